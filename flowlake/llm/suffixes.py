"""Exact removal of repeated byte strings: threshold-bounded intervals over a suffix array.

A string of ``least`` bytes is removed wherever it starts if it starts anywhere else too. To
find all of them without sorting the corpus in one place:

1. Each window of ``least`` bytes has a minimizer, its smallest hashed byte gram. Consecutive
   windows that share one minimizer occurrence form a run; about one run per 90 bytes. Equal
   windows have equal minimizers at equal distance, so only runs of one minimizer can hold equal
   windows, and a run never holds a window twice.
2. Runs whose minimizer occurs once are done. Where all runs of a minimizer have the same
   content, all their windows repeat.
3. Of the rest each distinct content is cut out once. Those that agree with no other of their
   minimizer in the bytes just before it, or just after it, are done. Blocks of whole minimizer groups are
   indexed by a suffix array and its Burrows-Wheeler transform; breadth-first backward extension
   finds the common prefixes by increasing value and stops at ``least``. Neighbours whose common
   prefix is still unknown then share a window. Groups too large for a block are narrowed first:
   their runs are cut into stretches that have more bytes in common than the minimizer, which
   splits the group, makes most contents equal and, at a stretch of one window, all of them.

Contents are compared by 64-bit hashes of runs within 44-bit minimizers.

Defined results: null and empty texts have no bytes and keep none; matches never cross rows;
repeated rows remove each other; a string that overlaps itself counts; columns other than the
id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from flowlake.llm.common import group_starts, quoted, text_bytes, whole_groups, written

#: Long enough not to occur twice by chance in prose; a multiple of 8.
GRAM = 32
#: Bytes hashed at once; a packed position has this many values.
CHUNK = 1 << 17
#: Bytes of the pieces in which texts meet the runs that are cut out of them.
PIECE = 1 << 16
#: Distinct contents of one minimizer that one block may hold.
GROUP_LIMIT = 1500
LOW = np.uint64(CHUNK - 1)
MULTIPLIERS = tuple(np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hash of each ``GRAM`` bytes."""
    a, b, c = MULTIPLIERS
    words = np.ascontiguousarray(sliding_window_view(data, 8)).view("<u8").ravel()
    n = len(data) - GRAM + 1
    x = words[:n] * a
    for at in range(8, GRAM, 8):
        x ^= x >> np.uint64(32)
        x += words[at:at + n]
        x *= b
    x ^= x >> np.uint64(29)
    x *= c
    x ^= x >> np.uint64(32)
    return x


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks both ways."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.ascontiguousarray(
        np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


class RunFinder:
    """Runs of windows that share a minimizer, over many short byte strings at once."""

    def __init__(self, least: int):
        self.least = least
        odd = np.full(CHUNK, MULTIPLIERS[0], np.uint64)
        odd[0] = 1
        self.power = np.cumprod(odd)
        inverse = np.full(CHUNK, pow(int(MULTIPLIERS[0]), -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self.inverse = np.cumprod(inverse)
        self.index = np.arange(CHUNK, dtype=np.uint64)

    def pieces(self, texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        """Texts too long for a chunk in pieces that share ``least - 1`` bytes."""
        step = CHUNK // 2
        for row, text in enumerate(texts):
            if len(text) <= step:
                yield row, 0, text
            else:
                for at in range(0, len(text) - self.least + 1, step):
                    yield row, at, text[at:at + step + self.least - 1]

    def __call__(self, texts: list[bytes]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, int, bytes]] = []
        size = 0
        for piece in self.pieces(texts):
            if len(piece[2]) < self.least:
                continue
            if size + len(piece[2]) > CHUNK:
                yield self.runs(held)
                held, size = [], 0
            held.append(piece)
            size += len(piece[2])
        if held:
            yield self.runs(held)

    def runs(self, held: list[tuple[int, int, bytes]]) -> pd.DataFrame:
        least = self.least
        lengths = np.array([len(t) for _, _, t in held])
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(t for _, _, t in held), np.uint8)
        grams = gram_hashes(data)
        smallest = sliding_minimum((grams & ~LOW) | self.index[:len(grams)], least - GRAM + 1)
        windows = lengths - least + 1
        firsts = ends - lengths
        owner = np.repeat(np.arange(len(held)), windows)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + firsts[owner]
        value = smallest[at]
        new = np.ones(len(at), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        start = at[first]
        total = np.zeros(len(grams) + 1, np.uint64)
        np.cumsum(grams * self.power[:len(grams)], out=total[1:])
        content = (total[start + count + least - GRAM] - total[start]) * self.inverse[start]
        content = (content ^ count.astype(np.uint64) * MULTIPLIERS[1]) * MULTIPLIERS[2]
        content ^= content >> np.uint64(31)
        which = owner[first]
        rows = np.array([r for r, _, _ in held])
        offsets = np.array([o for _, o, _ in held])
        return pd.DataFrame({
            "row": rows[which],
            "start": start - firsts[which] + offsets[which],
            "windows": count.astype(np.int32),
            "anchor": ((value[first] & LOW).astype(np.int64) - start).astype(np.int32),
            "minimizer": (value[first] >> np.uint64(20)).astype(np.int64),
            "content": content.view(np.int64),
        })


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions ordered by their first ``depth`` symbols or more, by prefix doubling."""
    n, known = len(symbols), 7
    padded = np.append(symbols, np.zeros(known, np.int64))
    key = np.zeros(n, np.int64)
    for k in range(known):
        key = key << 9 | padded[k:k + n]
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.append(0, np.cumsum(ordered[1:] != ordered[:-1])) + 1
        if known >= depth or rank[order[-1]] == n:
            return order
        key = rank * (n + 1)
        if known < n:
            key[:n - known] += rank[known:]
        known *= 2


def shared_prefix_groups(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order, and a group number per rank: equal numbers share ``least`` symbols.

    Symbol 0 separates strings. The common prefix of two neighbours is found by backward
    extension: an interval of ranks holds the suffixes that begin with one string; extending it
    by each symbol before it gives the intervals of strings one longer, whose upper neighbour
    then has a common prefix of the present length unless a shorter one is known already.
    Values come in increasing order, and the search ends at ``least``.
    """
    n = len(symbols)
    order = suffix_order(symbols, least)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = place[order - 1]  # rank of the suffix one longer
    symbol = symbols[order - 1]  # the transform
    unknown = np.ones(n + 1, bool)
    unknown[[0, n]] = False
    marked, owner_at = np.zeros(n, bool), np.zeros(n, np.int32)
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(least):
        sizes = high - low + 1
        owner = np.repeat(np.arange(len(low)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]
        real = symbol[inside] != 0
        inside, owner = inside[real], owner[real]
        if not len(inside):
            break
        longer = before[inside]
        if len(longer) > n // 64:  # in order by a scan over all ranks
            marked[longer], owner_at[longer] = True, owner
            longer = np.flatnonzero(marked)
            owner = owner_at[longer]
            marked[longer] = False
        else:
            by = np.argsort(longer)
            longer, owner = longer[by], owner[by]
        via = symbols[order[longer]]
        cut = np.flatnonzero((longer[1:] != longer[:-1] + 1) | (owner[1:] != owner[:-1])
                             | (via[1:] != via[:-1]))
        low, high = longer[np.append(0, cut + 1)], longer[np.append(cut, len(longer) - 1)]
        new = unknown[high + 1]
        low, high = low[new], high[new]
        unknown[high + 1] = False
    return order, np.cumsum(~unknown[:n])


def repeated_windows(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For each string, which of its windows starts anywhere else in the strings."""
    lengths = np.array([len(s) for s in strings])
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
    firsts = np.cumsum(lengths + 1) - lengths - 1
    data[firsts + lengths] = 0
    remaining = np.repeat(firsts + lengths, lengths + 1) - np.arange(len(data))
    order, group = shared_prefix_groups(data, least)
    whole = remaining[order] >= least
    count = np.bincount(group[whole], minlength=int(group[-1]) + 1)
    repeated = np.zeros(len(data), bool)
    repeated[order[whole]] = count[group[whole]] > 1
    return [repeated[f:f + max(0, n - least + 1)]
            for f, n in zip(firsts.tolist(), lengths.tolist(), strict=True)]


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of true values."""
    edge = np.diff(np.concatenate(([0], flags.view(np.int8), [0])))
    start = np.flatnonzero(edge == 1)
    return start, np.flatnonzero(edge == -1) - start


def keyed(docs: DataFrame) -> DataFrame:
    """The other columns as ``document``, the bytes, and a key for rows of equal id and text."""
    body = text_bytes()
    others = [F.col(quoted(c)).alias(c) for c in docs.columns if c != "text"]
    return docs.select(F.struct(*others).alias("document"),
                       F.coalesce(F.col("doc_id"), F.lit(0)).alias("key"),
                       F.xxhash64(body, F.col("doc_id").isNull()).alias("hash"),
                       body.alias("body"), F.col("text").isNull().alias("no_text"))


def gathered(frames: Iterator[pd.DataFrame], least: int = 50_000) -> Iterator[pd.DataFrame]:
    """Small frames put together, so that each one sent is worth its cost."""
    held, rows = [], 0
    for frame in frames:
        if len(frame):
            held.append(frame)
            rows += len(frame)
        if rows >= least:
            yield pd.concat(held, ignore_index=True)
            held, rows = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def runs_of(texts: DataFrame, least: int) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = RunFinder(least)
        for batch in batches:
            key, digest = batch["key"].to_numpy(), batch["hash"].to_numpy()
            for runs in gathered(finder(batch["body"].tolist())):
                row = runs.pop("row").to_numpy()
                yield runs.assign(key=key[row], hash=digest[row])

    return texts.select("key", "hash", "body").mapInPandas(
        find, "start long, windows int, anchor int, minimizer long, content long, key long, "
              "hash long")


def pieces_of(texts: DataFrame, least: int) -> DataFrame:
    """``key, hash, piece, bytes``: texts in pieces of ``PIECE`` bytes.

    Each piece goes on for as long as a run that starts in it can, so a run needs one piece and
    no row is larger than a piece, however long the text.
    """
    last = F.expr(f"cast((octet_length(body) - 1) div {PIECE} as int)")
    longest = 2 * least - GRAM
    return (texts.where(F.octet_length("body") >= least)
            .select("key", "hash", "body", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
            .select("key", "hash", "piece", F.expr(
                f"substring(body, piece * {PIECE} + 1, {PIECE + longest})").alias("bytes")))


def might_share(frame: pd.DataFrame, least: int) -> np.ndarray:
    """Which contents of a frame of whole groups can share a window with another of their group.

    A window reaches half of what it has beside the minimizer's gram to one side at least, so two
    contents that share one agree in the gram and that many bytes before it, or after it.
    """
    half = -(-(least - GRAM) // 2)
    segments, anchors = frame["segment"].tolist(), frame["anchor"].tolist()
    alike = np.zeros(len(frame), bool)
    for near in (
            [xxh64_intdigest(s[a - half:a + GRAM]) if a >= half else None
             for s, a in zip(segments, anchors, strict=True)],
            [xxh64_intdigest(s[a:a + GRAM + half]) if len(s) - a - GRAM >= half else None
             for s, a in zip(segments, anchors, strict=True)]):
        known = np.array([n is not None for n in near], bool)
        sides = pd.DataFrame({"group": frame["minimizer"].to_numpy()[known],
                              "side": np.array([n for n in near if n is not None], np.uint64)})
        alike[known] |= sides.duplicated(keep=False).to_numpy()
    return alike


def _settled_in_blocks(segments: DataFrame, least: int) -> DataFrame:
    """``minimizer, content, at, windows``: repeated windows of contents, by suffix arrays."""
    keys = ["minimizer"]

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        alike = (f[might_share(f, least)] for f in whole_groups(batches, keys, least=GROUP_LIMIT))
        for frame in gathered(alike, least=GROUP_LIMIT):
            flags = repeated_windows(frame["segment"].tolist(), least)
            found = [(i, *stretches(f)) for i, f in enumerate(flags) if f.any()]
            if not found:
                continue
            which = np.repeat([i for i, _, _ in found], [len(a) for _, a, _ in found])
            yield pd.DataFrame({
                "minimizer": frame["minimizer"].to_numpy()[which],
                "content": frame["content"].to_numpy()[which],
                "at": np.concatenate([a for _, a, _ in found]),
                "windows": np.concatenate([n for _, _, n in found]).astype(np.int32)})

    return (segments.select("minimizer", "content", "anchor", "segment")
            .repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(settle, "minimizer long, content long, at long, windows int"))


def narrowed(segments: DataFrame, least: int, width: int) -> DataFrame:
    """Stretches of at most ``width`` windows under a hash of the bytes they have in common.

    A window is told by its distance to the minimizer; stretches are cut at multiples of
    ``width`` of that distance, so that equal windows come into equal stretches.
    """

    def narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for minimizer, content, copies, anchor, segment in batch.itertuples(index=False):
                last = len(segment) - least
                for k in range(max(0, anchor - last) // width, anchor // width + 1):
                    first, end = max(0, anchor - k * width - width + 1), min(last, anchor - k * width)
                    if first <= end:
                        core = segment[anchor - k * width:
                                       anchor - k * width - width + 1 + least]
                        rows.append((minimizer, content, copies, first, anchor - first,
                                     xxh64_intdigest(core, k) - (1 << 63),
                                     segment[first:end + least]))
            yield pd.DataFrame(rows, columns=["minimizer", "content", "copies", "first", "anchor",
                                              "core", "segment"])

    return segments.select("minimizer", "content", "copies", "anchor", "segment").mapInPandas(
        narrow, "minimizer long, content long, copies long, first long, anchor int, core long, "
                "segment binary")


def settled(segments: DataFrame, least: int, widths: tuple[int, ...] = (16, 1)) -> DataFrame:
    """``minimizer, content, at, windows``: the repeated windows of distinct contents.

    ``segments`` has ``minimizer, content, copies, crowd, anchor, segment``; ``crowd`` is the number
    of contents of the minimizer, ``anchor`` its place in the segment. Contents with copies repeat as a whole.
    """
    whole = segments.where("copies > 1").select(
        "minimizer", "content", F.lit(0).cast("long").alias("at"),
        (F.octet_length("segment") - least + 1).alias("windows"))
    small = segments.where(F.col("crowd").between(2, GROUP_LIMIT))
    found = whole.union(_settled_in_blocks(small, least))
    large = segments.where(F.col("crowd") > GROUP_LIMIT)
    if not widths or not large.limit(1).count():
        return found
    parts = written(narrowed(large, least, widths[0]), "narrowed")
    contents = parts.groupBy("core", "segment").agg(
        F.sum("copies").alias("copies"), F.min("anchor").alias("anchor"))
    crowd = contents.groupBy("core").agg(F.count("*").alias("crowd"), F.sum("copies").alias("all"))
    # A stretch whose common bytes are nowhere else has no repeated window.
    shared = contents.join(crowd.where("all > 1").drop("all"), "core")
    own = F.xxhash64("segment")
    inner = written(shared.select(F.col("core").alias("minimizer"), own.alias("content"),
                                  "copies", "crowd", "anchor", "segment"), "stretches")
    within = settled(inner, least, widths[1:]).select(
        F.col("minimizer").alias("core"), F.col("content").alias("own"), "at", "windows")
    back = (parts.withColumn("own", own).join(within, ["core", "own"])
            .select("minimizer", "content", (F.col("first") + F.col("at")).alias("at"),
                    "windows"))
    return found.union(back)


def repeated_starts(texts: DataFrame, least: int) -> DataFrame:
    """``key, hash, start, windows``: stretches of starts whose windows start elsewhere too.

    Rows of equal key and hash have equal runs; each stretch is given once for all of them.
    """
    runs = written(runs_of(texts, least), "all-runs")
    # Written, so that the joins below deal both sides out and split a common minimizer.
    shared = (runs.groupBy("minimizer")
              .agg(F.count("*").alias("n"), F.min("content").alias("lo"),
                   F.max("content").alias("hi"))
              .where("n > 1").select("minimizer", (F.col("lo") != F.col("hi")).alias("mixed")))
    runs = written(runs.join(written(shared, "shared"), "minimizer"), "runs")
    mixed = runs.where("mixed")
    contents = mixed.groupBy("minimizer", "content", "windows").agg(
        F.count("*").alias("copies"), F.min("anchor").alias("anchor"),
        F.min(F.struct("key", "hash", "start")).alias("first"))
    contents = written(contents.select("minimizer", "content", "windows", "copies", "anchor",
                                       "first.*"), "contents")
    crowd = written(contents.groupBy("minimizer").agg(F.count("*").alias("crowd")), "crowd")
    wanted = contents.join(crowd, "minimizer").withColumns({
        "piece": F.expr(f"cast(start div {PIECE} as int)"),
        "at": F.expr(f"cast(start % {PIECE} as int)")})
    cut = F.expr(f"substring(bytes, at + 1, windows + {least - 1})")
    segments = written(
        wanted.join(pieces_of(texts, least), ["key", "hash", "piece"])
        .select("minimizer", "content", "copies", "crowd", "anchor", cut.alias("segment"))
        .dropDuplicates(["minimizer", "content"]), "segments")
    part = settled(segments, least).select("minimizer", "content", "at",
                                           F.col("windows").alias("found"))
    return (mixed.join(part, ["minimizer", "content"])
            .select("key", "hash", (F.col("start") + F.col("at")).alias("start"),
                    F.col("found").alias("windows"))
            .union(runs.where("not mixed").select("key", "hash", "start", "windows"))
            .distinct())


def spans_of(starts: DataFrame, least: int) -> DataFrame:
    """``key, hash, spans``: the maximal spans that repeated windows cover, packed as pairs.

    Rows come sorted and are merged as they pass, so a task holds one batch and the spans of the
    text at hand; no list of windows is ever gathered.
    """
    keys = ["key", "hash"]

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(frame):
                continue
            merged = merged_spans(frame, least)
            last = merged["text"].iloc[-1]
            # The last text may go on in the next batch: its spans come back as stretches.
            open_ones = merged["text"] == last
            held = frame.iloc[merged["first"][open_ones]][keys].assign(
                start=merged["start"][open_ones].to_numpy(),
                windows=(merged["end"] - merged["start"] - least + 1)[open_ones].to_numpy())
            if not open_ones.all():
                yield packed_spans(frame, merged[~open_ones])
        if held is not None:
            yield packed_spans(held, merged_spans(held.reset_index(drop=True), least))

    return (starts.select(*keys, "start", F.col("windows").cast("long").alias("windows"))
            .repartition(*keys).sortWithinPartitions(*keys, "start")
            .mapInPandas(merge, "key long, hash long, spans binary"))


def merged_spans(frame: pd.DataFrame, least: int) -> pd.DataFrame:
    """``text, first, start, end``: spans of stretches sorted by text and start.

    ``text`` numbers the texts of the frame, ``first`` is the row at which a span begins.
    """
    bounds = group_starts(frame, ["key", "hash"])
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    start = frame["start"].to_numpy()
    end = start + frame["windows"].to_numpy() + least - 1
    # The furthest end so far within a text: texts are put one behind the other.
    far = int(end.max()) + 1
    reach = np.maximum.accumulate(end + text * far) - text * far
    new = np.ones(len(frame), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return pd.DataFrame({"text": text[first], "first": first, "start": start[first],
                         "end": reach[np.append(first[1:], len(frame)) - 1]})


def packed_spans(frame: pd.DataFrame, merged: pd.DataFrame) -> pd.DataFrame:
    """One row per text: its spans as pairs of 64-bit numbers."""
    texts = np.append(np.flatnonzero(np.diff(merged["text"], prepend=-1)), len(merged))
    pairs = np.ascontiguousarray(merged[["start", "end"]].to_numpy(np.int64))
    rows = merged["first"].to_numpy()[texts[:-1]]
    return pd.DataFrame({
        "key": frame["key"].to_numpy()[rows], "hash": frame["hash"].to_numpy()[rows],
        "spans": [pairs[a:b].tobytes() for a, b in zip(texts, texts[1:], strict=False)]})


def cut_out(body: bytes, spans: bytes) -> tuple[bytes, list[tuple[int, int]]]:
    """What stays of ``body`` without the packed spans; the spans as start and length."""
    pairs = np.frombuffer(spans, np.int64).reshape(-1, 2).tolist()
    edges = [0, *(x for s in pairs for x in s), len(body)]
    kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
    return kept, [(a, b - a) for a, b in pairs]


def remover(characters: bool):
    """Function of a body and its packed spans; null spans give null."""

    @F.pandas_udf("kept binary, spans array<struct<start:long,length:long>>")
    def remove(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for bodies, founds in batches:
            done = [(None, None) if f is None else cut_out(b, f)
                    for b, f in zip(bodies, founds, strict=True)]
            kept = [k for k, _ in done]
            if characters:
                kept = [k and k.decode("utf-8", "ignore").encode() for k in kept]
            yield pd.DataFrame({"kept": kept, "spans": [s for _, s in done]})

    return remove


def without_repeats(docs: DataFrame, least: int = 200, characters: bool = False) -> DataFrame:
    """``document, no_text, body, kept, spans``: bytes before and after, and the removed spans.

    ``document`` holds the columns of ``docs`` but the text. A span may begin or end inside a
    character; with ``characters`` what is left of such a character goes too, so that the kept
    bytes are text.
    """
    texts = keyed(docs)
    found = spans_of(repeated_starts(texts, least), least).withColumnRenamed("spans", "found")
    touched = F.when(F.col("found").isNotNull(), F.col("body"))
    no_spans = F.expr("array()").cast("array<struct<start:bigint,length:bigint>>")
    return (texts.join(found, ["key", "hash"], "left")
            .withColumn("cut", remover(characters)(touched, "found"))
            .select("document", "no_text", "body",
                    F.coalesce("cut.kept", "body").alias("kept"),
                    F.coalesce("cut.spans", no_spans).alias("spans")))
