"""Benchmark decontamination by pigeonhole pieces and bit-parallel edit distance.

Texts and test items are lower-cased and their white space is made single spaces. An item of
``n`` characters is found where a stretch of the text is within ``n // per_error`` edits of it.
Cut into one piece more than that budget, at least one piece of the item must occur unchanged;
an automaton over all pieces finds these hits, and the text around each is verified with Myers'
bit-parallel algorithm.

Defined results: null and empty texts hold nothing; items with a null or empty text are found
nowhere; items with a null id are reported under a null id;
items shorter than ``per_error`` must occur unchanged; equal items are reported under each of
their ids, repeated item rows once; repeated rows are searched one by one; of overlapping occurrences in a text the closest,
then the first counts, and all that do not overlap are reported. Columns other than ids and texts are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from heapq import heappop, heappush

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import all_columns, quoted, written

#: Bytes of test items that one pass over the texts searches for.
BLOCK_BYTES = 4 << 20
MATCH = "array<struct<item_id:long,start:long,end:long,distance:int>>"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def masks(pattern: str) -> dict[str, int]:
    """Bit ``i`` of a letter's mask is set where the pattern has it at ``i``."""
    found: dict[str, int] = defaultdict(int)
    for i, letter in enumerate(pattern):
        found[letter] |= 1 << i
    return dict(found)


def closest(pattern: dict[str, int], n: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to a stretch of ``text``, and the first such end."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down = full, 0  # vertical differences of +1 and -1
    distance, best, end = n, n, 0
    get = pattern.get
    for at, letter in enumerate(text, 1):
        equal = get(letter, 0)
        diagonal = equal | down
        level = (((equal & up) + up) ^ up) | equal
        rise = down | ~(level | up) & full
        fall = up & level
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
        rise = rise << 1 & full
        fall = fall << 1 & full
        up = fall | ~(diagonal | rise) & full
        down = rise & diagonal
        if distance < best:
            best, end = distance, at
    return best, end


class Items:
    """Test items and the automaton over their pieces."""

    def __init__(self, rows: list[tuple[int | None, str]], per_error: int):
        self.ids: dict[str, list[int | None]] = defaultdict(list)
        for item_id, text in rows:
            if text := normal(text):
                self.ids[text].append(item_id)
        self.texts = list(self.ids)
        self.budget = [len(t) // per_error for t in self.texts]
        self.forward = [masks(t) for t in self.texts]
        self.backward = [masks(t[::-1]) for t in self.texts]
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (text, errors) in enumerate(zip(self.texts, self.budget, strict=True)):
            edges = [len(text) * i // (errors + 1) for i in range(errors + 2)]
            for a, b in zip(edges, edges[1:], strict=False):
                pieces[text[a:b]].append((number, b))
        self.finder = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.finder.add_word(piece, places)
        if pieces:
            self.finder.make_automaton()

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """The closest, then first place of each item, as ``occurrences`` gives them."""
        best: dict[int | None, tuple] = {}
        for match in self.occurrences(text):
            held = best.setdefault(match[0], match)
            if match[3] < held[3]:
                best[match[0]] = match
        return list(best.values())

    def occurrences(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """``item_id, start, end, distance`` in the normalised text, by item, null ids last."""
        text = normal(text)
        if not text or not self.texts:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for end, places in self.finder.iter(text):
            for number, at in places:
                starts[number].add(end + 1 - at)
        found = []
        for number, guesses in starts.items():
            errors, n = self.budget[number], len(self.texts[number])
            parts = []
            done = -1
            for guess in sorted(guesses):
                # One look covers all hits that would begin within the budget of each other.
                if guess <= done:
                    continue
                done = guess + errors
                parts.append((max(0, guess - errors), min(len(text), guess + n + 2 * errors)))
            places = self.disjoint(number, text, parts)
            found += [(i, *p) for i in self.ids[self.texts[number]] for p in places]
        return sorted(found, key=lambda m: (m[0] is None, m[0] or 0, m[1:]))

    def nearest(self, number: int, text: str, low: int, high: int) -> tuple | None:
        """``distance, start, end`` of the item's closest place in a part of the text."""
        errors, n = self.budget[number], len(self.texts[number])
        if high - low < n - errors:
            return None
        around = text[low:high]
        distance, end = closest(self.forward[number], n, around)
        if distance > errors:
            return None
        back = around[max(0, end - n - errors):end][::-1]
        _, length = closest(self.backward[number], n, back)
        return distance, low + end - length, low + end

    def disjoint(self, number: int, text: str,
                 parts: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """``start, end, distance`` of places that do not overlap, closer and earlier ones first
        chosen; any other place within the budget overlaps one of them."""
        waiting: list[tuple] = []
        firsts: list[int] = []
        taken: list[tuple[int, int, int]] = []

        def look(low: int, high: int) -> None:
            if place := self.nearest(number, text, low, high):
                heappush(waiting, (*place, low, high))

        for low, high in parts:
            look(low, high)
        while waiting:
            distance, start, end, low, high = heappop(waiting)
            at = bisect_left(firsts, end)
            if not at or taken[at - 1][1] <= start:
                firsts.insert(at, start)
                taken.insert(at, (start, end, distance))
            # What is free of this part may hold further places.
            k = max(0, bisect_left(firsts, low) - 1)
            while k < len(taken) and taken[k][0] < high:
                if taken[k][1] > low:
                    look(low, taken[k][0])
                    low = taken[k][1]
                k += 1
            look(low, high)
        return taken


def item_blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The distinct items in blocks of about ``block_bytes``, so that each can be broadcast."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where(
        "text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [items.where(part == k).orderBy("item_id", "text") for k in range(blocks)]


def searcher(shared):
    """Function from texts to the matches of one block of items."""

    @F.pandas_udf(MATCH)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        items = Items(*shared.value)
        for texts in batches:
            yield pd.Series([items.occurrences(t) for t in texts])

    return find


def matched(docs: DataFrame, benchmark: DataFrame, per_error: int = 16,
            block_bytes: int = BLOCK_BYTES, column: str = "matches") -> DataFrame:
    """``docs`` with the items found in each text; an empty array if none is.

    They are in ``column``, in the place of a column of that name; ``common.free_name`` gives one
    that is free. No other column of ``docs`` is touched.
    Several blocks are searched one after the other, so that only one is in memory; the matches
    of each are written under a digest of the text and joined at the end.
    """
    context = docs.sparkSession.sparkContext
    none = F.expr("array()").cast(MATCH)
    blocks = item_blocks(benchmark, block_bytes)

    def shared(block: DataFrame):
        return context.broadcast(([tuple(r) for r in block.collect()], per_error))

    if len(blocks) < 2:
        return docs.withColumn(column, searcher(shared(blocks[0]))("text") if blocks else none)
    digest = F.sha2(F.col("text").cast("binary"), 256)
    passes = []
    for block in blocks:
        items = shared(block)
        found = docs.select(digest.alias("_digest"), searcher(items)("text").alias("_found"))
        passes.append(written(found.where(F.size("_found") > 0).dropDuplicates(["_digest"]),
                              "matches"))
        items.destroy()
    found = reduce(DataFrame.union, passes).groupBy("_digest").agg(
        F.sort_array(F.flatten(F.collect_list("_found"))).alias("_found"))
    # The columns of the documents go through the join inside a struct.
    held = docs.select(F.struct(*all_columns(docs)).alias("_document"), digest.alias("_digest"))
    result = F.coalesce("_found", none)
    columns = [result.alias(c) if c == column else F.col(f"_document.{quoted(c)}").alias(c)
               for c in docs.columns]
    return held.join(found, "_digest", "left").select(
        *columns, *([] if column in docs.columns else [result.alias(column)]))
