"""Best-fit packing of token sequences with a bounded number of open bins.

Documents are tokenized, closed by an end id, and cut where they exceed the sequence length.
Each task packs its pieces online: a piece goes to the open bin it leaves least room in. Free
spaces are keys of a bitset, so the tightest fit is the lowest bit at or above the piece's
length. Only a fixed number of bins is open; when one more is needed the fullest closes.

Defined results: null and empty texts are one piece that holds the end id; texts of any length,
blank ones too, are encoded whole; repeated rows are packed one by one; columns other than the id
and the text are not read, whatever their names; an empty table has no sequence. The tokenizer file is read on the executors, which need it at the same path.
"""

from __future__ import annotations

import json
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 0
#: Letters on whose class every Unicode version agrees; others go the plain way.
UNUSUAL = re.compile("[^\u0000-\u036f\u2000-\u206f\u20a0-\u20bf]")
#: Longer runs of white space than this go the plain way.
LONGEST_BLANK = 10_000
BLANK = re.compile(r"\s{64}\s*+")
#: The pattern by which byte-level files split a text; a fixed value of the format.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_of_letter() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: visible ones stand for themselves."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts as the tokenizer file gives them, without special tokens added.

    A plain byte-level file also loads as merge ranks, which encode several times as fast.
    Texts that hold a special token, unusual letters or a very long run of white space (whose
    pattern overflows the quick way's stack) go through the file's own tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = self.as_ranks(path)

    def as_ranks(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model, split = held["model"], held["pre_tokenizer"] or {}
        vocabulary = {t: i for t, i in model.get("vocab", {}).items() if t not in self.special}
        letters = byte_of_letter()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        plain = (model["type"] == "BPE" and split.get("type") == "ByteLevel"
                 and split.get("use_regex", True) and not split.get("add_prefix_space")
                 and not held["normalizer"] and not model.get("dropout")
                 and set("".join(vocabulary)) <= letters.keys()
                 # A merge's rank must be the id of what it makes.
                 and [vocabulary.get(a + b) for a, b in merges]
                 == list(range(256, 256 + len(merges))))
        if not plain:
            return None
        ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items()}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks,
                                 special_tokens={}).encode_ordinary

    def plainly(self, text: str) -> bool:
        return (self.quick is None or UNUSUAL.search(text) is not None
                or any(s in text for s in self.special)
                or any(m.end() - m.start() > LONGEST_BLANK for m in BLANK.finditer(text)))

    def __call__(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if self.plainly(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.quick(text)
        return np.array(ids, "<u4").tobytes()


def pieces(docs: DataFrame, tokenizer: str, length: int, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and on request ``ids``.

    The first piece of a cut document takes what does not fill a sequence.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = Encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for key, null, text in batch.itertuples(index=False):
                ids = encode(text) + end
                n = len(ids) // 4
                edges = [0, *range(n % length or length, n, length), n]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    own = ids[4 * a:4 * b]
                    rows.append((key, null, k, a, b - a, crc32(own),
                                 np.frombuffer(own, "<u4").astype(np.int64) if with_ids else None))
            yield pd.DataFrame(rows, columns=[
                "key", "no_id", "piece", "start", "length", "ids_crc32", "ids"])

    cut_rows = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(0)).cast("long").alias("key"),
        F.col("doc_id").isNull().alias("no_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).mapInPandas(cut, "key long, no_id boolean, piece int, start long, length long, "
                       "ids_crc32 long, ids array<long>")
    columns = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return cut_rows.select(F.when(~F.col("no_id"), F.col("key")).alias("doc_id"), *columns)


class OpenBins:
    """Free spaces of the open bins as a bitset, and the bins behind each."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.spaces, self.count, self.made = 0, 0, 0
        self.bins: defaultdict[int, list[int]] = defaultdict(list)

    def _take(self, free: int) -> int:
        same = self.bins[free]
        number = same.pop()
        if not same:
            self.spaces ^= 1 << free
        self.count -= 1
        return number

    def _put(self, number: int, free: int) -> None:
        if not free:
            return
        if self.count >= self.most:  # the fullest closes
            fullest = (self.spaces & -self.spaces).bit_length() - 1
            if free <= fullest:
                return
            self._take(fullest)
        self.bins[free].append(number)
        self.spaces |= 1 << free
        self.count += 1

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece."""
        fitting = self.spaces >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        self._put(number, free - length)
        return number, self.capacity - free


def packed(pieces: DataFrame, length: int = 2048, open_bins: int = 256) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Pieces are spread and ordered by a hash; adaptive execution gathers small partitions, so
    that few bins are left open. Memory is that of the open bins.
    """
    schema = pieces.schema.simpleString()[len("struct<"):-1]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bins = OpenBins(length, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch["length"].tolist()]
            yield batch.assign(sequence_id=[base + b for b, _ in placed],
                               offset=[o for _, o in placed])

    return (pieces.repartition("doc_id", "piece", "ids_crc32")
            .sortWithinPartitions("ids_crc32", "doc_id", "piece")
            .mapInPandas(pack, f"{schema},sequence_id:bigint,offset:bigint"))
