"""SimHash near-duplicates through an inverted index over positional bytes.

Two 64-bit fingerprints that differ in at most four bits differ in at most four of their eight
bytes, so at least four positional bytes are shared. The index lists fingerprints under every
group of three positional bytes of a family of 20 groups that has one inside any four of the
eight positions; each pair that is linked meets in at least one list. Within a list the shared
positional bytes of each pair are tallied, pairs below the guaranteed count of four go, and the
rest is verified by their bit distance.

Defined results: texts without a word (null, empty, white space) have fingerprint zero and are
linked like any other; equal fingerprints are linked; repeated rows get equal results; a null
id takes part but never names a component unless nothing else is in it; texts of any length are
taken whole; columns of any other name are carried through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import all_columns, group_starts, text_bytes, whole_groups, written
from flowlake.llm.components import components

POSITIONS = 8
#: Rows of one list that are compared in one task; longer lists are compared block by block.
LIST_BLOCK = 1500


def covering_groups(shared: int, width: int) -> list[tuple[int, ...]]:
    """Groups of ``width`` positions such that any ``shared`` positions contain one of them.

    For three of four the positions are dealt to three classes in a cycle: a group is taken if
    it lies in one class, or has two in a class and one in the next. Otherwise all groups.
    """
    groups = list(combinations(range(POSITIONS), width))
    if (shared, width) != (4, 3):
        return groups
    kind = [0, 0, 0, 1, 1, 1, 2, 2]

    def taken(g):
        k = [kind[p] for p in g]
        return len(set(k)) == 1 or any(k.count(c) == 2 and k.count((c + 1) % 3) == 1
                                       for c in range(3))

    return [g for g in groups if taken(g)]


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(
            starts[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist(), strict=True)),
        np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bits take eight times the space of the hashes
        counts += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8),
                                axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``docs`` with ``simhash``, a signed long."""

    @F.pandas_udf("long")
    def simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn("simhash", simhash(text_bytes()))


def postings(prints: DataFrame, distance: int, width: int) -> DataFrame:
    """``posting, simhash``: each fingerprint under its positional byte groups."""
    value = F.col("simhash")
    keys = []
    for number, group in enumerate(covering_groups(POSITIONS - distance, width)):
        key = F.lit(number).cast("long")
        for p in group:
            key = key * 256 + F.shiftrightunsigned(value, 8 * p).bitwiseAND(F.lit(255))
        keys.append(key)
    return prints.select(F.explode(F.array(*keys)).alias("posting"), "simhash")


def dealt(lists: DataFrame, block: int) -> DataFrame:
    """Lists with more than one entry; long ones as pairs of blocks, each met once.

    A list of ``g`` blocks gives each entry to the ``g`` block pairs it belongs to, so a task
    holds two blocks at most whatever the length of the list.
    """
    # Written, so that the join deals both sides out and can split a long list.
    sizes = written(lists.groupBy("posting").count().where("count > 1").select(
        "posting", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "lists")
    own = F.pmod(F.xxhash64("simhash"), F.col("blocks")).cast("int")
    return (lists.join(sizes, "posting").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("posting", F.least("own", "other").alias("low"),
                    F.greatest("own", "other").alias("high"), "simhash"))


def linked_in(frame: pd.DataFrame, keys: list[str], distance: int) -> pd.DataFrame:
    """Star links between the fingerprints that verified links connect within each group."""
    value = frame["simhash"].to_numpy()
    bounds = group_starts(frame, keys)
    end = np.repeat(bounds[1:], np.diff(bounds))
    active = np.arange(len(value))
    left, right = [], []
    step = 1
    while True:
        active = active[active + step < end[active]]
        if not len(active):
            break
        differing = value[active] ^ value[active + step]
        # Tally of shared positional bytes, then the exact bit distance.
        shared = (differing.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(1)
        close = np.flatnonzero(shared >= POSITIONS - distance)
        close = close[np.bitwise_count(differing[close].view(np.uint64)) <= distance]
        left.append(active[close])
        right.append(active[close] + step)
        step += 1
    if not left:
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    left, right = np.concatenate(left), np.concatenate(right)
    root = np.arange(len(value))
    while True:
        least = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, least)
        np.minimum.at(root, right, least)
        root = root[root]
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"a": value[root[moved]], "b": value[moved]}).drop_duplicates()


def links(prints: DataFrame, distance: int = 4, width: int = 3,
          block: int = LIST_BLOCK) -> DataFrame:
    """``a, b``: links whose components are those of all pairs within ``distance`` bits.

    ``prints`` holds distinct ``simhash`` values. A wider byte group means more rows in the
    index and fewer chance pairs; results are the same for widths up to ``8 - distance``.
    """
    keys = ["posting", "low", "high"]
    spread = dealt(postings(prints, distance, width), block)

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, keys):
            yield linked_in(frame, keys, distance)

    return (spread.repartition(*keys).sortWithinPartitions(*keys)
            .mapInPandas(pairs, "a long, b long").distinct())


def members(prints: DataFrame, distance: int = 4, width: int = 3) -> DataFrame:
    """``simhash, root``: the component of each fingerprint in ``prints``."""
    distinct = prints.select("simhash").distinct()
    roots = components(links(distinct, distance, width))
    return distinct.join(roots, distinct["simhash"] == roots["node"], "left").select(
        "simhash", F.coalesce("root", "simhash").alias("root"))


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4,
                    width: int = 3) -> DataFrame:
    """``doc_id, simhash, component_id``: one row per document, the component's smallest id."""
    prints = written(fingerprints(docs.select("doc_id", "text"), shingle)
                     .select("doc_id", "simhash"), "simhash")
    first = prints.groupBy("simhash").agg(F.min("doc_id").alias("first_id"))
    rooted = written(members(prints, distance, width).join(first, "simhash"), "rooted")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(rooted.join(named, "root").select("simhash", "component_id"), "simhash")


def one_of_each(docs: DataFrame, distance: int = 4, shingle: int = 4,
                width: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id.

    Ids come before null; of equal ids the text with the smaller hash stays, once.
    """
    key, digest = "key", "hash"
    # The columns of the documents go through the joins inside a struct.
    marked = docs.select(
        F.struct(*all_columns(docs)).alias("document"), "text",
        F.coalesce(F.col("doc_id"), F.lit(0)).alias(key),
        F.xxhash64(text_bytes(), F.col("doc_id").isNull()).alias(digest),
        F.col("doc_id").isNull().alias("no_id"))
    prints = written(fingerprints(marked.drop("document"), shingle)
                     .select(key, digest, "no_id", "simhash"), "simhash")
    first = prints.groupBy("simhash").agg(F.min(F.struct("no_id", key, digest)).alias("first"))
    chosen = (first.join(members(prints, distance, width), "simhash").groupBy("root")
              .agg(F.min("first").alias("kept")).select(f"kept.{key}", f"kept.{digest}"))
    turn = F.row_number().over(Window.partitionBy(key, digest).orderBy(key))
    return (marked.select("document", key, digest).join(chosen, [key, digest], "left_semi")
            .withColumn("turn", turn).where("turn = 1").select("document.*"))
