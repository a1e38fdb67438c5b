"""Approximate nearest neighbours with a forest of random-projection trees.

Each tree halves the space again and again: two sample vectors give a direction, the median of
the sample's projections on it the plane. The forest is fitted on a bounded sample; its depth
follows the number of vectors up to the sample's size. Every vector is then routed to one leaf
per tree. A query walks all trees through one shared priority queue, in which a node waits under
the smallest distance to a plane on the way to it, and takes the leaves that come first until
they hold enough vectors. Queries and members of a leaf meet in one shuffle; distances there are
exact and in double precision, and the nearest of all leaves are merged.

Equal vectors are indexed once, with as many of their smallest ids as a result can use, so a
vector that is very common costs as much as any other. Where vectors outnumber the leaves by far
a leaf's members are dealt to slices, and its queries go to each of them.

Defined results: vectors that are null, zero, or hold a null or non-finite component take no
part; nor do vectors of another width than most; a null id takes no part; repeated rows of one
id count once per vector; ties go to the smaller id; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import group_starts, whole_groups, written

LEAF_ROWS = 2000


@dataclass(frozen=True)
class Forest:
    """Complete binary trees in heap order: node ``i`` has children ``2i+1`` and ``2i+2``."""

    planes: np.ndarray  # trees, nodes, width
    offsets: np.ndarray  # trees, nodes
    depth: int

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree."""
        leaves = np.zeros((len(self.planes), len(vectors)), np.int64)
        for tree, (planes, offsets) in enumerate(zip(self.planes, self.offsets, strict=True)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", vectors, planes[node]) >= offsets[node]
                node = 2 * node + 1 + side
            leaves[tree] = node - (2**self.depth - 1)
        return leaves

    def search(self, queries: np.ndarray, leaves: int) -> list[list[tuple[int, int]]]:
        """The first ``leaves`` (tree, leaf) of each query by the shared priority queue."""
        inner = 2**self.depth - 1
        found = []
        for at in range(0, len(queries), 256):
            part = queries[at:at + 256]
            margins = np.einsum("qd,tnd->qtn", part, self.planes, optimize=True) - self.offsets
            for margin in margins.tolist():
                queue = [(-np.inf, tree, 0) for tree in range(len(self.planes))]
                heapify(queue)
                taken: list[tuple[int, int]] = []
                while queue and len(taken) < leaves:
                    waiting, tree, node = heappop(queue)
                    if node >= inner:
                        taken.append((tree, node - inner))
                        continue
                    m = margin[tree][node]
                    heappush(queue, (max(waiting, m), tree, 2 * node + 1))
                    heappush(queue, (max(waiting, -m), tree, 2 * node + 2))
                found.append(taken)
        return found


def grow(sample: np.ndarray, trees: int, depth: int, seed: int = 11) -> Forest:
    """Trees whose planes halve the sample between two of its vectors."""
    random = np.random.default_rng(seed)
    width = sample.shape[1]
    planes = np.zeros((trees, 2**depth - 1, width))
    offsets = np.zeros((trees, 2**depth - 1))
    for tree in range(trees):
        members = [np.arange(len(sample))]
        for node in range(2**depth - 1):
            rows = members[node]
            if len(rows) > 1:
                a, b = random.choice(rows, 2, replace=False)
                plane = sample[a] - sample[b]
            else:
                plane = random.normal(size=width)
            plane = plane / max(float(np.linalg.norm(plane)), 1e-300)
            along = sample[rows] @ plane
            planes[tree, node] = plane
            offsets[tree, node] = np.median(along) if len(rows) else 0.0
            side = along >= offsets[tree, node]
            members += [rows[~side], rows[side]]
            members[node] = None
    return Forest(planes, offsets, depth)


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``id, vector`` of the rows that take part, components as doubles."""
    value = F.col(vector).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(key).cast("long").alias("id"), value.alias("vector"))
            .where(F.col("id").isNotNull() & F.coalesce(
                finite & F.exists("vector", lambda x: x != 0), F.lit(False))))


def common_width(rows: DataFrame) -> int:
    """The most frequent number of components, the larger of equals; 0 without a row."""
    found = (rows.groupBy(F.size("vector").alias("width")).count()
             .orderBy(F.desc("count"), F.desc("width")).first())
    return found["width"] if found else 0


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """``group, vector, ids``: each distinct vector with its ``most`` smallest ids.

    The limit is applied per task before the shuffle, so a common vector moves few rows.
    """
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    return (rows.distinct().withColumn("turn", rank).where(F.col("turn") <= most)
            .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .select(F.col("ids")[0].alias("group"), "vector", "ids"))


def forest_for(groups: DataFrame, total: int, trees: int, leaf: int,
               sample: int) -> Forest | None:
    """A forest over a hash sample of about ``sample`` of ``total`` vectors, or all of them.

    None for an empty table.
    """
    if not total:
        return None
    share = int(min(1.0, sample / total) * (1 << 20))
    rows = (groups.where(F.pmod(F.xxhash64("vector"), F.lit(1 << 20)) < max(share, 1))
            .select("vector").toPandas()["vector"])
    if not len(rows):
        rows = groups.select("vector").limit(1).toPandas()["vector"]
    matrix = np.vstack(rows.to_numpy())
    matrix = matrix[np.lexsort(matrix.T)]  # the same forest whatever the order of the files
    return grow(matrix, trees, max(0, int(np.ceil(np.log2(max(1, len(matrix) / leaf))))))


def routed(groups: DataFrame, forest: Forest, slices: int) -> DataFrame:
    """Members: a row for each vector and tree."""
    shared = groups.sparkSession.sparkContext.broadcast(forest)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = shared.value
        for batch in batches:
            if not len(batch):
                continue
            leaves = forest.route(np.vstack(batch["vector"].to_numpy()))
            for tree, leaf in enumerate(leaves):
                yield pd.DataFrame({"tree": tree, "leaf": leaf, "group": batch["group"],
                                    "vector": batch["vector"]})

    return (groups.select("group", "vector")
            .mapInPandas(route, "tree int, leaf long, group long, vector array<double>")
            .select("tree", "leaf", F.pmod(F.xxhash64("group"), F.lit(slices)).alias("slice"),
                    F.lit(False).alias("asks"), "group", "vector"))


def asked(groups: DataFrame, forest: Forest, leaves: int, slices: int) -> DataFrame:
    """Queries: a row for each leaf a query takes, and each slice of it."""
    shared = groups.sparkSession.sparkContext.broadcast(forest)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forest = shared.value
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                taken = forest.search(np.vstack(part["vector"].to_numpy()), leaves)
                which = np.repeat(np.arange(len(part)), [len(t) for t in taken])
                both = np.array([x for t in taken for x in t])
                yield pd.DataFrame({
                    "tree": both[:, 0], "leaf": both[:, 1],
                    "group": part["group"].to_numpy()[which],
                    "vector": part["vector"].to_numpy()[which]})

    return (groups.select("group", "vector")
            .mapInPandas(ask, "tree int, leaf long, group long, vector array<double>")
            .withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"),
                                                      F.lit(slices - 1).cast("long"))))
            .select("tree", "leaf", "slice", F.lit(True).alias("asks"), "group", "vector"))


def reranked(frame: pd.DataFrame, keys: list[str], most: int) -> pd.DataFrame:
    """``asking, group, score``: the nearest members of each query in a frame's leaves, exactly.

    The leaves of a frame are merged here, so that a query leaves ``most`` rows per frame.
    """
    asks, group = frame["asks"].to_numpy(bool), frame["group"].to_numpy()
    vectors = np.vstack(frame["vector"].to_numpy())
    bounds = group_starts(frame, keys)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, b in zip(bounds, bounds[1:], strict=False):
        rows = np.arange(a, b)
        queries, members = rows[asks[a:b]], rows[~asks[a:b]]
        if not len(queries) or not len(members):
            continue
        for q in queries:
            difference = vectors[members] - vectors[q]
            distance = np.sqrt((difference * difference).sum(1))
            if len(distance) > most:  # and all that tie with the last one
                near = np.flatnonzero(distance <= np.partition(distance, most - 1)[most - 1])
            else:
                near = np.arange(len(distance))
            found.append((np.full(len(near), group[q]), group[members[near]], distance[near]))
    if not found:
        return pd.DataFrame({"asking": [], "group": [], "score": []})
    asking, member, score = (np.concatenate(x) for x in zip(*found, strict=True))
    rows = pd.DataFrame({"asking": asking, "group": member, "score": score})
    return (rows.sort_values(["asking", "score", "group"]).drop_duplicates()
            .groupby("asking").head(most))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id",
            vector: str = "embedding", trees: int = 8, leaf: int = 128, share: float = 0.1,
            least: int = 12_000, sample: int = 20_000) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, itself excluded.

    ``queries`` has the same columns as ``vectors``. A query looks at leaves until they hold
    ``share`` of all trees' entries, ``least`` at any rate: data without structure needs the
    default, clustered data far less. ``sample`` bounds the fit and the size of the forest.
    """
    keys = ["tree", "leaf", "slice"]
    rows = usable(vectors, key, vector)
    width = common_width(rows)
    groups = written(distinct_vectors(rows.where(F.size("vector") == width), k + 1), "vectors")
    asking = usable(queries, key, vector).where(F.size("vector") == width).distinct()
    asking_groups = asking.select("vector").distinct().join(groups, "vector")
    total = groups.count()
    forest = forest_for(groups, total, trees, leaf, sample)
    schema = "asking long, group long, score double"
    if forest is None:
        found = groups.select(F.col("group").alias("asking"), "group",
                              F.lit(0.0).alias("score")).limit(0)
    else:
        slices = max(1, -(-total // (LEAF_ROWS * 2**forest.depth)))
        entries = max(share * trees * total, least)
        leaves = int(np.ceil(min(trees, entries / total) * 2**forest.depth))
        rows = routed(groups, forest, slices).union(asked(asking_groups, forest, leaves, slices))

        def rerank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in whole_groups(batches, keys):
                yield reranked(frame, keys, k + 1)

        found = (rows.repartition(*keys).sortWithinPartitions(*keys)
                 .mapInPandas(rerank, schema).distinct())
    first = Window.partitionBy("asking").orderBy("score", "group")
    best = (found.withColumn("turn", F.row_number().over(first))
            .where(F.col("turn") <= k + 1).drop("turn"))
    # Ids of equal vectors, then each query without itself.
    named = (best.join(groups.select("group", "ids"), "group")
             .select("asking", "score", F.explode("ids").alias("vec_id")))
    ids = (asking.join(groups.select("vector", F.col("group").alias("asking")), "vector")
           .select("asking", F.col("id").alias("query_id")))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (ids.join(named, "asking").where("query_id != vec_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
