"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard has ``replicas`` points on a ring of 64-bit hashes. A row's home is the shard whose
point follows the hash of its text, so equal texts have one home. Shards have a capacity; rows
come in the order of a second hash of their text, and a row that finds its shard full continues
clockwise to the next shard that is not. With ``slack`` 0 the capacities add up to the number of
rows: all shards fill, and counts are at most one apart. With more slack fewer rows leave home and
fewer move when a shard is added.

Rows between two neighbouring points and in one turn of the second hash form a cell. All rows of
a cell see the same shards in the same order, so the fate of a cell follows from the number of
rows in each cell: the driver gets at most ``turns * shards * replicas`` counts, however many rows
there are, and finds at which cell each shard fills. At most one cell per shard is split between
shards; its rows take them in the order of a written table's files and rows. Everything else is a
function of the row. Places within shards are counted per file first, so that neither a large
shard nor a large group of copies meets in one task.

Defined results: a null text counts as empty and shares the home of empty texts; null and repeated
ids are rows like any other, as rows are told by their place in the written table; copies of one
text stay together unless their shard fills among them; an empty table gives no rows, fewer rows
than shards one row to some shards and none to others. Texts may be of any length, only their hash,
size and checksum are kept. Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlake.llm.common import text_bytes, written

#: Bytes a row takes beside its text.
OVERHEAD = 16
#: Rows of a file of the keys at most, hence of a group that is numbered in one task.
FILE_ROWS = 1 << 20


@dataclass(frozen=True)
class Ring:
    """Points of the shards in ring order, and the shards met from each point on."""

    points: np.ndarray  # unsigned, ascending
    order: np.ndarray  # per point, the shards in clockwise order

    @classmethod
    def of(cls, shards: int, replicas: int) -> Ring:
        names = [(xxhash.xxh64_intdigest(f"shard {s} point {r}".encode()), s)
                 for s in range(shards) for r in range(replicas)]
        points, owners = zip(*sorted(names), strict=True)
        order = np.empty((len(points), shards), np.int32)
        # Walking anticlockwise, each point puts its shard before all others.
        recent: list[int] = []
        for at in [*range(len(points)), *range(len(points))][::-1]:
            owner = owners[at]
            if owner in recent:
                recent.remove(owner)
            recent.insert(0, owner)
            if len(recent) == shards:
                order[at] = recent
        return cls(np.array(points, np.uint64), order)

    def arcs(self, hashes: np.ndarray) -> np.ndarray:
        """Number of the point at or after each hash, clockwise."""
        return np.searchsorted(self.points, hashes) % len(self.points)


@dataclass(frozen=True)
class Placement:
    """How cells go to shards: the cell at which each shard fills, and the split cells.

    ``filled[s]`` is the cell that takes the last place of shard s; later cells pass it by.
    ``split`` gives the cells that several shards take rows of: cell, first rank, shard.
    """

    filled: np.ndarray
    split: list[tuple[int, int, int]]


def capacities(rows: int, shards: int, slack: float) -> np.ndarray:
    """Equal shares, whole rows; without slack the first shards take what is left over."""
    if slack:
        return np.full(shards, int(np.ceil(rows * (1 + slack) / shards)), np.int64)
    return np.full(shards, rows // shards) + (np.arange(shards) < rows % shards)


def placed(ring: Ring, cells: np.ndarray, counts: np.ndarray, capacity: np.ndarray) -> Placement:
    """Deal cells, in ascending order, to the first shards clockwise that have room.

    Cells are numbered turn by turn; within a turn by point.
    """
    shards = len(capacity)
    room = capacity.astype(np.int64).copy()
    filled = np.where(room > 0, np.iinfo(np.int64).max, -1)
    split: list[tuple[int, int, int]] = []
    by = np.argsort(cells)
    cells, counts = cells[by], counts[by].astype(np.int64)
    orders = ring.order[cells % len(ring.points)]
    done = 0
    while done < len(cells):
        # To whom the cells would go if no further shard filled.
        free = (room > 0)[orders[done:]]
        target = orders[done:][np.arange(len(cells) - done), free.argmax(1)]
        # The first cell that does not fit, over all shards.
        stop = len(cells) - done
        for s in np.flatnonzero(room > 0):
            mine = np.flatnonzero(target == s)
            over = np.searchsorted(np.cumsum(counts[done + mine]), room[s], "left")
            if over < len(mine):
                stop = min(stop, int(mine[over]))
        room -= np.bincount(target[:stop], counts[done:done + stop], shards).astype(np.int64)
        done += stop
        if done == len(cells):
            break
        # This cell fills its shard and goes on to the next ones with what is left.
        rank, left = 0, int(counts[done])
        for s in orders[done].tolist():
            if not left:
                break
            taken = min(left, int(room[s]))
            if taken:
                split.append((int(cells[done]), rank, s))
                room[s] -= taken
                rank, left = rank + taken, left - taken
                if not room[s]:
                    filled[s] = cells[done]
        done += 1
    return Placement(filled, split)


def keys_of(docs: DataFrame, ring: Ring, turns: int) -> DataFrame:
    """``doc_id, size, text_crc32, cell`` and the row's place: ``file, row``."""
    points = len(ring.points)

    @F.pandas_udf("long")
    def cell(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for home, turn in batches:
            yield pd.Series(turn * points + ring.arcs(home.to_numpy().view(np.uint64)))

    body = text_bytes()
    home = F.xxhash64(body)
    keyed = docs.select("doc_id", (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
                        F.crc32(body).alias("text_crc32"),
                        cell(home, F.pmod(F.xxhash64(home), F.lit(turns))).alias("cell"))
    return (written(keyed, "keys", max_rows=FILE_ROWS)
            .select("*", F.xxhash64("_metadata.file_path").alias("file"),
                    F.col("_metadata.row_index").alias("row")))


def numbered(rows: DataFrame, group: str) -> Column:
    """Number from 0 of each row within its group, in the order of files and rows.

    A file's rows of a group are numbered in one task, the files by their counts.
    """
    counts = written(rows.groupBy(group, "file").agg(F.count("*").alias("rows")), "counts")
    until = Window.partitionBy(group).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(group, "file", F.coalesce(F.sum("rows").over(until), F.lit(0)).alias(
        "before"))
    own = F.row_number().over(Window.partitionBy(group, "file").orderBy("row")) - 1
    return (rows.withColumn("own", own).join(before, [group, "file"])
            .withColumn("number", F.col("own") + F.col("before")).drop("own", "before"))


def sharded(docs: DataFrame, shards: int = 40, slack: float = 0.0, replicas: int = 128,
            turns: int = 32) -> DataFrame:
    """``doc_id, size, text_crc32, home, shard, slot``: one row per row of ``docs``.

    ``home`` is where the ring alone would put the row; ``slot`` counts from 0 in each shard.
    """
    ring = Ring.of(shards, replicas)
    rows = keys_of(docs, ring, turns)
    counts = rows.groupBy("cell").agg(F.count("*").alias("rows")).toPandas()
    cells, sizes = counts["cell"].to_numpy(np.int64), counts["rows"].to_numpy(np.int64)
    place = placed(ring, cells, sizes, capacities(int(sizes.sum()), shards, slack))
    points = len(ring.points)

    @F.pandas_udf("home int, shard int")
    def assign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for cell in batches:
            at = cell.to_numpy(np.int64)
            order = ring.order[at % points]
            free = place.filled[order] > at[:, None]
            shard = order[np.arange(len(at)), free.argmax(1)]
            yield pd.DataFrame({"home": order[:, 0], "shard": shard})

    rows = rows.withColumn("to", assign("cell")).select(
        "doc_id", "size", "text_crc32", "cell", "file", "row", "to.home", "to.shard")
    if place.split:
        several = sorted({c for c, _, _ in place.split})
        inside = F.col("cell").isin(several)
        ranked = numbered(rows.where(inside), "cell")
        starts = F.array(*(F.struct(F.lit(c).cast("long").alias("cell"),
                                    F.lit(r).cast("long").alias("rank"), F.lit(s).alias("shard"))
                           for c, r, s in place.split))
        mine = F.filter(starts, lambda s: (s["cell"] == F.col("cell"))
                        & (s["rank"] <= F.col("number")))
        ranked = ranked.withColumn("shard", F.element_at(mine, -1)["shard"]).drop("number")
        rows = rows.where(~inside).unionByName(ranked)
    return numbered(written(rows, "shards"), "shard").select(
        "doc_id", "size", "text_crc32", "home", "shard", F.col("number").cast("long").alias("slot"))
