"""Late flows kept, and the closed windows they belong to corrected.

A windowed stream drops rows whose window it has closed. Here a second stream follows the stored
flows, keeps the late ones in a layer of their own, and counts the windows they touch anew from
all stored flows. Corrections stand beside gold, so gold stays append-only; readers put them in
the place of the rows they correct.

Which rows gold dropped is for gold's own watermark to say, which depends on how its batches
fell. The watermark used here is never behind it: it follows from all flows up to and including
the batch at hand, and both streams take the layer's files in one order. Windows behind it are
counted anew, and only counts that differ from gold's are written. Every later row of such a window
comes by here again, so the newest correction of a window and key holds all of its flows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlake.config import LakeConfig
from flowlake.model import FRONTIER, GOLD, SILVER, batched
from flowlake.operators.rollup import GOLD_ROLLUPS
from flowlake.operators.rules import keep_matching
from flowlake.sources.layers import read_layer
from flowlake.sources.streams import follow_layer
from flowlake.streaming.medallion import Medallion
from flowlake.streaming.sinks import triggered


def closed_by(newest: int, watermark: str) -> Column:
    """Whether a row's window ends at or before the newest time less the watermark's delay."""
    return F.col("window.end") <= F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {watermark}")


def recounted(lake: Medallion, table: str, touched: DataFrame) -> DataFrame:
    """The gold rows of the touched ``window, key`` pairs, from all stored flows."""
    key = GOLD_ROLLUPS[table].key
    first, last = touched.agg(F.min("window.start"), F.max("window.end")).first()
    flows = read_layer(touched.sparkSession, lake.cfg.silver, SILVER).where(
        F.col("ts").between(F.lit(first), F.lit(last))
        & F.col("date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    timed = flows.withColumn("window", F.window("ts", lake.cfg.window))
    return lake.gold(table, keep_matching(timed, touched, "window", key).drop("window"))


def start_corrections(lake: Medallion, trigger: str | None = None) -> StreamingQuery:
    """Follow the enriched flows and correct the lake's gold tables.

    A batch that is repeated replaces all it wrote before: late flows, corrections, and the newest
    time seen, by which the next batch tells what is late.
    """
    cfg = lake.cfg

    def correct(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        known = read_layer(session, f"{cfg.frontier}/batch={batch_id - 1}", FRONTIER).first()
        before = known.newest if known else None
        rows = rows.withColumn("window", F.window("ts", cfg.window)).persist()
        try:
            newest = rows.agg(F.max(F.unix_micros("ts"))).first()[0]
            newest = max((t for t in (before, newest) if t is not None), default=None)
            if newest is not None:
                _replace(session.createDataFrame([(newest,)], FRONTIER),
                         f"{cfg.frontier}/batch={batch_id}")
                if before is not None:
                    late = rows.where(closed_by(before, cfg.watermark)).drop("window")
                    _replace(late, f"{cfg.late}/batch={batch_id}", "date")
                behind = rows.where(closed_by(newest, cfg.watermark))
                if not behind.isEmpty():
                    for table in lake.tables:
                        _correct_table(lake, table, behind, batch_id)
        finally:
            rows.unpersist()

    writer = (
        follow_layer(lake.session, cfg.silver, SILVER, cfg.max_files).writeStream
        .queryName("corrections").foreachBatch(correct)
        .option("checkpointLocation", cfg.checkpoint("corrections"))
    )
    return triggered(writer, trigger).start()


def _correct_table(lake: Medallion, table: str, behind: DataFrame, batch_id: int) -> None:
    key, columns = GOLD_ROLLUPS[table].key, GOLD[table].fieldNames()
    touched = behind.select("window", key).distinct()
    counted = recounted(lake, table, touched).select(*columns)
    stored = read_layer(behind.sparkSession, lake.cfg.gold(table), GOLD[table])
    changed = keep_matching(counted, stored, *columns, how="left_anti")
    _replace(changed.withColumn("date", F.to_date("window.start")),
             f"{lake.cfg.corrections(table)}/batch={batch_id}", "date")


def _replace(rows: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write a batch's rows in the place of what an earlier attempt wrote; no file if none."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def read_late(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The flows that came after their window had closed."""
    return read_layer(spark, cfg.late, SILVER)


def read_corrected(spark: SparkSession, cfg: LakeConfig, table: str) -> DataFrame:
    """A gold table with the newest correction of each window and key in its place."""
    key, columns = GOLD_ROLLUPS[table].key, GOLD[table].fieldNames()
    rest = [c for c in columns if c not in ("window", key)]
    stored = read_layer(spark, cfg.gold(table), GOLD[table])
    corrections = read_layer(spark, cfg.corrections(table), batched(GOLD[table]))
    newest = corrections.groupBy("window", key).agg(
        F.max_by(F.struct(*rest), "batch").alias("_newest")).select("window", key, "_newest.*")
    return keep_matching(stored, newest, "window", key, how="left_anti").unionByName(newest)
