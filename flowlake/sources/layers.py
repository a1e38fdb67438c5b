"""Reading and writing the stored layers of the lake."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlake.functions.address import ip_number


def read_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a layer; none if nothing has been written yet.

    Goes through Spark so that files a stream has not committed stay invisible.
    Of a layer stored by date the column is read if the schema names it.
    """
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def between(flows: DataFrame, since: Column | None = None, until: Column | None = None,
            entity: dict[str, str] | None = None) -> DataFrame:
    """Rows of a time range (``until`` excluded) and of given key values.

    Adds the matching bounds on ``date`` where the layer has that column, so
    that whole partitions are skipped.
    """
    dated = "date" in flows.columns
    bounds = []
    if since is not None:
        bounds.append(F.col("ts") >= since)
        if dated:
            bounds.append(F.col("date") >= F.to_date(since))
    if until is not None:
        bounds.append(F.col("ts") < until)
        if dated:
            bounds.append(F.col("date") <= F.to_date(until))
    bounds += [F.col(name) == value for name, value in (entity or {}).items()]
    return reduce(DataFrame.where, bounds, flows)


def interleaved(first: Column, second: Column) -> Column:
    """The low 16 bits of two numbers in turn, ``first`` leading: neighbours in both stay near."""
    def spread(x: Column) -> Column:
        x = x.cast("long").bitwiseAND(F.lit(0xFFFF))
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
        return x

    return F.shiftleft(spread(first), 1).bitwiseOR(spread(second))


def write_clustered(df: DataFrame, path: str, partition_by: str, mode: str = "append") -> None:
    """Write enriched flows so that the flows of one address and time lie together.

    Within a date rows are dealt out and sorted by an interleaved key of the quarter of an hour
    and the address block of the destination, so the statistics of a row group span little of
    both. Bloom filters tell for both addresses which row groups cannot hold them.
    """
    slot = F.floor(F.unix_seconds("ts") / 900)
    block = F.coalesce(F.shiftright(ip_number("dst_ip"), 8), F.xxhash64("dst_ip"))
    # Address blocks are folded to 16 bits; equal addresses stay together.
    block = block.bitwiseXOR(F.shiftright(block, 8))
    writer = (
        df.withColumn("_near", interleaved(block, slot))
        .repartitionByRange(partition_by, "_near").sortWithinPartitions(partition_by, "_near")
        .drop("_near").write.mode(mode).partitionBy(partition_by)
    )
    for address in ("src_ip", "dst_ip"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{address}", "true")
    writer.parquet(path)


def entity_history(silver: DataFrame, address: str, since: Column | None = None,
                   until: Column | None = None) -> DataFrame:
    """Flows that an address sent or received in a time range, told apart by ``role``.

    Each role is a scan with an equality that row-group statistics and Bloom filters can answer.
    A flow from the address to itself is listed as sent.
    """
    flows = between(silver, since, until)
    sent = flows.where(F.col("src_ip") == address)
    received = flows.where((F.col("dst_ip") == address) & ~F.col("src_ip").eqNullSafe(address))
    return sent.withColumn("role", F.lit("sent")).unionByName(
        received.withColumn("role", F.lit("received")))


def write_layer(df: DataFrame, path: str, partition_by: str | None = None,
                mode: str = "append") -> None:
    """Append a batch to a layer (or write it anew, by ``mode``).

    Rows are rebalanced first, by the partition column if there is one: files
    get an even size, and a date that holds a third of all rows is split over
    several tasks.
    """
    hint = df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")
    writer = hint.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def _with_file(df: DataFrame) -> DataFrame:
    """The file each row was read from; the frame of a missing layer knows no files."""
    try:
        return df.select(F.col("_metadata.file_path").alias("_file"))
    except AnalysisException:
        return df.select(F.lit("none").alias("_file"))


def inventory(layers: dict[str, DataFrame]) -> DataFrame:
    """Files and rows per layer.

    Rows are first counted per file, so only file names are shuffled. A layer
    that has not been written has no files and no rows.
    """
    counted = [
        _with_file(df).groupBy("_file")
        .agg(F.count("*").alias("_rows"))
        .agg(
            F.count("*").alias("files"),
            F.coalesce(F.sum("_rows"), F.lit(0).cast("bigint")).alias("row_count"),
        )
        .select(F.lit(name).alias("layer"), "files", "row_count")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counted)
