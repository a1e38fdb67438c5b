"""Few files in the place of many: compaction of the layers that streams append to.

A sink adds files with every trigger. Dates that are closed are rewritten into few files, in a
table beside the layer, and a manifest tells which version of a date is current and which of the
layer's files it holds. A manifest counts once its commit mark is there, so readers switch from
one state to the next at once, and a run that fails changes nothing. Files that come late for a
date are read from the layer until the date is compacted again. One compaction of a layer runs at
a time; streams and readers go on meanwhile. With a ``retention`` the sink's log forgets files
that old, so neither log nor layer grows for ever; compact within that time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlake.model import MANIFEST, VERSION
from flowlake.sources.layers import read_layer, write_layer


def _folder(path: str) -> str:
    return f"{path}_compacted"


def _files(spark: SparkSession, pattern: str) -> list[str]:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    return [str(found.getPath()) for found in store.globStatus(path) or ()]


def committed(spark: SparkSession, path: str) -> int:
    """Number of the layer's newest committed manifest; 0 if there is none."""
    marks = _files(spark, f"{_folder(path)}/manifest/version=*/_SUCCESS")
    return max((int(m.split("version=")[1].split("/")[0]) for m in marks), default=0)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``date, version, file``: the layer's files held by the current version of each date."""
    version = committed(spark, path)
    if not version:
        return spark.createDataFrame([], MANIFEST)
    return read_layer(spark, f"{_folder(path)}/manifest/version={version}", MANIFEST)


def _in_layer(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The layer's committed rows, and the file of each."""
    rows = spark.read.schema(schema).parquet(path)
    return rows.select(*schema.fieldNames(), F.col("_metadata.file_path").alias("_file"))


def _in_versions(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of the current versions."""
    current = manifest(spark, path).select("date", "version").distinct()
    stored = read_layer(spark, f"{_folder(path)}/data", StructType(schema.fields + VERSION.fields))
    return stored.join(current, ["date", "version"], "left_semi").drop("version")


def compact(spark: SparkSession, path: str, schema: StructType, before: str,
            write: Callable[..., None] = write_layer) -> int:
    """Rewrite the dates earlier than ``before`` that have files of their own in the layer.

    Returns the number of the manifest in force. ``schema`` names the layer's ``date``; with
    ``write=write_clustered`` enriched flows are also sorted for lookups of addresses.
    """
    known, version = manifest(spark, path), committed(spark, path) + 1
    layer = _in_layer(spark, path, schema).where(F.col("date") < F.lit(before).cast("date"))
    # Written first: what is compacted stays the same though the stream goes on.
    pending = f"{_folder(path)}/pending/version={version}"
    files = layer.select("date", F.col("_file").alias("file")).distinct()
    files.join(known, "file", "left_anti").coalesce(1).write.mode("overwrite").parquet(pending)
    pending = spark.read.schema(StructType([f for f in MANIFEST.fields if f.name != "version"])
                                ).parquet(pending)
    dates = pending.select("date").distinct()
    if dates.isEmpty():
        return version - 1
    new = layer.join(pending.select(F.col("file").alias("_file")), "_file", "left_semi")
    old = _in_versions(spark, path, schema).join(dates, "date", "left_semi")
    columns = schema.fieldNames()
    write(new.select(*columns).unionByName(old.select(*columns)),
          f"{_folder(path)}/data/version={version}", "date", mode="overwrite")
    covered = known.join(dates, "date", "left_semi").select("date", "file").unionByName(
        pending.select("date", "file"))
    listed = known.join(dates, "date", "left_anti").select("date", "version", "file").unionByName(
        covered.select("date", F.lit(version).alias("version"), "file"))
    listed.coalesce(1).write.mode("overwrite").parquet(
        f"{_folder(path)}/manifest/version={version}")
    return version


def read_compacted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of a layer: current versions, and the layer's files that they do not hold."""
    if not committed(spark, path):
        return read_layer(spark, path, schema)
    held = manifest(spark, path).select(F.col("file").alias("_file"))
    columns = schema.fieldNames()
    rest = _in_layer(spark, path, schema).join(held, "_file", "left_anti")
    return _in_versions(spark, path, schema).select(*columns).unionByName(rest.select(*columns))


def files_per_date(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """``date, files``: how many files a reader of all rows opens for a date."""
    held = manifest(spark, path)
    of_layer = _in_layer(spark, path, schema).select("date", F.col("_file").alias("file")).distinct()
    open_files = of_layer.join(held, "file", "left_anti")
    versions = spark.read.schema(StructType(schema.fields + VERSION.fields)).parquet(
        f"{_folder(path)}/data").select("date", "version", F.col("_metadata.file_path").alias("file"))
    current = versions.join(held.select("date", "version").distinct(), ["date", "version"],
                            "left_semi").select("date", "file").distinct()
    return open_files.select("date", "file").unionByName(current).groupBy("date").agg(
        F.count("*").alias("files"))


def drop_superseded(spark: SparkSession, path: str) -> list[str]:
    """Delete versions that the current manifest does not name, and manifests before it."""
    newest = committed(spark, path)
    used = {r.version for r in manifest(spark, path).select("version").distinct().collect()}
    folder, gone = _folder(path), []
    context = spark.sparkContext
    for kind, kept in (("data", used), ("manifest", {newest}), ("pending", set())):
        for found in _files(spark, f"{folder}/{kind}/version=*"):
            number = int(found.split("version=")[1])
            if number <= newest and number not in kept:
                target = context._jvm.org.apache.hadoop.fs.Path(found)
                target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
                gone.append(found)
    return gone
