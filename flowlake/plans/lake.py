"""A lake built by batch jobs from an ``events`` table, layer by layer on demand."""

from __future__ import annotations

from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.config import LakeConfig, shared_folder
from flowlake.model import ALERT, FLOW, GOLD, MESSAGE, SILVER, SOURCE_BITS
from flowlake.operators.enrich import enrich, with_date
from flowlake.operators.mergeable import PANES, address_bits, panes
from flowlake.operators.rollup import GOLD_ROLLUPS, rollup
from flowlake.operators.rules import STANDARD_RULES, detect_all
from flowlake.sources.events import flows_of_events, messages_of_events
from flowlake.sources.layers import read_layer, write_clustered, write_layer


class EventLake:
    """Messages, bronze, silver, gold and alerts of one events table.

    Each layer is written once, to the shared folder, from the layer before it.
    That cuts the lineage: views read stored rows, and a lost executor costs a
    re-read rather than the whole chain.
    """

    def __init__(self, spark: SparkSession, events_path: str):
        self.spark = spark
        self.events_path = events_path
        self.cfg = LakeConfig.under(shared_folder(spark, "lake"))
        self._written: set[str] = set()
        self._lock = RLock()

    def events(self) -> DataFrame:
        return self.spark.read.parquet(self.events_path)

    def messages(self) -> DataFrame:
        """What the message log would hold."""
        return self._layer(
            f"{self.cfg.bronze}_log", MESSAGE,
            lambda: messages_of_events(self.events()).withColumn(
                "timestamp", F.col("timestamp").cast("timestamp")
            ),
        )

    def bronze(self) -> DataFrame:
        return self._layer(
            self.cfg.bronze, FLOW,
            lambda: flows_of_events(self.events()).withColumn("ts", F.col("ts").cast("timestamp")),
        )

    def silver(self) -> DataFrame:
        return self._layer(
            self.cfg.silver, SILVER, lambda: with_date(enrich(self.bronze())), "date"
        )

    def clustered(self) -> DataFrame:
        """The silver layer as ``write_clustered`` lays it out."""
        return self._layer(f"{self.cfg.silver}_clustered", SILVER, self.silver, "date",
                           write_clustered)

    def gold(self, table: str, window: str) -> DataFrame:
        path = self.cfg.gold(f"{table}_{window.replace(' ', '_')}")
        return self._layer(
            path, GOLD[table],
            lambda: rollup(self.silver(), GOLD_ROLLUPS[table], window, distinct="exact"),
        )

    def panes(self, table: str, window: str) -> DataFrame:
        """A gold table that merges, see ``operators.mergeable``."""
        path = self.cfg.gold(f"{table}_{window.replace(' ', '_')}")
        return self._layer(
            path, PANES[table].schema(), lambda: panes(self.silver(), PANES[table], window))

    def source_bits(self, window: str) -> DataFrame:
        path = self.cfg.gold(f"source_bits_{window.replace(' ', '_')}")
        return self._layer(
            path, SOURCE_BITS, lambda: address_bits(self.silver(), "dst_ip", "src_ip", window))

    def alerts(self, window: str) -> DataFrame:
        path = self.cfg.gold(f"alerts_{window.replace(' ', '_')}")
        return self._layer(
            path, ALERT,
            lambda: detect_all({r.table: self.gold(r.table, window) for r in STANDARD_RULES}),
        )

    def _layer(self, path, schema, build, partition_by=None, write=write_layer) -> DataFrame:
        with self._lock:
            if path not in self._written:
                write(build(), path, partition_by)
                self._written.add(path)
        return read_layer(self.spark, path, schema)


_lakes: dict[tuple[str, str], tuple[object, EventLake]] = {}
_lakes_lock = RLock()


def state_of(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change of the files a table consists of."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(context._jsc.hadoopConfiguration()).listFiles(found, True)
    state = []
    while files.hasNext():
        file = files.next()
        state.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return sorted(state)


def lake_of(spark: SparkSession, events_path: str) -> EventLake:
    """The lake of an events table, shared by the queries of an application.

    A table whose files have changed gets a new lake.
    """
    key, state = (spark.sparkContext.applicationId, events_path), state_of(spark, events_path)
    with _lakes_lock:
        if key not in _lakes or _lakes[key][0] != state:
            _lakes[key] = (state, EventLake(spark, events_path))
        return _lakes[key][1]
