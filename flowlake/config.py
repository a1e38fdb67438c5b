"""Lake configuration, session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Settings every job needs, whoever built the session.
SESSION_CONF = {
    # Dates and wire texts are UTC.
    "spark.sql.session.timeZone": "UTC",
    # The INT96 default carries no min/max statistics, so time filters could not
    # skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The JVM interprets methods above 8000 bytes of bytecode. Wide projections
    # pass that when fused into one method; Spark then splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# State lives off the executor heap and checkpoints as change logs, so the
# number of open (window, entity) groups is not bounded by memory.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class LakeConfig:
    """Where the lake lives and how its streams run.

    ``shuffle_partitions`` is fixed for the life of a streaming checkpoint, so
    size it for the peak, not for the first day. ``None`` takes the session's
    setting. ``max_offsets`` and ``max_files`` bound what one micro-batch takes
    from the log and from a followed layer, so that a backlog is worked off in
    batches of a size the cluster knows. ``silver_files_per_date`` shuffles each batch of
    the enriched layer into that many files per date: set it for backfills, whose
    batches span many dates; a live batch spans one or two and needs no shuffle.
    ``gold_files`` gathers the windows a batch closes into that many files per
    gold table; by default every state partition writes one. ``salts`` splits hot
    keys of the rollups that allow it, see ``rollup``. ``retention`` (such as ``7d``) lets the logs
    of the sinks forget files that old, see ``streaming.compaction``. ``suppress`` also judges the
    alerts of the destination profile by the past of their target, see ``streaming.decayed``.
    """

    # Default paths, topics and stream settings of a deployment.
    bronze: str = "/data/bronze/netflow"
    silver: str = "/data/silver/netflow_enriched"
    gold_root: str = "/data/gold"
    checkpoint_root: str = "/data/checkpoints"
    bronze_checkpoint: str | None = None
    silver_checkpoint: str | None = None
    brokers: str = "localhost:9092"
    topic: str = "netflow.raw"
    alerts_topic: str = "netflow.alerts"
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    app_name: str = "flowlake"
    window: str = "1 minute"
    watermark: str = "2 minutes"
    trigger: str = "10 seconds"
    distinct: str = "approx"
    shuffle_partitions: int | None = None
    silver_files_per_date: int | None = None
    gold_files: int | None = None
    salts: int = 1
    max_offsets: int | None = None
    max_files: int | None = None
    retention: str | None = None
    suppress: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> LakeConfig:
        """Read the deployment's environment variables; blanks keep defaults."""
        env = os.environ if env is None else env
        named = {
            "brokers": "KAFKA_BROKERS",
            "topic": "KAFKA_TOPIC",
            "bronze": "BRONZE_PATH",
            "silver": "SILVER_PATH",
            "gold_root": "GOLD_PATH",
            "bronze_checkpoint": "CHECKPOINT_PATH",
            "silver_checkpoint": "SILVER_CHECKPOINT",
        }
        numbers = {
            "shuffle_partitions": "SHUFFLE_PARTITIONS",
            "silver_files_per_date": "SILVER_FILES_PER_DATE",
            "gold_files": "GOLD_FILES",
            "salts": "SALTS",
            "max_offsets": "MAX_OFFSETS_PER_TRIGGER",
            "max_files": "MAX_FILES_PER_TRIGGER",
        }
        texts = {
            "alerts_topic": "ALERTS_TOPIC",
            "starting_offsets": "STARTING_OFFSETS",
            "window": "WINDOW",
            "watermark": "WATERMARK",
            "trigger": "TRIGGER",
            "retention": "RETENTION",
            "distinct": "DISTINCT_MODE",
        }
        found = {f: env[name] for f, name in {**named, **texts}.items() if env.get(name)}
        found |= {f: int(env[name]) for f, name in numbers.items() if env.get(name)}
        if env.get("SUPPRESS"):
            found["suppress"] = env["SUPPRESS"].lower() in ("1", "true", "yes")
        return cls(**{**found, **overrides})

    @classmethod
    def under(cls, root: str, **overrides) -> LakeConfig:
        """All layers and checkpoints below one folder."""
        paths = {
            "bronze": f"{root}/bronze",
            "silver": f"{root}/silver",
            "gold_root": f"{root}/gold",
            "checkpoint_root": f"{root}/checkpoints",
        }
        return cls(**{**paths, **overrides})

    @property
    def alerts(self) -> str:
        return self.gold("alerts")

    @property
    def received(self) -> str:
        return f"{self.bronze}_received"

    @property
    def quarantine(self) -> str:
        return f"{self.bronze}_quarantine"

    @property
    def batches(self) -> str:
        return self.gold("stream_batches")

    @property
    def latency(self) -> str:
        return self.gold("alert_latency")

    @property
    def judged(self) -> str:
        return self.gold("judged_alerts")

    @property
    def late(self) -> str:
        return f"{self.silver}_late"

    @property
    def frontier(self) -> str:
        return f"{self.checkpoint_root}/corrections_frontier"

    def corrections(self, table: str) -> str:
        return self.gold(f"{table}_corrections")

    def gold(self, table: str) -> str:
        return f"{self.gold_root}/{table}"

    def checkpoint(self, sink: str) -> str:
        """One checkpoint folder per sink, below one root unless overridden."""
        override = {"bronze": self.bronze_checkpoint, "silver": self.silver_checkpoint}
        return override.get(sink) or f"{self.checkpoint_root}/{sink}"


def seconds_of(spark: SparkSession, interval: str) -> int:
    """Length of an interval text such as ``1 minute``."""
    return spark.sql(f"SELECT unix_seconds(timestamp_seconds(0) + INTERVAL {interval})").first()[0]


def open_session(cfg: LakeConfig | None = None, master: str | None = None) -> SparkSession:
    """Session for lake jobs."""
    cfg = cfg or LakeConfig()
    builder = SparkSession.builder.appName(cfg.app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **STATE_CONF}.items():
        builder = builder.config(key, value)
    if cfg.shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(cfg.shuffle_partitions))
    return builder.getOrCreate()


def pinned(spark: SparkSession) -> SparkSession:
    """A session with the settings jobs need: ``spark`` itself if it has them.

    Otherwise a sibling with the caller's settings and these, so that the
    caller's session stays as it is.
    """
    if all(spark.conf.get(key, None) == value for key, value in SESSION_CONF.items()):
        return spark
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and session.conf.get(key, None) != value:
            session.conf.set(key, value)
    for key, value in SESSION_CONF.items():
        session.conf.set(key, value)
    return session


def streaming_session(spark: SparkSession, cfg: LakeConfig) -> SparkSession:
    """Sibling session with the streaming settings, leaving ``spark`` as it is.

    The session's number of shuffle partitions holds unless ``cfg`` names one.
    """
    session = spark.newSession()
    for key, value in {**SESSION_CONF, **STATE_CONF}.items():
        session.conf.set(key, value)
    partitions = cfg.shuffle_partitions or spark.conf.get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return session


_application_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """Fresh folder that driver and executors can all reach.

    It lies below the folder the cluster names in ``spark.checkpoint.dir``, in
    one folder per application that goes when the application ends. Only a
    local-mode session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    top = _application_folders.get(context.applicationId)
    if top is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            root = tempfile.mkdtemp(prefix="flowlake-")
        top = f"{root.rstrip('/')}/flowlake/{context.applicationId}"
        path = context._jvm.org.apache.hadoop.fs.Path(top)
        store = path.getFileSystem(context._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _application_folders[context.applicationId] = top
    return f"{top}/{purpose}-{uuid.uuid4().hex}"
