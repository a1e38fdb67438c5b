"""Start the lake's streams: ``spark-submit run_streams.py``.

Brokers, topics, paths, rate limits and sizes come from the environment, see
``LakeConfig.from_env``. Beside the layers run the corrections of late flows and the metrics of
the streams. With ``SUPPRESS`` set alerts are also judged by the past of their target, with
``ALERTS_TOPIC`` set the alerts also go to that topic.
"""

import os
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from flowlake.config import LakeConfig, open_session, seconds_of
from flowlake.model import ALERT
from flowlake.operators.rules import FAN_IN
from flowlake.sources.streams import open_stream
from flowlake.streaming.decayed import start_decayed
from flowlake.streaming.late import start_corrections
from flowlake.streaming.medallion import STANDARD_TABLES, Medallion
from flowlake.streaming.metrics import BatchLog, start_latency
from flowlake.streaming.sinks import publish_alerts


def start(spark: SparkSession, cfg: LakeConfig,
          open_messages: Callable[[SparkSession], DataFrame]) -> Medallion:
    """Start all streams that the configuration asks for."""
    profile = ("destination_profile",) if cfg.suppress else ()
    lake = Medallion(spark, cfg, open_messages=open_messages, tables=STANDARD_TABLES + profile)
    lake.session.streams.addListener(BatchLog(lake.session, cfg.batches))
    lake.start()
    start_corrections(lake, cfg.trigger)
    start_latency(lake.session, cfg, cfg.trigger)
    if cfg.suppress:
        start_decayed(lake.session, cfg, replace(FAN_IN, table="destination_profile"),
                      seconds_of(spark, cfg.window), cfg.trigger)
    return lake


def main() -> None:
    cfg = LakeConfig.from_env()
    spark = open_session(cfg)
    spark.sparkContext.setLogLevel("WARN")
    lake = start(spark, cfg, lambda session: open_stream(session, cfg))
    if os.environ.get("ALERTS_TOPIC"):
        publish_alerts(lake.follow(cfg.alerts, ALERT), cfg, cfg.trigger)
    lake.session.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
