"""The chained streams of the lake.

messages -> received -> bronze -> silver -> gold tables -> alerts, and received
-> quarantine. Each layer follows the committed files of the one before, so the
log is read once, bronze and quarantine together hold exactly what was received,
and the alert rules are plain filters over gold. Layers of flows, gold and alerts are
stored by date; what was received and the quarantine are not, as a text that cannot be
decoded has no date. With a retention set their logs forget old files like all others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlake.config import LakeConfig, streaming_session
from flowlake.model import FLOW, GOLD, RECEIVED, SILVER, dated
from flowlake.operators.codec import decode, parse_flows, quarantined, valid_flows
from flowlake.operators.enrich import enrich, with_date
from flowlake.operators.mergeable import PANES, address_bits, panes
from flowlake.operators.rollup import GOLD_ROLLUPS, rollup
from flowlake.operators.rules import STANDARD_RULES, Rule, detect_all
from flowlake.sources.streams import follow_layer
from flowlake.streaming.metrics import observed
from flowlake.streaming.sinks import append_files

#: Gold tables beside those of ``GOLD_ROLLUPS`` and ``PANES``.
SOURCE_BITS_TABLE = "source_bits"

STANDARD_TABLES = ("top_destinations", "top_talkers", "router_summary")


@dataclass
class Medallion:
    """Builds and starts the streams of one lake.

    ``open_messages`` or ``open_flows`` gives the input, as a stream on the
    session it is called with: messages with a ``value``, or flow rows.
    """

    spark: SparkSession
    cfg: LakeConfig
    open_messages: Callable[[SparkSession], DataFrame] | None = None
    open_flows: Callable[[SparkSession], DataFrame] | None = None
    tables: tuple[str, ...] = STANDARD_TABLES
    rules: tuple[Rule, ...] = STANDARD_RULES

    def __post_init__(self):
        self.session = streaming_session(self.spark, self.cfg)
        self.tables = tuple(dict.fromkeys([*self.tables, *(r.table for r in self.rules)]))

    def flows(self) -> DataFrame:
        if self.open_flows:
            return self.open_flows(self.session)
        return parse_flows(self.open_messages(self.session))

    def gold(self, table: str, flows: DataFrame) -> DataFrame:
        cfg = self.cfg
        if table in PANES:
            return panes(flows, PANES[table], cfg.window, cfg.watermark)
        if table == SOURCE_BITS_TABLE:
            return address_bits(flows, "dst_ip", "src_ip", cfg.window, cfg.watermark)
        spec = GOLD_ROLLUPS[table]
        # Only mergeable sketches allow salts where several columns are counted.
        salted = cfg.salts > 1 and cfg.distinct == "approx" and len(spec.distinct) > 1
        return rollup(
            flows,
            spec,
            window=cfg.window,
            watermark=cfg.watermark,
            distinct="sketch" if salted else cfg.distinct,
            salts=cfg.salts,
        )

    def run_available(self, until: str | None = None) -> list[StreamingQuery]:
        """Bring the layers up to date with the input, one after the other.

        Stops after the layer whose stream is called ``until``.
        """
        finished = []
        for starts in self._stages():
            queries = [start(None) for start in starts]
            for query in queries:
                query.awaitTermination()
            finished += queries
            if until in {query.name for query in queries}:
                break
        return finished

    def start(self) -> list[StreamingQuery]:
        """Start all streams for good."""
        return [start(self.cfg.trigger) for starts in self._stages() for start in starts]

    def start_direct(self) -> list[StreamingQuery]:
        """Start every layer straight from the input.

        Less delay, but each stream reads the input by itself and the alert
        stream repeats the work of two gold streams.
        """
        cfg, flows = self.cfg, self.flows
        queries = [self._append(flows(), cfg.bronze, "bronze", cfg.trigger, "ts")]
        if self.open_messages:
            bad = quarantined(self.open_messages(self.session))
            queries.append(self._append(bad, cfg.quarantine, "quarantine", cfg.trigger))
        queries.append(self._silver(flows(), cfg.trigger))
        queries += [self._gold(table, flows(), cfg.trigger) for table in self.tables]
        if self.rules:
            gold = {rule.table: self.gold(rule.table, flows()) for rule in self.rules}
            alerts = detect_all(gold, self.rules)
            queries.append(self._alerts(alerts, cfg.trigger))
        return queries

    def run_forever(self) -> None:
        """Start all streams; return or raise when the first one ends."""
        self.start()
        self.session.streams.awaitAnyTermination()

    def _stages(self):
        """Per layer, in order, the functions that start its streams.

        A stream's sink folder exists once it has started, so the next layer
        can follow it at once.
        """
        cfg = self.cfg

        def received(trigger):
            decoded = decode(self.open_messages(self.session))
            return self._append(decoded, cfg.received, "received", trigger)

        def bronze(trigger):
            if self.open_messages:
                flows = valid_flows(self.follow(cfg.received, RECEIVED, stored_by_date=False))
            else:
                flows = self.flows()
            return self._append(flows, cfg.bronze, "bronze", trigger, "ts")

        def quarantine(trigger):
            decoded = self.follow(cfg.received, RECEIVED, stored_by_date=False)
            bad = decoded.where(F.col("ts").isNull()).select("raw")
            return self._append(bad, cfg.quarantine, "quarantine", trigger)

        def silver(trigger):
            return self._silver(self.follow(cfg.bronze, FLOW), trigger)

        def gold(table):
            def start(trigger):
                return self._gold(table, self.follow(cfg.silver, SILVER), trigger)
            return start

        def alerts(trigger):
            gold = {
                rule.table: self.follow(cfg.gold(rule.table), GOLD[rule.table])
                for rule in self.rules
            }
            return self._alerts(detect_all(gold, self.rules), trigger)

        if self.open_messages:
            yield [received]
        yield [bronze, quarantine] if self.open_messages else [bronze]
        yield [silver]
        yield [gold(table) for table in self.tables]
        if self.rules:
            yield [alerts]

    def follow(self, path: str, schema, stored_by_date: bool = True) -> DataFrame:
        """Stream of a layer's rows, in batches the configuration bounds."""
        stored = dated(schema) if stored_by_date else schema
        rows = follow_layer(self.session, path, stored, self.cfg.max_files)
        return rows.select(*schema.fieldNames())

    def _silver(self, flows: DataFrame, trigger: str | None) -> StreamingQuery:
        silver = with_date(enrich(flows))
        if self.cfg.silver_files_per_date:
            # The salt splits a date that holds most rows. It is a function of
            # the row, so that a repeated task writes the same rows again.
            salt = F.pmod(
                F.xxhash64("ts", "src_ip", "src_port"), F.lit(self.cfg.silver_files_per_date)
            )
            silver = silver.repartition("date", salt)
        return self._append(silver, self.cfg.silver, "silver", trigger, "ts")

    def _gold(self, table: str, flows: DataFrame, trigger: str | None) -> StreamingQuery:
        gold = self.gold(table, flows)
        if self.cfg.gold_files:
            # Only closed windows pass here: little data, but from every state
            # partition, which would each write a small file.
            gold = gold.repartition(self.cfg.gold_files, gold.columns[1])
        return self._append(gold, self.cfg.gold(table), f"gold_{table}", trigger, "window.start")

    def _alerts(self, alerts: DataFrame, trigger: str | None) -> StreamingQuery:
        # Few rows, but found by every task that reads gold: each would write a file per date,
        # and what follows the alerts takes so many files per batch.
        return self._append(alerts, self.cfg.alerts, "gold_alerts", trigger, "window_start",
                            rebalanced=True)

    def _append(self, df, path, sink, trigger, time: str | None = None,
                rebalanced: bool = False) -> StreamingQuery:
        """Start a layer's sink, stored by the date of ``time`` if one is given.

        ``rebalanced`` gathers the rows of a date in a batch in as many files as their size asks.
        """
        df = observed(df, time)
        if time:
            df = df.withColumn("date", F.to_date(time))
        if rebalanced:
            df = df.hint("rebalance", "date")
        return append_files(
            df, path, self.cfg.checkpoint(sink), sink, trigger,
            partition_by="date" if time else None, retention=self.cfg.retention,
        )
