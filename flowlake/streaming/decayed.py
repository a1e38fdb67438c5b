"""Baselines kept as state: decayed sums per entity, updated with every window.

The suppression of ``streaming.suppression`` reads the gold of its lookback again for every
batch. Here the past of an entity is two numbers in the state store: the sum of its evidence and
the number of its windows, both multiplied by ``decay`` for each window width that goes by. A
window is held against what was there before it, then added.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from flowlake.config import LakeConfig
from flowlake.functions.timing import WIRE_TIME_FORMAT, epoch_seconds
from flowlake.model import DECAYED, GOLD, dated
from flowlake.operators.rules import SYN_FLOOD_RATIO, SYN_RATIO, Rule, detect
from flowlake.sources.streams import follow_layer
from flowlake.streaming.sinks import append_files

DEFAULT_DECAY = 0.5
DEFAULT_LEAST_WEIGHT = 0.8
DEFAULT_FACTOR = 2
#: Window widths of silence after which an entity's past is forgotten.
FORGOTTEN = 40


def with_decayed_past(profile: DataFrame, rule: Rule, window_seconds: int,
                      decay: float = DEFAULT_DECAY) -> DataFrame:
    """A stream of gold rows with ``history_sum`` and ``history_weight`` of the windows before.

    Both are as of the row's own window. Windows of an entity come in order from one gold stream;
    one that comes out of order is judged against the past known by then. A task holds the new
    windows of one entity and batch: gold rows, never flows. The state of an entity that has been
    silent for ``FORGOTTEN`` windows goes; rows that are later than that are dropped.
    """
    horizon = FORGOTTEN * window_seconds
    # Rows pass through as text, so that no type changes on the way.
    options = {"timestampFormat": WIRE_TIME_FORMAT}
    packed = profile.withColumn("at", F.col("window.start")).withWatermark(
        "at", f"{horizon} seconds").select(
        F.coalesce(F.col(rule.entity), F.lit("")).alias("key"),
        F.col(rule.entity).isNull().alias("no_entity"), "at",
        F.floor(epoch_seconds("at") / window_seconds).alias("turn"),
        F.col(rule.evidence).alias("evidence"),
        F.to_json(F.struct(*GOLD[rule.table].fieldNames()), options).alias("row"))

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState,
               ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, total, weight = state.get if state.exists else (None, 0.0, 0.0)
        rows = pd.concat(list(batches)).sort_values("turn", kind="stable")
        sums, weights = [], []
        for turn, evidence in zip(rows["turn"].tolist(), rows["evidence"].tolist(), strict=True):
            if last is not None and turn > last:
                faded = decay ** (turn - last)
                total, weight = total * faded, weight * faded
            last = turn if last is None else max(last, turn)
            sums.append(total)
            weights.append(weight)
            total, weight = total + evidence, weight + 1
        state.update((last, total, weight))
        state.setTimeoutTimestamp(max((last + FORGOTTEN) * window_seconds * 1000,
                                      state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"row": rows["row"].to_numpy(), "history_sum": sums,
                            "history_weight": weights})

    judged = packed.groupBy("key", "no_entity").applyInPandasWithState(
        update, "row string, history_sum double, history_weight double",
        "last long, total double, weight double", "append", GroupStateTimeout.EventTimeTimeout)
    return judged.select(
        F.from_json("row", GOLD[rule.table], options).alias("row"), "history_sum",
        "history_weight").select("row.*", "history_sum", "history_weight")


def judge_decayed(past: DataFrame, rule: Rule, factor: float = DEFAULT_FACTOR,
                  least_weight: float = DEFAULT_LEAST_WEIGHT) -> DataFrame:
    """Alerts of ``rule`` with their past and a verdict, batch or stream.

    Suppressed are alerts of entities with a past of ``least_weight`` whose evidence is at most
    ``factor`` times the decayed mean, and whose TCP traffic is no SYN flood.
    """
    alerts = detect(past.withColumn("syn_ratio", F.expr(SYN_RATIO)), rule,
                    "syn_ratio", "history_sum", "history_weight")
    usual = F.col("unique_sources") * F.col("history_weight") <= F.lit(factor) * F.col("history_sum")
    no_flood = F.coalesce(F.col("syn_ratio") <= SYN_FLOOD_RATIO, F.lit(True))
    return alerts.withColumn(
        "suppressed", (F.col("history_weight") >= least_weight) & usual & no_flood)


def start_decayed(session, cfg: LakeConfig, rule: Rule, window_seconds: int,
                  trigger: str | None = None, decay: float = DEFAULT_DECAY,
                  **options) -> StreamingQuery:
    """Follow the stored destination profile and store every alert with its verdict."""
    schema = GOLD[rule.table]
    profile = follow_layer(session, cfg.gold(rule.table), dated(schema), cfg.max_files).drop("date")
    judged = judge_decayed(with_decayed_past(profile, rule, window_seconds, decay), rule, **options)
    return append_files(
        judged.select(*DECAYED.fieldNames()).withColumn("date", F.to_date("window_start")),
        cfg.judged, cfg.checkpoint("judged_alerts"), "judged_alerts", trigger, partition_by="date")
