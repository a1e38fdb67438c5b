"""Rolling baselines that tell flash crowds from attacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlake.functions.timing import epoch_seconds
from flowlake.operators.rules import SYN_FLOOD_RATIO, SYN_RATIO, Rule, detect, keep_matching

DEFAULT_LOOKBACK = 7
DEFAULT_FACTOR = 2
DEFAULT_MIN_HISTORY = 3


def with_trailing(gold: DataFrame, entity: str, measure: str, window_seconds: int,
                  lookback: int = DEFAULT_LOOKBACK) -> DataFrame:
    """Add the number and the sum of ``measure`` of the entity's earlier windows.

    Looks back over ``lookback`` window widths of event time, the row's own
    window excluded. A task sorts the gold rows of an entity, one per window,
    however many flows they stand for.
    """
    start = epoch_seconds("window.start")
    trailing = (
        Window.partitionBy(entity).orderBy(start).rangeBetween(-lookback * window_seconds, -1)
    )
    return gold.withColumns({
        "history_windows": F.count(measure).over(trailing),
        "history_sum": F.coalesce(F.sum(measure).over(trailing), F.lit(0).cast("bigint")),
    })


def judge(profile: DataFrame, rule: Rule, window_seconds: int, lookback: int = DEFAULT_LOOKBACK,
          factor: int = DEFAULT_FACTOR, min_history: int = DEFAULT_MIN_HISTORY,
          history: DataFrame | None = None) -> DataFrame:
    """Alerts of ``rule`` with the baseline they were held against and a verdict.

    An alert is ``suppressed`` when the entity has at least ``min_history``
    earlier windows, its evidence is at most ``factor`` times their mean, and
    its TCP traffic is no SYN flood. The last condition keeps a sustained flood
    from becoming its own baseline.

    ``profile`` holds the windows to judge and ``history`` (by default the same
    table) the windows to compare with, those of ``profile`` included. Pass
    stored tables: they are read once for the alerts and once more for the few
    entities that have one, so the sort never covers entities without an alert.
    """
    suspects = rule.over(profile).where(rule.matches()).select("window", rule.entity)
    stored = profile if history is None else history
    trails = with_trailing(
        keep_matching(stored, suspects, rule.entity),
        rule.entity, rule.evidence, window_seconds, lookback,
    )
    if history is not None:
        trails = keep_matching(trails, suspects, "window", rule.entity)
    alerts = detect(
        trails.withColumn("syn_ratio", F.expr(SYN_RATIO)),
        rule, "syn_ratio", "history_windows", "history_sum",
    )
    within_baseline = (
        F.col("unique_sources") * F.col("history_windows") <= F.lit(factor) * F.col("history_sum")
    )
    no_flood = F.coalesce(F.col("syn_ratio") <= SYN_FLOOD_RATIO, F.lit(True))
    return alerts.withColumn(
        "suppressed",
        (F.col("history_windows") >= min_history) & within_baseline & no_flood,
    )


def suppress(judged: DataFrame) -> DataFrame:
    """The alerts that remain, in the standard alert columns."""
    return judged.where(~F.col("suppressed")).drop(
        "suppressed", "syn_ratio", "history_windows", "history_sum"
    )
