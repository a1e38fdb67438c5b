"""Rules straight over stored flows, counting different values only where it matters.

Exact distinct counts shuffle every (key, value) pair, while most keys are far
too quiet to trip a rule. A cheap first pass leaves only those that could.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.operators.rollup import GOLD_ROLLUPS, rollup
from flowlake.operators.rules import Above, Rule, detect, keep_matching

def candidates(flows: DataFrame, rule: Rule, window: str) -> DataFrame:
    """The (window, key) pairs whose sums and counts allow ``rule`` to hold.

    A group has at least as many flows as different values, so a limit on a
    distinct count is a limit on the flow count too.
    """
    spec = GOLD_ROLLUPS[rule.table]

    def implied(limit: Above) -> Above:
        return replace(limit, measure="flow_count") if limit.measure in spec.distinct else limit

    needed = replace(
        rule, every=tuple(map(implied, rule.every)), some=tuple(map(implied, rule.some))
    )
    totals = rollup(flows, replace(spec, distinct={}), window)
    return rule.over(totals).where(needed.matches()).select("window", spec.key)


def detect_in_flows(flows: DataFrame, rule: Rule, window: str) -> DataFrame:
    """Alerts of one rule over a batch of flows, with exact counts.

    The candidates are a part of the plan: a semi join picks their flows, and
    adaptive execution broadcasts them or not by the size they turn out to have.
    """
    spec = GOLD_ROLLUPS[rule.table]
    timed = flows.withColumn("window", F.window("ts", window))
    loud = keep_matching(timed, candidates(flows, rule, window), "window", spec.key)
    return detect(rollup(loud.drop("window"), spec, window, distinct="exact"), rule)


def detect_all_in_flows(flows: DataFrame, rules: tuple[Rule, ...], window: str) -> DataFrame:
    return reduce(
        DataFrame.unionByName, (detect_in_flows(flows, rule, window) for rule in rules)
    )
