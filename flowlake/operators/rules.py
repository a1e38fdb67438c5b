"""Threshold rules over gold rows, stated as data."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.functions.severity import banded


@dataclass(frozen=True)
class Above:
    """The measure lies strictly above the limit."""

    measure: str
    limit: float

    def test(self) -> Column:
        return F.col(self.measure) > F.lit(self.limit)


@dataclass(frozen=True)
class Rule:
    """When a gold row is an alert, and how severe.

    All of ``every`` and, if given, at least one of ``some`` must hold. The
    measure named by ``evidence`` is reported in the alert; ``graded`` (by
    default the same one) decides the severity through ``bands`` of
    ``(above, score)`` with ``floor`` below them all. ``derived`` names measures
    to compute from gold columns first, as SQL expressions.
    """

    alert_type: str
    table: str
    entity: str
    evidence: str
    every: tuple[Above, ...]
    some: tuple[Above, ...] = ()
    bands: tuple[tuple[float, float], ...] = ()
    floor: float = 0.4
    graded: str | None = None
    derived: dict[str, str] = field(default_factory=dict)

    def over(self, gold: DataFrame) -> DataFrame:
        """The gold table with the derived measures."""
        return gold.withColumns({name: F.expr(sql) for name, sql in self.derived.items()})

    def matches(self) -> Column:
        condition = reduce(and_, (limit.test() for limit in self.every))
        if self.some:
            condition = condition & reduce(or_, (limit.test() for limit in self.some))
        return condition


# Thresholds, severity bands and names of the two standard rules.
FAN_IN = Rule(
    alert_type="FAN_IN_DDOS",
    table="top_destinations",
    entity="dst_ip",
    evidence="unique_sources",
    every=(Above("unique_sources", 100),),
    some=(Above("total_packets", 10_000), Above("total_bytes", 10_000_000)),
    bands=((500, 1.0), (200, 0.7)),
)
FAN_OUT = Rule(
    alert_type="FAN_OUT_SCAN",
    table="top_talkers",
    entity="src_ip",
    evidence="unique_destinations",
    every=(Above("unique_destinations", 50), Above("distinct_ports", 20)),
    bands=((200, 1.0), (100, 0.7)),
)
STANDARD_RULES = (FAN_IN, FAN_OUT)

# Share of pure SYN flows above which TCP traffic counts as a SYN flood.
SYN_RATIO = "try_divide(syn_flows, tcp_flows)"
SYN_FLOOD_RATIO = 0.8

# Opt-in. The ratio alone would flag any single SYN, hence the least of 50 flows.
SYN_BURST = Rule(
    alert_type="SYN_BURST",
    table="destination_profile",
    entity="dst_ip",
    evidence="unique_sources",
    every=(Above("syn_ratio", SYN_FLOOD_RATIO), Above("tcp_flows", 49)),
    bands=((0.95, 1.0), (0.9, 0.7)),
    graded="syn_ratio",
    derived={"syn_ratio": SYN_RATIO},
)


def detect(gold: DataFrame, rule: Rule, *keep: str) -> DataFrame:
    """Alerts of one rule over its gold table, batch or stream.

    ``keep`` names gold columns to carry along after the alert columns.
    """
    return rule.over(gold).where(rule.matches()).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.lit(rule.alert_type).alias("alert_type"),
        F.col(rule.entity).alias("entity"),
        banded(rule.graded or rule.evidence, rule.bands, rule.floor).alias("severity_score"),
        F.col(rule.evidence).alias("unique_sources"),
        "total_packets",
        "total_bytes",
        F.current_timestamp().alias("detected_at"),
        *keep,
    )


def keep_matching(left: DataFrame, right: DataFrame, *columns: str,
                  how: str = "left_semi") -> DataFrame:
    """Rows of ``left`` found in ``right`` (or not, as ``left_anti``).

    NULL matches NULL: records without an address form a group like any other.
    """
    wanted = right.select(*(F.col(name).alias(f"_wanted_{name}") for name in columns))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_wanted_{c}")) for c in columns))
    return left.join(wanted, same, how)


def detect_all(gold: dict[str, DataFrame], rules: tuple[Rule, ...] = STANDARD_RULES) -> DataFrame:
    """Alerts of several rules, each over the gold table it names."""
    return reduce(DataFrame.unionByName, (detect(gold[rule.table], rule) for rule in rules))
