"""Severity scores and their display labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lowest score that still earns the label, and the default label.
LABELS = ((0.8, "CRITICAL"), (0.6, "HIGH"))
DEFAULT_LABEL = "MEDIUM"


def banded(measure: Column | str, bands: Sequence[tuple[float, float]], floor: float) -> Column:
    """Score of the highest band the measure lies strictly above, else ``floor``.

    ``bands`` holds ``(above, score)`` pairs in any order.
    """
    measure = F.col(measure) if isinstance(measure, str) else measure
    reached = [
        F.when(measure > above, F.lit(float(score)))
        for above, score in sorted(bands, reverse=True)
    ]
    return F.coalesce(*reached, F.lit(float(floor)))


def severity_label(score: Column | str = "severity_score") -> Column:
    score = F.col(score) if isinstance(score, str) else score
    reached = [F.when(score >= least, F.lit(label)) for least, label in LABELS]
    return F.coalesce(*reached, F.lit(DEFAULT_LABEL))
