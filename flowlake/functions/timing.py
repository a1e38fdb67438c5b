"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

# RFC 3339 with microseconds and zone, as the wire carries it.
WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a zoned or zone-less (UTC) timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.cast("timestamp").cast("bigint")


def flatten_window(gold: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` and ``window_end``."""
    rest = [name for name in gold.columns if name != "window"]
    return gold.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *rest,
    )


def zoneless(df: DataFrame) -> DataFrame:
    """Zoned timestamps as zone-less ones in the session's zone (UTC here)."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
