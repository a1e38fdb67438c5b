"""Wire messages to flow rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowlake.functions.timing import WIRE_TIME_FORMAT
from flowlake.model import FLOW


def decode(messages: DataFrame, *keep: str, payload: str = "value") -> DataFrame:
    """One row per message: ``keep``, the text as ``raw``, and the flow columns.

    A field that does not fit its type is NULL; a text that is no JSON object
    yields NULL in every field.
    """
    # A generator rather than a struct column: filters on the decoded fields
    # cannot be rewritten into a second parse of the text.
    text = messages.select(*keep, F.col(payload).cast("string").alias("raw"))
    return text.select(*keep, "raw", F.inline(F.array(F.from_json("raw", FLOW))))


def valid_flows(decoded: DataFrame) -> DataFrame:
    """Records with an event time."""
    return decoded.where(F.col("ts").isNotNull()).drop("raw")


def quarantined(messages: DataFrame, payload: str = "value") -> DataFrame:
    """Texts of the messages without a usable event time.

    Only the time is decoded; the other fields cannot make a record unusable.
    """
    text = messages.select(F.col(payload).cast("string").alias("raw"))
    time = F.inline(F.array(F.from_json("raw", StructType([FLOW["ts"]]))))
    return text.select("raw", time).where(F.col("ts").isNull()).select("raw")


def parse_flows(messages: DataFrame, payload: str = "value") -> DataFrame:
    return valid_flows(decode(messages, payload=payload))


def wire_json(*columns: str | Column) -> Column:
    """JSON text of the given columns, timestamps as RFC 3339 with zone."""
    return F.to_json(F.struct(*columns), {"timestampFormat": WIRE_TIME_FORMAT})


def encode(rows: DataFrame, key: str | None = None) -> DataFrame:
    """``(key, value)`` messages: every column of ``rows`` as one JSON object.

    Zone-less timestamps are taken as UTC.
    """
    columns = [
        F.col(name).cast("timestamp").alias(name) if dtype.startswith("timestamp") else F.col(name)
        for name, dtype in rows.dtypes
    ]
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return rows.select(key_column.alias("key"), wire_json(*columns).alias("value"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts for the message log, keyed by entity so one entity stays in order."""
    return encode(alerts, key="entity")
