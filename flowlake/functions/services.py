"""Destination port to service name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Well-known ports and the name for every other port.
SERVICE_BY_PORT = {
    80: "HTTP",
    443: "HTTPS",
    22: "SSH",
    53: "DNS",
    21: "FTP",
    25: "SMTP",
    3306: "MySQL",
    5432: "PostgreSQL",
    6379: "Redis",
    8080: "HTTP-ALT",
}
OTHER_SERVICE = "OTHER"

def service_name(port: Column | str) -> Column:
    """Name of a well-known port, ``OTHER`` for the rest and for NULL."""
    port = F.col(port) if isinstance(port, str) else port
    known = F.create_map(*(F.lit(part) for pair in SERVICE_BY_PORT.items() for part in pair))
    return F.coalesce(F.try_element_at(known, port), F.lit(OTHER_SERVICE))


def join_service(flows: DataFrame, services: DataFrame, port: str = "dst_port",
                 output: str = "dst_service") -> DataFrame:
    """Name services from a user's ``(port, service)`` table instead.

    Two names for one port are an error, raised when the flows are read.
    Repeated rows are not, and rows without a port or a name count for nothing.
    """
    problem = F.concat(F.lit("two services for port "), F.col("_port").cast("string"))
    by_port = (
        services.where(F.col("port").isNotNull() & F.col("service").isNotNull())
        .groupBy(F.col("port").cast("int").alias("_port"))
        .agg(F.min("service").alias("_first"), F.max("service").alias("_last"))
        .select("_port", F.when(F.col("_first") == F.col("_last"), F.col("_first"))
                .otherwise(F.raise_error(problem)).alias("_service"))
    )
    return (
        flows.join(by_port, flows[port] == F.col("_port"), "left")
        .withColumn(output, F.coalesce("_service", F.lit(OTHER_SERVICE)))
        .drop("_port", "_service")
    )
