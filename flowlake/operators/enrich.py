"""Flow enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.functions.address import is_private, subnet_24
from flowlake.functions.services import join_service, service_name


def enrich(flows: DataFrame, services: DataFrame | None = None) -> DataFrame:
    """Add subnets, private-address flags and the destination service.

    ``services`` optionally replaces the built-in port list by a
    ``(port, service)`` table.
    """
    derived = {
        "src_subnet_24": subnet_24("src_ip"),
        "dst_subnet_24": subnet_24("dst_ip"),
        "is_private_src": is_private("src_ip"),
        "is_private_dst": is_private("dst_ip"),
    }
    if services is not None:
        return join_service(flows.withColumns(derived), services)
    return flows.withColumns({**derived, "dst_service": service_name("dst_port")})


def with_date(flows: DataFrame) -> DataFrame:
    """Add the partition column of the enriched layer."""
    return flows.withColumn("date", F.to_date("ts"))
