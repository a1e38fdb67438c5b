"""Column functions over dotted-quad address strings."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# A whole dotted quad, capturing its first three octets.
SUBNET_24_PATTERN = r"^([0-9]+[.][0-9]+[.][0-9]+)[.][0-9]+$"

# An IPv4 address in its usual spelling, four numbers to 255 without extra zeros.
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^{_OCTET}[.]{_OCTET}[.]{_OCTET}[.]{_OCTET}$"

# RFC 1918 ranges as text prefixes (10/8, 192.168/16, 172.16/12).
PRIVATE_PREFIXES = ("10.", "192.168.", *(f"172.{octet}." for octet in range(16, 32)))


def subnet_24(ip: Column | str) -> Column:
    """First three octets; ``''`` for anything but four numbers, NULL for NULL."""
    return F.regexp_extract(ip, SUBNET_24_PATTERN, 1)


def is_private(ip: Column | str) -> Column:
    """Whether the text starts like a private address; NULL for NULL.

    Prefix tests rather than a pattern, so that a filter on it reaches the
    Parquet scan.
    """
    ip = F.col(ip) if isinstance(ip, str) else ip
    return reduce(or_, (ip.startswith(prefix) for prefix in PRIVATE_PREFIXES))


def ip_number(ip: Column | str) -> Column:
    """An IPv4 address as a number; NULL for any other text, so equal numbers are equal texts."""
    ip = F.col(ip) if isinstance(ip, str) else ip
    octets = F.split(ip, "[.]")
    number = reduce(lambda high, at: high * 256 + F.try_element_at(octets, F.lit(at)).try_cast("long"),
                    range(1, 5), F.lit(0).cast("long"))
    return F.when(ip.rlike(IPV4_PATTERN), number)
