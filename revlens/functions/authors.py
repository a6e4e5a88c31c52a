"""Anonymous-author tests. The input data knows four variants; ``is_anon`` is the one used by jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
IPV4 = r"^(\d{1,3}\.){3}\d{1,3}$"
IPV6 = r"^[0-9a-fA-F:]+:[0-9a-fA-F:]+$"
IPV6_PREFIX = r"^[0-9a-fA-F:]+:"


def is_anon(user: Column, empty_is_anon: bool = True) -> Column:
    """IPv4 or IPv6 address as user name; a missing name counts as anonymous unless told otherwise."""
    named = F.trim(user).rlike(f"{IPV4}|{IPV6}")
    return F.when(F.coalesce(user == "", F.lit(True)), F.lit(empty_is_anon)).otherwise(named)


def is_anon_ipv4(user: Column) -> Column:
    """Live-stream variant: IPv4 only, missing name is not anonymous."""
    return F.coalesce(user.rlike(IPV4), F.lit(False))


def is_anon_prefix(user: Column) -> Column:
    """Collector variant: IPv4, or any name that starts like an IPv6 address."""
    return F.coalesce(user.rlike(f"{IPV4}|{IPV6_PREFIX}"), F.lit(False))


def is_anon_record(user: Column) -> Column:
    """Record-preparation variant: untrimmed name, missing name is not anonymous."""
    return F.coalesce(user.rlike(f"{IPV4}|{IPV6}"), F.lit(False))
