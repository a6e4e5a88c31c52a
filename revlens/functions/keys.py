"""Deterministic keys and hash buckets: the same row gets the same value on every run and layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edit_key(wiki: Column, rev_id: Column) -> Column:
    """Surrogate id of an edit; a replayed edit maps to the same id."""
    return F.sha2(F.concat_ws(":", wiki, rev_id), 256)


def hash32(key: Column, salt: str = "") -> Column:
    """Uniform integer in [0, 2**32)."""
    text = key.cast("string")
    salted = F.concat(F.lit(f"{salt}:"), text) if salt else text
    return F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column, buckets: int, salt: str = "") -> Column:
    return (hash32(key, salt) % buckets).cast("int")
