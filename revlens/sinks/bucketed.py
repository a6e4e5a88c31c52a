"""Tables dealt out and sorted by a key when they are written, so that reads by that key need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.operators.tables import latest_by_key
from revlens.session import mark_exists


def attach(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> DataFrame:
    """The table at ``path`` with what is known of its layout; the folder may be empty.

    ``columns`` is its schema as text. Nothing is copied: only a temporary name is registered, which
    ends with the session.
    """
    return spark.table(_register(spark, path, columns, key, buckets))


def _register(spark: SparkSession, path: str, columns: str, key: str, buckets: int) -> str:
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    return name


def columns_of(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int, append: bool = False) -> DataFrame:
    """Writes rows into buckets of the key, one file per bucket and write, and returns the table.

    A bucket's rows share a hash of the key. All rows of one key lie in one bucket, so the key should
    be one of many values, such as an id; rows with a NULL key share a bucket. ``append`` adds rows to
    a table of the same key and number of buckets; without it the folder must not exist.
    """
    spark = rows.sparkSession
    if not append and mark_exists(spark, path):
        raise ValueError(f"{path} exists already")
    name = _register(spark, path, columns_of(rows), key, buckets)
    dealt = rows.repartition(buckets, F.col(key)).sortWithinPartitions(key)
    dealt.write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def latest_bucketed(table: DataFrame, key: str, newest_first: list) -> DataFrame:
    """The newest row per key of a bucketed table: each bucket is sorted by itself, no row is moved."""
    return latest_by_key(table, [key], newest_first)
