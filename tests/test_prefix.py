"""First rows and estimates from some splits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revlens.operators.prefix import first_rows
from revlens.sources.sampling import estimate_tags, split_bytes
from revlens.sources.xml import count_revisions


@pytest.mark.parametrize("n", [0, 1, 24, 25, 26, 99, 100, 1000])
def test_first_rows(spark, n):
    df = spark.range(0, 100, 1, 4).withColumn("_x", F.lit(1))
    got = first_rows(df, n)
    assert got.columns == ["id", "_x"]
    assert sorted(r.id for r in got.collect()) == list(range(min(n, 100)))


def test_first_rows_stay_in_their_tasks(spark):
    """No stage takes all rows in one task: what moves is a number per task."""
    got = first_rows(spark.range(0, 100_000, 1, 8), 60_000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan
    spread = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sorted(r["count"] for r in spread) == [10_000, 12_500, 12_500, 12_500, 12_500]
    assert first_rows(spark.range(0), 5).count() == 0
    with pytest.raises(ValueError):
        first_rows(spark.range(3), -1)


@pytest.fixture
def dump(spark, tmp_path):
    path = str(tmp_path / "dump")
    line = F.when(F.col("id") % 10 == F.crc32(F.col("id").cast("string").cast("binary")) % 3, "<revision>").otherwise("<text>words and more words</text>")
    spark.range(0, 200_000, 1, 4).select(line.alias("value")).write.text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield path
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def exact(spark, path):
    return count_revisions(spark, path).agg(F.sum("revisions")).first()[0]


def test_some_splits_estimate_all(spark, dump):
    n = len(split_bytes(spark.read.text(dump)))
    assert n >= 20
    wanted, covered = exact(spark, dump), 0
    for seed in range(10):
        row = estimate_tags(spark, dump, n // 4, seed=seed).first()
        assert row.sampled_splits == n // 4 and row.all_splits == n
        assert abs(row.sampled_bytes / row.all_bytes - 0.25) < 0.06
        covered += abs(row.estimate - wanted) <= 3 * row.standard_error
    assert covered >= 9


def test_all_splits_are_exact(spark, dump):
    row = estimate_tags(spark, dump, 10_000).first()
    assert (row.estimate, row.standard_error, row.sampled_bytes) == (exact(spark, dump), 0.0, row.all_bytes)


def test_one_split_has_no_known_error(spark, dump):
    row = estimate_tags(spark, dump, 1).first()
    assert row.estimate > 0 and row.standard_error is None
    with pytest.raises(ValueError):
        estimate_tags(spark, dump, 0)
