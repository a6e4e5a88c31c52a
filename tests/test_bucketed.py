"""Keyed tables in buckets: the same rows as without, and no shuffle of what is stored."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revlens.operators import feed, tables
from revlens.sinks.bucketed import attach, columns_of, latest_bucketed, write_bucketed
from tests.conftest import rows


@pytest.fixture
def stored(spark, tmp_path):
    edits = spark.range(4000).select(
        F.when(F.col("id") % 500 == 0, None).otherwise(F.concat(F.lit("e"), F.col("id") % 1500)).alias("id"),
        F.col("id").cast("string").alias("created_at"),
        F.lit("c").alias("comment"),
    )
    answers = spark.range(0, 4000, 3).select(
        F.concat(F.lit("e"), F.col("id") % 1200).alias("edit_id"), F.col("id").cast("string").alias("generated_at"), F.lit("x").alias("explanation")
    )
    p = write_bucketed(edits, str(tmp_path / "p"), "id", 8)
    e = write_bucketed(answers, str(tmp_path / "e"), "edit_id", 8)
    return edits, answers, p, e


@pytest.fixture(autouse=True)
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key(stored):
    edits, _, p, _ = stored
    order = [F.desc("created_at")]
    found = latest_bucketed(p, "id", order)
    assert "Exchange" not in plan(found)
    assert rows(found) == rows(tables.latest_by_key(edits, ["id"], order))


def test_joins(stored):
    edits, answers, p, e = stored
    left = tables.unexplained_edits(p, e)
    assert "Exchange" not in plan(left)
    assert rows(left) == rows(tables.unexplained_edits(edits, answers)) and left.count() > 0
    newest = tables.latest_explanations(e)
    joined = p.join(newest, p.id == newest.edit_id)
    assert "Exchange" not in plan(joined)
    assert joined.count() == edits.join(tables.latest_explanations(answers), F.col("id") == F.col("edit_id")).count()


def test_lookup_reads_one_bucket(spark, stored):
    _, _, p, _ = stored
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # shows what is pruned either way
    found = feed.edit_by_id(p, "e77")
    assert "SelectedBucketsCount: 1 out of 8" in plan(found)
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert found.first().id == "e77" and feed.edit_by_id(p, "none").count() == 0


def test_appends_keep_the_layout(spark, stored, tmp_path):
    _, answers, _, e = stored
    more = answers.limit(100).withColumn("generated_at", F.lit("99999"))
    both = write_bucketed(more, str(tmp_path / "e"), "edit_id", 8, append=True)
    found = tables.latest_explanations(both)
    assert "Exchange" not in plan(found)
    assert rows(found) == rows(tables.latest_explanations(answers.unionByName(more)))
    again = attach(spark, str(tmp_path / "e"), columns_of(answers), "edit_id", 8)
    assert rows(tables.latest_explanations(again)) == rows(found)
    with pytest.raises(ValueError):
        write_bucketed(more, str(tmp_path / "e"), "edit_id", 8)


def test_without_rows(spark, stored, tmp_path):
    _, _, p, _ = stored
    none = write_bucketed(p.limit(0), str(tmp_path / "none"), "id", 8)
    assert latest_bucketed(none, "id", [F.desc("created_at")]).collect() == []
