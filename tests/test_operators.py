from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlens.operators import confusion, deltas, feed, ranking, splits, stats, tables
from revlens.operators.labeling import apply_weak_labels
from revlens.plans.views import edits, turns
from tests.conftest import rows

# ---- size deltas


def test_ranged_lag_equals_plain_lag(spark):
    """Any bound on hot pages gives the lag of a single window, gaps and NULLs included."""
    rng = random.Random(7)
    data = [
        (i, "hot" if rng.random() < 0.5 else f"p{rng.randrange(9)}",
         None if rng.random() < 0.1 else rng.randrange(1000))
        for i in rng.sample(range(5000), 1500)
    ]
    df = spark.createDataFrame(data, "id bigint, page string, size bigint")
    plain = df.withColumn("prev", F.lag("size").over(W.partitionBy("page").orderBy("id")))
    for hot_rows in (1, 7, 90, 400, 1_000_000):
        ranged = deltas.with_previous(df, "page", "id", "size", "prev", hot_rows)
        assert rows(ranged.select("id", "prev")) == rows(plain.select("id", "prev"))


def test_parent_join_equals_lag(spark, sf_dir):
    revs = turns(spark, sf_dir)
    joined = deltas.with_parent_size(revs, keep_unknown=True)
    order = F.element_at(F.split("rev_id", "-"), 2).cast("int")
    lagged = revs.withColumn("prev", F.lag("text_bytes").over(W.partitionBy("page_id").orderBy(order)))
    assert rows(joined.select("rev_id", "parent_bytes")) == rows(lagged.select("rev_id", "prev"))


def test_parent_join_keeps_every_child_once(spark):
    data = [("1", "", 10), ("2", "1", 15), ("2", "1", 15), ("3", None, 7), ("4", "0", 9), ("5", "99", 4)]
    revs = spark.createDataFrame(data, "rev_id string, parent_rev_id string, text_bytes bigint")
    got = deltas.with_parent_size(revs).select("rev_id", "parent_bytes", "length_delta")
    assert rows(got) == [
        ("1", 0, 10.0), ("2", 10, 5.0), ("2", 10, 5.0), ("3", 0, 7.0), ("4", 0, 9.0), ("5", 0, 4.0),
    ]


# ---- feed


@pytest.fixture(scope="module")
def predictions(spark, sf_dir):
    return edits(spark, sf_dir).persist()


def test_deep_pages_equal_the_sorted_list(spark, predictions):
    wanted = [r.id for r in predictions.orderBy(F.desc("created_at"), F.desc("id")).collect()]
    for page in (1, 2, 7, 60, len(wanted) // 10, len(wanted) // 10 + 1):
        got = [r.id for r in feed.feed_page(predictions, page, 10).collect()]
        assert got == wanted[(page - 1) * 10 : page * 10]


def test_rows_without_a_stamp_come_last_on_any_page(spark):
    stamp = F.when(F.col("n") % 5 < 2, F.format_string("2024-01-01T00:%02d:00", (F.col("n") % 60).cast("int")))
    df = spark.range(500).select(F.col("id").alias("n")).select(
        F.format_string("%04d", "n").alias("id"), stamp.alias("created_at")
    )
    wanted = [r.id for r in df.orderBy(F.desc_nulls_last("created_at"), F.desc("id")).collect()]
    for page in (1, 4, 5, 9, 10, 11):
        assert [r.id for r in feed.feed_page(df, page, 50).collect()] == wanted[(page - 1) * 50 : page * 50]
    plan = feed.feed_page(df, 9, 50)._jdf.queryExecution().toString()
    assert "Offset" not in plan and "offset=" not in plan


def test_seek_walks_over_rows_without_a_stamp(spark):
    df = spark.createDataFrame([("a", "2024"), ("b", None), ("c", None), ("d", None)], "id string, created_at string")
    assert [r.id for r in feed.feed_after(df, "2024", "a", 2).collect()] == ["d", "c"]
    assert [r.id for r in feed.feed_after(df, None, "c", 2).collect()] == ["b"]


def test_deep_page_inside_one_stamp(spark):
    df = spark.range(100).select(
        F.format_string("%03d", "id").alias("id"), F.lit("2024-01-01T00:00:00.000000").alias("created_at")
    )
    assert [r.id for r in feed.feed_page(df, 5, 10).collect()] == [f"{i:03d}" for i in range(59, 49, -1)]


def test_seek_continues_a_page(predictions):
    first = feed.feed_page(predictions, 1, 20).collect()
    second = feed.feed_page(predictions, 2, 20).collect()
    last = first[-1]
    assert feed.feed_after(predictions, last.created_at, last.id, 20).collect() == second


def test_argument_limits(predictions):
    for page, size in ((0, 10), (1, 0), (1, 201)):
        with pytest.raises(ValueError):
            feed.feed_page(predictions, page, size)
    with pytest.raises(ValueError):
        feed.feed_filter(predictions, risk_label="URGENT")
    with pytest.raises(ValueError):
        feed.feed_filter(predictions, search="x" * 121)


def test_filters_combine(predictions):
    got = feed.feed_filter(predictions, risk_label="high", scored_only=True, search="ReVert")
    assert got.count() > 0
    assert all("revert" in r.comment.lower() and r.risk_label == "HIGH" for r in got.collect())


def test_search_is_off_while_a_band_is_chosen():
    assert feed.dashboard_search("All", " typo ") == {"risk_label": None, "search": "typo"}
    assert feed.dashboard_search("HIGH", "typo") == {"risk_label": "HIGH", "search": None}
    assert feed.dashboard_search("All", "  ") == {"risk_label": None, "search": None}


def test_unknown_id_gives_nothing(predictions):
    assert feed.edit_by_id(predictions, "no such id").count() == 0


def test_records_drop_or_fill(predictions):
    total = predictions.count()
    kept, lost = feed.as_records(predictions).count(), feed.rejected_records(predictions).count()
    assert lost > 0 and kept + lost == total
    assert feed.as_records(predictions, fill=True).count() == total


# ---- keyed tables


def test_latest_and_ignore(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"), ("a", 2, "w")]
    df = spark.createDataFrame(data, "k string, t int, v string")
    assert rows(tables.latest_by_key(df, ["k"], [F.desc("t")])) == [("a", 3, "y"), ("b", 2, "z")]
    old = spark.createDataFrame([("b", 9, "kept")], df.schema)
    assert rows(tables.insert_or_ignore(old, df, ["k"], [F.asc("t")])) == [("a", 1, "x"), ("b", 9, "kept")]


def test_not_in_with_a_null_leaves_nothing(spark):
    edits_ = spark.createDataFrame([("a",), ("b",)], "id string")
    some = spark.createDataFrame([("a",), (None,)], "edit_id string")
    assert rows(tables.unexplained_edits(edits_, some)) == [("b",)]
    assert rows(tables.unexplained_edits(edits_, some, not_in=True)) == []
    assert rows(tables.unexplained_edits(edits_, some.na.drop(), not_in=True)) == [("b",)]
    assert tables.unexplained_edits(edits_, some.limit(0), limit=1).count() == 1


def test_explanation_answers(spark, predictions):
    known = [r.id for r in predictions.select("id").limit(3).collect()]
    stored = spark.createDataFrame(
        [(known[0], "old text", "m", "t"), ("gone", "kept text", "m", "t")],
        "edit_id string, explanation string, model string, generated_at string",
    )
    asked = [(known[0], False), (known[1], False), (known[2], True), ("gone", False), ("nobody", False)]
    requests = spark.createDataFrame(asked, "edit_id string, force_refresh boolean")
    got = {r.edit_id: r for r in tables.answer_explanations(requests, predictions, stored).collect()}
    assert got[known[0]].explanation == "old text" and got[known[0]].cached
    assert got[known[1]].explanation.startswith("This edit") and not got[known[1]].cached
    assert got["gone"].explanation == "kept text" and got["gone"].cached
    assert not got["nobody"].found and got["nobody"].explanation is None
    again = requests.withColumn("force_refresh", F.lit(True))
    forced = {r.edit_id: r for r in tables.answer_explanations(again, predictions, stored).collect()}
    assert not forced[known[0]].cached and forced[known[0]].explanation.startswith("This edit")


# ---- statistics


def test_label_columns_may_have_either_name(spark):
    data = [("rv", True, 0.0), ("ok", False, -501.0), (None, False, 0.0)]
    one = spark.createDataFrame(data, "comment string, is_anon boolean, length_delta double")
    two = one.select(
        F.col("comment").alias("comment_clean"),
        F.col("is_anon").cast("int").alias("is_anon_int"),
        "length_delta",
    )
    for df in (one, two):
        assert [r.label for r in apply_weak_labels(df).collect()] == [1, 1, 0]
        assert [r.label for r in apply_weak_labels(df, null_as_zero=False).collect()] == [1, 1, None]


def test_empty_input_gives_zero_rates(spark):
    empty = spark.createDataFrame([], "label int")
    assert tuple(stats.label_stats(empty).first()) == (0, 0, 0, 0.0)
    assert tuple(stats.label_counts(empty).first()) == (0, 0, 0, 0, 0.0)


def test_null_labels(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "label int")
    assert tuple(stats.label_stats(df).first())[:3] == (3, 1, 2)
    assert tuple(stats.label_counts(df).first())[:4] == (2, 1, 1, 1)


def test_row_guard(spark):
    assert stats.require_rows(spark.range(10), 10) == 10
    with pytest.raises(ValueError, match="at least 11"):
        stats.require_rows(spark.range(10), 11)


def test_histogram_counts_every_score(spark, predictions):
    np = pytest.importorskip("numpy")
    scores = [r[0] for r in predictions.select("risk_score").na.drop().collect()]
    wanted, edges = np.histogram(scores, bins=40)
    got = stats.score_histogram(predictions).collect()
    assert [r.n_rows for r in got] == list(wanted)
    assert [r.low_edge for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(0.4,), (0.4,), (None,)], "risk_score double")
    got = stats.score_histogram(df, bins=4).collect()
    assert [r.n_rows for r in got] == [0, 0, 2, 0]


# ---- ranking and confusion


def brute_roc(scored):
    pos = [s for s, label in scored if label == 1]
    neg = [s for s, label in scored if label == 0]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / len(pos) / len(neg)


@pytest.mark.parametrize("distinct", [3, 40, 10_000])
def test_areas(spark, distinct):
    """Exact for any number of ranges, ties and a score shared by a third of all rows."""
    rng = random.Random(distinct)
    data = [
        (0.5 if rng.random() < 0.33 else rng.randrange(distinct) / distinct, int(rng.random() < 0.3))
        for _ in range(600)
    ]
    df = spark.createDataFrame(data, "s double, label int").withColumn("label", F.col("label"))
    wanted = ranking.ranking_metrics(df.coalesce(1), "s", "label").first()
    assert wanted.roc_auc == pytest.approx(brute_roc(data), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", numBins=0)
    spark_pr = evaluator.setMetricName("areaUnderPR").evaluate(df.withColumn("label", F.col("label") * 1.0))
    assert wanted.pr_auc == pytest.approx(spark_pr, abs=1e-9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for ranges in (1, 7, 32):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            got = ranking.ranking_metrics(df, "s", "label").first()
            assert tuple(got) == pytest.approx(tuple(wanted), abs=1e-12)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_without_a_score_are_counted_apart(spark):
    data = [(0.9, 1), (0.4, 0), (0.2, 1), (None, 1), (float("nan"), 0)]
    got = ranking.ranking_metrics(spark.createDataFrame(data, "s double, label int"), "s", "label").first()
    assert (got.positives, got.negatives, got.unscored) == (2, 1, 2)
    assert got.roc_auc == pytest.approx(0.5)


def test_confusion_document(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 0.0), (0, 0.0)], "label int, prediction double")
    doc = confusion.confusion_document(df, "run").first()
    assert (doc.run_id, doc.tp, doc.fp, doc.tn, doc.fn) == ("run", 1, 0, 2, 1)
    assert [tuple(c) for c in doc.confusion_matrix] == [(0, 0, 2), (1, 0, 1), (1, 1, 1)]
    metrics = confusion.weighted_metrics(confusion.confusion_cells(df)).first()
    assert metrics.accuracy == metrics.recall == pytest.approx(0.75)
    assert metrics.precision == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000)
    one = splits.with_fold(splits.with_split(df.repartition(1), "id"), "id")
    many = splits.with_fold(splits.with_split(df.repartition(13), "id"), "id")
    assert rows(one) == rows(many)
    share = one.filter("split = 'train'").count() / 2000
    assert 0.75 < share < 0.85
    assert sum(p.count() for p in splits.random_split(df)) == 2000
