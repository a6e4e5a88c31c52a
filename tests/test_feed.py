"""Pages by counts and searches by trigrams, against sorting and scanning."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import feed, search
from revlens.schemas import PREDICTION
from tests.conftest import rows


def prediction(i, created, **changes):
    row = {
        "id": i, "rev_id": f"r{i}", "page_title": "Page", "namespace": 0, "user": "Ann", "is_anon": 0, "comment": "", "length_delta": 0.0,
        "timestamp": "", "wiki": "enwiki", "risk_score": None, "risk_label": None, "scored": 0, "created_at": created,
    }
    return tuple((row | changes).values())


def odd_feed(seed):
    """Stamps of all lengths of tie: hours, seconds, one stamp for a third of all rows, none at all."""
    rng = random.Random(seed)
    out = []
    for n in range(3000):
        kind = rng.random()
        if kind < 0.33:
            stamp = "2024-03-05T10:00:00.000000"
        elif kind < 0.5:
            stamp = None
        elif kind < 0.7:
            stamp = f"2024-03-05T10:00:{rng.randint(0, 59):02d}.{rng.randint(0, 3):06d}"
        else:
            stamp = f"2024-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}T{rng.randint(10, 23)}:00:00.000000"
        i = rng.choice([f"{n}", f"{rng.randint(0, 40)}", None if n % 50 == 0 else f"x{n}", ""])
        label = rng.choice(["HIGH", "LOW", None])
        out.append(prediction(i, stamp, risk_label=label, scored=int(label is not None), wiki=rng.choice(["enwiki", "dewiki"])))
    return out


def sorted_keys(data):
    def key(r):
        return tuple((x is None, [-ord(c) for c in x or ""] + [1]) for x in (r[-1], r[0]))

    return [(r[-1], r[0]) for r in sorted(data, key=key)]


@pytest.mark.parametrize("bucket", [5000, 30, 1])
def test_pages_are_those_of_a_sort(spark, monkeypatch, bucket):
    monkeypatch.setattr(feed, "BUCKET_ROWS", bucket)
    data = odd_feed(bucket)
    df = spark.createDataFrame(data, PREDICTION).repartition(3).cache()
    counts = feed.feed_directory(df).cache()
    wanted = sorted_keys(data)
    for page, size in [(1, 50), (2, 7), (8, 60), (25, 40), (15, 200), (16, 200), (40, 100)]:
        for directory in (None, counts):
            got = feed.feed_page(df, page, size, directory).collect()
            assert [(r.created_at, r.id) for r in got] == wanted[(page - 1) * size : page * size]


def test_filtered_pages_use_the_filtered_directory(spark):
    data = odd_feed(9)
    df = spark.createDataFrame(data, PREDICTION)
    counts = feed.feed_filter(feed.feed_directory(df), risk_label="high")
    got = feed.feed_page(feed.feed_filter(df, risk_label="high"), 3, 50, counts).collect()
    wanted = sorted_keys([r for r in data if r[9] == "enwiki" and r[11] == "HIGH"])
    assert [(r.created_at, r.id) for r in got] == wanted[100:150]


def test_a_page_is_cut_from_a_small_bucket(spark, monkeypatch):
    """Under one percent of the rows are put in order, and the scan can skip all newer files."""
    monkeypatch.setattr(feed, "BUCKET_ROWS", 150)
    data = [prediction(f"{n:06d}", f"2024-01-{1 + n // 1000:02d}T{n % 1000 // 50 + 4:02d}:00:00.{n % 50:06d}") for n in range(20_000)]
    df = spark.createDataFrame(data, PREDICTION)
    rest, before, size = feed.page_start(df, 12_345)
    assert size < 200 and before <= 12_345 < before + size
    plan = df.filter(rest)._jdf.queryExecution().optimizedPlan().toString()
    assert "created_at" in plan


def test_no_rows_no_page(spark):
    none = spark.createDataFrame([], PREDICTION)
    assert feed.feed_page(none).collect() == []
    assert feed.feed_page(none, 3, 10, feed.feed_directory(none)).collect() == []


# ---- search ---------------------------------------------------------------------------------

WORDS = ["Revert", "vandalism", "Ünder", "100%_sure", "a", "", "ab", "The Quick", "fox_jumps", "10.0.0.1", "straße", "İstanbul", "😀 ok"]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(5)

    def text():
        return None if rng.random() < 0.1 else " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))

    data = [
        prediction(rng.choice([f"{n}", f"{n % 30}", None]), f"2024-01-01T00:{n % 60:02d}", comment=text(), page_title=text(), user=text(), rev_id=str(n),
                   wiki=rng.choice(["enwiki", "enwiki", "dewiki"]), scored=n % 2)
        for n in range(1500)
    ]
    data += data[:20]  # repeated rows
    df = spark.createDataFrame(data, PREDICTION).cache()
    path = str(tmp_path_factory.mktemp("index") / "i")
    search.build_index(df, path, 200)
    return df, path


@pytest.mark.parametrize("wildcards", [False, True])
def test_same_as_the_scan(spark, indexed, wildcards):
    df, path = indexed
    rng = random.Random(wildcards)
    texts = ["revert", "VANDALISM", " ünder ", "%", "_", "100%_s", "ox_ju", "a", "ab", "k rev", "10.0", "149", "STRASSE", "straße", "istan", "😀 o", "nowhere at all", "e  r"]
    texts += [w[a : a + rng.randint(1, 6)] or "x" for w in (" ".join(rng.sample(WORDS, 3)) for _ in range(12)) for a in [rng.randint(0, 5)]]
    for text in texts:
        wanted = feed.feed_filter(df, search=text, wildcards=wildcards)
        got = search.search_index(spark, path, df.schema, text, wildcards=wildcards)
        assert rows(got) == rows(wanted), text


def test_other_filters(spark, indexed):
    df, path = indexed
    got = search.search_index(spark, path, df.schema, "fox", wiki="dewiki", scored_only=True)
    assert rows(got) == rows(feed.feed_filter(df, "dewiki", scored_only=True, search="fox")) and got.count() > 0


def test_only_postings_of_the_text_and_its_blocks_are_read(spark, indexed):
    df, path = indexed
    found = search.candidates(spark, path, "vandalism")
    plan = found._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "In(gram" in read
    whole = search.search_index(spark, path, df.schema, "vandalism")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in whole.lower()


def test_postings_stay_where_they_are_made(spark, tmp_path):
    """A block's postings lie in one file, in order of trigram; searches may share the listed blocks."""
    df = spark.createDataFrame([prediction(f"{n}", f"2024-01-01T00:{n % 60:02d}", comment=f"word {n * 7919 % 500}") for n in range(400)], PREDICTION)
    path = str(tmp_path / "i")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "20000"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        search.build_index(df, path, 100)
    finally:
        for key in settings:
            spark.conf.unset(key)
    postings = spark.read.parquet(f"{path}/postings").withColumn("file", F.input_file_name())
    files = postings.groupBy("block").agg(F.count_distinct("file").alias("n")).collect()
    assert len(files) > 2 and {f["n"] for f in files} == {1} and postings.select("file").distinct().count() > 1
    for (file,) in postings.select("file").distinct().collect():
        held = [r["gram"] for r in spark.read.parquet(file).coalesce(1).collect()]
        assert held == sorted(held)
    stored = search.read_rows(spark, path, df.schema)
    got = search.search_index(spark, path, df.schema, "word 42", rows=stored)
    assert rows(got) == rows(feed.feed_filter(df, search="word 42")) and got.count() > 0


def test_a_row_may_be_searched_by_a_number(spark, indexed):
    df, path = indexed
    got = search.search_index(spark, path, df.schema, "1499", wiki="enwiki")
    assert rows(got.select("rev_id")) == rows(df.filter("rev_id like '%1499%' and wiki = 'enwiki'").select("rev_id"))


def test_grams():
    assert search.grams("Abab") == ["aba", "bab"] and search.grams("ab") == []
    assert search.literal_parts("page _5%x", True) == ["page ", "5", "x"]
    assert F is not None
