"""Folding of batches: what is rewritten, what readers see meanwhile, totals without the rows."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from revlens.operators import feed, stats
from revlens.operators.features import article_edits, event_features
from revlens.schemas import PREDICTION
from revlens.sinks import generations as g
from revlens.sinks.tables import append_batch, archive
from revlens.sources.events import read_events
from revlens.streaming.scorer import read_archive, read_predictions
from tests.conftest import rows
from tests.test_streaming import event

KIND = g.predictions_kind()


def batch(spark, numbers, created, score=None, scored=1):
    data = [
        (f"e{n}", f"{n}", f"Page {n % 3}", 0, "Ann", 0, "c", 1.0, f"2024-01-{1 + n % 5:02d}T10:00:00Z" if n % 7 else "", "enwiki" if n % 2 else "dewiki",
         (score if score is not None else n / 100) if scored else None, ("HIGH" if n % 2 else "LOW") if scored else None, scored, f"2024-02-{created:02d}T00:00:00.{n:06d}")
        for n in numbers
    ]
    return spark.createDataFrame(data, PREDICTION)


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "live"), str(tmp_path / "root")


def current(spark, paths):
    return rows(g.read_current(spark, KIND, paths[1], paths[0]))


def written(tmp_path):
    return sorted(str(p) for p in (tmp_path / "root").rglob("part-*"))


def test_current_rows_are_the_newest_per_edit(spark, paths, tmp_path):
    live, root = paths
    rng = random.Random(3)
    everything = []
    for number in range(6):
        part = batch(spark, rng.sample(range(40), 15), number + 1, score=number / 10)
        append_batch(part, live, "a" if number % 2 else "b", number)
        everything.append(part)
        union = everything[0]
        for other in everything[1:]:
            union = union.unionByName(other)
        newest = union.groupBy("id").agg(F.max_by(F.struct(*PREDICTION.fieldNames()), "created_at").alias("r")).select("r.*")
        g.fold(spark, KIND, live, root)
        assert current(spark, paths) == rows(newest)
    assert len(g.committed(spark, root)) == 2  # the newest and the one before


def test_only_touched_days_are_rewritten(spark, paths, tmp_path):
    live, root = paths
    append_batch(batch(spark, [n for n in range(1, 35) if n % 7], 1), live, "s", 0)
    append_batch(batch(spark, [1, 6], 2), live, "s", 1)
    first = g.fold(spark, KIND, live, root)
    assert sorted(first.days) == [f"2024-01-0{d}" for d in range(1, 6)]
    append_batch(batch(spark, [100], 3), live, "s", 2)
    second = g.fold(spark, KIND, live, root)
    changed = {d for d in second.days if second.days[d] != first.days.get(d)}
    assert changed == {"2024-01-02"}  # 1 and 6 are edits of that day


def test_a_fold_without_new_batches_writes_nothing(spark, paths, tmp_path):
    live, root = paths
    assert g.fold(spark, KIND, live, root) is None
    append_batch(batch(spark, range(20), 1), live, "s", 0)
    assert g.fold(spark, KIND, live, root) is None  # the stream's newest batch may be written again
    append_batch(batch(spark, range(20, 30), 2), live, "s", 1)
    first = g.fold(spark, KIND, live, root)
    before = written(tmp_path)
    assert g.fold(spark, KIND, live, root) == first and written(tmp_path) == before


def test_a_read_begun_before_a_fold_ends_right(spark, paths):
    live, root = paths
    for number in range(3):
        append_batch(batch(spark, range(number * 10, number * 10 + 12), number + 1), live, "s", number)
    g.fold(spark, KIND, live, root)
    wanted = current(spark, paths)
    begun = g.read_current(spark, KIND, root, live)  # planned over this generation's folders
    append_batch(batch(spark, range(0, 50, 3), 9, score=0.9), live, "s", 3)
    g.fold(spark, KIND, live, root)
    assert rows(begun) == wanted
    assert current(spark, paths) != wanted


def test_a_fold_that_did_not_end_is_not_read(spark, paths, monkeypatch):
    live, root = paths
    for number in range(2):
        append_batch(batch(spark, range(number * 10, number * 10 + 12), number + 1), live, "s", number)
    wanted = rows(read_predictions(spark, live))
    with monkeypatch.context() as broken:
        broken.setattr(g, "commit_mark", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            g.fold(spark, KIND, live, root)
    assert g.read_manifest(spark, root) is None and current(spark, paths) == wanted
    assert g.fold(spark, KIND, live, root).number == 1 and current(spark, paths) == wanted


def test_an_edit_that_changes_its_day_is_one_row(spark, paths):
    """Without a time of its own an edit's day is that of its row."""
    live, root = paths
    for number in range(3):
        append_batch(batch(spark, [7, 14], number + 1), live, "s", number)
        g.fold(spark, KIND, live, root)
    assert [r[0] for r in current(spark, paths)] == ["e14", "e7"]
    assert g.fold(spark, KIND, live, root).days.keys() == {"2024-02-02"}


def test_pending_rows_give_way(spark, paths):
    live, root = paths
    append_batch(batch(spark, [1, 2], 1, scored=0), live, "feed", 0)
    append_batch(batch(spark, [1], 1, score=0.3), live, "scorer", 0)
    append_batch(batch(spark, [3], 1), live, "feed", 1)
    append_batch(batch(spark, [4], 1), live, "scorer", 1)
    g.fold(spark, KIND, live, root)
    assert {r[0]: r[12] for r in current(spark, paths)} == {"e1": 1, "e2": 0, "e3": 1, "e4": 1}


def test_generation_rows_are_not_shuffled(spark, paths):
    live, root = paths
    for number in range(2):
        append_batch(batch(spark, range(number * 10, number * 10 + 12), number + 1), live, "s", number)
    g.fold(spark, KIND, live, root)
    plan = g.read_current(spark, KIND, root, live)._jdf.queryExecution().executedPlan().toString()
    alone = plan[: plan.index("Window")]
    assert "LeftAnti" in alone and "BroadcastHashJoin" in alone and "hashpartitioning" not in alone.split("LeftAnti")[1].split("FileScan")[0]


def test_totals_equal_a_scan(spark, paths):
    live, root = paths
    rng = random.Random(8)
    for number in range(5):
        append_batch(batch(spark, rng.sample(range(60), 25), number + 1, scored=int(number % 3 > 0)), live, "s", number)
        if number in (1, 3):
            g.fold(spark, KIND, live, root)
        scan = g.read_current(spark, KIND, root, live)
        totals = g.current_totals(spark, root, live)
        assert rows(g.feed_stats(totals)) == rows(stats.feed_stats(scan))
        assert rows(g.band_summary(totals)) == rows(stats.band_summary(scan))
        assert rows(g.scoring_progress(totals)) == rows(stats.scoring_progress(scan))
        counts = totals.groupBy("risk_label").agg(F.sum("n_rows"))
        assert rows(counts) == rows(scan.groupBy("risk_label").count())


def test_stored_directory_finds_pages(spark, paths):
    live, root = paths
    for number in range(3):
        append_batch(batch(spark, range(number * 30, number * 30 + 40), number + 1), live, "s", number)
    g.fold(spark, KIND, live, root)
    held = g._folded_rows(spark, KIND, g.read_manifest(spark, root)).select(*PREDICTION.fieldNames())
    counts = feed.feed_filter(g.stored_directory(spark, root), scored_only=True)
    matching = feed.feed_filter(held, scored_only=True)
    got = feed.feed_page(matching, 2, 10, counts).collect()
    wanted = matching.orderBy(F.desc("created_at"), F.desc("id")).limit(20).collect()[10:]
    assert got == wanted


def test_archive_is_folded(spark, tmp_path):
    live, root = str(tmp_path / "archive"), str(tmp_path / "root")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.jsonl").write_text("\n".join(json.dumps(event(i)) for i in range(30)))
    features = event_features(article_edits(read_events(spark, str(tmp_path / "in"))))
    for number in range(4):
        archive(features.filter(F.col("id") % 4 <= number), live, F.col("event_time"), "s", number)
    kind = g.archive_kind(features.schema)
    wanted = rows(read_archive(spark, live).select("id", "event_time"))
    for _ in range(2):
        g.fold(spark, kind, live, root)
        assert rows(g.read_current(spark, kind, root, live).select("id", "event_time")) == wanted
    archive(features.filter("id = 3"), live, F.col("event_time"), "s", 4)
    g.fold(spark, kind, live, root)
    assert rows(g.read_current(spark, kind, root, live).select("id", "event_time")) == wanted
    left = {p.name for p in (tmp_path / "archive").rglob("batch_id=*") if any(p.iterdir())}
    assert left == {"batch_id=3", "batch_id=4"}
