from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from revlens.functions.risk import risk_band
from revlens.operators.features import article_edits, event_features
from revlens.plans import io_queries
from revlens.plans.jobs import run_compaction
from revlens.schemas import PREDICTION, PREDICTION_COLUMNS
from revlens.sinks.tables import append_batch, compact_latest
from revlens.sources.events import read_events
from revlens.streaming.dedup import read_late, start_deduped
from revlens.streaming.landing import land_events
from revlens.streaming.pending import start_pending_scorer
from revlens.streaming.scorer import (
    ScorerPaths,
    read_archive,
    read_predictions,
    score_batch,
    score_pending,
    start_scorer,
)
from tests.conftest import rows


def event(i, **changes):
    return {
        "id": i, "type": "edit", "namespace": 0, "title": f"Page {i % 3}", "comment": f"edit {i}",
        "timestamp": 1704110400 + i, "user": "10.0.0.1" if i % 4 == 0 else "Ann", "wiki": "enwiki",
        "length": {"old": 100, "new": 100 + i}, "revision": {"old": i, "new": 1000 + i},
        "meta": {"dt": f"2024-01-0{1 + i % 2}T12:00:00Z", "id": str(i)},
    } | changes


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for part in range(4):
        lines = [json.dumps(event(i)) for i in range(part * 10, part * 10 + 10)]
        if part == 1:
            lines += ["{broken", "", json.dumps(event(900, type="log")), json.dumps(event(901, namespace=2))]
            lines += [json.dumps(event(500, user=None, length={"new": 7}, comment=None))]
        (folder / f"batch_{part}.jsonl").write_text("\n".join(lines) + "\n")
    return str(folder)


def run(spark, landing, tmp_path, name="ckpt", **options):
    paths = ScorerPaths(str(tmp_path / "predictions"), str(tmp_path / "archive"))
    query = start_scorer(
        spark, landing, str(tmp_path / name), paths, trigger_seconds=None, max_files=1, **options
    )
    query.awaitTermination()
    return paths


COMPARED = [c for c in PREDICTION_COLUMNS if c not in ("created_at",)]


def test_stream_equals_batch(spark, landing, tmp_path):
    paths = run(spark, landing, tmp_path)
    stored = read_predictions(spark, paths.predictions)
    assert stored.columns == PREDICTION_COLUMNS
    batch = event_features(article_edits(read_events(spark, landing)))
    assert stored.count() == batch.count() == 41
    wanted = batch.select(F.col("revision.new").cast("string"), "length_delta", "is_anon_int")
    assert rows(stored.select("rev_id", "length_delta", "is_anon")) == rows(wanted)
    odd = stored.filter("rev_id = '1500'").first()
    assert (odd.user, odd.is_anon, odd.length_delta, odd.comment) == ("", 1, 7.0, "")
    assert stored.filter(F.col("risk_label") != risk_band(F.col("risk_score"))).count() == 0


def test_replay_changes_nothing(spark, landing, tmp_path):
    paths = run(spark, landing, tmp_path)
    first = rows(read_predictions(spark, paths.predictions).select(COMPARED))
    run(spark, landing, tmp_path, "other-ckpt")
    assert rows(read_predictions(spark, paths.predictions).select(COMPARED)) == first
    # a new checkpoint is a stream of its own, which leaves the first one's rows alone
    assert spark.read.parquet(paths.predictions).select("stream_id").distinct().count() == 2
    assert read_archive(spark, paths.archive).count() == len(first)


def test_restart_continues(spark, landing, tmp_path):
    paths = run(spark, landing, tmp_path)
    (tmp_path / "landing" / "batch_9.jsonl").write_text(json.dumps(event(77)) + "\n")
    run(spark, landing, tmp_path)
    assert read_predictions(spark, paths.predictions).count() == 42
    assert spark.read.parquet(paths.predictions).select("batch_id").distinct().count() == 5


def test_same_edit_in_a_later_batch_replaces_the_earlier(spark, landing, tmp_path):
    paths = run(spark, landing, tmp_path)
    (tmp_path / "landing" / "batch_9.jsonl").write_text(json.dumps(event(3, comment="late")) + "\n")
    run(spark, landing, tmp_path)
    stored = read_predictions(spark, paths.predictions)
    assert stored.count() == 41
    assert stored.filter("rev_id = '1003'").first().comment == "late"


def test_compacted_generation_and_later_batches(spark, landing, tmp_path):
    paths = run(spark, landing, tmp_path)
    first = read_predictions(spark, paths.predictions)
    generation, live = str(tmp_path / "generation"), str(tmp_path / "live")
    compact_latest(first, generation)
    assert rows(read_predictions(spark, generation)) == rows(first)
    (tmp_path / "landing2").mkdir()
    lines = [json.dumps(event(3, comment="late")), json.dumps(event(300))]
    (tmp_path / "landing2" / "b.jsonl").write_text("\n".join(lines) + "\n")
    start_scorer(
        spark, str(tmp_path / "landing2"), str(tmp_path / "c2"), ScorerPaths(live), trigger_seconds=None
    ).awaitTermination()
    both = read_predictions(spark, generation, live)
    assert both.count() == 42
    assert both.filter("rev_id = '1003'").first().comment == "late"


def test_repeats_in_a_batch_are_folded(spark, landing, tmp_path):
    (tmp_path / "landing" / "batch_9.jsonl").write_text(json.dumps(event(3)) + "\n" + json.dumps(event(3)) + "\n")
    paths = run(spark, landing, tmp_path, dedup=True)
    assert spark.read.parquet(paths.predictions).count() == 42  # the repeat in another batch is stored
    assert read_predictions(spark, paths.predictions).count() == 41


def test_compaction_retires_batches(spark, landing, tmp_path):
    paths = run(spark, landing, tmp_path)
    before = rows(read_predictions(spark, paths.predictions))
    generation = run_compaction(spark, paths.predictions, str(tmp_path / "generations"))
    assert spark.read.parquet(paths.predictions).select("batch_id").distinct().count() == 1
    assert rows(read_predictions(spark, generation, paths.predictions)) == before
    again = run_compaction(spark, paths.predictions, str(tmp_path / "generations"))
    assert again != generation and rows(read_predictions(spark, again, paths.predictions)) == before


def test_empty_batch_writes_nothing(spark, tmp_path):
    paths = ScorerPaths(str(tmp_path / "p"))
    (tmp_path / "in").mkdir()
    none = event_features(article_edits(read_events(spark, str(tmp_path / "in"))))
    score_batch(None, paths, "s")(none, 0)
    assert not (tmp_path / "p").exists()


def test_landing(spark, tmp_path):
    feed, target = tmp_path / "feed", str(tmp_path / "landed")
    feed.mkdir()
    lines = [json.dumps(event(i, wiki="enwiki" if i % 2 else "dewiki")) for i in range(250)]
    (feed / "m.txt").write_text("\n".join([*lines, "", "{broken"]) + "\n")
    land_events(
        spark.readStream.text(str(feed)), target, str(tmp_path / "c"), flush_seconds=None, events_per_file=100
    ).awaitTermination()
    assert read_events(spark, target).count() == 125
    assert len(list((tmp_path / "landed").glob("*.txt"))) == 2


def test_landing_stops_after_a_number_of_events(spark, tmp_path):
    feed, target = tmp_path / "feed", str(tmp_path / "landed")
    feed.mkdir()
    (feed / "m.txt").write_text("\n".join(json.dumps(event(i)) for i in range(50)) + "\n")
    land_events(
        spark.readStream.text(str(feed)), target, str(tmp_path / "c"), flush_seconds=None, max_events=20
    ).awaitTermination()
    assert read_events(spark, target).count() == 20


def test_pending_rows_get_heuristic_scores(spark):
    data = [("a", "rv vandalism", "10.0.0.1", 1, -600.0, None, None, 0, "t1"),
            ("b", "ok", "Ann", 0, 1.0, 0.5, "HIGH", 1, "t2")]
    df = spark.createDataFrame(
        data,
        "id string, comment string, user string, is_anon int, length_delta double, risk_score double, "
        "risk_label string, scored int, created_at string",
    )
    first, second = score_pending(df).orderBy("id").collect()
    assert (first.risk_score, first.risk_label, first.scored) == (pytest.approx(0.70), "HIGH", 1)
    assert (second.risk_score, second.risk_label, second.created_at) == (0.5, "HIGH", "t2")
    assert first.scored_at is not None and second.scored_at is None


# ---- one row per edit across batches ---------------------------------------------------------


def at(i, second, **changes):
    return event(i, timestamp=1704110400 + second, meta={"id": str(i)}, **changes)


def land_part(tmp_path, name, events):
    (tmp_path / "feed").mkdir(exist_ok=True)
    (tmp_path / "feed" / f"{name}.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))


def deduped(spark, tmp_path, delay="10 minutes"):
    query = start_deduped(
        spark, str(tmp_path / "feed"), str(tmp_path / "c"), ScorerPaths(str(tmp_path / "p")), str(tmp_path / "late"),
        delay, trigger_seconds=None, max_files=1,
    )
    query.awaitTermination()
    return query


def test_an_edit_of_another_batch_is_not_stored_again(spark, tmp_path):
    land_part(tmp_path, "a", [at(i, i) for i in range(20)])
    deduped(spark, tmp_path)
    land_part(tmp_path, "b", [at(i, i) for i in range(10, 30)] + [at(12, 12)])
    deduped(spark, tmp_path)
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert stored.count() == stored.select("id").distinct().count() == 30
    assert rows(stored.groupBy("batch_id").count().select("count")) == [(10,), (20,)]
    assert not (tmp_path / "late").exists()


def test_late_events_are_kept_apart(spark, tmp_path):
    land_part(tmp_path, "a", [at(1, 0), at(2, 3600)])
    deduped(spark, tmp_path)
    # behind the watermark: a repeat, and an edit never seen; at its edge: one more
    land_part(tmp_path, "b", [at(1, 0), at(3, 60), at(4, 3000), at(5, 3001)])
    deduped(spark, tmp_path)
    stored, late = spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "late"))
    assert rows(stored.select("rev_id")) == [("1001",), ("1002",), ("1005",)]
    assert rows(late.select("id")) == [(1,), (3,), (4,)]
    assert rows(read_late(late, stored).select("id")) == [(3,), (4,)]


def test_no_edit_is_lost_however_files_fall_into_batches(spark, tmp_path):
    """The same files read in one go: another batch order makes others late, but each edit is somewhere once."""
    for part, seconds in enumerate([(0, 3600), (60, 3000), (3001, 0), (9000,), (60, 8000, 9001)]):
        land_part(tmp_path, f"f{part}", [at(s, s) for s in seconds])
    deduped(spark, tmp_path)
    stored, late = spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "late"))
    assert stored.count() == stored.select("id").distinct().count()
    found = rows(stored.select("rev_id")) + rows(read_late(late, stored).select(F.col("revision.new").cast("string")))
    assert sorted(found) == [(str(1000 + s),) for s in sorted((0, 60, 3000, 3001, 3600, 8000, 9000, 9001), key=lambda s: str(1000 + s))]


def test_state_holds_a_stretch_of_time(spark, tmp_path):
    """Ten batches of an hour each: the state holds the last ones, not all."""
    sizes = []
    for hour in range(10):
        land_part(tmp_path, f"h{hour}", [at(hour * 100 + i, hour * 3600 + i) for i in range(100)])
        query = deduped(spark, tmp_path)
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1000
    assert max(sizes) <= 200


def test_events_without_time_are_stored(spark, tmp_path):
    timeless = event(7, timestamp=None, meta={"id": "7"})
    land_part(tmp_path, "a", [at(1, 0), timeless])
    deduped(spark, tmp_path)
    assert rows(spark.read.parquet(str(tmp_path / "p")).select("rev_id")) == [("1001",), ("1007",)]


def test_events_without_a_new_revision_keep_their_own_key(spark, landing, tmp_path):
    lines = [json.dumps(event(600 + i, revision={"old": 1, "new": None})) for i in range(4)]
    (tmp_path / "landing" / "batch_9.jsonl").write_text("\n".join(lines) + "\n")
    paths = run(spark, landing, tmp_path)
    stored = read_predictions(spark, paths.predictions)
    assert stored.count() == 45
    assert rows(stored.filter("rev_id like '60_'").select("rev_id")) == [(str(600 + i),) for i in range(4)]


# ---- pending rows ---------------------------------------------------------------------------


def pending(spark, ids, scored=0):
    data = [
        (i, i, "Page", 0, "10.0.0.1", 1, "rv vandalism", -600.0, "", "enwiki", 0.5 if scored else None, None, scored, f"2024-01-01T00:00:0{n}")
        for n, i in enumerate(ids)
    ]
    return spark.createDataFrame(data, PREDICTION)


def test_pending_rows_are_scored_once(spark, tmp_path):
    stored, target, checkpoint = (str(tmp_path / n) for n in ("stored", "target", "c"))

    def drain(where):
        query = start_pending_scorer(spark, stored, target, where, trigger_seconds=None)
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    append_batch(pending(spark, ["a", "b"]), stored, "feed", 0)
    append_batch(pending(spark, ["c"], scored=1), stored, "feed", 1)
    assert drain(checkpoint) == 2  # the scored row is skipped in the scan
    append_batch(pending(spark, ["d", "b"]), stored, "feed", 2)
    assert drain(checkpoint) == 2  # only the new file
    assert drain(checkpoint) == 0
    found = read_predictions(spark, stored, target)
    assert rows(found.select("id", "scored")) == [("a", 1), ("b", 1), ("c", 1), ("d", 1)]
    assert found.filter("id = 'c'").first().risk_score == 0.5
    assert found.filter("id = 'a'").first().risk_label == "HIGH"
    assert found.filter("id = 'a'").first().created_at == "2024-01-01T00:00:00"
    before = rows(found)
    drain(str(tmp_path / "c2"))  # all of it once more
    assert rows(read_predictions(spark, stored, target)) == before


def test_pending_scorer_needs_its_own_folder(spark, tmp_path):
    with pytest.raises(ValueError):
        start_pending_scorer(spark, str(tmp_path), f"{tmp_path}/", str(tmp_path / "c"))


def test_landed_files_grow_in_number_with_the_events(spark, tmp_path, monkeypatch):
    """The lines of a task stay as many, and no file gets all of the blank ones."""
    i = F.col("id")
    spark.range(4000).select(
        i.alias("event_id"), F.timestamp_seconds(1_704_067_200 + i).alias("ts"), (i % 13).alias("user_id"),
        F.lit("view").alias("event_type"), (i * 2.5).alias("value"), F.lit('{"k": 3}').alias("props"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(io_queries, "EVENTS_PER_LANDED_FILE", 250)
    lines = spark.read.text(io_queries.land(spark, str(tmp_path), copies=2))
    files = lines.groupBy(F.col("_metadata.file_name")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.trim("value") == "").alias("blank")
    ).collect()
    assert sum(f["n"] for f in files) == 5 * 4000 and sum(f["blank"] for f in files) == 2 * 4000
    assert len(files) == 16 and max(f["n"] for f in files) < 3 * 5 * 250
    assert max(f["blank"] for f in files) < 3 * 2 * 250


@pytest.fixture
def written(spark, tmp_path, monkeypatch):
    """A folder of 4000 events of two wikis, what their landed lines take, and what queries land in bytes."""
    i = F.col("id")
    spark.range(4000).select(
        i.alias("event_id"), F.timestamp_seconds(1_704_067_200 + i).alias("ts"), (i % 13).alias("user_id"),
        F.when(i % 5 == 0, "error").otherwise("view").alias("event_type"), (i * 2.5).alias("value"),
        F.concat(F.lit('{"k": '), i % 101, F.lit("}")).alias("props"),
    ).write.parquet(str(tmp_path / "events.parquet"))
    numbers = iter(range(1000))
    monkeypatch.setattr(io_queries, "scratch_path", lambda _, name: str(tmp_path / "scratch" / f"{name}-{next(numbers)}"))

    def landed():
        return sum(f.stat().st_size for f in (tmp_path / "scratch").glob("landing*/part-*"))

    plain = spark.read.text(io_queries.land(spark, str(tmp_path))).agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert landed() == plain
    return str(tmp_path), plain, lambda: landed() - plain


def edits_of(spark, folder):
    """Ids of the edits of article space, told by the rows of ``written``."""
    events = event_features(article_edits(io_queries.raw_events(spark, folder)))
    return rows(events.select(F.coalesce(F.col("revision.new"), F.col("id")).cast("string")))


def test_two_writers_land_the_events_once_and_packed(spark, written):
    folder, plain, landed = written
    found = io_queries._two_writers(spark, folder)
    assert rows(found.select("rev_id")) == edits_of(spark, folder)
    assert rows(found.groupBy("wiki").count().select("wiki")) == [("dewiki",), ("enwiki",)]
    assert 0 < landed() < plain / 2


def test_a_wiki_is_landed_in_files_of_some_lines(spark, tmp_path, written, monkeypatch):
    folder, _, _ = written
    monkeypatch.setattr(io_queries, "LINES_PER_WIKI_FILE", 250)
    found = io_queries._two_writers(spark, folder)
    assert rows(found.select("rev_id")) == edits_of(spark, folder)
    lines = spark.read.text(str(tmp_path / "scratch" / "landing-enwiki-*"))
    sizes = rows(lines.groupBy(F.col("_metadata.file_name")).count().select("count"))
    assert sum(n for n, in sizes) == 3200 and len(sizes) > 10 and max(n for n, in sizes) <= 250


def test_scored_files_are_dropped_if_asked(spark, landing, tmp_path):
    """All but those of a run's last batch; what is stored, and where a restart goes on, stay the same."""
    kept = run(spark, landing, tmp_path)
    wanted = rows(read_predictions(spark, kept.predictions).select(COMPARED))
    assert len(list((tmp_path / "landing").iterdir())) == 4
    paths = ScorerPaths(str(tmp_path / "again"))

    def drain():
        query = start_scorer(
            spark, landing, str(tmp_path / "c"), paths, trigger_seconds=None, max_files=1, drop_landed=True
        )
        query.awaitTermination()
        return sum(p["numInputRows"] > 0 for p in query.recentProgress)

    assert drain() == 4
    assert rows(read_predictions(spark, paths.predictions).select(COMPARED)) == wanted
    assert len(list((tmp_path / "landing").iterdir())) == 1
    assert drain() == 0
    (tmp_path / "landing" / "batch_9.jsonl").write_text(json.dumps(event(77)) + "\n")
    assert drain() == 1
    assert read_predictions(spark, paths.predictions).count() == len(wanted) + 1
    assert spark.read.parquet(paths.predictions).select("batch_id").distinct().count() == 5


def test_compaction_query_keeps_no_landed_copies(spark, written):
    folder, plain, landed = written
    found = io_queries._compacted(spark, folder)
    assert rows(found.select("rev_id")) == edits_of(spark, folder)
    assert 0 < landed() < plain
