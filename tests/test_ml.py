from __future__ import annotations

import bz2
from dataclasses import replace

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from revlens.config import HISTORY, WEAK, JobConfig, TrainConfig
from revlens.ml import training
from revlens.ml.evaluation import evaluate, exact_areas
from revlens.ml.features import NUMERIC, classifier, fit_features, fitted_stages
from revlens.ml.scoring import load_first_model, rescore, save_model, score
from revlens.operators.splits import with_fold
from revlens.plans import ml_queries
from revlens.plans.catalog import catalog
from revlens.plans.jobs import run_batch, run_history
from revlens.plans.ml_queries import _fitted, exported_model
from revlens.plans.views import edits
from revlens.schemas import HISTORY_COLUMNS, RESCORE_INPUT

SMALL = replace(HISTORY, comment_buckets=64, title_buckets=32, min_doc_freq=1, min_rows=10)


def labeled_rows(spark, n=600):
    """Labels that follow the comment and the size only loosely."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64("id"), F.lit(10))
    return spark.range(n).select(
        i.cast("string").alias("revision_id"),
        ((i % 5 == 0) != (noise < 2)).cast("int").alias("label"),
        (F.when(i % 5 == 0, -50.0).otherwise(120.0) + noise * 40).alias("length_delta"),
        (i % 4 == 0).cast("int").alias("is_anon_int"),
        (i % 24).cast("int").alias("hour_of_day"),
        (i % 7 + 1).cast("int").alias("day_of_week"),
        F.concat(F.lit("word"), (i % 5).cast("string"), F.lit(" extra"), noise.cast("string")).alias(
            "comment_clean"
        ),
        F.concat(F.lit("title "), F.lit("t"), (i % 3).cast("string")).alias("title_clean"),
    )


def test_feature_vector(spark):
    df = labeled_rows(spark, 50)
    features = fit_features(df, SMALL).transform(df)
    assert len(features.first().features) == 64 + 32 + 4
    names = {s.uid.split("_")[0] for s in Pipeline(stages=fitted_stages(WEAK)).getStages()}
    assert names == {"IDF", "VectorAssembler", "StandardScaler"}


def test_search_equals_a_plain_cross_validation(spark):
    """Same folds, same scores as refitting the whole chain for each grid point."""
    cfg = replace(SMALL, grid_reg=(0.01, 0.1), grid_iter=(3, 50))
    hashed, _ = training.hashed_rows(labeled_rows(spark), "revision_id", cfg)
    hashed = with_fold(hashed, "revision_id", cfg.folds).persist()
    got, fits = training.cross_validate(hashed, cfg)
    lr = classifier(cfg)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.01, 0.1]).addGrid(lr.maxIter, [3, 50]).build()
    plain = CrossValidator(
        estimator=Pipeline(stages=[*fitted_stages(cfg), lr]),
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(rawPredictionCol="raw_prediction"),
        numFolds=cfg.folds,
        foldCol="fold",
    ).fit(hashed)
    wanted = {
        (point[lr.regParam], point[lr.maxIter]): value
        for point, value in zip(grid, plain.avgMetrics, strict=True)
    }
    assert got == pytest.approx(wanted, abs=2e-3)
    assert fits <= 12


def test_one_fit_serves_two_limits_once_converged(spark):
    hashed, _ = training.hashed_rows(labeled_rows(spark, 300), "revision_id", SMALL)
    features = Pipeline(stages=fitted_stages(SMALL)).fit(hashed).transform(hashed)
    models = training._fit_limits(classifier(SMALL), features, 0.1, (50, 100), True)
    assert models[50] is models[100] and models[50].summary.totalIterations < 50
    apart = training._fit_limits(classifier(SMALL), features, 0.1, (50, 100), False)
    assert apart[50] is not apart[100]
    short = training._fit_limits(classifier(SMALL), features, 0.001, (2, 100), True)
    assert short[2] is not short[100]


def test_train_save_load_score(spark, tmp_path):
    result = training.train(labeled_rows(spark), "revision_id", SMALL)
    assert set(result.metrics) == {
        "auc", "pr_auc", "f1", "precision", "recall", "accuracy", "training_time_seconds",
    }
    assert 0.6 < result.metrics["auc"] <= 1
    assert result.rows["train"] + result.rows["test"] == 600
    assert len(result.cv_scores) == 6 and result.fits <= 19
    assert result.best["best_reg_param"] in SMALL.grid_reg
    scored = result.model.transform(result.test)
    exact = exact_areas(scored).first()
    assert result.metrics["auc"] == pytest.approx(exact.roc_auc, abs=2e-3)
    assert evaluate(scored) == {k: v for k, v in result.metrics.items() if k != "training_time_seconds"}

    save_model(result.model, str(tmp_path / "model"))
    loaded = load_first_model([str(tmp_path / "absent"), str(tmp_path / "model")])
    probability = vector_to_array("probability")[1]
    before = result.model.transform(result.test).select("revision_id", probability.alias("p"))
    after = score(result.test, loaded).select("revision_id", F.col("risk_score").alias("p"))
    assert before.exceptAll(after).count() == 0
    with pytest.raises(FileNotFoundError):
        load_first_model([str(tmp_path / "absent")])


def test_too_few_rows(spark):
    with pytest.raises(ValueError, match="at least 1000"):
        training.train(labeled_rows(spark, 20), "revision_id", TrainConfig())


def history_file(path, n=2000):
    lines = ["# generated"]
    comments = ["/* section */ fixed typo", "added reference", "copy edit", "new paragraph", "cleanup"]
    for i in range(n):
        fields = {
            "wiki_db": "enwiki", "event_entity": "revision", "event_type": "create",
            "event_timestamp": f"2023-06-{1 + i % 28:02d} {i % 24:02d}:30:00.0",
            "event_comment": comments[i % 5], "event_user_is_anonymous": str(i % 4 == 0).lower(),
            "page_title_historical": f"Title {i % 7}", "page_namespace": "0", "revision_id": str(i),
            "revision_text_bytes_diff": str((-50 if i % 5 == 0 else 120) + i % 30),
            "revision_is_identity_reverted": str(i % 5 == 0).lower(),
        }
        lines.append("\t".join(fields.get(c, "") for c in HISTORY_COLUMNS))
    path.write_bytes(bz2.compress(("\n".join(lines) + "\n").encode()))


def test_history_job(spark, tmp_path, sf_dir):
    history_file(tmp_path / "h.tsv.bz2")
    cfg = JobConfig(
        work_dir=str(tmp_path / "work"), history_paths=(str(tmp_path / "h.tsv.bz2"),), train=SMALL
    )
    stored = edits(spark, sf_dir)
    first = run_history(spark, cfg, stored)
    assert first.counts["labels"] == {"total": 2000, "positive": 400, "negative": 1600, "positive_rate": 0.2}
    assert first.training.metrics["auc"] > 0.99  # the comment decides the label in this file
    assert first.counts["scored"]["complete"] is True
    rescored = spark.read.parquet(cfg.path("rescored"))
    assert rescored.count() == stored.count()
    assert rescored.filter("risk_score is null or risk_label is null or scored = 0").count() == 0
    manifest = spark.read.json(cfg.path("model_manifest")).first()
    assert manifest.training_data_stats.total == 2000 and manifest.metrics.auc > 0.99
    matrix = spark.read.json(cfg.path("confusion_matrix")).first()
    assert matrix.tp + matrix.fp + matrix.tn + matrix.fn == first.training.rows["test"]

    assert first.counts["steps"]
    assert not list((tmp_path / "work").glob("_scratch-*"))

    again = run_history(spark, cfg)
    assert again.reused and again.training is None
    assert again.counts["labels"] == first.counts["labels"]
    assert again.counts["steps"] == first.counts["steps"]


def test_history_job_knows_its_inputs(spark, tmp_path):
    history_file(tmp_path / "a.tsv.bz2", 600)
    history_file(tmp_path / "b.tsv.bz2", 300)
    small = replace(SMALL, min_rows=10, grid_reg=(0.01,), grid_iter=(20,))
    cfg = JobConfig(
        work_dir=str(tmp_path / "w"), history_paths=(str(tmp_path / "a.tsv.bz2"),), row_cap=200, train=small
    )
    assert run_history(spark, cfg).counts["labels"]["total"] == 200
    whole = run_history(spark, replace(cfg, row_cap=None))
    assert not whole.reused and whole.counts["labels"]["total"] == 600
    other = run_history(spark, replace(cfg, row_cap=None, history_paths=(str(tmp_path / "b.tsv.bz2"),)))
    assert not other.reused and other.counts["labels"]["total"] == 300
    last = replace(cfg, row_cap=None, history_paths=(str(tmp_path / "b.tsv.bz2"),))
    assert run_history(spark, last).reused
    assert not run_history(spark, replace(last, train=replace(small, grid_reg=(0.1,)))).reused


def test_history_job_without_rows(spark, tmp_path):
    (tmp_path / "h.tsv").write_text("enwiki\tuser\tcreate\n")
    cfg = JobConfig(work_dir=str(tmp_path / "w"), history_paths=(str(tmp_path / "h.tsv"),))
    with pytest.raises(RuntimeError, match="revision_entity"):
        run_history(spark, cfg)


def dump_file(path, pages=40, revisions=6):
    parts = ["<mediawiki>"]
    for p in range(pages):
        parts.append(f"<page><title>Page {p}</title><ns>{int(p % 10 == 9)}</ns><id>{p}</id>")
        for r in range(revisions):
            parent = f"<parentid>{p * 100 + r - 1}</parentid>" if r else ""
            size = 2000 - 700 * (r % 3 == 2) + p
            text = "rv vandalism" if (p + r) % 5 == 0 else f"work on section {r}"
            parts.append(
                f"<revision><id>{p * 100 + r}</id>{parent}<timestamp>2024-01-01T0{r}:00:00Z</timestamp>"
                f"<contributor><username>U{r}</username></contributor><comment>{text}</comment>"
                f'<text bytes="{size}"/></revision>'
            )
        parts.append("</page>")
    path.write_bytes(bz2.compress(("\n".join(parts) + "</mediawiki>").encode()))


def test_dump_job(spark, tmp_path):
    dump_file(tmp_path / "d.xml.bz2")
    train = replace(SMALL, min_rows=100, grid_reg=(0.01,), grid_iter=(50,))
    cfg = JobConfig(
        work_dir=str(tmp_path / "work"), dump_paths=(str(tmp_path / "d.xml.bz2"),), train=train
    )
    result = run_batch(spark, cfg)
    features = spark.read.parquet(cfg.path("features"))
    assert features.count() == 36 * 6
    assert features.filter("length_delta = -700").count() == 36 * 2
    counts = result.counts["labels"]
    assert counts["total"] == 216 and 0 < counts["positive"] < 216 and counts["null_labels"] == 0
    assert result.training.metrics["auc"] > 0.5
    only_labels = run_batch(spark, replace(cfg, phases=("label",)))
    assert only_labels.training is None and only_labels.counts["labels"] == counts
    plain = run_batch(spark, replace(cfg, phases=("features", "label"), placeholder_parent=True))
    assert plain.counts["labels"]["positive"] < counts["positive"]
    assert spark.read.parquet(cfg.path("features")).filter("length_delta < 0").count() == 0


def test_rescore_keeps_the_feed_order(spark, sf_dir):
    model = training.train(labeled_rows(spark), "revision_id", SMALL).model
    stored = edits(spark, sf_dir)
    fresh = rescore(stored, model)
    assert fresh.columns == stored.columns
    assert fresh.select("id", "created_at").exceptAll(stored.select("id", "created_at")).count() == 0
    from revlens.operators.features import prediction_features

    inputs = prediction_features(stored)
    assert [(f.name, f.dataType) for f in inputs.schema] == [(f.name, f.dataType) for f in RESCORE_INPUT]


def test_scores_computed_in_sql(spark, sf_dir, tmp_path):
    """The model's own numbers as rows: DuckDB hashes nothing, but adds up margins, scores and the area."""
    rows_in, model = _fitted(spark, sf_dir)
    hashed, _ = training.hashed_rows(rows_in, "revision_id", WEAK)
    width = [WEAK.comment_buckets, WEAK.title_buckets]

    def exploded(column, offset):
        return hashed.select("revision_id", F.posexplode(vector_to_array(column)).alias("i", "x")).select("revision_id", (F.col("i") + offset).alias("i"), "x")

    values = exploded("comment_tf", 0).unionAll(exploded("title_tf", width[0]))
    for n, name in enumerate(NUMERIC):
        values = values.unionAll(hashed.select("revision_id", F.lit(sum(width) + n), F.col(name).cast("double")))
    values.filter("x <> 0").write.parquet(str(tmp_path / "values"))
    scored = score(rows_in, model).select("revision_id", F.col("label").cast("int").alias("label"), "risk_score")
    scored.write.parquet(str(tmp_path / "scores"))
    con = duckdb.connect()
    con.execute("CREATE TABLE model(i INTEGER, weight DOUBLE, deviation DOUBLE, coefficient DOUBLE)")
    con.executemany("INSERT INTO model VALUES (?, ?, ?, ?)", exported_model(model))
    found = con.execute(f"""WITH m AS (
        SELECT revision_id, sum(CASE WHEN deviation = 0 THEN 0 ELSE x * weight / deviation * coefficient END) AS s
        FROM '{tmp_path}/values/*.parquet' JOIN model USING (i) GROUP BY 1),
      s AS (SELECT revision_id, label, risk_score, 1 / (1 + exp(-(coalesce(s, 0) + (SELECT coefficient FROM model WHERE i = -1)))) AS own
        FROM '{tmp_path}/scores/*.parquet' LEFT JOIN m USING (revision_id)),
      r AS (SELECT label, rank() OVER (ORDER BY own) + (count(*) OVER (PARTITION BY own) - 1) / 2 AS place FROM s)
      SELECT (SELECT count(*) FROM s), (SELECT max(abs(own - risk_score)) FROM s),
        (SELECT (sum(place) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2)
          / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) FROM r)""").fetchone()
    assert found[0] == rows_in.count() and found[1] < 1e-9
    area = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="risk_score").evaluate(scored.withColumn("label", F.col("label").cast("double")))
    assert abs(found[2] - area) < 1e-9


def odd_tables(spark, path, n=60):
    """Labelled documents, one id twice, and events."""
    i = F.col("id")
    ids = spark.range(n).unionAll(spark.range(1))
    ids.select(
        i.alias("doc_id"),
        F.concat(F.lit("word"), (i % 5).cast("string"), F.lit(" extra"), (i % 3).cast("string")).alias("text"),
        F.lit("en").alias("lang"),
        F.concat(F.lit("site "), (i % 3).cast("string")).alias("source"),
        (i * 7).alias("n_chars"),
    ).write.parquet(f"{path}/documents.parquet")
    spark.range(n).select(
        i.alias("doc_id"), (i % 5 == 0).cast("int").alias("quality"), (i % 5 == 0).cast("int").alias("toxic")
    ).write.parquet(f"{path}/labels.parquet")
    spark.range(n).select(
        i.alias("event_id"),
        F.timestamp_seconds(1_704_067_200 + i * 900).alias("ts"),
        (i % 13).alias("user_id"),
        F.when(i % 4 == 0, "signup").otherwise("view").alias("event_type"),
        (i * 2.5).alias("value"),
        F.concat(F.lit('{"k": '), (i % 100).cast("string"), F.lit("}")).alias("props"),
    ).write.parquet(f"{path}/events.parquet")


def test_scores_say_what_holds_of_margin_and_band(spark, tmp_path):
    """Every labelled row, a repeated id as often as it is there."""
    odd_tables(spark, str(tmp_path))
    got = catalog()["logreg_scores"].run(spark, str(tmp_path))
    assert got.columns == ["revision_id", "label", "is_logistic_of_margin", "band_agrees"]
    assert got.count() == 61
    assert got.filter("is_logistic_of_margin and band_agrees").count() == 61


def test_rescored_edits_all_come_back(spark, tmp_path, monkeypatch):
    """A row with a bad score is shown as such, not left out."""
    odd_tables(spark, str(tmp_path))
    run = catalog()["model_rescore"].run
    got = run(spark, str(tmp_path))
    assert got.columns == ["id", "page_title", "comment", "created_at", "scored", "band_agrees", "score_in_range"]
    assert got.count() == got.filter("band_agrees and score_in_range and scored = 1").count() == 60
    bad = F.when(F.col("id") == "7", 1.5).otherwise(F.col("risk_score"))
    monkeypatch.setattr(ml_queries, "rescore", lambda rows, model: rescore(rows, model).withColumn("risk_score", bad))
    got = run(spark, str(tmp_path))
    assert got.count() == 60
    assert [r["id"] for r in got.filter("not score_in_range").collect()] == ["7"]
