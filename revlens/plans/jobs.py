"""End-to-end jobs. Every phase reads the table the phase before it wrote."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revlens.config import HISTORY, WEAK, JobConfig, TrainConfig
from revlens.ml.scoring import rescore, save_model
from revlens.ml.training import TrainResult, train
from revlens.operators import stats
from revlens.operators.confusion import confusion_document
from revlens.operators.deltas import parent_sizes
from revlens.operators.features import (
    history_features,
    history_revisions,
    history_steps,
    revision_features,
)
from revlens.operators.labeling import apply_weak_labels
from revlens.operators.prefix import first_rows
from revlens.session import drop_folder, folder_names, job_scratch, pin_utc, stage_table
from revlens.sinks.documents import model_manifest, read_document, write_document
from revlens.sinks.tables import compact_latest, write_revisions, write_table
from revlens.sources.history import read_history
from revlens.sources.tables import read_table
from revlens.sources.xml import read_revisions
from revlens.streaming.scorer import read_predictions


@dataclass
class JobResult:
    counts: dict[str, dict] = field(default_factory=dict)
    training: TrainResult | None = None
    reused: bool = False


def run_batch(spark: SparkSession, cfg: JobConfig) -> JobResult:
    """XML dumps to a model with weak labels; phases not listed in the config are skipped."""
    pin_utc(spark)
    with job_scratch(spark, cfg.work_dir):
        return _run_batch(spark, cfg)


def _run_batch(spark: SparkSession, cfg: JobConfig) -> JobResult:
    result = JobResult()
    if "parse" in cfg.phases:
        write_revisions(read_revisions(spark, list(cfg.dump_paths)), cfg.path("revisions"))
    if "features" in cfg.phases:
        revisions = read_table(spark, cfg.path("revisions"))
        parents = None
        if not cfg.placeholder_parent:
            parents = stage_table(parent_sizes(revisions), "parent-sizes")
        rows = revision_features(revisions, parents, cfg.placeholder_parent)
        write_table(rows, cfg.path("features"))
    if "label" in cfg.phases:
        rows = read_table(spark, cfg.path("features"))
        write_table(apply_weak_labels(rows), cfg.path("labeled"))
        labeled = read_table(spark, cfg.path("labeled"))
        result.counts["labels"] = read_document(stats.label_counts(labeled))
    if "train" in cfg.phases:
        labeled = read_table(spark, cfg.path("labeled"))
        result.training = _train(labeled, "rev_id", cfg, cfg.train or WEAK, "xml dumps", "weak rules")
    return result


def labeled_history(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    raw = read_history(spark, list(cfg.history_paths))
    return _labeled(raw, cfg)


def _labeled(raw: DataFrame, cfg: JobConfig) -> DataFrame:
    rows = history_features(history_revisions(raw))
    return rows if cfg.row_cap is None else first_rows(rows, cfg.row_cap)


def run_history(
    spark: SparkSession, cfg: JobConfig, predictions: DataFrame | None = None
) -> JobResult:
    """History dumps to a model with observed-revert labels, then fresh scores for stored edits.

    What an earlier run left is reused if that run's inputs were the same: the labelled table for the
    same paths and row cap, the model for the same training settings as well. Else it is built anew.
    ``counts`` hold the filter steps, the labels and the scored rows. The rescored table is written
    to ``rescored``.
    """
    pin_utc(spark)
    with job_scratch(spark, cfg.work_dir):
        return _run_history(spark, cfg, predictions)


def _run_history(spark: SparkSession, cfg: JobConfig, predictions: DataFrame | None) -> JobResult:
    settings = cfg.train or HISTORY
    table_inputs = {"paths": sorted(cfg.history_paths), "row_cap": cfg.row_cap}
    model_inputs = table_inputs | {"train": asdict(settings)}
    result = JobResult()
    same_table = _recorded(spark, cfg, "labeled_history") == _as_json(table_inputs)
    same_model = same_table and _recorded(spark, cfg, "model") == _as_json(model_inputs)
    if not same_table:
        # The steps are counted by the pass that writes the rows, so the dump is read once. In a session
        # of its own: one that has observed something can no longer be sent to tasks, as evaluators do.
        counts, steps = Observation("history-steps"), history_steps()
        reader = pin_utc(spark.newSession())
        raw = read_history(reader, list(cfg.history_paths)).observe(counts, *stats.step_counts(steps))
        write_table(_labeled(raw, cfg), cfg.path("labeled_history"))
        write_table(stats.observed_waterfall(spark, steps, counts.get), cfg.path("waterfall"))
        _record(spark, cfg, "labeled_history", table_inputs)
    labeled = read_table(spark, cfg.path("labeled_history"))
    result.counts["steps"] = {
        r["name"]: r["n_rows"] for r in read_table(spark, cfg.path("waterfall")).collect()
    }
    if same_model:
        model = PipelineModel.load(cfg.path("model"))
        result.reused = True
        result.counts["labels"] = read_document(spark.read.json(cfg.path("label_stats")))
    else:
        write_document(stats.label_stats(labeled), cfg.path("label_stats"))
        result.counts["labels"] = read_document(spark.read.json(cfg.path("label_stats")))
        if result.counts["labels"]["total"] == 0:
            raise RuntimeError(f"no labelled rows after filtering: {result.counts['steps']}")
        result.training = _train(
            labeled, "revision_id", cfg, settings, "history dumps", "revision_is_identity_reverted"
        )
        model = result.training.model
        _record(spark, cfg, "model", model_inputs)
    if predictions is not None:
        write_table(rescore(predictions, model, cfg.bands), cfg.path("rescored"))
        rescored = read_table(spark, cfg.path("rescored"))
        result.counts["scored"] = read_document(stats.scoring_progress(rescored))
    return result


def _as_json(inputs: dict) -> str:
    return json.dumps(inputs, sort_keys=True)


def _record(spark: SparkSession, cfg: JobConfig, name: str, inputs: dict) -> None:
    """What ``name`` was made of; written after it, so an unfinished table has no record."""
    row = spark.range(1).select(F.lit(_as_json(inputs)).alias("value"))
    row.coalesce(1).write.mode("overwrite").text(cfg.path(f"{name}_inputs"))


def _recorded(spark: SparkSession, cfg: JobConfig, name: str) -> str | None:
    try:
        found = spark.read.text(cfg.path(f"{name}_inputs")).first()
    except AnalysisException:
        return None
    return found[0] if found else None


def run_compaction(spark: SparkSession, live: str, generations: str) -> str:
    """Folds the batches of ``live`` and the newest generation into a new generation; returns its path.

    Batches that are folded go, but for each stream's newest one, which its stream may write again
    after a failure. Of the generations before, the last stays for readers that still use it. Read the
    result with ``read_predictions(spark, path, live)``.
    """
    with job_scratch(spark, generations):
        names = sorted(folder_names(spark, generations, "g-"))
        done = [f"{generations.rstrip('/')}/{n}" for n in names]
        batches = (
            spark.read.parquet(live)
            .select(F.col("stream_id").cast("string").alias("stream_id"), "batch_id")
            .distinct()
            .collect()  # one row per batch since the last compaction
        )
        newest = {s: max(b for t, b in batches if t == s) for s, _ in batches}
        folders = {(s, b): f"{live.rstrip('/')}/stream_id={s}/batch_id={b}" for s, b in batches}
        rows = read_predictions(spark, live, *done[-1:])
        path = f"{generations.rstrip('/')}/g-{int(names[-1][2:]) + 1 if names else 0:010d}"
        compact_latest(rows, path)
        for (stream, batch), folder in folders.items():
            if batch < newest[stream]:
                drop_folder(spark, folder)
        for old in done[:-1]:
            drop_folder(spark, old)
    return path


def _train(
    labeled: DataFrame, key: str, cfg: JobConfig, settings: TrainConfig, source: str, label: str
) -> TrainResult:
    """Trains, then writes model, manifest and confusion matrix."""
    run_id = uuid.uuid4().hex
    trained = train(labeled, key, settings, cfg.path("test_scores"))
    save_model(trained.model, cfg.path("model"))
    manifest = model_manifest(
        stats.label_stats(labeled), run_id, cfg.path("model"), source, label, trained.metrics
    )
    write_document(manifest, cfg.path("model_manifest"))
    write_document(confusion_document(trained.scored, run_id), cfg.path("confusion_matrix"))
    return trained
