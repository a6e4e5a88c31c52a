"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace

from pyspark.sql import SparkSession

from revlens.plans.catalog import catalog

HEADLINE = (
    "clean_text",
    "token_counts",
    "weak_labels",
    "weak_label_stats",
    "event_json_features",
    "heuristic_score",
    "explanations",
    "feed_page",
    "feed_stats",
    "score_histogram",
    "latest_by_key",
    "rescore_merge",
    "explanation_cache",
    "length_delta_parent_join",
    "tfidf",
    "ranking_metrics",
    "stream_scores",
    "logreg_scores",
)


def train_history(spark: SparkSession, sf_dir: str, share_fits: bool) -> tuple[float, int, int]:
    """The published headline: cross-validated training on history rows.

    Rows are the edits of ``events``, written as a dump before the clock starts. Returns seconds of
    search and refit, labelled rows, and the fits made: 19 without sharing, fewer where points of the
    grid that lead to the same coefficients share theirs.
    """
    from revlens.config import HISTORY
    from revlens.ml.training import train
    from revlens.operators.features import history_features, history_revisions
    from revlens.plans.io_queries import write_history
    from revlens.session import stage_table
    from revlens.sources.history import read_history

    raw = read_history(spark, write_history(spark, sf_dir))
    labeled = stage_table(history_features(history_revisions(raw)), "bench-labeled")
    result = train(labeled, "revision_id", replace(HISTORY, min_rows=1, share_fits=share_fits))
    return result.seconds, sum(result.rows.values()), result.fits


def raw_reads(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Reading raw formats, which are written before the clock starts."""
    from revlens.operators import features
    from revlens.plans.io_queries import write_dump, write_history
    from revlens.sources import history, xml

    inputs = {
        "history_features": (
            write_history(spark, sf_dir),
            lambda p: features.history_features(features.history_revisions(history.read_history(spark, p))),
        ),
        "xml_revision_features": (
            write_dump(spark, sf_dir),
            lambda p: features.revision_features(xml.read_revisions(spark, p)),
        ),
    }
    seconds = {}
    for name, (path, run) in inputs.items():
        start = time.perf_counter()
        run(path).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("revlens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog()
    registered["feed_count"].run(spark, sf_dir).collect()  # start-up is not part of any query

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    seconds |= raw_reads(spark, sf_dir)
    extra = {}
    for name, share in (("history_training", True), ("history_training_all_fits", False)):
        fit_seconds, rows, fits = train_history(spark, sf_dir, share)
        seconds[name] = round(fit_seconds, 3)
        extra |= {
            f"{name}_rows": rows,
            f"{name}_fits": fits,
            f"{name}_rows_per_sec": round(rows / fit_seconds, 1),
            f"{name}_rows_per_sec_and_fit": round(rows * fits / fit_seconds, 1),
        }
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                **extra,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
