"""Tables written batch by batch, folded into generations: versions of days, named by a committed manifest.

A generation is a list of day folders that never change. A fold writes new folders for the days it
touches, then a manifest that names them next to the untouched ones, then a mark that commits it.
Readers take the newest committed manifest and the batches behind it. What a fold replaces goes only
with the fold after it, so a read that began before a fold ends right.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.feed import feed_directory
from revlens.operators.tables import latest_by_key
from revlens.schemas import PREDICTION
from revlens.session import commit_mark, drop_folder, folder_names, job_scratch, mark_exists, stage_table
from revlens.streaming.scorer import event_key

NO_DAY = "none"
#: Ids that are sent to every task to find their older rows; more are joined with a shuffle.
SENT_IDS = 1_000_000
_BATCH = (T.StructField("stream_id", T.StringType()), T.StructField("batch_id", T.LongType()))


def _day(text: Column) -> Column:
    day = F.substring(text, 1, 10)
    return F.when(day.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), day).otherwise(NO_DAY)


@dataclass(frozen=True)
class Kind:
    """What one row per key means for a table: key, day, which row is the newest, folders of a batch."""

    columns: T.StructType
    key: Callable[[], Column]
    day: Callable[[], Column]
    newest: Callable[[], list[Column]]
    folders: tuple[str, ...] = ("stream_id", "batch_id")


def predictions_kind() -> Kind:
    """An edit's newest row, a scored one before a pending one; days by the edit's own time, else by its row's."""
    return Kind(
        PREDICTION,
        lambda: F.col("id"),
        lambda: _day(F.coalesce(F.nullif(F.col("timestamp"), F.lit("")), F.col("created_at"))),
        lambda: [F.desc("created_at"), F.desc("scored"), F.desc("batch_id"), F.desc("stream_id")],
    )


def archive_kind(columns: T.StructType) -> Kind:
    """An event's newest row by event time; days are the archive's own."""
    return Kind(
        columns,
        event_key,
        lambda: _day(F.date_format("event_time", "yyyy-MM-dd")),
        lambda: [F.desc("event_time"), F.desc("stream_id"), F.desc("batch_id")],
        ("date", "stream_id", "batch_id"),
    )


# ---- manifests ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """Folders of the days, the last folded batch of each stream, and where the manifest's tables lie."""

    number: int
    path: str
    days: dict[str, str]
    folded: dict[str, int]


def _manifest_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/manifests/m-{number:010d}"


def committed(spark: SparkSession, root: str) -> list[int]:
    names = folder_names(spark, f"{root.rstrip('/')}/manifests", "m-")
    return sorted(int(n[2:]) for n in names if mark_exists(spark, f"{_manifest_path(root, int(n[2:]))}/_COMMITTED"))


def read_manifest(spark: SparkSession, root: str, number: int | None = None) -> Manifest | None:
    """The newest committed manifest, or a given one; one row per day and per stream reach the driver."""
    numbers = committed(spark, root)
    if not numbers:
        return None
    number = numbers[-1] if number is None else number
    path = _manifest_path(root, number)
    days = spark.read.schema("day string, folder string").parquet(f"{path}/days").collect()
    folded = spark.read.schema("stream_id string, batch_id bigint").parquet(f"{path}/folded").collect()
    return Manifest(number, path, {r["day"]: r["folder"] for r in days}, {r["stream_id"]: r["batch_id"] for r in folded})


# ---- reading --------------------------------------------------------------------------------


def _folded_rows(spark: SparkSession, kind: Kind, manifest: Manifest | None, days: list[str] | None = None) -> DataFrame:
    layout = T.StructType([*kind.columns.fields, *_BATCH])
    folders = [] if manifest is None else [f for d, f in sorted(manifest.days.items()) if days is None or d in days]
    if not folders:
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(*folders).select(*layout.fieldNames())


def _live_rows(spark: SparkSession, kind: Kind, live: str, manifest: Manifest | None) -> DataFrame:
    """Rows of the batches that no generation holds yet; the folders of others are not read."""
    layout = T.StructType([*kind.columns.fields, *_BATCH])
    if not folder_names(spark, live, ""):
        return spark.createDataFrame([], layout)
    rows = spark.read.schema(layout).parquet(live)
    for stream, batch in (manifest.folded if manifest else {}).items():
        rows = rows.filter((F.col("stream_id") != stream) | (F.col("batch_id") > batch))
    return rows.select(*layout.fieldNames())


def _newest(rows: DataFrame, kind: Kind) -> DataFrame:
    keyed = rows.withColumn("_key", kind.key())
    return latest_by_key(keyed, ["_key"], kind.newest()).drop("_key")


def _with_keys(rows: DataFrame, kind: Kind, keys: DataFrame, many: int, how: str) -> DataFrame:
    """Rows whose key is (``left_semi``) or is not (``left_anti``) among ``keys``; their order in the plan stays."""
    keys = F.broadcast(keys) if many <= SENT_IDS else keys
    return rows.withColumn("_key", kind.key()).join(keys, "_key", how).drop("_key")


def read_current(spark: SparkSession, kind: Kind, root: str, live: str) -> DataFrame:
    """One row per key of the newest generation and the batches behind it.

    Rows of a generation are unique. Those whose key a later batch has again are few and meet these
    batches; all others are passed through without a shuffle.
    """
    manifest = read_manifest(spark, root)
    later = stage_table(_live_rows(spark, kind, live, manifest), "later-batches")
    keys = stage_table(later.select(kind.key().alias("_key")).distinct(), "later-keys")
    many = keys.count()
    folded = _folded_rows(spark, kind, manifest)
    met = _with_keys(folded, kind, keys, many, "left_semi")
    alone = _with_keys(folded, kind, keys, many, "left_anti")
    return alone.unionByName(_newest(later.unionByName(met), kind)).select(*kind.columns.fieldNames())


# ---- folding --------------------------------------------------------------------------------


def totals_of(predictions: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Sums that add up over any parts of a table: by wiki, band and state of scoring, and ``more`` columns."""
    score = F.col("risk_score")
    return predictions.groupBy(*more, "wiki", "risk_label", "scored").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(score).alias("n_scores"),
        F.coalesce(F.sum(score.cast("decimal(38,18)")), F.lit(0).cast("decimal(38,18)")).cast("decimal(38,18)").alias("score_sum"),
        F.count_if((F.col("scored") == 1) & score.isNotNull()).alias("n_done"),
        F.max("created_at").alias("last"),
    )


def _write(rows: DataFrame, path: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def _touched(rows: DataFrame, kind: Kind) -> list[str]:
    return sorted(r[0] for r in rows.select(kind.day().alias("day")).distinct().collect())  # one row per day


def fold(spark: SparkSession, kind: Kind, live: str, root: str) -> Manifest | None:
    """Folds finished batches into a new generation and returns its manifest; without any it writes nothing.

    A stream's newest batch may be written again after a failure, so it stays where it is. Days are
    rewritten if new rows fall on them or if they hold an older row of a key that comes again; a key's
    rows are looked for in all days, by the key's columns alone. What the generation before the last
    one used, and batches that the last one had folded already, are dropped at the end.
    """
    root, live = root.rstrip("/"), live.rstrip("/")
    manifest = read_manifest(spark, root)
    if not folder_names(spark, live, ""):
        return manifest
    with job_scratch(spark, root):
        batches = spark.read.parquet(live).select(
            *[F.col(c).cast("bigint" if c == "batch_id" else "string").alias(c) for c in kind.folders]
        )
        batches = [tuple(r) for r in batches.distinct().collect()]  # a row per folder that is still there
        seen = {s: max(b for *_, t, b in batches if t == s) for *_, s, _ in batches}
        folded = dict(manifest.folded) if manifest else {}
        upto = {s: b for s, b in ((s, max([b for *_, t, b in batches if t == s and b < newest], default=-1)) for s, newest in seen.items())}
        fresh = {s: b for s, b in upto.items() if b > folded.get(s, -1)}
        if not fresh:
            return manifest
        rows = _live_rows(spark, kind, live, manifest)
        new = rows.filter("false")
        for stream, batch in fresh.items():
            new = new.unionByName(rows.filter((F.col("stream_id") == stream) & (F.col("batch_id") <= batch)))
        new = stage_table(_newest(new, kind), "folded-batches")
        keys = stage_table(new.select(kind.key().alias("_key")).distinct(), "folded-keys")
        old = _with_keys(_folded_rows(spark, kind, manifest), kind, keys, keys.count(), "left_semi")
        days = sorted({*_touched(new, kind), *_touched(old, kind)})
        merged = _newest(new.unionByName(_folded_rows(spark, kind, manifest, days)), kind)
        number = (manifest.number if manifest else -1) + 1
        while folder_names(spark, _manifest_path(root, number), ""):
            number += 1  # left by a fold that did not end
        data = f"{root}/days/g-{number:010d}"
        merged = merged.withColumn("day", kind.day())
        merged.repartitionByRange("day", kind.key()).sortWithinPartitions("day").write.mode("errorifexists").partitionBy("day").parquet(data)
        written = {n.split("=", 1)[1]: f"{data}/{n}" for n in folder_names(spark, data, "day=")}
        kept = {d: f for d, f in (manifest.days if manifest else {}).items() if d not in days}
        path = _manifest_path(root, number)
        _write(spark.createDataFrame(sorted({**kept, **written}.items()), "day string, folder string"), f"{path}/days")
        _write(spark.createDataFrame(sorted({**folded, **fresh}.items()), "stream_id string, batch_id bigint"), f"{path}/folded")
        if kind.columns == PREDICTION:
            layout = T.StructType([*kind.columns.fields, T.StructField("day", T.StringType())])
            touched = spark.read.schema(layout).parquet(data)
            for name, parts in (("totals", totals_of(touched, ("day",))), ("directory", feed_directory(touched, more=("day",)))):
                if kept:
                    before = spark.read.parquet(f"{manifest.path}/{name}")
                    parts = parts.unionByName(before.filter(F.col("day").isin(*kept)))
                _write(parts, f"{path}/{name}")
        commit_mark(spark, f"{path}/_COMMITTED")
        _retire(spark, kind, live, root, manifest, number, batches)
    return read_manifest(spark, root, number)


def _retire(spark: SparkSession, kind: Kind, live: str, root: str, last: Manifest | None, number: int, batches: list[tuple]) -> None:
    """Drops what neither this generation nor the last one reads."""
    if last is None:
        return
    current = read_manifest(spark, root, number)
    used = {*current.days.values(), *last.days.values()}
    for generation in folder_names(spark, f"{root}/days", "g-"):
        folder = f"{root}/days/{generation}"
        mine = {f for f in used if f.startswith(f"{folder}/")}
        if not mine:
            drop_folder(spark, folder)
            continue
        for day in folder_names(spark, folder, "day="):
            if f"{folder}/{day}" not in mine:
                drop_folder(spark, f"{folder}/{day}")
    for other in committed(spark, root):
        if other < last.number:
            drop_folder(spark, _manifest_path(root, other))
    for batch in batches:
        stream, at = batch[-2], batch[-1]
        if at <= last.folded.get(stream, -1):
            drop_folder(spark, live + "".join(f"/{c}={v}" for c, v in zip(kind.folders, batch)))


# ---- totals ---------------------------------------------------------------------------------


def _signed(totals: DataFrame, sign: int) -> DataFrame:
    return totals.withColumns({c: (F.col(c) * sign).cast(totals.schema[c].dataType) for c in ("n_rows", "n_scores", "score_sum", "n_done")})


def current_totals(spark: SparkSession, root: str, live: str) -> DataFrame:
    """``totals_of`` the current table without reading the rows of its generation.

    The generation's sums by day, less those of its rows whose edit a later batch has again, plus those
    of what counts now of these batches and rows. Of the generation only the ids are looked through,
    and the rows of those ids are read.
    """
    kind = predictions_kind()
    manifest = read_manifest(spark, root)
    later = stage_table(_live_rows(spark, kind, live, manifest), "later-batches")
    keys = stage_table(later.select(kind.key().alias("_key")).distinct(), "later-keys")
    met = stage_table(_with_keys(_folded_rows(spark, kind, manifest), kind, keys, keys.count(), "left_semi"), "superseded")
    parts = totals_of(_newest(later.unionByName(met), kind)).unionByName(_signed(totals_of(met), -1))
    if manifest is not None:
        parts = parts.unionByName(spark.read.parquet(f"{manifest.path}/totals").drop("day"))
    groups = parts.groupBy("wiki", "risk_label", "scored").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("n_rows", "n_scores")],
        F.sum("score_sum").cast("decimal(38,18)").alias("score_sum"),
        F.sum("n_done").cast("bigint").alias("n_done"),
        F.max("last").alias("last"),
    )
    return groups.filter("n_rows > 0")


def _mean() -> Column:
    return (F.sum("score_sum") / F.nullif(F.sum("n_scores"), F.lit(0))).cast("double")


def feed_stats(totals: DataFrame) -> DataFrame:
    """As ``stats.feed_stats``, from totals. A newer stamp of a replaced row counts as an update."""
    from revlens.functions.numbers import round_exact

    def of(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0))

    band = F.col("risk_label")
    return totals.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_edits"),
        of(band == "HIGH").alias("high_risk"),
        of(band == "MEDIUM").alias("medium_risk"),
        of(band == "LOW").alias("low_risk"),
        of(F.col("scored") == 0).alias("unscored"),
        F.coalesce(round_exact(_mean(), 4), F.lit(0.0)).alias("avg_risk_score"),
        F.coalesce(F.max("last"), F.lit("")).alias("last_updated"),
    )


def band_summary(totals: DataFrame) -> DataFrame:
    """As ``stats.band_summary``, from totals."""
    from revlens.functions.numbers import round_exact

    found = totals.groupBy("risk_label").agg(F.sum("n_rows").alias("n_rows"), round_exact(_mean(), 3).alias("avg_score"))
    return found.orderBy(F.desc("avg_score"), "risk_label")


def scoring_progress(totals: DataFrame) -> DataFrame:
    """As ``stats.scoring_progress``, from totals."""
    done, total = F.coalesce(F.sum("n_done"), F.lit(0)), F.coalesce(F.sum("n_rows"), F.lit(0))
    return totals.agg(done.alias("already_scored"), total.alias("total_edits"), ((done == total) & (total > 0)).alias("complete"))


def stored_directory(spark: SparkSession, root: str) -> DataFrame:
    """The counts for ``feed_page`` of the newest generation."""
    return spark.read.parquet(f"{read_manifest(spark, root).path}/directory").drop("day")
