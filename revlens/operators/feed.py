"""Questions of the monitoring feed over the predictions table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlens.functions import times
from revlens.functions.numbers import fixed, percent, round_exact
from revlens.functions.text import missing

SEARCHED = ("page_title", "comment", "user", "rev_id")
MAX_PAGE_SIZE = 200
MAX_SEARCH = 120


def feed_filter(
    predictions: DataFrame,
    wiki: str = "enwiki",
    risk_label: str | None = None,
    scored_only: bool = False,
    search: str | None = None,
    wildcards: bool = False,
) -> DataFrame:
    """Rows of one wiki, optionally of one band, scored, and containing a text in any searched column.

    ``wildcards`` lets ``%`` and ``_`` in the search act as in SQL ``LIKE``.
    """
    if risk_label and not re.fullmatch("(?i)high|medium|low", risk_label):
        raise ValueError(f"unknown risk label {risk_label!r}")
    if search is not None and not 1 <= len(search) <= MAX_SEARCH:
        raise ValueError(f"search must have 1 to {MAX_SEARCH} characters")
    kept = predictions.filter(F.col("wiki") == wiki)
    if risk_label:
        kept = kept.filter(F.col("risk_label") == risk_label.upper())
    if scored_only:
        kept = kept.filter(F.col("scored") == 1)
    if search:
        kept = kept.filter(_matches(search.strip(), wildcards))
    return kept


def _matches(search: str, wildcards: bool) -> Column:
    hit = F.lit(False)
    for name in SEARCHED:
        value = F.col(name)
        hit = hit | (
            value.ilike(f"%{search}%") if wildcards else F.lower(value).contains(search.lower())
        )
    return hit


def dashboard_search(risk_choice: str, search: str) -> dict[str, str | None]:
    """Filter arguments of the dashboard: a chosen band switches the text search off."""
    everything = risk_choice == "All"
    text = search.strip()
    return {
        "risk_label": None if everything else risk_choice,
        "search": text if everything and text else None,
    }


def _newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("created_at"), F.desc("id"))


#: Rows of a bucket that a page is cut from; a bucket of more is divided further.
BUCKET_ROWS = 5_000
#: Lengths of the stamp's beginnings that divide the feed: day, hour, minute, second, all of it.
STAMP_LENGTHS = (10, 13, 16, 19, 26)
_COUNTED = ("wiki", "risk_label", "scored")


def feed_directory(predictions: DataFrame, length: int = 13, more: tuple[str, ...] = ()) -> DataFrame:
    """How many rows of each wiki, band and state of scoring every stretch of time holds.

    ``bucket`` is the beginning of ``created_at``, by default down to the hour. Kept with a generation
    of the table it tells a page's place without a look at the rows. ``more`` columns divide the counts.
    """
    bucket = F.substring("created_at", 1, length).alias("bucket")
    return predictions.groupBy(*more, bucket, *_COUNTED).agg(F.count(F.lit(1)).alias("n_rows"))


def _holding(counts: DataFrame, skip: int) -> tuple[str | None, int, int] | None:
    """The bucket that holds the row at place ``skip``, the rows before it, and its own.

    ``counts`` has one row per bucket (``bucket``, ``n``); NULL, if there is one, is the last.
    """
    order = W.orderBy(F.desc_nulls_last("bucket")).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = counts.withColumn("upto", F.sum("n").over(order)).filter(F.col("upto") > skip)
    row = placed.orderBy("upto").select("bucket", (F.col("upto") - F.col("n")).alias("before"), "n").first()
    return None if row is None else (row["bucket"], row["before"], row["n"])


def _in_bucket(name: str, start: str | None, length: int | None) -> Column:
    """Rows whose text has that beginning, as a range that a scan can skip files by.

    A beginning shorter than ``length`` is the whole text.
    """
    if start is None:
        return F.col(name).isNull()
    if length is None or len(start) < length:
        return F.col(name) == start
    return (F.col(name) >= start) & F.col(name).startswith(start)


def _behind(name: str, start: str | None) -> Column:
    """Rows that stand behind a bucket."""
    return F.lit(False) if start is None else F.col(name).isNull() | (F.col(name) < start)


def _level(matching: DataFrame, name: str, length: int | None, skip: int) -> tuple[str | None, int, int] | None:
    part = F.col(name) if length is None else F.substring(name, 1, length)
    return _holding(matching.groupBy(part.alias("bucket")).agg(F.count(F.lit(1)).alias("n")), skip)


def page_start(
    matching: DataFrame, skip: int, directory: DataFrame | None = None, directory_length: int = 13
) -> tuple[Column, int, int] | None:
    """Where the row at place ``skip`` is: a condition for all rows from its bucket on, the place of the
    bucket's first row, the bucket's rows. None if there are no so many rows.

    Rows are counted by the beginnings of their stamps (those of the hour, if a directory has them),
    then, where a bucket is too large, by longer ones, and under one stamp by beginnings of the id. Each
    count reads only the rows of the bucket before it.
    """
    before, size = 0, BUCKET_ROWS + 1
    held = rest = F.lit(True)
    levels: list[int | None] = [*STAMP_LENGTHS, None]
    counts = directory
    if counts is not None:
        levels = [directory_length, *[n for n in STAMP_LENGTHS if n > directory_length], None]
    while levels and size > BUCKET_ROWS:
        length = levels.pop(0)
        if counts is None:
            found = _level(matching.filter(held), "created_at", length, skip - before)
        else:
            found = _holding(counts.groupBy("bucket").agg(F.sum("n_rows").alias("n")), skip)
            counts = None
        if found is None:
            return None
        start, size, before = found[0], found[2], before + found[1]
        held = _in_bucket("created_at", start, length)
        rest = held | _behind("created_at", start)
        if start is None or length is None or len(start) < length:
            levels = []  # rows of one stamp
    stamp, behind, length = held, _behind("created_at", start), 0
    while size > BUCKET_ROWS:
        length += 1
        first, more, size = _level(matching.filter(held), "id", length, skip - before)
        before += more
        held = stamp & _in_bucket("id", first, length)
        rest = held | (stamp & _behind("id", first)) | behind
        if first is None or len(first) < length:
            break  # rows of one stamp and one id
    return rest, before, size


def feed_page(
    matching: DataFrame,
    page: int = 1,
    page_size: int = 50,
    directory: DataFrame | None = None,
    directory_length: int = 13,
) -> DataFrame:
    """One page, newest first, rows without a stamp last, ties broken by id.

    The same way at any depth. Counts by stretches of time, from ``directory`` (see ``feed_directory``,
    filtered like the rows) or from a count of the rows, lead to the bucket that the page begins in;
    the page is the first rows from there on, a top-k of at most ``BUCKET_ROWS`` and a page. The table
    is never sorted. Rows of one stamp are divided by their ids; rows alike in both stand in any order.
    ``feed_after`` is the cheaper way to walk on.
    """
    if page < 1 or not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError("page must be >= 1 and page_size between 1 and 200")
    skip = (page - 1) * page_size
    found = page_start(matching, skip, directory, directory_length)
    if found is None:
        return matching.limit(0)
    rest, before, _ = found
    order = [F.desc_nulls_last("created_at"), F.desc_nulls_last("id")]
    top = matching.filter(rest).orderBy(*order).limit(skip - before + page_size)  # no more than a bucket and a page
    numbered = top.withColumn("_at", F.row_number().over(W.orderBy(*order)))
    return numbered.filter(F.col("_at") > skip - before).orderBy("_at").select(*matching.columns)


def feed_after(
    matching: DataFrame, created_at: str | None, id: str, page_size: int = 50
) -> DataFrame:
    """The page after a given row: cost does not grow with depth. Rows without a stamp come last."""
    if created_at is None:
        older = F.col("created_at").isNull() & (F.col("id") < id)
    else:
        older = (
            (F.col("created_at") < created_at)
            | ((F.col("created_at") == created_at) & (F.col("id") < id))
            | F.col("created_at").isNull()
        )
    return _newest_first(matching.filter(older)).limit(page_size)


def feed_count(matching: DataFrame, page: int = 1, page_size: int = 50) -> DataFrame:
    """Total of matching rows and whether pages follow."""
    return matching.agg(F.count(F.lit(1)).alias("total")).select(
        "total",
        F.lit(page).alias("page"),
        F.lit(page_size).alias("page_size"),
        (F.lit(page).cast("bigint") * page_size < F.col("total")).alias("has_more"),
    )


def edit_by_id(predictions: DataFrame, id: str) -> DataFrame:
    return predictions.filter(F.col("id") == id).limit(1)


def pending_oldest(predictions: DataFrame, limit: int = 1) -> DataFrame:
    """Unscored rows, oldest first."""
    return predictions.filter(F.col("scored") == 0).orderBy("created_at", "id").limit(limit)


def first_scored(predictions: DataFrame, limit: int = 100) -> DataFrame:
    """Newest rows that have a score."""
    return _newest_first(predictions.filter(F.col("risk_score").isNotNull())).limit(limit)


# columns a record cannot be without; score and band may be NULL
REQUIRED = (
    "id",
    "rev_id",
    "page_title",
    "namespace",
    "user",
    "comment",
    "length_delta",
    "timestamp",
    "wiki",
    "created_at",
)


def _complete() -> Column:
    ok = F.lit(True)
    for name in REQUIRED:
        ok = ok & F.col(name).isNotNull()
    return ok


def as_records(predictions: DataFrame, fill: bool = False) -> DataFrame:
    """Typed records: flags as booleans, score to four places.

    Rows with a NULL in a required column are dropped (``rejected_records`` lists them); with ``fill``
    only id and title are required and the rest take their defaults.
    """
    if fill:
        predictions = predictions.na.drop(subset=["id", "page_title"]).na.fill(
            {"rev_id": "", "namespace": 0, "user": "", "comment": "", "length_delta": 0.0}
            | {"timestamp": "", "wiki": "enwiki", "created_at": ""}
        )
    flags = {
        c: F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in ("is_anon", "scored")
    }
    return predictions.filter(_complete()).withColumns(
        flags | {"risk_score": round_exact(F.col("risk_score"), 4)}
    )


def rejected_records(predictions: DataFrame) -> DataFrame:
    """Rows ``as_records`` drops."""
    return predictions.filter(~_complete())


def display_rows(predictions: DataFrame, now: Column) -> DataFrame:
    """Dashboard rows with texts for missing values, relative ages and formatted scores."""
    stamp = F.when(missing(F.col("timestamp")), F.col("created_at")).otherwise(F.col("timestamp"))
    score = F.col("risk_score")
    return predictions.select(
        "id",
        F.when(missing(F.col("risk_label")), "UNSCORED").otherwise(F.col("risk_label")).alias("risk"),
        score.alias("score"),
        F.coalesce(fixed(score, 3), F.lit("")).alias("score_text"),
        F.coalesce(percent(score), F.lit("not scored")).alias("percent_text"),
        F.col("page_title").alias("page"),
        F.col("length_delta").alias("delta"),
        F.when(F.coalesce(F.col("is_anon").cast("boolean"), F.lit(False)), "anonymous")
        .otherwise("registered")
        .alias("editor"),
        F.coalesce("comment", F.lit("")).alias("edit_summary"),
        times.age_text(times.iso_time(stamp), now).alias("age"),
        F.coalesce(stamp, F.lit("")).alias("timestamp"),
        F.coalesce("rev_id", F.lit("")).alias("rev_id"),
    )


def edit_details(predictions: DataFrame) -> DataFrame:
    """Headline texts of single edits."""
    score = F.col("risk_score")
    band = F.when(missing(F.col("risk_label")), "UNSCORED").otherwise(F.col("risk_label"))
    return predictions.select(
        "id",
        F.when(missing(F.col("page_title")), "Unknown page")
        .otherwise(F.col("page_title"))
        .alias("title"),
        band.alias("risk"),
        F.coalesce(percent(score), F.lit("not scored")).alias("score_text"),
        F.when(missing(F.col("comment")), "No edit summary provided by the editor.")
        .otherwise(F.col("comment"))
        .alias("summary"),
    )
