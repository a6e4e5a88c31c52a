"""Size change of a revision against the revision before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def parent_sizes(revisions: DataFrame) -> DataFrame:
    """One size per revision id, so that repeated revisions cannot multiply their children."""
    return revisions.groupBy(F.col("rev_id").alias("parent_key")).agg(
        F.max("text_bytes").alias("parent_bytes")
    )


def with_parent_size(
    revisions: DataFrame, parents: DataFrame | None = None, keep_unknown: bool = False
) -> DataFrame:
    """Adds ``parent_bytes`` and ``length_delta`` by an equi self-join on the parent id.

    Page creations (no parent, or parent 0) can be a large share of all rows. They get a key of
    their own that matches nothing, which spreads them over all partitions instead of sending every
    NULL to one. ``parents`` may be a written table of ``parent_sizes``: its scan then feeds the join
    directly and AQE can split a hot parent. With ``keep_unknown`` a missing parent stays NULL.
    """
    parents = parent_sizes(revisions) if parents is None else parents
    no_parent = F.coalesce(F.col("parent_rev_id").isin("", "0"), F.lit(True))
    keyed = revisions.withColumn(
        "parent_key",
        F.when(no_parent, F.concat(F.lit("new:"), "rev_id")).otherwise(F.col("parent_rev_id")),
    )
    base = F.col("parent_bytes") if keep_unknown else F.coalesce("parent_bytes", F.lit(0))
    return (
        keyed.join(parents, "parent_key", "left")
        .drop("parent_key")
        .withColumn("parent_bytes", base.cast("bigint"))
        .withColumn("length_delta", (F.col("text_bytes") - F.col("parent_bytes")).cast("double"))
    )


def with_placeholder_parent(revisions: DataFrame) -> DataFrame:
    """The published placeholder: every parent has size 0."""
    return revisions.withColumn("parent_bytes", F.lit(0).cast("bigint")).withColumn(
        "length_delta", F.col("text_bytes").cast("double")
    )


def with_previous(
    df: DataFrame,
    page: str,
    order: str,
    value: str,
    output: str,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """``lag(value)`` per page in the order of a unique integer id.

    Rows without a page have no previous row; each gets a page of its own, so they spread.
    One page may hold a large part of all rows. Pages of more than ``hot_rows`` rows are cut into
    ranges of ``hot_rows`` ids: ids are unique, so that bounds every window group. Only the first row
    of a range needs the last value of the page's previous non-empty range, which comes from one row
    per range. At most rows / ``hot_rows`` pages can be that large, which bounds the broadcast; without
    any, the later join is against nothing and AQE drops it.
    """
    alone = F.concat(F.lit("no page:"), F.col(order).cast("string"))
    known = F.concat(F.lit("page:"), F.col(page).cast("string"))
    df = df.withColumn("_page", F.coalesce(known, alone))
    hot = (
        df.groupBy("_page")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select("_page", F.lit(True).alias("_hot"))
    )
    cut = F.when(F.col("_hot"), F.expr(f"`{order}` div {hot_rows}")).otherwise(F.lit(0))
    marked = df.join(F.broadcast(hot), "_page", "left")
    ranged = marked.withColumn("_range", cut.cast("bigint"))
    last = (
        ranged.filter(F.col("_hot"))
        .groupBy("_page", "_range")
        .agg(F.max_by(value, order).alias("_last"))
    )
    carried = last.select(
        "_page", "_range", F.lag("_last").over(W.partitionBy("_page").orderBy("_range")).alias("_carried")
    )
    local = W.partitionBy("_page", "_range").orderBy(order)
    return (
        ranged.withColumn("_first", F.row_number().over(local) == 1)
        .withColumn("_local", F.lag(value).over(local))
        .join(carried, ["_page", "_range"], "left")
        .withColumn(output, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_local")))
        .drop("_page", "_hot", "_range", "_first", "_local", "_carried")
    )


def delta_or_zero(new: Column, old: Column, per_side: bool = True) -> Column:
    """Length change of an event: a missing side counts as 0, or (``per_side=False``) the whole does."""
    if per_side:
        return (F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))).cast("double")
    return F.coalesce((new - old).cast("double"), F.lit(0.0))
