"""Line dedup: lines that too many pages of one site share are boilerplate and go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import send_if_small, spare_name, staged

#: A line on more than this share of a site's pages is boilerplate, ...
RATIO = 0.01
#: ... if at least this many pages of the site have it.
MIN_PAGES = 5


def _key(line: Column) -> Column:
    """Lines are the same if they are without spaces around; blank ones (NULL) are never boilerplate."""
    bare = F.trim(line)
    return F.when(bare != "", F.md5(bare))


def host(url: Column | str) -> Column:
    """Site of a page's address, for tables that have one."""
    return F.lower(F.parse_url(F.col(url) if isinstance(url, str) else url, F.lit("HOST")))


def boilerplate(
    pages: DataFrame, site_col: str, text_col: str, ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``site``, ``keys``: digests of each site's boilerplate lines, for sites that have any.

    A page counts once for a line however often it has it. Counting starts within the tasks, so a
    site with a third of all pages sends one row per line and task. A site has at most
    (lines per page / ``ratio``) such lines.
    """
    rows = pages.select(F.col(site_col).alias("site"), F.col(text_col).alias("text"))
    on_pages = (
        rows.select("site", F.explode(F.array_distinct(F.transform(F.split("text", "\n", -1), _key))).alias("line"))
        .where("line is not null")
        .groupBy("site", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    sites = rows.groupBy("site").agg(F.count(F.lit(1)).alias("total"))
    return (
        on_pages.join(sites.withColumnRenamed("site", "of"), F.col("site").eqNullSafe(F.col("of")))
        .where(F.col("n") / F.col("total") > ratio)
        .groupBy("site")
        .agg(F.collect_list("line").alias("keys"))
    )


def _with_keys(
    pages: DataFrame, site_col: str, text_col: str, ratio: float, min_pages: int
) -> tuple[DataFrame, str]:
    """The pages with their site's boilerplate digests in a column of a free name."""
    found = staged(boilerplate(pages, site_col, text_col, ratio, min_pages), "boilerplate")
    sites, keys = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()
    name, of = spare_name(pages, "keys"), spare_name(pages, "of")
    found = send_if_small(found.select(F.col("site").alias(of), F.col("keys").alias(name)), 1, 64 * (sites + keys))
    return pages.join(found, pages[site_col].eqNullSafe(found[of]), "left").drop(of), name


def _kept(text: Column, keys: Column) -> Column:
    return F.filter(
        F.split(text, "\n", -1),
        lambda line: ~F.coalesce(F.array_contains(F.coalesce(keys, F.array().cast("array<string>")), _key(line)), F.lit(False)),
    )


def drop_boilerplate(
    pages: DataFrame,
    site_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """The same rows and columns, boilerplate lines taken out of the text.

    The rest keeps its order; a text of boilerplate only becomes empty. A NULL text stays NULL and
    counts as a page without lines; rows of a NULL site are a site of their own; repeated rows each
    count as a page. Every other column comes back as it is, whatever its name. No rows, no rows.
    """
    rows, keys = _with_keys(pages, site_col, text_col, ratio, min_pages)
    left = F.array_join(_kept(F.col(text_col), F.col(keys)), "\n")
    return rows.select(*[left.alias(c) if c == text_col else F.col(f"`{c}`") for c in pages.columns])


def line_report(
    pages: DataFrame,
    id_col: str = "doc_id",
    site_col: str = "source",
    text_col: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Id, ``n_lines``, ``n_dropped`` and ``kept_md5`` (of the text without boilerplate) per row.

    Rows as in ``drop_boilerplate``; a NULL text has no lines and a NULL digest.
    """
    rows, keys = _with_keys(pages.select(id_col, site_col, text_col), site_col, text_col, ratio, min_pages)
    lines = F.coalesce(F.size(F.split(text_col, "\n", -1)), F.lit(0)).cast("long")
    return rows.select(
        F.col(id_col),
        F.greatest(lines, F.lit(0)).alias("n_lines"),
        _kept(F.col(text_col), F.col(keys)).alias("kept"),
    ).select(
        id_col,
        "n_lines",
        F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.md5(F.array_join("kept", "\n")).alias("kept_md5"),
    )
