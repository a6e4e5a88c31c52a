"""Revisions out of MediaWiki XML exports, plain or bz2.

The text reader splits files (bz2 too) and cuts records at ``</revision>``. A record therefore never
grows with the length of a page's history, which for busy pages exceeds what one string can hold.
Page title, namespace and id stand once, before the page's first revision; they are carried forward
to the page's later revisions, within a file split by a window and across splits by one summary row
per split.

Most of a record is the revision's text, of which only the size is wanted. It is cut off at its tag
and the size read from the tag; the body goes through an XML parser only where that size is broken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from revlens.functions.authors import is_anon
from revlens.schemas import REVISION
from revlens.session import stage_table

# every leaf is text: one malformed number must not void the record
_PAGE = "title string, ns string, id string"
_REVISION = (
    "id string, parentid string, timestamp string, contributor struct<username:string,ip:string>, "
    "comment string"
)
_BODY = "text struct<_bytes:string,_VALUE:string>"
_SPLIT = ["_file", "_split"]


def _strip(column: Column) -> Column:
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def revision_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per ``<revision>`` with its place in the files and, on a page's first one, the page."""
    chunks = spark.read.option("lineSep", "</revision>").text(paths)
    body = F.substring_index("value", "<revision>", -1)
    head = F.substring_index(F.substring_index("value", "<page>", -1), "<revision>", 1)
    options = {"attributePrefix": "_", "valueTag": "_VALUE", "ignoreSurroundingSpaces": "false"}
    page = F.from_xml(F.concat(F.lit("<page>"), head, F.lit("</page>")), _PAGE, options)

    def revision(inner: Column, schema: str) -> Column:
        return F.from_xml(F.concat(F.lit("<revision>"), inner, F.lit("</revision>")), schema, options)

    text_tag = F.substring_index(F.substring_index(F.concat(body, F.lit("<text")), "<text", 2), "<text", -1)
    stated = F.trim(F.regexp_extract(F.substring_index(text_tag, ">", 1), r"""\sbytes=["']([^"']*)""", 1))
    measured = F.octet_length(F.coalesce(revision(body, _BODY)["text"]["_VALUE"], F.lit("")))
    text_bytes = (
        F.when(stated == "", F.lit(0).cast("bigint"))
        .when(stated.try_cast("bigint").isNotNull(), stated.try_cast("bigint"))
        .otherwise(measured.cast("bigint"))
    )
    located = chunks.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_seq"),
    ).filter(F.contains("value", F.lit("<revision>")))
    parsed = located.select(
        *_SPLIT,
        "_seq",
        F.when(F.contains("value", F.lit("<page>")), page).alias("_page"),
        revision(F.substring_index(body, "<text", 1), _REVISION).alias("r"),
        text_bytes.alias("text_bytes"),
    )
    user = F.coalesce(F.col("r.contributor.ip"), F.col("r.contributor.username"), F.lit(""))
    return parsed.select(
        *_SPLIT,
        "_seq",
        "_page",
        F.coalesce(F.col("r.id"), F.lit("")).alias("rev_id"),
        F.coalesce(F.col("r.parentid"), F.lit("")).alias("parent_rev_id"),
        F.coalesce(F.col("r.timestamp"), F.lit("")).alias("timestamp"),
        user.alias("contributor_username"),
        (F.col("r.contributor.ip").isNotNull() | is_anon(user)).alias("is_anon"),
        _strip(F.coalesce(F.col("r.comment"), F.lit(""))).alias("comment"),
        "text_bytes",
    )


def with_page(records: DataFrame) -> DataFrame:
    """Carries each page's title, namespace and id to all its revisions."""
    order = W.partitionBy(*_SPLIT).orderBy("_seq")
    own = F.last("_page", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    # last page named in each split, then the last one named in any split before it
    named = records.groupBy(*_SPLIT).agg(
        F.max_by("_page", F.when(F.col("_page").isNotNull(), F.col("_seq"))).alias("_last")
    )
    earlier = W.partitionBy("_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    carried = named.select(*_SPLIT, F.last("_last", ignorenulls=True).over(earlier).alias("_prev"))
    return (
        records.withColumn("_own", own)
        .join(carried, _SPLIT, "left")
        .withColumn("_p", F.coalesce("_own", "_prev"))
        .select(
            F.coalesce("_p.id", F.lit("")).alias("page_id"),
            _strip(F.coalesce("_p.title", F.lit(""))).alias("page_title"),
            F.coalesce(F.trim("_p.ns").try_cast("int"), F.lit(0)).alias("namespace"),
            *REVISION.fieldNames()[3:],
        )
    )


def read_revisions(spark: SparkSession, paths: str | list[str], staged: bool = True) -> DataFrame:
    """Revisions of one or more dumps.

    The carry reads the records twice. ``staged`` writes them once to the shared folder, so large
    dumps are decompressed and parsed a single time.
    """
    records = revision_records(spark, paths)
    return with_page(stage_table(records, "xml-records") if staged else records)


def count_revisions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Revision tags per file."""
    lines = spark.read.text(paths).filter(F.contains("value", F.lit("<revision>")))
    tags = F.size(F.split("value", "<revision>")) - 1
    return lines.groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.sum(tags.cast("bigint")).alias("revisions")
    )
