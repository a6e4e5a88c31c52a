"""Text search by an inverted index of character trigrams."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.feed import SEARCHED, feed_filter

GRAM = 3
#: Rows of a block, and the rarest trigrams of a text whose postings are intersected.
BLOCK_ROWS, PROBED = 50_000, 4
#: Candidates that are sent to every task; beyond, blocks are joined with a shuffle.
SENT_ROWS = 1_000_000


def grams(text: str) -> list[str]:
    """The distinct trigrams of a text in lower case; none if it is shorter."""
    low = text.lower()
    return sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})


def build_index(predictions: DataFrame, path: str, block_rows: int = BLOCK_ROWS) -> None:
    """Writes the rows in blocks, the postings of their trigrams, and how many postings each trigram has.

    A block is a stretch of time; its rows have a number in it. Postings name block and row. The task that
    reads a stretch of blocks makes and keeps their postings, in order of trigram: none is moved, a trigram
    that every row has is many tasks and files, and a search reads its trigrams' pages of each file. Rows
    of a NULL id, repeated ids and NULL texts are rows like others.
    """
    spark = predictions.sparkSession
    many = max(1, -(-predictions.count() // block_rows))
    order = [F.desc_nulls_last("created_at"), F.desc_nulls_last("id"), F.xxhash64(*predictions.columns)]
    rows = predictions.repartitionByRange(many, *order).withColumns(
        {"block": F.spark_partition_id(), "row": F.monotonically_increasing_id()}
    )
    rows.write.mode("errorifexists").partitionBy("block").parquet(f"{path}/rows")
    stored = read_rows(spark, path, predictions.schema)
    low = F.filter(F.array(*[F.lower(c) for c in SEARCHED]), lambda t: F.length(t) >= GRAM)

    def parts(text):
        return F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.substring(text, i, F.lit(GRAM)))

    gram = F.explode(F.array_distinct(F.flatten(F.transform(low, parts)))).alias("gram")
    postings = stored.select(gram, "block", "row").sortWithinPartitions("gram")
    postings.write.mode("errorifexists").parquet(f"{path}/postings")
    counts = spark.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts.repartitionByRange("gram").sortWithinPartitions("gram").write.mode("errorifexists").parquet(f"{path}/counts")


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    layout = T.StructType([*schema.fields, T.StructField("row", T.LongType()), T.StructField("block", T.IntegerType())])
    return spark.read.schema(layout).parquet(f"{path}/rows")


def literal_parts(search: str, wildcards: bool) -> list[str]:
    """The pieces of a search that a text must hold as they are."""
    return [p for p in re.split("[%_]", search) if p] if wildcards else [search]


def candidates(spark: SparkSession, path: str, search: str, wildcards: bool = False, probed: int = PROBED) -> DataFrame | None:
    """``block`` and ``row`` of the rows that hold the rarest trigrams of a search, in whatever column.

    Only the postings of these trigrams are read. None if the search has no trigram: then all rows are
    candidates. A trigram of which there is no posting leaves none.
    """
    wanted = sorted({g for part in literal_parts(search, wildcards) for g in grams(part)})
    if not wanted:
        return None
    counts = spark.read.parquet(f"{path}/counts").filter(F.col("gram").isin(wanted))
    known = {r["gram"]: r["n"] for r in counts.collect()}  # one row per trigram of the search
    rarest = sorted(wanted, key=lambda g: (known.get(g, 0), g))[:probed]
    if rarest[0] not in known:
        return spark.createDataFrame([], "block int, row long")
    postings = spark.read.parquet(f"{path}/postings").filter(F.col("gram").isin(rarest))
    held = postings.groupBy("block", "row").agg(F.count(F.lit(1)).alias("n"))
    held = held.filter(F.col("n") == len(rarest)).select("block", "row")
    return F.broadcast(held) if known[rarest[0]] <= SENT_ROWS else held


def search_index(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    search: str,
    wiki: str = "enwiki",
    risk_label: str | None = None,
    scored_only: bool = False,
    wildcards: bool = False,
    rows: DataFrame | None = None,
) -> DataFrame:
    """What ``feed_filter`` with this search finds, by the index.

    ``rows`` is what ``read_rows`` gave for this index: several searches then list its blocks once.

    Candidates are the rows whose columns hold all probed trigrams together; the filter itself verifies
    them. Blocks without candidates are not read. A search of less than three characters reads all rows.
    """
    rows = read_rows(spark, path, schema) if rows is None else rows
    found = candidates(spark, path, search.strip(), wildcards)
    if found is not None:
        rows = rows.join(found, ["block", "row"], "left_semi")
    return feed_filter(rows, wiki, risk_label, scored_only, search, wildcards).select(*schema.fieldNames())
