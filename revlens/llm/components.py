"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import staged


def _signature(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))
        ).first()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node of the links ``a``, ``b`` (long); smallest node names it.

    Large-star and small-star steps in turn: each hangs the nodes around a node on the smallest of
    them, until every component is a star. The number of rounds grows with the logarithm of the
    longest path. Every step's result is written, so no lineage grows with the rounds, and the
    neighbourhoods' minima are written before they are joined, so that a node with very many links
    is a skewed key of a plain join, which adaptive execution can split. Rows with a NULL end and
    links of a node to itself are no links; such nodes are not returned. No links, no rows.
    """
    links = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "a", "b")
        .toDF("a", "b", "x", "y")
        .where("x <> y")
        .select("a", "b")
        .distinct(),
        "links",
    )
    before = _signature(links)
    while before[0]:
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least"
        )
        large = staged(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
            "large-star",
        )
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        links = staged(
            large.join(least, "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct(),
            "small-star",
        )
        after = _signature(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)
