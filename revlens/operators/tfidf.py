"""Term frequencies and TF-IDF as rows, with hash buckets any engine can reproduce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.keys import hash_bucket
from revlens.functions.text import clean_text, tokens


def term_buckets(df: DataFrame, key: str, text: str, buckets: int) -> DataFrame:
    """(key, bucket, tf). A row's tokens sit in one task, so the map side already sums them up."""
    words = df.select(key, F.explode(tokens(clean_text(F.col(text)))).alias("token"))
    return words.groupBy(key, hash_bucket(F.col("token"), buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("tf")
    )


def tfidf(df: DataFrame, key: str, text: str, buckets: int = 256, min_doc_freq: int = 2) -> DataFrame:
    """(key, bucket, tf, idf, tfidf) with idf = ln((n + 1) / (df + 1)), 0 under ``min_doc_freq``.

    ``bucket_df`` has one row per bucket, so broadcasting it is bounded by ``buckets``. It is summed
    from the same term table, whose shuffle Spark therefore runs once.
    """
    terms = term_buckets(df, key, text, buckets)
    bucket_df = terms.groupBy("bucket").agg(F.count_if(F.col("tf") > 0).alias("doc_freq"))
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    idf = F.when(
        F.col("doc_freq") >= min_doc_freq, F.log((n_docs + 1.0) / (F.col("doc_freq") + 1.0))
    ).otherwise(0.0)
    return (
        terms.join(F.broadcast(bucket_df), "bucket")
        .withColumn("idf", idf)
        .select(key, "bucket", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))
    )
