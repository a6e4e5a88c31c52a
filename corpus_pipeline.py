"""The corpus pipeline: toxic documents go, boilerplate lines go, near copies go, secrets are masked,
and what is left is packed into token sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import linededup, packing, secrets, simhash, toxicity
from revlens.llm.common import read, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay as they are."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")), "text", 0.5)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that over 1 % of a source's documents share are cut; every document stays."""
    return _measured(linededup.drop_boilerplate(docs, "source", "text", ratio=0.01, min_pages=5))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 4 or fewer differing bits, the one of the smallest id stays."""
    return simhash.drop_near_duplicates(docs, "doc_id", "text", words_per_shingle=4, max_bits=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    model, dictionary = secrets.fit(docs)
    return _measured(secrets.redact(docs, model, dictionary, "text", "source"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=2048, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("simhash", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: The trained stages cannot be said in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again for the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
