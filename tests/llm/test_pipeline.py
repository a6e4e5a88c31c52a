"""The registered queries and the pipeline's stages on the supplied tables."""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from revlens.llm.common import read, staged
from revlens.llm.queries import QUERIES
from revlens.llm.secrets import MARK
from tests.llm.test_pii import plain_row
from tests.llm.test_texts import components, plain_fingerprint
from tests.oracle import compare, connect

CONTRACT = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_topk": ["query_id", "rank", "vec_id", "score"],
    "op7_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op8_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op9_quality": ["doc_id", "held_out", "score", "predicted"],
    "op11_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
    "op12_hardneg": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op13_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


def test_personal_data_of_the_supplied_texts(spark, sf_dir):
    rows = QUERIES["op11_pii"].run(spark, sf_dir)
    assert rows.columns == CONTRACT["op11_pii"]
    wanted = [plain_row(r.doc_id, r.text) for r in read(spark, sf_dir, "documents").collect()]
    assert sorted(tuple(r)[:6] for r in rows.collect()) == sorted(wanted)


@pytest.mark.parametrize("name", ["op12_hardneg", "op13_repair"])
def test_agreed_columns(spark, sf_dir, name):
    assert QUERIES[name].run(spark, sf_dir).columns == CONTRACT[name]


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_same_as_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), sf_dir, QUERIES[name]) == []


@pytest.mark.parametrize("name", ["op2_toxicity", "op9_quality", "op10_secrets"])
def test_whole_table_comes_back(spark, sf_dir, name):
    rows = QUERIES[name].run(spark, sf_dir)
    docs = read(spark, sf_dir, "documents")
    if name == "op10_secrets":
        texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        wanted = {(i, m.start(1)) for i, t in texts.items() for m in re.finditer(r'(?i)token\W+"([0-9a-f]{40})"', t or "")}
        assert {(r.doc_id, r.start) for r in rows.where("is_secret").collect()} >= wanted
        return
    found = rows.collect()
    assert rows.columns == CONTRACT[name]
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in found)


def test_registered():
    names = __spark_entry__.queries()
    assert {*CONTRACT, "pipeline"} <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "secrets", "packing"]
    for number in range(1, 11):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1


def test_stages(spark, sf_dir):
    """Each stage on what the one before it kept, against plain Python."""
    docs = read(spark, sf_dir, "documents")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        kept.append(docs)
        if name != "packing":
            assert docs.columns == columns
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
    calm, lines, single, clean, pieces = kept

    # line dedup
    rows = calm.collect()
    totals = collections.Counter(r.source for r in rows)
    on = collections.Counter((r.source, x) for r in rows for x in {y.strip(" ") for y in r.text.split("\n")} - {""})
    gone = {k for k, n in on.items() if n >= 5 and n / totals[k[0]] > 0.01}
    wanted = {r.doc_id: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in gone) for r in rows}
    assert {r.doc_id: r.text for r in lines.collect()} == wanted

    # near copies
    groups = components({i: plain_fingerprint(t) for i, t in wanted.items()}, 4)
    left = {i: t for i, t in wanted.items() if groups[i] == i}
    assert {r.doc_id: r.text for r in single.collect()} == left

    # secrets
    token = re.compile(r'(?i)(token\W+")[0-9a-f]{40}(")')
    masked = {r.doc_id: r.text for r in clean.collect()}
    assert {i: token.sub(rf"\g<1>{MARK}\g<2>", t) for i, t in left.items()} == masked

    # packing
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at = collections.Counter()
    for p in sorted(pieces.collect(), key=lambda p: (p.doc_id, p.start)):
        ids = np.array(tokenizer.encode(masked[p.doc_id], add_special_tokens=False).ids + [1], "<u4")
        assert p.start == at[p.doc_id] and zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        at[p.doc_id] += p.length
        assert p.doc_tokens == len(ids)
    assert set(at) == set(masked)
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n <> 2048").count()
    assert whole <= 1


def test_run_keeps_every_calm_document_once(spark, sf_dir):
    pieces = corpus_pipeline.run(spark, sf_dir)
    assert pieces.groupBy("doc_id", "start").count().where("count > 1").count() == 0
