from __future__ import annotations

import bz2
import json
import random

import pytest
from pyspark.sql import functions as F

from revlens.plans import io_queries
from revlens.schemas import HISTORY_COLUMNS, REVISION
from revlens.sinks.documents import read_document, write_dataset_manifest, write_document
from revlens.sinks.tables import append_delta, archive, write_revisions
from revlens.sources import events, files, history, tables, xml
from tests.conftest import rows

DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-{version}/" version="{version}">
  <siteinfo><sitename>X</sitename></siteinfo>
  <page>
    <title> First &amp; best </title>
    <ns>0</ns>
    <id>10</id>
    <revision>
      <id>100</id>
      <timestamp>2024-01-01T12:00:00Z</timestamp>
      <contributor><username>Ann</username><id>5</id></contributor>
      <comment> made &lt;it&gt; </comment>
      <text bytes="120" xml:space="preserve">body</text>
    </revision>
    <revision>
      <id>101</id>
      <parentid>100</parentid>
      <timestamp>2024-01-02T12:00:00Z</timestamp>
      <contributor><ip>192.168.1.1</ip></contributor>
      <text bytes="zz">größe</text>
    </revision>
  </page>
  <page>
    <title>Empty page</title><ns>0</ns><id>11</id>
  </page>
  <page>
    <title>Talk</title>
    <ns>odd</ns>
    <id>12</id>
    <revision>
      <id>102</id>
      <contributor deleted="deleted" />
      <comment deleted="deleted" />
      <text deleted="deleted" />
    </revision>
  </page>
</mediawiki>
"""
REVISIONS = [
    ("10", "First & best", 0, "100", "", "2024-01-01T12:00:00Z", "Ann", False, "made <it>", 120),
    ("10", "First & best", 0, "101", "100", "2024-01-02T12:00:00Z", "192.168.1.1", True, "", 7),
    ("12", "Talk", 0, "102", "", "", "", True, "", 0),
]


@pytest.mark.parametrize("version", ["0.10", "0.11"])
@pytest.mark.parametrize("packed", [False, True])
def test_dump_fields(spark, tmp_path, version, packed):
    text = DUMP.format(version=version).encode()
    path = tmp_path / ("dump.xml.bz2" if packed else "dump.xml")
    path.write_bytes(bz2.compress(text) if packed else text)
    got = xml.read_revisions(spark, str(path))
    assert got.columns == REVISION.fieldNames()
    assert [f.dataType for f in got.schema] == [f.dataType for f in REVISION]
    assert rows(got) == REVISIONS
    assert rows(xml.read_revisions(spark, str(path), staged=False)) == REVISIONS
    assert xml.count_revisions(spark, str(path)).first().revisions == 3


def test_pages_are_carried_over_file_splits(spark, tmp_path):
    """A page may be far longer than a split; its later revisions still get its title and id."""
    rng = random.Random(3)
    wanted = []
    for part in range(2):
        pieces = ["<mediawiki>"]
        for page in range(12):
            pid = f"{part}{page}"
            pieces.append(f"<page><title>P {pid}</title><ns>{page % 3}</ns><id>{pid}</id>")
            for rev in range(400 if page == 5 else rng.randrange(0, 6)):
                size = rng.randrange(0, 400)
                pieces.append(
                    f"<revision><id>{pid}-{rev}</id><comment>c</comment>"
                    f'<text bytes="{size}">{"x" * size}</text></revision>'
                )
                wanted.append((pid, f"P {pid}", page % 3, f"{pid}-{rev}", size))
            pieces.append("</page>")
        (tmp_path / f"d{part}.xml").write_text("\n".join(pieces) + "</mediawiki>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        records = xml.revision_records(spark, str(tmp_path))
        assert records.select("_file", "_split").distinct().count() > 20
        got = xml.read_revisions(spark, str(tmp_path), staged=False)
        assert rows(got.select("page_id", "page_title", "namespace", "rev_id", "text_bytes")) == sorted(
            wanted, key=repr
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dump_discovery(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.find_dumps(spark, str(tmp_path))
    for name in ("b.xml.bz2", "a.xml.bz2", "c.txt"):
        (tmp_path / name).write_bytes(bz2.compress(b"x\n"))
    found = files.find_dumps(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in found] == ["a.xml.bz2", "b.xml.bz2"]


def history_line(**fields):
    return "\t".join(fields.get(c, "") for c in HISTORY_COLUMNS)


def test_history_readers(spark, tmp_path):
    lines = [
        "# header\tcomment",
        history_line(wiki_db="enwiki", event_comment='say "hi" \\n', revision_id="1",
                     revision_is_identity_reverted="true"),
        history_line(wiki_db="enwiki", revision_id="2"),
        "enwiki\tshort line",
    ]
    path = tmp_path / "history.tsv.bz2"
    path.write_bytes(bz2.compress(("\n".join(lines) + "\n").encode()))
    strict = history.read_history(spark, str(path)).select(
        "revision_id", "event_comment", "revision_is_identity_reverted"
    )
    assert rows(strict) == sorted(
        [("1", 'say "hi" \\n', "true"), ("2", None, None), (None, None, None)], key=repr
    )
    lenient = history.read_history_lenient(spark, str(path)).select(
        "revision_id", "event_comment", "revision_is_identity_reverted"
    )
    assert rows(lenient) == [("1", 'say "hi" \\n', "true"), ("2", "", "")]
    total = files.raw_bytes(spark, str(path)).first().n_bytes
    assert total == len(bz2.decompress(path.read_bytes()))


def test_bz2_is_split(spark, tmp_path):
    """Blocks of one compressed file are read by several tasks without losing or doubling lines."""
    rng = random.Random(1)
    lines = [f"{i} {rng.random()} {rng.random()}" for i in range(60_000)]
    path = tmp_path / "big.bz2"
    path.write_bytes(bz2.compress(("\n".join(lines) + "\n").encode(), 1))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        df = spark.read.text(str(path))
        assert df.rdd.getNumPartitions() > 3
        assert df.count() == df.distinct().count() == len(lines)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_messages(spark):
    good = {"id": 1, "type": "edit", "wiki": "enwiki", "namespace": 0, "title": "T"}
    lines = [json.dumps(good), "", "   ", "{broken", json.dumps(good | {"wiki": "dewiki"}),
             json.dumps(good | {"namespace": 1}), json.dumps(good | {"type": "log"}), "[1]", "null"]
    got = events.parse_messages(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert [(r.id, r.title) for r in got.collect()] == [(1, "T")]


def test_inventory(spark, tmp_path):
    bodies = {"a.bz2": b"abc" * 5_000_000, "b.bz2": bz2.compress(b"b"), "c d.bz2": b"z"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    sizes = files.file_inventory(spark, str(tmp_path))
    big = sizes.filter("name = 'a.bz2'").first()
    assert (big.compressed_mb, big.decompressed_bytes_estimate) == (15.0, 105_000_000)
    write_dataset_manifest(sizes, str(tmp_path / "manifest"), "somewhere", "20240420")
    summary = spark.read.json(str(tmp_path / "manifest" / "summary")).first()
    assert (summary.total_files, summary.requirement_10gb_met) == (3, False)
    assert spark.read.json(str(tmp_path / "manifest" / "files")).count() == 3


def test_table_readers(spark, tmp_path):
    one = spark.range(10).withColumn("a", F.lit("x"))
    one.write.parquet(str(tmp_path / "parts" / "p0"))
    one.write.parquet(str(tmp_path / "parts" / "p1"))
    assert tables.read_parts(spark, str(tmp_path / "parts")).count() == 20
    spark.range(3).write.parquet(str(tmp_path / "other"))
    both = tables.read_union(spark, [str(tmp_path / "parts" / "p0"), str(tmp_path / "other")])
    assert both.count() == 13 and both.filter("a is null").count() == 3
    path = str(tmp_path / "built")
    _, reused = tables.read_or_build(spark, path, lambda: one)
    again, reused_again = tables.read_or_build(spark, path, lambda: 1 / 0)
    assert (reused, reused_again, again.count()) == (False, True, 10)


def test_bounded_files(spark, tmp_path):
    write_revisions(spark.range(0, 100, 1, 1), str(tmp_path / "r"), rows_per_file=30)
    assert len(list((tmp_path / "r").glob("*.parquet"))) == 4
    write_revisions(spark.range(5), str(tmp_path / "r"), rows_per_file=30)
    assert spark.read.parquet(str(tmp_path / "r")).count() == 5


def test_archive_prunes_dates(spark, tmp_path):
    path = str(tmp_path / "archive")
    df = spark.range(48).withColumn("t", F.timestamp_seconds(F.col("id") * 3600))
    archive(df, path, F.col("t"))
    assert sorted(p.name for p in (tmp_path / "archive").glob("date=*")) == [
        "date=1970-01-01", "date=1970-01-02",
    ]
    one_day = spark.read.parquet(path).filter("date = '1970-01-02'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert one_day.count() == 24


def test_delta_is_optional(spark, tmp_path):
    assert append_delta(spark.range(3), str(tmp_path / "delta"), "s", 0) is False


def test_document_round_trip(spark, tmp_path):
    write_document(spark.range(1).select(F.lit("r").alias("run_id"), F.lit(3).alias("n")), str(tmp_path / "d"))
    assert len(list((tmp_path / "d").glob("*.json"))) == 1
    assert read_document(spark.read.json(str(tmp_path / "d"))) == {"n": 3, "run_id": "r"}


def test_dump_files_are_of_about_as_many_documents(spark, tmp_path, monkeypatch):
    """However the table is cut; every line of every text is a revision, copies and rows without a text too."""
    i = F.col("id")
    ids = spark.range(400).coalesce(1)
    docs = ids.select(
        i.alias("doc_id"),
        F.when(i % 50 > 0, F.concat_ws("\n", F.lit("first"), i.cast("string"))).alias("text"),
        F.lit("en").alias("lang"), F.lit("site").alias("source"), F.lit(1).cast("bigint").alias("n_chars"),
    )
    docs.unionAll(docs.filter("doc_id < 5")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(io_queries, "DOCS_PER_DUMP_FILE", 50)
    path = io_queries.write_dump(spark, str(tmp_path))
    files = spark.read.text(path).filter(F.contains("value", F.lit("<page>"))).groupBy(F.col("_metadata.file_name")).count().collect()
    assert len(files) == 9 and max(f["count"] for f in files) < 3 * 50
    got = xml.read_revisions(spark, path)
    assert got.count() == 2 * (400 - 8) + 2 * 4
    assert got.select("page_id").distinct().count() == 400 - 8
