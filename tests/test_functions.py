from __future__ import annotations

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from revlens.functions import authors, labels, numbers, risk, times, wording
from revlens.functions.text import clean_text

# (comment, anonymous, delta) -> label, NULL where no rule decides
TRUTH = [
    (None, 0, 0.0, None),
    ("", 0, 0.0, 0),
    (None, 1, 0.0, 1),
    ("rv vandalism", 0, 0.0, 1),
    ("\t", 1, 0.0, 0),
    ("ok", 0, -500.0, 0),
    ("ok", 0, -501.0, 1),
    ("ok", 1, 1000.0, 0),
    ("ok", 1, -1001.0, 1),
    (None, 0, -600.0, 1),
    ("ok", 1, None, None),
    ("Reverted edits by user", 0, 0.0, 1),
    ("", 0, -600.0, 1),
    ("Fixed grammar", 0, 50.0, 0),
    ("", 1, 2000.0, 1),
]


def evaluate(spark, values, schema, column):
    return [r[0] for r in spark.createDataFrame(values, schema).select(column).collect()]


def test_weak_label_truth_table(spark):
    df = spark.createDataFrame(TRUTH, "comment string, anon int, delta double, expected int")
    columns = (F.col("comment"), F.col("anon"), F.col("delta"))
    for null_as_zero in (False, True):
        label = labels.weak_label(*columns, null_as_zero=null_as_zero)
        for row in df.select("*", label.alias("got")).collect():
            wanted = 0 if row.expected is None and null_as_zero else row.expected
            assert row.got == wanted, row


def test_grouped_pattern_equals_the_listed_ones(spark, sf_dir):
    """The regrouped alternation finds what the patterns find one by one."""
    cases = [
        "REVERT", "unrevert", "xrevert", "a revert", "rv", "rvx", "prv", "rv.", "rvv", "Vandalize",
        "vandals", "vandal", "antivandal", "spam", "spammer", "undo", "undone", "undid", "test edits",
        "contest edit", "robot: reverting", "cv", "cvs", "xcopyviox", "offtopic", "off-topic",
        "off topic", "it is not notable", "", "bcnorstuv",
    ]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    df = docs.unionByName(spark.createDataFrame([(c,) for c in cases], "text string"))
    one_by_one = F.lit(False)
    for pattern in labels.RISKY_PATTERNS:
        one_by_one = one_by_one | F.col("text").rlike(pattern)
    assert df.filter(labels.risky_comment(F.col("text")) != one_by_one).count() == 0


def test_decimal_texts_are_correctly_rounded(spark):
    """Against Python's formatting: wide values, values near ties, and tiny ones."""
    rng = random.Random(1)
    values = [rng.uniform(-1e6, 1e6) for _ in range(3000)]
    values += [rng.randint(-(10**7), 10**7) / 20000 for _ in range(3000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.uniform(-310, 6) for _ in range(3000)]
    values += [0.0, 5e-324, -5e-324, 0.05, -0.05]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(
        "v",
        numbers.fixed(F.col("v"), 1).alias("one"),
        numbers.fixed(F.col("v"), 3).alias("three"),
        numbers.percent(F.col("v")).alias("pct"),
        numbers.round_exact(F.col("v"), 4).alias("r4"),
    )
    for row in got.collect():
        assert row.one == f"{row.v:.1f}"
        assert row.three == f"{row.v:.3f}"
        assert row.pct == f"{row.v:.1%}"
        assert math.isclose(row.r4, round(row.v, 4), rel_tol=1e-15, abs_tol=0)


def test_ties_go_to_even_on_the_binary_value(spark):
    got = evaluate(spark, [(0.0025,), (6.25,), (6.75,), (0.15,), (None,)], "v double",
                   numbers.fixed(F.col("v"), 1))
    assert got == ["0.0", "6.2", "6.8", "0.1", None]


def test_byte_texts(spark):
    sizes = [0, 1023, 1024, 1536, 1048576, 5 * 1024**3, 3 * 1024**4, 2000 * 1024**4]
    got = evaluate(spark, [(s,) for s in sizes], "n bigint", numbers.byte_text(F.col("n")))
    assert got == [
        "0.0 B", "1023.0 B", "1.0 KB", "1.5 KB", "1.0 MB", "5.0 GB", "3.0 TB", "2000.0 TB",
    ]


USERS = [
    # name, default, empty not anonymous, IPv4 only, prefix, record
    ("192.168.1.100", True, True, True, True, True),
    ("2001:db8::1", True, True, False, True, True),
    ("abc:user", False, False, False, True, False),
    ("TestUser", False, False, False, False, False),
    (" 10.0.0.1 ", True, True, False, False, False),
    ("", True, False, False, False, False),
    (None, True, False, False, False, False),
]


def test_anonymous_variants(spark):
    df = spark.createDataFrame([(u[0],) for u in USERS], "u string")
    u = F.col("u")
    got = df.select(
        u,
        authors.is_anon(u),
        authors.is_anon(u, empty_is_anon=False),
        authors.is_anon_ipv4(u),
        authors.is_anon_prefix(u),
        authors.is_anon_record(u),
    ).collect()
    assert [tuple(r) for r in got] == USERS


def test_times(spark):
    df = spark.createDataFrame(
        [("2024-01-01T12:00:00Z", "2023-06-04 07:30:00.0", 1704110400), ("nonsense", "", None)],
        "iso string, hist string, secs bigint",
    )
    first, second = df.select(
        times.hour_of_day(times.dump_time(F.col("iso"))).alias("h"),
        times.day_of_week(times.iso_time(F.col("iso"))).alias("d"),
        times.day_of_week(times.iso_time(F.col("iso")), iso=True).alias("i"),
        times.hour_of_day(times.history_time(F.col("hist"))).alias("hh"),
        times.day_of_week(times.history_time(F.col("hist"))).alias("hd"),
        times.hour_of_day(times.event_time(F.lit(None).cast("string"), F.col("secs"))).alias("eh"),
    ).collect()
    assert tuple(first) == (12, 2, 1, 7, 1, 12)
    assert tuple(second) == (0, 1, 1, 0, 1, 0)


def test_ages(spark):
    now = datetime.datetime(2024, 1, 10, 12)
    ages = [0, 59, 60, 3599, 3600, 86399, 86400, 10 * 86400, -50]
    df = spark.createDataFrame(
        [(str(now - datetime.timedelta(seconds=a)),) for a in ages] + [("bad",)], "t string"
    )
    text = times.age_text(times.iso_time(F.col("t")), F.lit(str(now)).cast("timestamp"))
    assert [r[0] for r in df.select(text).collect()] == [
        "0s ago", "59s ago", "1m ago", "59m ago", "1h ago", "23h ago", "1d ago", "10d ago", "0s ago", "",
    ]


def test_clean_text_keeps_length_per_code_point(spark):
    got = evaluate(spark, [("Ünï-Code 9!\t😀x",), (None,)], "t string", clean_text(F.col("t")))
    assert got == [" n  code 9 \t x", None]


EDITS = [
    # comment, user, anon, delta, score
    ("Fixed typo", "TestUser", 0, 15.0, 0.05),
    ("revert vandalism by user", "192.168.1.100", 1, -2500.0, 0.80),
    ("", "10.0.0.1", 1, 0.0, 0.33),
    (None, "Botty", 0, None, 0.02),
    ("rvx", None, None, 1001.0, 0.15),
]


def test_heuristic_score(spark):
    df = spark.createDataFrame(EDITS, "comment string, user string, anon int, delta double, want double")
    got = df.select(
        "want", risk.heuristic_score(*(F.col(c) for c in ("comment", "user", "anon", "delta")))
    )
    for want, score in got.collect():
        assert score == pytest.approx(want)


def test_bands(spark):
    got = evaluate(spark, [(0.2,), (0.1999,), (0.08,), (0.0799,), (None,)], "s double",
                   risk.risk_band(F.col("s")))
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]


def explained(spark, *row):
    schema = "comment string, delta double, anon int, score double, label string"
    columns = (F.col(c) for c in ("comment", "delta", "anon", "score", "label"))
    return evaluate(spark, [row], schema, wording.explanation(*columns))[0]


def test_explanations(spark):
    text = explained(spark, "revert vandalism by user", -2500.0, 1, 0.85, "HIGH")
    assert text.startswith("This edit was flagged as **HIGH** risk because ")
    assert "keywords" in text and "(2500 bytes deleted)" in text and "85.0%" in text
    assert "large content change" not in text  # only the first two reasons
    low = explained(spark, "Fixed typo in introduction", 15.0, 0, 0.12, "LOW")
    assert wording.REASON_GENERIC in low and "**LOW**" in low and "12.0%" in low
    assert wording.REASON_HIGH_SCORE in explained(spark, "ok", 1.0, 0, 0.7, "HIGH")
    assert "keywords" in explained(spark, "customer service", 1.0, 0, 0.1, "LOW")
    small = explained(spark, "  ", -10.0, 1, None, None)
    assert "**None**" in small and "score of 0.0%" in small
    assert "without explanation; the anonymous editor provided no edit summary" in small


def test_alert_and_links(spark):
    row = [("123", "My Page", "c" * 600, -12.7, 0.5, "HIGH"), (None, None, "", None, None, None)]
    schema = "rev string, title string, comment string, delta double, score double, label string"
    df = spark.createDataFrame(row, schema)
    c = {n: F.col(n) for n in df.columns}
    full, empty = df.select(
        wording.alert_subject(c["title"], c["label"], "Watch").alias("s"),
        wording.alert_body(
            c["rev"], c["title"], c["comment"], c["delta"], c["score"], c["label"], "Watch"
        ).alias("b"),
        wording.diff_url(c["rev"], c["title"]).alias("u"),
    ).collect()
    assert full.s == "Watch HIGH alert: My Page"
    assert "Size change: -12 bytes" in full.b and "c" * 500 + "\nDiff" in full.b
    assert "(score 50.0%)" in full.b
    assert full.u == "https://en.wikipedia.org/wiki/Special:Diff/123"
    assert empty.s == "Watch UNKNOWN alert: Unknown page"
    assert "score not scored" in empty.b and "+0 bytes" in empty.b
    assert "(no edit summary)" in empty.b and empty.b.endswith("/wiki/Unknown_page")
    assert empty.u == "https://en.wikipedia.org/wiki/Wikipedia"
