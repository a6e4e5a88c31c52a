"""Personal data: plain spans against Python's regular expressions, added spans against planted ones."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from revlens.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BITS = [
    "a@b.co", "_x@d.com", "@", "..", "user.name+tag@mail.example.com", "1.2.3.4", "300.1.2.3.4", " ", "  ", "-", "4111111111111111",
    "4111 1111 1111 1111", "+1 (017) 555-7713", "+49 30 123456", "+1", "(", ")", ".", "5", "12", "é", "😀", "\n", "\x01", "\x02",
    "a[at]b[dot]com", "x (at) y.org", "card 4111.1111.1111.1111", "(555) 123-4567", "1[.]2[.]3[.]4", "fe80::1", "v1.2.3.4.5", "+", "@x.y",
    "b@c", "a.b", "4111-1111", "0000", "255.255.255.256", "001.002.003.0255",
]


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (
                kind == "email"
                or (kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")))
                or (kind == "card" and 13 <= len(digits) <= 19 and luhn(digits))
                or (kind == "phone" and 9 <= len(digits) <= 15)
            ):
                out.append((kind, m.start(), m.end()))
    return out


def plain_row(doc_id, text):
    spans = plain_spans(text)
    listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    return (doc_id, *[sum(s[0] == k for s in spans) for k in PATTERNS], hashlib.sha256(listed.encode()).hexdigest())


def odd_rows():
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice(BITS) + rng.choice(["", " ", "", " w "]) for _ in range(rng.randint(0, 30)))) for i in range(800)]
    rows += [(9001, None), (9002, ""), (9003, "a@b" + ".c" * 2000), (9004, "1" * 3000), (9005, "1.2.3.4 " * 3000), (9006, "a" * 2000)]
    rows += [(9007, "1 " * 3000), (9008, "+1" + " " * 2000), (9009, "1.2." * 1000), (None, "x@y.z"), (3, "a@b.co"), (3, "a@b.co")]
    return rows


def test_plain_spans(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, spans string, id int").repartition(4)
    got = sorted((tuple(r) for r in pii.report(df).collect()), key=repr)
    assert [g[:6] for g in got] == sorted((plain_row(*r) for r in rows), key=repr)
    texts = dict(rows)
    for doc_id, *_, spans, added in got:
        if doc_id not in (None, 3):
            wanted = [f"{k}:{s}:{e}" for k, s, e in plain_spans(texts[doc_id])]
            listed = spans.split(",") if spans else []
            assert set(wanted) <= set(listed) and len(listed) == len(wanted) + added
            places = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in listed]
            assert places == sorted(places)


def test_long_runs_are_read_once(spark):
    """Texts on which a search that goes back over a run would not end."""
    texts = ["a@b" + ".c" * 300_000, "1" * 1_000_000, "a" * 1_000_000, "1 " * 400_000, "+1" + " " * 400_000, "1.2.3.4 " * 40_000]
    got = pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got] == [(1, 0, 0, 0), *[(0, 0, 0, 0)] * 4, (0, 40_000, 0, 0)]


def planted(rng, n):
    """Texts with a span written around, or with something that only looks like one."""

    def digits(k):
        return "".join(rng.choice("0123456789") for _ in range(k))

    def word():
        return "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8)))

    def card(sep):
        body = "4" + digits(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        return sep.join(body[i : i + 4] for i in range(0, 16, 4))

    def octets(sep):
        return sep.join(str(rng.randint(1, 220)) for _ in range(4))

    true = [
        ("email", "contact: ", lambda: f"{word()}.{word()} (at) {word()}.com"),
        ("email", "mail me ", lambda: f"{word()}[at]{word()}[dot]org"),
        ("ip", "login from ", lambda: octets("[.]")),
        ("ip", "server ", lambda: ":".join(f"{rng.randint(0, 65535):x}" for _ in range(8))),
        ("card", "visa ", lambda: card(".")),
        ("phone", "call ", lambda: f"({rng.randint(200, 999)}) {digits(3)}-{digits(4)}"),
        ("phone", "tel ", lambda: f"{rng.randint(200, 999)}-{digits(3)}-{digits(4)}"),
    ]
    false = [
        ("", "order ", lambda: ".".join(["9999", digits(4), digits(4), "9999"])),
        ("", "part ", lambda: f"x{digits(3)}-{digits(3)}-{digits(4)}"),
        ("", "score ", lambda: f"{digits(2)}-{digits(3)}-{digits(3)}"),
    ]
    rows = []
    for i in range(n):
        kind, cue, make = rng.choice(true if rng.random() < 0.6 else false)
        before, span = " ".join(word() for _ in range(6)) + " " + cue, make()
        rows.append((i, before + span + " " + word() + ".", kind, len(before), len(before) + len(span)))
    plain = [f"{word()} {word()}@{word()}.com {word()} +1 ({rng.randint(200, 999)}) 555-{digits(4)} {word()} {octets('.')} {word()} {card('')} {word()}" for _ in range(n)]
    return rows, [(n + i, t) for i, t in enumerate(plain)]


def test_added_spans(spark):
    rows, plain = planted(random.Random(4), 1500)
    df = spark.createDataFrame([r[:2] for r in rows] + plain, "doc_id long, text string")
    got = {r.doc_id: {s for s in r.spans.split(",") if s} for r in pii.report(df).collect()}
    wanted = {i: f"{k}:{s}:{e}" for i, _, k, s, e in rows if k}
    caught = sum(span in got[i] for i, span in wanted.items())
    wrong = sum(len(got[i]) for i, _, k, *_ in rows if not k)
    assert caught >= 0.95 * len(wanted)
    assert wrong <= 0.05 * (len(rows) - len(wanted))
    assert all(len(got[i]) == 4 for i, _ in plain)


def test_reliabilities_are_found():
    """Votes drawn from known chances: expectation-maximisation finds them without labels."""
    rng = random.Random(2)
    chances, share = [(0.95, 0.1), (0.9, 0.2), (0.8, 0.05), (0.7, 0.3), (0.85, 0.4)], 0.3
    counts, truth = {}, {}
    for _ in range(40_000):
        y = rng.random() < share
        votes = tuple(-1 if rng.random() < 0.2 else int(rng.random() < c[0 if y else 1]) for c in chances)
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = truth.get(votes, 0) + y
    found, found_share, believed = pii.reliabilities(counts)
    for (a, b), (c, d) in zip(found.values(), chances):
        assert abs(a - c) < 0.03 and abs(b - d) < 0.03
    assert abs(found_share - share) < 0.02
    assert abs(sum(believed[v] * n for v, n in counts.items()) - sum(truth.values())) < 800


def test_redact(spark):
    docs = spark.createDataFrame([(1, "a@b.co and 1.2.3.4é", "s"), (2, None, "s"), (3, "", "s"), (4, "no data", None)], "doc_id long, text string, spans string")
    model = pii.Model({}, {}, {}, -20.0)
    got = pii.redact(docs, model).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["[EMAIL] and [IP]é", None, "", "no data"]
    assert [r.spans for r in got] == ["s", "s", "s", None]


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_without_spans(spark, rows):
    got = pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in got] == [(None, 0, 0, 0, 0, empty, "", 0)] * len(rows)


def test_no_python_on_the_way(spark, sf_dir):
    """Scan, votes and decisions are column expressions."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found, name = pii.candidates(docs)
    plan = pii.decided(found, name, pii.Model({}, {}, {"email": 1.0}, 0.0))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
