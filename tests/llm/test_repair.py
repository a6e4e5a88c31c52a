"""Conversation repair against a plain search over every row, with odd rows, long runs and small chunks."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from revlens.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, conv int, place string"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def plain_damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, "user" if kind == 4 else role, text)
        out += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def inserted(states):
    """Every state with its cheapest way, insertions included, until nothing gets better."""
    better = True
    while better:
        better = False
        for (s, first), t in STEP.items():
            if first != "s" and s in states:
                role = "user" if first == "u" else "assistant"
                new = (states[s][0] + 3, states[s][1] + "I", states[s][2] + ((role, ""),))
                if t not in states or new[:2] < states[t][:2]:
                    states[t] = new
                    better = True
    return states


def plain_repair(rows):
    ordered = sorted((t is not None, t or 0, r, hashlib.md5(x.encode()).hexdigest(), x) for t, r, x in rows)
    turns = {r[1] for r in ordered if r[0]}
    seen, faults = set(), []
    for *_, role, _, text in ordered:
        bare = text.rstrip(" \t\n\x0b\f\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    states = {0: (0, "", ())}
    for (*_, role, _, text), fault in zip(ordered, faults):
        new = {}
        for s, (cost, audit, out) in inserted(states).items():
            ways = [(s, 4, "D", ())]
            if fault not in ("b", "d"):
                extra = 3 if fault == "t" else 0
                ways += [(STEP.get((s, role[:1])), extra, "K", ((role, text),))]
                ways += [(STEP.get((s, r[0])), extra + 3, "R", ((r, text),)) for r in ("user", "assistant")]
            for to, more, edit, row in ways:
                way = (cost + more, audit + edit, out + row)
                if to is not None and (to not in new or way[:2] < new[to][:2]):
                    new[to] = way
        states = new
    states = inserted(states)
    cost, audit, out = min(states[s] for s in (0, 3) if s in states)
    first = [r[2][:1] for r in ordered]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *[faults.count(f) for f in "bdt"], illegal, cost, audit), out


def plain_report(rows):
    damaged = plain_damage(rows)
    found = []
    for conv in {r[0] for r in rows}:
        facts, out = plain_repair([r[1:4] for r in damaged if r[0] == conv])
        found.append((conv, *facts, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()))
    return sorted(found, key=repr)


def odd_rows(seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "u2"]
    texts = ["Hi.", "a b", "ok!  ", "what?\n", "", " ", None, "x ", "é. . ?", "long " * 50, "very long " * 20_000 + "."]
    rows = []
    for conv in [None, *range(60)]:
        for t in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 60])):
            turn = rng.choice([t, t, t, t, None, rng.randint(0, 9)])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts), 1, "x"))
    rows += [(9999, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.", 1, None) for t in range(700)]
    rows += [(8888, 3, "user", "same.", 1, None)] * 300  # one row many times
    rng.shuffle(rows)
    return rows


def report(df):
    got = repair.repair_report(repair.damaged(df), df)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("chunk, piece, rules", [(1024, 64, 512), (7, 3, 5), (1, 1, 0)])
def test_same_as_plain(spark, monkeypatch, chunk, piece, rules):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "PIECE", piece)
    monkeypatch.setattr(repair, "learn_grammar", lambda sequences, learn=repair.learn_grammar: learn(sequences, rules))
    rows = odd_rows(chunk)
    assert report(spark.createDataFrame(rows, SCHEMA).repartition(4)) == plain_report(rows)


def test_repaired_turns(spark):
    rows = odd_rows(3)
    damaged = repair.damaged(spark.createDataFrame(rows, SCHEMA))
    got = {}
    for r in repair.repaired_turns(damaged, repair.plans(damaged)).orderBy("place").collect():
        got.setdefault(r.conv, []).append((r.role, r.text))
    plain = plain_damage(rows)
    for conv in {r[0] for r in plain}:
        wanted = list(plain_repair([r[1:] for r in plain if r[0] == conv])[1])
        assert got.get(conv, []) == wanted
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0][0] for r in wanted))


def test_without_rows(spark):
    assert report(spark.createDataFrame([], SCHEMA)) == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert report(spark.createDataFrame([(1, dropped, "user", "x", 0, "")], SCHEMA)) == [(1, 0, 0, 0, 0, 0, 0, "", empty)]


def test_grammar_shares_repeats(spark):
    """Frequent pairs become symbols of symbols, and every symbol stands for what it replaced."""
    marks = spark.createDataFrame([("EIEIEIEI", 5), ("AEIEI", 2), ("EEEEE", 3)], "marks string, n long")
    grammar = repair.learn_grammar(marks, 16, 2)
    pairs = [pair for rules in grammar for pair in rules]

    def expanded(symbol):
        return chr(65 + symbol) if symbol < 16 else "".join(map(expanded, pairs[symbol - 16]))

    for text in ("EIEIEIEI", "AEIEI", "EEEEE", "IEIE"):
        assert "".join(map(expanded, repair.compressed(text, grammar))) == text
    assert len(repair.compressed("EIEIEIEI", grammar)) == 1


def test_ropes_share_and_compare():
    a, b = ("x" * 60, "D"), ("x" * 60, "I")
    assert repair._less(a, b) and not repair._less(b, a) and not repair._less(a, a)
    assert repair._less(("x" * 30, "x" * 30), ("x" * 60, "D")) and "".join(repair.leaves((a, b))) == "x" * 60 + "D" + "x" * 60 + "I"
