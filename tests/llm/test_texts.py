"""Encoding, packing, line dedup and SimHash against brute force, with odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import bpe, linededup, packing, simhash

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", " ", " ", "\n", "\t", " ", "a", "b", "é", "1", "'", "s", "ll", "ß", "中", "😀", "!!", "the", " and", "\r", "\x1c", "\x85", "²"]

ODD = [
    (1, "The quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (4, "  \n\n  "), (5, "The quick brown fox jumps over the lazy dog"),
    (5, "The quick brown fox jumps over the lazy dog"), (None, "no id here"), (7, "x" * 9000 + " y"), (8, "word " * 3000), (9, "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "s" if i else None, 1, "clash") for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens int, fp string").repartition(3)


@pytest.fixture(scope="module")
def known():
    ranks = bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.TextCodec(RANKS, public_tokenizers.PATTERN)


def random_texts(n, size, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, size))) for _ in range(n)]


def test_encoding_equals_merging(codec, known):
    texts = random_texts(4000, 14) + ["".join(random.Random(i).choices("abcdeéntrisoxz", k=40)) for i in range(500)]
    for text, ids in zip(texts, codec.encode_all(pa.array(texts))):
        assert ids.tolist() == known.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_texts_over_a_block_are_cut_where_nothing_changes(codec, known, monkeypatch):
    from revlens.llm import words

    monkeypatch.setattr(words, "BLOCK", 64)
    for text in [*random_texts(300, 200, 2), "z" * 500, "a  b" * 100]:
        assert codec.encode(text).tolist() == known.encode_ordinary(text), repr(text)


def test_edits_follow_the_text(codec, known):
    rng = random.Random(5)
    for text in random_texts(400, 14, 3):
        held = bpe.EncodedText(codec, text)
        for _ in range(4):
            start = rng.randint(0, len(held.text))
            end = min(len(held.text), start + rng.randint(0, 4))
            held.replace(start, end, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 4))))
            assert held.ids == known.encode_ordinary(held.text)
        held.append(" tail")
        assert held.ids == known.encode_ordinary(held.text)


def test_an_edit_leaves_distant_matches_alone(codec):
    held = bpe.EncodedText(codec, "one two three " * 200)
    assert held.replace(1400, 1403, "xyz") < 6


def test_round_trip_of_odd_rows(spark, odd, known):
    got = sorted(map(tuple, bpe.round_trip(odd, RANKS, public_tokenizers.PATTERN).collect()), key=repr)
    wanted = []
    for i, text in ODD:
        ids = known.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        wanted.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(wanted, key=repr)
    assert bpe.round_trip(odd.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    coded = bpe.encode_texts(odd, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode_ids(coded, RANKS, public_tokenizers.PATTERN)
    assert sorted((r.doc_id or -1, bytes(r.data).decode()) for r in back.collect()) == sorted((i or -1, t or "") for i, t in ODD)


# ---- packing


def test_layout_puts_every_token_in_one_place():
    rng = random.Random(3)
    for trial in range(200):
        totals = {f"q{i}": rng.randint(0, 300) for i in range(rng.randint(1, 6))}
        targets = None if trial % 2 else {q: rng.choice([0, 1, 2, 5]) for q in totals}
        window, seen, windows = rng.choice([7, 16, 64]), set(), {}
        course = {q: [] for q in totals}
        for phase in packing.phases(totals, targets):
            for i, queue in enumerate(phase.queues):
                course[queue].append((phase, i))
        for queue, total in totals.items():
            at = 0
            while at < total:
                size = min(total - at, rng.randint(1, 40))
                spots = [p + k for p, n in packing.places(course, queue, at, size, window, windows) for k in range(n)]
                assert len(spots) == size and not seen & set(spots)
                seen |= set(spots)
                at += size
        assert seen == set(range(sum(totals.values())))


def test_windows_hold_the_target_shares():
    totals, targets, window = {"a": 60_000, "b": 30_000, "c": 90_000}, {"a": 2, "b": 1, "c": 1}, 1000
    first = packing.phases(totals, targets)[0]
    for x in range(0, first.length, window):
        served = [first.served(i, x + window) - first.served(i, x) for i in range(3)]
        for share, n in zip((0.5, 0.25, 0.25), served):
            assert abs(n - share * window) <= 1


def test_pieces_of_odd_rows(spark, odd):
    tokenizer = Tokenizer.from_file(JSON)
    pieces = packing.pack(odd, JSON, length=64).collect()
    ids = collections.defaultdict(list)
    for i, text in ODD:
        ids[i].append(np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4"))
    assert sum(p.length for p in pieces) == sum(len(x) for xs in ids.values() for x in xs)
    for p in pieces:
        assert any(
            len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in ids[p.doc_id]
        )
    by_sequence = collections.defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for sequence, parts in by_sequence.items():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 64 or sequence == max(by_sequence)
    assert packing.pack(odd.limit(0), JSON).count() == 0


def test_targets_hold_beside_thousands_of_sources(spark, monkeypatch):
    """Sources with a target keep their queues; small ones take turns behind them, every token once."""
    monkeypatch.setattr(packing, "TAIL_QUEUES", 16)
    rows = [(i, "tiny text", f"s{i % 5000}") for i in range(10_000)]
    rows += [(100_000 + i, "word " * 400, "a" if i % 2 else "b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    pieces = packing.pack(docs, JSON, {"a": 3, "b": 1}, length=64).select("doc_id", "length", "sequence_id", "offset").collect()
    source = {i: s for i, _, s in rows}
    taken = collections.defaultdict(collections.Counter)
    for p in pieces:
        taken[p.sequence_id // packing.WINDOW_SEQUENCES][source[p.doc_id]] += p.length
    window = 64 * packing.WINDOW_SEQUENCES
    for n in range(8):  # "a" lasts about ten windows
        assert abs(taken[n]["a"] / window - 0.75) < 0.01 and abs(taken[n]["b"] / window - 0.25) < 0.01
    tokenizer = Tokenizer.from_file(JSON)
    sizes = {t: len(tokenizer.encode(t).ids) + 1 for t in ("tiny text", "word " * 400)}
    assert sum(p.length for p in pieces) == sum(sizes[t] for _, t, _ in rows)
    places = sorted((p.sequence_id * 64 + p.offset, p.length) for p in pieces)
    assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))


def test_words_encoded_together_are_those_encoded_alone():
    codec, tokenizer = packing.codec(JSON), Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    rng = random.Random(7)
    words = ["".join(rng.choice(PIECES).strip(" ") for _ in range(rng.randint(0, 6))) for _ in range(4000)]
    words += ["", "<|endoftext|>", "don't", "a\nb", "\n", "x\x85", "中文", "'s", "\u00a0x"]
    wanted = [np.array(tokenizer.encode(" " + w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert codec._all(words) == wanted


# ---- line dedup


def test_boilerplate_by_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        site = rng.choice(["a", "b", None, ""])
        lines = [rng.choice(["menu", " menu ", "rare %d" % rng.randint(0, 40), "", "unique %d" % i, "footer " + str(site)]) for _ in range(rng.randint(0, 8))]
        rows.append((i % 250, None if i % 50 == 0 else "\n".join(lines), site, i, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, keys int, of string").repartition(5)
    totals = collections.Counter(r[2] for r in rows)
    on = collections.Counter((r[2], line) for r in rows for line in {x.strip(" ") for x in (r[1] or "").split("\n")} - {""})
    gone = {k for k, n in on.items() if n >= 5 and n / totals[k[0]] > 0.2}
    assert gone
    wanted = [
        (r[0], None if r[1] is None else "\n".join(x for x in r[1].split("\n") if (r[2], x.strip(" ")) not in gone), *r[2:]) for r in rows
    ]
    got = linededup.drop_boilerplate(docs, ratio=0.2)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(wanted, key=repr)
    assert linededup.drop_boilerplate(docs.limit(0)).count() == 0 and linededup.line_report(docs.limit(0)).count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_a_site_too_large_to_send_is_joined_by_shuffle(spark, monkeypatch):
    from revlens.llm import common

    rows = [(i, f"menu\ntext {i}", "a" if i % 3 else "b") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wanted = sorted(map(tuple, linededup.drop_boilerplate(docs).collect()))
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, linededup.drop_boilerplate(docs).collect())) == wanted
    assert all(t == f"text {i}" for i, t, _ in wanted)


def test_hosts(spark):
    df = spark.createDataFrame([("http://M.Example.com:80/a?b=1",), (None,)], "url string")
    assert [r[0] for r in df.select(linededup.host("url")).collect()] == ["m.example.com", None]


# ---- SimHash


def plain_fingerprint(text, size=4):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def components(fps, max_bits):
    """Smallest id reachable, by comparing all pairs."""
    ids = sorted(fps)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints(spark, odd):
    texts = random_texts(300, 60, 8) + ["A B\tC\x0bD\x0cE " * 300, "ÄÖ Ü x y z"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    got = simhash.near_duplicates(odd).collect()
    fps = {i: plain_fingerprint(t) for i, t in ODD if i}
    wanted = components(fps, 4)
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == sorted((i or -1, wanted[i] if i else -1) for i, _ in ODD)
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [20_000, 6])
@pytest.mark.parametrize("max_bits", [4, 1])
def test_trie_join_by_brute_force(spark, monkeypatch, hot, max_bits):
    """Dense groups and chains of fingerprints, also where subtries are opened into node pairs."""
    monkeypatch.setattr(simhash, "HOT_NODE", hot)
    rng = random.Random(hot + max_bits)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(40):
            near = centre
            for _ in range(rng.randint(0, 6)):
                near ^= 1 << rng.randrange(64)
            fps.add(near)
            if rng.random() < 0.1:
                centre = near
    fps |= {rng.getrandbits(64) for _ in range(100)} | {0, 2**64 - 1}
    nodes = dict(enumerate(sorted(fps, key=lambda x: rng.random())))
    signed = [(i, int(np.array(f, np.uint64).view(np.int64))) for i, f in nodes.items()]
    links = simhash.linked_classes(spark.createDataFrame(signed, "rep long, fp long"), max_bits).collect()
    for r in links:
        assert r.a != r.b
    wanted = components(nodes, max_bits)
    parent = {i: i for i in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        x, y = find(r.a), find(r.b)
        parent[max(x, y)] = min(x, y)
    assert {i: find(i) for i in nodes} == wanted


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(3, text, 0), (1, text + " end", 0), (2, "other words " * 20, 0), (2, "other words " * 20, 1), (None, text, 0), (None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone int")
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id or -1) for r in got.collect())) == [-1, -1, 1, 2]


def test_an_id_links_all_classes_of_its_texts(spark):
    rng = random.Random(21)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(6)]
    rows = [(i + 1, t) for i, t in enumerate(texts)] + [(9, t) for t in texts[:5]]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = simhash.near_duplicates(df, max_bits=0).collect()
    assert len({r.fp for r in found}) == 6
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted([(i, 1) for i in range(1, 6)] + [(9, 1)] * 5 + [(6, 6)])


def test_components_of_long_paths_and_stars(spark):
    from revlens.llm.components import connected_components

    path = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(10, 60)]
    links = spark.createDataFrame([*path, *star, (5, 5), (None, 7)], "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in [1, *range(10, 60)]}}
    assert connected_components(links.limit(0)).count() == 0


def test_memo_forgets_but_answers():
    from revlens.llm.common import Memo

    made = collections.Counter()

    def make(k):
        made[k] += 1
        return k * 2

    for memo in (Memo(make, 5), Memo(make, 5, lambda ks: [make(k) for k in ks])):
        for _ in range(3):
            assert memo.many(list(range(12))) == [2 * k for k in range(12)]
            assert [memo[k] for k in (3, 11, 3)] == [6, 22, 6]
        assert len(memo) + len(memo._old) <= 2 * 12


def test_folds(spark):
    from revlens.llm.common import fold

    df = spark.createDataFrame([(i,) for i in (0, 7, 123456, None)], "doc_id long")
    wanted = [zlib.crc32(str(i).encode() if i is not None else b"") % 5 for i in (0, 7, 123456, None)]
    assert [r[0] for r in df.select(fold("doc_id")).collect()] == wanted
    assert df.select(fold(F.col("doc_id"))).count() == 4
