"""Toxicity: misspelled lexicon terms found by Levenshtein automata, weighed by their context."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import Memo, fold, staged
from revlens.llm.words import blocks, release

#: Labelled rows a fit may take; more are thinned by a hash of the id.
FIT_ROWS = 20_000
#: With at least this many, one half finds the lexicon and the other weighs it.
SPLIT_ROWS = 1_000
#: Terms and stems a lexicon may have.
MAX_TERMS = 20_000
#: Evidence (G-squared) and share of toxic texts a term needs.
EVIDENCE, PRECISION = 20.0, 0.9
STEM_EVIDENCE, STEM_PRECISION, STEM_SIZES = 25.0, 0.25, (3, 4, 5, 6, 7, 8)
#: Terms from this length on may be misspelled by one edit.
FUZZY_SIZE = 5
#: Words before and after a term that are its context.
WINDOW = 6

#: Words whose matches a task remembers, twice over.
RECENT = 60_000

EXACT, FUZZY, STEM = 1, 2, 3
_PARTS = re.compile(r"[^\W_]+")

# Marks that open and close a quotation.
OPENING, CLOSING = "\"'“„«‹‘‚", "\"'”“»›’‘"
# Words that report what others say.
REPORTING = frozenset(
    "said says saying wrote writes quoted quote quotes called calls term word phrase dit écrit appelé mot "
    "sagte schrieb nannte wort dijo escribió llamó palabra".split()
)
# Words that address the reader.
ADDRESS = frozenset("you your you're u ur tu te vous ton votre toi du dich dein ihr euch tú usted eres vosotros".split())

FEATURES = 11
SCHEMA = "doc_id {0}, f array<double>"


@dataclass
class Lexicon:
    """Terms with weights in a trie; a word meets it by walking its Levenshtein automaton along."""

    terms: dict[str, float]
    stems: dict[str, float] = field(default_factory=dict)
    #: words known from harmless texts: no misspellings
    harmless: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        self._child: list[dict[str, int]] = [{}]
        self._term: list[str | None] = [None]
        self._stem: list[float] = [0.0]
        for word, weight in [*((t, None) for t in self.terms), *self.stems.items()]:
            node = 0
            for letter in word:
                if letter not in self._child[node]:
                    self._child[node][letter] = len(self._child)
                    self._child.append({})
                    self._term.append(None)
                    self._stem.append(0.0)
                node = self._child[node][letter]
            if weight is None:
                self._term[node] = word
            else:
                self._stem[node] = weight
        fuzzy = [t for t in self.terms if len(t) >= FUZZY_SIZE]
        self._heads = {t[: len(t) // 2] for t in fuzzy}
        self._tails = {t[len(t) // 2 :] for t in fuzzy}
        self._head_sizes = sorted({len(h) for h in self._heads})
        self._tail_sizes = sorted({len(t) for t in self._tails})

    def _worth_a_walk(self, word: str) -> bool:
        """One edit leaves the first or the second half of a term as it is, at that end of the word."""
        return any(word[:n] in self._heads for n in self._head_sizes) or any(
            word[-n:] in self._tails for n in self._tail_sizes
        )

    def within_one(self, word: str) -> list[str]:
        """Terms at distance 0 or 1 of ``word``: the automaton of the word intersected with the trie.

        Bit i of ``none`` (``one``) is set if the letters so far can be the first i of the word
        without (with one) edit. A branch ends where both are empty.
        """
        at: dict[str, int] = {}
        for i, letter in enumerate(word):
            at[letter] = at.get(letter, 0) | 1 << i
        whole = 1 << len(word)
        every = (whole << 1) - 1
        found = []
        stack = [(0, 1, 3 & every)]
        while stack:
            node, none, one = stack.pop()
            term = self._term[node]
            if term is not None and (none | one) & whole:
                found.append(term)
            for letter, child in self._child[node].items():
                same = at.get(letter, 0)
                next_none = (none & same) << 1
                next_one = (((one & same) << 1) | none | (none << 1) | (next_none << 1)) & every
                if next_none | next_one:
                    stack.append((child, next_none, next_one))
        return found

    def stem_weight(self, word: str) -> float:
        node, best = 0, 0.0
        for letter in word:
            node = self._child[node].get(letter, -1)
            if node < 0:
                return best
            best = max(best, self._stem[node])
        return best

    def meet(self, word: str) -> tuple[int, float]:
        """Kind and weight of the strongest match of one word; kind 0 if there is none."""
        weight = self.terms.get(word)
        if weight is not None:
            return EXACT, weight
        stem = self.stem_weight(word)
        if stem:
            return STEM, stem
        if len(word) >= FUZZY_SIZE - 1 and self._worth_a_walk(word) and word not in self.harmless:
            near = [self.terms[t] for t in self.within_one(word) if len(t) >= FUZZY_SIZE]
            if near:
                return FUZZY, max(near)
        return 0, 0.0

    def meet_chunk(self, chunk: str) -> float:
        """100 * kind + weight for a stretch without white space: its parts, and they joined."""
        parts = [chunk] if chunk.isalpha() else _PARTS.findall(chunk)
        if len(parts) > 1:
            parts.append("".join(parts))
        best = max((self.meet(p) for p in parts), key=lambda m: (m[1], -m[0]), default=(0, 0.0))
        return 100.0 * best[0] + best[1] if best[0] else 0.0


def context_weight(words: list[str], at: int) -> tuple[float, bool]:
    """What a match counts in its window, and whether it is quoted.

    A term between quotation marks or after a reporting word is someone's words and counts less; one
    beside a word that addresses the reader counts more.
    """
    before, after = words[max(0, at - WINDOW) : at + 1], words[at : at + WINDOW + 1]
    opened = any(w[:1] and w[0] in OPENING for w in before)
    closed = any(w.rstrip(".,;:!?")[-1:] and w.rstrip(".,;:!?")[-1] in CLOSING for w in after)
    quoted = opened and closed
    bare = {w.strip(OPENING + CLOSING + ".,;:!?") for w in words[max(0, at - WINDOW) : at + WINDOW + 1]}
    weight = 0.25 if quoted else 1.0
    if bare & REPORTING:
        weight *= 0.5
    if bare & ADDRESS:
        weight *= 1.25
    return weight, quoted


def _summary(matches: list[tuple[int, float, float, bool]], distinct: int, n_words: int) -> list[float]:
    """Features of a text from its matches (kind, weight, context weight, quoted)."""
    sums = dict.fromkeys((EXACT, FUZZY, STEM), 0.0)
    count = top = quoted = 0.0
    for kind, weight, factor, in_quotes in matches:
        share = factor * (0.5 if kind == FUZZY else 1.0)
        sums[kind] += weight * share
        count += share
        top = max(top, weight * share)
        quoted += in_quotes
    total = sum(sums.values())
    n = max(1, n_words)
    return [
        math.log1p(sums[EXACT]),
        math.log1p(sums[STEM]),
        math.log1p(sums[FUZZY]),
        top,
        math.log1p(100.0 * total / n),
        math.log1p(100.0 * count / n),
        math.log1p(count),
        math.log1p(distinct),
        math.log1p(quoted),
        math.log1p(n_words),
        math.log1p(count) * math.log1p(n_words),
    ]


def features_of(texts: pa.Array, memo: Memo[str, float]) -> Iterator[list[float]]:
    """Features of every text in order; each distinct word of a block is matched once."""
    texts = pc.fill_null(texts, "")
    for start, stop in blocks(texts):
        words = pc.utf8_split_whitespace(pc.utf8_lower(texts.slice(start, stop - start)))
        offsets = words.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        coded = words.flatten().dictionary_encode()
        known = coded.dictionary.to_numpy(zero_copy_only=False)
        if not len(known):
            yield from (_summary([], 0, 0) for _ in range(stop - start))
            continue
        match = np.array(memo.many(known))
        codes = coded.indices.to_numpy()
        blank = np.flatnonzero((known == "")[codes])  # white space at an end, or nothing
        blanks = np.searchsorted(blank, offsets)
        hits = np.flatnonzero(match[codes])
        firsts = np.searchsorted(hits, offsets)
        for doc in range(stop - start):
            a, b = int(offsets[doc]), int(offsets[doc + 1])
            found = []
            for hit in hits[firsts[doc] : firsts[doc + 1]].tolist():
                low, high = max(a, hit - WINDOW), min(b, hit + WINDOW + 1)
                around = known[codes[low:high]].tolist()
                factor, quoted = context_weight(around, hit - low)
                value = float(match[codes[hit]])
                found.append((int(value // 100), value % 100, factor, quoted))
            yield _summary(found, len(set(codes[hits[firsts[doc] : firsts[doc + 1]]].tolist())), b - a - int(blanks[doc + 1] - blanks[doc]))


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray  # of the features, the last one is the constant

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = rows @ self.weights[:-1] + self.weights[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _logistic(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression by Newton steps, features but the constant held small."""
    x = np.concatenate((rows, np.ones((len(rows), 1))), axis=1)
    w = np.zeros(x.shape[1])
    pull = np.diag([ridge] * rows.shape[1] + [1e-3])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + pull, x.T @ (labels - p) - pull @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``id``, ``text``, ``label``, ``half`` of the rows a fit may use, at most about ``FIT_ROWS``."""
    marks = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .where(fold("id") != 0)
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    marks = staged(marks, "fit-labels")
    total = marks.count()
    if total > FIT_ROWS:
        share = int(FIT_ROWS / total * 1_000_000)
        marks = marks.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1_000_000)) < share)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(marks), "id")  # FIT_ROWS rows of two numbers
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)) if total >= SPLIT_ROWS else F.lit(-1)
    return staged(rows.withColumn("half", half.cast("int")), "fit-texts")


def _signature(hashes: np.ndarray) -> int:
    """The smallest word under each of four orders, as one number: alike for copies, else rarely."""
    if not len(hashes):
        return 0
    orders = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)
    least = ((hashes[:, None] * orders) & np.uint64(0xFFFFFFFF)).min(axis=0)
    return int.from_bytes(hashlib.sha256(least.tobytes()).digest()[:8], "little", signed=True)


def _word_rows(sample: DataFrame) -> DataFrame:
    """``label``, ``half`` and the distinct words of each text; of texts with one signature, as copies
    mostly have, one is kept."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(set(_PARTS.findall((t or "").lower()))) for t in batch.column("text").to_pylist()]
            least = [_signature(np.array([crc32(w.encode()) for w in ws], np.uint64)) for ws in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), batch.column("half"), pa.array(least, pa.int64()), pa.array(words, pa.list_(pa.string()))],
                ["id", "label", "half", "sig", "words"],
            )

    rows = sample.mapInArrow(run, "id bigint, label int, half int, sig bigint, words array<string>")
    return rows.groupBy("sig").agg(
        F.max("label").alias("label"), F.min_by("half", "id").alias("half"), F.min_by("words", "id").alias("words")
    )


def _telling(counts: DataFrame, toxic: int, total: int, evidence: float, precision: float) -> dict[str, float]:
    """Strings whose texts are toxic far more often than chance, with their log-odds (at most 20)."""
    k, n = F.col("k").cast("double"), F.col("n").cast("double")
    cells = [(k, n * toxic / total), (n - k, n * (total - toxic) / total)]
    other = [(toxic - k, (total - n) * toxic / total), (total - n - toxic + k, (total - n) * (total - toxic) / total)]
    g = sum((F.when((o > 0) & (e > 0), 2 * o * F.log(o / e)).otherwise(0.0) for o, e in cells + other), F.lit(0.0))
    odds = F.log((k + 0.5) / (n - k + 0.5)) - math.log((toxic + 0.5) / (total - toxic + 0.5))
    rows = (
        counts.where((k / n >= precision) & (g >= evidence))
        .select("s", F.least(odds, F.lit(20.0)).alias("w"), g.alias("g"))
        .orderBy(F.desc("g"), "s")
        .limit(MAX_TERMS)
        .collect()
    )
    return {r["s"]: r["w"] for r in rows}


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """Lexicon and weights from labelled rows that are not held out (see ``fold``).

    Terms are words that only toxic texts have, stems are beginnings of words that toxic texts have
    more often, as one half of the sample shows; the other half weighs the features, so that terms found by chance are weighed as
    such. Without labels, or with labels of one kind, the score is the labels' share.
    """
    sample = _labelled(docs, labels, id_col, text_col, label_col)
    words = staged(_word_rows(sample), "fit-words")
    seen = words.where("half <> 1").select("label", F.explode("words").alias("s"))
    total, toxic = words.where("half <> 1").agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    terms: dict[str, float] = {}
    stems: dict[str, float] = {}
    harmless: frozenset[str] = frozenset()
    if 0 < toxic < total:
        counts = seen.groupBy("s").agg(F.sum("label").alias("k"), F.count(F.lit(1)).alias("n"))
        terms = _telling(counts.where("k >= 3 and length(s) >= 3"), toxic, total, EVIDENCE, PRECISION)
        starts = words.where("half <> 1").select(
            "label",
            F.explode(
                F.array_distinct(
                    F.flatten(F.transform("words", lambda w: F.array(*[F.when(F.length(w) >= n, F.substring(w, 1, n)) for n in STEM_SIZES])))
                )
            ).alias("s"),
        )
        counts = starts.where("s is not null").groupBy("s").agg(F.sum("label").alias("k"), F.count(F.lit(1)).alias("n"))
        found = _telling(counts.where("k >= 5"), toxic, total, STEM_EVIDENCE, STEM_PRECISION)
        stems = {s: w for s, w in found.items() if w > 0}
        harmless = _harmless(words, Lexicon(terms, stems))
    lexicon = Lexicon(terms, stems, harmless)
    rows = score_features(sample.where("half <> 0"), lexicon, "id").join(
        sample.where("half <> 0").select(F.col("id").alias("doc_id"), "label").distinct(), "doc_id"
    )
    rows = rows.select("f", "label").collect()  # at most about FIT_ROWS rows of FEATURES numbers
    marks = np.array([r["label"] for r in rows], float)
    if not len(marks) or marks.min() == marks.max():
        share = min(max(float(marks.mean()) if len(marks) else 0.0, 1e-3), 1 - 1e-3)
        return Model(lexicon, np.array([0.0] * FEATURES + [math.log(share / (1 - share))]))
    return Model(lexicon, _logistic(np.array([r["f"] for r in rows], float), marks))


def _harmless(words: DataFrame, lexicon: Lexicon) -> frozenset[str]:
    """Words of texts that are not toxic which the lexicon would take for misspellings."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: Memo[str, int] = Memo(lambda w: lexicon.meet(w)[0])
        for batch in batches:
            taken = [w for w in batch.column("s").to_pylist() if memo[w] == FUZZY]
            yield pa.RecordBatch.from_arrays([pa.array(taken, pa.string())], ["s"])

    found = words.where("label = 0").select(F.explode("words").alias("s")).distinct().mapInArrow(run, "s string")
    return frozenset(r["s"] for r in found.collect())  # words of FIT_ROWS texts within one edit of a term


def score_features(docs: DataFrame, lexicon: Lexicon, id_col: str, text_col: str = "text") -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: Memo[str, float] = Memo(lexicon.meet_chunk, RECENT)
        for batch in batches:
            found = list(features_of(batch.column("text"), memo))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "f"])
            release()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA.format(docs.schema[id_col].dataType.simpleString()))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row.

    The score sees the text only. NULL and empty texts have no matches and get the score of that.
    Rows with a NULL id are scored too; their ``held_out`` is that of the empty text. Repeated rows
    each come back. No rows, no rows. Only the two named columns are read.
    """
    scored = score_features(docs, model.lexicon, id_col, text_col)
    weights = F.array(*[F.lit(float(w)) for w in model.weights[:-1]])
    z = F.aggregate(
        F.zip_with("f", weights, lambda a, b: a * b), F.lit(float(model.weights[-1])), lambda total, x: total + x
    )
    score = 1.0 / (1.0 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores below ``threshold``, all columns as they are, whatever their names."""
    text_at = docs.columns.index(text_col)
    schema = docs.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: Memo[str, float] = Memo(model.lexicon.meet_chunk, RECENT)
        for batch in batches:
            rows = np.array(list(features_of(batch.column(text_at).cast(pa.string()), memo))).reshape(-1, FEATURES)
            yield batch.filter(pa.array(model.score(rows) < threshold))
            release()

    return docs.mapInArrow(run, schema)
