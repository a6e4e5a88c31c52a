"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import Memo, fold, labelled_sample
from revlens.llm.words import blocks, gather

#: Labelled rows a fit may take.
FIT_ROWS = 20_000
#: Words share this many vectors by a hash; the first ones are for what is no word.
WORDS, MARKS = 8192, 256
#: Numbers of a vector, those of them that are not 0 in a word's index vector, words of context a side.
SIZE, ACTIVE, REACH = 32, 4, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 60, 256, 0.01, 1e-4
THRESHOLD = 0.3
FEATURES = 2 * SIZE + 2

_PARTS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_UPPER, _TITLE, _NUMBER = 1, 2, 3


@lru_cache(maxsize=1)
def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of every word the places of its ``ACTIVE`` numbers, and their signs; the same in every run."""
    rng = np.random.default_rng(20240229)
    return rng.integers(0, SIZE, (WORDS, ACTIVE)), rng.choice([-1.0, 1.0], (WORDS, ACTIVE))


def _codes(chunk: str) -> bytes:
    """Numbers of a stretch without white space: its words, marks and digits, and how they are written."""
    out = []
    for part in _PARTS.findall(chunk):
        if part[0].isalpha():
            if len(part) > 1 and part.isupper():
                out.append(_UPPER)
            elif part[0].isupper():
                out.append(_TITLE)
            out.append(MARKS + crc32(part.lower().encode()) % (WORDS - MARKS))
        elif part[0].isdigit():
            out.append(_NUMBER)
        else:
            out.append(8 + crc32(part.encode()) % (MARKS - 8))
    return np.array(out, "<u2").tobytes()


def coded(texts: pa.Array, memo: Memo[str, bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers of the texts, block by block, and where each text ends among them."""
    texts = pc.fill_null(texts, "")
    for start, stop in blocks(texts):
        chunks = pc.utf8_split_whitespace(texts.slice(start, stop - start))
        offsets = chunks.offsets.to_numpy().astype(np.int64)
        words = chunks.flatten().dictionary_encode()
        if not len(words):
            yield np.empty(0, np.int64), np.zeros(stop - start, np.int64)
            continue
        values = memo.many(words.dictionary.to_numpy(zero_copy_only=False))
        ids, ends = gather(values, words.indices.to_numpy().astype(np.int64), "<u2")
        ends = np.concatenate(([0], ends))
        yield ids.astype(np.int64), ends[offsets[1:] - offsets[0]]


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """A vector for every word number, from all neighbours it has in all texts.

    A word's vector is the sum of the index vectors of the words up to ``REACH`` away. Each task adds
    its own up and returns a row per word number; their sums are ``WORDS`` rows whatever the input.
    Rows come back centred and of length one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros(WORDS * SIZE)
        memo: Memo[str, bytes] = Memo(_codes, 200_000)
        for batch in batches:
            for ids, ends in coded(batch.column("text"), memo):
                text = np.repeat(np.arange(len(ends)), np.diff(np.concatenate(([0], ends))))
                for away in range(1, REACH + 1):
                    same = text[away:] == text[:-away]
                    left, right = ids[:-away][same], ids[away:][same]
                    for word, beside in ((left, right), (right, left)):
                        for k in range(ACTIVE):
                            sums += np.bincount(word * SIZE + places[beside, k], signs[beside, k], WORDS * SIZE)
        rows = sums.reshape(WORDS, SIZE)
        used = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), *(pa.array(rows[used, i].astype(np.int64)) for i in range(SIZE))],
            ["word", *(f"v{i}" for i in range(SIZE))],
        )

    schema = "word int, " + ", ".join(f"v{i} bigint" for i in range(SIZE))
    found = (
        docs.select(F.col(text_col).cast("string").alias("text"))
        .mapInArrow(run, schema)
        .groupBy("word")
        .agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(SIZE)])
        .collect()
    )
    out = np.zeros((WORDS, SIZE))
    for row in found:
        out[row[0]] = row[1:]
    some = out.any(axis=1)
    out[some] /= np.linalg.norm(out[some], axis=1, keepdims=True)
    if some.any():
        out[some] -= out[some].mean(axis=0)
        out[some] /= np.maximum(np.linalg.norm(out[some], axis=1, keepdims=True), 1e-12)
    return out.astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray, memo: Memo[str, bytes]) -> np.ndarray:
    """Per text the mean and the spread of its words' vectors, its length and the mean's length."""
    out = []
    for ids, ends in coded(texts, memo):
        start = 0
        for end in ends.tolist():
            n = end - start
            total, squares = np.zeros(SIZE), np.zeros(SIZE)
            for at in range(start, end, 1 << 15):
                rows = vectors[ids[at : min(end, at + (1 << 15))]]
                total += rows.sum(axis=0, dtype=np.float64)
                squares += np.einsum("ij,ij->j", rows, rows, dtype=np.float64)
            mean = total / max(1, n)
            spread = np.sqrt(np.maximum(squares / max(1, n) - mean * mean, 0.0))
            out.append(np.concatenate((mean, spread, [np.log1p(n), np.linalg.norm(mean)])))
            start = end
    return np.array(out).reshape(-1, FEATURES)


@dataclass(frozen=True)
class Network:
    """Input scaling, a hidden layer of tanh units, one output; logits are divided by ``heat``."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    heat: float = 1.0

    def logits(self, rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((rows - self.centre) / self.scale) @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(rows) / self.heat)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def _loss(z: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0.0, z) - labels * z))


def learn(rows: np.ndarray, labels: np.ndarray, check: np.ndarray) -> Network:
    """The network by Adam on the rows not in ``check``; its temperature by the loss on those in it."""
    rng = np.random.default_rng(11)
    x, y = rows[~check], labels[~check].astype(float)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - centre) / scale
    w = [
        rng.normal(0, 1 / np.sqrt(rows.shape[1]), (rows.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        np.array(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))),
    ]
    first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), BATCH):
            part = order[at : at + BATCH]
            hidden = np.tanh(z[part] @ w[0] + w[1])
            off = (_sigmoid(hidden @ w[2] + w[3]) - y[part]) / len(part)
            back = np.outer(off, w[2]) * (1 - hidden * hidden)
            slopes = [z[part].T @ back + DECAY * w[0], back.sum(axis=0), hidden.T @ off + DECAY * w[2], off.sum()]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                rate = RATE * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                w[i] = w[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    net = Network(centre, scale, w[0], w[1], w[2], float(w[3]))
    held, marks = (rows[check], labels[check]) if check.any() else (rows, labels)
    logits = net.logits(held)
    heats = np.geomspace(0.25, 16.0, 97)
    heat = float(heats[np.argmin([_loss(logits / t, marks) for t in heats])])
    return Network(net.centre, net.scale, net.w1, net.b1, net.w2, net.b2, heat)


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    network: Network | None
    share: float  # of label 1; the score if there is no network

    def score(self, rows: np.ndarray) -> np.ndarray:
        return self.network.probability(rows) if self.network else np.full(len(rows), self.share)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Word vectors from all texts; the network from labelled rows that are not held out.

    A fifth of those sets the temperature. Without labels, or with labels of one kind, the score is
    their share (a half without any).
    """
    vectors = word_vectors(docs, text_col)
    sample = labelled_sample(docs, labels, FIT_ROWS, 0, id_col, text_col, label_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: Memo[str, bytes] = Memo(_codes, 200_000)
        for batch in batches:
            rows = pooled(batch.column("text"), vectors, memo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["id", "label", "f"],
            )

    rows = sample.mapInArrow(run, "id bigint, label int, f binary").orderBy("id").collect()  # about FIT_ROWS
    marks = np.array([r["label"] for r in rows])
    if not len(marks) or marks.min() == marks.max():
        return Model(vectors, None, float(marks.mean()) if len(marks) else 0.5)
    features = np.array([np.frombuffer(r["f"]) for r in rows])
    check = np.array([crc32(f"check {r['id']}".encode()) % 5 == 0 for r in rows])
    if len({*marks[~check].tolist()}) < 2:
        check[:] = False
    return Model(vectors, learn(features, marks, check), float(marks.mean()))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row.

    The score sees the text only. NULL and empty texts have vectors of zeros and are scored as such.
    Rows with a NULL id are scored too; their ``held_out`` is that of the empty text. Repeated rows
    each come back. No rows, no rows. Only the two named columns are read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: Memo[str, bytes] = Memo(_codes, 200_000)
        for batch in batches:
            found = model.score(pooled(batch.column("text"), model.vectors, memo))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")
    return scored.select(
        "doc_id", (fold("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
