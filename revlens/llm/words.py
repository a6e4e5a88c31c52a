"""Texts as words: each distinct word of a batch is worked on once, the rest is array lookups."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from revlens.llm.common import Memo

#: Bytes of text whose words are held at once; a longer text is taken alone, in stretches.
BLOCK = 2 << 20

_SPACE_AFTER_SPACE = r"[\p{Z}\t\n\v\f\r\x{85}\x{1c}-\x{1f}] "
_FREE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def stretches(text: str, size: int = 1 << 16) -> Iterator[str]:
    """The text cut before single spaces between two characters that are no white space.

    Such a space opens a new match of a splitting pattern for byte-level BPE ("optional space, then
    a run of one kind"), and no match reaches over it or looks beyond it, so the stretches' matches
    are the text's matches. At least ``size`` characters each, but for the last.
    """
    at = 0
    while at < len(text):
        found = _FREE_SPACE.search(text, at + size)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def release() -> None:
    """Hand memory of finished batches back, so that idle workers leave it to the executor."""
    pa.default_memory_pool().release_unused()


def blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``BLOCK`` bytes together, or of one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + BLOCK, side="right")))
        yield start, stop
        start = stop


def gather(values: list[bytes], codes: np.ndarray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of all codes one after the other, as numbers, and where each one ends."""
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(dtype).itemsize
    flat = np.frombuffer(b"".join(values), dtype)
    starts = np.cumsum(sizes) - sizes
    many = sizes[codes]
    ends = np.cumsum(many)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(starts[codes] - (ends - many), many)], ends


def encoded(
    texts: pa.Array, after_space: Memo[str, bytes], plain: Callable[[str], bytes], dtype: str
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of the texts in order, block by block: all ids and the ends of the texts in them.

    ``after_space[w]`` holds the ids of " " + w, ``plain(s)`` gives those of any stretch. A NULL text
    has no ids.
    """
    texts = pc.fill_null(texts, "")
    for start, stop in blocks(texts):
        part = texts.slice(start, stop - start)
        if stop - start == 1 and pc.binary_length(part)[0].as_py() > BLOCK:
            ids = np.concatenate([np.frombuffer(plain(s), dtype) for s in stretches(part[0].as_py())])
            yield ids, np.array([len(ids)])
            continue
        wary = pc.match_substring_regex(part, _SPACE_AFTER_SPACE).to_numpy(zero_copy_only=False)
        if wary.any():
            # their words are not independent: each such text is one "word"
            texts_of = part.to_numpy(zero_copy_only=False)
            easy = pc.if_else(pa.array(wary), "", part)
        else:
            easy = part
        split = pc.split_pattern(easy, " ")
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        words = split.flatten().dictionary_encode()
        codes = words.indices.to_numpy().astype(np.int64)
        known = words.dictionary.to_numpy(zero_copy_only=False)
        values = after_space.many(known)
        first, inverse = np.unique(codes[offsets[:-1]], return_inverse=True)
        codes[offsets[:-1]] = len(values) + inverse
        values += [plain(known[c]) for c in first]
        if wary.any():
            at = np.flatnonzero(wary)
            codes[offsets[at]] = len(values) + np.arange(len(at))
            values += [b"".join(map(plain, stretches(texts_of[i]))) for i in at]
        ids, ends = gather(values, codes, dtype)
        yield ids, ends[offsets[1:] - 1]
