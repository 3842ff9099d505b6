"""Vectorised words of Arrow texts: boundaries, 64-bit hashes and n-gram hashes, a chunk of documents at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
CHUNK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SEED = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _SEED.integers(0, 2**64, 256, dtype=np.uint64, endpoint=False)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_POWER = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the word (a 64-bit finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWER
    if len(_POWER) < n:
        _POWER = np.concatenate([[np.uint64(1)], np.cumprod(np.full(2 * n, _A), dtype=np.uint64)])
    return _POWER


class Chunk(NamedTuple):
    """Documents first..last-1 of a batch: bytes as they came, byte offsets, and by word its start, end, hash; words[i] is where document i's words begin."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    words: np.ndarray


def _layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def chunks(texts: pa.Array, lower: bool, limit: int = CHUNK, hashed: bool = True, space: np.ndarray = SPACE) -> Iterator[Chunk]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a string array, or the runs of bytes not in ``space``, in chunks of whole
    documents of about ``limit`` bytes; nulls have none."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    data, offsets = _layout(texts)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1))
        part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        word = ~space[part]
        before = np.zeros(len(word) + 1, bool)
        before[1:] = word
        before[at] = False
        starts = np.flatnonzero(word & ~before[:-1])
        after = np.zeros(len(word) + 1, bool)
        after[:-1] = word
        after[at] = False
        ends = np.flatnonzero(word & ~after[1:]) + 1
        words = np.searchsorted(starts, at)
        yield Chunk(i, j, part, at, starts, ends, word_hashes(LOWER[part] if lower else part, word, starts, ends) if hashed else np.zeros(0, np.uint64), words)
        i = j


def word_hashes(data: np.ndarray, word: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = _BYTE[data[word]] * _powers(int(lengths.max()))[within]
    return mix(np.add.reduceat(values, first) ^ (lengths.astype(np.uint64) * _C))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position (those within len - n + 1)."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:size].copy()
    for k in range(1, n):
        out = (out ^ (out >> np.uint64(29))) * _A + hashes[k : k + size] * _B
    return mix(out)


def gram_starts(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a chunk where an n-gram lies within one document, and that document's number in the chunk."""
    counts = np.maximum(np.diff(words) - n + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return words[:-1][doc] + within, doc


def split(text: str | bytes | None) -> list[bytes]:
    """Words of one text as bytes; bytes.split() parts at exactly the six white-space bytes."""
    return text.encode().split() if isinstance(text, str) else (text or b"").split()
