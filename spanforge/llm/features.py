"""Sparse features of documents: hashed words, structure statistics and metadata, computed a chunk at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm import words as W

#: Buckets that words are hashed into; then come the statistics, one feature each.
BUCKETS = 1 << 15
STATISTICS = ("log_words", "log_bytes", "mean_word", "distinct_words", "top_word", "repeated_windows", "upper", "digits", "punctuation", "symbols", "shouts", "other_bytes", "log_lines", "short_words", "log_longest", "log_stated_chars")
SIZE = BUCKETS + len(STATISTICS)
#: Centre and spread that statistics are brought to (fixed scales, not fitted): values are clipped to -3..3 after.
_CENTRE = np.array([5.5, 7, 6, 0.6, 0.1, 0.1, 0.05, 0.01, 0.03, 0.02, 0.01, 0.1, 2, 0.2, 3, 7])
_SPREAD = np.array([2, 2, 2, 0.3, 0.1, 0.3, 0.1, 0.05, 0.03, 0.05, 0.05, 0.1, 1.5, 0.2, 1, 2])
_CLASS = np.zeros(256, np.int64)
for _n, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?\"'()-", b"#*$%&|<>", b"!", bytes(range(128, 256)), b"\n"), 1):
    _CLASS[list(_chars)] = _n


class Sparse(NamedTuple):
    """Documents of a chunk: row k has index[begin[k]:begin[k + 1]] with values, statistics last; n words each."""

    begin: np.ndarray
    index: np.ndarray
    value: np.ndarray
    n: np.ndarray


def _per(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    return total / np.maximum(n, 1)


def sparse(chunk: W.Chunk, stated: np.ndarray) -> Sparse:
    """stated: the metadata count of characters by document, NaN where there is none."""
    docs, size = chunk.last - chunk.first, np.diff(chunk.offsets)
    n = np.diff(chunk.words)
    owner = np.repeat(np.arange(docs), n)
    keys, counts = np.unique(owner * BUCKETS + (chunk.hashes % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    row, weight = keys // BUCKETS, np.log1p(counts)
    norm = np.sqrt(np.bincount(row, weight**2, docs))
    classes = np.bincount(np.repeat(np.arange(docs) * 8, size) + _CLASS[chunk.data], minlength=docs * 8).reshape(docs, 8)
    lengths = chunk.ends - chunk.starts
    longest, top = np.zeros(docs), np.zeros(docs)
    np.maximum.at(longest, owner, lengths)
    np.maximum.at(top, row, counts)
    starts, of = W.gram_starts(chunk.words, 3)
    windows = W.grams(chunk.hashes, 3)[starts] if len(starts) else np.zeros(0, np.uint64)
    different = np.zeros(docs)
    if len(starts):
        order = np.lexsort((windows, of))
        new = np.concatenate([[True], (windows[order][1:] != windows[order][:-1]) | (of[order][1:] != of[order][:-1])])
        different = np.bincount(of[order][new], minlength=docs)
    total = np.bincount(of, minlength=docs)
    stated = np.where(np.isnan(stated) | (stated < 0), size, stated)
    table = np.stack(
        [np.log1p(n), np.log1p(size), _per(np.bincount(owner, lengths, docs), n), _per(np.bincount(row, minlength=docs), n), _per(top, n), 1 - np.where(total > 0, _per(different, total), 1),
         *(_per(classes[:, k], size) for k in (1, 2, 3, 4, 5, 6)), np.log1p(classes[:, 7]), _per(np.bincount(owner, lengths <= 2, docs), n), np.log1p(longest), np.log1p(stated)],
        axis=1,
    )
    table = np.clip((table - _CENTRE) / _SPREAD, -3, 3) / 4
    per_row = np.bincount(row, minlength=docs)
    begin = np.concatenate([[0], np.cumsum(per_row + len(STATISTICS))])
    index, value = np.empty(begin[-1], np.int32), np.empty(begin[-1], np.float32)
    spot = np.arange(len(keys)) + np.repeat(np.arange(docs) * len(STATISTICS), per_row)
    index[spot], value[spot] = keys % BUCKETS, weight / norm[row]
    tail = (begin[1:, None] - len(STATISTICS)) + np.arange(len(STATISTICS))
    index[tail], value[tail] = BUCKETS + np.arange(len(STATISTICS)), table
    return Sparse(begin, index, value, n)


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Sparse]]:
    """Each chunk of documents as (its rows, its features); a column n_chars, where there is one, is metadata."""
    for batch in batches:
        for chunk in W.chunks(batch.column("text"), True):
            rows = batch.slice(chunk.first, chunk.last - chunk.first)
            stated = rows.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False) if "n_chars" in batch.schema.names else np.full(rows.num_rows, np.nan)
            yield rows, sparse(chunk, stated)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Features and labels of at most ``limit`` labelled documents, those of least hashed id: the bound on what the
    driver fits on. Rows without an id or label are passed over; of several labels of one id the least
    counts, and of several texts the least, so that no id sends the driver more than one row."""
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias("_label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    used = ["text", *(["n_chars"] if "n_chars" in docs.columns else [])]
    sample = docs.select("doc_id", *used).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "_label").agg(F.min(F.struct(*used)).alias("_row")).select("doc_id", "_label", "_row.*")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, got in batches_of(batches):
            cut = lambda x: pa.ListArray.from_arrays(pa.array(got.begin.astype(np.int32)), pa.array(x))
            yield pa.record_batch({"doc_id": rows.column("doc_id"), "label": rows.column("_label").cast(pa.int32()), "index": cut(got.index), "value": cut(got.value)})

    table = sample.mapInArrow(extract, "doc_id long, label int, index array<int>, value array<float>").toArrow().sort_by("doc_id")
    split = lambda name: [x.values.to_numpy(zero_copy_only=False) for x in table.column(name)]
    return split("index"), split("value"), table.column("label").to_numpy()
