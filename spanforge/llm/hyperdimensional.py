"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1; a 3-letter gram is the product of its letters' vectors, the first rotated
twice and the second once; a text is the sum of its grams' vectors, and so is a language over its documents. A text
takes the language whose prototype has the largest cosine. As binding and bundling are linear in gram counts, the
prototypes come from one distributed count of grams by language.

Letters are alphabetic characters, lower-cased; anything else is a boundary, and counts as one letter at word edges.
Defined cases: a null text, or one without a letter, is ``und`` with score 0; with no labelled document all are ``und``.
Ties go to the first language by name; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.shared import crc_of_id, small_batches

#: Dimensions of a vector; symbols that letters fall into (0 is the boundary); gram size; bytes of text at once.
DIMENSIONS, SYMBOLS, GRAM, BYTES = 1024, 64, 3, 1 << 19


@lru_cache(1)
def letter_table() -> np.ndarray:
    """Symbol of each code point: 0 if not alphabetic; a-z their own; others share the rest by code point."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(len(out)):
        if chr(c).isalpha():
            x = ord(chr(c).lower()[0])
            out[c] = x - 96 if 97 <= x <= 122 else 27 + x % (SYMBOLS - 27)
    return out


@lru_cache(1)
def letter_vectors() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(7)).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    vectors = letter_vectors()
    a, b, c = grams // SYMBOLS**2, grams // SYMBOLS % SYMBOLS, grams % SYMBOLS
    return np.roll(vectors, 2, axis=1)[a] * np.roll(vectors, 1, axis=1)[b] * vectors[c]


def document_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Gram of each place that holds a letter in its middle or a word of one letter, and the number of its text."""
    joined = "\x00\x00".join(texts) + "\x00\x00"
    symbols = letter_table()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
    ends = np.cumsum(np.fromiter((len(x) + 2 for x in texts), np.int64, len(texts)))
    first = np.concatenate([[0], symbols[:-1]])
    last = np.concatenate([symbols[1:], [0]])
    at = np.flatnonzero(symbols)
    return first[at] * SYMBOLS**2 + symbols[at] * SYMBOLS + last[at], np.searchsorted(ends, at, "right")


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about BYTES bytes, with the place of the first; nulls are empty."""
    column, first, run, size = batch.column("text"), 0, [], 0
    for k, value in enumerate(column):
        text = value.as_py() or ""
        run.append(text)
        size += len(text)
        if size >= BYTES:
            yield first, run
            first, run, size = k + 1, [], 0
    if run:
        yield first, run


def gram_counts(docs: DataFrame) -> DataFrame:
    """Counts of grams by language over all documents with one: lang, gram, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for first, texts in _texts(batch):
                grams, owner = document_grams(texts)
                langs = batch.column("lang").slice(first, len(texts)).to_pylist()
                for lang in set(langs):
                    own = np.array([x == lang for x in langs])[owner]
                    got = np.bincount(grams[own], minlength=SYMBOLS**GRAM)
                    totals[lang] = totals[lang] + got if lang in totals else got
        for lang, n in totals.items():
            seen = np.flatnonzero(n)
            yield pa.record_batch({"lang": pa.array([lang] * len(seen), pa.string()), "gram": pa.array(seen, pa.int32()), "n": pa.array(n[seen], pa.int64())})

    labelled = docs.where("lang is not null").select("text", "lang")
    return labelled.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def prototypes(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages by name, and a unit vector for each. Bounded: at most SYMBOLS**3 counts a language reach the driver."""
    rows = gram_counts(docs).toArrow().to_pydict()
    langs = sorted(set(rows["lang"]))
    out = np.zeros((len(langs), DIMENSIONS), np.float32)
    which, grams, n = np.array([langs.index(x) for x in rows["lang"]], np.int64), np.array(rows["gram"], np.int64), np.array(rows["n"], np.float64)
    for k in range(len(langs)):
        own = which == k
        total = max(n[own].sum(), 1)
        for at in range(0, int(own.sum()), 4096):
            out[k] += (n[own][at : at + 4096] / total).astype(np.float32) @ gram_vectors(grams[own][at : at + 4096]).astype(np.float32)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return langs, out / np.where(norms > 0, norms, 1)


def identify(docs: DataFrame, langs: list[str], vectors: np.ndarray, keep: list[str]) -> DataFrame:
    """keep columns with lang_pred and score (0 to 1: the best cosine, moved from -1..1)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((langs, vectors))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, proto = sent.value
        for batch in batches:
            pred, score = [], []
            for _, texts in _texts(batch):
                grams, owner = document_grams(texts)
                present = np.bincount(owner, minlength=len(texts)) > 0
                seen, code = np.unique(grams, return_inverse=True)
                counts = np.zeros((len(texts), max(len(seen), 1)), np.float32)
                if len(seen):
                    flat = np.bincount(owner * len(seen) + code, minlength=counts.size)
                    counts = flat.reshape(counts.shape).astype(np.float32)
                    bundles = counts @ gram_vectors(seen).astype(np.float32)
                else:
                    bundles = np.zeros((len(texts), DIMENSIONS), np.float32)
                norms = np.linalg.norm(bundles, axis=1, keepdims=True)
                cosines = (bundles / np.where(norms > 0, norms, 1)) @ proto.T if names else np.zeros((len(texts), 0))
                for k in range(len(texts)):
                    best = int(np.argmax(cosines[k])) if names and present[k] else -1
                    pred.append(names[best] if best >= 0 else "und")
                    score.append(float(np.clip((cosines[k][best] + 1) / 2, 0, 1)) if best >= 0 else 0.0)
            columns = {name: batch.column(name) for name in keep}
            yield pa.record_batch(columns | {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(score, pa.float64())})

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(judge, schema)


def op9_hyperdimensional(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.pmod(crc_of_id(), F.lit(5)) == 0)
    langs, vectors = prototypes(docs.where("not held_out"))
    return identify(docs, langs, vectors, ["doc_id", "held_out"])
