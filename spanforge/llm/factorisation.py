"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of features x is sigmoid(w0 + sum w_i x_i + sum over pairs of (v_i . v_j) x_i x_j); the pair term is half of
(sum v_i x_i)^2 - sum (v_i x_i)^2 by factor, so scoring takes time in proportion to a document's features.

The driver fits on at most SAMPLE labelled documents (AdaGrad, fixed seed); the model's size is fixed by BUCKETS and
FACTORS. Defined cases: null and empty texts are scored by bias, statistics and metadata alone; repeated rows get equal
scores; with no labelled document every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.features import SIZE, Sparse, batches_of, labelled_sample
from spanforge.llm.shared import crc_of_id, small_batches

FACTORS, SAMPLE, EPOCHS, BATCH, RATE, DECAY, THRESHOLD = 8, 10_000, 6, 64, 0.1, 1e-5, 0.3


class Machine(NamedTuple):
    bias: float
    linear: np.ndarray
    factors: np.ndarray


def raw_scores(model: Machine, rows: Sparse) -> np.ndarray:
    """Before the sigmoid. Every row has the statistics, so none of the sums below is over nothing."""
    if len(rows.begin) < 2:
        return np.zeros(0)
    first = rows.begin[:-1]
    linear = np.add.reduceat(model.linear[rows.index] * rows.value, first)
    part = model.factors[rows.index] * rows.value[:, None]
    sums = np.add.reduceat(part, first, axis=0)
    squares = np.add.reduceat((part**2).sum(axis=1), first)
    return model.bias + linear + 0.5 * ((sums**2).sum(axis=1) - squares)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(index: list[np.ndarray], value: list[np.ndarray], label: np.ndarray, seed: int = 1) -> Machine:
    draw = np.random.Generator(np.random.PCG64(seed))
    linear, factors, bias = np.zeros(SIZE, np.float32), draw.normal(0, 0.03, (SIZE, FACTORS)).astype(np.float32), 0.0
    seen_l, seen_f, seen_b = np.full(SIZE, 1e-2, np.float32), np.full((SIZE, FACTORS), 1e-2, np.float32), 1e-2
    for _ in range(EPOCHS if len(label) else 0):
        order = draw.permutation(len(label))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            sizes = np.array([len(index[k]) for k in some])
            rows = Sparse(np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([index[k] for k in some]), np.concatenate([value[k] for k in some]), sizes)
            error = (sigmoid(raw_scores(Machine(bias, linear, factors), rows)) - label[some]).astype(np.float32)
            each, first = np.repeat(error, sizes), rows.begin[:-1]
            part = factors[rows.index] * rows.value[:, None]
            sums = np.repeat(np.add.reduceat(part, first, axis=0), sizes, axis=0)
            touched, code = np.unique(rows.index, return_inverse=True)
            by = np.argsort(code, kind="stable")
            runs = np.searchsorted(code[by], np.arange(len(touched)))
            slope_l = np.add.reduceat((each * rows.value)[by], runs) + DECAY * linear[touched]
            slope_f = np.add.reduceat(((each * rows.value)[:, None] * (sums - part))[by], runs, axis=0) + DECAY * factors[touched]
            slope_b = float(error.sum())
            seen_l[touched] += slope_l**2
            seen_f[touched] += slope_f**2
            seen_b += slope_b**2
            linear[touched] -= RATE * slope_l / np.sqrt(seen_l[touched])
            factors[touched] -= RATE * slope_f / np.sqrt(seen_f[touched])
            bias -= RATE * slope_b / seen_b**0.5
    return Machine(bias, linear, factors)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = SAMPLE) -> Machine:
    return fit(*labelled_sample(docs, labels, label, limit))


def score(docs: DataFrame, model: Machine, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """keep columns with score and predicted for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, got in batches_of(batches):
            p = sigmoid(raw_scores(sent.value, got)).astype(np.float64)
            yield pa.record_batch({name: rows.column(name) for name in keep} | {"score": pa.array(p), "predicted": pa.array((p >= threshold).astype(np.int32))})

    inputs = [*dict.fromkeys([*keep, "text", *(["n_chars"] if "n_chars" in docs.columns else [])])]
    return docs.select(*inputs).mapInArrow(judge, schema)


def op1_factorisation(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars").withColumn("held_out", F.pmod(crc_of_id(), F.lit(5)) == 0)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality").where(F.pmod(crc_of_id(), F.lit(5)) != 0)
    return score(docs, train(docs, labels), ["doc_id", "held_out"])
