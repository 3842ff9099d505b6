"""Mixing to target weights with soft domain membership.

A softmax classifier, fitted on a labelled table, gives each document a posterior over domains. Document rates r >= 0
are then fitted by least squares, so that the expected domain token totals sum(tokens * r * posterior) meet the targets.
Projected gradient, distributed: a step needs only the K totals under the present rates, and a document's rate follows
from its posterior and the steps so far, so the driver keeps K numbers a step and no rate. Residuals are weighted by
the domains' available tokens, and rates by tokens, which leaves a well-conditioned problem; the step is one over the
largest eigenvalue of its K x K matrix. Every STORED steps the rates are written, and the next steps go on from there, so
that a step costs no more the later it is. Steps end when the targets are met, when the rates no longer move, as the
bounds then allow no better, or after STEPS; the column reached tells whether the targets are met.

Defined cases: a null or empty text has no tokens and rate by its posterior; domains with no available token are left
out of the fit; an empty table gives no rows; with no label every posterior is even.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from spanforge.llm.features import SIZE, batches_of, labelled_sample
from spanforge.llm.shared import dropped, small_batches, written

DOMAINS = ("clean", "toxic", "low")
SHARES = (0.95, 0.04, 0.01)
SAMPLE, EPOCHS, BATCH, RATE = 10_000, 6, 64, 0.3
STEPS, STORED, TOLERANCE = 400, 20, 1e-3
#: Mean change of a token's rate in a step under which the rates stand still.
STILL = 1e-5


def domain_labels(labels: DataFrame) -> DataFrame:
    """Domain number of each labelled document: low quality, else toxic, else clean; null where no label tells."""
    domain = F.when(F.col("quality") == 0, 2).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 0)
    return labels.select("doc_id", domain.alias("domain"))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_domains(index: list[np.ndarray], value: list[np.ndarray], label: np.ndarray, domains: int, seed: int = 1) -> np.ndarray:
    """Weights by feature and domain, the last row being the bias (AdaGrad, fixed seed)."""
    draw = np.random.Generator(np.random.PCG64(seed))
    weights, seen = np.zeros((SIZE + 1, domains), np.float32), np.full((SIZE + 1, domains), 1e-2, np.float32)
    for _ in range(EPOCHS if len(label) else 0):
        order = draw.permutation(len(label))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            sizes = np.array([len(index[k]) for k in some])
            idx, val = np.concatenate([index[k] for k in some]), np.concatenate([value[k] for k in some])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            error = softmax(np.add.reduceat(weights[idx] * val[:, None], first, axis=0) + weights[-1])
            error[np.arange(len(some)), label[some]] -= 1
            slope = np.zeros_like(weights)
            np.add.at(slope, idx, np.repeat(error, sizes, axis=0) * val[:, None])
            slope[-1] = error.sum(axis=0)
            touched = np.append(np.unique(idx), SIZE)
            seen[touched] += slope[touched] ** 2
            weights[touched] -= RATE * slope[touched] / np.sqrt(seen[touched])
    return weights


def posteriors(docs: DataFrame, weights: np.ndarray, keep: list[str]) -> DataFrame:
    """keep columns with n_tokens (words) and posterior, an array by domain."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    schema = docs.select(*keep).schema.add("n_tokens", "long").add("posterior", ArrayType(DoubleType()))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, got in batches_of(batches):
            w = sent.value
            p = softmax((np.add.reduceat(w[got.index] * got.value[:, None], got.begin[:-1], axis=0) + w[-1]).astype(np.float64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))
            yield pa.record_batch({name: rows.column(name) for name in keep} | {"n_tokens": pa.array(got.n.astype(np.int64)), "posterior": lists})

    inputs = [*dict.fromkeys([*keep, "text", *(["n_chars"] if "n_chars" in docs.columns else [])])]
    return docs.select(*inputs).mapInArrow(judge, schema)


def rates(posterior: np.ndarray, steps: np.ndarray, least: np.ndarray | float = 0.0, start: np.ndarray | float = 1.0) -> np.ndarray:
    """Rates after the steps (each a vector by domain, already times the step size), from start, kept at ``least`` or more."""
    r = np.ones(len(posterior)) * start
    for u in steps:
        r = np.maximum(least, r - posterior @ u)
    return r


def _parts(batch: pa.RecordBatch, domains: int) -> tuple[np.ndarray, np.ndarray | float, np.ndarray | float]:
    """Posteriors of a batch, and the least and the stored rates where it has them."""
    least, start = (batch.column(c).to_numpy() if c in batch.schema.names else x for c, x in (("least", 0.0), ("_start", 1.0)))
    return batch.column("posterior").flatten().to_numpy().reshape(-1, domains), least, start


def _sums(table: DataFrame, domains: int, size: int, tell: Callable[..., np.ndarray]) -> np.ndarray:
    """Sum of tell(posteriors, tokens, least rates, stored rates), a vector of that size, over the table: one row a task and number."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            p, least, start = _parts(batch, domains)
            total += tell(p, batch.column("n_tokens").to_numpy().astype(np.float64), least, start)
        yield pa.record_batch({"k": pa.array(np.arange(size), pa.int32()), "x": pa.array(total)})

    out = np.zeros(size)
    used = [c for c in ("n_tokens", "posterior", "least", "_start") if c in table.columns]
    for row in table.select(*used).mapInArrow(add, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect():
        out[row.k] = row.x
    return out


def _totals(table: DataFrame, steps: np.ndarray) -> tuple[np.ndarray, float]:
    """Totals over documents of tokens * rate * posterior after the steps, and of tokens * the last step's change of rate."""

    def tell(p: np.ndarray, t: np.ndarray, least: np.ndarray | float, start: np.ndarray | float) -> np.ndarray:
        before = rates(p, steps[:-1], least, start)
        now = np.maximum(least, before - p @ steps[-1])
        return np.append((t * now) @ p, (t * np.abs(now - before)).sum())

    got = _sums(table, steps.shape[1], steps.shape[1] + 1, tell)
    return got[:-1], got[-1]


class Fit(NamedTuple):
    """The table, with stored rates if there are any, the steps since then, and whether the targets are met by the totals."""

    table: DataFrame
    steps: np.ndarray
    targets: np.ndarray
    totals: np.ndarray
    reached: bool


def fit_rates(table: DataFrame, shares: tuple[float, ...], budget: float | None = None, capped: bool = False) -> Fit:
    """Without a budget, the first domain keeps all its tokens and sets the others'; ``capped`` targets ask no domain for
    more tokens than the table has of it. Rates keep to the column ``least``, if any."""
    k = len(shares)
    gram = _sums(table, k, k * k, lambda p, t, *_: ((p * t[:, None]).T @ p).ravel()).reshape(k, k)
    available = gram.sum(axis=1)
    targets = np.array(shares) * (budget if budget is not None else available[0] / max(shares[0], 1e-12))
    if capped:
        targets = np.minimum(targets, available)
    open_ = available > 0
    if not open_.any():
        return Fit(table, np.zeros((0, k)), targets, available, bool((targets <= 0).all()))
    weight = np.where(open_, 1 / np.where(open_, available, 1), 0)
    root = np.sqrt(weight)
    step = 1 / np.linalg.eigvalsh(root[:, None] * gram * root)[-1]
    steps: list[np.ndarray] = []
    totals, moved, taken, stored = available, np.inf, 0, None
    missed = lambda: np.abs(totals - targets)[open_].max() > TOLERANCE * targets.sum()
    while missed() and moved > STILL * available.sum() and taken < STEPS:
        if len(steps) == STORED:
            before, stored = stored, written(rated(table, np.array(steps)).withColumnRenamed("rate", "_start"), "rates")
            table, steps = stored, []
            if before is not None:
                dropped(before)
        steps.append(step * weight * (totals - targets))
        totals, moved = _totals(table, np.array(steps))
        taken += 1
    return Fit(table, np.array(steps).reshape(-1, k), targets, totals, not missed())


def rated(table: DataFrame, steps: np.ndarray) -> DataFrame:
    """table with rate, after the steps from its stored rates, which go."""
    names = [c for c in table.columns if c != "_start"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, least, start = _parts(batch, steps.shape[1])
            yield pa.record_batch({n: batch.column(n) for n in names} | {"rate": pa.array(rates(p, steps, least, start))})

    return table.mapInArrow(apply, StructType([*table.select(*names).schema.fields, StructField("rate", DoubleType())]))


def soft_mix(docs: DataFrame, labels: DataFrame, keep: list[str], shares: tuple[float, ...] = SHARES, budget: float | None = None, limit: int = SAMPLE, whole: str | None = None) -> DataFrame:
    """keep columns of every row with n_tokens, posterior, rate and reached. ``whole`` names a kept column with the domain that a
    row is known to be of, or null: rows known or else judged to be of the first domain then have rates of 1 or more
    (column least), and targets are capped at what the rows have."""
    index, value, label = labelled_sample(docs, labels, "domain", limit)
    table = posteriors(docs, fit_domains(index, value, label, len(shares)), keep)
    if whole is not None:
        leads = F.col("posterior")[0] >= F.array_max("posterior")
        table = table.withColumn("least", F.coalesce(F.col(whole) == 0, leads).cast("double"))
    table = written(table, "posteriors")
    fit = fit_rates(table, shares, budget, whole is not None)
    return rated(fit.table, fit.steps).withColumn("reached", F.lit(fit.reached))


def copies(rate, key):
    """Whole copies whose expectation is the rate: its floor, and one more where the row's hash falls below the rest."""
    uniform = (F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))).cast("double")
    return (F.floor(rate) + F.when(uniform < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def op10_soft_mixing(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "n_chars")
    labels = domain_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = soft_mix(docs, labels, ["doc_id"])
    return out.select("doc_id", "n_tokens", *[F.col("posterior")[k].alias(f"p_{name}") for k, name in enumerate(DOMAINS)], "rate", "reached")
