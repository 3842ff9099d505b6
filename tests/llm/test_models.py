"""The classifier's pairs, the mixing's optimum and the shards' order against plain computations."""

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA

from spanforge.llm import factorisation, features, hilbert_shards, soft_mixing
from spanforge.llm import words as W


def test_op1_scores_are_the_sum_over_all_pairs():
    draw = np.random.default_rng(4)
    model = factorisation.Machine(0.3, draw.normal(size=features.SIZE), draw.normal(size=(features.SIZE, 4)))
    texts = pa.array(["one two two three", "", "a b c d e f g h i j k l m n a b c", None, "x"])
    chunk = next(W.chunks(texts, True))
    rows = features.sparse(chunk, np.full(len(texts), np.nan))
    got = factorisation.raw_scores(model, rows)
    for k in range(len(texts)):
        index, value = rows.index[rows.begin[k] : rows.begin[k + 1]], rows.value[rows.begin[k] : rows.begin[k + 1]].astype(float)
        wanted = model.bias + sum(model.linear[i] * x for i, x in zip(index, value, strict=True))
        for a in range(len(index)):
            for b in range(a):
                wanted += model.factors[index[a]] @ model.factors[index[b]] * value[a] * value[b]
        assert abs(got[k] - wanted) < 1e-4 * max(1, abs(wanted))


@pytest.mark.parametrize("stored", [3, 1000])
def test_op10_rates_meet_the_targets_and_stay_nonnegative(spark, monkeypatch, stored):
    """Also where rates are stored on the way, which changes none of them."""
    monkeypatch.setattr(soft_mixing, "STORED", stored)
    draw = np.random.default_rng(7)
    posterior = draw.dirichlet([2, 1, 0.5], 300)
    tokens = draw.integers(1, 500, 300)
    table = spark.createDataFrame([(k, int(t), p.tolist()) for k, (t, p) in enumerate(zip(tokens, posterior, strict=True))], "k int, n_tokens long, posterior array<double>")
    fit = soft_mixing.fit_rates(table, (0.6, 0.3, 0.1))
    assert fit.reached and len(fit.steps) <= stored and ("_start" in fit.table.columns) == (stored == 3)
    out = soft_mixing.rated(fit.table, fit.steps)
    assert out.columns == ["k", "n_tokens", "posterior", "rate"]
    rates = np.array([r.rate for r in out.orderBy("k").collect()])
    assert (rates >= 0).all()
    assert np.allclose((tokens * rates) @ posterior, fit.totals) and np.abs(fit.totals - fit.targets).max() <= 2 * soft_mixing.TOLERANCE * fit.targets.sum()


def test_op10_tells_what_is_out_of_reach(spark):
    """A domain that no row can be without."""
    table = spark.createDataFrame([(10, [0.9, 0.1]), (20, [0.8, 0.2])], "n_tokens long, posterior array<double>")
    assert not soft_mixing.fit_rates(table, (0.05, 0.95), 30.0).reached


def test_op4_slots_follow_the_curve_and_files_are_pruned(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    sharded = hilbert_shards.hilbert_shards(docs, hilbert_shards.document_levels()).select("doc_id", "lang", "curve", "shard", "slot").persist()
    rows = sorted(sharded.collect(), key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in rows] == sorted(r.curve for r in rows)
    hilbert_shards.write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(rows)
    spans = {r.shard: (r.low, r.high) for r in back.groupBy("shard").agg({"curve": "min"}).withColumnRenamed("min(curve)", "low").join(back.groupBy("shard").agg({"curve": "max"}).withColumnRenamed("max(curve)", "high"), "shard").collect()}
    # Shards meet in one curve index at most, so a box of the quantised dimensions leaves most of them unread.
    assert all(spans[k][1] <= spans[k + 1][0] for k in range(len(spans) - 1))
    assert sum(1 for k in spans if any(r.shard == k and r.lang == rows[0].lang for r in rows)) < len(spans)
