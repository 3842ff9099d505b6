"""Dense hits in one pass, loci in one shuffle, names of very many features, and features without numbers of their own."""

import random

import pytest
from test_greedy import clustered, hits_of, plain_clusters, plain_suppression, suppressed

from spanforge.operators import annotation, greedy, intervals, loci
from spanforge.plans import projections as P
from spanforge.sources import audits


def dense(seed, n=400, places=3000):
    draw = random.Random(seed)
    return [(f"h{k:04}", start := draw.randrange(1, places), start + draw.choice([60, 90, 95, 100, 400]), float(draw.randrange(40)), draw.random() < 0.1) for k in range(n)]


@pytest.mark.parametrize("fold", [20, 150])
def test_windows_of_the_first_pass_give_what_plain_folds_give(spark, monkeypatch, fold):
    """Bins of some 20 hits, some of them over ``fold``, so that windows have open edges and hot neighbours."""
    monkeypatch.setattr(greedy, "PLACE_BIN", 128)
    rows = dense(fold)
    hits = hits_of(spark, rows).persist()
    assert suppressed(hits, fold=fold) == plain_suppression(rows)
    assert clustered(hits, fold=fold) == plain_clusters(rows)


def test_an_island_of_many_hits_is_written_once(spark, monkeypatch):
    made, cut = [], greedy.cut
    monkeypatch.setattr(greedy, "cut", lambda df: made.append(1) or cut(df))
    rows = dense(3)
    hits = hits_of(spark, rows).persist()
    assert suppressed(hits) == plain_suppression(rows) and clustered(hits) == plain_clusters(rows)
    assert len(made) == 4  # the counts of bins and the hits, for each of the two


def test_loci_shuffle_their_members_once(spark):
    members = P.hits(spark, "/root/testdata/sf0.001").selectExpr("*", "id AS anchor_id", "0 AS n_compatible")
    plan = loci.loci(members, members=members)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_names_of_many_features_meet_no_pairs(spark):
    kind = "seqid string, declared_id string, attrs map<string,array<string>>"
    rows = [("s", f"f{k}", {"Name": ["RNA"]}) for k in range(50)] + [("t", "g", {"Name": ["RNA"]}), ("s", "u", {"Name": ["own"]}), ("s", "u", {"Name": ["own"]}), ("s", "own2", {})]
    wanted = spark.createDataFrame([("1", "s", "RNA"), ("2", "t", "RNA"), ("3", "s", "own"), ("4", "s", "own2"), ("5", "t", "own"), ("6", "s", None)], "id string, seqid string, self_id string")
    out = annotation.resolve_ids(wanted, spark.createDataFrame(rows, kind))
    assert {r.id: r.resolved for r in out.collect()} == {"1": None, "2": "g", "3": "u", "4": "own2", "5": None, "6": None}
    assert "collect_set" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_declared_coverage_of_features_whose_numbers_repeat(spark):
    place = "n long, seqid string, start1 int, end1 int"
    features = spark.createDataFrame([(1, "s", 5, 9), (1, "s", 50, 60), (2, "s", 5, 9), (2, "t", 5, 9)], place).withColumn("_n", P.F.col("n"))
    declared = spark.createDataFrame([("s", 1, 20)], "seqid string, start1 int, end1 int")
    lengths = spark.createDataFrame([("s", 100), ("t", 10)], "seqid string, length int")
    got = {r.seqid: (r.n_features, r.n_outside, r.uncovered) for r in audits.declared_coverage(features, declared, lengths).collect()}
    assert got == {"s": (3, 1, 80), "t": (1, 1, 10)}


def test_a_pair_of_an_overlap_join_is_only_compared(spark):
    """Also of intervals that end before they start, over bins' edges, long ones and negative places."""
    draw = random.Random(4)
    spans = [(k, start := draw.randrange(-3000, 9000), start + draw.choice([0, 60, 900, 5000, 40_000])) for k in range(120)] + [(500, 1030, 1010), (501, -5, -1030), (502, 1023, 1024)]
    a = spark.createDataFrame(spans, "id int, s1 int, e1 int").selectExpr("'c' AS seqid", "*")
    b = a.toDF("seqid", "other", "s2", "e2")
    joined = intervals.overlap_join(a, b, ["seqid"], ("s1", "e1", "s2", "e2"))
    want = [(x, y) for x, s1, e1 in spans for y, s2, e2 in spans if s1 <= e2 and s2 <= e1]
    assert sorted((r.id, r.other) for r in joined.collect()) == sorted(want)
    (join,) = [x for x in joined._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
    assert "POWER" not in join and "FLOOR" not in join
