"""Joins and counts of tables much larger than the ones at hand: what is few comes to what is many."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanforge.operators import annotation, curation, integrity, seeds, support


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_dealt_by_their_model(spark):
    models = spark.createDataFrame([("m", "xx.x", "<..>"), ("n", "xxxx", None)], "model string, rf string, structure string")
    rows = spark.createDataFrame([("a", "m", "ACGT"), ("b", "n", "A--T"), ("c", "m", None)], "id string, model string, aligned string")
    out = integrity.metrics_by_model(rows, models)
    assert re.search(r"BroadcastHashJoin \[model#\d+\], \[_model#\d+\]", _plan(out))
    assert {r.id: (r.occupied, r.paired_observed) for r in out.collect()} == {"a": (3, 1), "b": (2, 0), "c": (None, None)}


def _banded(query, window, shift, scoring):
    """A cell a step: score, first letters (from 1) in query and window, and the aligned strings."""
    worst, band, cost = -(1 << 30), scoring.band, scoring.gap_open + scoring.gap_extend
    before_h, before_f, trace, best = {}, {}, {}, (0, 0, 0)
    for i, a in enumerate(query, 1):
        h, f, e = {}, {}, worst
        for j in range(max(1, i + shift - band), min(len(window), i + shift + band) + 1):
            left, up = h.get(j - 1, worst), before_h.get(j, worst)
            e_open, e = left - cost >= e - scoring.gap_extend, max(left - cost, e - scoring.gap_extend)
            f_open, f[j] = up - cost >= before_f.get(j, worst) - scoring.gap_extend, max(up - cost, before_f.get(j, worst) - scoring.gap_extend)
            diagonal = max(0, before_h.get(j - 1, 0)) + (scoring.match if a == window[j - 1] and a != "N" else scoring.mismatch)
            h[j] = value = max(0, diagonal, e, f[j])
            trace[i, j] = (0 if not value else 1 if value == diagonal else 2 if value == e else 3, e_open, f_open)
            if value > best[0]:
                best = (value, i, j)
        before_h, before_f = h, f
    score, i, j = best
    q, s, state = [], [], 0
    while kind := state or trace.get((i, j), (0, True, True))[0]:
        _, e_open, f_open = trace.get((i, j), (0, True, True))
        q.append("-" if kind == 2 else query[i - 1])
        s.append("-" if kind == 3 else window[j - 1])
        state = 0 if kind == 1 or (e_open if kind == 2 else f_open) else kind
        i, j = i - (kind != 2), j - (kind != 3)
    return score, i + 1, j + 1, "".join(reversed(q)), "".join(reversed(s))


def _subjects(draw, queries, n):
    bases = lambda k: "".join(draw.choices("ACGTN", [9, 9, 9, 9, 1], k=k))
    out = []
    for _ in range(n):
        text = list(draw.choice(queries))
        for _ in range(draw.randrange(6)):
            at = draw.randrange(len(text))
            text[at : at + draw.randrange(4)] = bases(draw.randrange(4))
        out.append(bases(draw.randrange(30)) + "".join(text) + bases(draw.randrange(30)))
    return out


@pytest.mark.parametrize("scoring", [seeds.Scoring(), seeds.Scoring(band=2), seeds.Scoring(match=2, mismatch=-1, gap_open=0, gap_extend=1, band=5), seeds.Scoring(match=2, mismatch=-2, gap_open=2, gap_extend=1)])
def test_many_bands_at_once_are_those_of_a_cell_a_step(scoring):
    draw, band = random.Random(4), scoring.band
    queries = ["".join(draw.choices("ACGTN", [9, 9, 9, 9, 1], k=draw.randrange(12, 70))) for _ in range(12)]
    texts = _subjects(draw, queries, 150)
    pairs = [(draw.choice(queries), text, draw.randrange(-25, 40)) for text in texts]
    longest = max(len(q) for q, _, _ in pairs)
    number = lambda text, at: ord(text[at]) + 1 if 0 <= at < len(text) else 0
    q = np.array([[number(x, i) for i in range(longest)] for x, _, _ in pairs])
    s = np.array([[number(y, i + d - band) for i in range(longest + 2 * band)] for _, y, d in pairs])
    score, row, place, steps = seeds.banded(q, s, scoring)
    for k, (x, y, d) in enumerate(pairs):
        want = _banded(x, y, d, scoring)
        assert score[k] == want[0]
        if want[0]:
            i, j, a, b = seeds.traced(x, y, int(row[k]), int(row[k] + place[k] + d - band), int(place[k]), steps[:, k])
            assert (i + 1, j + 1, a, b) == want[1:]


def test_hits_are_extended_where_their_seeds_are_found(spark, monkeypatch):
    """No text is shuffled again, and parts of any size give the same hits; also of repeated words and texts without an id."""
    draw = random.Random(9)
    queries = ["".join(draw.choices("ACGT", k=n)) for n in (30, 45, 80)] + ["A" * 30]
    subjects = [*enumerate(_subjects(draw, queries, 40)), (50, "é" + queries[0]), (51, "A" * 90), (None, queries[1]), (52, None)]
    a, b = spark.createDataFrame(subjects, "id int, seq string"), spark.createDataFrame([*enumerate(queries), (None, queries[0])], "item_id int, seq string")
    told = []
    for rows, pairs, letters in ((50_000, 1024, 500_000), (70, 3, 150)):
        monkeypatch.setattr(seeds, "ROWS", rows)
        monkeypatch.setattr(seeds, "PAIRS", pairs)
        monkeypatch.setattr(seeds, "LETTERS", letters)
        out = seeds.extended_hits(a, b)
        assert "Join" not in out._jdf.queryExecution().toString()
        told.append(sorted(map(tuple, out.collect())))
    assert told[0] == told[1]
    # Every seed whose diagonal scores enough has the best of its band.
    want, size, s = set(), 11, seeds.Scoring()
    for key, text in subjects:
        for k, plus in enumerate(queries):
            for strand, query in (("+", plus), ("-", plus[::-1].translate(str.maketrans("ACGT", "TGCA")))):
                for d in {i - j for i in range(len(text or "") - size + 1) for j in range(len(query) - size + 1) if text[i : i + size] == query[j : j + size]} if key is not None else ():
                    found = _banded(query, text, d, s)
                    if found[0] >= s.least and _ungapped(query, text, d, size, s) >= s.opens:
                        want.add((str(k), str(key), strand, *found[:1], found[2], *found[3:]))
    assert {(r[0], r[1], r[10], r[11], r[8], r[16], r[17]) for r in told[0]} == want


def _ungapped(query, text, d, size, s):
    """The best score of a seed on a diagonal with what extends it both ways."""
    out = 0
    for j in range(len(query) - size + 1):
        if j + d < 0 or text[j + d : j + d + size] != query[j : j + size]:
            continue
        total = size * s.match
        for ends in (range(j + size, min(len(query), len(text) - d)), range(j - 1, max(-1, -d - 1), -1)):
            now = best = 0
            for p in ends:
                now += s.match if query[p] == text[p + d] != "N" else s.mismatch
                if now < best - s.drop:
                    break
                best = max(best, now)
            total += best
        out = max(out, total)
    return out


def test_best_hits_of_windows_are_found_without_a_sort_of_all_hits(spark, monkeypatch):
    draw = random.Random(6)
    bodies = [(f"b{k}", "s", draw.choice("+-"), x := draw.randrange(100, 400), x + 60, x - 30, x + 90) for k in range(30)]
    windows = spark.createDataFrame(bodies, "id string, seqid string, strand string, start1 int, end1 int, low int, high int")
    hits = [(k, x := draw.randrange(1, 100), x + draw.randrange(20, 60), draw.choice([True, False, None]), draw.choice([50.0, 51.0, 52.0, None, float("nan")]), draw.choice([80.0, 90.0])) for k in range(25)]
    given = spark.createDataFrame(hits, "n int, sstart int, send int, strong boolean, bits double, qcov double")
    search = lambda w: w.crossJoin(given).where("(n * 7 + start1) % 3 > 0").drop("seqid").select("*", F.lit(1).alias("qstart"), F.col("sstart").alias("position"), F.concat(F.lit("o"), "n").alias("ordinal")).drop("n")
    seen, cut = [], support.cut
    monkeypatch.setattr(support, "cut", lambda df: seen.append(_plan(df)) or cut(df))
    told = lambda df: sorted(map(str, df.select("id", "strong", "bits", "qcov", "ordinal", "g_position").collect()))
    assert told(support.best_searched(windows, search)) == told(support.best_local(support.placed_hits(search(windows))))
    assert "HashAggregate" in seen[0] and "SortAggregate" not in seen[0] and "SortAggregate" in seen[1]


def test_audit_counts_make_no_pairs(spark):
    """Counts are those of the pairs but a region's own, by kind and relation; also of own rows beside the region."""
    from test_round4 import _audit

    regions, features = _audit(spark)
    assessed = regions.unionByName(spark.createDataFrame([("r4", "s", ".", 100, 400), ("r5", "s", "-", 150, 160)], regions.schema)).withColumn("status", F.when(F.col("id") == "r5", "context_not_assessed").otherwise("assessed"))
    trusted = spark.createDataFrame([("r1", "g"), ("r1", "a"), ("r1", "b"), ("r2", "d"), ("r2", "c"), ("r4", "a")], "id string, feature_id string")
    own = annotation.self_features(features, trusted)
    want = {}
    for r in annotation.audit_overlaps(assessed, features, own, trusted).where("not is_self").collect():
        for kind in r.categories.split("|"):
            n = want.setdefault((r.id, kind), {"same": 0, "opposite": 0, "unknown": 0})
            n[r.relation] += 1
    there = {kind for r in features.collect() for kind in r.own_categories}
    out = annotation.audit_counts(assessed, features, own)
    for r in out.collect():
        n = want.get((r.id, r.kind))
        known = r.id not in ("r3", "r5") and (n or r.kind in there)
        assert (r.n, r.n_same, r.n_opposite, r.n_unknown) == ((sum(n.values()), *n.values()) if n else (0,) * 4 if known else (None,) * 4)
    assert out.count() == 5 * len(annotation.CATEGORIES) and {r.id for r in own.collect()} == {"r1", "r2", "r4"}
    assert "_role" not in out._jdf.queryExecution().optimizedPlan().toString()  # of overlap_join


def test_own_ids_of_regions_resolve_to_themselves(spark):
    from test_round4 import _audit

    regions, features = _audit(spark)
    ids = annotation.supporting_ids(regions, features)
    resolved = annotation.resolve_ids(ids.join(regions.select("id", "seqid"), "id"), features).collect()
    assert len(resolved) == ids.count() and all(r.resolved == r.self_id for r in resolved)


def test_regions_keep_their_rows_when_features_are_counted(spark):
    kind = "id string, region string, hypothesis string, seqid string, strand string, start1 int, end1 int"
    placed = spark.createDataFrame([("a", "body", None, "s", "+", 10, 20), ("a", "core", "h", "s", "+", 30, 31), ("b", "body", None, "s", "-", None, None), ("c", "body", None, "t", "+", 1, 9), ("d", "body", None, None, "+", 1, 9)], kind)
    features = spark.createDataFrame([("s", "+", 5, 12, "exon"), ("s", "-", 20, 40, "exon"), ("s", ".", 1, 9, "CDS"), ("s", "+", 1, 2, None)], "seqid string, strand string, start1 int, end1 int, kind string")
    out = curation.region_counts(placed, features, ["CDS", "exon", "repeat"])
    none = dict.fromkeys(("CDS", "exon", "repeat"))
    assert {(r.id, r.region): r.counts for r in out.collect()} == {("a", "body"): none | {"CDS": 0, "exon": 2}, ("a", "core"): none | {"CDS": 0, "exon": 1}, ("b", "body"): None, ("c", "body"): none, ("d", "body"): none}
    # Counts come to the rows in one join by key, and are not gathered again.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 0
