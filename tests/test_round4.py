"""Annotation audits, closures and overlap joins whose work follows their input."""

import random

from pyspark.sql import functions as F

from spanforge.functions import sequence
from spanforge.operators import annotation, intervals

FEATURE = "n long, seqid string, kind string, start1 int, end1 int, strand string, declared_id string, parents array<string>, attrs map<string,array<string>>"


def _audit(spark):
    rows = [
        (1, "s", "gene", 100, 199, "+", "g", [], {"Name": ["OsU6-1"]}), (2, "s", "snRNA", 100, 199, "+", "a", ["g"], {}), (3, "s", "snRNA", 120, 150, "+", "b", ["g"], {"Name": ["AtU6.1"]}),
        (4, "s", "exon", 100, 199, "+", None, ["a"], {}), (5, "s", "snRNA", 100, 199, "-", "c", [], {"Name": ["AtU6.1"]}), (6, "s", "gene", 300, 399, "+", "h", [], {"gene_biotype": ["protein_coding"], "Name": ["OsU6-2"]}),
        (7, "s", "U6_snRNA", 300, 399, "+", "d", ["h"], {}), (8, "s", "snRNA", 300, 399, "+", "e", [], {"Name": ["U6 atac like"]}),
    ]
    regions = spark.createDataFrame([("r1", "s", "+", 110, 180), ("r2", "s", "+", 310, 320), ("r3", "t", "+", 1, 9)], "id string, seqid string, strand string, start1 int, end1 int")
    return regions, annotation.described(spark.createDataFrame(rows, FEATURE))


def test_features_are_judged_before_they_meet_regions(spark, monkeypatch):
    regions, features = _audit(spark)
    met, join = [], annotation.overlap_join
    monkeypatch.setattr(annotation, "overlap_join", lambda a, b, *rest: met.append(b) or join(a, b, *rest))
    assert {tuple(r) for r in annotation.supporting_ids(regions, features).collect()} == {("r1", "a"), ("r1", "b"), ("r1", "g"), ("r2", "d")}
    # Those whose labels reject them meet no region, and none brings its labels.
    assert {r.declared_id for r in met[0].collect()} == {"a", "b", "c", "d"} and "labels" not in met[0].columns


def test_pairs_are_not_shuffled_once_they_have_met(spark):
    regions, features = _audit(spark)
    assessed = regions.withColumn("status", F.lit("assessed"))
    resolved = spark.createDataFrame([("r1", "g"), ("r1", "a"), ("r1", "b")], "id string, feature_id string")
    pairs = annotation.audit_overlaps(assessed, features, annotation.self_features(features, resolved), resolved)
    assert {(r.id, r.n, r.is_self, r.shared_with_self) for r in pairs.collect()} == {("r1", 1, True, False), ("r1", 2, True, True), ("r1", 3, True, True), ("r1", 4, True, True), ("r1", 5, False, False), ("r2", 6, False, False), ("r2", 7, False, False), ("r2", 8, False, False)}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" not in plan


def _closure(edges):
    up, known = {}, set()
    for a, b in edges:
        if b is not None and a != b:
            up.setdefault(a, set()).add(b)
    for a in up:
        stack = list(up[a])
        while stack:
            if (b := stack.pop()) != a and (a, b) not in known:
                known.add((a, b))
                stack += up.get(b, ())
    return known


def test_leaves_join_the_closure_of_their_parents_once(spark, monkeypatch):
    """Two layers of leaves over a chain with a cycle; ids of the layers take no part in the doubling."""
    draw = random.Random(7)
    edges = [(f"x{k}", f"x{k + 1}") for k in range(12)] + [("x9", "x3"), ("x2", "x2"), ("z", None)]
    edges += [(f"m{k}", f"x{draw.randrange(12)}") for k in range(60)] + [(f"l{k}", f"m{draw.randrange(60)}") for k in range(400)] + [(f"l{k}", f"m{draw.randrange(60)}") for k in range(100)]
    sizes, cut = [], annotation.cut

    def seen(df):
        out = cut(df)
        sizes.append({r.id[0] for r in out.select("id").collect()})
        return out

    monkeypatch.setattr(annotation, "cut", seen)
    got = [tuple(r) for r in annotation.ancestors(spark.createDataFrame(edges, "id string, parent string")).collect()]
    assert len(got) == len(set(got)) and set(got) == _closure(edges)
    assert sum("l" in x for x in sizes) == 3  # the edges, marked, and with all that is found


def test_values_of_ancestors_of_very_many_ids(spark):
    closure = spark.createDataFrame([(f"a{k}", "top") for k in range(20)] + [("a1", "b"), ("a2", "b"), ("a3", "none")], "id string, ancestor string")
    values = spark.createDataFrame([(f"a{k}", "own" if k == 5 else None) for k in range(20)] + [("top", "t"), ("top", "s"), ("b", "u"), ("b", None)], "id string, value string")
    wanted = {f"a{k}": "s,t" for k in range(20)} | {"a1": "s,t,u", "a2": "s,t,u", "a5": "own", "top": "s,t", "b": "u"}
    for hot in (1, 5, 100):
        assert {r.id: r.value for r in annotation.inherited(values, closure, hot).collect()} == wanted


def test_intervals_of_one_level_come_to_a_bin_once_on_each_side(spark):
    a = spark.createDataFrame([("s", 10 * k, 10 * k + 50) for k in range(1, 90)], "seqid string, s int, e int")
    b = a.toDF("seqid", "s2", "e2")
    long = b.unionByName(spark.createDataFrame([("s", 1, 5000), ("s", 300, 1500)], b.schema))
    rows = intervals.overlap_join(a, b, ["seqid"], ("s", "e", "s2", "e2"))._jdf.queryExecution().optimizedPlan().toString()
    assert "_least" in rows  # what no shorter interval comes to has no row under that role
    for other in (b, long):
        rows = [tuple(r)[1:] for r in other.collect()]
        got = sorted((r.s, r.e, r.s2, r.e2) for r in intervals.overlap_join(a, other, ["seqid"], ("s", "e", "s2", "e2")).collect())
        assert got == sorted((s, e, x, y) for s, e in (tuple(r)[1:] for r in a.collect()) for x, y in rows if s <= y and x <= e)
        assert sorted(got) == sorted((r.s, r.e, r.s2, r.e2) for r in intervals.overlap_join(other, a, ["seqid"], ("s2", "e2", "s", "e")).collect())


def test_position_map_of_any_gaps_and_without_a_step_a_letter(spark):
    draw = random.Random(5)
    rows = [("".join(draw.choice("AC-") for _ in range(n)), "".join(draw.choice("GT-") for _ in range(max(0, n - cut))), at) for n in (0, 1, 2, 3, 7, 40, 129) for at in (-1, 0, 1, 2, 5, 20, 90, None) for cut in (0, 1, 5)]

    def plain(q, s, at):
        x = y = 0
        for a, b in zip(q, s):
            x, y = x + (a != "-"), y + (b != "-")
            if a != "-" and b != "-" and x == at:
                return y

    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, q string, s string, at int").withColumn("got", sequence.position_map(F.col("q"), F.col("s"), F.col("at")))
    assert {r.k: r.got for r in df.collect()} == {k: plain(*r) for k, r in enumerate(rows)}
    assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_metrics_take_runs_of_columns_and_map_a_row_once(spark):
    """Both ways give the same, with a knot, inserts at edges and all gap letters; no letter is mapped by itself."""
    from spanforge.operators import integrity

    rf, structure = ".xx.xxxxxx~", "<<A.>..>.a."
    pairs = [tuple(r) for r in integrity.bracket_pairs(spark.createDataFrame([("m", structure)], "id string, structure string")).select("left", "right").collect()]
    draw = random.Random(3)
    rows = spark.createDataFrame([(str(k), "m", "".join(draw.choice("ACGTUN.-_~acgu") for _ in rf)) for k in range(60)] + [("gaps", "m", "-" * len(rf)), ("null", "m", None)], "id string, model string, aligned string")
    one = integrity.alignment_metrics(rows, rf, pairs)
    many = integrity.metrics_by_model(rows, spark.createDataFrame([("m", rf, structure)], "model string, rf string, structure string"))
    told = lambda df: {r.id: r.asDict() for r in df.collect()}
    assert told(one) == told(many)
    for df in (one, many):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("T.-_~") == 1


def test_overlaps_are_counted_without_pairs(spark):
    """Bins of few positions, equal rows, rows without place, and bins that are asked only."""
    draw = random.Random(11)
    rows = lambda n, long: [(draw.choice("st"), draw.choice(["+", "-", ".", None]), x := draw.randrange(1, 400), x + draw.randrange(long)) for _ in range(n)]
    a, b = rows(150, 40) + [("s", "+", 900, 910)], rows(80, 300) + [("s", "+", 700, 720), ("u", "+", 1, 9)]
    kind = "seqid string, strand string, start1 int, end1 int"
    left = spark.createDataFrame([*a, *a[:20], (None, "+", 1, 9), ("s", "+", None, None)], kind)
    right = spark.createDataFrame([(f"f{k % 30}", *r) for k, r in enumerate(b)], "key string, seqid string, f_strand string, s int, e int")
    wanted = {}
    for k, (seqid, _, s, e) in enumerate(b):
        met = [r for r in [*a, *a[:20]] if r[0] == seqid and r[2] <= e and s <= r[3]]
        old = wanted.get(f"f{k % 30}", (0, 0))
        wanted[f"f{k % 30}"] = (old[0] + sum(r[1] == "+" for r in met), old[1] + len(met))
    for width in (16, 65_536):
        out = intervals.overlap_counts(left, right, ["seqid"], ("start1", "end1", "s", "e"), {"plus": F.col("strand") == "+", "every": F.lit(True)}, ["key"], width)
        assert {r.key: (r.plus, r.every) for r in out.collect()} == wanted
    for df in (out, annotation.relation_counts(left, left.withColumn("kind", F.lit("x")))):
        assert "start1" not in "".join(x for x in df._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x)


def test_contexts_and_relations_of_all_strands(spark):
    kind = "seqid string, strand string, start1 int, end1 int"
    regions = spark.createDataFrame([("s", x, 10, 20) for x in ("+", "-", ".", None)] + [("t", "+", 1, 5)], kind).withColumn("id", F.concat("seqid", F.coalesce("strand", F.lit("n"))))
    features = spark.createDataFrame([("s", x, 20, 30) for x in ("+", "+", "-", ".", None)] + [("s", "+", 21, 30)], kind).withColumn("kind", F.lit("exon"))
    got = {(r.id, r.kind): tuple(r)[2:] for r in annotation.context_counts(regions, features, ["exon", "CDS"]).collect()}
    none = (None,) * 4
    assert got == {("s+", "exon"): (5, 2, 1, 2), ("s-", "exon"): (5, 1, 2, 2), ("s.", "exon"): (5, 0, 0, 5), ("sn", "exon"): (5, 0, 0, 5), ("t+", "exon"): none} | {(r, "CDS"): none for r in ("s+", "s-", "s.", "sn", "t+")}
    assert {tuple(r) for r in annotation.relation_counts(regions, features).collect()} == {("exon", "same", 3), ("exon", "opposite", 3), ("exon", "unknown", 14)}
