"""Small cases of operators, readers and writers."""

import random

import pytest
from pyspark.sql import functions as F

from spanforge.functions import sequence as S
from spanforge.operators import annotation, greedy, integrity, intervals, loci, support
from spanforge.sources import readers, sinks

PLACE = "id string, seqid string, strand string, start1 int, end1 int"


def test_islands_cross_bins_and_ties(spark):
    rows = [("a", "s", "+", 1, 50), ("b", "s", "+", 1, 50), ("c", "s", "+", 49, 250), ("d", "s", "+", 240, 260), ("e", "s", "+", 261, 270), ("f", "s", "-", 261, 270)]
    got = {r.id: r.island for r in intervals.islands(spark.createDataFrame(rows, PLACE), width=100).collect()}
    assert got == {"a": 1, "b": 1, "c": 1, "d": 1, "e": 261, "f": 261}


def test_overlap_join_finds_each_pair_once(spark):
    a = spark.createDataFrame([("a", "s", "+", 1, 5000)], PLACE)
    b = spark.createDataFrame([("s", 10, 4000), ("s", 5000, 5001), ("s", 5001, 5002), ("t", 1, 2)], "seqid string, s int, e int")
    assert sorted((r.s, r.e) for r in intervals.overlap_join(a, b, ["seqid"], ("start1", "end1", "s", "e"), 64).collect()) == [(10, 4000), (5000, 5001)]


@pytest.mark.parametrize("end,other", [(29, "x"), (28, None)])
def test_reciprocal_needs_15_common_positions(spark, end, other):
    hits = spark.createDataFrame([("h", "s", "+", 15, end)], PLACE)
    others = spark.createDataFrame([("x", "s", "+", 1, 29)], PLACE)
    assert intervals.best_reciprocal(hits, others).first().other_id == other


EVIDENCE = PLACE + ", score double, method string, query string, tier string, ga_pass boolean, bits double, qcov double, pident double"


def evidence(spark, rows):
    return spark.createDataFrame([(*r, "m", "q", "none", False, None, None, None) for r in rows], EVIDENCE)


@pytest.mark.parametrize("fold", [64, 0])
def test_suppressed_hits_suppress_nobody(spark, fold):
    rows = [("a", "s", "+", 1, 100, 9.0), ("b", "s", "+", 6, 105, 8.0), ("c", "s", "+", 14, 113, 7.0)]
    assert {r.id: r.suppressed_by for r in greedy.suppress(evidence(spark, rows), fold=fold).collect()} == {"a": None, "b": "a", "c": None}


@pytest.mark.parametrize("fold", [64, 0])
def test_clusters_join_the_anchor_not_each_other(spark, fold):
    rows = [("seed", "s", "+", 1, 100, 5.0), ("near", "s", "+", 40, 139, 4.0), ("far", "s", "+", 80, 179, 3.0)]
    hits = evidence(spark, rows).selectExpr("*", "id = 'seed' as seed")
    assert {r.id: r.anchor_id for r in greedy.anchor_clusters(hits, fold=fold).collect()} == {"seed": "seed", "near": "seed", "far": "far"}


def test_rounds_give_what_the_fold_gives(spark):
    rng = random.Random(5)
    rows = [(f"h{k:03}", "s", "+", start := rng.randrange(1, 700), start + rng.randrange(50, 90), float(rng.randrange(30))) for k in range(40)]
    hits = evidence(spark, rows).selectExpr("*", "score > 26 as seed").persist()
    for op in (greedy.suppress, greedy.anchor_clusters):
        names = ["id", "suppressed_by"] if op is greedy.suppress else ["id", "anchor_id", "n_compatible"]
        folded, rounds = ({tuple(r) for r in op(hits, fold=n).select(*names).collect()} for n in (1000, 0))
        assert folded == rounds and len(rounds) == 40


def test_a_deep_pile_is_settled_in_rounds(spark):
    pile = spark.range(3000).selectExpr("cast(id as string) as id", "'s' as seqid", "'+' as strand", "cast(1 + id % 3 as int) as start1", "cast(100 + id % 3 as int) as end1", "cast(id as double) as score", "'m' as method", "'q' as query", "'none' as tier", "false as ga_pass", "cast(null as double) as bits", "cast(null as double) as qcov", "cast(null as double) as pident")
    got = greedy.suppress(pile).groupBy("suppressed_by").count().collect()
    assert {(r.suppressed_by, r["count"]) for r in got} == {(None, 1), ("2999", 2999)}


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_do_not_depend_on_partitions(spark, partitions):
    rows = [(f"h{k}", f"s{k % 3}", "+-"[k % 2], 1 + k * 37 % 500, 600 + k) for k in range(60)]
    got = loci.numbered(spark.createDataFrame(rows, PLACE).repartition(partitions), "start1", "end1", 50).collect()
    wanted = sorted(rows, key=lambda r: (r[1], r[3], r[4], r[2], r[0]))
    assert [r.id for r in sorted(got, key=lambda r: r.number)] == [r[0] for r in wanted]


def test_loci_are_numbered_by_body_not_by_anchor(spark):
    """The anchor of a lies first and its body last; what is not canonical takes a number too."""
    rows = [("a", "s", "+", 1, 100, 500, 600, True), ("b", "s", "+", 200, 300, 210, 290, False), ("c", "s", "-", 400, 450, 210, 290, True), ("d", "r", "-", 900, 950, 900, 950, True)]
    fields = PLACE + ", body_start1 int, body_end1 int, canonical boolean"
    got = {r.id: r.number for r in loci.numbered(spark.createDataFrame(rows, fields)).where("canonical").collect()}
    assert got == {"d": 1, "c": 3, "a": 4}


def test_graph_cycles_and_shared_children(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "x"), ("d", "b"), ("p", "q"), ("q", "p")], "id string, parent string")
    assert {(r.id, r.ancestor) for r in annotation.ancestors(edges).collect()} == {("b", "a"), ("c", "b"), ("c", "x"), ("c", "a"), ("d", "b"), ("d", "a"), ("p", "q"), ("q", "p")}
    assert {r.id for r in annotation.all_paths_self(edges, spark.createDataFrame([("a",)], "id string")).collect()} == {"a", "b", "d"}


def test_sequences(spark):
    row = spark.createDataFrame([("AACCGTTTTTGTTTT",)], "s string").select(
        S.reverse_complement(F.col("s")).alias("rc"), S.runs(F.col("s"), "T", 4).alias("runs"), S.mismatches(F.lit("ANG"), "RNG").alias("mm"),
        S.position_map(F.lit("AC-GT"), F.lit("A-CGT"), F.lit(3)).alias("at"), S.upstream(F.col("s"), F.lit("+"), F.lit(4), F.lit(10))["seq"].alias("up"), S.upstream(F.col("s"), F.lit("-"), F.lit(12), F.lit(2))["seq"].alias("down"),
    ).first()
    assert (row.rc, row.mm, row.at, row.up, row.down) == ("AAAACAAAAACGGTT", 1, 3, "AAC", "AA")
    assert [tuple(r) for r in row.runs] == [(6, 10, False), (12, 15, True)]


@pytest.mark.parametrize("strand, tss, size, wanted", [
    ("+", 15, 10, ("boundary_outside_reference", "", None)), ("-", 0, 10, ("boundary_outside_reference", "", None)), ("+", 1, 5, ("no_upstream_sequence_at_reference_edge", "", None)),
    ("-", 10, 5, ("no_upstream_sequence_at_reference_edge", "", None)), ("+", 4, 5, ("truncated_reference_edge", "ACG", 1)), ("-", 8, 5, ("truncated_reference_edge", "GT", 9)), ("+", 6, 5, ("complete", "ACGTA", 1)),
])
def test_upstream_states(spark, strand, tss, size, wanted):
    w = spark.createDataFrame([("ACGTACGTAC",)], "s string").select(S.upstream(F.col("s"), F.lit(strand), F.lit(tss), F.lit(size)).alias("w")).first().w
    assert (w.status, w.seq, w.start1) == wanted


def test_brackets(spark):
    model = lambda text: integrity.bracket_pairs(spark.createDataFrame([("m", text)], "id string, structure string"))
    assert {(r.left, r.right) for r in model("<.(A)>a<<>>").collect()} == {(1, 6), (3, 5), (4, 7), (8, 11), (9, 10)}
    for text in ("<<>", ">", "Aa)", "<>>"):
        with pytest.raises(Exception, match="unbalanced"):
            model(text).collect()


def test_alignment_metrics_and_every_reason(spark):
    rf, body = "x" * 90 + ".." + "x" * 10, "ACGTN"[0] * 100
    rows = [("whole", "A" * 90 + "--" + "A" * 10, body), ("insert", "A" * 90 + "A~" + "A" * 10, "A" * 101), ("inner", "A" * 40 + "._-~" + "A" * 46 + ".." + "A" * 10, "A" * 96), ("end", "-" * 7 + "A" * 83 + ".." + "A" * 10, "A" * 93)]
    rows += [("none", "-" * 102, ""), ("null", None, body), ("length", "A" * 90 + "--" + "A" * 10, body + "A"), ("other", "A" * 90 + "--" + "A" * 10, "C" * 100), ("letters", "N" + "A" * 89 + "--" + "A" * 10, "N" + "A" * 99), ("low", "A" * 84 + "-" * 6 + ".." + "A" * 4 + "-" * 6, "A" * 88)]
    got = integrity.integrity(integrity.alignment_metrics(spark.createDataFrame(rows, "id string, aligned string, seq string").selectExpr("*", "id = 'whole' as pseudogene"), rf, [(k, 30 - k) for k in range(1, 7)] + [(91, 92)]))
    by = {r.id: r for r in got.collect()}
    pairs, deletion, terminal, occupancy, length = "low_canonical_wobble_pair_compatibility", "substantial_internal_model_column_deletion", "terminal_model_columns_missing_in_submitted_body", "RF_match_column_occupancy_below_0.90", "length_outside_pilot_80_130nt_review_window"
    assert {k: (r.status.split("_")[0], r.reasons) for k, r in by.items()} == {
        "whole": ("atypical", pairs + ";annotated_pseudogene_requires_review"), "insert": ("atypical", pairs), "inner": ("structural", f"{deletion};{pairs}"), "end": ("terminally", terminal), "none": ("terminally", f"{terminal};{occupancy};{length}"),
        "null": ("unresolved", "structural_alignment_missing_or_incomplete"), "length": ("unresolved", "alignment_sequence_length_mismatch"), "other": ("unresolved", "alignment_sequence_checksum_mismatch"), "letters": ("unresolved", "ambiguous_reference_bases"),
        "low": ("structural", f"{deletion};{terminal};{occupancy};{pairs}"),
    }
    assert (by["insert"].inserted, by["whole"].paired_positions, by["end"].paired_observed, by["end"].pair_compatibility) == (1, 6, 0, None)
    assert (by["none"].gap5, by["none"].gap3, by["inner"].longest_interior_gap) == (100, 0, 4)


def test_all_true_and_booleans(spark):
    rows = spark.createDataFrame([("Yes",), ("0",)], "s string").withColumn("b", integrity.boolean(F.col("s")))
    assert {(r.check, r.passed, r.n_failed) for r in integrity.all_true(rows, known=F.col("b").isNotNull(), yes=F.col("b")).collect()} == {("known", True, 0), ("yes", False, 1)}
    with pytest.raises(Exception, match="not a boolean"):
        spark.range(1).select(integrity.boolean(F.lit("maybe"))).collect()


def test_local_hits_come_back_to_the_sequence(spark):
    bodies = spark.createDataFrame([("p", "+", 101, 200, 41, 260), ("m", "-", 101, 200, 41, 260)], "id string, strand string, start1 int, end1 int, low int, high int")
    hits = spark.createDataFrame([("p", 61, 160, 61), ("m", 61, 160, 61), ("p", 1, 60, None), ("m", 160, 61, 61)], "id string, sstart int, send int, position int")
    assert {(r.id, r.g_start1, r.g_end1, r.g_position) for r in support.local_hits(hits, bodies).collect()} == {("p", 101, 200, 101), ("m", 101, 200, 200)}


def test_readers(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">one first\nacg\nT\n>two\nNN\n")
    assert {(r.seqid, r.seq, r.length) for r in readers.read_fasta(spark, str(tmp_path / "a.fa")).collect()} == {("one", "ACGT", 4), ("two", "NN", 2)}
    (tmp_path / "b.tsv").write_text("# c\nq\ts\t90\t20\t0\t0\t1\t20\t50\t31\t1e-5\t40\t40\t100\t50\n")
    hit = readers.read_blast(spark, str(tmp_path / "b.tsv"), "sp").first()
    assert (hit.raw_hit_id, hit.start1, hit.end1, hit.strand, hit.qcov_exact) == ("sp_BLAST_000001", 31, 50, "-", 50.0)
    (tmp_path / "c.gff").write_text("##gff-version 3\ns\tx\tgene\t1\t9\t.\t+\t.\tID=g%2C1;Note=a+b,c%3Bd\n##FASTA\n>s\nAC\n")
    row = readers.read_gff3(spark, str(tmp_path / "c.gff")).first()
    assert (row.declared_id, row.attrs["Note"], row.parents) == ("g,1", ["a+b", "c;d"], [])
    (tmp_path / "d.sto").write_text("# STOCKHOLM 1.0\na AC\nb G-\n#=GC RF xx\n\na GT\nb TT\n#=GC RF xx\n//\n")
    assert {(r.name, r.aligned) for r in readers.read_stockholm(spark, str(tmp_path / "d.sto")).collect()} == {("a", "ACGT"), ("b", "G-TT"), ("#RF", "xxxx")}
    (tmp_path / "e.cm").write_text("NAME U\nACC RF1\nCLEN 10\nGA 4.5\nCM\nNAME other\n")
    assert readers.read_model_header(spark, str(tmp_path / "e.cm")) == {"NAME": "U", "ACC": "RF1", "CLEN": "10", "GA": "4.5"}
    (tmp_path / "f.tbl").write_text("#x\ns - U RF1 cm 1 10 40 31 - no 1 0.4 0.0 9.5 1e-4 ! -\n")
    cm = readers.read_tblout(spark, str(tmp_path / "f.tbl"), "sp", "RF1", 10, 4.5).first()
    assert (cm.raw_hit_id, cm.start1, cm.end1, cm.score, cm.ga_pass, cm.model_coverage) == ("sp_RF1_000001", 31, 40, 9.5, True, 1.0)


def test_malformed_files_raise(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    with pytest.raises(ValueError, match="before the first record"):
        readers.read_fasta(spark, put("a.fa", "ACGT\n>one\nAC\n"))
    with pytest.raises(ValueError, match="repeated"):
        readers.read_fasta(spark, put("b.fa", ">one\nA\n>one\nC\n"))
    row = "s\tx\tgene\t1\t9\t.\t+\t.\t"
    got = readers.read_gff3(spark, put("c.gff", row + "ID=g;Note=a,b;Note=c;.\n")).first()
    assert got.attrs["Note"] == ["a", "b", "c"]
    for text in (row + "ID=g;flag\n", row.replace("1\t9", "9\t1") + "ID=g\n", "s\tx\n"):
        with pytest.raises(Exception, match="attribute without =|bad feature row"):
            readers.read_gff3(spark, put(f"d{len(text)}.gff", text)).collect()
    for text in ("a AC\n#=GC RF xx\n", "a AC\n#=GC RF xx\n//\nb AC\n", "a AC\n//\n", "a ACG\n#=GC RF xx\n//\n", "a A C\n#=GC RF xx\n//\n"):
        with pytest.raises(Exception, match="alignment|RF"):
            readers.read_stockholm(spark, put(f"e{abs(hash(text))}.sto", text))


def test_lines_are_numbered_across_splits(spark, tmp_path):
    (tmp_path / "big.tsv").write_text("# head\n" + "".join(f"q{k}\ts\t90\t20\t0\t0\t1\t20\t1\t20\t1e-5\t40\t40\t100\t50\n" for k in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        hits = readers.read_blast(spark, str(tmp_path / "big.tsv"), "sp")
        assert spark.read.text(str(tmp_path / "big.tsv")).rdd.getNumPartitions() > 5
        assert all(r.line == int(r.query[1:]) + 2 and r.raw_hit_id == f"sp_BLAST_{int(r.query[1:]) + 1:06}" for r in hits.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fasta_audit(spark):
    row = readers.audit_fasta(spark.createDataFrame([("s", "ACGTNNRX" * 10, 80)], "seqid string, seq string, length int")).first()
    assert (row.n_count, row.ambiguous, row.foreign) == (20, 40, 10)


def test_annotation_audits(spark):
    features = spark.createDataFrame([("s", 1, 9, "g", []), ("s", 5, 20, None, ["g", "h"]), ("t", 1, 2, "x", [])], "seqid string, start1 int, end1 int, declared_id string, parents array<string>")
    lengths = spark.createDataFrame([("s", 10)], "seqid string, length int")
    assert {tuple(r) for r in readers.audit_gff(features, lengths).collect()} == {("beyond_sequence_end", "s", 1), ("unknown_seqid", "t", 1), ("unresolved_parent", "s", 1)}
    regions = spark.createDataFrame([("r", "s", "+", 1, 5)], PLACE)
    assert annotation.audit_status(regions, None).first().reason == "no_gff"
    assert annotation.audit_status(regions, features.withColumn("kind", F.lit("region"))).first().reason == "empty_gff"


def test_differences_exclusions_and_tables(spark, tmp_path):
    a, b = (spark.createDataFrame(rows, "seqid string, k int") for rows in ([("s", 1), ("s", 1), ("t", 2)], [("s", 1), ("u", 3)]))
    assert {tuple(r) for r in integrity.differences(a, b, ["seqid", "k"]).collect()} == {("s", 1, "only_a"), ("t", 2, "only_a"), ("u", 3, "only_b")}
    kept, counts = intervals.without_seqids(a, ["s", "x"])
    assert {r.seqid for r in kept.collect()} == {"t"} and {tuple(r) for r in counts.collect()} == {("s", 2), ("x", 0)}
    sinks.write_tsv(a.where("k > 5"), str(tmp_path / "none"))
    sinks.write_tsv(b.withColumn("n", F.lit(None).cast("string")), str(tmp_path / "some"))
    assert readers.read_table(spark, str(tmp_path / "some")).where("n is null").count() == 2
    before = readers.file_manifest(spark, str(tmp_path / "some")).where("path like '%part%'")
    assert readers.preserved(before, before).count() == 0 and readers.preserved(before, before.limit(0)).first().change == "removed"
    assert readers.read_table(spark, str(tmp_path / "none")).columns == ["seqid", "k"]
    (tmp_path / "ragged.tsv").write_text("a\tb\n1\t2\n1\t2\t3\n")
    with pytest.raises(Exception, match="Malformed|MALFORMED|FAILFAST|malformed"):
        readers.read_table(spark, str(tmp_path / "ragged.tsv")).collect()


def test_sinks_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("one", "ACGT" * 30), ("two", "A" * 80)], "id string, seq string")
    sinks.write_fasta(rows, str(tmp_path / "fa"))
    assert {(r.seqid, r.seq) for r in readers.read_fasta(spark, str(tmp_path / "fa")).collect()} == {tuple(r) for r in rows.collect()}
    sinks.write_bed(spark.createDataFrame([("l", "s", "+", 5, 9)], PLACE), str(tmp_path / "bed"))
    assert spark.read.text(str(tmp_path / "bed")).first()[0] == "s\t4\t9\tl\t0\t+"
    sinks.write_tsv(spark.createDataFrame([(1, None, False), (None, "x", True)], "a int, b string, c boolean"), str(tmp_path / "tsv"), "c", ("b",))
    assert {r.value for r in spark.read.text(str(tmp_path / "tsv")).collect()} >= {"a\tb\tc", "1\t\tfalse", "NA\tx\ttrue"}
    assert readers.file_manifest(spark, str(tmp_path / "bed"), allow_empty=True).count() == 1
