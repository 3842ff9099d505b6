"""Genomes over many splits: carried records and places, index, chunks, regions, and what is refused."""

import random

import pytest

from spanforge.sources import audits, genome, readers


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_many_splits(spark, tmp_path, small_splits, end):
    draw = random.Random(3)
    records = {f"r{k}": "".join(draw.choices("ACGTNacgt", k=n)) for k, n in enumerate((1, 60, 61, 5000, 59, 9000, 120))}
    text, index = b"", []
    for name, seq in records.items():
        text += f">{name} some words{end}".encode()
        index.append((name, len(seq), len(text), min(60, len(seq)), min(60, len(seq)) + len(end)))
        text += "".join(seq[k : k + 60] + end for k in range(0, len(seq), 60)).encode()
    (tmp_path / "g.fa").write_bytes(text)
    lines = genome.genome_lines(spark, str(tmp_path / "g.fa"))
    assert lines.select("split").distinct().count() > 10
    got = genome.genome_index(lines)
    assert {tuple(r)[:5] for r in got.collect()} == set(index)
    assert {r.seqid: (r.n_count, r.ambiguous) for r in got.collect()} == {k: (v.upper().count("N"),) * 2 for k, v in records.items()}
    chunks = genome.genome_chunks(lines, 250).persist()
    assert max(len(r.seq) for r in chunks.collect()) == 250
    whole = {}
    for r in sorted(chunks.collect(), key=lambda r: r.chunk):
        whole[r.seqid] = whole.get(r.seqid, "") + r.seq
    assert whole == {k: v.upper() for k, v in records.items()}
    regions = [(k, a := draw.randrange(1, len(v) + 1), draw.randrange(a, len(v) + 1), "x") for k, v in records.items() for _ in range(8)] + [("r5", 100, 1100, "y"), ("r5", 100, 1100, "z")]
    table = spark.createDataFrame(regions, "seqid string, start1 int, end1 int, note string")
    found = [(r.seqid, r.start1, r.end1, r.note, r.seq) for r in genome.fetch(chunks, table, 250).collect()]
    assert sorted(found) == sorted((*r, records[r[0]][r[1] - 1 : r[2]].upper()) for r in regions)
    for bad in (("r1", 1, 61), ("r1", 0, 5), ("zz", 1, 2)):
        with pytest.raises(Exception, match="outside"):
            genome.fetch(chunks, spark.createDataFrame([bad], "seqid string, start1 int, end1 int"), 250).collect()


@pytest.mark.parametrize(
    "text, message",
    [
        ("ACGT\n>a\nAC\n", "before the first"), (">\nAC\n", "without a name"), (">a\nAC\n>a\nAC\n", "repeated"), (">a\n>b\nAC\n", "without a base"), (">a\nAC\n\nAC\n", "blank"), (">a\nAXQ\n", "foreign"),
        (">a\nACG\nAC\nACG\n", "unequal"), (">a\nAC\nACG\n", "longer"), (">a\nACG\r\nACG\nA\n", "unequal"),
    ],
)
def test_what_the_audit_refuses(spark, tmp_path, text, message):
    (tmp_path / "g.fa").write_bytes(text.encode())
    with pytest.raises(ValueError, match=message):
        genome.genome_index(genome.genome_lines(spark, str(tmp_path / "g.fa")))


def test_lenient_decoding_and_declared_regions(spark, tmp_path):
    row = "c%201\tx\tgene\t1\t9\t.\t+\t.\t"
    (tmp_path / "a.gff").write_text(f"##sequence-region c%201 1 50\n{row}ID=g;Note=95% identical,50%25,%zz,a+b\n##FASTA\n##sequence-region d 1 2\n")
    got = readers.read_gff3(spark, str(tmp_path / "a.gff")).first()
    assert (got.seqid, got.attrs["Note"]) == ("c 1", ["95% identical", "50%", "%zz", "a+b"])
    assert [tuple(r) for r in readers.read_declared_regions(spark, str(tmp_path / "a.gff")).collect()] == [("c 1", 1, 50)]


@pytest.mark.parametrize("qseq, sseq, good", [("AC-GT", "ACCGT", True), ("ACGT", "AC", False), ("ACGGT", "ACCGT", False), ("AC-GT", "AC-GT", False)])
def test_aligned_strings_must_agree_with_places(spark, tmp_path, qseq, sseq, good):
    (tmp_path / "b.tsv").write_text(f"q\ts\t90\t5\t0\t0\t1\t4\t50\t54\t1e-5\t40\t4\t100\t50\t{qseq}\t{sseq}\t4\n")
    hits = readers.read_blast(spark, str(tmp_path / "b.tsv"), "sp")
    if good:
        assert hits.first().sseq == sseq
    else:
        with pytest.raises(Exception, match="bad tabular hit"):
            hits.collect()


def test_audit_of_annotation(spark):
    features = spark.createDataFrame([("s", "gene", 1, 9), ("s", "exon", 5, 9), ("t", "gene", 1, 2), ("m", "gene", 1, 900)], "seqid string, kind string, start1 int, end1 int")
    declared = spark.createDataFrame([("s", 1, 10), ("t", 2, 3), ("m", 1, 5)], "seqid string, start1 int, end1 int")
    lengths = spark.createDataFrame([("s", 10), ("t", 5), ("u", 7)], "seqid string, length int")
    told = {k: {tuple(r) for r in v.collect()} for k, v in audits.audit_annotation(features, declared, lengths, ["m", "x"]).items()}
    assert told == {"kinds": {("gene", 2), ("exon", 1)}, "excluded": {("m", 1), ("x", 0)}, "regions": {("s", 1, 10, True), ("t", 2, 3, False)}, "bare": {("u",)}}
    for given, excluded, message in ((features, ["s", "m"], "hide"), (features, [], "unknown record"), (features.selectExpr("seqid", "kind", "start1", "end1 + 5 as end1"), ["m"], "out of bounds")):
        with pytest.raises(ValueError, match=message):
            audits.audit_annotation(given, declared, lengths, excluded)
    with pytest.raises(ValueError, match="declared region out of bounds"):
        audits.audit_annotation(features, spark.createDataFrame([("s", 1, 11)], declared.schema), lengths, ["m"])


def test_interval_sets_across_bins(spark):
    from spanforge.operators import intervals

    draw = random.Random(8)
    rows = [("s", a := draw.randrange(1, 900), a + draw.randrange(30)) for _ in range(40)] + [("t", 1, 1000)]
    table = spark.createDataFrame(rows, "seqid string, start1 int, end1 int")
    lengths = spark.createDataFrame([("s", 1000), ("t", 1000), ("u", 5)], "seqid string, length int")
    runs = intervals.union(table)
    covered = {k: {p for s, a, b in rows if s == k for p in range(a, b + 1)} for k in "stu"}
    for k, size in (("s", 1000), ("t", 1000), ("u", 5)):
        got = [p for r in runs.where(f"seqid = '{k}'").collect() for p in range(r.start1, r.end1 + 1)]
        assert sorted(got) == sorted(covered[k])
        gaps = [p for r in intervals.complement(runs, lengths, 64).where(f"seqid = '{k}'").collect() for p in range(r.start1, r.end1 + 1)]
        assert sorted(gaps) == sorted(set(range(1, size + 1)) - covered[k])


def test_a_whole_chromosome_takes_few_rows_in_a_join(spark):
    from spanforge.operators import intervals

    draw = random.Random(9)
    left = [(k, a := draw.randrange(1, 3_000_000), a + draw.choice([10, 900, 40_000, 2_000_000])) for k in range(150)] + [(999, 1, 250_000_000)]
    right = [(k, a := draw.randrange(1, 3_000_000), a + draw.choice([0, 1500, 300_000])) for k in range(150)] + [(998, 1, 250_000_000)]
    a, b = spark.createDataFrame([("s", *r) for r in left], "seqid string, a int, s1 int, e1 int"), spark.createDataFrame([("s", *r) for r in right], "seqid string, b int, s2 int, e2 int")
    joined = intervals.overlap_join(a, b, ["seqid"], ("s1", "e1", "s2", "e2"))
    assert sorted((r.a, r.b) for r in joined.collect()) == sorted((x[0], y[0]) for x in left for y in right if x[1] <= y[2] and y[1] <= x[2])
    one = spark.createDataFrame([("s", 1, 1, 250_000_000)], "seqid string, a int, s1 int, e1 int")
    assert intervals.overlap_join(one, b.where("b < 100"), ["seqid"], ("s1", "e1", "s2", "e2")).count() == 100
    level = intervals._level("s1", "e1", intervals.JOIN_BIN)
    width = intervals._bin_width(level, intervals.JOIN_BIN)
    from pyspark.sql import functions as F

    assert one.select((F.floor(F.col("e1") / width) - F.floor(F.col("s1") / width) + 1).alias("n")).first().n <= 3
