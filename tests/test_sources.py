"""Models as data, evidence in the order of input, and publishing at once."""

import os

import pytest
from pyspark.sql import functions as F

from spanforge.operators import greedy, integrity, loci
from spanforge.sources import evidence, readers, sinks

MODELS = [("one", "xx.xxxxxx", "<<..>>..."), ("two", "xxxxx", None), ("three", ".xxxx.", "(Aa.).")]


def test_many_models_in_one_plan(spark):
    rows = [(f"{m}{k}", m, a) for m, texts in (("one", ["ACGGT-ANU", "---------", "AC~GTAC.N", None]), ("two", ["ACG-T", "aaaaa"]), ("three", ["GAUUCG", "-A..C-"])) for k, a in enumerate(texts)]
    table, models = spark.createDataFrame(rows, "id string, model string, aligned string"), spark.createDataFrame(MODELS, "model string, rf string, structure string")
    got = {r.id: r for r in integrity.metrics_by_model(table, models).collect()}
    assert len(got) == len(rows)
    for model, rf, structure in MODELS:
        pairs = [tuple(r)[1:] for r in integrity.bracket_pairs(spark.createDataFrame([(model, structure)], "id string, structure string")).collect()] if structure else []
        for r in integrity.alignment_metrics(table.where(F.col("model") == model), rf, pairs).collect():
            assert r == got[r.id]
    for bad, message in (("nine", "unknown model"), ("two", "differ in length")):
        with pytest.raises(Exception, match=message):
            integrity.metrics_by_model(spark.createDataFrame([("x", bad, "ACGTACGT")], table.schema), models).collect()


def _blast(n, start, bits):
    return f"q\tc1\t90\t100\t0\t0\t1\t100\t{start}\t{start + 99}\t1e-5\t{bits}\t100\t5000\t100\n"


def test_ties_are_settled_in_the_order_of_input(spark, tmp_path):
    """Hit 1,000,000 sorts before hit 999,999 as text, and comes after it in the file."""
    (tmp_path / "b.tsv").write_text(_blast(0, 1000, 50) + _blast(1, 1000, 50))
    hits = readers.read_blast(spark, str(tmp_path / "b.tsv"), "sp")
    late = hits.withColumn("raw_hit_id", F.when(F.col("line") == 1, "sp_BLAST_999999").otherwise("sp_BLAST_1000000"))
    (tmp_path / "m.tbl").write_text("s - U RF1 cm 1 100 1 100 + no 1 0.4 0.0 9.5 1e-4 ! -\n")
    model = readers.read_tblout(spark, str(tmp_path / "m.tbl"), "sp", "RF1", 100, 4.5)
    both = evidence.evidence(late, model, model.limit(0))
    assert [r.id for r in both.orderBy("ordinal").collect()] == ["sp_BLAST_999999", "sp_BLAST_1000000", "sp_RF1_000001"]
    for fold in (64, 0):
        got = {r.id: r.suppressed_by for r in greedy.suppress(both, fold=fold).collect()}
        assert got == {"sp_BLAST_999999": None, "sp_BLAST_1000000": "sp_BLAST_999999", "sp_RF1_000001": None}
    assert {r.id for r in greedy.suppress(both.drop("ordinal")).where("suppressed_by is null").collect()} == {"sp_BLAST_1000000", "sp_RF1_000001"}
    with pytest.raises(ValueError, match="no source"):
        evidence.in_order([])


def test_from_files_to_loci(spark, tmp_path):
    (tmp_path / "b.tsv").write_text(_blast(0, 1003, 95) + _blast(1, 3000, 95))
    (tmp_path / "f.tbl").write_text("c1 - U RF1 cm 1 100 1000 1099 + no 1 0.4 0.0 90.5 1e-9 ! -\n")
    (tmp_path / "o.tbl").write_text("c1 - V RF2 cm 1 100 1001 1100 + no 1 0.4 0.0 2.5 1e-1 ! -\nc1 - V RF2 cm 1 100 200 299 - no 1 0.4 0.0 2.5 1e-1 ! -\n".replace("200 299 -", "299 200 -"))
    read = lambda name, acc: readers.read_tblout(spark, str(tmp_path / name), "sp", acc, 100, 50.0)
    hits = evidence.evidence(readers.read_blast(spark, str(tmp_path / "b.tsv"), "sp"), read("f.tbl", "RF1"), read("o.tbl", "RF2"))
    got = {r.id: r for r in loci.numbered(loci.loci(hits, historical="q")).collect()}
    assert set(got) == {"sp_RF1_000001", "sp_BLAST_000002"}
    first = got["sp_RF1_000001"]
    assert (first.number, first.canonical, first.strict, first.legacy_grade, first.body_start1, first.other_score, first.q1_position) == (1, True, True, "A2_CM_led_U6", 1000, 2.5, 1003)
    assert (got["sp_BLAST_000002"].number, got["sp_BLAST_000002"].family_class) == (2, "BLAST_supported_review")


def test_publishing_is_whole_or_nothing(spark, tmp_path):
    rows = spark.range(5).selectExpr("concat('r', id) as id", "'ACGT' as seq")

    def write(folder):
        sinks.write_fasta(rows, f"{folder}/bodies")
        sinks.write_tsv(rows, f"{folder}/table")

    path = str(tmp_path / "out")
    manifest = sinks.publish(spark, path, write).collect()
    import hashlib

    for r in manifest:
        raw = (tmp_path / "out" / r.path).read_bytes()
        assert (r.bytes, r.sha256, r.md5, r.lines) == (len(raw), hashlib.sha256(raw).hexdigest(), hashlib.md5(raw).hexdigest(), len(raw.splitlines()))
    assert {r.path.split("/")[0] for r in manifest} == {"bodies", "table"} and spark.read.text(f"{path}/bodies").count() == 10
    with pytest.raises(FileExistsError):
        sinks.publish(spark, path, write)
    os.symlink(tmp_path / "nowhere", tmp_path / "link")
    with pytest.raises(FileExistsError):
        sinks.publish(spark, str(tmp_path / "link"), write)

    def broken(folder):
        write(folder)
        raise RuntimeError("half way")

    with pytest.raises(RuntimeError, match="half way"):
        sinks.publish(spark, str(tmp_path / "other"), broken)
    assert sorted(os.listdir(tmp_path)) == ["link", "out"]


def test_manifests_stream_files(spark, tmp_path, monkeypatch):
    """In pieces much smaller than the file, as a file above 2 GB would be."""
    import hashlib

    monkeypatch.setattr(readers, "HASHED", 1000)
    raw = os.urandom(123_457)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "big file.bin").write_bytes(raw)
    row = readers.file_manifest(spark, str(tmp_path / "in")).first()
    assert (row.bytes, row.sha256, row.md5) == (len(raw), hashlib.sha256(raw).hexdigest(), hashlib.md5(raw).hexdigest())
    (tmp_path / "in" / "empty").write_bytes(b"")
    with pytest.raises(Exception, match="empty file"):
        readers.file_manifest(spark, str(tmp_path / "in"))
