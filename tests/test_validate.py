"""A small run that passes, and planted faults that the independent checks must find, and no others."""

import random

import pytest
from pyspark.sql import functions as F

from spanforge.functions import sequence as S
from spanforge.operators import validate
from spanforge.sources import genome


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Tables of a run, made by the library from a genome of two records."""
    draw = random.Random(12)
    path = tmp_path_factory.mktemp("run") / "g.fa"
    records = {"c1": "".join(draw.choices("ACGTN", [30, 30, 30, 30, 1], k=3000)), "c2": "".join(draw.choices("ACGT", k=700))}
    path.write_text("".join(f">{k}\n" + "".join(v[i : i + 70] + "\n" for i in range(0, len(v), 70)) for k, v in records.items()))
    lines = genome.genome_lines(spark, str(path))
    index = genome.genome_index(lines)
    rows = [("L1", "c1", "+", 1500, 1600, True, False, True), ("L2", "c1", "-", 2900, 2990, True, False, True), ("L3", "c2", "+", 1, 90, True, False, True), ("L4", "c2", "-", 100, 180, True, True, False)]
    loci = spark.createDataFrame(rows, "locus_id string, seqid string, strand string, body_start1 int, body_end1 int, family_ga boolean, other_ga boolean, canonical boolean")
    whole = spark.createDataFrame(list(records.items()), "seqid string, text string")
    placed = loci.join(whole, "seqid")
    body = S.oriented(F.col("text"), F.col("strand"), F.col("body_start1"), F.col("body_end1"))
    bodies = placed.select(F.col("locus_id").alias("id"), body.alias("seq"))
    loci = loci.join(bodies.withColumnRenamed("id", "locus_id"), "locus_id").select("*", F.length("seq").alias("body_length"), F.sha2("seq", 256).alias("body_sequence_sha256"), F.when(F.col("strand") == "+", F.col("body_start1")).otherwise(F.col("body_end1")).alias("predicted_tss1")).drop("seq")
    each = placed.where("canonical").join(loci.select("locus_id", "predicted_tss1"), "locus_id").select("*", F.explode(F.array(*map(F.lit, validate.LENGTHS))).alias("requested_length"))
    w = S.upstream(F.col("text"), F.col("strand"), F.col("predicted_tss1"), F.col("requested_length"))
    promoters = each.withColumn("w", w).select("locus_id", F.lit("edge").alias("hypothesis"), F.lit(True).alias("is_primary"), "requested_length", F.col("predicted_tss1").alias("tss1"), "seqid", "strand", F.col("w.status").alias("extraction_status"), F.col("w.start1").alias("start1"), F.col("w.end1").alias("end1"), F.col("w.seq").alias("sequence"), F.length("w.seq").alias("actual_length"), F.col("w.truncated").alias("truncated"), F.col("w.first").alias("first_relative_position"), F.col("w.n_count").alias("n_count"))
    tables = {"loci": loci, "bodies": bodies, "promoters": promoters}
    tables |= {"jobs": validate.jobs_of(loci, bodies, promoters), "candidates": loci.where("canonical"), "bed": loci.where("canonical").select("seqid", (F.col("body_start1") - 1).alias("start0"), F.col("body_end1").alias("end1"), F.col("locus_id").alias("id"), "strand"), "exports": promoters.select("requested_length", F.col("locus_id").alias("id"), F.col("sequence").alias("seq"))}
    return {"lines": lines, "index": index} | {k: spark.createDataFrame(v.collect(), v.schema) for k, v in tables.items()}


def failed(tables):
    return {r.check for r in validate.verdict(validate.validate(**tables)).collect() if r.n_failed}


def test_a_sound_run_passes(run):
    told = {r.check: (r.n, r.n_failed) for r in validate.verdict(validate.validate(**run)).collect()}
    assert told["independent_sequence"] == (4 + 9 - 3, 0) and told["empty_promoter_geometry"] == (3, 0) and told["primary_windows_nested"] == (3, 0)
    assert not any(n for _, n in told.values())


def put(column, value, where):
    return lambda df: df.withColumn(column, F.when(F.expr(where), F.expr(value)).otherwise(F.col(column)))


FAULTS = [
    ("bodies", put("seq", "concat('A', substring(seq, 2))", "id = 'L1' and seq not like 'A%'"), None),
    ("bodies", put("seq", "reverse(seq)", "id = 'L2'"), {"body_geometry_and_digest", "independent_sequence", "jobs_equal_reconstructed_jobs"}),
    ("loci", put("canonical", "true", "locus_id = 'L4'"), {"family_retention", "candidate_rows", "family_bed", "primary_promoters_scope", "primary_windows_nested"}),
    ("promoters", put("n_count", "n_count + 1", "locus_id = 'L1' and requested_length = 500"), {"promoter_geometry"}),
    ("promoters", put("extraction_status", "'boundary_outside_reference'", "actual_length = 0"), {"empty_promoter_geometry"}),
    ("promoters", put("strand", "'-'", "locus_id = 'L1' and requested_length = 300"), {"promoter_scope", "promoter_geometry", "independent_sequence", "jobs_equal_reconstructed_jobs"}),
    ("promoters", lambda df: df.unionByName(df.where("locus_id = 'L1' and requested_length = 300")), {"unique_promoters", "primary_promoters_scope", "primary_windows_nested", "promoter_exports", "jobs_equal_reconstructed_jobs"}),
    ("jobs", put("end1", "end1 + 1", "job_id = 'B__L3'"), {"jobs_equal_reconstructed_jobs"}),
    ("jobs", lambda df: df.where("job_id <> 'B__L4'"), {"jobs_equal_reconstructed_jobs"}),
    ("candidates", put("body_length", "body_length + 1", "locus_id = 'L1'"), {"candidate_rows"}),
    ("bed", put("start0", "start0 + 1", "id = 'L2'"), {"family_bed"}),
    ("exports", put("seq", "lower(seq)", "id = 'L1'"), set()),
    ("exports", lambda df: df.where("requested_length <> 1000"), {"promoter_exports"}),
]


@pytest.mark.parametrize("k", range(len(FAULTS)))
def test_planted_faults_are_found(run, k):
    name, change, wanted = FAULTS[k]
    if wanted is None:
        seq = run["bodies"].where("id = 'L1'").first().seq
        wanted = set() if seq[0] == "A" else {"body_geometry_and_digest", "independent_sequence", "jobs_equal_reconstructed_jobs"}
    assert failed(run | {name: change(run[name])}) == wanted
