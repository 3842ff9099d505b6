"""Independent checks of a run's tables: every sequence is taken anew from the genome's lines by line arithmetic, every
place is derived anew, and the tables must agree with each other. Nothing here uses the code that made the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Letters and their complements, window lengths of the primary boundary, states of empty windows.
_LETTERS, _PARTNERS = "ACGTRYKMBVDHSWN", "TGCAYRMKVBHDSWN"
LENGTHS = (300, 500, 1000)
OUTSIDE, AT_EDGE = "boundary_outside_reference", "no_upstream_sequence_at_reference_edge"
JOB = ["seqid", "start1", "end1", "strand", "sequence"]


def extracted(lines: DataFrame, index: DataFrame, jobs: DataFrame) -> DataFrame:
    """job_id and observed, the sequence at each job's place in the direction of its strand, from `genome.genome_lines` and
    `genome.genome_index`: a place is a line and a column, as all lines of a record but the last are of one width. Jobs
    outside their record get what there is."""
    width = F.col("line_bases").cast("long")
    last = (F.least(F.col("end1").cast("long"), F.col("length")) - 1).cast("long")
    first = (F.greatest(F.col("start1").cast("long"), F.lit(1)) - 1).cast("long")
    asked = jobs.join(F.broadcast(index.select("seqid", "length", "line_bases")), "seqid").where(first <= last)
    asked = asked.select("job_id", "seqid", "strand", first.alias("_first"), last.alias("_last"), width.alias("_width")).withColumn("_line", F.explode(F.sequence(F.floor(F.col("_first") / F.col("_width")), F.floor(F.col("_last") / F.col("_width")))))
    numbered = lines.where((F.col("header") == F.lit(False)) & (F.length("bases") > 0)).join(F.broadcast(index.select("seqid", F.col("line_bases").alias("_width"))), "seqid").select("seqid", F.floor(F.col("first") / F.col("_width")).alias("_line"), "bases")
    begin = F.greatest(F.lit(0).cast("long"), F.col("_first") - F.col("_line") * F.col("_width")).cast("int")
    end = F.least(F.col("_width"), F.col("_last") + 1 - F.col("_line") * F.col("_width")).cast("int")
    parts = asked.join(numbered, ["seqid", "_line"]).select("job_id", "strand", F.struct("_line", F.substring(F.col("bases"), begin + 1, end - begin).alias("part")).alias("p"))
    whole = parts.groupBy("job_id", "strand").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["part"]), "").alias("plus"))
    return whole.select("job_id", F.when(F.col("strand") == "-", F.translate(F.reverse("plus"), _LETTERS, _PARTNERS)).otherwise(F.col("plus")).alias("observed"))


def jobs_of(loci: DataFrame, bodies: DataFrame, promoters: DataFrame) -> DataFrame:
    """The jobs that a run must have: one a body, and one a promoter window that is not empty."""
    body = loci.join(bodies.select(F.col("id").alias("locus_id"), F.upper("seq").alias("sequence")), "locus_id", "left")
    own = body.select(F.concat(F.lit("B__"), "locus_id").alias("job_id"), "seqid", F.col("body_start1").alias("start1"), F.col("body_end1").alias("end1"), "strand", F.coalesce("sequence", F.lit("")).alias("sequence"))
    some = promoters.where("actual_length > 0")
    return own.unionByName(some.select(F.concat_ws("__", F.lit("P"), "locus_id", "hypothesis", F.col("requested_length").cast("string")).alias("job_id"), "seqid", "start1", "end1", "strand", F.upper("sequence").alias("sequence")))


def _told(rows: DataFrame, name: str, key: Column, passed: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("check"), key.cast("string").alias("key"), F.coalesce(passed, F.lit(False)).alias("passed"))


def _differ(a: DataFrame, b: DataFrame, name: str, key: str) -> DataFrame:
    """One row a key that the two tables do not have alike, as multisets of whole rows; none if they agree."""
    count = lambda df, n: df.groupBy(*df.columns).agg(F.count("*").alias(n))
    left, right = count(a, "_a"), count(b.select(*a.columns), "_b")
    same = reduce(lambda x, y: x & y, [left[c].eqNullSafe(right[c]) for c in a.columns])
    met = left.join(right, same, "full").where(~F.col("_a").eqNullSafe(F.col("_b")))
    return _told(met.select(F.coalesce(left[key], right[key]).alias("_k")).distinct(), name, F.col("_k"), F.lit(False))


def validate(lines: DataFrame, index: DataFrame, loci: DataFrame, bodies: DataFrame, promoters: DataFrame, jobs: DataFrame, candidates: DataFrame, bed: DataFrame, exports: DataFrame) -> DataFrame:
    """check, key and passed: a row for each row that is checked, and for each difference between tables.

    loci: locus_id, seqid, strand, body_start1, body_end1, body_length, body_sequence_sha256, family_ga, other_ga,
    canonical, predicted_tss1; bodies: id, seq; promoters: locus_id, hypothesis, is_primary, requested_length, tss1, seqid,
    strand, extraction_status, start1, end1, sequence, actual_length, truncated, first_relative_position, n_count; jobs:
    job_id and JOB; candidates: columns of loci; bed: seqid, start0, end1, id, strand; exports: requested_length, id, seq."""
    sizes = index.select("seqid", F.col("length").alias("_size"))
    c = F.col
    body = loci.join(sizes, "seqid", "left").join(bodies.select(c("id").alias("locus_id"), F.upper("seq").alias("_seq")), "locus_id", "left")
    good = (c("body_start1") >= 1) & (c("body_start1") <= c("body_end1")) & (c("body_end1") <= c("_size")) & (F.length("_seq") == c("body_end1") - c("body_start1") + 1) & (c("body_length") == F.length("_seq")) & (F.sha2("_seq", 256) == c("body_sequence_sha256")) & c("strand").isin("+", "-")
    family = loci.where("canonical")
    out = [
        _told(loci.groupBy("locus_id").count(), "unique_locus_ids", c("locus_id"), c("count") == 1), _differ(loci.select(c("locus_id").alias("id")), bodies.select("id"), "all_search_body_ids", "id"),
        _told(body, "body_geometry_and_digest", c("locus_id"), good), _told(loci, "family_retention", c("locus_id"), c("canonical") == (c("family_ga") & ~c("other_ga"))),
    ]
    p = promoters.join(family.select("locus_id", c("seqid").alias("_seqid"), c("strand").alias("_strand"), c("predicted_tss1").alias("_tss")), "locus_id", "left").join(sizes, "seqid", "left")
    name = F.concat_ws("/", "locus_id", "hypothesis", c("requested_length").cast("string"))
    plus, inside = c("strand") == "+", c("tss1").between(1, F.coalesce("_size", F.lit(0)))
    start, end = F.when(plus, F.greatest(F.lit(1), c("tss1") - c("requested_length"))).otherwise(c("tss1") + 1), F.when(plus, c("tss1") - 1).otherwise(F.least(c("_size"), c("tss1") + c("requested_length")))
    reason = (~inside & (c("extraction_status") == OUTSIDE)) | (inside & (start > end) & (c("extraction_status") == AT_EDGE))
    empty = (F.coalesce("sequence", F.lit("")) == "") & reason & c("truncated")
    text = F.upper("sequence")
    whole = (
        (c("requested_length") > 0) & c("strand").isin("+", "-") & inside & (c("start1") == start) & (c("end1") == end) & (start <= end) & (F.length(text) == c("actual_length")) & (c("actual_length") == c("end1") - c("start1") + 1)
        & (c("first_relative_position") == -c("actual_length")) & (c("truncated") == (c("actual_length") < c("requested_length"))) & (c("n_count") == F.length(text) - F.length(F.replace(text, F.lit("N"), F.lit(""))))
    )
    out += [
        _told(promoters.groupBy("locus_id", "hypothesis", "requested_length").count(), "unique_promoters", name, c("count") == 1), _told(p, "promoter_scope", name, c("_seqid").eqNullSafe(c("seqid")) & c("_strand").eqNullSafe(c("strand"))),
        _told(p.where("actual_length = 0"), "empty_promoter_geometry", name, empty), _told(p.where("actual_length <> 0"), "promoter_geometry", name, whole),
    ]
    primary = p.where("is_primary")
    wanted = family.select("locus_id", F.explode(F.array(*map(F.lit, LENGTHS))).alias("requested_length"))
    three = primary.groupBy("locus_id").agg(F.array_sort(F.collect_list(F.struct("requested_length", F.coalesce(text, F.lit("")).alias("s")))).alias("w"), F.bool_and(c("tss1").eqNullSafe(c("_tss"))).alias("same"))
    nested = (F.size("w") == len(LENGTHS)) & c("same") & F.endswith(c("w")[1]["s"], c("w")[0]["s"]) & F.endswith(c("w")[2]["s"], c("w")[1]["s"])
    out += [
        _differ(wanted, primary.select("locus_id", "requested_length"), "primary_promoters_scope", "locus_id"), _told(family.select("locus_id").join(three, "locus_id", "left"), "primary_windows_nested", c("locus_id"), nested),
        _differ(primary.select("requested_length", c("locus_id").alias("id"), F.coalesce(text, F.lit("")).alias("seq")), exports.select("requested_length", "id", F.upper("seq").alias("seq")), "promoter_exports", "id"),
        _differ(family.select(*candidates.columns), candidates, "candidate_rows", "locus_id"),
        _differ(family.select("seqid", (c("body_start1") - 1).alias("start0"), c("body_end1").alias("end1"), c("locus_id").alias("id"), "strand"), bed, "family_bed", "id"),
    ]
    rebuilt = jobs_of(loci, bodies, promoters)
    fresh = extracted(lines, index, rebuilt.dropDuplicates(["job_id"]))
    compared = rebuilt.join(fresh, "job_id", "left")
    out += [_differ(rebuilt, jobs.withColumn("sequence", F.upper("sequence")), "jobs_equal_reconstructed_jobs", "job_id"), _told(compared, "independent_sequence", c("job_id"), F.coalesce("observed", F.lit("")) == c("sequence"))]
    return reduce(DataFrame.unionByName, out)


def verdict(checks: DataFrame) -> DataFrame:
    """check, n and n_failed of every check that was made."""
    return checks.groupBy("check").agg(F.count("*").alias("n"), F.count_if(~F.col("passed")).alias("n_failed"))
