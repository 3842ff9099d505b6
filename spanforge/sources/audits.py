"""Audits of annotation against its genome: declared regions, exclusions, bounds, counts by type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.operators.intervals import complement, union, within


def declared_coverage(features: DataFrame, declared: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row for each record of lengths: n_declared regions, n_runs (of their union), uncovered positions, covered_whole,
    n_features and n_outside (features that no run holds whole). Features are told apart by nothing but their place, so
    their numbers may repeat."""
    runs = union(declared)
    placed = features.groupBy("seqid", "start1", "end1").agg(F.count("*").alias("_n")).withColumn("_place", F.struct("seqid", "start1", "end1"))
    held = placed.join(within(placed, runs, "_place"), "_place", "left_semi")
    count = lambda df, name: df.groupBy("seqid").agg(F.count("*").alias(name))
    gaps = complement(runs, lengths).groupBy("seqid").agg(F.sum(F.col("end1") - F.col("start1") + 1).alias("uncovered"))
    out = lengths.select("seqid", "length")
    for part in (count(declared, "n_declared"), count(runs, "n_runs"), gaps, count(features, "n_features"), held.groupBy("seqid").agg(F.sum("_n").alias("_held"))):
        out = out.join(part, "seqid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select("seqid", "length", *[zero(c).alias(c) for c in ("n_declared", "n_runs", "uncovered")], (zero("uncovered") == 0).alias("covered_whole"), zero("n_features").alias("n_features"), (zero("n_features") - zero("_held")).alias("n_outside"))


def audit_annotation(features: DataFrame, declared: DataFrame, lengths: DataFrame, excluded: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Tables of an annotation that passes its coordinate checks; one that does not is refused. features: seqid, kind,
    start1, end1; declared: seqid, start1, end1; lengths: seqid, length; excluded: seqids that are left out on purpose.

    kinds: kind, n; excluded: seqid, n (0 too); regions: declared ones of known records, with covers_whole_record; bare:
    records without a feature. Refused are exclusions that would hide an included record, seqids that are neither known
    nor excluded, and features or regions out of bounds."""
    spark = features.sparkSession
    named = spark.createDataFrame([(x,) for x in dict.fromkeys(excluded)], "seqid string")
    known = lengths.select("seqid", "length")
    if hidden := known.join(named, "seqid", "left_semi").take(1):
        raise ValueError(f"an exclusion would hide annotation of an included record: {hidden[0].seqid}")
    inside = features.join(named, "seqid", "left_anti").join(known, "seqid", "left")
    placed = declared.join(named, "seqid", "left_anti").join(known, "seqid", "left")
    bad = F.col("length").isNull() | ~((F.col("start1") >= 1) & (F.col("start1") <= F.col("end1")) & (F.col("end1") <= F.col("length")))
    for what, rows in (("feature", inside), ("declared region", placed)):
        if wrong := rows.where(bad).select("seqid", "start1", "end1", "length").take(1):
            r = wrong[0]
            raise ValueError(f"{what} {'of an unknown record' if r.length is None else 'out of bounds'}: {r.seqid}:{r.start1}-{r.end1}")
    left_out = features.join(named, "seqid", "left_semi").groupBy("seqid").agg(F.count("*").alias("n"))
    return {
        "kinds": inside.groupBy("kind").agg(F.count("*").alias("n")), "excluded": named.join(left_out, "seqid", "left").select("seqid", F.coalesce("n", F.lit(0)).alias("n")),
        "regions": placed.select("seqid", "start1", "end1", ((F.col("start1") == 1) & (F.col("end1") == F.col("length"))).alias("covers_whole_record")), "bare": known.select("seqid").join(inside.select("seqid").distinct(), "seqid", "left_anti"),
    }
