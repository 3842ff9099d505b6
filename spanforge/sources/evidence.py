"""Hits of several searches as one table of evidence, in the order of input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.operators.support import Policy, support_tier


def in_order(sources: Sequence[DataFrame], line: str = "line") -> DataFrame:
    """The rows of all sources, columns by name (missing ones null), with ordinal: sources in the order given, and rows of
    a source by their line. It is the same however the files are split, and no rows are counted for it."""
    out = None
    for k, rows in enumerate(sources):
        some = rows.withColumn("ordinal", F.lit(k << 40) + F.col(line).cast("long"))
        out = some if out is None else out.unionByName(some, allowMissingColumns=True)
    if out is None:
        raise ValueError("no source")
    return out


def evidence(search: DataFrame, family: DataFrame, other: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The hits that `loci.loci` takes: those of `readers.read_blast`, then of `readers.read_tblout` for the family's model
    and for its competitor's, with their tier and ordinal."""
    blast = search.select(F.col("raw_hit_id").alias("id"), "seqid", "strand", "method", "query", "start1", "end1", "pident", F.col("qcov_exact").alias("qcov"), F.col("bitscore").alias("bits"), "qstart", "gapopen", F.col("slen").alias("subject_length"), "evalue", "line")
    model = lambda rows, name: rows.select(F.col("raw_hit_id").alias("id"), "seqid", "strand", "method", F.lit(name).alias("query"), "start1", "end1", (100 * F.col("model_coverage")).alias("qcov"), "score", "ga_pass", "trunc", "evalue", "line")
    both = in_order([blast, model(family, "family"), model(other, "other")])
    return both.drop("line").withColumn("tier", support_tier(F.col("method"), F.col("pident"), F.col("qcov"), F.col("bits"), policy))
