"""Genomes as chunks, straight from the lines of FASTA files: no record is ever one row.

Files are read in splits. What a line lacks, its record and its place in it, is carried over splits by one summary row a
split: the record open at its end, and the bases of that record so far. Within a split the lines follow in order. So a
record of any length is read by as many tasks as it has splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanforge.operators.annotation import cut
from spanforge.sources.readers import checked

#: Bases of a chunk; letters that a sequence may have.
CHUNK, LETTERS = 1 << 16, "ACGTRYSWKMBDHVN"


def genome_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row a line of FASTA files, written once: file, split, at (order within it), seqid (null before any header),
    header, bases (upper case), first (bases of the record before it), offset (bytes of the file before it), width (its
    bytes, the line end among them)."""
    raw = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"), F.col("value"))
    line = F.rtrim(F.col("value"), F.lit("\r"))
    header = line.startswith(">")
    name = F.when(header, F.get(F.split(F.trim(F.substring(line, 2, 1 << 30)), r"\s+"), F.lit(0)))
    # The last header of a split, the bases after it, and its bytes.
    lines = raw.select("file", "split", "size", "at", header.alias("header"), name.alias("name"), F.when(header, "").otherwise(F.upper(line)).alias("bases"), (F.octet_length("value") + 1).cast("long").alias("width"))
    inside = Window.partitionBy("file", "split").orderBy("at")
    sofar = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    n = F.length("bases").cast("long")
    placed = cut(lines.withColumns({"_total": zero(F.sum(n).over(sofar)), "_bytes": zero(F.sum("width").over(sofar)), "_open": F.last(F.when(F.col("header"), F.struct("name", "at")), ignorenulls=True).over(upto)}).withColumn("_before", F.last(F.when(F.col("header"), F.col("_total")), ignorenulls=True).over(upto)))
    summary = placed.groupBy("file", "split").agg(F.sum(n).alias("all"), F.max_by("_open", F.when(F.col("_open").isNotNull(), F.col("at"))).alias("last"), F.max("_before").alias("before"), F.sum("width").alias("bytes"))
    # Over splits, of which a file has few: the record open at a split's start, and what it has by then.
    files = Window.partitionBy("file").orderBy("split")
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.when(F.col("last").isNotNull(), F.struct(F.col("last.name").alias("name"), (F.col("all") - F.col("before")).alias("rest"), F.col("_cum").alias("cum"))), ignorenulls=True).over(earlier)
    carried = summary.withColumn("_cum", F.sum("all").over(files)).withColumn("_from", opened)
    carried = carried.select("file", "split", F.col("_from.name").alias("_name"), zero(F.col("_from.rest") + F.col("_cum") - F.col("all") - F.col("_from.cum")).alias("_carried"), zero(F.sum("bytes").over(earlier)).alias("_start"))
    whole = placed.join(F.broadcast(carried), ["file", "split"])
    own = F.col("_open").isNotNull()
    return cut(whole.select("file", "split", "at", F.when(own, F.col("_open.name")).otherwise(F.col("_name")).alias("seqid"), F.col("_open.at").alias("record"), "header", "bases", F.when(own, F.col("_total") - F.col("_before")).otherwise(F.col("_carried") + F.col("_total")).alias("first"), (F.col("_start") + F.col("_bytes")).alias("offset"), "width", "size"))


def genome_index(lines: DataFrame) -> DataFrame:
    """seqid, length, offset, line_bases, line_width of every record, with its letter counts: the audit of `genome_lines`.

    Refused are text before the first header, headers without a name, repeated names, records without a base, blank lines
    and letters outside the alphabet within a record, lines of unequal width before a record's last, and a last line that
    is longer."""
    first = lambda cond, message: (lines.where(cond).select("file", "seqid").take(1), message)
    body = F.col("header") == F.lit(False)
    for found, message in (
        first(body & F.col("seqid").isNull(), "text before the first record"), first(F.col("header") & (F.coalesce("seqid", F.lit("")) == ""), "header without a name"),
        first(body & ((F.length("bases") == 0) | (F.length(F.translate("bases", LETTERS, "")) > 0)), "blank line or foreign letter"),
    ):
        if found:
            raise ValueError(f"{message}: {found[0].file} {found[0].seqid or ''}".rstrip())
    n = F.length("bases").cast("long")
    some = lines.where(body)
    last = F.struct("first", n.alias("n"))
    by = some.groupBy("file", "seqid").agg(
        F.sum(n).alias("length"), F.min_by("offset", "first").alias("offset"), F.min_by(n, "first").alias("line_bases"), F.min_by("width", "first").alias("line_width"), F.max(last).alias("_last"), F.count("*").alias("n_lines"), F.max(n).alias("_most"),
        F.sum(n - F.length(F.translate("bases", "N", ""))).alias("n_count"), F.sum(F.length(F.translate("bases", "ACGT", ""))).alias("ambiguous"),
    )
    heads = lines.where("header").groupBy("seqid").agg(F.count("*").alias("heads"))
    both = cut(heads.join(by, "seqid", "left"))
    # All lines but the last are as the first: their bases, and their bytes, which must differ by the same line end.
    uneven = some.join(F.broadcast(both.select("file", "seqid", "line_bases", "line_width", "_last")), ["file", "seqid"]).where((F.col("first") < F.col("_last.first")) & ((n != F.col("line_bases")) | (F.col("width") != F.col("line_width"))))
    for found, message in ((both.where("heads > 1").take(1), "repeated id"), (both.where("length is null").take(1), "record without a base"), (both.where("_last.n > line_bases").take(1), "last line longer than the others"), (uneven.take(1), "lines of unequal width")):
        if found:
            raise ValueError(f"{message}: {found[0].seqid}")
    return both.select("seqid", "length", "offset", "line_bases", "line_width", "n_count", "ambiguous")


def genome_chunks(lines: DataFrame, size: int = CHUNK) -> DataFrame:
    """seqid, chunk, seq: every record in pieces of ``size`` bases (the last shorter), each made of the lines that reach
    into it; no row is longer than that."""
    n = F.length("bases")
    spans = F.sequence(F.floor(F.col("first") / size), F.floor((F.col("first") + n - 1) / size))
    each = lines.where((F.col("header") == F.lit(False)) & (n > 0)).select("seqid", "first", "bases", F.explode(spans).alias("chunk"))
    low = F.greatest(F.lit(0).cast("long"), F.col("chunk") * size - F.col("first")).cast("int")
    high = F.least(F.length("bases").cast("long"), (F.col("chunk") + 1) * size - F.col("first")).cast("int")
    parts = each.select("seqid", "chunk", F.struct(F.col("first").alias("first"), F.substring(F.col("bases"), low + 1, high - low).alias("part")).alias("p"))
    return parts.groupBy("seqid", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["part"]), "").alias("seq"))


def fetch(chunks: DataFrame, regions: DataFrame, size: int = CHUNK) -> DataFrame:
    """regions (seqid, start1, end1 and others) with seq, stitched from all chunks that they reach into, in order. One that
    leaves its sequence raises. Regions that repeat are fetched once."""
    place = ["seqid", "start1", "end1"]
    n: Column = F.col("end1") - F.col("start1") + 1
    wanted = regions.select(*place).distinct()
    inside = (F.col("start1") >= 1) & (n >= 1)
    asked = wanted.where(inside).withColumn("chunk", F.explode(F.sequence(F.floor((F.col("start1") - 1) / size), F.floor((F.col("end1") - 1) / size))))
    low = F.greatest(F.lit(0).cast("long"), F.col("start1") - 1 - F.col("chunk") * size).cast("int")
    high = F.least(F.lit(size).cast("long"), F.col("end1") - F.col("chunk") * size).cast("int")
    met = asked.join(chunks, ["seqid", "chunk"]).select(*place, F.struct("chunk", F.substring(F.col("seq"), low + 1, high - low).alias("part")).alias("p"))
    joined = met.groupBy(*place).agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda x: x["part"]), "").alias("seq"))
    return regions.join(joined, place, "left").withColumn("seq", checked(F.col("seq"), F.coalesce(F.length("seq") == n, F.lit(False)), "region outside its sequence"))
