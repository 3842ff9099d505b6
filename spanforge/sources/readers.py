"""Readers of sequence-search text formats as typed DataFrames; malformed rows raise when they are read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, n (line from 1), line. Files are read in splits: a line's number is its place in its split after the lines
    of the splits before it, of which only the counts meet in one place. Files may be compressed."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"))
    counts = raw.groupBy("file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block")) - F.col("_n")
    return raw.join(counts.withColumn("_before", before), ["file", "_block"]).select("file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).cast("int").alias("n"), "line")


def checked(value: Column, good: Column, message: str) -> Column:
    return F.when(good, value).otherwise(F.raise_error(F.lit(message)))


def read_fasta(spark: SparkSession, path: str, ids: list[str] | None = None) -> DataFrame:
    """seqid (first word of the header), seq (upper case), length of files of short records, one row each; splits at record
    starts, so files of many records are read in parallel. ``ids`` keeps some records only. A repeated id raises, as does
    text before the first record. For long records, see `genome`."""
    records = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("file"), "value").where(F.length(F.trim("value")) > 0)
    if headless := records.groupBy("file").agg(F.count_if(F.col("value").startswith(">")).alias("k")).where("k = 0").take(1):
        raise ValueError(f"text before the first record: {headless[0].file}")
    head, body = F.substring_index("value", "\n", 1), F.regexp_replace("value", r"^[^\n]*\n?", "")
    rows = records.select(F.split(F.regexp_replace(head, "^>", ""), r"\s+")[0].alias("seqid"), F.upper(F.regexp_replace(body, r"\s", "")).alias("seq"))
    rows = rows.withColumn("length", F.length("seq"))
    if twice := rows.groupBy("seqid").count().where("count > 1").select("seqid").take(1):
        raise ValueError(f"sequence id is repeated: {twice[0][0]}")
    return rows if ids is None else rows.where(F.col("seqid").isin(ids))


def audit_fasta(genome: DataFrame, letters: str = "ACGTRYSWKMBDHVN") -> DataFrame:
    """seqid, length, n_count, ambiguous, foreign (letters outside the alphabet), sha256 of each sequence."""
    left = lambda keep: F.length(F.translate("seq", keep, ""))
    return genome.select("seqid", "length", (F.length("seq") - left("N")).alias("n_count"), left("ACGT").alias("ambiguous"), left(letters).alias("foreign"), F.sha2("seq", 256).alias("sha256"))


def read_blast(spark: SparkSession, path: str, species: str) -> DataFrame:
    """Tabular hits of 15 or 18 columns (comments skipped); coordinates become rising, with a strand; ids number the data
    rows. Aligned strings (of 18 columns) must be of the length told and hold as many bases as the coordinates span."""
    names = "query seqid pident alignment_length mismatch gapopen qstart qend sstart send evalue bitscore qlen slen qcov_reported qseq sseq btop".split()
    data = _lines(spark, path).where("trim(line) <> '' and line not like '#%'").withColumn("f", F.split("line", "\t"))
    number = F.row_number().over(Window.partitionBy("file").orderBy("n"))
    cols = {x: F.get("f", F.lit(k)) for k, x in enumerate(names)}
    kinds = {x: "double" for x in ("pident", "evalue", "bitscore", "qcov_reported")} | {x: "int" for x in ("alignment_length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "qlen", "slen")}
    out = data.withColumn("ordinal", number).select("n", "ordinal", *[v.cast(kinds.get(k, "string")).alias(k) for k, v in cols.items()], F.size("f").alias("_size"))
    bases = lambda x: F.length(F.replace(F.col(x), F.lit("-"), F.lit("")))
    told = (F.length("qseq") == F.col("alignment_length")) & (F.length("sseq") == F.col("alignment_length")) & (bases("qseq") == F.col("qend") - F.col("qstart") + 1) & (bases("sseq") == F.abs(F.col("send") - F.col("sstart")) + 1)
    good = F.col("_size").isin(15, 18) & ((F.col("_size") == 15) | F.coalesce(told, F.lit(False))) & (F.col("qstart") >= 1) & (F.col("qstart") <= F.col("qend")) & (F.col("qend") <= F.col("qlen")) & (F.least("sstart", "send") >= 1) & (F.greatest("sstart", "send") <= F.col("slen"))
    return out.select(
        checked(F.format_string(f"{species}_BLAST_%06d", "ordinal"), good, "bad tabular hit").alias("raw_hit_id"), F.lit("blastn").alias("method"), *[F.col(x) for x in names if x not in ("sstart", "send")],
        F.least("sstart", "send").alias("start1"), F.greatest("sstart", "send").alias("end1"), F.when(F.col("sstart") <= F.col("send"), "+").otherwise("-").alias("strand"),
        (F.lit(100.0) * (F.col("qend") - F.col("qstart") + 1) / F.col("qlen")).alias("qcov_exact"), F.col("n").alias("line"),
    )


def read_tblout(spark: SparkSession, path: str, species: str, accession: str, clen: int, ga: float) -> DataFrame:
    """Covariance-model hits from a table of 18 white-space fields, with model coverage and whether the score passes ``ga``."""
    data = _lines(spark, path).where("trim(line) <> '' and line not like '#%'").withColumn("f", F.split(F.trim("line"), r"\s+", 18))
    number = F.row_number().over(Window.partitionBy("file").orderBy("n"))
    x = lambda k, kind="int": F.get("f", F.lit(k)).cast(kind)
    good = (F.get("f", F.lit(4)) == "cm") & F.get("f", F.lit(3)).isin(accession, "-") & (x(5) >= 1) & (x(5) <= x(6)) & (x(6) <= clen)
    return data.withColumn("ordinal", number).select(
        checked(F.format_string(f"{species}_{accession}_%06d", "ordinal"), good, "bad model hit").alias("raw_hit_id"), F.lit("cmsearch").alias("method"), F.lit(accession).alias("query"), F.get("f", F.lit(0)).alias("seqid"),
        F.least(x(7), x(8)).alias("start1"), F.greatest(x(7), x(8)).alias("end1"), F.get("f", F.lit(9)).alias("strand"), x(5).alias("model_from"), x(6).alias("model_to"), ((x(6) - x(5) + 1) / F.lit(float(clen))).alias("model_coverage"),
        F.get("f", F.lit(10)).alias("trunc"), x(13, "double").alias("bias"), x(14, "double").alias("score"), x(15, "double").alias("evalue"), (x(14, "double") >= ga).alias("ga_pass"), F.col("n").alias("line"),
    )


def read_model_header(spark: SparkSession, path: str) -> dict[str, str]:
    """First ACC, NAME, CLEN, GA and W of a covariance model, before the line that opens its body."""
    lines = _lines(spark, path).withColumn("f", F.split(F.trim("line"), r"\s+"))
    stop = lines.where(F.col("f")[0] == "CM").agg(F.min("n")).first()[0]
    head = lines.where(F.col("f")[0].isin("ACC", "NAME", "CLEN", "GA", "W") & (F.col("n") < (stop if stop is not None else 1 << 31)))
    return {r.tag: r.value for r in head.groupBy(F.col("f")[0].alias("tag")).agg(F.min_by(F.get("f", F.lit(1)), "n").alias("value")).collect()}


def read_stockholm(spark: SparkSession, path: str) -> DataFrame:
    """name, aligned of one alignment; blocks are joined, and the RF and SS_cons lines come as '#RF' and '#SS_cons'.
    Raises without the closing mark, with text after it, without sequences or RF, on ragged rows and malformed lines."""
    lines = _lines(spark, path).withColumn("f", F.split(F.trim("line"), r"\s+"))
    data = lines.where("trim(line) <> '' and line not like '#%'")
    end = data.where("trim(line) = '//'").agg(F.min("n"), F.count("*")).first()
    if end[0] is None or data.where(F.col("n") > end[0]).limit(1).count():
        raise ValueError("expected one alignment that ends with //")
    column = lines.where("line like '#=GC RF%' or line like '#=GC SS_cons%'").select(F.concat(F.lit("#"), F.col("f")[1]).alias("name"), "n", F.get("f", F.lit(2)).alias("part"))
    rows = data.where("trim(line) <> '//'").select(checked(F.col("f")[0], F.size("f") == 2, "malformed alignment row").alias("name"), "n", F.get("f", F.lit(1)).alias("part"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "part"))), lambda x: x["part"]), "")
    out = rows.unionByName(column).groupBy("name").agg(joined.alias("aligned"))
    sizes = out.agg(F.count_if(F.col("name") == "#RF").alias("rf"), F.count_if(~F.col("name").startswith("#")).alias("rows"), F.countDistinct(F.length("aligned")).alias("lengths")).first()
    if not sizes.rf or not sizes.rows or sizes.lengths != 1:
        raise ValueError("sequences and an RF line of one length are required")
    return out


def unquoted(text: Column) -> Column:
    """Text with %XX decoded; a per cent sign that no two hexadecimal digits follow stays, as does a plus sign."""
    return F.url_decode(F.replace(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B")))


def _gff_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of annotation files up to ##FASTA."""
    lines = _lines(spark, path)
    stop = lines.where("line like '##FASTA%'").groupBy("file").agg(F.min("n").alias("stop"))
    return lines.join(stop, "file", "left").where("stop is null or n < stop")


def read_declared_regions(spark: SparkSession, path: str) -> DataFrame:
    """seqid, start1, end1 of the ##sequence-region lines."""
    f = F.split(F.trim("line"), r"\s+")
    return _gff_lines(spark, path).where("line like '##sequence-region %'").select(checked(unquoted(F.get(f, F.lit(1))), F.size(f) == 4, "bad sequence-region line").alias("seqid"), F.get(f, F.lit(2)).cast("int").alias("start1"), F.get(f, F.lit(3)).cast("int").alias("end1"))


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    """Features (9 columns, plain or gzip) up to ##FASTA; seqids are decoded, attributes after they are split."""
    data = _gff_lines(spark, path).where("trim(line) <> '' and line not like '#%'").withColumn("f", F.split("line", "\t"))
    decode = unquoted
    items = F.filter(F.split(F.get("f", F.lit(8)), ";"), lambda x: ~F.trim(x).isin("", "."))
    pairs = F.transform(items, lambda x: F.struct(checked(decode(F.trim(F.substring_index(x, "=", 1))), x.contains("="), "attribute without =").alias("k"), F.transform(F.split(F.regexp_replace(x, "^[^=]*=", ""), ","), decode).alias("v")))
    # Values of a repeated key are one list.
    folded = F.transform(F.array_distinct(F.transform("pairs", lambda p: p["k"])), lambda k: F.struct(k, F.flatten(F.transform(F.filter("pairs", lambda p: p["k"] == k), lambda p: p["v"]))))
    good = (F.size("f") == 9) & (F.get("f", F.lit(3)).cast("int") >= 1) & (F.get("f", F.lit(3)).cast("int") <= F.get("f", F.lit(4)).cast("int")) & F.get("f", F.lit(6)).isin("+", "-", ".", "?")
    out = data.select(checked(unquoted(F.get("f", F.lit(0))), good, "bad feature row").alias("seqid"), F.get("f", F.lit(1)).alias("source"), F.get("f", F.lit(2)).alias("kind"), F.get("f", F.lit(3)).cast("int").alias("start1"), F.get("f", F.lit(4)).cast("int").alias("end1"), F.get("f", F.lit(6)).alias("strand"), pairs.alias("pairs"), F.col("n").alias("line_number"))
    out = out.withColumn("attrs", F.map_from_entries(folded)).drop("pairs")
    empty = F.array().cast("array<string>")
    return out.withColumns({"declared_id": F.get(F.coalesce(F.try_element_at("attrs", F.lit("ID")), empty), F.lit(0)), "parents": F.coalesce(F.try_element_at("attrs", F.lit("Parent")), empty)})


def audit_gff(features: DataFrame, lengths: DataFrame) -> DataFrame:
    """problem, seqid and n of features on unknown sequences, beyond their end, or with a parent that no row declares."""
    placed = features.join(lengths.select("seqid", "length"), "seqid", "left")
    where = F.when(F.col("length").isNull(), "unknown_seqid").when(F.col("end1") > F.col("length"), "beyond_sequence_end")
    known = features.where("declared_id is not null").select(F.col("declared_id").alias("parent")).distinct()
    orphan = features.select("seqid", F.explode("parents").alias("parent")).join(known, "parent", "left_anti").select(F.lit("unresolved_parent").alias("problem"), "seqid")
    return placed.select(where.alias("problem"), "seqid").where("problem is not null").unionByName(orphan).groupBy("problem", "seqid").agg(F.count("*").alias("n"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated rows with a header, all as text; NA and empty fields are null. A ragged row raises."""
    return spark.read.option("sep", "\t").option("header", "true").option("nullValue", "NA").option("quote", "").option("mode", "FAILFAST").option("enforceSchema", "false").csv(path)


#: Bytes of a file that are hashed at once.
HASHED = 1 << 22


def file_manifest(spark: SparkSession, path: str, allow_empty: bool = False) -> DataFrame:
    """path, bytes, lines, sha256, md5 of every file under a folder, in order. A task streams its files in pieces of HASHED
    bytes, so that a file may be of any size. An empty file raises, but for names that begin with a dot or
    underscore; with ``allow_empty`` it is left out, as Spark's writers make empty parts."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(where, True)
    while not allow_empty and listed.hasNext():  # Spark's readers list no empty files
        found = listed.next()
        if found.getLen() == 0 and found.getPath().getName()[0] not in "._":
            raise ValueError(f"empty file: {found.getPath()}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").orderBy("path")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path_, size in zip(*(batch.column(c).to_pylist() for c in ("path", "length")), strict=True):
                system, place = fs.FileSystem.from_uri(path_) if "://" in path_ else (fs.LocalFileSystem(), unquote(path_.removeprefix("file:")))
                sha, md, lines, last = hashlib.sha256(), hashlib.md5(usedforsecurity=False), 0, b"\n"
                with system.open_input_stream(place) as stream:
                    while piece := stream.read(HASHED):
                        sha.update(piece)
                        md.update(piece)
                        lines, last = lines + piece.count(b"\n"), piece[-1:]
                rows.append((path_, size, lines + (last != b"\n"), sha.hexdigest(), md.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True) if rows else ((),) * 5, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["path", "bytes", "lines", "sha256", "md5"])

    return files.mapInArrow(digest, "path string, bytes long, lines long, sha256 string, md5 string")


def preserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """path and change (added, removed, changed) of files that differ between two manifests."""
    both = before.select("path", F.col("sha256").alias("a")).join(after.select("path", F.col("sha256").alias("b")), "path", "full")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return both.select("path", change.alias("change")).where("change is not null")
