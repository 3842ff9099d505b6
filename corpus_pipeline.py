"""From raw documents to token files: rules, near duplicates, decontamination, mixing, output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.llm import arrow_tokens, jaccard_join, line_cleaning, soft_mixing, spaced_seeds
from spanforge.llm.shared import join_checked, shared_folder, small_batches, with_key, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without the lines that fail; n_chars follows the text. Null and empty texts, which
    have too few words, go; rows without an id are judged like any other, and repeated rows stay repeated."""
    # A projection that depends on the partition keeps the filter above it, so that the rules run once.
    judged = line_cleaning.clean_lines(docs.select(*COLUMNS)).withColumn("kept", F.col("kept") & (F.spark_partition_id() >= 0))
    kept = judged.where("kept")
    return kept.withColumn("text", F.col("cleaned_text")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group at 0.8 or more of five-word shingles: that of least id, rows without an id last. Texts without
    a word are like no other and stay, repeated or not; of other repeated rows one stays."""
    small_batches(spark)
    return jaccard_join.least_rows(with_key(docs.select(*COLUMNS), *COLUMNS)).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item, with an id or without; null and empty texts overlap none and stay."""
    small_batches(spark)
    return spaced_seeds.decontaminate(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as their fitted rates say. The targets follow from the stage's input: clean tokens
    stay as they are, and the other domains get their share of `soft_mixing.SHARES` beside them, but never more tokens
    than they have, as more would only repeat them. Documents labelled clean, or judged so where no label tells, all stay."""
    small_batches(spark)
    labels = soft_mixing.domain_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    known = labels.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    keyed = with_key(docs.select(*COLUMNS), *COLUMNS)
    rows = join_checked(keyed, written(known, "domains"), "doc_id", "left")
    rates = soft_mixing.soft_mix(rows, labels, ["row_key", "domain"], whole="domain")
    # Rows of one key are alike, and so are their rates.
    copies = written(rates.groupBy("row_key").agg(F.min("rate").alias("rate")).select("row_key", soft_mixing.copies(F.col("rate"), F.col("row_key")).alias("copies")), "copies")
    joined = join_checked(keyed, copies, "row_key")
    return joined.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and where each document is in them, read back from the files. A null or empty text is
    its end id alone; rows without an id and repeated rows are encoded each once a row."""
    small_batches(spark)
    manifest = arrow_tokens.write_arrow(docs, shared_folder(spark, "arrow-tokens"), public_tokenizers.path("word_bpe_49k.json"))
    return arrow_tokens.read_arrow(manifest)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", token_files),
]

#: The classifier of the mixing stage and the tokenizer of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
