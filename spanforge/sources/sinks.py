"""Writers of result tables and sequences. Spark refuses an existing folder, so nothing is ever overwritten."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanforge.sources.readers import file_manifest


def cell(df: DataFrame, name: str):
    """Text of a cell: null as NA, nested values as JSON with nulls kept."""
    kind = dict(df.dtypes)[name]
    value = F.to_json(name, {"ignoreNullFields": "false"}) if kind.startswith(("struct", "array", "map")) else F.col(name).cast("string")
    return F.coalesce(value, F.lit("NA"))


def write_tsv(df: DataFrame, path: str, computed: str | None = None, optional: tuple[str, ...] = ()) -> None:
    """Tab-separated with a header, also where there are no rows. ``optional`` columns are empty, not NA, where the flag
    column ``computed`` is false: those rows never took the path that fills them."""
    cells = [F.when(F.col(computed), cell(df, c)).otherwise("").alias(c) if computed and c in optional else cell(df, c).alias(c) for c in df.columns]
    df.select(*cells).write.option("sep", "\t").option("header", "true").option("emptyValue", "").option("quote", "").csv(path)


def write_fasta(records: DataFrame, path: str, width: int = 80) -> None:
    """records (id, seq), wrapped."""
    records.select(F.concat(F.lit(">"), "id", F.lit("\n"), F.rtrim(F.regexp_replace("seq", f"(.{{{width}}})", "$1\n"), F.lit("\n"))).alias("value")).write.text(path)


def write_bed(loci: DataFrame, path: str) -> None:
    """BED6 (starts from 0) of loci (id, seqid, strand, start1, end1), score 0."""
    loci.select(F.concat_ws("\t", "seqid", F.col("start1") - 1, "end1", "id", F.lit("0"), "strand").alias("value")).write.text(path)


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> DataFrame:
    """What ``write(folder)`` writes, published at ``path`` at once or not at all, with its manifest (see
    `readers.file_manifest`; paths are relative) in the folder ``manifest``, which is returned.

    Files are staged beside the target and renamed when all are written and hashed. A path that exists is refused, as is a
    link, even one that leads nowhere; if writing fails, the staged files go and the error is raised."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    local = urlparse(path).path if urlparse(path).scheme in ("", "file") else None

    def refuse() -> None:
        if system.exists(target) or local is not None and os.path.lexists(local):
            raise FileExistsError(f"refusing an existing path: {path}")

    refuse()
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}.staged"
    stage = spark._jvm.org.apache.hadoop.fs.Path(staged)
    try:
        write(staged)
        relative = F.regexp_replace("path", f"^.*{stage.getName()}/", "")
        file_manifest(spark, staged, allow_empty=True).withColumn("path", relative).where(~F.col("path").rlike(r"(^|/)[._]")).coalesce(1).sortWithinPartitions("path").write.json(f"{staged}/manifest")
        refuse()
        if not system.rename(stage, target):
            raise OSError(f"cannot publish {path}")
    except BaseException:
        system.delete(stage, True)
        raise
    return spark.read.schema("path string, bytes long, lines long, sha256 string, md5 string").json(f"{path}/manifest")
