"""Places and sizes: the folder all executors share, written tables, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest side, in rows, that `join_checked` broadcasts; beyond it the join shuffles both sides.
BROADCAST_ROWS = 2_000_000


#: Rows of an Arrow batch that Python workers are sent: texts of a few MB, also where some are very long.
ARROW_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of the session's Python stages by ARROW_ROWS, as JVM and worker hold several at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > ARROW_ROWS or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, str(ARROW_ROWS))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``; a temporary one only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="spanforge-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: a cut of lineage that outlives executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that `written` made and that no result still reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Joins with a broadcast of ``small`` (a written table) if its row count is within ``limit``, else by shuffle."""
    return big.join(F.broadcast(small) if small.count() <= limit else small, on, how)


def with_key(docs: DataFrame, *columns: str) -> DataFrame:
    """docs with row_key, a hash of these columns in which nulls count: the same on every reading, and equal for rows
    alike in all of them, which every stage judges alike. A row_key that is there already stays."""
    if "row_key" in docs.columns:
        return docs
    return docs.withColumn("row_key", F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))]))


def filesystem(path: str):
    """pyarrow's file system of a shared folder, and the path in it."""
    from pyarrow import fs

    if urlparse(path).scheme in ("", "file"):
        local = urlparse(path).path if path.startswith("file:") else path
        return fs.LocalFileSystem(), local
    return fs.FileSystem.from_uri(path)


def publish(path: str, payload: bytes) -> None:
    """Writes a file whole: under a name of its own first, so that retried or doubled tasks never mix."""
    system, target = filesystem(path)
    system.create_dir(os.path.dirname(target), recursive=True)
    own = f"{target}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(own) as out:
        out.write(payload)
    system.move(own, target)


def let(value: Column, body) -> Column:
    """body(value) with value computed once, by binding it to a lambda variable."""
    return F.transform(F.array(value), body)[0]


def crc_of_id(column: str = "doc_id") -> Column:
    """Unsigned crc32 of an id written as text; a null id counts as the empty text."""
    return F.coalesce(F.crc32(F.col(column).cast("string")), F.lit(0))
