"""Vector codes: Lloyd's iteration over parts of vectors, which moves only what changed.

A vector is cut into equal parts and each part is coded by the nearest entry of that part's codebook. Every round's
table holds each row's vector with its codes of this round and the last, so a round is one pass without a shuffle; the
entries' running integer sums and counts are kept from round to round, and only the plus and minus contributions of
parts whose entry changed are shuffled, summed a task first. A round in which no part moves is the last one needed.
Sums, floors and distances are integers, so that the result does not depend on how the rows are split.

The driver holds the codebooks and sums: parts x entries x width numbers, however many rows there are.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped, and all others coded;
components beyond +-CLAMP once scaled are held there; vectors shorter than the longest, or of a length that the parts
do not divide, end in zeros; a null id starts no entry, but is coded; rows of equal ids all count, in order of their
vectors; with fewer rows than entries the codebook is shorter; with no id at all codes and errors are null; an empty
table gives no rows. Other columns may have any name: those kept come first, and what is added replaces its namesakes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from spanforge.llm.shared import BROADCAST_ROWS, dropped, written
from spanforge.llm.vectors import integers, matrix, products, usable

PARTS, ENTRIES, ROUNDS, SCALE, CLAMP = 4, 256, 4, 1024, 1 << 26
#: A group with at least this share of the rows is joined by broadcast: there are at most so many.
HOT = 4096


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point, the first of equal ones, and its squared distance."""
    distance = (points**2).sum(axis=1)[:, None] - 2 * products(points, entries) + (entries**2).sum(axis=1)[None, :]
    best = distance.argmin(axis=1)
    return best, distance[np.arange(len(points)), best]


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    """Entries by row and part; -1 throughout where there is no code yet."""
    values = column.to_pylist()
    return np.array([[-1] * parts if x is None else list(x) for x in values], np.int64).reshape(len(values), parts)


def _assigned(state: DataFrame, books: np.ndarray, schema: StructType) -> DataFrame:
    """state (kept, vector, code) with each part's nearest entry in code, the code so far in before, and error."""
    sent = state.sparkSession.sparkContext.broadcast(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        parts, entries, width = books.shape
        for batch in batches:
            points = matrix(batch.column("vector"), parts * width)
            code, error = np.zeros((len(points), parts), np.uint8), np.zeros(len(points), np.int64)
            for p in range(parts if entries else 0):
                code[:, p], off = nearest(points[:, p * width : (p + 1) * width], books[p])
                error += off
            codes = pa.array([x.tobytes() if entries else None for x in code], pa.binary())
            errors = pa.array(error, mask=np.full(len(points), not entries))
            yield pa.RecordBatch.from_arrays([batch.column("kept"), batch.column("vector"), batch.column("code"), codes, errors], ["kept", "vector", "before", "code", "error"])

    return state.select("kept", "vector", "code").mapInArrow(assign, schema)


def _moves(state: DataFrame, parts: int, entries: int, width: int) -> DataFrame:
    """Changes of the entries' counts and sums since the codes before: part, entry, n and one sum a component."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            points, new, old = matrix(batch.column("vector"), parts * width), _codes(batch.column("code"), parts), _codes(batch.column("before"), parts)
            for p in range(parts):
                changed = np.flatnonzero(new[:, p] != old[:, p])
                part = points[changed, p * width : (p + 1) * width]
                np.add.at(sums[p], new[changed, p], part)
                np.add.at(counts[p], new[changed, p], 1)
                left = old[changed, p] >= 0
                np.subtract.at(sums[p], old[changed, p][left], part[left])
                np.subtract.at(counts[p], old[changed, p][left], 1)
        part, entry = np.nonzero((counts != 0) | (sums != 0).any(axis=2))
        columns = {"part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()), "n": pa.array(counts[part, entry])}
        yield pa.record_batch(columns | {f"s{i}": pa.array(sums[part, entry, i]) for i in range(width)})

    moved = state.where("before is null or code <> before").select("vector", "before", "code")
    fields = "part int, entry int, n long" + "".join(f", s{i} long" for i in range(width))
    return moved.mapInArrow(gather, fields).groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *(f"s{i}" for i in range(width)))])


def fit_codes(rows: DataFrame, keep: list[str], order: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """The table of keep columns with code (a byte a part) and error, and the final codebooks by part, entry, position.

    The codebooks start as the parts of the rows first by ``order``; each of ``rounds`` rounds assigns all parts and
    moves every used entry to the floor of its parts' mean; the parts are assigned once more at the end."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte a part: entries must be 1 to 256")
    kept = rows.where(usable(vector)).select(F.struct(*keep).alias("kept"), F.col(order).alias("place"), integers(vector, scale, CLAMP).alias("vector"))
    width = -(-(kept.agg(F.max(F.size("vector"))).first()[0] or 0) // parts)
    start = [r.vector for r in kept.where("place is not null").orderBy("place", "vector").select("vector").limit(entries).collect()]
    books = np.zeros((len(start), parts * width), np.int64)
    for k, x in enumerate(start):
        books[k, : len(x)] = x
    books = books.reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    sums, counts = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
    schema = kept.select("kept", "vector").schema.add("before", BinaryType()).add("code", BinaryType()).add("error", LongType())
    state, settled = written(_assigned(kept.withColumn("code", F.lit(None).cast("binary")), books, schema), "codes"), not len(start)
    for _ in range(rounds):
        moves = [] if settled else _moves(state, parts, books.shape[1], width).collect()
        if not moves:
            break
        for r in moves:
            counts[r.part, r.entry] += r.n
            sums[r.part, r.entry] += [r[f"s{i}"] for i in range(width)]
        used = counts > 0
        books = books.copy()
        books[used] = sums[used] // counts[used][:, None]
        following = written(_assigned(state, books, schema), "codes")
        dropped(state)
        state = following
    return state.select(*[F.col("kept")[c].alias(c) for c in keep if c not in ("code", "error")], "code", "error"), books


def codebooks_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_group_sum(table: DataFrame, key: str, value: str, name: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """table with the sum of value over the rows of equal key, nulls together. The sums are joined by broadcast up to
    ``limit`` keys. Beyond it, keys with a 1/HOT share of the rows, so at most HOT of them, are, and the rest shuffle."""
    mark = "_" * (1 + max(map(len, table.columns)))  # names that no column has
    own, rows, hot = mark + "key", mark + "rows", mark + "hot"
    sums = written(table.groupBy(F.col(key).alias(own)).agg(F.sum(value).alias(name), F.count("*").alias(rows)), "group-sums")
    n = sums.agg(F.count("*"), F.sum(rows)).first()
    same = F.col(key).eqNullSafe(F.col(own))
    if n[0] <= limit:
        return table.join(F.broadcast(sums.drop(rows)), same, "left").drop(own)
    large = F.col(rows) >= n[1] / HOT
    marked = table.join(F.broadcast(sums.where(large).drop(rows).withColumn(hot, F.lit(True))), same, "left").drop(own)
    few = marked.where(F.col(hot).isNull()).drop(hot, name).join(sums.where(~large).drop(rows), same, "left").drop(own)
    return marked.where(hot).drop(hot).unionByName(few)


def op11_delta_lloyd(spark, sf_dir: str) -> DataFrame:
    table, books = fit_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), ["vec_id", "label"])
    coded = with_group_sum(table, "label", "error", "label_error")
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def _round_sql(k: int) -> str:
    """SQL of round k: every part's nearest entry, then the moved codebook (entries without parts stay)."""
    return f"""
near{k} AS MATERIALIZED (SELECT r, p, x, m % 256 AS e, m // 256 AS d FROM (SELECT r, p, any_value(x) AS x,
  min(CAST(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS BIGINT) * 256 + e) AS m
  FROM parts JOIN book{k} USING (p) GROUP BY r, p)),
means{k} AS (SELECT p, e, list(CAST(floor(s / n) AS DOUBLE) ORDER BY i) AS c FROM (SELECT p, e, i, sum(y) AS s, count(*) AS n FROM
  (SELECT p, e, unnest(x) AS y, unnest(range(len(x))) AS i FROM near{k}) GROUP BY p, e, i) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN means{k} m USING (p, e)),"""


ORACLE = f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
  list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS x FROM kept, range({PARTS}) t(p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {ENTRIES}),{"".join(map(_round_sql, range(ROUNDS + 1)))}
coded AS (SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY r),
told AS (SELECT sha256(string_agg(t, ',' ORDER BY p, e)) AS h FROM (SELECT p, e, array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ',') AS t FROM book{ROUNDS}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM kept JOIN coded USING (r), told"""
