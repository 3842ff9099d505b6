"""Hard negatives by a k-nearest-neighbour join that Voronoi cells deal out.

Inner products become distances by a component added to every vector: the square root of the largest squared norm less
its own, and 0 for anchors; then d(a, x)^2 = |a|^2 + norm - 2 a.x, and nearer means a higher score. A bounded sample of
rows are the pivots. Every row goes to its nearest pivot's cell and keeps its distance to it. Anchors are grouped by
cell, near cells together, and a group knows, for each pivot, how near and far its anchors are. By the triangle
inequality that bounds the distance between a row and any anchor of a group, so a row is copied only to the groups it
might serve:

* positives: rows no farther than the group's largest bound on an anchor's k-th neighbour of its own label, which the
  rows nearest to each pivot give, by label;
* negatives: rows within the distances that the scores of the group's positives leave.

Each group meets its rows in blocks by hash, so that neither a crowded cell nor a hot label is one task's work. A block
joins exactly, in integers, and keeps its best per anchor (or per anchor and positive); the blocks' bests are ranked.

What the driver holds: PIVOTS vectors, and two numbers a group and pivot; groups number at most MAX_GROUPS and PIVOTS.

Defined cases: rows with a null label, or whose vector is null or holds null or non-finite components, take no part;
components beyond +-CLAMP once scaled are held there; shorter vectors end in zeros; a null id is no anchor and comes
after other ids in ties; rows of equal ids are rows of their own; with no anchor there are no rows. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from spanforge.llm.shared import join_checked, small_batches, written
from spanforge.llm.vectors import integers, matrix, products, squared_norm, usable

SCALE, CLAMP, PIVOTS = 256, 1 << 22, 64
#: Anchors of a group, groups at most (beyond which groups grow), rows of a block, anchors compared at once, rows sent on at once.
GROUP, MAX_GROUPS, BLOCK, STRIP, SENT = 2048, 4096, 32_768, 128, 10_000
#: Labels up to which the nearest rows of every label and cell are broadcast: some 5 kB a label.
LABELS = 5_000
#: Distances are floating-point: bounds are loosened by this share of the largest norm.
SLACK = 1e-6


class Space(NamedTuple):
    """Width of vectors, largest squared norm, and the pivots' vectors."""

    width: int
    norm: int
    pivots: np.ndarray

    def distances(self, points: np.ndarray, anchors: bool) -> np.ndarray:
        """To every pivot, with the added component."""
        square, own = (points**2).sum(axis=1), (self.pivots**2).sum(axis=1)
        height = np.zeros(len(points)) if anchors else np.sqrt(self.norm - square)
        total = square + height**2
        return np.sqrt(np.maximum(0, total[:, None] + self.norm - 2 * (products(points, self.pivots) + height[:, None] * np.sqrt(self.norm - own)[None, :])))


def _space(rows: DataFrame) -> tuple[Space, int]:
    figures = rows.agg(F.max(F.size("vector")), F.max(squared_norm("vector")), F.count("*")).first()
    width, norm, n = figures[0] or 0, figures[1] or 0, figures[2]
    sample = rows.orderBy(F.xxhash64("vec_id", "vector")).select("vector").limit(4 * PIVOTS).collect()
    unlike = list(dict.fromkeys(tuple(r.vector) + (0,) * (width - len(r.vector)) for r in sample))[:PIVOTS]
    return Space(width, norm, np.array(unlike, np.int64).reshape(len(unlike), width)), n


def _placed(rows: DataFrame, space: Space) -> DataFrame:
    """rows with a key of their own, their cell, and the distance r to its pivot."""
    sent = rows.sparkSession.sparkContext.broadcast(space)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off = sent.value.distances(matrix(batch.column("vector"), sent.value.width), False)
            cell = off.argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(off[np.arange(len(off)), cell])], [*batch.schema.names, "cell", "r"])

    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    return written(keyed.mapInArrow(place, keyed.select("*").schema.add("cell", "integer").add("r", "double")), "placed")


def _anchors(placed: DataFrame, space: Space) -> DataFrame:
    """The anchors with d, their distances to every pivot, and home, the nearest."""
    sent = placed.sparkSession.sparkContext.broadcast(space)
    chosen = placed.where("anchor").select("row", "vec_id", "label", "vector")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off = sent.value.distances(matrix(batch.column("vector"), sent.value.width), True)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(off) + 1) * off.shape[1], pa.int32()), pa.array(off.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(off.argmin(axis=1), pa.int32()), lists], [*batch.schema.names, "home", "d"])

    return chosen.mapInArrow(measure, chosen.select("*").schema.add("home", "integer").add("d", ArrayType(DoubleType())))


def _grouped(anchors: DataFrame, space: Space) -> tuple[DataFrame, int]:
    """anchors with their group, and the number of groups: near cells are packed up to GROUP anchors, larger cells cut by hash."""
    sizes = {r.home: r.n for r in anchors.groupBy("home").agg(F.count("*").alias("n")).collect()}
    size = max(GROUP, -(-sum(sizes.values()) // MAX_GROUPS))
    chain, left = [], sorted(sizes)
    while left:
        last = space.pivots[chain[-1] if chain else left[0]]
        chain.append(min(left, key=lambda c: (int(((space.pivots[c] - last) ** 2).sum()), c)))
        left.remove(chain[-1])
    first, pieces, groups, filled = {}, {}, 0, 0
    for c in chain:
        if filled and filled + sizes[c] > size:
            groups, filled = groups + 1, 0
        first[c], pieces[c] = groups, -(-sizes[c] // size)
        groups, filled = (groups + pieces[c], 0) if pieces[c] > 1 else (groups, filled + sizes[c])
    look = lambda x: F.element_at(F.create_map(*[F.lit(v) for kv in x.items() for v in kv]), F.col("home"))
    return written(anchors.withColumn("group", (look(first) + F.pmod(F.xxhash64("row"), look(pieces))).cast("int")), "anchors"), groups + bool(filled)


def _reach(placed: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """anchors with far: no anchor's k-th neighbour of its label, itself aside, is farther. Cells' nearest rows by label bound it."""
    order = Window.partitionBy("label", "cell").orderBy("r", "row")
    nearest = placed.select("label", "cell", "r", "row").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    by_label = written(nearest.groupBy(F.col("label").alias("of")).agg(F.collect_list(F.struct("cell", "r")).alias("near")), "cells")
    joined = join_checked(anchors, by_label, F.col("label") == F.col("of"), "left", LABELS)
    bounds = F.sort_array(F.transform("near", lambda x: F.get("d", x["cell"]) + x["r"]))
    return joined.select("row", "group", "d", F.lit(0.0).alias("close"), F.coalesce(F.get(bounds, F.lit(k)), F.lit(float("inf"))).alias("far"))


def _bounds(limits: DataFrame, groups: int, space: Space) -> tuple[np.ndarray, ...]:
    """Of limits (group, d, close, far): the groups' least and largest distances to each pivot, least close and largest far."""
    low, high = np.full((groups, len(space.pivots)), np.inf), np.full((groups, len(space.pivots)), -np.inf)
    close, far = np.full(groups, np.inf), np.full(groups, -np.inf)
    each = limits.select("group", "close", "far", F.posexplode("d").alias("pivot", "off"))
    for r in each.groupBy("group", "pivot").agg(F.min("off").alias("low"), F.max("off").alias("high"), F.min("close").alias("close"), F.max("far").alias("far")).toLocalIterator():
        low[r.group, r.pivot], high[r.group, r.pivot], close[r.group], far[r.group] = r.low, r.high, r.close, r.far
    slack = SLACK * (1 + space.norm**0.5)
    return low, high, close - slack, far + slack


def _routed(placed: DataFrame, bounds: tuple[np.ndarray, ...], blocks: int) -> DataFrame:
    """A copy of each row for every group that it might serve, with group and block."""
    sent = placed.sparkSession.sparkContext.broadcast(bounds)
    rows = placed.select("row", "vec_id", "label", "vector", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), "cell", "r")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high, close, far = sent.value
        for batch in batches:
            cell, r = batch.column("cell").to_numpy(), batch.column("r").to_numpy()
            serves = (np.maximum(low[:, cell] - r, r - high[:, cell]) <= far[:, None]) & (high[:, cell] + r >= close[:, None])
            group, at = np.nonzero(serves)
            for k in range(0, len(at), SENT):
                some = pa.array(at[k : k + SENT])
                out = batch.select(["row", "vec_id", "label", "vector", "block"]).take(some)
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(group[k : k + SENT], pa.int32())], [*out.schema.names, "group"])

    return rows.mapInArrow(route, rows.drop("cell", "r").schema.add("group", "integer"))


def _joined(routed: DataFrame, anchors: DataFrame, groups: int, blocks: int, join, schema: str) -> DataFrame:
    """join(rows, anchors) of every group and block."""
    session = int(routed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(session, -(-groups * blocks // 16))
    everywhere = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    deal = lambda x: x.repartition(parts, "group", "block").groupBy("group", "block")
    return deal(routed).cogroup(deal(everywhere)).applyInArrow(join, schema)


def _ordered(rows: pa.Table) -> pa.Table:
    """By id, nulls last, then by key: the order in which ties are taken."""
    return rows.take(pc.sort_indices(rows, [("vec_id", "ascending"), ("row", "ascending")], null_placement="at_end"))


def _label_codes(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    codes = pa.concat_arrays([*a.column("label").chunks, *b.column("label").chunks]).dictionary_encode().indices.to_numpy()
    return codes[: len(a)], codes[len(a) :]


def _positives_join(width: int, k: int):
    def join(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if len(rows) and len(anchors):
            rows = _ordered(rows)
            own, theirs = _label_codes(anchors, rows)
            a, x = matrix(anchors.column("vector"), width), matrix(rows.column("vector"), width)
            a_row, x_row = anchors.column("row").to_numpy(), rows.column("row").to_numpy()
            for label in np.unique(own):
                mine, same = np.flatnonzero(own == label), np.flatnonzero(theirs == label)
                for at in range(0, len(mine), STRIP):
                    some = mine[at : at + STRIP]
                    for i, scores in zip(some, products(a[some], x[same]), strict=True):
                        others = np.flatnonzero(x_row[same] != a_row[i])
                        if len(others) > k:
                            least = np.partition(scores[others], len(others) - k)[len(others) - k]
                            others = others[scores[others] >= least]
                        best = others[np.argsort(-scores[others], kind="stable")[:k]]
                        found += [(i, same[j], scores[j]) for j in best]
        i, j, score = np.array(found, np.int64).reshape(-1, 3).T
        return pa.table({"row": anchors.column("row").take(pa.array(i)), "positive_row": rows.column("row").take(pa.array(j)), "positive_id": rows.column("vec_id").take(pa.array(j)), "positive_score": pa.array(score)})

    return join


def _negatives_join(width: int, k: int, low: int, high: int):
    def join(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if len(rows) and len(anchors):
            rows = _ordered(rows)
            own, theirs = _label_codes(anchors, rows)
            a, x = matrix(anchors.column("vector"), width), matrix(rows.column("vector"), width)
            ends = anchors.column("positives").combine_chunks().offsets.to_numpy()
            flat = anchors.column("positives").combine_chunks().values.field("positive_score").to_numpy()
            for at in range(0, len(a), STRIP):
                for i, scores in enumerate(products(a[at : at + STRIP], x), at):
                    wanted = flat[ends[i] : ends[i + 1]]
                    others = np.flatnonzero((theirs != own[i]) & (100 * scores >= (low * wanted).min()) & (100 * scores <= (high * wanted).max()))
                    ordered = others[np.argsort(-scores[others], kind="stable")]
                    falling = -100 * scores[ordered]
                    for n, p in enumerate(wanted):
                        first, end = np.searchsorted(falling, -high * p, "left"), np.searchsorted(falling, -low * p, "right")
                        found += [(i, ends[i] + n, j, scores[j]) for j in ordered[first : min(end, first + k)]]
        i, n, j, score = np.array(found, np.int64).reshape(-1, 4).T
        positives = anchors.column("positives").combine_chunks()
        chosen = (positives.values if len(positives) else pa.array([], positives.type.value_type)).take(pa.array(n))
        return pa.table({"row": anchors.column("row").take(pa.array(i)), "anchor_id": anchors.column("vec_id").take(pa.array(i)), **{c: chosen.field(c) for c in ("positive_row", "positive_id", "positive_score")}, "negative_row": rows.column("row").take(pa.array(j)), "negative_id": rows.column("vec_id").take(pa.array(j)), "negative_score": pa.array(score)})

    return join


def _first(rows: DataFrame, by: list[str], score: str, ident: str, row: str, k: int) -> DataFrame:
    """The k rows of each key with the highest scores, ties by id (nulls last), then by key, with their rank."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(ident).asc_nulls_last(), row)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """For each anchor row and each of its best ``positives`` other rows of its label: the best ``negatives`` rows of
    other labels whose score is low to high per cent of the positive's. rows: vec_id (long), label, the vector."""
    spark = rows.sparkSession
    taken = rows.where(F.col("label").isNotNull() & usable(vector)).select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.coalesce(anchor & F.col("vec_id").isNotNull(), F.lit(False)).alias("anchor"), integers(vector, scale, CLAMP).alias("vector"))
    space, n = _space(taken)
    if not n:
        return spark.createDataFrame([], RESULT)
    placed = _placed(taken, space)
    anchors, groups = _grouped(_anchors(placed, space), space)
    if not groups:
        return spark.createDataFrame([], RESULT)
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BLOCK))
    routed = _routed(placed, _bounds(_reach(placed, anchors, positives), groups, space), blocks)
    sides = anchors.select("row", "vec_id", "label", "vector", "group")
    near = _joined(routed, sides, groups, blocks, _positives_join(space.width, positives), "row long, positive_row long, positive_id long, positive_score long")
    best = _first(near, ["row"], "positive_score", "positive_id", "positive_row", positives)
    open_ = best.where(low * F.col("positive_score") <= high * F.col("positive_score"))
    lists = written(open_.groupBy("row").agg(F.collect_list(F.struct("positive_row", "positive_id", "positive_score")).alias("positives")), "positives")
    scores = F.transform("positives", lambda x: x["positive_score"])
    off = lambda score: F.sqrt(F.greatest(F.lit(0.0), squared_norm("vector") + F.lit(space.norm) - 2 * score / 100))
    served = written(join_checked(anchors, lists, "row").withColumns({"close": off(high * F.array_max(scores)), "far": off(low * F.array_min(scores))}), "served")
    routed = _routed(placed, _bounds(served, groups, space), blocks)
    schema = "row long, anchor_id long, positive_row long, positive_id long, positive_score long, negative_row long, negative_id long, negative_score long"
    far = _joined(routed, served.select("row", "vec_id", "label", "vector", "group", "positives"), groups, blocks, _negatives_join(space.width, negatives, low, high), schema)
    return _first(far, ["row", "positive_row"], "negative_score", "negative_id", "negative_row", negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_voronoi_negatives(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLE = f"""WITH kept AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (SELECT a.vec_id AS anchor_id, x.vec_id AS other, a.label = x.label AS alike, CAST(list_dot_product(a.v, x.v) AS BIGINT) AS score
  FROM kept a JOIN kept x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id) WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 5"""
