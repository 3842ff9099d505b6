"""Interval operators on 1-based closed coordinates: overlap joins, best reciprocal partners, islands.

All of them work in bins of positions, so that a sequence with most of the rows is spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Positions in a bin of a join at its lowest level, longest level (some 10**9 positions), and positions in a bin of the
#: island scan.
JOIN_BIN, LEVELS, ISLAND_BIN = 1024, 10, 65_536


def length(start: Column, end: Column) -> Column:
    return end - start + 1


def overlap_length(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Common positions of two closed intervals, 0 if none."""
    return F.greatest(F.lit(0), F.least(e1, e2) - F.greatest(s1, s2) + 1)


def _level(start: str, end: str, width: int) -> Column:
    """The level whose bins, of width * 4**level positions, are no shorter than the interval (LEVELS at most)."""
    size = F.greatest(F.lit(1.0), (F.col(end) - F.col(start) + 1) / F.lit(float(width)))
    return F.least(F.lit(LEVELS), F.ceil(F.log(size) / math.log(4))).cast("int")


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[str], names: tuple[str, str, str, str], width: int = JOIN_BIN) -> DataFrame:
    """Pairs that agree in ``on`` and overlap. names: start and end of left, start and end of right.

    An interval is at the level of its length, where it lies in two bins or three, and is looked up from there in the
    bins of the longer levels that the other side has, so that a whole chromosome takes as few rows as an exon. A pair
    meets at the level of its longer interval, in the one bin that holds its first common position, so none is repeated
    and none needs a distinct. Bins with many rows are split by Spark's skew join."""
    s1, e1, s2, e2 = names
    bins = lambda s, e, k: F.sequence(F.floor(F.col(s) / _bin_width(k, width)), F.floor(F.col(e) / _bin_width(k, width)))
    a, b = left.withColumn("_own", _level(s1, e1, width)), right.withColumn("_own", _level(s2, e2, width))
    levels = lambda df: F.broadcast(df.select(F.col("_own").alias("_level")).distinct())

    def spread(df: DataFrame, other: DataFrame, s: str, e: str, own: str, longer: str) -> DataFrame:
        """df in its own bins under one role, and under the other in those of longer levels that ``other`` has."""
        here = df.withColumns({"_level": F.col("_own"), "_role": F.lit(own)})
        if own == "r":
            # Shorter intervals alone come to it; those of its level meet it under the other role.
            here = here.join(levels(other).select(F.col("_level").alias("_least")), F.col("_least") < F.col("_own"), "left_semi")
        above = F.when(F.col("_own") < LEVELS, F.sequence(F.col("_own") + 1, F.lit(LEVELS))).otherwise(F.array().cast("array<int>"))
        far = df.withColumn("_level", F.explode(above)).join(levels(other), "_level", "left_semi").withColumn("_role", F.lit(longer))
        return here.unionByName(far).withColumn("_bin", F.explode(bins(s, e, F.col("_level")))).drop("_own")

    # left stays at its level and right comes to it (role l), or right stays and left comes to it (role r).
    there = spread(b, a, s2, e2, "r", "l").unionByName(b.withColumns({"_level": F.col("_own"), "_role": F.lit("l")}).withColumn("_bin", F.explode(bins(s2, e2, F.col("_level")))).drop("_own"))
    # The bin's places are worked out once a row: what is done for a pair, of which there are many more, is to compare.
    low = (F.col("_bin") * _bin_width(F.col("_level"), width)).cast("long")
    edged = spread(a, b, s1, e1, "l", "r").withColumns({"_low": low, "_high": low + _bin_width(F.col("_level"), width).cast("long")})
    first = F.greatest(s1, s2)
    joined = edged.join(there, [*on, "_role", "_level", "_bin"])
    meets = (F.col(s1) <= F.col(e2)) & (F.col(s2) <= F.col(e1)) & (first >= F.col("_low")) & (first < F.col("_high"))
    return joined.where(meets).drop("_role", "_level", "_bin", "_low", "_high")


def _bin_width(level: Column, width: int) -> Column:
    return F.pow(F.lit(4.0), level) * width


def overlap_counts(left: DataFrame, right: DataFrame, on: Sequence[str], names: tuple[str, str, str, str], classes: dict[str, Column], by: Sequence[str], width: int = ISLAND_BIN, alone: bool = False) -> DataFrame:
    """by (columns of right), and under the name of each class (a condition on left) the number of pairs that `overlap_join`
    would give, without making them: those of left that start up to an interval's end, less those that end before its
    start. Rows that have all but their number alike are counted first, but those of right not if each stands ``alone`` by its
    ``by``; a bin of positions takes one row from earlier ones."""
    s1, e1, s2, e2 = names
    on, by = list(on), list(by)
    told = {f"_{kind}{k}": (kind, cond) for kind in "se" for k, cond in enumerate(classes.values())}
    known = lambda df, *c: df.where(" and ".join(f"{x} is not null" for x in (*on, *c)))
    at = lambda df, place, kind: known(df, s1, e1).select(*on, place.alias("_pos"), *[(F.coalesce(cond, F.lit(False)).cast("long") if kind == x else F.lit(0).cast("long")).alias(c) for c, (x, cond) in told.items()])
    put = at(left, F.col(s1), "s").unionByName(at(left, F.col(e1) + 1, "e")).groupBy(*on, "_pos").agg(*[F.sum(c).alias(c) for c in told]).withColumns({"_q": F.lit(0), "_w": F.lit(0).cast("long")})
    ask = lambda place, sign: known(right, s2, e2).select(*on, *by, F.col(place).alias("_pos"), F.lit(sign).alias("_q"))
    asked = ask(e2, 1).unionByName(ask(s2, 2))
    asked = asked.withColumn("_w", F.lit(1).cast("long")) if alone else asked.groupBy(*on, *by, "_pos", "_q").agg(F.count("*").alias("_w"))
    rows = put.unionByName(asked, allowMissingColumns=True).withColumn("_bin", F.floor(F.col("_pos") / width))
    before = Window.partitionBy(*on).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = put.groupBy(*on, F.floor(F.col("_pos") / width).alias("_bin")).agg(*[F.sum(c).alias(c) for c in told])
    # Bins that are asked only have their place in the carry as well.
    carried = sums.unionByName(asked.select(*on, F.floor(F.col("_pos") / width).alias("_bin")).distinct(), allowMissingColumns=True).groupBy(*on, "_bin").agg(*[F.sum(c).alias(c) for c in told])
    carried = carried.select(*on, "_bin", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in told])
    inside = Window.partitionBy(*on, "_bin").orderBy("_pos", "_q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Every bin has its carry. A left join adds no filter to one side alone, so that both sides share one shuffle of the events.
    run = rows.withColumns({c: F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in told}).where("_q > 0").join(carried, [*on, "_bin"], "left")
    value = lambda k: F.when(F.col("_q") == 1, F.col(f"_s{k}") + F.col(f"_s{k}_before")).otherwise(-F.col(f"_e{k}") - F.col(f"_e{k}_before")) * F.col("_w")
    return run.groupBy(*by).agg(*[F.sum(value(k)).alias(name) for k, name in enumerate(classes)])


def best_reciprocal(hits: DataFrame, others: DataFrame, least: int = 15, share: float = 0.5, order: Column | None = None) -> DataFrame:
    """Each of hits with its best of others: at least ``least`` common positions and ``share`` of the longer of the two;
    the largest overlap wins, then the first by ``order`` (of others; its id if not given). n_compatible counts all that
    qualify. Hits without one keep nulls and 0. Columns: id, seqid, strand, start1, end1."""
    b = others.select("seqid", "strand", *[F.col(c).alias(f"other_{c}") for c in ("id", "start1", "end1")], (F.col("id") if order is None else order).alias("_order"))
    ov = overlap_length(F.col("start1"), F.col("end1"), F.col("other_start1"), F.col("other_end1"))
    longer = F.greatest(length(F.col("start1"), F.col("end1")), length(F.col("other_start1"), F.col("other_end1")))
    pairs = overlap_join(hits, b, ["seqid", "strand"], ("start1", "end1", "other_start1", "other_end1")).withColumn("overlap", ov)
    good = pairs.where((F.col("overlap") >= least) & (F.col("overlap") >= share * longer))
    best = good.groupBy("id").agg(F.min(F.struct((-F.col("overlap")).alias("o"), "_order", F.col("other_id").alias("i"))).alias("b"), F.count("*").cast("int").alias("n_compatible"))
    found = hits.join(best.select("id", F.col("b.i").alias("other_id"), (-F.col("b.o")).alias("overlap"), "n_compatible"), "id", "left")
    return found.withColumn("n_compatible", F.coalesce("n_compatible", F.lit(0)))


def unmatched(hits: DataFrame, others: DataFrame, least: int = 15, share: float = 0.5) -> DataFrame:
    """hits that no other matches by the same rule."""
    return hits.join(best_reciprocal(hits, others, least, share).where("other_id is not null").select("id"), "id", "left_anti")


def islands(hits: DataFrame, key: Sequence[str] = ("seqid", "strand"), width: int = ISLAND_BIN) -> DataFrame:
    """hits with island, the start of the maximal run of overlapping intervals that agree in ``key``.

    A bin is scanned by itself; what reaches it from earlier bins (their greatest end, their last island start) comes
    from one row a bin, so no task scans a whole sequence."""
    binned = hits.withColumn("_bin", F.floor(F.col("start1") / width))
    before = Window.partitionBy(*key).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    reach = binned.groupBy(*key, "_bin").agg(F.max("end1").alias("_end")).withColumn("_reach", F.max("_end").over(before)).drop("_end")
    inside = Window.partitionBy(*key, "_bin").orderBy("start1", "end1")
    prior = F.greatest(F.max("end1").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("_reach"))
    opened = binned.join(reach, [*key, "_bin"]).withColumn("_open", F.when(F.coalesce(F.col("start1") > prior, F.lit(True)), F.col("start1")))
    last = opened.groupBy(*key, "_bin").agg(F.max("_open").alias("_last")).withColumn("_carried", F.max("_last").over(before)).drop("_last")
    # A range frame holds ties, so equal intervals get one answer in whatever order they come.
    running = F.max("_open").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    out = opened.join(last, [*key, "_bin"]).withColumn("island", F.coalesce(running, "_carried"))
    return out.drop("_bin", "_reach", "_open", "_carried")


def known_cases(cases: DataFrame, candidates: DataFrame) -> DataFrame:
    """case_id, n_found and found (its id, if one alone) for each case (case_id, seqid, strand, start1, end1): candidates on
    its strand that overlap it."""
    c = candidates.select("seqid", "strand", F.col("id").alias("_id"), F.col("start1").alias("_s"), F.col("end1").alias("_e"))
    met = overlap_join(cases, c, ["seqid", "strand"], ("start1", "end1", "_s", "_e")).groupBy("case_id").agg(F.count("*").alias("n_found"), F.min("_id").alias("found"))
    out = cases.select("case_id").join(met, "case_id", "left")
    return out.select("case_id", F.coalesce("n_found", F.lit(0)).alias("n_found"), F.when(F.col("n_found") == 1, F.col("found")).alias("found"))


def without_seqids(rows: DataFrame, excluded: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """rows outside the excluded seqids, and how many each of these had (0 too)."""
    out = F.col("seqid").isin(list(excluded))
    counts = rows.where(out).groupBy("seqid").agg(F.count("*").alias("n"))
    named = rows.sparkSession.createDataFrame([(x,) for x in dict.fromkeys(excluded)], "seqid string")
    return rows.where(~F.coalesce(out, F.lit(False))), named.join(counts, "seqid", "left").select("seqid", F.coalesce("n", F.lit(0)).alias("n"))


def union(intervals: DataFrame, key: Sequence[str] = ("seqid",)) -> DataFrame:
    """key, start1, end1: the maximal runs of positions that intervals cover; runs that touch are one."""
    wider = intervals.select(*key, "start1", (F.col("end1") + 1).alias("end1"))
    return islands(wider, key).groupBy(*key, "island").agg((F.max("end1") - 1).alias("end1")).select(*key, F.col("island").alias("start1"), "end1")


def complement(merged: DataFrame, lengths: DataFrame, width: int = ISLAND_BIN) -> DataFrame:
    """seqid, start1, end1: the positions of each sequence (seqid, length) that no run of `union` covers. A run's
    predecessor is in its bin, or the last of an earlier one, of which one row a bin is kept."""
    ends = lengths.select("seqid", (F.col("length") + 1).cast("int").alias("start1"), (F.col("length") + 1).cast("int").alias("end1"))
    binned = merged.select("seqid", "start1", "end1").unionByName(ends).withColumn("_bin", F.floor(F.col("start1") / width))
    before = Window.partitionBy("seqid").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    reach = binned.groupBy("seqid", "_bin").agg(F.max("end1").alias("_end")).withColumn("_reach", F.max("_end").over(before)).drop("_end")
    inside = Window.partitionBy("seqid", "_bin").orderBy("start1", "end1").rowsBetween(Window.unboundedPreceding, -1)
    prior = F.coalesce(F.greatest(F.max("end1").over(inside), F.col("_reach")), F.lit(0))
    gaps = binned.join(reach, ["seqid", "_bin"]).withColumn("_prior", prior)
    return gaps.where("start1 > _prior + 1").select("seqid", (F.col("_prior") + 1).cast("int").alias("start1"), (F.col("start1") - 1).cast("int").alias("end1"))


def within(rows: DataFrame, merged: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` of the rows (seqid, start1, end1) that one run of `union` holds whole."""
    runs = merged.select("seqid", F.col("start1").alias("_s"), F.col("end1").alias("_e"))
    met = overlap_join(rows.select(key, "seqid", "start1", "end1"), runs, ["seqid"], ("start1", "end1", "_s", "_e"))
    return met.where("_s <= start1 and end1 <= _e").select(key).distinct()
