"""Searches by seeds: words that sequences share, and hits extended from them."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from spanforge.functions.sequence import reverse_complement

#: Letters of text from which words are taken at once: few, as a substring at a place walks there from the start.
PIECE = 256
#: Bases as numbers, other letters below 0; rows in a batch of pairs; pairs that are aligned at once, and letters of their queries,
#: or of subjects whose seeds are extended at once.
BASES = np.full(256, -1, np.int64)
BASES[list(b"ACGT")] = range(4)
ROWS, PAIRS, LETTERS = 50_000, 1024, 500_000


def words(sequences: DataFrame, size: int) -> DataFrame:
    """The other columns with word and at (from 1), for every place of a word without ambiguous letters."""
    rest = [c for c in sequences.columns if c != "seq"]
    # Cut once, each piece with the first letters of the next.
    cut = sequences.select(*rest, F.regexp_extract_all("seq", F.lit(f".{{1,{PIECE}}}"), F.lit(0)).alias("_cut"))
    joined = lambda x, k: F.struct((k * PIECE).alias("first"), F.concat(x, F.coalesce(F.substring(F.get("_cut", k + 1), 1, size - 1), F.lit(""))).alias("part"))
    pieces = cut.select(*rest, F.explode(F.transform("_cut", joined)).alias("p"))
    starts = F.when(F.length("p.part") >= size, F.sequence(F.lit(1), F.length("p.part") - size + 1)).otherwise(F.array().cast("array<int>"))
    placed = pieces.select(*rest, "p.first", F.explode(F.transform(starts, lambda k: F.struct(k.alias("k"), F.substring(F.col("p.part"), k, F.lit(size)).alias("word")))).alias("w"))
    return placed.select(*rest, F.col("w.word").alias("word"), (F.col("first") + F.col("w.k")).alias("at")).where(F.length(F.translate("word", "ACGT", "")) == 0)


def placed(seq: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The words of ``size`` bases without ambiguous letters, as numbers (as bytes where these are too long), and their places
    from 1."""
    raw = np.frombuffer(seq, np.uint8)
    raw = raw[raw & 0xC0 != 0x80]  # a letter of several bytes is one place
    base = BASES[raw]
    if len(base) < size:
        return np.zeros(0, np.int64 if size <= 31 else f"S{size}"), np.zeros(0, np.int64)
    bad = np.concatenate([[0], np.cumsum(base < 0)])
    good = bad[size:] == bad[:-size]
    if size > 31:
        return np.lib.stride_tricks.sliding_window_view(raw.view("S1"), size)[good].view(f"S{size}").ravel(), np.flatnonzero(good) + 1
    code = np.zeros(len(good), np.int64)
    for k in range(size):
        code = code * 4 + base[k : k + len(good)]
    return code[good], np.flatnonzero(good) + 1


def codes(seq: bytes, size: int) -> np.ndarray:
    """The distinct words."""
    code, _ = placed(seq, size)
    if size > 8:
        return np.unique(code)
    seen = np.zeros(4**size, bool)
    seen[code] = True
    return np.flatnonzero(seen)


class _Index:
    """The queries of every word, one list after the other."""

    def __init__(self, own: dict) -> None:
        self.names = list(own)
        words = [np.unique(np.concatenate(x)) for x in own.values()]
        each, item = np.concatenate(words), np.repeat(np.arange(len(words)), list(map(len, words)))
        order = np.argsort(each, kind="stable")
        self.known, first = np.unique(each[order], return_index=True)
        self.first, self.item = np.append(first, len(each)), item[order]

    def counts(self, found: np.ndarray) -> np.ndarray:
        """By query, the words that are among these distinct ones."""
        at = np.searchsorted(self.known, found)
        found, at = found[at < len(self.known)], at[at < len(self.known)]
        at = at[self.known[at] == found]
        many = self.first[at + 1] - self.first[at]
        place = np.repeat(self.first[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.bincount(self.item[place], minlength=len(self.names))


def _dealt(subjects: DataFrame, queries: DataFrame) -> DataFrame:
    """side, id, item_id and seq: subjects (side 1) by id in the shuffle's partitions, all queries (side 0) before them in each."""
    n = int(subjects.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids, items = subjects.schema["id"].dataType, queries.schema["item_id"].dataType
    every = queries.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part"), F.lit(0).alias("side"), F.lit(None).cast(ids).alias("id"), "item_id", "seq")
    dealt = subjects.select(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("part"), F.lit(1).alias("side"), "id", F.lit(None).cast(items).alias("item_id"), "seq")
    return every.unionByName(dealt).where("seq is not null").repartitionById(n, "part").sortWithinPartitions("side", "id").select("side", "id", "item_id", "seq")


def shared_words(subjects: DataFrame, queries: DataFrame, size: int) -> DataFrame:
    """id, item_id and n_words, the distinct words that a subject (id, seq) and a query (item_id, seq) share.

    Subjects are dealt by id over the shuffle's partitions, and the queries, which are few beside them, come to each of these
    first. A task holds the queries' words and counts a subject at a time, so that neither words nor met words are rows."""
    ids, items = subjects.schema["id"].dataType, queries.schema["item_id"].dataType
    met = _dealt(subjects, queries)
    schema = StructType([StructField("id", ids), StructField("item_id", items), StructField("n_words", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                kinds.update(id=batch.schema.field("id").type, item_id=batch.schema.field("item_id").type)
                for side, key, item, seq in zip(*[batch.column(c).to_pylist() for c in ("side", "id", "item_id")], batch.column("seq"), strict=True):
                    yield (side, key), item, codes(seq.as_buffer(), size)

        def packed() -> pa.RecordBatch:
            key = pa.array(keys, kinds["id"]).take(pa.array(np.repeat(np.arange(len(keys)), list(map(len, found)))))
            item = pa.array(index.names, kinds["item_id"]).take(pa.array(np.concatenate(found)))
            return pa.record_batch({"id": key, "item_id": item, "n_words": pa.array(np.concatenate(shared))})

        kinds, index, keys, found, shared, held = {}, None, [], [], [], 0
        for (side, key), group in groupby(rows(), lambda x: x[0]):
            if side == 0:
                own: dict = {}
                for _, item, words_of in group:
                    own.setdefault(item, []).append(words_of)
                index = _Index(own)
            elif index:
                each = [x[2] for x in group]
                counts = index.counts(each[0] if len(each) == 1 else np.unique(np.concatenate(each)))
                keys.append(key)
                found.append(np.flatnonzero(counts))
                shared.append(counts[found[-1]])
                held += len(found[-1])
                if held >= ROWS:
                    yield packed()
                    keys, found, shared, held = [], [], [], 0
        if held:
            yield packed()

    return met.mapInArrow(count, schema)


@dataclass(frozen=True)
class Scoring:
    """Scores of a nucleotide search (fixed values): a gap of n letters costs gap_open + n * gap_extend; lambda_ and k turn
    scores into bits. drop ends an ungapped extension, opens is the ungapped score that calls for gaps, band the gaps' reach
    about a diagonal, least the score of a hit."""

    match: int = 1
    mismatch: int = -3
    gap_open: int = 5
    gap_extend: int = 2
    lambda_: float = 1.374
    k: float = 0.711
    drop: int = 10
    opens: int = 14
    band: int = 8
    least: int = 18


def _seeds(batches: Iterator[pa.RecordBatch], size: int, most: int) -> Iterator[tuple]:
    """By subject of a task of `_dealt`: its batch and row, the queries (item_id and seq), and of its seeds the query's place among
    these, the diagonal and q_at. Texts of one repeated word have very many seeds: they are given in parts of about ``most``."""
    queries, own, index = [], [], None
    for batch in batches:
        named = batch.column("item_id")
        for k, (side, seq) in enumerate(zip(batch.column("side").to_pylist(), batch.column("seq"), strict=True)):
            code, at = placed(seq.as_buffer(), size)
            if side == 0:
                queries.append((named[k].as_py(), seq.as_py()))
                own.append((code, at))
                continue
            if not own:
                return
            if index is None:
                each = np.concatenate([x for x, _ in own])
                order = np.argsort(each, kind="stable")
                known, first = np.unique(each[order], return_index=True)
                item, q_at = np.repeat(np.arange(len(own)), [len(x) for x, _ in own])[order], np.concatenate([x for _, x in own])[order]
                index = known, np.append(first, len(each)), item, q_at
            known, first, item, q_at = index
            where = np.searchsorted(known, code)
            inside = where < len(known)
            code, at, where = code[inside], at[inside], where[inside]
            met = known[where] == code
            at, where = at[met], where[met]
            many = first[where + 1] - first[where]
            cuts = np.unique([0, *(np.flatnonzero(np.diff(np.cumsum(many) // most)) + 1), len(at)])
            for x, y in zip(cuts, cuts[1:], strict=False):
                n = many[x:y]
                place = np.repeat(first[where[x:y]] - np.cumsum(n) + n, n) + np.arange(n.sum())
                yield batch, k, queries, item[place], np.repeat(at[x:y], n) - q_at[place], q_at[place]


def seed_places(subjects: DataFrame, queries: DataFrame, size: int) -> DataFrame:
    """id, item_id, diagonal (place in the subject less place in the query) and q_at of every seed, a word of ``size`` bases
    that both have. Tasks hold the queries' words, so that of a subject's words only seeds are rows."""
    ids, items = subjects.schema["id"].dataType, queries.schema["item_id"].dataType
    schema = StructType([StructField("id", ids), StructField("item_id", items), StructField("diagonal", IntegerType()), StructField("q_at", IntegerType())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, k, named, item, diagonal, q_at in _seeds(batches, size, ROWS):
            found = pa.array([x for x, _ in named], batch.schema.field("item_id").type).take(pa.array(item))
            yield pa.record_batch({"id": batch.column("id").take(pa.array(np.full(len(item), k))), "item_id": found, "diagonal": pa.array(diagonal, pa.int64()).cast(pa.int32()), "q_at": pa.array(q_at, pa.int64()).cast(pa.int32())})

    return _dealt(subjects, queries).mapInArrow(meet, schema)


def seed_runs(subjects: DataFrame, queries: DataFrame, size: int) -> DataFrame:
    """id, item_id, diagonal, q_from and q_to of every maximal run of seeds on a diagonal. A run is bounded by its query."""
    by = seed_places(subjects, queries, size).groupBy("id", "item_id", "diagonal").agg(F.array_sort(F.collect_set("q_at")).alias("starts"))
    # A run opens where the word before is no neighbour, and ends where the word after is none.
    opens = F.filter("starts", lambda x, i: (i == 0) | (x - F.coalesce(F.get("starts", i - 1), x) > 1))
    ends = F.filter("starts", lambda x, i: (i == F.size("starts") - 1) | (F.coalesce(F.get("starts", i + 1), x) - x > 1))
    runs = F.transform(F.arrays_zip(opens.alias("a"), ends.alias("b")), lambda r: F.struct(r["a"].cast("int").alias("q_from"), (r["b"] + size - 1).cast("int").alias("q_to")))
    return by.select("id", "item_id", "diagonal", F.inline(runs))


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All letters, one text after the other, as numbers above 0, with the first place and the length of each text."""
    sizes = np.array(list(map(len, texts)), np.int64)
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32) + 1, np.cumsum(sizes) - sizes, sizes


AMBIGUOUS = ord("N") + 1


def _reach(q: np.ndarray, s: np.ndarray, q_at: np.ndarray, s_at: np.ndarray, room: np.ndarray, step: int, scoring: Scoring) -> np.ndarray:
    """The best scores of ungapped extensions from places (not counted) in a direction, ended where they have dropped too far."""
    best, now = np.zeros(len(room), np.int64), np.zeros(len(room), np.int64)
    live, n = np.flatnonzero(room > 0), 0
    while len(live):
        n += 1
        a = q[q_at[live] + n * step]
        now[live] += np.where((a == s[s_at[live] + n * step]) & (a != AMBIGUOUS), scoring.match, scoring.mismatch)
        live = live[now[live] >= best[live] - scoring.drop]
        best[live] = np.maximum(best[live], now[live])
        live = live[room[live] > n]
    return best


def banded(q: np.ndarray, s: np.ndarray, scoring: Scoring) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The best local alignments with affine gaps within the band, of many pairs at once, a row of all their bands a step. q: queries, a
    row each, filled up with 0; s: the letters about their diagonals, where a query's letter i has those of i to i + 2 * band
    (0: outside). Scores, ends (row from 0 and place in the band) and steps; the first end in order of query and subject wins
    among equal scores. A step is 0 (none), 1 (both), 2 (a gap in q) or 3 (in s), with 4 and 8 where a gap in q or s opens."""
    worst, width, cost = -(1 << 29), 2 * scoring.band + 1, scoring.gap_open + scoring.gap_extend
    many, ramp = len(q), (np.arange(width) * scoring.gap_extend).astype(np.int32)
    # One place more than the band, outside.
    h, f = np.full((many, width + 1), worst, np.int32), np.full((many, width + 1), worst, np.int32)
    e = np.empty((many, width), np.int32)
    steps = np.empty((q.shape[1], many, width), np.uint8)
    score, row, place = np.zeros(many, np.int32), np.zeros(many, np.int64), np.zeros(many, np.int64)
    for i in range(q.shape[1]):
        a, b = q[:, i : i + 1], s[:, i : i + width]
        there = (a > 0) & (b > 0)
        up, further = h[:, 1:] - cost, f[:, 1:] - scoring.gap_extend
        f_open, gap = up >= further, np.maximum(up, further)
        both = np.maximum(h[:, :-1], 0) + np.where((a == b) & (a != AMBIGUOUS), scoring.match, scoring.mismatch).astype(np.int32)
        value = np.where(there, np.maximum(np.maximum(both, gap), 0), worst)
        # A gap in q opens at the best of all places before: one that opens where another ends is none better.
        e[:, 0] = worst
        e[:, 1:] = (np.maximum.accumulate(value + ramp, axis=1) - ramp - cost)[:, :-1]
        value = np.where(there, np.maximum(value, e), worst)
        e_open = np.ones((many, width), bool)
        e_open[:, 1:] = value[:, :-1] - cost >= e[:, :-1] - scoring.gap_extend
        kind = np.where(value <= 0, 0, np.where(value == both, 1, np.where(value == e, 2, 3)))
        steps[i] = np.where(there, kind + 4 * e_open + 8 * f_open, 12)
        h[:, :-1], f[:, :-1] = value, np.where(there, gap, worst)
        first = value.argmax(axis=1)
        top = value[np.arange(many), first]
        better = top > score
        score[better], row[better], place[better] = top[better], i, first[better]
    return score, row, place, steps


def traced(q: str, s: str, row: int, at: int, place: int, steps: np.ndarray) -> tuple[int, int, str, str]:
    """First letters (from 0) and aligned strings of the alignment of q and s that ends in letter ``row`` of q, ``at`` of s."""
    width, known, state, x, y = steps.shape[1], steps.tobytes(), 0, [], []
    while True:
        step = known[row * width + place] if row >= 0 and 0 <= place < width else 12
        kind = state or step & 3
        if not kind:
            return row + 1, at + 1, "".join(reversed(x)), "".join(reversed(y))
        x.append("-" if kind == 2 else q[row])
        y.append("-" if kind == 3 else s[at])
        state = 0 if kind == 1 or step & (4 if kind == 2 else 8) else kind
        row, at, place = row - (kind != 2), at - (kind != 3), place + (kind == 3) - (kind == 2)


HIT = "query string, seqid string, pident double, alignment_length int, mismatch int, gapopen int, qstart int, qend int, start1 int, end1 int, strand string, score int, bitscore double, qlen int, subject_length int, qcov_exact double, qseq string, sseq string"


def _extended(held: list[tuple], q: np.ndarray, q_first: np.ndarray, q_size: np.ndarray, size: int, scoring: Scoring, pairs: int, letters: int) -> Iterator[tuple]:
    """Place in held and among queries, score, ends and steps of the alignments that seeds call for. held: text, query, diagonal and
    q_at of the seeds of subjects. q: letters of the queries. pairs: aligned at once; letters: of their queries."""
    s, s_first, s_size = _letters([x[0] for x in held])
    sub = np.repeat(np.arange(len(held)), [len(x[1]) for x in held])
    item, diagonal, q_at = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
    order = np.lexsort((q_at, diagonal, item, sub))
    sub, item, diagonal, q_at = sub[order], item[order], diagonal[order], q_at[order]
    # A run opens where the word before is no neighbour. One that is cut between parts is as good: what it lacks is extended.
    same = np.append(False, (sub[1:] == sub[:-1]) & (item[1:] == item[:-1]) & (diagonal[1:] == diagonal[:-1]))
    opens = np.flatnonzero(~(same & np.append(False, np.diff(q_at) == 1)))
    start, end = q_at[opens], q_at[np.append(opens[1:], len(q_at)) - 1] + size - 1
    sub, item, diagonal = sub[opens], item[opens], diagonal[opens]
    place = lambda p: (q_first[item] + p - 1, s_first[sub] + p + diagonal - 1)
    right = _reach(q, s, *place(end), np.minimum(q_size[item], s_size[sub] - diagonal) - end, 1, scoring)
    left = _reach(q, s, *place(start), np.minimum(start, start + diagonal) - 1, -1, scoring)
    good = (end - start + 1) * scoring.match + right + left >= scoring.opens
    found = np.unique(np.stack([q_size[item], item, sub, diagonal])[:, good], axis=1)[1:]
    # Queries of like length come together; what is held of their bands is bounded.
    at, band = 0, scoring.band
    while at < found.shape[1]:
        many = 1
        while many < pairs and at + many < found.shape[1] and (many + 1) * q_size[found[0, at + many]] <= letters:
            many += 1
        item, sub, diagonal = found[:, at : at + many]
        at += many
        longest = q_size[item].max()
        i, j = np.arange(longest), np.arange(longest + 2 * band) + (diagonal - band)[:, None]
        queries = np.where(i < q_size[item][:, None], q[np.minimum(q_first[item][:, None] + i, len(q) - 1)], 0)
        about = np.where((j >= 0) & (j < s_size[sub][:, None]), s[np.clip(s_first[sub][:, None] + j, 0, len(s) - 1)], 0)
        score, row, end, steps = banded(queries, about, scoring)
        for k in np.flatnonzero(score >= scoring.least):
            yield int(sub[k]), int(item[k]), int(score[k]), int(row[k]), int(row[k] + end[k] + diagonal[k] - band), int(end[k]), steps[:, k]


def extended_hits(subjects: DataFrame, queries: DataFrame, size: int = 11, scoring: Scoring = Scoring()) -> DataFrame:
    """Hits of queries (item_id, seq) on both strands of subjects (id, seq): seeds chained by diagonal, extended without gaps
    until they drop, and, if they reach ``scoring.opens``, aligned with gaps in a band about their diagonal. One row for
    each alignment found, with the columns of tabular hits; it holds the best of its band, so a pair has as many hits as
    bands with seeds. Minus hits are of the reversed query; their aligned strings run along the subject.

    The task that finds a subject's seeds has its text and the queries': seeds are extended and aligned there, many at once, and
    neither they nor texts are shuffled again."""
    both = queries.select(F.concat(F.lit("+"), F.col("item_id").cast("string")).alias("item_id"), "seq").unionByName(queries.select(F.concat(F.lit("-"), F.col("item_id").cast("string")).alias("item_id"), reverse_complement(F.col("seq")).alias("seq")))
    named = subjects.select(F.col("id").cast("string").alias("id"), "seq")
    schema = pa.schema([(x.split()[0], {"string": pa.string(), "double": pa.float64(), "int": pa.int32()}[x.split()[1]]) for x in HIT.split(", ")])

    def told(found: list[tuple], held: list[tuple], names: list[str], queries: list[tuple]) -> pa.RecordBatch:
        rows = []
        for sub, item, score, row, at, place, steps in found:
            (key, query), (text, *_) = queries[item], held[sub]
            first, start, q, s = traced(query, text, row, at, place, steps)
            letters, gaps, n = len(q) - q.count("-"), q.count("-") + s.count("-"), len(query)
            same = sum(a == b for a, b in zip(q, s, strict=True))
            opened = sum(len([g for g in re.split("[^-]+", t) if g]) for t in (q, s))
            qstart = first + 1 if key[0] == "+" else n - (first + letters) + 1
            rows.append((key[1:], names[sub], 100 * same / len(q), len(q), len(q) - same - gaps, opened, qstart, qstart + letters - 1, start + 1, start + len(s) - s.count("-"), key[0], score, (scoring.lambda_ * score - math.log(scoring.k)) / math.log(2), n, len(text), 100 * letters / n, q, s))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held, names, n_seeds, n_letters = None, [], [], 0, 0

        def done() -> Iterator[pa.RecordBatch]:
            extended = _extended(held, *known, size, scoring, PAIRS, LETTERS)
            while part := list(islice(extended, PAIRS)):
                yield told(part, held, names, queries)

        for batch, k, queries, item, diagonal, q_at in _seeds(batches, size, ROWS):
            known = known or _letters([x for _, x in queries])
            held.append((batch.column("seq")[k].as_py(), item, diagonal, q_at))
            names.append(batch.column("id")[k].as_py())
            n_seeds, n_letters = n_seeds + len(item), n_letters + len(held[-1][0])
            if n_seeds >= ROWS or n_letters >= LETTERS:
                yield from done()
                held, names, n_seeds, n_letters = [], [], 0, 0
        if held:
            yield from done()

    return _dealt(named.where("id is not null"), both.where("item_id is not null")).mapInArrow(align, HIT).distinct()
