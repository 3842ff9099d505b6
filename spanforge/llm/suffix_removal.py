"""Substring removal with suffix automata of reference segments.

A word goes if some window of WINDOW consecutive words over it also starts in a document with a smaller id. Whole
automata of a corpus grow with it, so they are not broadcast: reference and stream are brought together in shards.
Every window has an anchor, the least hash among its GRAM-word grams (equal windows have equal anchors); anchors met in
two documents or more are kept, and the stretch of windows around each occurrence of one is a segment. Segments of equal
words are merged, a task takes a range of anchors in ascending order of the smallest document id, builds the suffix
automaton of the segments so far and streams each segment through it: its matching statistics tell, window by window,
the first document that has it. A shard's automaton is let go once SHARD words are in it and its anchor ends. An anchor
of more than HOT segments would be one task's work: its segments are cut into single windows, which go by their own hash.

Words are compared as they are, white space being ignored. Defined cases: null and empty texts have no words; a null id
is neither smaller than another nor gets words removed; rows that share an id never remove each other's words, and each
is judged by its own text; columns beyond the id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm import words as W
from spanforge.llm.shared import join_checked, small_batches, written

WINDOW, GRAM, SHARD = 13, 5, 20_000
#: Shared anchors that are sent to every task; beyond this the segments are joined to them by shuffle.
ANCHOR_ROWS = 4_000_000
SPAN_ROWS = 500_000
#: Segments (merged within tasks) of an anchor beyond which its windows go apart.
HOT = 20_000
HELD = 100_000


class Automaton:
    """Generalised suffix automaton over words; first[state] is the document of the state's first occurrence."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.size, self.first, self.words = [-1], [0], [-1], 0

    def _state(self, size: int, first: int, steps: dict, link: int) -> int:
        self.next.append(steps)
        self.size.append(size)
        self.first.append(first)
        self.link.append(link)
        return len(self.size) - 1

    def _split(self, parent: int, word: bytes, state: int) -> int:
        twin = self._state(self.size[parent] + 1, self.first[state], dict(self.next[state]), self.link[state])
        self.link[state] = twin
        while parent >= 0 and self.next[parent].get(word) == state:
            self.next[parent][word] = twin
            parent = self.link[parent]
        return twin

    def add(self, words: list[bytes], document: int) -> None:
        last = 0
        for word in words:
            there = self.next[last].get(word)
            if there is not None:
                last = there if self.size[there] == self.size[last] + 1 else self._split(last, word, there)
                continue
            new, at = self._state(self.size[last] + 1, document, {}, 0), last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = new
                at = self.link[at]
            if at >= 0:
                there = self.next[at][word]
                self.link[new] = there if self.size[there] == self.size[at] + 1 else self._split(at, word, there)
            last = new
        self.words += len(words)

    def firsts(self, words: list[bytes], window: int) -> list[int]:
        """By window of the words, the document it first occurred in, or -1."""
        out, state, length = [], 0, 0
        for k, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            # Only the last `window` words matter from here: keep the state that stands for them.
            while state and self.size[self.link[state]] >= window:
                state = self.link[state]
            length = min(length, self.size[state])
            if k >= window - 1:
                out.append(self.first[state] if length >= window else -1)
        return out


def anchors_of(chunk: W.Chunk, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows of a document with one anchor occurrence: anchor hash, document, first and last window start (word of the chunk)."""
    starts, doc = W.gram_starts(chunk.words, window)
    empty = np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), empty, empty, empty
    grams = W.grams(chunk.hashes, GRAM)
    best, at = grams[starts].copy(), starts.copy()
    for k in range(1, window - GRAM + 1):
        other = grams[starts + k]
        less = other < best
        best[less], at[less] = other[less], starts[less] + k
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
    last = np.append(new[1:], len(starts)) - 1
    return best[new], doc[new], starts[new], starts[last]


def shared_anchors(docs: DataFrame, window: int) -> DataFrame:
    """Anchors that occur in documents of different ids."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def merged() -> Iterator[pa.RecordBatch]:
            key, who = np.concatenate(keys), np.concatenate(ids)
            order = np.lexsort((who, key))
            key, who = key[order], who[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            end = np.concatenate([key[1:] != key[:-1], [True]])
            spread = end & ~new & (who != who[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))])
            keep = np.flatnonzero(new | spread)
            for k in range(0, len(keep), 50_000):
                yield pa.record_batch({"anchor": pa.array(key[keep[k : k + 50_000]].view(np.int64)), "doc": pa.array(who[keep[k : k + 50_000]])})

        size = 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_numpy()
            for chunk in W.chunks(batch.column("text"), False):
                key, doc, _, _ = anchors_of(chunk, window)
                keys.append(key)
                ids.append(doc_ids[chunk.first + doc])
                size += len(key)
                if size > 2_000_000:
                    yield from merged()
                    keys.clear()
                    ids.clear()
                    size = 0
        if size:
            yield from merged()

    found = docs.select("doc_id", "text").mapInArrow(emit, "anchor long, doc long").groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    return found.where("low < high").select("anchor")


def segments(docs: DataFrame, window: int, anchors: np.ndarray | None) -> DataFrame:
    """Segments around anchors (all, or the sorted ones given): the words, the least id, and where in which rows they
    are. A task merges equal segments among those it holds."""
    sent = None if anchors is None else docs.sparkSession.sparkContext.broadcast(anchors)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bytes], list] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            items = list(held.items())
            held.clear()
            for k in range(0, len(items), 5_000):
                part = items[k : k + 5_000]
                yield pa.record_batch(
                    {
                        "anchor": pa.array([a for (a, _), _ in part], pa.int64()),
                        "segment": pa.array([s.decode() for (_, s), _ in part], pa.string()),
                        "low": pa.array([min(x[0] for x in rows) for _, rows in part], pa.int64()),
                        "rows": pa.array([[{"doc_id": d, "text_key": t, "at": at} for d, t, at in rows] for _, rows in part], pa.list_(pa.struct({"doc_id": pa.int64(), "text_key": pa.int64(), "at": pa.int32()}))),
                    }
                )

        size = 0
        for batch in batches:
            doc_ids, text_keys = batch.column("doc_id").to_numpy(), batch.column("text_key").to_numpy()
            for chunk in W.chunks(batch.column("text"), False):
                key, doc, first, last = anchors_of(chunk, window)
                if sent is not None and len(key):
                    known = sent.value
                    spot = np.minimum(np.searchsorted(known, key.view(np.int64)), len(known) - 1)
                    hit = known[spot] == key.view(np.int64) if len(known) else np.zeros(len(key), bool)
                    key, doc, first, last = key[hit], doc[hit], first[hit], last[hit]
                raw, starts, ends = chunk.data.tobytes(), chunk.starts, chunk.ends
                for a, d, s, e in zip(key.view(np.int64).tolist(), doc.tolist(), first.tolist(), (last + window - 1).tolist(), strict=True):
                    words = b" ".join(raw[starts[s] : ends[e]].split())
                    held.setdefault((a, words), []).append((int(doc_ids[chunk.first + d]), int(text_keys[chunk.first + d]), s - int(chunk.words[d])))
                    size += 1
                if size > HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.select("doc_id", "text_key", "text").mapInArrow(emit, "anchor long, segment string, low long, rows array<struct<doc_id:long,text_key:long,at:int>>")


def matched(found: DataFrame, window: int) -> DataFrame:
    """By segment, the first document of each of its windows, from the automaton of the segments of smaller ids."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, anchor = Automaton(), None
        for batch in batches:
            out = []
            columns = (batch.column(k).to_pylist() for k in ("anchor", "segment", "low"))
            for key, segment, low in zip(*columns, strict=True):
                if key != anchor and automaton.words >= SHARD:
                    automaton = Automaton()
                anchor = key
                words = segment.encode().split()
                firsts = automaton.firsts(words, window)
                if -1 in firsts:
                    automaton.add(words, low)
                out.append([low if x < 0 else x for x in firsts])
            if out:
                yield pa.record_batch({"anchor": batch.column("anchor"), "segment_key": batch.column("segment_key"), "firsts": pa.array(out, pa.list_(pa.int64()))})

    # One shuffle by anchor serves the merge of equal segments, the order and the shards.
    together = found.select("anchor", "segment", "low").repartition("anchor").groupBy("anchor", "segment").agg(F.min("low").alias("low"))
    ordered = together.withColumn("segment_key", F.xxhash64("segment")).sortWithinPartitions("anchor", "low", "segment")
    return ordered.mapInArrow(stream, "anchor long, segment_key long, firsts array<long>")


def spread(found: DataFrame, window: int, hot: int) -> DataFrame:
    """found, with the segments of anchors of more than ``hot`` of them cut into single windows, each under a key of its
    own. Equal windows have equal anchors, so that all of a window's occurrences are cut alike and meet under its key."""
    heavy = written(found.groupBy("anchor").count().where(F.col("count") > hot).select("anchor", F.lit(True).alias("heavy")), "heavy")
    if heavy.isEmpty():
        return found
    words = F.split("segment", " ")
    places = F.when(F.col("heavy"), F.sequence(F.lit(0), F.size(words) - window)).otherwise(F.array(F.lit(-1)))
    each = join_checked(found, heavy, "anchor", "left").select("anchor", "segment", "low", "rows", F.explode(places).alias("i"))
    cut, piece = F.col("i") >= 0, F.array_join(F.slice(words, F.col("i") + 1, window), " ")
    moved = F.transform("rows", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["text_key"].alias("text_key"), (x["at"] + F.col("i")).alias("at")))
    pick = lambda new, old: F.when(cut, new).otherwise(F.col(old)).alias(old)
    return each.select(pick(F.xxhash64("anchor", piece), "anchor"), pick(piece, "segment"), "low", pick(moved, "rows"))


def removed_spans(docs: DataFrame, window: int, hot: int = HOT) -> DataFrame:
    """doc_id, text_key and spans (flat word ranges, begin and end) that go, of rows that lose a word."""
    anchors = written(shared_anchors(docs, window), "anchors")
    fits = anchors.count() <= ANCHOR_ROWS
    found = segments(docs, window, np.sort(anchors.toArrow().column("anchor").to_numpy()) if fits else None)
    found = spread(written(found if fits else found.join(anchors, "anchor", "left_semi"), "segments"), window, hot)
    firsts = matched(found, window)
    rows = found.select("anchor", F.xxhash64("segment").alias("segment_key"), "rows").join(firsts, ["anchor", "segment_key"])
    each = rows.select("firsts", F.explode("rows").alias("row")).select("row.*", "firsts")
    # Windows that start in a smaller document, as begin and end of the words they cover.
    covered = F.filter(F.transform("firsts", lambda x, i: F.when(x < F.col("doc_id"), F.col("at") + i)), lambda x: x.isNotNull())
    ranges = each.select("doc_id", "text_key", covered.alias("at")).where(F.size("at") > 0).groupBy("doc_id", "text_key").agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("at"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for value in batch.column("at"):
                at = value.values.to_numpy()
                new = np.flatnonzero(np.concatenate([[True], at[1:] > at[:-1] + window]))
                last = np.append(new[1:], len(at)) - 1
                spans.append(np.stack([at[new], at[last] + window], axis=1).ravel())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "spans": pa.array(spans, pa.list_(pa.int32()))})

    return written(ranges.mapInArrow(merge, "doc_id long, text_key long, spans array<int>"), "spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (the words left, joined by one space) of every row."""
    keyed = docs.select("doc_id", "text").withColumn("text_key", F.crc32(F.col("text")))
    spans = removed_spans(keyed.where("doc_id is not null and text is not null"), window, hot)
    joined = join_checked(keyed, spans, ["doc_id", "text_key"], "left", SPAN_ROWS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = W.split(text.as_py())
                n.append(len(words))
                if spans.is_valid:
                    at, left = 0, []
                    ranges = spans.values.to_pylist()
                    for begin, end in zip(ranges[::2], ranges[1::2], strict=True):
                        left += words[at:begin]
                        at = end
                    words = left + words[at:]
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept_text": pa.array(kept, pa.string())})

    return joined.select("doc_id", "text", "spans").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_text string")


def op7_suffix_removal(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""WITH tokens AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, doc_id, i, array_to_string(w[i:i+12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM tokens)),
earlier AS (SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY g) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM earlier),
placed AS (SELECT r, doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM tokens),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM placed ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM tokens LEFT JOIN kept USING (r)"""
