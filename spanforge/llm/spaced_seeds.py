"""Benchmark decontamination with spaced seeds: masks that ignore some positions find windows alike but for
substitutions; overlaps are then verified word by word along the hit's diagonal.

Words are lower-cased (A-Z) runs without white space. A document and an item overlap where a mask's kept words agree
on a diagonal and some window of ``window`` words of that diagonal (or the whole item, if shorter) agrees in at least
``share`` of its words. The masks are lossless for that rule: wherever the allowed substitutions fall in a window, some
mask has a place in it that keeps none of them. The seeds of the benchmark go to every task in blocks of at most about
``seed_rows``; each block is one more scan of the documents.

Defined cases: null and empty texts hit nothing; items shorter than the window are compared whole, by masks of their own
length; items without words never hit; equal items hit one by one, with an id or without; repeated document rows count
one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm import words as W
from spanforge.llm.shared import small_batches, with_key

#: Kept positions are 1. These two are lossless for 2 substitutions in 13 words.
MASKS = ("11110011", "11010111")
WINDOW, SHARE = 13, 0.8
SEED_ROWS = 4_000_000


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of a mask's kept words from each position."""
    size = len(hashes) - len(mask) + 1
    out = np.full(max(size, 0), len(mask), np.uint64) * W._C ^ np.uint64(int(mask, 2) % (1 << 64))
    for k in (k for k, bit in enumerate(mask) if bit == "1"):
        out = (out ^ (out >> np.uint64(29))) * W._A + hashes[k : k + max(size, 0)] * W._B
    return W.mix(out)


def allowed(window: int, share: float) -> int:
    """Most substitutions that leave a window's words alike in at least ``share``."""
    if share <= 0:
        raise ValueError("share must be above 0")
    return window - next((n for n in range(window + 1) if n >= share * window), window + 1)


def lossless(masks: tuple[str, ...], window: int, most: int) -> bool:
    """No ``most`` substitutions in the window spoil every mask at every place."""
    kept = [{at + k for k, bit in enumerate(mask) if bit == "1"} for mask in masks for at in range(window - len(mask) + 1)]
    return all(any(not places & set(bad) for places in kept) for bad in combinations(range(window), most))


def whole_masks(window: int, most: int) -> tuple[str, ...]:
    """Lossless masks as long as the window: its places are dealt into groups, and each mask leaves out ``most`` of them."""
    groups = min(most + 2, window)
    return tuple("".join("0" if k % groups in out else "1" for k in range(window)) for out in combinations(range(groups), most))


def masks_for(window: int, share: float) -> tuple[str, ...]:
    """Lossless masks of a window; none where no number of words alike is enough."""
    most = allowed(window, share)
    if most < 0:
        return ()
    return MASKS if comb(window, most) <= 10_000 and lossless(MASKS, window, most) and window >= WINDOW else whole_masks(window, most)


class Items:
    """Seeds of the benchmark, sorted, with their items and places; and the items' word hashes."""

    def __init__(self, rows: list[tuple[int, str | None]], window: int = WINDOW, share: float = SHARE) -> None:
        self.ids = [x for x, _ in rows]
        chunk_list = list(W.chunks(pa.array([t for _, t in rows], pa.string()), True, 1 << 40))
        self.hashes = chunk_list[0].hashes if chunk_list else np.zeros(0, np.uint64)
        self.words = chunk_list[0].words if chunk_list else np.zeros(1, np.int64)
        keys, item, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        counts = np.diff(self.words)
        # Items as long as the window or longer share its masks, shorter ones have those of their own length.
        length = np.minimum(counts, window)
        wanted = [(int(n), mask) for n in np.unique(length[length > 0]) for mask in masks_for(int(n), share)]
        self.masks = list(dict.fromkeys(mask for _, mask in wanted))
        for n, mask in wanted:
            starts, doc = W.gram_starts(self.words, len(mask))
            own = length[doc] == n
            starts, doc = starts[own], doc[own]
            keys.append(seeds(self.hashes, mask)[starts] if len(starts) else np.zeros(0, np.uint64))
            item.append(doc)
            place.append(starts - self.words[doc])
        key = np.concatenate(keys)
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.place = key[order], np.concatenate(item)[order], np.concatenate(place)[order]
        self.bits = 24
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.key >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, chunk: W.Chunk) -> np.ndarray:
        """Distinct (document, item, diagonal) with a common seed."""
        found = []
        for mask in self.masks:
            starts, doc = W.gram_starts(chunk.words, len(mask))
            if not len(starts):
                continue
            key = seeds(chunk.hashes, mask)[starts]
            may = np.flatnonzero(self.seen[(key >> np.uint64(64 - self.bits)).astype(np.int64)])
            low, high = np.searchsorted(self.key, key[may], "left"), np.searchsorted(self.key, key[may], "right")
            may, low, n = may[high > low], low[high > low], (high - low)[high > low]
            if len(may):
                at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                which = np.repeat(may, n)
                found.append(np.stack([doc[which], self.item[at], starts[which] - chunk.words[doc[which]] - self.place[at]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def verify(self, chunk: W.Chunk, doc: int, item: int, shift: int, window: int, share: float) -> tuple[int, int, int] | None:
        """Words alike in the best window of the diagonal, that window's size and its start in the document."""
        own = self.hashes[self.words[item] : self.words[item + 1]]
        text = chunk.hashes[chunk.words[doc] : chunk.words[doc + 1]]
        low, high = max(0, -shift), min(len(own), len(text) - shift)
        window = min(window, len(own))
        if high - low < window:
            return None
        alike = np.concatenate([[0], np.cumsum(own[low:high] == text[low + shift : high + shift])])
        sums = alike[window:] - alike[:-window]
        best = int(np.argmax(sums))
        return (int(sums[best]), window, low + shift + best) if sums[best] >= share * window else None


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE, seed_rows: int = SEED_ROWS) -> DataFrame:
    """One row per document row and item that overlap: doc_id, item_id, words_alike, window_words, start (word) of the
    best window. A benchmark beyond ``seed_rows`` seeds is taken in blocks of that size, dealt by hash, with a scan of the
    documents for each, so no task ever holds more than one block."""
    spark = docs.sparkSession
    sized = benchmark.select("item_id", "text").withColumn("_w", F.octet_length(F.coalesce("text", F.lit(""))))
    total = sized.agg(F.coalesce(F.sum("_w"), F.lit(0))).first()[0]
    blocks = 1 + int(total * max(1, len(masks_for(window, share))) // (2 * seed_rows))
    out = None
    for block in range(blocks):
        part = benchmark.select("item_id", "text") if blocks == 1 else benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("item_id", "text")
        # Bounded: a block holds about seed_rows seeds at most.
        rows = sorted(((r.item_id, r.text) for r in part.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        sent = spark.sparkContext.broadcast(rows)
        found = docs.select("doc_id", "text").mapInArrow(_finder(sent, window, share), "doc_id long, item_id long, words_alike int, window_words int, start int")
        out = found if out is None else out.unionByName(found)
    return out


def _finder(sent, window: int, share: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(sent.value, window, share)
        for batch in batches:
            keys = batch.column("doc_id")
            for chunk in W.chunks(batch.column("text"), True):
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for doc, item, shift in items.hits(chunk).tolist():
                    got = items.verify(chunk, doc, item, shift, window, share)
                    if got and ((doc, item) not in best or (got[0], -got[2]) > (best[doc, item][0], -best[doc, item][2])):
                        best[doc, item] = got
                if best:
                    pairs = list(best)
                    yield pa.record_batch(
                        {
                            "doc_id": keys.take(pa.array([chunk.first + d for d, _ in pairs])),
                            "item_id": pa.array([items.ids[i] for _, i in pairs], pa.int64()),
                            **{name: pa.array([best[p][k] for p in pairs], pa.int32()) for k, name in enumerate(("words_alike", "window_words", "start"))},
                        }
                    )

    return find


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the rows that overlap any item, each judged by its own text, with or without an id."""
    keyed = with_key(docs, "doc_id", "text")
    hit = contaminated(keyed.select(F.col("row_key").alias("doc_id"), "text"), benchmark, **options).select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(hit, "row_key", "left_anti").select(*docs.columns)


def op6_spaced_seeds(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_LOWER_SQL = "list_transform(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w"

#: Without seeds: every diagonal on which enough single words agree, then its windows.
ORACLE = f"""WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, {_LOWER_SQL} FROM documents), items AS MATERIALIZED (SELECT row_number() OVER () AS t, item_id, {_LOWER_SQL} FROM benchmark),
said AS (SELECT d, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs), asked AS (SELECT t, least({WINDOW}, len(w)) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM items),
diagonals AS (SELECT d, t, i - p AS shift, any_value(n) AS n FROM said JOIN asked USING (word) GROUP BY d, t, i - p HAVING count(*) >= {SHARE} * any_value(n)),
placed AS (SELECT d, t, shift, n, docs.w AS dw, items.w AS tw, greatest(1, 1 - shift) AS low, least(len(items.w), len(docs.w) - shift) AS high FROM diagonals JOIN docs USING (d) JOIN items USING (t)),
alike AS (SELECT d, t, shift, n, p, high, CAST(dw[p + shift] = tw[p] AS INT) AS same FROM (SELECT *, unnest(range(low, high + 1)) AS p FROM placed)),
sums AS (SELECT *, sum(same) OVER (PARTITION BY d, t, shift ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS s FROM alike),
windows AS (SELECT * FROM sums WHERE p + n - 1 <= high AND s >= {SHARE} * n),
best AS (SELECT * FROM windows QUALIFY row_number() OVER (PARTITION BY d, t ORDER BY s DESC, p + shift) = 1)
SELECT doc_id, item_id, s AS words_alike, n AS window_words, p + shift - 1 AS start FROM best JOIN docs USING (d) JOIN items USING (t)"""
