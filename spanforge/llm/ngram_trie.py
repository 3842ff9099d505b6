"""Language-model scoring with an Elias-Fano n-gram trie.

Level 1 holds word hashes; a word's id is its rank. Level k holds, context after context, the words that follow a
(k-1)-gram. A follower is coded relative to its context: by its place among the followers of the context's own suffix
(for bigrams, the word id). Adding a running base per context makes the codes one monotone sequence. Bases, pointers
(where a context's followers begin) and codes are Elias-Fano sequences; probabilities and back-off weights are two bytes
each. A look-up adds the context's base to the relative code and searches the sequence at that spot; within a run of
documents each distinct n-gram is looked up once.

Counts come from grouped Spark aggregations, one level after the other: an n-gram is counted only where its prefix and
suffix were kept, and kept if it occurs MIN_COUNT times or more: by default all are. Levels are cut into ranges of contexts
of about SHARD n-grams; a task builds one range and writes it to the shared folder, and scoring tasks map the files, so no
process holds a level in memory. A context is whole in one range: its followers are distinct words, however often it occurs.

P(w | context) = (count - D) / count(context) + b(context) * P(w | shorter context) for kept n-grams, else the second
term alone, with b(context) the mass left over; P(w) = (c + 1) / (N + V + 1). Codes are rounded towards smaller values (by
less than STEP in log10), so that no context's probabilities sum to more than 1.

Defined cases: a null text is empty, and has the end token only; with no training token, every probability is 1;
equal rows score equal; columns beyond the id and text are ignored.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm import words as W
from spanforge.llm.elias_fano import encode, monotone, named, pack, unpack
from spanforge.llm.shared import crc_of_id, dropped, filesystem, publish, shared_folder, written

ORDER, MIN_COUNT, DISCOUNT, STEP = 3, 1, 0.75, 1 / 2048
#: N-grams of a shard, as the ranges are meant to be; tokens that are counted, and bytes of text scored, at once.
SHARD, RUN, TEXT = 2_000_000, 1_000_000, 4 << 20
#: Hash of the end token: that of a "word" of white space, which no text has.
END = W.mix(np.array([0x20], np.uint64))[0]
SIGN = np.uint64(1 << 63)


class Shard(NamedTuple):
    """A file: its first key (hash or context), its number of entries, and how many come before it in its level."""

    path: str
    first: int
    size: int
    before: int


class Trie(NamedTuple):
    """By level, its shards; ``cuts``: nodes of the last level at which ranges of contexts begin, ``hot``: which of these
    begin a range of one node that is met more often than a shard's size."""

    levels: list[list[Shard]]
    tokens: int
    types: int
    cuts: np.ndarray
    hot: np.ndarray


@lru_cache(4096)
def _mapped(path: str) -> dict:
    """Arrays of a shard, memory-mapped; from a folder that is not a local path, through a copy kept while the worker lives."""
    system, local = filesystem(path)
    if system.type_name != "local":
        own = os.path.join(tempfile.mkdtemp(), "shard")
        with system.open_input_stream(local) as source, open(own, "wb") as out:
            while block := source.read(1 << 22):
                out.write(block)
        local = own
    arrays = unpack(np.memmap(local, np.uint8, "r").view(np.ndarray))
    names = {x.partition(".")[0] for x in arrays if "." in x}
    return arrays | {name: monotone(name, arrays) for name in names}


def _routed(shards: list[Shard], keys: np.ndarray) -> Iterator[tuple[Shard, np.ndarray]]:
    """Each shard that some key falls to, with those keys' places."""
    firsts = np.array([x.first for x in shards], keys.dtype)
    to = np.searchsorted(firsts, keys, "right") - 1
    if len(keys) and (to[1:] >= to[:-1]).all():
        order = np.arange(len(keys))
    else:
        order = np.argsort(to, kind="stable")
    sorted_ = to[order]
    cuts = np.append(np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(keys) else [], len(keys)).astype(np.int64)
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if sorted_[low] >= 0:
            yield shards[sorted_[low]], order[low:high]


def find_words(trie: Trie, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: unseen) and counts of word hashes."""
    ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
    for shard, at in _routed(trie.levels[0], hashes):
        file = _mapped(shard.path)
        got = file["keys"].find(hashes[at])
        hit = got >= 0
        ids[at[hit]] = got[hit] + shard.before
        counts[at[hit]] = file["n"][got[hit]]
    return ids, counts


class Found(NamedTuple):
    """By query: the node (-1: none), its coded probability and count, the context's back-off code and first child."""

    node: np.ndarray
    code: np.ndarray
    backoff: np.ndarray
    begin: np.ndarray


def find_followers(trie: Trie, level: int, context: np.ndarray, relative: np.ndarray, order: int = 99) -> Found:
    """Followers at a level (2 and up); a context or relative code below 0 has none. Queries are taken in order of their
    contexts, and what belongs to a context is read once; the first child only below level ``order``."""
    n = len(context)
    out = Found(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64))
    by = np.flatnonzero(context >= 0)
    steps = np.diff(context[by])
    if (steps < 0).any():
        by = by[np.argsort(context[by], kind="stable")]
        steps = np.diff(context[by])
    new = np.flatnonzero(np.append(True, steps != 0)) if len(by) else by
    distinct, ends = context[by[new]], np.append(new, len(by))
    for shard, own_at in _routed(trie.levels[level - 1], distinct):
        file, first, last = _mapped(shard.path), int(own_at[0]), int(own_at[-1]) + 1
        own = distinct[first:last] - shard.first
        last = first + int(np.searchsorted(own, len(file["backoff"])))
        own = own[: last - first]
        at = by[ends[first] : ends[last]]
        of = np.repeat(np.arange(len(own)), np.diff(ends[first : last + 1]))
        out.backoff[at] = file["backoff"][own][of]
        if level < order:
            out.begin[at] = (file["begin"].get(own).astype(np.int64) + shard.before)[of]
        base, stop = file["base"].both(own)
        may = np.flatnonzero(relative[at] >= 0)
        place, of = at[may], of[may]
        key = base[of] + relative[place].astype(np.uint64)
        fits = np.flatnonzero(key < stop[of])
        got = file["keys"].find(key[fits])
        hit = np.flatnonzero(got >= 0)
        place, got = place[fits[hit]], got[hit]
        out.node[place] = got + shard.before
        out.code[place] = file["prob"][got]
    return out


def _sequence(chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a chunk's tokens, each document's end included, and where each document begins."""
    begin = chunk.words + np.arange(len(chunk.words))
    tokens = np.empty(begin[-1], np.uint64)
    ends = begin[1:] - 1
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner], tokens[ends] = chunk.hashes, END
    return tokens, begin


class Grams(NamedTuple):
    """Distinct n-grams of a run: by token, the one that ends there (-1: none); by n-gram, its node (-1: not kept) and the first of its context's nodes."""

    at: np.ndarray
    node: np.ndarray
    first: np.ndarray


def _pairs_at(grams: Grams, fits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of tokens that end an n-gram one word longer, and a number for it, equal for equal n-grams."""
    place = np.flatnonzero(fits)
    return place, grams.at[place - 1] * np.int64(len(grams.node)) + grams.at[place]


def _walk(trie: Trie, tokens: np.ndarray, begin: np.ndarray, upto: int, order: int = 99):
    """Counts of tokens and their places in documents, the distinct n-grams of the last level, and by level where they end and what was found."""
    seen, code = np.unique(tokens, return_inverse=True)
    ids, counts = find_words(trie, seen)
    number = np.arange(len(tokens)) - np.repeat(begin[:-1], np.diff(begin))
    grams, levels = Grams(code, ids, np.zeros(len(ids), np.int64)), []
    for level in range(2, upto + 1):
        place, key = _pairs_at(grams, number >= level - 1)
        pairs, which = np.unique(key, return_inverse=True)
        context, last = np.divmod(pairs, max(1, len(grams.node)))
        got = find_followers(trie, level, grams.node[context], np.where(grams.node[last] >= 0, grams.node[last] - grams.first[last], -1), order)
        at = np.full(len(tokens), -1, np.int64)
        at[place] = which
        levels.append((place, which, got))
        grams = Grams(at, got.node, got.begin)
    return counts[code], number, grams, levels


def count_words(docs: DataFrame) -> DataFrame:
    """word (hash, signed) and n, over all tokens; each task sums its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
            seen, code = np.unique(keys, return_inverse=True)
            return seen, np.bincount(code, n).astype(np.int64)

        size = 0
        for batch in batches:
            for chunk in W.chunks(batch.column("text"), True):
                held.append(np.unique(_sequence(chunk)[0], return_counts=True))
                size += len(held[-1][0])
                if size > 4_000_000:
                    held = [merged()]
                    if (size := len(held[0][0])) > 2_000_000:
                        yield from _pairs(*held.pop(), "word")
                        size = 0
        if held:
            yield from _pairs(*merged(), "word")

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _pairs(keys: np.ndarray, n: np.ndarray, name: str) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(keys), 50_000):
        yield pa.record_batch({name: pa.array(keys[k : k + 50_000].view(np.int64)), "n": pa.array(n[k : k + 50_000].astype(np.int64))})


def _narrow(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in as few bytes as hold them."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _sent(part: np.ndarray, context: np.ndarray, relative: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of part and entries: the n-grams of a part in one packed row."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
    for own in np.split(order, cuts[1:]):
        first = context[own].min()
        arrays = {"first": np.array([first]), "context": _narrow(context[own] - first), "relative": _narrow(relative[own]), "n": _narrow(n[own])}
        yield pa.record_batch({"part": pa.array([part[own[0]]], pa.int32()), "entries": pa.array([pack(arrays)], pa.binary())})


def _summed(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """context, relative and n of packed rows, in order, equal ones added."""
    rows = [unpack(np.frombuffer(x, np.uint8)) for x in packed]
    context = np.concatenate([x["context"].astype(np.int64) + x["first"][0] for x in rows])
    relative, n = (np.concatenate([x[k].astype(np.int64) for x in rows]) for k in ("relative", "n"))
    low, span = context.min(), int(relative.max()) + 1
    if int(context.max() - low + 1) * span < 2**63:
        order = np.argsort((context - low) * span + relative)
    else:
        order = np.lexsort((relative, context))
    context, relative, n = context[order], relative[order], n[order]
    new = np.flatnonzero(np.append(True, (context[1:] != context[:-1]) | (relative[1:] != relative[:-1])))
    return context[new], relative[new], np.add.reduceat(n, new)


def count_followers(docs: DataFrame, trie: Trie, level: int, salts: int) -> DataFrame:
    """part, entries: n-grams whose prefix and suffix are kept, counted in runs of about RUN tokens, for the range of
    their context; those of hot contexts go to one of ``salts`` parts behind the ranges instead."""
    sent = docs.sparkSession.sparkContext.broadcast(trie)

    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        sizes = np.cumsum([0, *(len(x) for x, _ in held)])
        tokens = np.concatenate([x for x, _ in held])
        begin = np.append(np.concatenate([b[:-1] + size for (_, b), size in zip(held, sizes[:-1], strict=True)]), len(tokens))
        _, number, grams, _ = _walk(t, tokens, begin, level - 1)
        _, key = _pairs_at(grams, number >= level - 1)
        pairs, n = np.unique(key, return_counts=True)
        before, last = np.divmod(pairs, max(1, len(grams.node)))
        context, node = grams.node[before], grams.node[last]
        good = (context >= 0) & (node >= 0)
        context, relative, n = context[good], (node - grams.first[last])[good], n[good]
        if len(n):
            part = np.searchsorted(t.cuts, context, "right") - 1
            hot = np.flatnonzero(t.hot[part])
            part[hot] = len(t.cuts) + W.mix(context[hot].astype(np.uint64) * W._A + relative[hot].astype(np.uint64)) % np.uint64(salts)
            yield from _sent(part, context, relative, n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for chunk in W.chunks(batch.column("text"), True):
                held.append(_sequence(chunk))
                size += len(held[-1][0])
                if size >= RUN:
                    yield from counted(held)
                    held, size = [], 0
        if size:
            yield from counted(held)

    return docs.select("text").mapInArrow(count, "part int, entries binary")


def _coded(p: np.ndarray) -> np.ndarray:
    return np.clip(np.ceil(-np.log10(np.maximum(p, 1e-300)) / STEP), 0, 65535).astype(np.uint16)


#: A shard, with the nodes (from its first) at which about every so many occurrences begin and those beyond SHARD; or, in its place, summed entries of a range.
MANIFEST = pa.schema([("path", pa.string()), ("first", pa.int64()), ("size", pa.int64()), ("cuts", pa.list_(pa.int64())), ("hot", pa.list_(pa.int64())), ("part", pa.int32()), ("entries", pa.binary())])
MANIFEST_DDL = "path string, first long, size long, cuts array<long>, hot array<long>, part int, entries binary"


def _made(path: str, first: int, n: np.ndarray, per: int, shard: int) -> pa.RecordBatch:
    hot = np.flatnonzero(n > shard)
    held = np.cumsum(np.where(n > shard, 0, n)) // per
    cuts = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
    return pa.RecordBatch.from_pylist([{"path": path, "first": first, "size": len(n), "cuts": cuts.tolist(), "hot": hot.tolist()}], MANIFEST)


def _build_words(folder: str, per: int, shard: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = [(b.column("word").to_numpy(), b.column("n").to_numpy()) for b in batches if b.num_rows]
        if parts:
            keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            keys = keys.view(np.uint64) ^ SIGN
            path = f"{folder}/words-{TaskContext.get().partitionId():06d}"
            publish(path, pack(named("keys", encode(keys, 1 << 64)) | {"n": _narrow(n)}))
            yield _made(path, int(keys[0].view(np.int64)), n, per, shard)

    return build


def _build_followers(folder: str, sent, level: int, min_count: int, per: int, shard: int):
    """A range of contexts to a shard; entries of hot contexts are summed and sent on to their range."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_part: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, entries in zip(batch.column("part").to_pylist(), batch.column("entries").to_pylist(), strict=True):
                by_part.setdefault(part, []).append(entries)
        trie = sent.value
        for part, packed in by_part.items():
            context, relative, n = _summed(packed)
            if part >= len(trie.cuts):
                for batch in _sent(np.searchsorted(trie.cuts, context, "right") - 1, context, relative, n):
                    yield pa.RecordBatch.from_pylist(batch.to_pylist(), MANIFEST)
                continue
            kept = n >= min_count
            context, relative, n = context[kept], relative[kept], n[kept]
            if not len(n):
                continue
            lo, hi = int(context[0]), int(context[-1]) + 1
            new = np.append(True, context[1:] != context[:-1])
            first, of = np.flatnonzero(new), np.cumsum(new) - 1
            own = context[first]
            share = (n - DISCOUNT) / np.maximum(_counts_of(trie, level - 1, own)[of], n)
            left = np.maximum(1 - np.add.reduceat(share, first), 1e-9)
            prob = share + left[of] * _suffix_probability(trie, level, own, of, relative)
            spans = np.zeros(hi - lo, np.int64)
            spans[own - lo] = relative[np.append(first[1:], len(n)) - 1] + 1
            base = np.concatenate([[0], np.cumsum(spans)]).astype(np.uint64)
            begin = np.searchsorted(context, np.arange(lo, hi + 1)).astype(np.uint64)
            backoff = np.zeros(hi - lo, np.uint16)
            backoff[own - lo] = _coded(left)
            arrays = named("keys", encode(base[context - lo] + relative.astype(np.uint64), int(base[-1]))) | named("base", encode(base, int(base[-1]) + 1)) | named("begin", encode(begin, len(n) + 1))
            path = f"{folder}/level{level}-{part:06d}"
            publish(path, pack(arrays | {"prob": _coded(np.minimum(prob, 1)), "backoff": backoff, "n": _narrow(n)}))
            yield _made(path, lo, n, per, shard)

    return build


def _counts_of(trie: Trie, level: int, nodes: np.ndarray, name: str = "n") -> np.ndarray:
    shards = trie.levels[level - 1]
    out = np.zeros(len(nodes), np.int64)
    numbered = [x._replace(first=x.before) for x in shards]
    for shard, at in _routed(numbered, nodes):
        out[at] = _mapped(shard.path)[name][nodes[at] - shard.before]
    return out


def _suffix_probability(trie: Trie, level: int, contexts: np.ndarray, of: np.ndarray, relative: np.ndarray) -> np.ndarray:
    """Lower-order probability of followers; of: the place of each one's context in contexts, which are in order."""
    if level == 2:
        return (_counts_of(trie, 1, relative) + 1) / (trie.tokens + trie.types + 1)
    # The follower is a child of the context's last words: context (u, v) is itself child v of u, so the suffix node
    # is the relative code counted from v's first child; v's id is the context node's own relative code.
    last = np.zeros(len(contexts), np.int64)
    for shard, at in _routed([x._replace(first=x.before) for x in trie.levels[1]], contexts):
        file = _mapped(shard.path)
        own = contexts[at] - shard.before
        begins = file["begin"].get(np.arange(file["begin"].n)).astype(np.int64)
        # The last context that begins at or before a child owns it.
        owner = np.searchsorted(begins, own, "right") - 1
        last[at] = (file["keys"].get(own) - file["base"].get(owner)).astype(np.int64)
    words, which = np.unique(last, return_inverse=True)
    begin = find_followers(trie, 2, words, np.full(len(words), -1, np.int64)).begin[which]
    return 10.0 ** (-STEP * _counts_of(trie, 2, begin[of] + relative, "prob"))


def _with_level(trie: Trie, made: list, unsigned: bool = False) -> Trie:
    """trie with a level of these manifest rows: small ones, one a file."""
    first = lambda r: r["first"] % 2**64 if unsigned else r["first"]
    shards, cuts, hot, before = [], [np.zeros(1, np.int64)], [], 0
    for row in sorted(made, key=first):
        shards.append(Shard(row["path"], first(row), row["size"], before))
        cuts.append(np.array(row["cuts"], np.int64) + before)
        hot.append(np.array(row["hot"], np.int64) + before)
        before += row["size"]
    hot = np.concatenate(hot) if hot else np.zeros(0, np.int64)
    cuts = np.unique(np.concatenate([*cuts, hot, hot + 1]))
    return trie._replace(levels=[*trie.levels, shards], cuts=cuts, hot=np.isin(cuts, hot))


def train(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, partitions: int | None = None, shard: int = SHARD) -> Trie:
    """A trie over the texts of docs, in the shared folder. ``order`` is 2 or 3."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "ngram-trie")
    least = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = written(count_words(docs), "words")
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # Ranges hold about as many occurrences each: at most SHARD, but for a hot context, whose entries are summed first.
    per = max(1, min(shard, tokens // least))
    # Ranges are of the signed hash with its top bit turned, which is the order of the unsigned one.
    turned = counts.withColumn("word", F.col("word").bitwiseXOR(F.lit(-(1 << 63)))).repartitionByRange(max(least, -(-types // shard)), "word").sortWithinPartitions("word")
    trie = Trie([], tokens, types, np.zeros(0, np.int64), np.zeros(0, bool))
    trie = _with_level(trie, turned.mapInArrow(_build_words(folder, per, shard), MANIFEST_DDL).collect(), True)
    dropped(counts)
    for level in range(2, order + 1):
        salts = max(least, tokens // shard) if trie.hot.any() else 0
        parts, sent = len(trie.cuts), spark.sparkContext.broadcast(trie)
        build = _build_followers(folder, sent, level, min_count, per, shard)
        made = written(count_followers(docs, trie, level, salts).repartitionById(parts + salts, "part").mapInArrow(build, MANIFEST_DDL), f"level{level}")
        rows = made.where("entries is null").drop("entries").collect()
        if salts:
            hot = written(made.where("entries is not null").select("part", "entries").repartitionById(parts, "part").mapInArrow(build, MANIFEST_DDL), f"level{level}-hot")
            rows += hot.drop("entries").collect()
            dropped(hot)
        dropped(made)
        trie = _with_level(trie, rows)
    return trie


def score(docs: DataFrame, trie: Trie, keep: list[str]) -> DataFrame:
    """keep columns with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    sent = docs.sparkSession.sparkContext.broadcast(trie)
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    new = [StructField(k, LongType()) for k in ("n_tokens", "n_known", "train_tokens")] + [StructField(k, DoubleType()) for k in ("base_score", "score")]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        total = t.tokens + t.types + 1
        for batch in batches:
            for chunk in W.chunks(batch.column("text"), True, TEXT):
                tokens, begin = _sequence(chunk)
                counts, _, _, levels = _walk(t, tokens, begin, len(t.levels), len(t.levels))
                base = np.log10((counts + 1) / total)
                value = base.copy()
                for place, which, got in levels:
                    value[place] = np.where(got.node[which] >= 0, -STEP * got.code[which], value[place] - STEP * got.backoff[which])
                first = begin[:-1]
                rows = batch.slice(chunk.first, chunk.last - chunk.first)
                yield pa.record_batch(
                    {name: rows.column(name) for name in keep}
                    | {
                        "n_tokens": pa.array(np.diff(begin)),
                        "n_known": pa.array(np.add.reduceat((counts > 0).astype(np.int64), first)),
                        "train_tokens": pa.array(np.full(rows.num_rows, t.tokens, np.int64)),
                        "base_score": pa.array(np.add.reduceat(base, first)),
                        "score": pa.array(np.add.reduceat(value, first)),
                    }
                )

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(judge, StructType([*docs.select(*keep).schema.fields, *new]))


def op2_ngram_trie(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("held_out", F.pmod(crc_of_id(), F.lit(7)) == 2)
    return score(docs, train(docs.where("not held_out").select("text")), ["doc_id", "held_out"])
