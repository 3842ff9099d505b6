"""Exact Jaccard join of shingle sets, with set relations used to skip work, and its connected components.

Equal sets are one class and answer alike. First, every shingle is counted over all documents, in packed runs that meet by
parts of the hash space: a set with more than n - ceil(t n) shingles of its own can be like no other and is done. The sets
that are left are compared where their prefixes meet: a set's shingles are put in a global order (fewest sets first, then
by hash), and sets at least as similar as asked share one of the first n - ceil(t n) + 1.

Skipping in the index: each shingle's list is cut into blocks by set size and by the shingle's position. A pair of
blocks is opened only if the sizes can match and the words left after both positions could still make up the overlap
needed; blocks whose sets are in one component already are passed over.

Skipping by answers: every list first compares its sets with two hubs only (those of its sets with the fewest shingles of
their own), which joins most near copies, in a number of pairs linear in the list. For the pairs that are left, two sets
compared with one hub l bound their own overlap, |x l| + |z l| - |l| <= |x z| <= min(|x l|, |z l|) + min(|x - l|, |z - l|);
only pairs that these bounds leave open are verified, by the whole sets.

Defined cases: null and empty texts, and texts without words, have size 0 and stay alone; fewer than k words make one
shingle; a null id takes part by its text, and a component's id is its least non-null id; repeated rows are one class;
columns beyond id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanforge.llm import words as W
from spanforge.llm.components import connected_components
from spanforge.llm.elias_fano import pack, unpack
from spanforge.llm.shared import dropped, join_checked, small_batches, with_key, written

#: Shingles that a task counts at once, bytes of text for each part of the hash space, and positions of a block of a list.
RUN, PART, POSITIONS = 300_000, 8 << 20, 8
SET_ROWS = 1_000_000


def shingles_of(chunk: W.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a chunk's documents, repeats included, and the document of each."""
    starts, doc = W.gram_starts(chunk.words, k)
    keys = W.grams(chunk.hashes, k)[starts] if len(starts) else np.zeros(0, np.uint64)
    counts = np.diff(chunk.words)
    for n in range(1, k):
        own = np.flatnonzero(counts == n)
        if len(own):
            at = chunk.words[own]
            keys, doc = np.concatenate([keys, W.grams(chunk.hashes, n)[at] ^ np.uint64(n)]), np.concatenate([doc, own])
    return keys, doc


def sets_of(chunk: W.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a chunk's documents, sorted by document then hash, and where each document begins."""
    keys, doc = shingles_of(chunk, k)
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])]) if len(keys) else np.zeros(0, bool)
    return keys[new], np.searchsorted(doc[new], np.arange(len(chunk.words)))


def _classes(keys: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and class (a hash of the whole set, in any order) of each document from its distinct shingles."""
    n, total = np.bincount(doc, minlength=docs), np.zeros(docs, np.uint64)
    np.add.at(total, doc, W.mix(keys ^ W._C))
    return n, W.mix(total + n.astype(np.uint64) * W._A).view(np.int64)


def _prefix(n: Column, num: int, den: int) -> Column:
    """Shingles of a set's prefix: fewer of its own leave enough for a link."""
    return n - F.ceil(n * num / F.lit(float(den)) - 1e-9) + 1


_META = {"doc_id": pa.list_(pa.int64()), "row_key": pa.list_(pa.int64()), "n": pa.list_(pa.int64()), "class": pa.list_(pa.int64()), "shared": pa.list_(pa.int64())}
_META_DDL = ", ".join(f"`{c}` array<long>" for c in _META)


def _counted_runs(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """part, run, packed, and once a run its documents. packed: a run's distinct shingles of a part (32 bits of the hash
    behind the part's), in order of the document they are in, and how many each document has; last those that several
    documents of the run have, so that a shingle of all documents is sent once a run. Runs are numbered by task: docs must
    read the same again."""
    low, most = np.uint64(64 - bits - 32), np.uint64(64 - bits)
    empty = dict.fromkeys(_META, [None])

    def row(part: int, run: str, packed: bytes | None, meta: dict) -> pa.RecordBatch:
        own = {"part": pa.array([part], pa.int32()), "run": pa.array([run]), "packed": pa.array([packed], pa.binary())}
        return pa.record_batch(own | {c: pa.array(meta[c], kind) for c, kind in _META.items()})

    def counted(held: list[tuple], run: str) -> Iterator[pa.RecordBatch]:
        firsts = np.cumsum([0, *(size for _, _, size, _, _ in held)])
        keys, doc = np.concatenate([x[0] for x in held]), np.concatenate([x[1] + first for x, first in zip(held, firsts, strict=False)])
        docs, ids, row_keys = int(firsts[-1]), *([y for x in held for y in x[i]] for i in (3, 4))
        order = np.argsort(keys)
        keys, doc = keys[order], doc[order]
        again = np.append(False, keys[1:] == keys[:-1])[: len(keys)]
        again[:-1] |= again[1:]
        # Of shingles met several times, each document counts once.
        once, several = np.flatnonzero(~again), np.flatnonzero(again)
        pairs = np.lexsort((doc[several], keys[several]))
        several = several[pairs]
        several = several[np.append(True, (keys[several][1:] != keys[several][:-1]) | (doc[several][1:] != doc[several][:-1]))] if len(several) else several
        first = np.append(True, keys[several][1:] != keys[several][:-1])[: len(several)]
        alone = first & np.append(first[1:], True)[: len(several)]
        shared = np.bincount(doc[several[~alone]], minlength=docs)
        n, which = _classes(np.concatenate([keys[once], keys[several]]), np.concatenate([doc[once], doc[several]]), docs)
        yield row(zlib.crc32(run.encode()) % (1 << bits), run, None, {"doc_id": [ids], "row_key": [row_keys], "n": [n], "class": [which], "shared": [shared]})
        sent = np.concatenate([once, several[first]])
        owner = np.concatenate([doc[once], np.where(alone, doc[several], docs)[first]])
        part = (keys[sent] >> most).astype(np.int64)
        order = np.argsort(part * (docs + 1) + owner)
        part, owner, short = part[order], owner[order], ((keys[sent[order]] >> low) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else [0]
        for at, end in zip(cuts[:-1], cuts[1:], strict=True):
            sizes = np.bincount(owner[at:end], minlength=docs + 1)
            yield row(int(part[at]), run, pack({"short": short[at:end], "sizes": sizes.astype(np.min_scalar_type(sizes.max()))}), empty)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, size, number = [], 0, 0
        for batch in batches:
            for chunk in W.chunks(batch.column("text"), True):
                keys, doc = shingles_of(chunk, k)
                ids, row_keys = (batch.column(c).slice(chunk.first, chunk.last - chunk.first).to_pylist() for c in ("doc_id", "row_key"))
                held.append((keys, doc, len(ids), ids, row_keys))
                size += len(keys)
                if size >= RUN:
                    yield from counted(held, f"{TaskContext.get().partitionId()}-{number}")
                    held, size, number = [], 0, number + 1
        if held:
            yield from counted(held, f"{TaskContext.get().partitionId()}-{number}")

    return docs.select("doc_id", "row_key", "text").mapInArrow(emit, f"part int, run string, packed binary, {_META_DDL}")


def _shared_in_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each run of a part, its documents with shingles that another run has too, and how many; rows of documents pass."""
    by_part: dict[int, list[tuple[str, bytes]]] = {}
    names = ["run", "packed", *_META]
    for batch in batches:
        passing = batch.filter(pa.compute.is_null(batch.column("packed")))
        if passing.num_rows:
            yield passing.select(names)
        rest = batch.filter(pa.compute.is_valid(batch.column("packed"))).select(["part", "run", "packed"])
        for row in rest.to_pylist():
            by_part.setdefault(row["part"], []).append((row["run"], row["packed"]))
    for rows in by_part.values():
        runs = [unpack(np.frombuffer(packed, np.uint8)) for _, packed in rows]
        short = np.concatenate([x["short"] for x in runs])
        order = np.argsort(short)
        same = short[order][1:] == short[order][:-1]
        often = np.zeros(len(short), bool)
        often[order[1:][same]] = often[order[:-1][same]] = True
        at = 0
        for (run, _), x in zip(rows, runs, strict=True):
            owner = np.repeat(np.arange(len(x["sizes"])), x["sizes"])[often[at : at + len(x["short"])]]
            at += len(x["short"])
            docs, counts = np.unique(owner[owner < len(x["sizes"]) - 1], return_counts=True)
            if len(docs):
                packed = pack({"doc": docs.astype(np.min_scalar_type(docs[-1])), "count": counts.astype(np.min_scalar_type(counts.max()))})
                yield pa.record_batch({"run": pa.array([run]), "packed": pa.array([packed], pa.binary())} | {c: pa.array([None], kind) for c, kind in _META.items()})


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of a run, with its counts of all parts added."""
    for batch in batches:
        for at in range(batch.num_rows):
            meta = {c: batch.column(c)[at].values for c in _META}
            shared = np.array(meta["shared"].to_numpy())
            for packed in batch.column("packed")[at].as_py():
                x = unpack(np.frombuffer(packed, np.uint8))
                shared[x["doc"]] += x["count"]
            yield pa.record_batch({**{c: meta[c] for c in ("doc_id", "row_key", "n", "class")}, "shared": pa.array(shared)})


def document_classes(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, row_key, n, class (a hash of the whole set) of every document, and alone: no other document can be like it."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(int(spark.conf.get("spark.sql.shuffle.partitions")) - 1, size // PART, 1).bit_length()
    runs = _counted_runs(docs, k, bits).repartitionById(1 << bits, "part").mapInArrow(_shared_in_part, f"run string, packed binary, {_META_DDL}")
    whole = runs.groupBy("run").agg(F.collect_list("packed").alias("packed"), *[F.first(c, ignorenulls=True).alias(c) for c in _META])
    rows = whole.mapInArrow(_documents, "doc_id long, row_key long, n long, class long, shared long")
    return rows.withColumn("alone", (F.col("n") == 0) | (F.col("n") - F.col("shared") >= _prefix(F.col("n"), num, den))).drop("shared")


def open_sets(docs: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """class, n and sorted shingles of the classes that are not alone; recomputed from one row of each."""
    chosen = written(classes.where("not alone").groupBy("class").agg(F.min("row_key").alias("row_key")).select("row_key").distinct(), "set-keys")
    own = join_checked(docs.select("row_key", "text"), chosen, "row_key", "left_semi", SET_ROWS)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text"), True):
                keys, begin = sets_of(chunk, k)
                n, which = _classes(keys, np.repeat(np.arange(len(begin) - 1), np.diff(begin)), len(begin) - 1)
                yield pa.record_batch({"class": pa.array(which), "n": pa.array(n, pa.int64()), "shingles": pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(keys.view(np.int64)))})

    # Rows alike in every column share a key.
    return own.mapInArrow(emit, "class long, n long, shingles array<long>").dropDuplicates(["class"])


def prefixes(sets: DataFrame, num: int, den: int) -> DataFrame:
    """shingle, class, n, pos, own (shingles that no other set has): the places of each set's prefix that some other set has too. Shingles are in order of the
    sets they are in; those of one set only come first and need no row."""
    entries = sets.select("class", "n", F.explode("shingles").alias("shingle"))
    often = entries.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("class")
    placed = entries.join(often, "shingle").withColumns({"many": F.count("*").over(own), "rank": F.row_number().over(own.orderBy("df", "shingle"))})
    placed = placed.withColumn("own", F.col("n") - F.col("many")).withColumn("pos", F.col("own") + F.col("rank") - 1)
    return placed.where(F.col("pos") < _prefix(F.col("n"), num, den)).select("shingle", "class", "n", "pos", "own")


def _needed(nx: Column, ny: Column, num: int, den: int) -> Column:
    """Least overlap of linked sets of these sizes."""
    return F.ceil((nx + ny) * num / F.lit(float(den + num)) - 1e-9)


def _possible(n1: Column, p1: Column, n2: Column, p2: Column, num: int, den: int) -> Column:
    """Sizes can match, and what is left after a common shingle at these positions can make up the overlap."""
    sizes = (n1 * den >= n2 * num) & (n2 * den >= n1 * num)
    return sizes & (1 + F.least(n1 - p1 - 1, n2 - p2 - 1) >= _needed(n1, n2, num, den))


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (a, b, na, nb) with both, the size of the sets' intersection."""
    one, two = (sets.select(F.col("class").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    return written(pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("both")), "overlaps")


def _linked(num: int, den: int) -> Column:
    return F.col("both") * den >= (F.col("na") + F.col("nb") - F.col("both")) * num


def linked_components(docs: DataFrame, classes: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """class, root of every class linked with another."""
    sets = written(open_sets(docs, classes, k), "sets")
    places = written(prefixes(sets, num, den), "prefixes")
    lists = places.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    index = written(places.join(lists.select("shingle"), "shingle", "left_semi"), "index")
    dropped(places)

    # Answers of hubs: of each list, the two sets with the fewest shingles of their own. Copies that were edited each in
    # its own way are like the text they come from, if like anything, and that has none.
    hub = lambda tie: F.min(F.struct("own", tie.alias("tie"), "class", "n", "pos"))
    hubs = index.groupBy("shingle").agg(hub(F.col("class")).alias("one"), hub(-F.col("class")).alias("two"))
    hubs = hubs.select("shingle", F.explode(F.array(*[F.struct(*[f"{x}.{c}" for c in ("class", "n", "pos")]) for x in ("one", "two")])).alias("hub")).select("shingle", F.col("hub.class").alias("b"), F.col("hub.n").alias("nb"), F.col("hub.pos").alias("pb"))
    met = index.join(hubs, "shingle").where((F.col("class") != F.col("b")) & _possible(F.col("n"), F.col("pos"), F.col("nb"), F.col("pb"), num, den))
    pairs = written(met.select(F.col("class").alias("a"), "b", F.col("n").alias("na"), "nb").distinct(), "hub-pairs")
    tested = overlaps(pairs, sets)
    edges = tested.where(_linked(num, den)).select("a", "b")
    roots = written(connected_components(edges), "roots")

    # The rest: pairs of one list that are not in one component yet, opened block by block.
    placed = index.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    open_ = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("shingle")
    band = F.floor(F.log(F.col("n")) / float(np.log(den / num)))
    placed = written(placed.join(open_, "shingle", "left_semi").withColumns({"band": band, "block": F.floor(F.col("pos") / POSITIONS)}), "open-index")
    key = ["shingle", "root", "band", "block"]
    blocks = placed.groupBy(*key).agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("pos").alias("p0"))
    one, two = (blocks.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in blocks.columns if c != "shingle"]) for x in "ab")
    small_n, left = lambda x: F.col(f"n0_{x}"), lambda x: F.col(f"n1_{x}") - F.col(f"p0_{x}") - 1
    may = (F.col("root_a") < F.col("root_b")) & (F.abs(F.col("band_a") - F.col("band_b")) <= 1) & (1 + F.least(left("a"), left("b")) >= _needed(small_n("a"), small_n("b"), num, den))
    opened = one.join(two, "shingle").where(may)
    side = lambda x: placed.select("shingle", *[F.col(c).alias(f"{c}_{x}") for c in ("root", "band", "block")], F.col("class").alias(x), F.col("n").alias(f"n{x}"), F.col("pos").alias(f"p{x}"))
    on = lambda x: ["shingle", f"root_{x}", f"band_{x}", f"block_{x}"]
    rest = opened.join(side("a"), on("a")).join(side("b"), on("b")).where(_possible(F.col("na"), F.col("pa"), F.col("nb"), F.col("pb"), num, den))
    both_ways = tested.select("a", "b").unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest = written(rest.select("a", "b", "na", "nb").distinct().join(both_ways, ["a", "b"], "left_anti"), "rest-pairs")

    # Bounds from the hub most like a, where b was compared with it too: one row a pair.
    seen = tested.select(F.col("a").alias("x"), F.col("b").alias("hub"), F.col("nb").alias("nh"), F.col("both").alias("o"))
    likest = seen.groupBy(F.col("x").alias("a")).agg(F.max(F.struct("o", "hub", "nh")).alias("h")).select("a", "h.hub", "h.nh", F.col("h.o").alias("oa"))
    through = rest.join(likest, "a").join(seen.select("x", "hub", "o").toDF("b", "hub", "ob"), ["b", "hub"])
    bounds = through.groupBy("a", "b").agg(
        F.max(F.col("oa") + F.col("ob") - F.col("nh")).alias("least"),
        F.min(F.least("oa", "ob") + F.least(F.col("na") - F.col("oa"), F.col("nb") - F.col("ob"))).alias("most"),
    )
    judged = rest.join(bounds, ["a", "b"], "left").withColumn("needed", _needed(F.col("na"), F.col("nb"), num, den))
    judged = written(judged.withColumn("verdict", F.when(F.col("least") >= F.col("needed"), True).when(F.col("most") < F.col("needed"), False)), "judged")
    more = judged.where("verdict").select("a", "b")
    unsure = judged.where("verdict is null").select("a", "b", "na", "nb")
    if not unsure.isEmpty():
        more = more.unionByName(overlaps(unsure, sets).where(_linked(num, den)).select("a", "b"))
    known = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    out = written(connected_components(known.unionByName(more)), "components")
    dropped(sets, index, pairs, placed, rest)
    return out.select(F.col("node").alias("class"), "root")


def least_rows(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs (with row_key) with one row of each component, that of least id (null last) and key; rows without words stay."""
    classes = written(document_classes(docs, k, num, den), "classes")
    full = classes.where("n > 0").join(linked_components(docs, classes, k, num, den), "class", "left").withColumn("root", F.coalesce("root", "class"))
    first = full.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")).select("first.row_key")
    several = classes.where("n > 0").groupBy("row_key").count().where("count > 1").select("row_key", F.lit(True).alias("several"))
    kept = first.join(several, "row_key", "left").unionByName(classes.where("n = 0").select("row_key", F.lit(None).cast("boolean").alias("several")).distinct())
    kept = written(kept, "kept-rows")
    out = join_checked(docs, kept, "row_key")
    # Rows alike in every column share a key: where such rows are kept, one of them is.
    if kept.where("several").isEmpty():
        return out.select(*docs.columns)
    return out.where("several is null").unionByName(out.where("several").dropDuplicates(["row_key"])).select(*docs.columns)


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row: documents whose sets of k-word shingles reach num / den linked."""
    docs = with_key(docs.select("doc_id", "text"), "doc_id", "text")
    classes = written(document_classes(docs, k, num, den), "classes")
    roots = linked_components(docs, classes, k, num, den)
    full = classes.where("n > 0").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    firsts = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    # Roots by class, not by document: a hot component's documents never meet in one task.
    by_class = roots.join(firsts, "root").select("class", F.col("component_id").alias("linked_id"))
    alike = classes.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("own_id"), F.count("*").alias("rows"))
    ids = alike.join(by_class, "class", "left").where("rows > 1 or linked_id is not null").select("class", F.coalesce("linked_id", "own_id").alias("component_id"))
    # Classes of one row that are linked with nothing need no row here.
    joined = join_checked(classes, written(ids, "class-ids"), "class", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def op5_jaccard_join(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90, 100)


ORACLE = r"""WITH RECURSIVE tokens AS (SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'),
  lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, array_to_string(w[i:i+2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM tokens)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM tokens WHERE len(w) BETWEEN 1 AND 2)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least LEFT JOIN sizes USING (doc_id)"""
