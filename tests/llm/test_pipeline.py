"""Every stage of the pipeline against a plain version on the same input, with null ids, repeats and null texts; and op9
against plain profiles."""

import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import DATA

from spanforge.llm import hyperdimensional, line_cleaning, soft_mixing
from spanforge.llm.shared import with_key, written

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The tables of sf0.001 with rows without ids, repeated rows, copies under null ids, null and empty texts; a benchmark
    item without an id that some document holds."""
    path = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rows = docs.orderBy("doc_id").collect()
    clean = next(r for r in rows if r.text and len(r.text.split()) > 120)
    own = " ".join(f"word{k % 97}x{k}" for k in range(80)) + "."
    more = [(None, clean.text, "en", "s", 1), (None, own, "en", "s", 2), (None, own, "en", "s", 2), (None, None, None, None, None), (7_000_001, "", "en", None, 0), rows[5], rows[5], (7_000_002, own + " And one more line that is its own.", None, None, 3)]
    docs.unionByName(spark.createDataFrame([tuple(r) for r in more], FIELDS)).coalesce(3).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{DATA}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    bench.unionByName(spark.createDataFrame([(None, " ".join(clean.text.split()[40:70])), (None, None)], "item_id long, text string"), allowMissingColumns=True).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def lowered(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in (x.decode() for x in (text or "").encode().split())]


def plain_rules(duck, rows):
    import pandas as pd

    table = pd.DataFrame([(k, r.text) for k, r in enumerate(rows)], columns=["doc_id", "text"])
    duck.register("some_docs", table)
    kept = duck.execute(f"WITH {line_cleaning.LINE_SQL.format(table='some_docs')} SELECT doc_id, cleaned FROM judged WHERE kept").fetchall()
    return [(rows[k].doc_id, text, rows[k].lang, rows[k].source, len(text)) for k, text in kept]


def plain_near_duplicates(rows):
    """All pairs of unlike texts, and one row of each group."""
    def shingles(text):
        words = lowered(text)
        return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()

    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    of = {}
    for k, s in enumerate(sets):
        for x in s:
            of.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        for j, same in Counter(j for x in s for j in of[x] if j < k).items():
            if 100 * same >= 80 * (len(s) + len(sets[j]) - same):
                root[max(top(j), top(k))] = min(top(j), top(k))
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(top(k), []).append(rows[k])
    return list(groups.values())


def plain_contaminated(text, items):
    words = lowered(text)
    for item in items:
        n = min(13, len(item))
        for shift in range(-len(item) + n, len(words) - n + 1) if n else ():
            low, high = max(0, -shift), min(len(item), len(words) - shift)
            same = np.concatenate([[0], np.cumsum([item[p] == words[p + shift] for p in range(low, high)])])
            if high - low >= n and (same[n:] - same[:-n]).max() >= 0.8 * n:
                return True
    return False


def test_stages_against_plain_versions(spark, duck, folder):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    run = lambda name, df: written(stages[name](spark, df, folder), name)
    rows = lambda df: [tuple(r) for r in df.collect()]
    cleaned = run("quality_rules", docs)
    assert Counter(rows(cleaned)) == Counter(plain_rules(duck, docs.collect()))
    single = run("near_duplicates", cleaned)
    groups, left = plain_near_duplicates(cleaned.collect()), Counter(rows(single))
    assert sum(left.values()) == len(groups)
    for group in groups:
        ids = [r.doc_id for r in group if r.doc_id is not None]
        least = [tuple(r) for r in group if r.doc_id == (min(ids) if ids else None)]
        assert any(left[r] for r in least)
    free = run("decontamination", single)
    items = [lowered(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = Counter(r for r in rows(single) if not plain_contaminated(r[1], items))
    assert Counter(rows(free)) == want and sum(want.values()) < single.count()
    mixed = run("mixing", free)
    assert Counter(rows(mixed)) == plain_mixing(spark, free, folder)
    coder, start, seen = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, Counter()
    told = Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in stages["token_files"](spark, mixed, folder).collect())
    for r in mixed.collect():
        ids = [*coder.encode(r.text or "", add_special_tokens=False).ids, 1]
        seen[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert told == seen


def plain_mixing(spark, free, folder):
    """Copies by rates that one loop over all rows fits, from the stage's own posteriors."""
    from pyspark.sql import functions as F

    labels = soft_mixing.domain_labels(spark.read.parquet(f"{folder}/labels.parquet"))
    known = {r.doc_id: r.domain for r in labels.where("doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain")).collect()}
    keyed = with_key(free, "doc_id", "text", "lang", "source", "n_chars")
    index, value, label = soft_mixing.labelled_sample(keyed, labels, "domain", soft_mixing.SAMPLE)
    table = soft_mixing.posteriors(keyed, soft_mixing.fit_domains(index, value, label, 3), ["row_key", "doc_id"]).collect()
    p, tokens = np.array([r.posterior for r in table]), np.array([r.n_tokens for r in table], float)
    least = np.array([float(known[r.doc_id] == 0 if r.doc_id in known else r.posterior[0] >= max(r.posterior)) for r in table])
    gram = (p * tokens[:, None]).T @ p
    available = gram.sum(axis=1)
    targets = np.minimum(np.array(soft_mixing.SHARES) * available[0] / soft_mixing.SHARES[0], available)
    root = 1 / np.sqrt(available)
    step = 1 / np.linalg.eigvalsh(root[:, None] * gram * root)[-1]
    rate, moved = np.ones(len(p)), np.inf
    while np.abs((tokens * rate) @ p - targets).max() > soft_mixing.TOLERANCE * targets.sum() and moved > soft_mixing.STILL * available.sum():
        now = np.maximum(least, rate - p @ (step / available * ((tokens * rate) @ p - targets)))
        rate, moved = now, (tokens * np.abs(now - rate)).sum()
    by_key = {r.row_key: x for r, x in zip(table, rate, strict=True)}
    frame = spark.createDataFrame([(k, float(v)) for k, v in by_key.items()], "row_key long, rate double")
    number = {r.row_key: r.n for r in frame.select("row_key", soft_mixing.copies(F.col("rate"), F.col("row_key")).alias("n")).collect()}
    out = Counter()
    for r in keyed.collect():
        out[tuple(r)[:5]] += number[r.row_key]
    return +out


def test_pipeline_of_an_empty_table(spark, folder, tmp_path):
    import corpus_pipeline

    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_op9_against_plain_profiles(spark):
    table, vectors = hyperdimensional.letter_table(), hyperdimensional.letter_vectors().astype(np.int64)

    def bundle(text):
        out, codes = np.zeros(hyperdimensional.DIMENSIONS, np.int64), [0, *(int(table[ord(x)]) for x in text or ""), 0]
        for (a, b, c), n in Counter(zip(codes, codes[1:], codes[2:], strict=False)).items():
            if b:
                out += n * np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c]
        return out

    rows = pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    bundles = [bundle(r["text"]) for r in rows]
    total = {}
    for r, x in zip(rows, bundles, strict=True):
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["lang"] is not None:
            total[r["lang"]] = total.get(r["lang"], 0) + x
    names = sorted(total)
    unit = np.array([total[n] / np.linalg.norm(total[n]) for n in names])
    got = {r.doc_id: r for r in hyperdimensional.op9_hyperdimensional(spark, DATA).collect()}
    for r, x in zip(rows, bundles, strict=True):
        told = got[r["doc_id"]]
        if not any(table[ord(c)] for c in r["text"] or ""):
            assert (told.lang_pred, told.score) == ("und", 0.0)
            continue
        cosines = unit @ (x / np.linalg.norm(x))
        assert abs(told.score - (cosines.max() + 1) / 2) < 1e-4 and cosines[names.index(told.lang_pred)] > cosines.max() - 1e-4


def test_clashing_columns_are_replaced_or_ignored(spark):
    """Every operator on a table whose columns have the names of its own."""
    from spanforge.llm import factorisation, ngram_trie

    docs = spark.createDataFrame([(1, "one two three", 9, "a", "b"), (2, None, 9, "a", "b")], "doc_id long, text string, score long, predicted string, base_score string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert factorisation.score(docs, factorisation.train(docs, labels), ["doc_id"]).columns == ["doc_id", "score", "predicted"]
    assert ngram_trie.score(docs, ngram_trie.train(docs), ["doc_id"]).count() == 2
    assert hyperdimensional.identify(docs, *hyperdimensional.prototypes(docs.selectExpr("*", "'en' as lang")), ["doc_id"]).columns == ["doc_id", "lang_pred", "score"]
