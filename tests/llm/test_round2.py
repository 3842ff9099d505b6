"""Whole jobs: cases in which rows, links or overlaps used to be lost."""

from collections import Counter

from conftest import DATA


def test_mixing_keeps_documents_labelled_clean(spark):
    import corpus_pipeline

    docs = corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{DATA}/documents.parquet"), DATA)
    clean = {r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").where("quality = 1 and toxic = 0").collect()}
    before = {r.doc_id for r in docs.collect()} & clean
    after = Counter(r.doc_id for r in corpus_pipeline.mixed(spark, docs, DATA).collect())
    assert before and before <= set(after)
    assert max(after.values()) < 10


FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "a b c d e f g h i j k l m n o p q r s t u v w x y z"


def _rows(spark, *rows):
    return spark.createDataFrame([(k, t, None, None, None) for k, t in rows], FIELDS)


def test_near_duplicates_keep_one_row_a_component(spark):
    import corpus_pipeline

    rows = [(1, LONG), (1, LONG), (1, "one text of its own under a shared id"), (2, LONG + " end"), (None, "null id and alone"), (None, "null id and also alone"), (None, LONG), (7, "here the copy has no id"), (None, "here the copy has no id"), (None, "both copies without id"), (None, "both copies without id"), (8, None), (9, "")]
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, _rows(spark, *rows), DATA).collect())
    assert got == Counter(rows[k] for k in (1, 2, 4, 5, 7, 9, 11, 12))
    plain = [x for k, x in enumerate(rows) if k != 1]
    assert Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, _rows(spark, *plain), DATA).collect()) == got


def test_texts_without_ids_link_others(spark):
    from spanforge.llm import jaccard_join

    words = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join(words)), (None, " ".join(words[:-3])), (2, " ".join(words[:-6]))]
    got = jaccard_join.jaccard_components(_rows(spark, *rows), 3, 94, 100).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (None, 1), (2, 1)}


def test_decontamination_judges_rows_by_their_own_text(spark):
    from spanforge.llm import spaced_seeds

    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    rows = [(None, "x " + LONG), (5, LONG), (5, "another text under that id"), (None, "clean")]
    got = spaced_seeds.decontaminate(_rows(spark, *rows), items).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("5", rows[2][1]), ("None", "clean")]


def test_labelled_sample_takes_an_id_once(spark):
    from spanforge.llm import features

    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    index, _, label = features.labelled_sample(_rows(spark, *[(1, f"text {k}") for k in range(50)], (2, "b")), labels, "label", 10)
    assert len(index) == 2 and label.tolist() == [1, 0]


def test_masks_are_lossless():
    from spanforge.llm import spaced_seeds as S

    for window in range(1, 18):
        for share in (0.5, 0.8, 0.9):
            assert S.lossless(S.masks_for(window, share), window, S.allowed(window, share))
    assert S.masks_for(S.WINDOW, S.SHARE) == S.MASKS and S.allowed(10, 0.8) == S.allowed(13, 0.8) == 2 and S.allowed(9, 0.8) == 1


def test_spaced_seeds_against_brute_force(spark):
    import random

    from spanforge.llm import spaced_seeds as S

    draw = random.Random(3)
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(1, 21)}
    docs = {}
    for n, words in items.items():
        for _ in range(40):
            own = list(words)
            for at in draw.sample(range(n), min(n, draw.randrange(5))):
                own[at] = f"x{at}"
            docs[len(docs)] = ["y"] * draw.randrange(3) + own + ["z"] * draw.randrange(3)
    want = set()
    for d, text in docs.items():
        for k, item in items.items():
            n = min(S.WINDOW, len(item))
            for i in range(len(item) - n + 1):
                for j in range(len(text) - n + 1):
                    if sum(a == b for a, b in zip(item[i : i + n], text[j : j + n], strict=True)) >= S.SHARE * n:
                        want.add((d, k))
    frame = lambda x, name: spark.createDataFrame([(k, " ".join(v)) for k, v in x.items()], f"{name} long, text string")
    got = S.contaminated(frame(docs, "doc_id"), frame(items, "item_id")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_trie_keeps_ngrams_that_occur_once(spark):
    from spanforge.llm import ngram_trie

    texts = ["a b c d e", "a b x", "one", None]
    trie = ngram_trie.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    lines = [[*(t or "").split(), "</s>"] for t in texts]
    for level, shards in enumerate(trie.levels, 1):
        assert sum(x.size for x in shards) >= len({tuple(w[k : k + level]) for w in lines for k in range(len(w) - level + 1)})


def test_every_letter_counts_as_one():
    from spanforge.llm import hyperdimensional

    table = hyperdimensional.letter_table()
    assert all((table[c] > 0) == chr(c).isalpha() for c in range(0x110000))
