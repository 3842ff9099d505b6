"""Components, set sizes and kept rows against a comparison of all pairs."""

import random

import pytest

from spanforge.llm import jaccard_join
from spanforge.llm.shared import with_key


def corpus(seed):
    """Texts of their own, near copies of a few of them edited each in its own way, exact copies, chains and short ones."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    texts = [" ".join(word() for _ in range(rng.randrange(3, 90))) for _ in range(60)]
    for base in texts[:6]:
        for _ in range(12):
            words = base.split()
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
    chain = [word() for _ in range(80)]
    for _ in range(10):
        chain = [*chain[1:], word()]
        texts.append(" ".join(chain))
    return [*texts, *texts[:5], texts[0].upper(), "a", "a", "A b", "a b", "", None, "  ", None]


def sets(texts, k):
    out = []
    for x in texts:
        words = "".join(c.lower() if c.isascii() else c for c in x or "").split()
        grams = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
        out.append(grams or ({tuple(words)} if words else set()))
    return out


def roots(found, num, den):
    root = list(range(len(found)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(found):
        for j in range(i):
            both = len(a & found[j])
            if both and den * both >= num * (len(a) + len(found[j]) - both):
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(found))]


@pytest.mark.parametrize("seed, k, num", [(1, 3, 90), (2, 5, 80), (3, 3, 60)])
def test_components_are_those_of_all_pairs(spark, seed, k, num):
    texts = corpus(seed)
    found = sets(texts, k)
    wanted = {(i, len(s), r) for i, (s, r) in enumerate(zip(found, roots(found, num, 100), strict=True))}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {tuple(r) for r in jaccard_join.jaccard_components(docs, k, num, 100).collect()} == wanted
    kept = {r.doc_id for r in jaccard_join.least_rows(with_key(docs, "doc_id", "text"), k, num, 100).collect()}
    assert kept == {r for _, _, r in wanted}
