"""The trie against a plain Python n-gram model, and the sums of its contexts."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from spanforge.llm import ngram_trie
from spanforge.llm import words as W
from spanforge.llm.elias_fano import Monotone, encode

END = " "


def texts(seed=3, n=120):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(400)]
    rows = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(n)]
    return [*rows, *rows[:7], "", None, "a A a", "hot hot " * 60]


class Plain:
    """The model by its formula, in dicts."""

    def __init__(self, docs):
        self.counts = [Counter(), Counter(), Counter()]
        for words in docs:
            for n in range(3):
                self.counts[n].update(tuple(words[i : i + n + 1]) for i in range(len(words) - n))
        self.followers = defaultdict(list)
        for table in self.counts[1:]:
            for gram, n in table.items():
                self.followers[gram[:-1]].append((gram[-1], n))
        self.total = sum(self.counts[0].values()) + len(self.counts[0]) + 1

    def p(self, context, word):
        if not context:
            return (self.counts[0][(word,)] + 1) / self.total
        some = self.followers.get(context)
        if not some:
            return self.p(context[1:], word)
        parent = self.counts[len(context) - 1][context]
        share = sum((n - ngram_trie.DISCOUNT) / parent for w, n in some if w == word)
        return share + (1 - sum((n - ngram_trie.DISCOUNT) / parent for _, n in some)) * self.p(context[1:], word)

    def score(self, words):
        return sum(math.log10(self.p(tuple(words[max(0, i - 2) : i]), w)) for i, w in enumerate(words))


@pytest.mark.parametrize("hot", [None, 20])
def test_scores_are_those_of_a_plain_model(spark, hot):
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    # With a small shard, contexts that are met more often are summed in salted parts first.
    trie = ngram_trie.train(docs.where("doc_id % 4 <> 1"), **({"shard": hot} if hot else {}))
    assert trie.hot.any() == bool(hot)
    words = [[*(x or "").lower().split(), END] for x in rows]
    plain = Plain([w for i, w in enumerate(words) if i % 4 != 1])
    for r in ngram_trie.score(docs, trie, ["doc_id"]).collect():
        own = words[r.doc_id]
        # Each token may lose less than two steps at each of two levels.
        assert plain.score(own) - 4 * ngram_trie.STEP * len(own) <= r.score <= plain.score(own) + 1e-6


def test_no_context_sums_to_more_than_one(spark):
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    trie = ngram_trie.train(docs, partitions=3)
    seen = sorted({w for x in rows for w in (x or "").lower().split()})
    hashes = np.concatenate([next(W.chunks(pa.array([" ".join(seen)]), True)).hashes, [ngram_trie.END]])
    for context in ("w1", "hot", seen[0], "zzz"):
        own = next(W.chunks(pa.array([context]), True)).hashes
        tokens = np.concatenate([[own[0], x] for x in hashes])
        begin = np.arange(0, len(tokens) + 1, 2)
        counts, _, _, levels = ngram_trie._walk(trie, tokens, begin, 3)
        value = np.log10((counts + 1) / (trie.tokens + trie.types + 1))
        place, which, got = levels[0]
        value[place] = np.where(got.node[which] >= 0, -ngram_trie.STEP * got.code[which], value[place] - ngram_trie.STEP * got.backoff[which])
        assert (10.0 ** value[place]).sum() <= 1


@pytest.mark.parametrize("universe, n", [(1 << 64, 900), (1000, 1000), (10**6, 300), (5, 100), (3, 0), (64000, 60000)])
def test_elias_fano_finds_what_bisection_finds(universe, n):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
    coded = Monotone(encode(values, universe))
    assert (coded.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe - 1, 2000, dtype=np.uint64, endpoint=True)])
    at = np.searchsorted(values, asked)
    there = at < n
    there[there] = values[at[there]] == asked[there]
    assert (coded.find(asked) == np.where(there, at, -1)).all()
