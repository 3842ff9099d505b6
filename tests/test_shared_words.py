"""Shared words against plain sets, and without a row for a word."""

import random

import pytest

from spanforge.operators import seeds


@pytest.mark.parametrize("size", [3, 7, 12, 33])
def test_shared_words_are_those_of_plain_sets(spark, size):
    draw = random.Random(size)
    bases = lambda n: "".join(draw.choices("ACGT", k=n))
    items = [(k, bases(90)) for k in range(12)] + [(3, bases(40)), (20, "NN"), (21, ""), (22, None), (23, "ACG\nTTTéAC")]
    subjects = [(k, bases(30) + "N" + draw.choice(items[:12])[1][20:80] + "acg" + bases(30)) for k in range(40)]
    subjects += [(5, items[0][1]), (50, ""), (51, None), (52, "NNN"), (None, items[1][1]), (None, items[2][1]), (53, "ACG\nTTTéACG"), (54, bases(4000))]

    def words(rows):
        out = {}
        for key, seq in rows:
            found = {(seq or "")[k : k + size] for k in range(len(seq or "") - size + 1)}
            out.setdefault(key, set()).update(x for x in found if not x.translate(str.maketrans("", "", "ACGT")))
        return out

    a, b = words(subjects), words(items)
    want = sorted((str(x), y, len(a[x] & b[y])) for x in a for y in b if a[x] & b[y])
    got = seeds.shared_words(spark.createDataFrame(subjects, "id long, seq string"), spark.createDataFrame(items, "item_id int, seq string"), size)
    assert sorted((str(r.id), r.item_id, r.n_words) for r in got.collect()) == want
    assert "Join" not in got._jdf.queryExecution().toString()


def test_shared_words_without_queries_are_none(spark):
    none = spark.createDataFrame([], "item_id int, seq string")
    assert not seeds.shared_words(spark.createDataFrame([("a", "ACGTACGT")], "id string, seq string"), none, 3).count()


@pytest.mark.parametrize("size", [3, 11])
def test_seeds_are_found_without_a_join(spark, monkeypatch, size):
    """Also those of a repeated word, in parts."""
    monkeypatch.setattr(seeds, "ROWS", 100)
    draw = random.Random(size)
    bases = lambda n: "".join(draw.choices("ACGT", k=n))
    items = [("a", bases(60)), ("b", "A" * 40), ("c", ""), ("d", None), ("e", bases(20) + "N" + bases(20))]
    subjects = [(1, bases(40) + items[0][1] + bases(9)), (2, "A" * 70), (3, ""), (4, None), (5, items[4][1]), (None, items[0][1]), (6, "ACGNNé" + items[0][1])]
    want = sorted((str(x), y, i - j, j + 1) for x, s in subjects for y, q in items for i in range(len(s or "") - size + 1) for j in range(len(q or "") - size + 1) if s[i : i + size] == q[j : j + size] and set(s[i : i + size]) <= set("ACGT"))
    got = seeds.seed_places(spark.createDataFrame(subjects, "id int, seq string"), spark.createDataFrame(items, "item_id string, seq string"), size)
    assert sorted((str(r.id), r.item_id, r.diagonal, r.q_at) for r in got.collect()) == want
    assert "Join" not in got._jdf.queryExecution().toString()
