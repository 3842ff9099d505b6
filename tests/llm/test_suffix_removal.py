"""Words removed, against every window of a small table, with and without anchors that count as hot."""

import random

import pytest

from spanforge.llm import suffix_removal

WINDOW = suffix_removal.WINDOW


def _plain(rows):
    """doc_id, n_words, n_removed and kept words of every row: a window goes if it starts in a smaller document too."""
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, words in texts:
        for k in range(len(words) - WINDOW + 1) if d is not None else ():
            w = tuple(words[k : k + WINDOW])
            first[w] = min(first.get(w, d), d)
    out = []
    for d, words in texts:
        starts = [k for k in range(len(words) - WINDOW + 1) if d is not None and first[tuple(words[k : k + WINDOW])] < d]
        gone = {k + i for k in starts for i in range(WINDOW)}
        out.append((d, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out, key=str)


def _rows():
    """Passages met with ever other neighbours, parts of them, copies, one word over and over, and defined cases."""
    draw = random.Random(5)
    passages = [[f"p{k}w{draw.randrange(9)}" for _ in range(25)] for k in range(3)]
    rows = []
    for d in range(60):
        words = [f"v{draw.randrange(40)}" for _ in range(draw.randrange(30))]
        for passage in draw.sample(passages, draw.randrange(1, 3)):
            begin = draw.randrange(8)
            at = draw.randrange(len(words) + 1)
            words[at:at] = passage[begin : begin + draw.randrange(12, 20)]
        rows.append((d * 3 % 61, "\n ".join(words)))
    return rows + [(70, rows[0][1]), (70, rows[1][1]), (71, "so " * 40), (72, "so " * 33), (73, None), (74, ""), (None, rows[0][1]), (75, "é x " + " ".join(passages[0]))]


@pytest.mark.parametrize("hot", [0, 3, suffix_removal.HOT])
def test_hot_anchors(spark, hot):
    rows = _rows()
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, low int, anchor string").repartition(4)
    found = [(r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in suffix_removal.remove_repeats(docs, hot=hot).collect()]
    assert sorted(found, key=str) == _plain(rows)
    assert sum(r[2] for r in found) > 300


def test_hot_anchor_is_spread(spark):
    """No key holds more than one distinct segment where every anchor counts as hot."""
    rows = _rows()
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows if d is not None and t], "doc_id long, text string, text_key long")
    found = suffix_removal.spread(suffix_removal.segments(docs, WINDOW, None), WINDOW, 0)
    assert found.groupBy("anchor").agg({"segment": "approx_count_distinct"}).where("`approx_count_distinct(segment)` > 1").isEmpty()
