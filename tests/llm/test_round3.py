"""Vector codes, licence scans and hard negatives: brute force on small tables, awkward rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanforge.llm import delta_lloyd, licence_index, voronoi_negatives

NAN, INF = float("nan"), float("inf")


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, kept string, row int, code string")


def _random(n, dims, seed, copies=0):
    draw = random.Random(seed)
    rows = [(k, draw.randrange(3) if draw.random() > 0.1 else None, [round(draw.gauss(0, 0.3), 3) for _ in range(dims)], "x", 1, "y") for k in range(n)]
    return rows + [(n + k, k % 3, rows[0][2], "x", 1, "y") for k in range(copies)]


AWKWARD = [(900, 1, None, "", 0, ""), (901, 1, [0.1, None, 0.2, 0.3], "", 0, ""), (902, 1, [NAN, 0.0, 0.0, 0.0], "", 0, ""), (903, 1, [INF, 0.0, 0.0, 0.0], "", 0, ""), (None, 2, [0.5, 0.5, 0.5, 0.5], "", 0, ""), (904, 2, [0.5], "", 0, ""), (905, None, [], "", 0, ""), (906, 1, [1e30, -1e30, 0.0, 0.0], "", 0, ""), (906, 1, [1e30, -1e30, 0.0, 0.0], "", 0, "")]


def _ints(vector, scale, clamp, width):
    import math

    import numpy as np

    return [max(-clamp, min(clamp, math.floor(float(np.float32(x)) * scale))) for x in vector] + [0] * (width - len(vector))


def _good(vector):
    return vector is not None and all(x is not None and x == x and abs(x) != INF for x in vector)


def _lloyd(rows, parts, entries, rounds):
    """A plain Lloyd iteration, which sums all parts anew each round."""
    kept = [r for r in rows if _good(r[2])]
    width = -(-max(len(r[2]) for r in kept) // parts)
    ints = [_ints(r[2], 1024, delta_lloyd.CLAMP, parts * width) for r in kept]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    start = sorted((r[0], v) for r, v in zip(kept, ints, strict=True) if r[0] is not None)[:entries]
    books = [[cut(v, p) for _, v in start] for p in range(parts)]
    near = lambda x, p: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))
    for turn in range(rounds + 1):
        codes = [[near(cut(v, p), p) for p in range(parts)] for v in ints]
        for p in range(parts if turn < rounds else 0):
            for e in range(len(books[p])):
                own = [cut(v, p) for v, c in zip(ints, codes, strict=True) if c[p][1] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return Counter((r[0], r[1], bytes(e for _, e in c), sum(d for d, _ in c)) for r, c in zip(kept, codes, strict=True)), books


@pytest.mark.parametrize("dims, parts, entries, extra", [(8, 4, 16, []), (4, 2, 5, AWKWARD), (6, 4, 300, [])])
def test_delta_lloyd_against_plain_lloyd(spark, dims, parts, entries, extra):
    rows = _random(120, dims, dims, copies=40) + extra
    entries = min(entries, 256)
    table, books = delta_lloyd.fit_codes(_vectors(spark, rows).repartition(5), ["vec_id", "label", "code"], parts=parts, entries=entries)
    want, plain = _lloyd(rows, parts, entries, delta_lloyd.ROUNDS)
    assert books.tolist() == plain and table.columns == ["vec_id", "label", "code", "error"]
    assert Counter((r.vec_id, r.label, bytes(r.code), r.error) for r in table.collect()) == want
    for limit in (10, 0):
        sums = delta_lloyd.with_group_sum(table, "label", "error", "label_error", limit).collect()
        total = Counter()
        for r in sums:
            total[r.label] += r.error
        assert len(sums) == sum(want.values()) and all(r.label_error == total[r.label] for r in sums)


def test_group_sums_of_rare_keys_shuffle(spark, monkeypatch):
    monkeypatch.setattr(delta_lloyd, "HOT", 4)
    table = spark.createDataFrame([(k if k < 20 else 99 if k < 60 else None, k) for k in range(80)], "label int, error long")
    got = {r.label: r.s for r in delta_lloyd.with_group_sum(table, "label", "error", "s", 0).collect()}
    assert got == {k: k for k in range(20)} | {99: sum(range(20, 60)), None: sum(range(60, 80))}


def test_delta_lloyd_moves_only_what_changed(spark):
    """After the first round fewer parts are shuffled, and a settled table needs no further round."""
    rows = [(k, 0, [float(k % 4), 0.0, 0.0, 0.0], "", 0, "") for k in range(40)]
    table, books = delta_lloyd.fit_codes(_vectors(spark, rows), ["vec_id"], parts=1, entries=4)
    assert sorted(x[0] for x in books[0].tolist()) == [0, 1024, 2048, 3072] and {r.error for r in table.collect()} == {0}
    state = spark.createDataFrame([([1, 2], b"\x00", b"\x00"), ([3, 4], b"\x00", b"\x01"), ([5, 6], None, b"\x01")], "vector array<int>, before binary, code binary")
    moves = {(r.part, r.entry): (r.n, r.s0, r.s1) for r in delta_lloyd._moves(state, 1, 2, 2).collect()}
    assert moves == {(0, 0): (-1, -3, -4), (0, 1): (2, 8, 10)}


def test_delta_lloyd_without_rows_or_ids(spark):
    empty, _ = delta_lloyd.fit_codes(_vectors(spark, []), ["vec_id"])
    assert empty.count() == 0 and empty.columns == ["vec_id", "code", "error"]
    bare, _ = delta_lloyd.fit_codes(_vectors(spark, [(None, 1, [0.1] * 4, "", 0, "")]), ["vec_id"])
    assert [(r.code, r.error) for r in bare.collect()] == [(None, None)]


def _negatives(rows, every, k, low, high):
    kept = [(n, r[0], r[1], r[2]) for n, r in enumerate(rows) if r[1] is not None and _good(r[2])]
    width = max(len(r[3]) for r in kept)
    kept = [(n, i, label, _ints(v, 256, voronoi_negatives.CLAMP, width)) for n, i, label, v in kept]
    late = lambda i: (i is None, i or 0)
    out = Counter()
    for n, i, label, v in kept:
        if i is None or i % every:
            continue
        scored = [(sum(a * b for a, b in zip(v, x[3], strict=True)), x) for x in kept if x[0] != n]
        first = lambda x: (-x[0], late(x[1][1]))
        for p, x in sorted((s for s in scored if s[1][2] == label), key=first)[:k]:
            fits = sorted((s for s in scored if s[1][2] != label and low * p <= 100 * s[0] <= high * p), key=first)[:k]
            out.update((i, x[1], rank, y[1], p, s) for rank, (s, y) in enumerate(fits, 1))
    return out


@pytest.mark.parametrize("dims, group, extra", [(2, 4, AWKWARD), (8, 2048, []), (3, 1, [])])
def test_voronoi_negatives_against_brute_force(spark, monkeypatch, dims, group, extra):
    monkeypatch.setattr(voronoi_negatives, "GROUP", group)
    monkeypatch.setattr(voronoi_negatives, "PIVOTS", 8)
    rows = _random(150, dims, dims + 1, copies=60) + extra
    got = voronoi_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") % 10 == 0)
    want = _negatives(rows, 10, 5, 80, 100)
    assert want and Counter(map(tuple, got.collect())) == want


def test_cells_spare_groups_rows_they_cannot_serve(spark, monkeypatch):
    """Two far clusters: rows go to the groups of their own cluster only."""
    monkeypatch.setattr(voronoi_negatives, "GROUP", 4)
    draw = random.Random(5)
    rows = [(k, k // 2 % 2, [8.0 * (k % 2) + draw.random(), 8.0 * (1 - k % 2) + draw.random()], "", 0, "") for k in range(200)]
    sent, route = [], voronoi_negatives._routed
    monkeypatch.setattr(voronoi_negatives, "_routed", lambda placed, bounds, blocks: sent.append((route(placed, bounds, blocks).count(), len(bounds[0]))) or route(placed, bounds, blocks))
    got = Counter(map(tuple, voronoi_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") % 5 == 0).collect()))
    assert got == _negatives(rows, 5, 5, 80, 100)
    assert all(copies <= 0.75 * groups * len(rows) for copies, groups in sent)


def test_negatives_without_anchors_or_rows(spark):
    for rows in ([], [(1, 0, [1.0, 2.0], "", 0, "")], AWKWARD[:4]):
        assert voronoi_negatives.hard_negatives(_vectors(spark, rows), F.col("vec_id") % 100 == 0).count() == 0


def _words(text):
    import re

    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _scan(text, templates):
    words, found = _words(text), []
    for label, passage, keys, base in templates:
        own = passage.split()
        for start in range(-len(own), len(words)):
            inside = [0 <= start + q < len(words) and words[start + q] == w for q, w in enumerate(own)]
            must = {q for key in (k.split() for k in keys) for at in [next(i for i in range(len(own)) if own[i : i + len(key)] == key)] for q in range(at, at + len(key))}
            if all(inside[q] for q in must) and sum(inside) >= licence_index.COVER * len(own):
                found.append((start, label, base, sum(inside) / len(own)))
    base = sorted(x[0] for x in found if x[2])
    join = lambda x: ",".join(sorted(set(x)))
    return len(words), len(base), *((base[0], base[-1]) if base else (None, None)), join(x[1] for x in found if x[2]), join(x[1] for x in found), max([x[3] for x in found], default=0.0)


def test_licence_index_against_brute_force(spark):
    draw = random.Random(2)
    pool = [w for t in licence_index.TEMPLATES for w in t.text.split()] + ["é", "x1"]
    texts = [None, "", " .,- ", "All Rights  Reserved", "cc-by cc by cc", "reserved all rights", "All rights reserved. " * 3000, "word " * 60_000 + "Released under the MIT License.", "É all rights reservedé"]
    for t in licence_index.TEMPLATES:
        words = t.text.split()
        for _ in range(4):
            kept = [w if draw.random() > 0.15 else draw.choice(pool) for w in words]
            texts.append(" ".join([*draw.choices(pool, k=draw.randrange(4)), *kept, *draw.choices(pool, k=draw.randrange(4))]))
        texts += [t.text.upper(), " ".join(words[len(words) // 3 :]), " ".join(words[: -len(words) // 3])]
    rows = [(k, t, "m", 5, "z") for k, t in enumerate(texts)] + [(3, texts[3], "m", 5, "z"), (None, texts[3], "m", 5, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string, n_words int, score string")
    index, idf = licence_index.build_index(docs)
    assert idf["fee"] > idf["license"]
    got = licence_index.scan(docs.repartition(3), index, ["doc_id", "matches", "n_words"])
    assert got.columns[:2] == ["doc_id", "n_words"] and got.columns.count("matches") == 1
    want = Counter((k, *_scan(t, licence_index.TEMPLATES)) for k, t, *_ in rows)
    assert Counter(tuple(r)[:-1] for r in got.collect()) == want
    assert licence_index.scan(docs.where("false"), licence_index.build_index(docs.where("false"))[0], ["doc_id"]).count() == 0


def test_key_phrases_must_be_in_their_template():
    with pytest.raises(ValueError, match="not in its template"):
        licence_index.key_places(licence_index.Template("x", "a b c", ("a c",)))


def test_items_without_ids_contaminate(spark):
    from spanforge.llm import spaced_seeds

    text = "a b c d e f g h i j k l m n"
    docs = spark.createDataFrame([(1, "x " + text, "p"), (2, "clean words here", "q"), (None, text, "r")], "doc_id long, text string, item_id string")
    items = spark.createDataFrame([(None, text), (None, text), (4, None), (5, text.replace("c", "z"))], "item_id long, text string")
    for rows in (10**6, 8):  # one block of the benchmark, and several
        got = Counter((r.doc_id, r.item_id, r.start) for r in spaced_seeds.contaminated(docs, items, seed_rows=rows).collect())
        assert got == {(1, None, 1): 2, (None, None, 0): 2, (1, 5, 1): 1, (None, 5, 0): 1}
    assert [r.doc_id for r in spaced_seeds.decontaminate(docs, items.where("item_id is null")).collect()] == [2]
