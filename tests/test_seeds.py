"""Extended hits against plain dynamic programming over whole sequences."""

import random
import re

import pytest

from spanforge.operators import seeds

S = seeds.Scoring()


def plain(query, subject):
    """Best local score with affine gaps, over all cells."""
    worst, cost, best = -(10**9), S.gap_open + S.gap_extend, 0
    h, f = [0] * (len(subject) + 1), [worst] * (len(subject) + 1)
    for a in query:
        now, e = [0] * (len(subject) + 1), worst
        for j, b in enumerate(subject, 1):
            e = max(now[j - 1] - cost, e - S.gap_extend)
            f[j] = max(h[j] - cost, f[j] - S.gap_extend)
            now[j] = max(0, h[j - 1] + (S.match if a == b and a != "N" else S.mismatch), e, f[j])
            best = max(best, now[j])
        h = now
    return best


def flipped(seq):
    return seq[::-1].translate(str.maketrans("ACGTN", "TGCAN"))


def of_alignment(q, s):
    """Score of two aligned strings."""
    total = sum(0 if "-" in (a, b) else S.match if a == b != "N" else S.mismatch for a, b in zip(q, s, strict=True))
    for text in (q, s):
        for part in re.findall("-+", text):
            total -= S.gap_open + S.gap_extend * len(part)
    return total


def bases(draw, n):
    return "".join(draw.choices("ACGT", k=n))


def changed(draw, seq):
    """With two substitutions and a gap of up to three letters, apart from each other."""
    out = list(seq)
    for k in (15, len(seq) - 15):
        out[k] = draw.choice([x for x in "ACGT" if x != out[k]])
    at, n = len(seq) // 2, draw.randrange(4)
    return "".join(out[:at]) + (bases(draw, n) if draw.random() < 0.5 else "") + "".join(out[at + (n if draw.random() < 0.5 else 0) :])


@pytest.mark.parametrize("seed", [1, 2])
def test_hits_have_the_scores_of_plain_dynamic_programming(spark, seed):
    draw = random.Random(seed)
    queries = {k: bases(draw, n) for k, n in enumerate((60, 75, 90, 40))} | {9: "NNNN", 10: ""}
    subjects = {}
    for k in range(24):
        own = draw.choice([q for q in queries.values() if len(q) > 30])
        planted = changed(draw, own) if k % 3 else own
        subjects[k] = bases(draw, draw.randrange(50)) + (flipped(planted) if k % 2 else planted) + bases(draw, draw.randrange(50))
    subjects |= {90: "", 91: None, 92: bases(draw, 9000) + queries[2] + bases(draw, 20)}
    a = spark.createDataFrame(list(subjects.items()), "id int, seq string")
    b = spark.createDataFrame(list(queries.items()), "item_id int, seq string")
    hits = seeds.extended_hits(a, b).collect()
    best = {}
    for r in hits:
        subject, query = subjects[int(r.seqid)], queries[int(r.query)]
        assert of_alignment(r.qseq, r.sseq) == r.score and len(r.qseq) == r.alignment_length
        assert r.sseq.replace("-", "") == subject[r.start1 - 1 : r.end1] and r.subject_length == len(subject)
        part = query[r.qstart - 1 : r.qend]
        assert r.qseq.replace("-", "") == (part if r.strand == "+" else flipped(part))
        key = (int(r.seqid), int(r.query), r.strand)
        best[key] = max(best.get(key, 0), r.score)
    assert len(hits) == len(set(hits))
    for k, subject in subjects.items():
        for n, query in queries.items():
            for strand, q in (("+", query), ("-", flipped(query))):
                want = plain(q, subject or "") if k != 92 or n == 2 else None
                if want is not None and want >= 22:  # long enough for a seed within the best alignment
                    assert best.get((k, n, strand)) == want
    assert {(92, 2, "+")} <= set(best)


def test_runs_of_seeds(spark):
    a, b = spark.createDataFrame([(1, "AACCGGTTACGT")], "id int, seq string"), spark.createDataFrame([(5, "CCGGTTGCGT")], "item_id int, seq string")
    got = {(r.diagonal, r.q_from, r.q_to) for r in seeds.seed_runs(a, b, 3).collect()}
    assert {(2, 1, 6), (2, 8, 10)} <= got and all(y - x >= 2 for _, x, y in got)
