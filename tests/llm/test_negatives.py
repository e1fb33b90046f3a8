"""Hard negatives against all pairs."""

from math import floor, inf, nan
import random

import duckdb
import numpy as np
import pytest

from tidewick.llm import negatives, oracle, queries

SCHEMA = "vec_id long, embedding array<float>, label int, _row string, id string, _group string, rank string"
CAP = (1 << 63) - 1


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "r", "i", "g", "k") for i, v, label in rows], SCHEMA)


def plain(rows, positives=5, negatives=5):
    """Rows without a vec_id come after the others; rows are told apart by their number."""
    sound = [(n, i, [floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i is not None and i % 7 == 0 else label)
             for n, (i, v, label) in enumerate(rows)
             if label is not None and v is not None and all(x is not None and abs(x) < inf for x in v)]

    def score(a, b):
        return max(-CAP, min(CAP, sum(x * y for x, y in zip(a, b))))

    def rank(s, i):
        return -s, i is None, i or 0

    out = []
    for n, i, v, label in sound:
        if i is None or i % 100:
            continue
        scores = [(score(v, w), j, own) for m, j, w, own in sound if m != n and len(w) == len(v)]
        best = sorted([x for x in scores if x[2] == label], key=lambda x: rank(x[0], x[1]))[:positives]
        for p, pid, _ in best:
            fit = [x for x in scores if x[2] != label and 80 * p <= 100 * x[0] <= 100 * p]
            for r, (s, nid, _) in enumerate(sorted(fit, key=lambda x: rank(x[0], x[1]))[:negatives], 1):
                out.append((i, pid, r, nid, p, s))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=repr)


def random_rows(seed, n, size, spread):
    """Vectors around a few centres, of very different lengths."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, size))
    rows = []
    for i in range(n):
        v = centres[i % 4] * (i % 3 > 0) + rng.normal(size=size) * spread
        v *= rng.choice([0.01, 1.0, 5.0])
        rows.append((int(rng.integers(0, 30) * 50 + i % 2), [float(x) for x in v], int(rng.integers(0, 3))))
    return rows


@pytest.mark.parametrize("seed,size,spread", [(1, 3, 0.1), (2, 8, 0.3), (3, 24, 0.05), (4, 1, 1.0)])
def test_against_all_pairs(spark, monkeypatch, seed, size, spread):
    for name, value in (("GROUP", 60), ("BLOCK", 7), ("BUCKET", 8)):
        monkeypatch.setattr(negatives, name, value)
    rows = [(i * 50, *r[1:]) for i, r in enumerate(random_rows(seed, 200, size, spread))]
    want = plain(rows)
    assert got(negatives.hard_negatives(table(spark, rows))) == want
    assert want


def test_pruning():
    """Candidates hold every row that reaches the cosine, and leave out most of the others."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(2000, 6))
    bucket, = negatives.buckets(rows)[:1]
    anchors = negatives.Anchors(rows[:20])
    for i in range(20):
        reached = (bucket.matrix @ anchors.matrix[i]) / anchors.length[i] / np.sqrt((bucket.matrix ** 2).sum(axis=1))
        for cosine in (0.2, 0.6, 0.95):
            found = bucket.candidates(anchors.unit[i], cosine, anchors.focus[i])
            found = np.arange(len(bucket.rows)) if found is None else found
            assert set(np.flatnonzero(reached >= cosine)) <= set(found.tolist())
            assert cosine < 0.9 or len(found) < len(bucket.rows) / 5


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (100, [0.0, 0.0], 2), (200, [0.5, 0.5], None), (300, None, 1),
            (400, [nan, 1.0], 1), (500, [inf, 1.0], 1), (600, [None, 1.0], 1), (800, [], 1), (801, [], 2), (900, [1.0, 2.0, 3.0], 1),
            (901, [1.0, 2.0, 3.0], 1), (902, [1.0, 2.0, 2.9], 2), (None, [1.0, 0.1], 1), (None, [0.9, 0.1], 2), (3, [0.9, 0.0], 2),
            (4, [0.9, 0.0], 2), (7, [0.9, 0.0], 1), (14, [0.9, 0.0], 0), (1000, [-1.0, 0.0], 3), (1001, [1.0, 0.0], 3),
            (1100, [3e38, 3e38], 4), (1101, [3e38, 3e38], 4), (1102, [3e38, 2e38], 5), (1200, [1e30, 1.0], 6), (1201, [1e-30, 1.0], 6)]
    assert got(negatives.hard_negatives(table(spark, rows))) == plain(rows)
    assert got(negatives.hard_negatives(table(spark, []))) == []
    assert got(negatives.hard_negatives(table(spark, rows[:1]))) == []


def test_repeated_and_tied(spark):
    rng = random.Random(2)
    rows = [(rng.choice([100, 200, 301, 402, 7]) + 7000 * rng.randint(0, 9), [float(rng.randint(-2, 2)) for _ in range(3)], rng.randint(0, 2))
            for _ in range(120)]
    # Of equal scores and equal ids any may be taken, so only the scores and ids are compared.
    assert got(negatives.hard_negatives(table(spark, rows))) == plain(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = sorted(con.execute(oracle.HARD_NEGATIVES).fetchall(), key=repr)
    assert got(queries.op13_hard_negatives(spark, sf)) == want and want
