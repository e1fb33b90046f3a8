"""Repeated passages, repeated bytes, near copies and components against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.llm.cases import frame, texts, words
from tidewick.llm import phrases, queries, simhash, suffixes
from tidewick.llm.components import components


def without_repeats(rows, window):
    seen, out = {}, {}
    for doc, text in sorted(rows):
        w = words(text)
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                keep[i:i + window] = [False] * window
            seen.setdefault(key, (doc, i))
        left = " ".join(x for x, k in zip(w, keep) if k)
        out[doc] = (len(w), keep.count(False), hashlib.sha256(left.encode()).hexdigest())
    return out


@pytest.mark.parametrize("window,seed", [(20, 1), (8, 2)])
def test_phrases(spark, window, seed):
    rows = texts(seed)
    got = phrases.repeated_phrases(frame(spark, rows), window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == without_repeats(rows, window)
    assert len(got) == len(rows)


def test_phrases_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PASSAGES_PER_TASK", 2)
    monkeypatch.setattr(phrases, "SHINGLES_PER_AUTOMATON", 3)
    rows = texts(5, n=60, chunks=3)
    got = phrases.repeated_phrases(frame(spark, rows), 10).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == without_repeats(rows, 10)


def test_phrases_hot_shingle_is_divided(spark, monkeypatch):
    window, phrase = 10, [f"h{i}" for i in range(7)]
    bodies = [[f"a{i}x{k}" for k in range(9)] + phrase + [f"b{i}x{k}" for k in range(9)] for i in range(30)]
    rows = [(n, " ".join(bodies[n % 30] if n % 2 else bodies[n % 30][:13] + bodies[n % 7][13:])) for n in range(90)]
    batch = pa.RecordBatch.from_pylist([
        {"_key": n, "_id": n, "text": t, "passages": [{"lo": 6, "hi": 9, "gram": 5, "own": True, "parts": 40}]}
        for n, t in rows])
    got = [r for b in phrases._passages(window)(iter([batch])) for r in b.to_pylist()]
    runs = {(n, o): " ".join(t.split()[o:o + window]).encode() for n, t in rows for o in range(6, 10)}
    for kind in (0, 1):
        assert sorted((r["_id"], r["lo"], r["words"]) for r in got if r["kind"] == kind) == sorted(
            (*k, w) for k, w in runs.items())
    assert len({(r["words"], r["part"]) for r in got}) == len({r["words"] for r in got})
    assert len({r["part"] for r in got}) > 20
    monkeypatch.setattr(phrases, "PASSAGES_PER_TASK", 4)
    out = phrases.repeated_phrases(frame(spark, rows), window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out} == without_repeats(rows, window)


def test_phrases_odd_rows(spark):
    long = " ".join(f"u{i}" for i in range(30))
    rows = [(1, long), (1, long), (None, long), (None, None), (2, "x " + long)]
    got = {(r.doc_id, r.n_words): r.n_removed for r in phrases.repeated_phrases(frame(spark, rows)).collect()}
    assert got == {(1, 30): 0, (None, 30): 30, (None, 0): 0, (2, 31): 30}
    assert phrases.repeated_phrases(frame(spark, [])).collect() == []
    assert phrases.repeated_phrases(frame(spark, [(1, "short")])).first().n_removed == 0


def cut_bytes(rows, depth):
    count = {}
    for _, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - depth + 1):
            count[b[i:i + depth]] = count.get(b[i:i + depth], 0) + 1
    out = []
    for doc, text in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - depth + 1):
            if count[b[i:i + depth]] > 1:
                gone[i:i + depth] = b"\1" * depth
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("depth,seed", [(120, 3), (200, 4)])
def test_suffixes(spark, depth, seed):
    rows = texts(seed, n=60)
    rng = random.Random(seed)
    for i in range(20):  # near copies: the same text with one changed place
        base = rows[i][1] or ""
        at = rng.randrange(len(base) + 1)
        rows.append((2000 + i, base[:at] + "#" + base[at:]))
    rows += [(7, rows[0][1]), (None, rows[1][1]), (None, None), (9, "a" * 700), (10, "ab" * 400)]
    got = suffixes.repeated_bytes(frame(spark, rows), depth).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((tuple(r) for r in got), key=repr) == cut_bytes(rows, depth)


def test_suffixes_empty(spark):
    assert suffixes.repeated_bytes(frame(spark, [])).collect() == []
    row = suffixes.repeated_bytes(frame(spark, [(1, "short"), (1, "short")])).first()
    assert (row.n_removed, row.n_spans, row.kept_bytes) == (0, 0, None)


def fingerprint(text):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(ids, links):
    top = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(top[a], top[b])
            if top[a] != m or top[b] != m:
                top[a] = top[b] = m
                changed = True
    return top


def test_near_copies(spark):
    rng = random.Random(8)
    rows = texts(9, n=30)
    for i in range(60):
        w = (rows[i % 8][1] or "").split()
        for _ in range(rng.randint(0, 3)):
            if w:
                w[rng.randrange(len(w))] = "edited"
        rows.append((3000 + i, " ".join(w)))
    prints = {d: fingerprint(t) for d, t in rows}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = least_reachable(prints, links)
    got = simhash.near_copies(frame(spark, rows)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        d: (f"{prints[d]:016x}", want[d]) for d in prints}
    kept = {r.doc_id for r in simhash.one_of_each(frame(spark, rows + rows[:5])).collect()}
    assert kept == set(want.values())


def test_links_of_a_hot_key(spark, monkeypatch):
    """Many fingerprints with common bytes, in several blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 40)
    rng = np.random.default_rng(1)
    base = np.uint64(0x0123456789ABCDEF)
    prints = {int(base ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False))))
              for _ in range(300)}
    rows = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print long")
    got = [(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.links(rows).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in got)
    every = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 4]
    assert least_reachable(prints, got) == least_reachable(prints, every)


def test_any_bytes_that_are_shared_meet_in_a_key():
    for shared in itertools.combinations(range(8), 4):
        assert any(set(places) <= set(shared) for places in simhash.PLACES)
    assert len(simhash.PLACES) == 20


def test_pairs_that_share_too_few_bytes_are_dropped():
    """Three equal bytes let a pair meet; the tally over all eight tells it from one with four."""
    base = 0x1122334455667788
    near, far = base ^ 0x01_01_01_01_00_00_00_00, base ^ 0x01_01_01_01_01_00_00_00
    other = np.array([base, near, far], np.uint64)
    assert simhash._near(np.uint64(base), other).tolist() == [True, True, False]


def test_near_copies_odd_rows(spark):
    rows = [(4, "a b c d e"), (4, "a b c d e"), (None, "a b c d e"), (None, "other words than these"), (6, None), (7, "")]
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_copies(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(4, 4), (4, 4), (None, 4), (None, None), (6, 6), (7, 6)], key=repr)
    assert simhash.one_of_each(frame(spark, rows)).count() == 3
    assert simhash.near_copies(frame(spark, [])).collect() == []


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)]
    links += [(300, 300), (None, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if None not in (a, b) and a != b]
    assert got == least_reachable({x for p in real for x in p}, real)


def test_queries_at_the_smallest_scale(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: tuple(r)[1:] for r in queries.op1_substring_dedup(spark, sf).collect()}
    assert got == without_repeats(rows, 20)
    assert sorted((tuple(r) for r in queries.op6_suffix_array_dedup(spark, sf).collect()), key=repr) == cut_bytes(rows, 400)
    prints = {d: fingerprint(t) for d, t in rows}
    got = {r.doc_id: r.fingerprint for r in queries.op4_simhash_near_dedup(spark, sf).collect()}
    assert got == {d: f"{p:016x}" for d, p in prints.items()}
