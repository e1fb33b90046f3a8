"""Spelling variants against every pair of words."""

from collections import Counter
import random
import re
from zlib import crc32

import pytest

from tests.llm.cases import frame, texts
from tidewick.llm import queries, spelling


def plain_vocabulary(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(vocabulary, near_of=None):
    near = near_of or {w: [v for v in vocabulary if one_edit(w, v)] for w in vocabulary}
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda v: (-vocabulary[v], v), default=None)
        form[w] = best if best is not None and vocabulary[best] >= 10 * n else None
    out = set()
    for w, n in vocabulary.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), None if form[w] is None else vocabulary[form[w]]))
    return out


def got(df):
    rows = df.collect()
    out = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def variants_of(seed):
    """Texts over words, their misspellings and those of these, with counts that make chains of forms."""
    rng = random.Random(seed)
    letters = "abcdefgéÿÄ"
    words = ["".join(rng.choices(letters, k=rng.randint(6, 12))) for _ in range(25)] + ["aaaaaaaa", "aaaaaaab", "baaaaaaa", "abababab"]

    def changed(w):
        i, kind = rng.randint(0, len(w)), rng.randint(0, 2)
        return w[:i] + rng.choice(letters) + w[i + (kind == 0):] if kind else w[:i] + w[i + 1:]

    bag = []
    for w in words:
        bag += [w] * rng.choice([300, 120, 3])
        for v in [changed(w) for _ in range(6)]:
            bag += [v] * rng.choice([1, 2, 12, 30])
            bag += [changed(v)] * rng.choice([1, 2, 3])
    rng.shuffle(bag)
    rows = [(i, rng.choice([" ", "-", "1"]).join(x.upper() if rng.random() < 0.1 and x.isascii() else x for x in bag[i * 40:i * 40 + 40]))
            for i in range(len(bag) // 40 + 1)]
    return rows + [(None, None), (None, "abababab abababab"), (7, ""), (7, "abababab"), (7, "abababab"), (9, "×÷ 1")]


@pytest.mark.parametrize("seed,index,hot", [(1024, 1024, 4096), (8, 8, 3), (8, 1, 2)])
def test_against_all_pairs(spark, monkeypatch, seed, index, hot):
    monkeypatch.setattr(spelling, "INDEX", index)
    monkeypatch.setattr(spelling, "HOT", hot)
    rows = variants_of(seed)
    want = plain(plain_vocabulary(rows))
    assert got(spelling.variants(frame(spark, rows))) == want
    assert max(x[4] for x in want) > 5 and sum(x[1] is not None and x[1] != x[2] for x in want) > 0


def test_small_cases(spark):
    assert got(spelling.variants(frame(spark, []))) == set()
    assert got(spelling.variants(frame(spark, [(1, None), (2, ""), (3, "short ones")]))) == set()
    rows = texts(4)
    assert got(spelling.variants(frame(spark, rows))) == plain(plain_vocabulary(rows))


def test_very_long_words(spark):
    word = "".join(random.Random(1).choices("abcdefghij", k=3000))
    other = word[:1700] + "k" + word[1701:]
    rows = [(i, f"{word} {other} {word}") for i in range(40, 44)]
    assert got(spelling.variants(frame(spark, rows))) == plain(plain_vocabulary(rows))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    vocabulary = plain_vocabulary(rows)
    by_gap = {}
    for w in vocabulary:  # words one edit apart have a spelling with one letter left out, or less, in common
        for v in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            by_gap.setdefault(v, []).append(w)
    near = {w: [] for w in vocabulary}
    for group in by_gap.values():
        for w in group:
            near[w] += [v for v in group if v != w and one_edit(w, v)]
    near = {w: sorted(set(x)) for w, x in near.items()}
    assert got(queries.op12_spelling_variants(spark, sf)) == plain(vocabulary, near)
