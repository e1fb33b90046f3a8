"""Sharding, packing and the whole pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import frame, texts
from tests.llm.test_dedup import fingerprint, least_reachable
from tests.llm.test_scans import base_spans
from tidewick.llm import packing, queries, sharding
from tidewick.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 37, 101, 1023, 5000])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n)).collect()]
    assert sorted(got) == list(range(n))
    assert n < 100 or sum(a == b for a, b in enumerate(got)) < n / 10


def places(rows):
    return sorted(((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in rows), key=repr)


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 7)
    rows = texts(3) + [(None, None), (None, "x"), (4, "é"), (4, "é"), (4, "é")]
    got = sharding.shards(frame(spark, rows), 6).collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows if d is not None)
    count = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(count.values()) - min(count.values()) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shards(frame(spark, rows[::-1]).repartition(5), 6).collect()
    assert places(again) == places(got)  # whatever the order and the partitions
    assert sharding.shards(frame(spark, []), 6).collect() == []


def test_sharding_query(spark):
    rows = queries.op5_feistel_sharding(spark, "/root/testdata/sf0.01").collect()
    assert set(Counter(r.shard for r in rows).values()) == {25} and {r.law for r in rows} == {"rows"}


def whole_ids(texts_):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(tokenizer_path())
    return [[*e.ids, 1] for e in coder.encode_batch(list(texts_), add_special_tokens=False)]


def check_pieces(pieces, docs, capacity):
    """Pieces give every text's ids, and sequences are gapless and not too long."""
    ids = dict(zip((d for d, _ in docs), whole_ids(t or "" for _, t in docs)))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(ids)
    for d, parts in by_doc.items():
        parts.sort(key=lambda p: p.piece)
        at = 0
        for n, p in enumerate(parts):
            data = np.array(ids[d][at:at + capacity], "<u4")
            assert (p.piece, p.start, p.length, p.ids_crc32) == (n, at, len(data), zlib.crc32(data.tobytes()))
            at += len(data)
        assert at == len(ids[d])
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
    return len(by_sequence), -(-sum(p.length for p in pieces) // capacity)


def test_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 12)
    odd = ["<|endoftext|> a<|startoftext|>b", "İstanbul ǅ ΑΣ. ß'S we'LL 12.5 «x»!", "é    x", "日本語 中文",
           "a" * 5000, "I'm!'s 'tis \x85 \x1c b"]
    docs = [(d, t) for d, t in texts(7) if d is not None] + [(5000 + i, t) for i, t in enumerate(odd)]
    got = packing.packed_sequences(frame(spark, docs), tokenizer_path(), capacity=64).collect()
    used, bound = check_pieces(got, docs, 64)
    assert used <= bound + 2
    assert packing.packed_sequences(frame(spark, []), tokenizer_path()).collect() == []
    twice = packing.packed_sequences(frame(spark, [(None, "a"), (None, "a"), (1, None)]), tokenizer_path()).collect()
    assert [r.length for r in sorted(twice, key=lambda r: r.length)] == [1, 2, 2]


def test_another_tokenizer(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    ids = Tokenizer.from_file(path).encode("The  text, and\nmore", add_special_tokens=False).ids + [1]
    row = packing.packed_sequences(frame(spark, [(1, "The  text, and\nmore")]), path).first()
    assert (row.length, row.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def fewest(lengths, capacity):
    """The least number of sequences, by trying everything."""
    lengths, best = sorted(lengths, reverse=True), len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in set(rooms):
            if r >= lengths[i]:
                rest = list(rooms)
                rest.remove(r)
                place(i + 1, rest + [r - lengths[i]])
        place(i + 1, rooms + [capacity - lengths[i]])

    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_sets():
    rng = random.Random(1)
    better = 0
    for _ in range(150):
        capacity = rng.choice([10, 20, 60])
        lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randint(1, 11))])
        solver = packing.Pack(lengths, capacity)
        simple, got = len(solver.best_fit()), solver.solve()
        assert Counter(x for s in got for x in s) == Counter(lengths.tolist())
        assert all(sum(s) <= capacity for s in got) and len(got) <= simple
        assert len(got) == fewest(lengths.tolist(), capacity)
        better += len(got) < simple
    hard = packing.Pack(np.array([6, 5, 5, 4, 4, 3, 3, 3, 3] * 3), 12)
    assert len(hard.solve()) == hard.bound


def test_pipeline_stages(spark):
    """Every stage against what its rule says of its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns
        rows[name] = {r.doc_id: r for r in out.collect()}
        docs = out
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    all_ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    judged = [(d in rows["quality"]) == bool(q) for d, q in quality.items() if d in all_ids]
    assert np.mean(judged) > 0.9
    prints = {d: fingerprint(r.text) for d, r in rows["quality"].items()}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    assert set(rows["near_dedup"]) == set(least_reachable(prints, links).values())
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {d for d, r in rows["near_dedup"].items() if not any(x in " ".join(r.text.lower().split()) for x in items)}
    assert set(rows["decontaminate"]) <= left and len(left) - len(rows["decontaminate"]) <= 1
    assert set(rows["redact_secrets"]) == set(rows["decontaminate"])
    for d, r in rows["redact_secrets"].items():
        before = rows["decontaminate"][d]
        assert not base_spans(r.text) and (r.text == before.text or base_spans(before.text))
    packed = corpus_pipeline.run(spark, SF).collect()
    check_pieces(packed, [(d, r.text) for d, r in rows["redact_secrets"].items()], 4096)


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []
