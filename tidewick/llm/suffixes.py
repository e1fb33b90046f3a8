"""Repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are only told apart through their first ``depth`` bytes; those that stay together are the
repeated strings. A plain most-significant-digit sort would move every suffix in every pass, so the
digits are chosen such that neighbouring suffixes share them:

1. The first digit of a suffix is its least ``TOKEN``-byte token (a window minimiser over the depth),
   which about 150 neighbouring suffixes have in common. Tokens are counted; suffixes whose token is
   alone are settled.
2. The second digit is the whole stretch of suffixes with one token occurrence. A stretch found twice
   or more settles all its suffixes as repeated.
3. Only stretches that are alone, but share their token with others, go on, together with one
   representative of each stretch settled in pass 2. The third digit is taken for ``RUN`` neighbouring
   suffixes at once, at fixed distances from the token: all their bytes, and the core that they have in
   common. Equal in all bytes: all repeated. A core that is alone: none repeated.
4. What is left, a few suffixes around each place where copies part, is told apart by all ``depth`` bytes.

A digit is a 64-bit hash; a string must agree in the token's and in the last one. Groups are counted,
never collected, with partial sums before each shuffle, and the joins back are sort-merge joins that
adaptive execution can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import kept, kept_by, row_key
from tidewick.llm.textblock import Block, blocks, lists, selected, signed, stretches

TOKEN = 100
RUN = 16

_SCAN = "_key long, n_bytes long, sha string, tokens array<long>, at array<int>"


def _tokens(block: Block) -> np.ndarray:
    n = max(0, len(block.bytes) - TOKEN + 1)
    at = np.arange(n)
    return block.byte_hashes(at, at + TOKEN)


def _scan(depth: int):
    """Per text: size, digest, and the selected tokens with their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches):
            tokens = _tokens(block)
            first = np.append(block.begin, len(block.bytes))
            at = selected(tokens, first, TOKEN, depth, first[1:] - 1)
            cut = np.searchsorted(at, first).astype(np.int32)
            local = (at - np.repeat(first[:-1], np.diff(cut))).astype(np.int32)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "_key": batch.column("_key"),
                "n_bytes": pa.array(block.sizes),
                "sha": pa.array([hashlib.sha256(t).hexdigest() for t in block.texts]),
                "tokens": pa.ListArray.from_arrays(cut, signed(tokens[at])),
                "at": pa.ListArray.from_arrays(cut, local)})
    return run


def _starts(block: Block, depth: int) -> np.ndarray:
    """Where a suffix of at least ``depth`` bytes starts."""
    edge = np.zeros(len(block.bytes) + 1, np.int64)
    real = block.sizes >= depth
    edge[block.begin[real]] += 1
    edge[block.begin[real] + block.sizes[real] - depth + 1] -= 1
    return np.cumsum(edge)[:-1] > 0


def _stretches(depth: int):
    """Per text with recurring tokens: the stretches of suffixes that share a token occurrence."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches):
            local = lists(batch, "at")
            at = np.concatenate([p + b for p, b in zip(local, block.begin)] or [np.zeros(0, np.int64)])
            at = np.sort(at).astype(np.int64)
            values = block.byte_hashes(at, at + TOKEN)
            owner, lo, hi = stretches(at, values, _starts(block, depth), depth - TOKEN + 1)
            doc = np.searchsorted(block.begin, lo, "right") - 1
            yield pa.record_batch({
                "_key": batch.column("_key").take(pa.array(doc)),
                "copies": batch.column("copies").take(pa.array(doc)), "token": pa.array(signed(values[owner])),
                "at": pa.array((at[owner] - block.begin[doc]).astype(np.int32)),
                "digit": pa.array(signed(block.byte_hashes(lo, hi + depth))),
                "lo": pa.array((lo - block.begin[doc]).astype(np.int32)),
                "hi": pa.array((hi - block.begin[doc]).astype(np.int32))})
    return run


def _flat(batch: pa.RecordBatch, block: Block, *names: str) -> list[np.ndarray]:
    """The list columns laid end to end, after the number of the text of each entry."""
    sizes = [len(x) for x in lists(batch, names[0])]
    return [np.repeat(np.arange(len(block)), sizes),
            *[np.concatenate(lists(batch, c) or [np.zeros(0, np.int64)]).astype(np.int64) for c in names]]


def _ranges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of the given sizes end to end: the number of the range and the place in it."""
    cut = np.concatenate(([0], np.cumsum(sizes)))
    return np.repeat(np.arange(len(sizes)), sizes), np.arange(cut[-1]) - np.repeat(cut[:-1], sizes)


def _runs(depth: int):
    """The third digits of the given stretches, one row for a run of suffixes at most RUN long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches):
            doc, lo, hi, at, alone, token = _flat(batch, block, "lo", "hi", "at", "alone", "token")
            # Run number j holds the suffixes that start j * RUN to j * RUN + RUN - 1 bytes before the token.
            low, high = (at - hi) // RUN, (at - lo) // RUN
            which, j = _ranges(high - low + 1)
            j += low[which]
            doc, at = doc[which], at[which]
            last = np.minimum(at - j * RUN, block.sizes[doc] - depth)
            first = np.maximum(at - j * RUN - RUN + 1, 0)
            base = block.begin[doc]
            core = block.byte_hashes(base + at - j * RUN, base + at - j * RUN - RUN + 1 + depth)
            whole = block.byte_hashes(base + first, base + last + depth) + (at - first).astype(np.uint64)
            yield pa.record_batch({
                "_key": batch.column("_key").take(pa.array(doc)), "token": pa.array(token[which]),
                "run": pa.array(j.astype(np.int32)), "core": pa.array(signed(core)), "whole": pa.array(signed(whole)),
                "lo": pa.array(first.astype(np.int32)), "hi": pa.array(last.astype(np.int32)),
                "at": pa.array(at.astype(np.int32)), "alone": pa.array(alone[which].astype(bool))})
    return run


def _opened(depth: int):
    """The full digits of all suffixes of the given runs, one row for a run.

    A digit tells how far the token is as well: runs of two tokens can hold the same suffix, and it must
    not meet itself.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches):
            doc, lo, hi, at, alone, token = _flat(batch, block, "lo", "hi", "at", "alone", "token")
            which, i = _ranges(hi - lo + 1)
            start = block.begin[doc[which]] + lo[which] + i
            digits = block.byte_hashes(start, start + depth) + (at[which] - lo[which] - i).astype(np.uint64)
            cut = np.concatenate(([0], np.cumsum(hi - lo + 1))).astype(np.int32)
            yield pa.record_batch({
                "_key": batch.column("_key").take(pa.array(doc)), "token": pa.array(token),
                "lo": pa.array(lo.astype(np.int32)), "alone": pa.array(alone.astype(bool)),
                "digits": pa.ListArray.from_arrays(cut, signed(digits))})
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts without the bytes of the given runs."""
    for batch, block in blocks(batches):
        out: list[list] = [[], [], [], []]
        for text, runs in zip(block.texts, batch.column("runs").to_pylist()):
            gone = np.zeros(len(text) + 2, np.int8)
            edge = np.zeros(len(text) + 1, np.int64)
            np.add.at(edge, [r["lo"] for r in runs], 1)
            np.add.at(edge, [r["hi"] for r in runs], -1)
            gone[1:-1] = np.cumsum(edge)[:-1] > 0
            steps = np.flatnonzero(np.diff(gone))
            left = np.frombuffer(text, np.uint8)[gone[1:-1] == 0].tobytes()
            values = (len(text) - len(left), [{"lo": int(a), "hi": int(b)} for a, b in
                                              zip(steps[0::2], steps[1::2])],
                      hashlib.sha256(left).hexdigest(), left)
            for column, value in zip(out, values):
                column.append(value)
        spans = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
        yield pa.record_batch([batch.column("_key"), pa.array(out[0], pa.int64()), pa.array(out[1], spans),
                               pa.array(out[2]), pa.array(out[3], pa.binary())],
                              ["_key", "n_removed", "spans", "cut_sha", "kept_bytes"])


def repeated_bytes(docs: DataFrame, depth: int = 400) -> DataFrame:
    """Documents without the bytes covered by a ``depth``-byte string that starts anywhere else too.

    Returns doc_id, n_bytes, n_removed, spans (the removed runs as [lo, hi) of bytes), n_spans,
    kept_sha256 and kept_bytes, which is null where nothing was removed. One row per input row.

    Texts are taken as UTF-8, a null text as empty. Matches never cross documents; every place of a
    repeated string goes, the first too. Repeated rows repeat their strings, also with equal or missing
    doc_id. Texts shorter than ``depth`` stay whole; an empty table gives no rows; other columns are
    ignored.
    """
    if depth <= TOKEN:
        raise ValueError(f"depth must be over {TOKEN} bytes")
    rows = docs.select("doc_id", row_key().alias("_key"), "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_SCAN}"
    scan = kept(rows.mapInArrow(_scan(depth), schema), "suffix-scan")

    # Pass 1: by token. What a join only looks up is a table of its own: both sides are then dealt out for
    # the join, and adaptive execution can split a token that very many rows have.
    counts = kept(scan.select(F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n")).filter("n > 1").select("token"), "suffix-tokens")
    places = scan.select("_key", F.explode(F.arrays_zip("tokens", "at")).alias("p")).select(
        "_key", F.col("p.tokens").alias("token"), F.col("p.at").alias("at"))
    by_text = places.join(counts, "token").groupBy("_key").agg(F.collect_set("at").alias("at"))
    texts = rows.select("_key", "text").join(by_text, "_key").groupBy("_key").agg(
        F.first("text").alias("text"), F.first("at").alias("at"), F.count(F.lit(1)).alias("copies"))
    texts = kept_by(texts, "suffix-texts", "_key")

    # Pass 2: by stretch.
    stretch = kept(texts.mapInArrow(_stretches(depth), "_key long, copies long, token long, at int, digit long, lo int, hi int"),
                   "suffix-stretches")
    kinds = kept(stretch.groupBy("token", "digit").agg(
        F.sum("copies").alias("n"), F.min(F.struct("_key", "lo", "hi", "at")).alias("p")), "suffix-kinds")
    whole = kept(stretch.join(kinds.filter("n > 1").select("token", "digit"), ["token", "digit"]).select(
        "_key", "lo", (F.col("hi") + depth).alias("hi")), "suffix-whole")

    # Pass 3: by runs of suffixes, only where a stretch that is alone shares its token.
    mixed = kept(kinds.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).filter(
        "m > 1 AND least = 1").select("token"), "suffix-mixed")
    todo = kinds.join(mixed, "token").groupBy(F.col("p._key").alias("_key")).agg(
        F.collect_list(F.struct("p.lo", "p.hi", "p.at", "token", (F.col("n") == 1).alias("alone"))).alias("s"))
    parts = texts.select("_key", "text").join(todo, "_key").select(
        "_key", "text", *[F.col(f"s.{c}").alias(c) for c in ("lo", "hi", "at", "token", "alone")])
    parts = kept(parts.mapInArrow(_runs(depth), "_key long, token long, run int, core long, whole long, lo int, hi int, "
                                                "at int, alone boolean"), "suffix-runs")
    weight = F.sum(F.when(F.col("alone"), 1).otherwise(2)).alias("n")
    same = ["token", "run", "core", "whole"]
    groups = kept(parts.groupBy(*same).agg(weight, F.min(F.struct("_key", "lo", "hi", "at")).alias("p")), "suffix-groups")
    several = parts.filter("alone").join(groups.filter("n > 1").select(*same), same).select(
        "_key", "lo", (F.col("hi") + depth).alias("hi"))
    several = kept(several, "suffix-several")

    # Pass 4: by all the bytes, where runs agree in their core alone.
    torn = kept(groups.groupBy("token", "run", "core").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least"))
                .filter("m > 1 AND least = 1").select("token", "run", "core"), "suffix-torn")
    todo = groups.join(torn, ["token", "run", "core"]).groupBy(F.col("p._key").alias("_key")).agg(
        F.collect_list(F.struct("p.lo", "p.hi", "p.at", "token", (F.col("n") == 1).alias("alone"))).alias("s"))
    opened = texts.select("_key", "text").join(todo, "_key").select(
        "_key", "text", *[F.col(f"s.{c}").alias(c) for c in ("lo", "hi", "at", "token", "alone")])
    opened = kept(opened.mapInArrow(_opened(depth), "_key long, token long, lo int, alone boolean, "
                                                    "digits array<long>"), "suffix-digits")
    found = kept(opened.select("token", "alone", F.explode("digits").alias("digit")).groupBy("token", "digit").agg(
        weight).filter("n > 1").select("token", "digit"), "suffix-found")
    start = F.col("lo") + F.col("i")
    single = opened.filter("alone").select("_key", "token", "lo", F.posexplode("digits").alias("i", "digit")).join(
        found, ["token", "digit"]).select("_key", start.alias("lo"), (start + depth).alias("hi"))
    single = kept(single, "suffix-single")

    runs = whole.union(several).union(single).groupBy("_key").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))
    cut = texts.select("_key", "text").join(runs, "_key").mapInArrow(
        _cut, "_key long, n_removed long, spans array<struct<lo: int, hi: int>>, cut_sha string, "
              "kept_bytes binary")
    out = scan.select("doc_id", "_key", "n_bytes", "sha").join(cut, "_key", "left")
    return out.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), "spans",
        F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("cut_sha", "sha").alias("kept_sha256"), "kept_bytes")

