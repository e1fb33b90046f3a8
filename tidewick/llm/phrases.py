"""Removal of word runs that occurred before, by automata of the recurring passages.

1. One pass over the texts selects shingles such that every run of ``window`` words has at least one,
   and which one depends on the run's words alone. Shingles are counted; a run can only recur if its
   selected shingle does.
2. Around recurring shingles the texts are cut into stretches: the words of all runs that have the same
   selected shingle. Equal stretches are counted and become one passage with its first place; a passage
   is confirmed if it was found twice or shares its shingle with another one.
3. The runs of the confirmed passages are compiled into Aho-Corasick automata, sharded by shingle, each
   with the first place of the run. All passages are streamed through the automaton of their shard,
   which compares real words and locates every occurrence. A located run that is not the first of its
   kind is removed; in a text that repeats a whole passage all its runs are.

Nothing is kept per document but numbers and no group is collected. The passages of a shingle that very
many of them share are cut into single runs, which are dealt to parts by a hash of their words, patterns and
streamed runs alike: equal runs meet in one part, and each part's automaton is bounded.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import kept, kept_by, order_key, row_key
from tidewick.llm.textblock import Block, anchors, blocks, lists, signed, stretches

SHINGLE = 6
#: Passages of one shingle that an automaton takes, or runs once the shingle is spread over several.
PASSAGES_PER_TASK = 4096
#: Shingles that share an automaton if they have few passages; small automata stay in the processor's cache.
SHINGLES_PER_AUTOMATON = 64

#: Rows of passages in a batch.
ROWS = 1 << 14

_SCAN = "_id long, _key long, n_words long, sha string, grams array<long>, at array<int>"


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _scan(window: int):
    """Per text: number of words, digest of all words, selected shingles and their places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches):
            block.split()
            grams = block.shingles(block.word_hashes(), SHINGLE)
            at = anchors(block, SHINGLE, window)
            cut = np.searchsorted(at, block.first).astype(np.int32)
            local = (at - np.repeat(block.first[:-1], np.diff(cut))).astype(np.int32)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "_id": batch.column("_id"), "_key": batch.column("_key"),
                "n_words": pa.array(block.n_words.astype(np.int64)),
                "sha": pa.array([_digest(b" ".join(t.split())) for t in block.texts]),
                "grams": pa.ListArray.from_arrays(cut, signed(grams[at])),
                "at": pa.ListArray.from_arrays(cut, local)})
    return run


def _stretches(window: int):
    """Per text with recurring shingles: its stretches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in blocks(batches):
            block.split()
            grams = block.shingles(block.word_hashes(), SHINGLE)
            at = np.concatenate([p + b for p, b in zip(lists(batch, "at"), block.first)] or [np.zeros(0, np.int64)])
            at = np.sort(at).astype(np.int64)
            at = at[at < len(grams)]
            owner, lo, hi = stretches(at, grams[at], _starts(block, window), window - SHINGLE + 1)
            doc = block.doc[lo]
            back = block.byte_hashes(block.start[lo], block.end[hi + window - 1])
            yield pa.record_batch({
                "_key": batch.column("_key").take(pa.array(doc)), "_id": batch.column("_id").take(pa.array(doc)),
                "gram": pa.array(signed(grams[at[owner]])), "passage": pa.array(signed(back)),
                "lo": pa.array((lo - block.first[doc]).astype(np.int32)),
                "hi": pa.array((hi - block.first[doc]).astype(np.int32))})
    return run


def _starts(block: Block, window: int) -> np.ndarray:
    """Where a run of ``window`` words starts."""
    edge = np.zeros(len(block.start) + 1, np.int64)
    real = block.n_words >= window
    edge[block.first[:-1][real]] += 1
    edge[block.first[1:][real] - window + 1] -= 1
    return np.cumsum(edge)[:-1] > 0


def _passages(window: int):
    """The words of the confirmed passages, or of their runs: each as a pattern (kind 0) and as a row to stream (kind 1)."""
    names = ["gram", "own", "part", "kind", "words", "_key", "_id", "lo"]
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch, block in blocks(batches):
            block.split()
            keys, ids = batch.column("_key").to_pylist(), batch.column("_id").to_pylist()
            for i, passages in enumerate(batch.column("passages").to_pylist()):
                data, edge = block.joined(i)
                edge = edge.tolist()
                for p in passages:
                    lo, hi, parts, gram = p["lo"], p["hi"], p["parts"], p["gram"]
                    own = gram if p["own"] else 0
                    # lo : hi are the first and the last start of a run.
                    for a, b in [(lo, hi)] if parts == 1 else [(x, x) for x in range(lo, hi + 1)]:
                        text = data[edge[a]:edge[b + window] - 1]
                        part = zlib.crc32(text) % parts if parts > 1 else 0
                        for kind in (0, 1):
                            yield gram, own, part, kind, text, keys[i], ids[i], a

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = rows(batches)
        while some := list(islice(every, ROWS)):
            yield pa.record_batch([pa.array(v, t) for v, t in zip(zip(*some), types)], names)
    return run


class _Shard:
    """The automaton of one shard; words are single characters in it."""

    def __init__(self, window: int):
        self.letters: dict[bytes, str] = {}
        self.automaton, self.window, self.ready = ahocorasick.Automaton(), window, False

    def add(self, words: bytes, doc: int, start: int) -> None:
        letters, automaton = self.letters, self.automaton
        text = "".join([letters.setdefault(w, chr(0x10000 + len(letters))) for w in words.split(b" ")])
        for o in range(len(text) - self.window + 1):
            run, place = text[o:o + self.window], (doc, start + o)
            if place < automaton.get(run, (place[0] + 1,)):
                automaton.add_word(run, place)

    def repeats(self, words: bytes, doc: int, start: int) -> list[int]:
        """Starts of the located runs that occurred before."""
        if not self.ready:
            self.automaton.make_automaton()
            self.ready = True
        get = self.letters.get
        text = "".join([get(w, "\0") for w in words.split(b" ")])
        shift = start - self.window + 1
        return [end + shift for end, place in self.automaton.iter(text) if place != (doc, end + shift)]


def _located(window: int):
    """Streams the rows of a partition, in order of shard, through the shards' automata."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, None
        for batch in batches:
            keys, los, his = [], [], []
            cols = [batch.column(c).to_pylist() for c in ("shard", "part", "own", "kind", "words", "_key", "_id", "lo")]
            for number, part, own, kind, words, key, doc, start in zip(*cols):
                if now != (number, part, own):
                    now, shard = (number, part, own), _Shard(window)
                if kind == 0:
                    shard.add(words, doc, start)
                    continue
                end = -1
                for s in shard.repeats(words, doc, start):
                    if s <= end:
                        his[-1] = end = s + window
                    else:
                        keys.append(key)
                        los.append(s)
                        his.append(end := s + window)
            yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(los, pa.int32()),
                                   pa.array(his, pa.int32())], ["_key", "lo", "hi"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts without the removed words."""
    for batch in batches:
        left, gone = [], []
        for text, runs in zip(batch.column("text").cast(pa.binary()).to_pylist(),
                              batch.column("runs").to_pylist()):
            words = text.split()
            keep = np.ones(len(words), bool)
            for r in runs:
                keep[r["lo"]:r["hi"]] = False
            gone.append(len(words) - int(keep.sum()))
            left.append(b" ".join([w for w, k in zip(words, keep.tolist()) if k]).decode())
        yield pa.record_batch([batch.column("_key"), pa.array(gone, pa.int64()), pa.array(left)],
                              ["_key", "n_removed", "kept_text"])


def repeated_phrases(docs: DataFrame, window: int = 20) -> DataFrame:
    """Documents with every word covered by a ``window``-word run that also starts earlier removed.

    Returns doc_id, _key, n_words, n_removed, kept_sha256 and kept_text; kept_text (the kept words
    joined by one space) is null where nothing was removed: the text stays as it is. One row per
    input row.

    Earlier means a smaller doc_id, or the same doc_id and an earlier start. A null text has no words.
    Rows without a doc_id come after all others; rows that share a doc_id are versions of one document,
    so the same run at the same place in both counts as one and stays. An empty table gives no rows.
    Columns other than doc_id and text are ignored.
    """
    if window <= SHINGLE:
        raise ValueError(f"window must be over {SHINGLE} words")
    rows = docs.select("doc_id", order_key().alias("_id"), row_key().alias("_key"), "text")
    texts = rows.select("_id", "_key", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_SCAN}"
    scan = kept(rows.mapInArrow(_scan(window), schema), "phrase-scan")

    gram = F.explode("grams").alias("gram")
    # A table of its own, so that the join below deals out both sides and a hot shingle can be split.
    counts = kept(scan.select(gram).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"),
                  "phrase-shingles")
    places = scan.select("_key", F.explode(F.arrays_zip("grams", "at")).alias("p")).select(
        "_key", F.col("p.grams").alias("gram"), F.col("p.at").alias("at"))
    by_text = places.join(counts, "gram").groupBy("_key").agg(F.collect_set("at").alias("at"))
    routed = kept_by(texts.join(by_text, "_key").dropDuplicates(["_key"]), "phrase-texts", "_key")

    found = kept(routed.mapInArrow(_stretches(window), "_key long, _id long, gram long, passage long, lo int, hi int"),
                 "phrase-stretches")
    passages = kept(found.groupBy("gram", "passage").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("_id", "lo", "_key", "hi")).alias("first")), "phrase-passages")
    shared = passages.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n")).filter(
        "m > 1 OR n > 1").select(
            "gram", F.expr(f"m > {PASSAGES_PER_TASK // SHINGLES_PER_AUTOMATON}").alias("own"),
            F.expr(f"int(IF(m < {PASSAGES_PER_TASK}, 1, 1 + m * {window - SHINGLE + 1} div {PASSAGES_PER_TASK}))").alias("parts"))
    shared = kept(shared, "phrase-shared")
    confirmed = passages.join(shared, "gram")
    place = F.struct("first.lo", "first.hi", "gram", "own", "parts")
    to_shards = routed.select("_key", "_id", "text").join(
        confirmed.groupBy(F.col("first._key").alias("_key")).agg(F.collect_list(place).alias("passages")), "_key")
    shards = F.lit(1 + shared.count() // SHINGLES_PER_AUTOMATON)
    rows_in = to_shards.mapInArrow(_passages(window), "gram long, own long, part int, kind int, words binary, _key long, "
                                                      "_id long, lo int").withColumn(
        "shard", F.pmod(F.xxhash64("gram"), shards)).drop("gram")
    located = kept(rows_in.repartition("shard", "part").sortWithinPartitions("shard", "part", "own", "kind")
                   .mapInArrow(_located(window), "_key long, lo int, hi int"), "phrase-located")
    again = found.join(passages.filter("n > 1").select("gram", "passage", F.col("first._id").alias("_first"),
                                                       F.col("first.lo").alias("_at")), ["gram", "passage"])
    again = again.filter("_id != _first OR lo != _at").select("_key", "lo", (F.col("hi") + window).alias("hi"))
    runs = located.union(again).groupBy("_key").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))
    cut = (routed.select("_key", "text").join(runs, "_key")
           .mapInArrow(_cut, "_key long, n_removed long, kept_text string"))
    out = scan.select("doc_id", "_key", "n_words", "sha").join(cut, "_key", "left")
    return out.select("doc_id", "_key", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                      F.coalesce(F.sha2("kept_text", 256), "sha").alias("kept_sha256"), "kept_text")
