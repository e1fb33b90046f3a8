"""Near copies by 64-bit fingerprints, found through an index of their bytes by position.

Fingerprints that differ in at most 4 bits agree in at least 4 of their 8 bytes. Lists of single bytes would
grow with the corpus, so a fingerprint is posted under 3 bytes at a time, at the fewest choices of positions of
which any 4 positions hold one (20 keys of 24 bits): a pair that agrees in 4 bytes meets. Where two meet, the bytes
they share by position are counted over all 8, pairs with fewer than the guaranteed 4 are dropped without a
look at their bits (most that meet by chance share the 3 of the key alone), and the rest is verified.

Only distinct fingerprints are posted, so copies cost nothing. A key that many fingerprints share is cut
into blocks of a fixed size that meet two by two, each pair of blocks in its own group; a group returns
a spanning forest of its links instead of all pairs, which keeps every connection.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewick.llm.common import NO_ID, kept, order_key, row_key, rows_with
from tidewick.llm.components import components
from tidewick.llm.textblock import blocks

SHINGLE, SEED = 4, 42
#: Fingerprints of one key that one group compares.
BLOCK = 1024
BYTES, DIFFER = 8, 4
SHARED = BYTES - DIFFER
#: Bytes of a key.
POSTED = SHARED - 1


def _places() -> list[tuple[int, ...]]:
    """Choices of ``POSTED`` positions such that any ``SHARED`` positions hold one (Turan's construction).

    Positions lie in three circles by their rest; a choice lies in one circle, or two of it in one and
    the third in the next. Four positions always hold such a choice.
    """
    def fits(choice: tuple[int, ...]) -> bool:
        n = [sum(x % 3 == r for x in choice) for r in range(3)]
        return 3 in n or (2 in n and n[(n.index(2) + 1) % 3] == 1)

    return [c for c in combinations(range(BYTES), POSTED) if fits(c)]


PLACES = _places()
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    if len(hashes) == 0:
        return 0
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        part = hashes[lo:lo + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh64_intdigest
    for batch, block in blocks(batches):
        block = type(block)([t.translate(_LOWER) for t in block.texts])
        block.split()
        out = np.zeros(len(block), np.uint64)
        for i in range(len(block)):
            data, edge = block.joined(i)
            n = len(edge) - 1
            if n <= 0:
                continue
            lo = edge[:max(1, n - SHINGLE + 1)].tolist()
            hi = (edge[min(n, SHINGLE):] - 1).tolist()
            out[i] = fingerprint(np.array([digest(data[a:b], SEED) for a, b in zip(lo, hi)], np.uint64))
        yield pa.record_batch([*[batch.column(c) for c in ("doc_id", "_id", "_key")], pa.array(out.view(np.int64))],
                              ["doc_id", "_id", "_key", "print"])


def _near(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Counts shared bytes by position, then compares the bits of the pairs that share enough."""
    differ = left ^ right
    shared = np.zeros(differ.shape, np.uint8)
    for i in range(BYTES):
        shared += ((differ >> np.uint64(8 * i)) & np.uint64(255)) == 0
    out = shared >= SHARED
    out[out] = np.bitwise_count(differ[out]) <= DIFFER
    return out


def _forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between the fingerprints of two blocks, without those that close a circle."""
    both = np.concatenate((left, right))
    label, out = np.arange(len(both)), []
    step = max(1, (1 << 18) // max(1, len(right)))
    for lo in range(0, len(left), step):
        for i, row in enumerate(_near(left[lo:lo + step, None], right[None, :]), lo):
            other = np.flatnonzero(row) + len(left)
            other = other[label[other] != label[i]]
            if len(other):
                trees, at = np.unique(label[other], return_index=True)
                out += [(int(left[i]), int(both[x])) for x in other[at]]
                label[np.isin(label, trees)] = label[i]
    return out


#: Groups up to this size are compared for all groups of a batch at once.
SMALL = 32


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Reads a partition sorted by group; a group is all rows of one pair of blocks."""
    for part in _whole_groups(batches):
        prints, side = part["print"].to_numpy().view(np.uint64), part["side"].to_numpy()
        group = part[["key", "p", "q"]].to_numpy()
        cut = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
        begin, end = np.append(0, cut), np.append(cut, len(part))
        number = np.repeat(np.arange(len(begin)), end - begin)
        small = (end - begin <= SMALL) & (group[begin, 1] == group[begin, 2])
        inside = small[number]
        pairs = []
        for d in range(1, int((end - begin)[small].max(initial=1))):
            i = np.flatnonzero((number[d:] == number[:-d]) & inside[d:])
            i = i[_near(prints[i], prints[i + d])]
            pairs.append(np.stack((prints[i], prints[i + d]), axis=1))
        for lo, hi, whole in zip(begin[~small], end[~small], group[begin[~small], 1] == group[begin[~small], 2]):
            mine, left = prints[lo:hi], side[lo:hi] == 0
            found = _forest(mine, mine) if whole else _forest(mine[left], mine[~left])
            pairs.append(np.array(found, np.uint64).reshape(-1, 2))
        out = np.concatenate(pairs or [np.zeros((0, 2), np.uint64)]).view(np.int64)
        yield pd.DataFrame({"a": out[:, 0], "b": out[:, 1]}).drop_duplicates()


def _whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches cut at borders of groups; a group has at most two blocks."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if len(batch) == 0:
            continue
        last = batch.iloc[-1]
        same = ((batch["key"] == last["key"]) & (batch["p"] == last["p"]) & (batch["q"] == last["q"])).to_numpy()
        n = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if n:
            yield batch.iloc[:n]
        rest = batch.iloc[n:]
    if rest is not None and len(rest):
        yield rest


def _keys():
    """Fingerprint -> array of keys: number of the byte positions, then the bytes there."""
    byte = [F.shiftrightunsigned("print", 8 * i).bitwiseAND(255) for i in range(BYTES)]
    return F.array(*[
        sum((F.shiftleft(byte[i], 8 * (POSTED - 1 - n)) for n, i in enumerate(places)),
            F.lit(number << 8 * POSTED).cast("bigint")) for number, places in enumerate(PLACES)])


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints at most ``DIFFER`` bits apart."""
    posted = prints.select("print", F.explode(_keys()).alias("key"))
    # A table of its own, so that the join below deals out both sides and a hot key can be split.
    counts = kept(posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "fingerprint-keys")
    parts = F.expr(f"int(1 + (n - 1) div {BLOCK})")
    met = posted.join(counts.select("key", parts.alias("parts")), "key")
    own = F.when(F.col("parts") == 1, F.lit(0)).otherwise(
        F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")).alias("own")
    met = met.select("print", "key", "parts", own).select(
        "print", "key", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    met = met.select("print", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
                     (F.col("own") > F.col("other")).cast("int").alias("side"))
    met = met.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
    return met.mapInPandas(_links, "a long, b long").distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """Documents with fingerprint and the component of documents linked through near fingerprints.

    Returns doc_id, _id, _key (order and row keys), print (the fingerprint as a signed number), fingerprint
    (16 hex digits), class_id (least doc_id with this fingerprint), _component (least _id that can be
    reached) and component_id (the doc_id that is), one row per input row.

    Texts are lower-cased in A-Z and cut into words; shingles of 4 words are hashed with XXH64, seed 42.
    A text of fewer words is one shingle; a text without words, a null text too, has fingerprint zero.
    Rows without a doc_id take part; a component of such rows alone has component_id null. Repeated rows
    are linked like any others; an empty table gives no rows; other columns are ignored.
    """
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _id long, _key long, print long"
    rows = kept(docs.select("doc_id", order_key().alias("_id"), row_key().alias("_key"), "text").mapInArrow(_fingerprints, schema),
                "fingerprints")
    classes = kept(rows.groupBy("print").agg(F.min("_id").alias("class"), F.min("doc_id").alias("class_id")),
                   "fingerprint-classes")
    pairs = links(classes.select("print"))
    found = pairs.join(classes.select(F.col("print").alias("a"), F.col("class").alias("x")), "a").join(
        classes.select(F.col("print").alias("b"), F.col("class").alias("y")), "b").select("x", "y")
    groups = components(found, ("x", "y"))
    ids = classes.join(groups, classes["class"] == groups["node"], "left").select(
        "print", "class_id", F.coalesce("component", "class").alias("_component"))
    plain = F.when(F.col("_component") < NO_ID, F.col("_component"))
    return rows.join(ids, "print").select(
        "doc_id", "_id", "_key", "print", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "class_id",
        "_component", plain.alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every component: the one with the least doc_id; all columns stay."""
    first = near_copies(docs).groupBy("_component").agg(F.min(F.struct("_id", "_key")).alias("first"))
    return rows_with(docs, first.select("first._key"), "left_semi", row_key()).dropDuplicates(["_of_row"]).select("_whole.*")
