"""Blocks of items and queries against joins that make a row for each pair."""

import math

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from tidewick.operators import memory as mem, pairs, vector_index as ix

ITEMS = "agent_id string, id string, embedding array<float>"
QUERIES = "query_id long, agent_id string, query array<float>"
NAN = float("nan")
#: Of items as of queries.
ODD = [None, [0.0] * 6, [NAN] * 6, [1.0, NAN, 0.0, 0.0, 0.0, 0.0], [1.0, None, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0], [3.0, 1.0], [],
       [float("inf")] + [1.0] * 5]


def _odd_frames(spark):
    """Vectors that repeat, ids that repeat with the same or another vector, and vectors that cannot be compared."""
    rng = np.random.default_rng(4)
    some = [[float(x) for x in v] for v in rng.normal(size=(60, 6))]
    rows = [("abc"[i % 3], f"m{i % 331}", some[int(rng.integers(60))] if i % 2 else [float(x) for x in rng.normal(size=6)]) for i in range(700)]
    rows += [("ab"[i % 2], f"odd{i}", ODD[i % len(ODD)]) for i in range(60)] + [("a", None, some[3]), (None, "m0", some[3]), ("d", "m1", some[0])]
    asked = [(i % 17, "abce"[i % 4], some[i]) for i in range(24)] + [(100 + i, "ab"[i % 2], v) for i, v in enumerate(ODD)]
    asked += [(None, "a", some[5]), (200, None, some[5])]
    return spark.createDataFrame(rows + rows[:40], ITEMS).cache(), spark.createDataFrame(asked, QUERIES).cache()


def _small(monkeypatch, module):
    """Blocks of a few dozen items; what they pass on is kept."""
    passed = []

    def meet(*args, **kwargs):
        passed.append(pairs.meet(*args, **{**kwargs, "block": 40, "chunk": (3, 5)}).cache())
        return passed[-1]

    monkeypatch.setattr(module, "meet", meet)
    return passed


def _counted(df):
    """Rows as often as they come; a score that is no number is written out."""
    rows = {}
    for r in df.collect():
        key = tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r)
        rows[key] = rows.get(key, 0) + 1
    return rows


@pytest.mark.parametrize("decimals", [None, 1])
def test_blocks_find_what_a_join_of_all_pairs_finds(spark, monkeypatch, decimals):
    items, queries = _odd_frames(spark)
    asked = queries.select("query_id", "agent_id", mem.unit(F.col("query")).alias("_q"))
    all_pairs = items.withColumn("_u", mem.unit(F.col("embedding"))).join(asked, "agent_id")
    score = mem.dot(F.col("_u"), F.col("_q"))
    all_pairs = all_pairs.select("query_id", "agent_id", "id", (score if decimals is None else F.round(score, decimals)).alias("score"))
    first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    ranked = all_pairs.withColumn("rank", F.row_number().over(first)).filter("rank <= 9")
    _small(monkeypatch, mem)
    found = mem.semantic_topk(items, queries, 9, decimals=decimals)
    # Ids repeat, so agents of one query and equal rows may change places; what stands at each rank does not.
    kept = ["query_id", "id", "score", "rank"]
    assert _counted(found.select(kept)) == _counted(ranked.select(kept))


def test_few_pairs_leave_the_blocks(spark, monkeypatch):
    """Before, each of the 600,000 pairs was a row with two vectors."""
    v = np.random.default_rng(2).normal(size=(3000, 16))
    items = spark.createDataFrame([("a", str(i), [float(y) for y in x]) for i, x in enumerate(v)], ITEMS)
    queries = spark.createDataFrame([(i, "a", [float(y) for y in x]) for i, x in enumerate(v[:200])], QUERIES)
    passed = []
    monkeypatch.setattr(mem, "meet", lambda *a, **k: passed.append(pairs.meet(*a, **{**k, "block": 1000}).cache()) or passed[-1])
    assert mem.semantic_topk(items, queries, 20, decimals=6).count() == 4000
    assert passed[0].count() <= 3 * 200 * 21


def test_equal_vectors_do_not_all_leave_the_blocks(spark, monkeypatch):
    items = spark.range(2000).select(F.lit("a").alias("agent_id"), F.format_string("%04d", "id").alias("id"),
                                     F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("embedding"))
    queries = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "a", [2.0, 1.0])], QUERIES)
    passed = []
    monkeypatch.setattr(mem, "meet", lambda *a, **k: passed.append(pairs.meet(*a, **k).cache()) or passed[-1])
    found = mem.semantic_topk(items, queries, 5).collect()
    assert sorted((r.query_id, r.id) for r in found) == [(q, f"000{i}") for q in (1, 2) for i in range(5)]
    assert passed[0].count() == 10


def test_shortlists_are_those_of_a_join_of_cells(spark, monkeypatch):
    items, queries = _odd_frames(spark)
    planes = ix.Hyperplanes(6, tables=4, bits=4)
    index = ix.index_items(items, planes).cache()
    rows = queries.select("query_id", "agent_id", ix._usable("query", 6).alias("_u"))
    asked = ix._signed(rows, ["query_id", "agent_id"], planes, 3)
    asked = asked.select("query_id", "agent_id", F.explode("cells").alias("cell"), F.col("signature").alias("_asked"))
    differ = sum((F.bit_count(F.col("signature")[i].bitwiseXOR(F.col("_asked")[i])) for i in range(ix.WORDS)), F.lit(0))
    met = index.join(asked, ["agent_id", "cell"]).groupBy("query_id", "agent_id", "id").agg(F.min(differ).alias("differ"))
    first = Window.partitionBy("query_id").orderBy("differ", "id")
    want = met.withColumn("_n", F.row_number().over(first)).filter("_n <= 12").drop("_n").select("query_id", "id", "differ")
    passed = _small(monkeypatch, ix)
    found = ix.shortlists(index, queries, planes, probes=3, shortlist=12)
    assert found.columns == ["query_id", "agent_id", "id", "differ"]
    assert _counted(found.select("query_id", "id", "differ")) == _counted(want)
    assert 0 < passed[0].count() < met.count() + 100
    everything = ix.shortlists(index, queries, planes, probes=3, shortlist=10**9)
    assert _counted(everything) == _counted(met.select(everything.columns))


def test_a_vectors_length_is_added_up_once(spark):
    """Named inside the division, it was added up again for each number of the vector."""
    items = spark.createDataFrame([("a", "1", [3.0, 4.0]), ("a", "2", None), ("a", "3", [0.0, 0.0]), ("a", "4", [1.0, None]), ("a", "5", [])], ITEMS)
    unit = items.select("id", mem.unit(F.col("embedding")).alias("u"))
    assert unit._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert {r.id: r.u for r in unit.collect()} == {"1": [0.6, 0.8], "2": None, "3": None, "4": None, "5": None}
