"""The hyperplane index against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewick.operators import memory as mem, vector_index as ix

ITEMS = "agent_id string, id long, embedding array<float>"
QUERIES = "query_id long, agent_id string, query array<float>"


def _clustered(n, size, centres, spread, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, size))
    return middle[rng.integers(0, centres, n)] + spread * rng.normal(size=(n, size))


def _frames(spark, vectors, agents, every):
    rows = [(str(i % agents), i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    asked = [(i, str(i % agents), [float(x) for x in v]) for i, v in enumerate(vectors) if i % every == 0]
    return spark.createDataFrame(rows, ITEMS).cache(), spark.createDataFrame(asked, QUERIES).cache()


@pytest.mark.parametrize("agents", [1, 3])
def test_recall_on_clusters_with_few_candidates(spark, agents):
    items, queries = _frames(spark, _clustered(3000, 32, 60, 0.35, 1), agents, 97)
    planes = ix.Hyperplanes(32, bits=10)
    index = ix.index_items(items, planes).cache()
    assert index.count() == 3000 * planes.tables
    met = ix.shortlists(index, queries, planes, probes=4, shortlist=10**9)
    pairs = items.join(queries, "agent_id").count()
    assert met.count() < 0.25 * pairs  # what the cells alone bring together
    found = ix.indexed_topk(items, index, queries, planes, 10, probes=4, shortlist=60)
    row = ix.recall(found, mem.semantic_topk(items, queries, 10)).first()
    assert row.recall >= 0.9 and row.queries == queries.count()


def test_recall_on_all_given_vectors(spark):
    """Vectors without clusters, the hardest case: recall is kept, and only the shortlist is compared exactly."""
    items = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(
        F.lit("a").alias("agent_id"), F.col("vec_id").alias("id"), "embedding").cache()
    queries = items.filter("id % 40 = 0").select(F.col("id").alias("query_id"), "agent_id", F.col("embedding").alias("query")).cache()
    planes = ix.Hyperplanes(64)
    index = ix.index_items(items, planes).cache()
    found = ix.indexed_topk(items, index, queries, planes, 20)
    row = ix.recall(found, mem.semantic_topk(items, queries, 20)).first()
    assert (row.queries, row.wanted) == (50, 1000) and row.recall >= 0.9


def test_everything_is_found_if_everything_is_asked(spark):
    items, queries = _frames(spark, np.random.default_rng(3).normal(size=(200, 8)), 2, 50)
    planes = ix.Hyperplanes(8, tables=2, bits=4)
    found = ix.indexed_topk(items, ix.index_items(items, planes), queries, planes, 7, probes=16, shortlist=200)
    key = ["query_id", "agent_id", "id", "rank"]
    want = {tuple(r[k] for k in key): r.score for r in mem.semantic_topk(items, queries, 7).collect()}
    got = {tuple(r[k] for k in key): r.score for r in found.collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_items_without_a_vector(spark):
    items = spark.createDataFrame([("a", 1, [1.0, 0.0]), ("a", 2, None), ("a", 3, [0.0, 0.0]), ("a", 4, [1.0]),
                                   ("a", 5, [1.0, None]), ("b", 6, [1.0, 0.0]), ("a", 7, [1.0, 0.0])], ITEMS)
    queries = spark.createDataFrame([(1, "a", [2.0, 0.0]), (2, "a", None), (3, "c", [1.0, 0.0])], QUERIES)
    planes = ix.Hyperplanes(2, tables=3, bits=2)
    index = ix.index_items(items, planes)
    assert {r.id for r in index.select("id").distinct().collect()} == {1, 6, 7}
    got = ix.indexed_topk(items, index, queries, planes, 5).collect()
    assert {(r.query_id, r.id, r["rank"]) for r in got} == {(1, 1, 1), (1, 7, 2)}
    empty = ix.indexed_topk(items.limit(0), ix.index_items(items.limit(0), planes), queries, planes, 5)
    assert empty.collect() == []


def test_appended_items_are_found(spark):
    items, queries = _frames(spark, _clustered(300, 16, 5, 0.2, 5), 1, 100)
    planes = ix.Hyperplanes(16)
    whole = ix.index_items(items, planes)
    parts = ix.index_items(items.filter("id < 100"), planes).unionByName(ix.index_items(items.filter("id >= 100"), planes))
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(whole) == rows(parts)
    assert rows(ix.indexed_topk(items, parts, queries, planes, 5)) == rows(ix.indexed_topk(items, whole, queries, planes, 5))


def test_recall_holds_among_many_vectors_without_clusters(spark):
    """The more items, the more of them lie almost as near as the nearest twenty."""
    rng = np.random.default_rng(8)
    items, queries = _frames(spark, rng.normal(size=(12000, 64)), 1, 300)
    planes = ix.Hyperplanes(64)
    index = ix.index_items(items, planes).cache()
    assert ix.shortlist_for(index, planes) == ix.SHORTLIST
    assert ix.shortlist_for(index, ix.Hyperplanes(64, tables=1)) == 439  # 192,000 rows, as of so many items
    found = ix.indexed_topk(items, index, queries, planes, 20)
    row = ix.recall(found, mem.semantic_topk(items, queries, 20)).first()
    assert (row.queries, row.wanted) == (40, 800) and row.recall >= 0.93
