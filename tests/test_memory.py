"""Budgeted context and ranked lists against plain loops."""

import random

from tidewick.operators import memory as mem


def _loop(recent, relevant, budget):
    used, kept = 0, []
    for i, tokens in recent:
        if used + tokens > budget:
            break
        kept.append((1, i))
        used += tokens
    ids = {i for i, _ in recent}
    for i, tokens in relevant:
        if used + tokens > budget:
            break
        if i not in ids:
            kept.append((2, i))
            used += tokens
    return kept


def test_two_phase_budget(spark):
    rng = random.Random(4)
    rec, rel, want = [], [], {}
    for a in range(300):
        pool = {f"m{i}": rng.randint(0, 60) for i in range(14)}
        r = rng.sample(sorted(pool.items()), rng.randint(0, 8))
        v = rng.sample(sorted(pool.items()), rng.randint(0, 12))
        want[str(a)] = _loop(r, v, 120)
        rec += [(str(a), i, "note", i, n, k + 1) for k, (i, n) in enumerate(r)]
        rel += [(str(a), i, "note", i, n, k + 1) for k, (i, n) in enumerate(v)]
    schema = ("agent_id string, id string, memory_type string, content string, token_count int, "
              "rank int")
    got = mem.token_budget_context(spark.createDataFrame(rec, schema),
                                   spark.createDataFrame(rel, schema), 120).collect()
    by_agent = {}
    for r in sorted(got, key=lambda r: (r.agent_id, r.phase, r.rank)):
        by_agent.setdefault(r.agent_id, []).append((r.phase, r.id))
    assert by_agent == {a: k for a, k in want.items() if k}


def test_upsert_keeps_the_newest(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 5, 1), ("c", 9, 1)], "id string, v int, t int")
    new = spark.createDataFrame([("a", 2, 1), ("b", 6, 0), ("d", 7, 1)], "id string, v int, t int")
    got = {r.id: r.v for r in mem.upsert_latest(old, new, ["id"], "t").collect()}
    assert got == {"a": 2, "b": 5, "c": 9, "d": 7}


def test_semantic_topk_matches_brute_force(spark):
    rng = random.Random(1)
    vecs = [(i, rng.choice("xy"), [rng.gauss(0, 1) for _ in range(8)]) for i in range(200)]
    queries = [(q, a, [rng.gauss(0, 1) for _ in range(8)]) for q, a in ((1, "x"), (2, "x"), (3, "y"))]
    got = mem.semantic_topk(
        spark.createDataFrame(vecs, "id int, agent_id string, embedding array<float>"),
        spark.createDataFrame(queries, "query_id int, agent_id string, query array<float>"), 5)
    ids = {}
    for r in sorted(got.collect(), key=lambda r: r.rank):
        ids.setdefault(r.query_id, []).append(r.id)

    def cos(a, b):
        return sum(p * q for p, q in zip(a, b)) / (
            sum(p * p for p in a) ** 0.5 * sum(q * q for q in b) ** 0.5)

    for q, a, v in queries:
        want = sorted((x for x in vecs if x[1] == a), key=lambda x: -cos(x[2], v))[:5]
        assert ids[q] == [x[0] for x in want]


def test_metrics_merge_new_value_wins(spark):
    agents = spark.createDataFrame([("a", {"w": 1.0, "n": 2.0}), ("b", {"w": 3.0})],
                                   "agent_id string, performance_metrics map<string,double>")
    new = spark.createDataFrame([("a", {"w": 9.0, "z": 4.0})],
                                "agent_id string, metrics map<string,double>")
    got = {r.agent_id: r.performance_metrics for r in mem.update_metrics(agents, new).collect()}
    assert got == {"a": {"w": 9.0, "n": 2.0, "z": 4.0}, "b": {"w": 3.0}}
