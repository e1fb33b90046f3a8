"""Queries over agent memory tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewick.functions import text as tx
from tidewick.operators import memory as mem, vector_index as ix
from tidewick.plans import sqltext as S, tables as t
from tidewick.plans.registry import query
from tidewick.session import scratch_path, written
from tidewick.sources.stores import KeyedStore

CONTEXT_TOKENS = 400
_M = (S.MEMORY,)
_A = (S.MEMORY, S.AGENTS)
_IMPORTANT = "importance DESC, timestamp DESC, id"
_RECENT = "timestamp DESC, id"


def _rank(name: str, order: str, k: int) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY {order}) AS rank
      FROM items) WHERE rank <= {k})"""


IMP, REC = _rank("imp", _IMPORTANT, 20), _rank("rec", _RECENT, 10)
_SHOW = "agent_id, id, memory_type, round(importance + 1e-9, 6) AS importance, rank"
_COLS = ["agent_id", "id", "memory_type", "importance", "rank"]


def _important(spark, sf):
    return mem.top_important(t.memory_items(spark, sf))


def _recent(spark, sf):
    return mem.top_recent(t.memory_items(spark, sf))


@query("top_important", S.with_(*_M, IMP, select=f"SELECT {_SHOW} FROM imp"))
def top_important(spark, sf):
    return _important(spark, sf).select(_COLS)


@query("top_recent", S.with_(*_M, REC, select=f"SELECT {_SHOW} FROM rec"))
def top_recent(spark, sf):
    return _recent(spark, sf).select(_COLS)


@query("agent_filter", S.with_(*_M, select="SELECT id, role AS agent_id, memory_type FROM items WHERE role IN ('assistant', 'system')"))
def agent_filter(spark, sf):
    """The speaker's role as the agent."""
    items = t.memory_items(spark, sf).withColumn("agent_id", F.col("tags")[0])
    return mem.agent_filter(items, "assistant", "system").select("id", "agent_id", "memory_type")


@query("token_usage", S.with_(*_M, select="SELECT agent_id, CAST(sum(token_count) AS BIGINT) AS total_tokens_used FROM items GROUP BY 1"))
def token_usage(spark, sf):
    return mem.token_usage(t.memory_items(spark, sf))


_SEM = """q AS (SELECT label, min(vec_id) AS query_id, arg_min(embedding, vec_id) AS query FROM embeddings GROUP BY 1),
  hits AS (SELECT query_id, CAST(label AS VARCHAR) AS agent_id, vec_id AS id, score, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (SELECT *, round(list_cosine_similarity(
    CAST(embedding AS DOUBLE[]), CAST(query AS DOUBLE[])), 6) AS score FROM embeddings JOIN q USING (label)) QUALIFY rank <= 20)"""


def _hits(spark, sf):
    return mem.semantic_topk(t.vectors(spark, sf), t.vector_queries(spark, sf), 20, decimals=6)


@query("semantic_topk", S.with_(_SEM, select="SELECT query_id, agent_id, id, round(score + 1e-9, 6) AS score, rank FROM hits"))
def semantic_topk(spark, sf):
    return _hits(spark, sf)


_ALL = """q AS (SELECT vec_id AS query_id, embedding AS query FROM embeddings WHERE vec_id % 25 = 0),
  hits AS (SELECT query_id, vec_id AS id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT query_id, vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(query AS DOUBLE[])), 6) AS score
    FROM embeddings CROSS JOIN q) QUALIFY rank <= 20)"""


@query("semantic_topk_index", S.with_(_ALL, select="""SELECT count(DISTINCT query_id) AS queries, count(*) AS wanted, true AS recall_reached,
  count(DISTINCT query_id) AS own_first, true AS scores_exact FROM hits"""))
def semantic_topk_index(spark, sf):
    """All vectors as one agent's, indexed; every 25th asks for its nearest 20, which are compared with the exact ones."""
    items = t.vectors(spark, sf).withColumn("agent_id", F.lit("all"))
    queries = items.filter("id % 25 = 0").select(F.col("id").alias("query_id"), "agent_id", F.col("embedding").alias("query"))
    planes = ix.Hyperplanes(64)
    index = written(ix.index_items(items, planes), "vector-index")
    found = written(ix.indexed_topk(items, index, queries, planes, 20, decimals=6), "found")
    exact = written(mem.semantic_topk(items, queries, 20, decimals=6), "exact")
    same = found.join(exact.select("query_id", "id", F.col("score").alias("_score")), ["query_id", "id"]).agg(
        F.bool_and(F.col("score") == F.col("_score"))).scalar()
    own = found.filter("rank = 1 AND id = query_id").agg(F.count(F.lit(1))).scalar()
    return ix.recall(found, exact).select("queries", "wanted", (F.col("recall") >= 0.9).alias("recall_reached"),
                                          own.alias("own_first"), same.alias("scores_exact"))


@query("memory_hydrate", S.with_(_SEM, select="""SELECT query_id, h.agent_id, id, rank, len(embedding) AS dims,
  round(embedding[1] + 1e-9, 6) AS first FROM hits h JOIN embeddings e ON e.vec_id = h.id"""))
def memory_hydrate(spark, sf):
    full = mem.memory_hydrate(_hits(spark, sf), t.vectors(spark, sf).drop("agent_id"))
    return full.select("query_id", "agent_id", "id", "rank", F.size("embedding").alias("dims"),
                       F.col("embedding")[0].cast("double").alias("first"))


@query("exclude_recent", S.with_(*_M, IMP, _rank("rec", _RECENT, 3), select="""SELECT agent_id, id, rank FROM imp
  WHERE NOT EXISTS (SELECT 1 FROM rec WHERE rec.agent_id = imp.agent_id AND rec.id = imp.id)"""))
def exclude_recent(spark, sf):
    return mem.exclude_recent(_important(spark, sf),
                              mem.top_recent(t.memory_items(spark, sf), 3)).select(
        "agent_id", "id", "rank")


# The two-phase budget as a recursive walk over each agent's list, one row at a time.
_WALK = f"""seq AS (SELECT agent_id, id, token_count, phase, rank, memory_type, content, dup, row_number() OVER (
    PARTITION BY agent_id ORDER BY phase, rank) AS n FROM (
    SELECT agent_id, id, token_count, 1 AS phase, rank, memory_type, content, false AS dup FROM rec
    UNION ALL SELECT agent_id, id, token_count, 2, rank, memory_type, content,
      EXISTS (SELECT 1 FROM rec WHERE rec.agent_id = imp.agent_id AND rec.id = imp.id) FROM imp)),
  walk AS (SELECT agent_id, CAST(0 AS BIGINT) AS n, CAST(0 AS HUGEINT) AS used, 0 AS stopped, false AS kept FROM (SELECT DISTINCT agent_id FROM seq)
    UNION ALL SELECT s.agent_id, s.n, CAST(w.used + CASE WHEN w.stopped < s.phase AND w.used + s.token_count <= {CONTEXT_TOKENS} AND NOT s.dup THEN s.token_count ELSE 0 END AS HUGEINT),
      CASE WHEN w.stopped < s.phase AND w.used + s.token_count > {CONTEXT_TOKENS} THEN s.phase ELSE w.stopped END,
      w.stopped < s.phase AND w.used + s.token_count <= {CONTEXT_TOKENS} AND NOT s.dup
    FROM walk w JOIN seq s ON s.agent_id = w.agent_id AND s.n = w.n + 1),
  fit AS (SELECT s.* FROM walk w JOIN seq s USING (agent_id, n) WHERE w.kept)"""
_REC_CTE = "RECURSIVE " + S.MEMORY


@query("token_budget_context", S.with_(_REC_CTE, IMP, REC, _WALK, select="SELECT agent_id, id, phase, rank, token_count FROM fit"))
def token_budget_context(spark, sf):
    return mem.token_budget_context(_recent(spark, sf), _important(spark, sf),
                                    CONTEXT_TOKENS).select("agent_id", "id", "phase", "rank",
                                                           "token_count")


_PERF = """perf AS (SELECT *, 'Total trades: ' || memory_count * 2 || ', Win rate: ' || printf('%.1f', win_rate * 100 + 1e-7)
  || '%, Total P&L: $' || printf('%.2f', total_pnl) || ', Avg confidence: ' || printf('%.2f', avg_confidence + 1e-9) AS line FROM agents)"""
_PTOK = f"len(regexp_extract_all(line, '{S.TOKEN}'))"


def _agents(spark, sf):
    """Agents whose printed metrics sit off rounding ties."""
    off = {"win_rate": 1e-9, "avg_confidence": 1e-9}
    shift = F.transform_values("performance_metrics", lambda k, v: v + F.when(
        k.isin(*off), 1e-9).otherwise(0.0))
    return t.agents(spark, sf).withColumn("performance_metrics", shift)


@query("context_build", S.with_(_REC_CTE, S.AGENTS, _PERF, IMP, REC, _WALK, f"""txt AS (SELECT agent_id,
  string_agg('[' || upper(memory_type) || '] ' || content, chr(10) || chr(10) ORDER BY phase, rank) AS body, sum(token_count) AS used FROM fit GROUP BY 1),
  j AS (SELECT agent_id, body, coalesce(used, 0) AS used, line, {_PTOK} AS ptok FROM perf LEFT JOIN txt USING (agent_id))""",
  select=f"""SELECT agent_id, concat_ws(chr(10) || chr(10), body, CASE WHEN used + ptok < {CONTEXT_TOKENS} THEN '[PERFORMANCE] ' || line END) AS context,
  CAST(used + CASE WHEN used + ptok < {CONTEXT_TOKENS} THEN ptok ELSE 0 END AS BIGINT) AS context_tokens FROM j"""))
def context_build(spark, sf):
    fitted = mem.token_budget_context(_recent(spark, sf), _important(spark, sf), CONTEXT_TOKENS)
    return mem.context_build(fitted, _agents(spark, sf), CONTEXT_TOKENS)


@query("retired_context", S.with_(*_A, _PERF, IMP, f"""s AS (SELECT imp.agent_id, rank, memory_type, content,
  {_PTOK} + sum(token_count) OVER (PARTITION BY imp.agent_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS used FROM imp JOIN perf USING (agent_id)),
  b AS (SELECT agent_id, string_agg('[' || upper(memory_type) || '] ' || content, chr(10) || chr(10) ORDER BY rank) AS body, max(used) AS used
    FROM s WHERE used <= {CONTEXT_TOKENS} GROUP BY 1)""", select=f"""SELECT agent_id, concat_ws(chr(10) || chr(10), '[RETIRED_AGENT] ' || line, body) AS context,
  CAST(coalesce(used, {_PTOK}) AS BIGINT) AS context_tokens FROM perf LEFT JOIN b USING (agent_id)"""))
def retired_context(spark, sf):
    return mem.retired_context(_important(spark, sf), _agents(spark, sf), CONTEXT_TOKENS)


@query("performance_text", S.with_(*_A, _PERF, select="""SELECT agent_id, line AS text, 'Performance insights from parent agent: ' || concat_ws('; ',
  CASE WHEN win_rate + 1e-9 > 0 THEN 'Parent agent achieved ' || printf('%.1f', win_rate * 100 + 1e-7) || '% win rate' END,
  CASE WHEN total_pnl > 0 THEN 'Parent agent generated $' || printf('%.2f', total_pnl) || ' profit' END,
  CASE WHEN avg_confidence + 1e-9 > 0 THEN 'Parent agent average confidence: ' || printf('%.2f', avg_confidence + 1e-9) END) AS insight FROM perf"""))
def performance_text(spark, sf):
    metrics = F.col("performance_metrics")
    return _agents(spark, sf).select("agent_id", tx.performance_text(metrics).alias("text"),
                                     tx.parent_insight_text(metrics).alias("insight"))


@query("add_memories", S.with_(*_M, select="""SELECT md5(agent_id || '_' || content || '_' || strftime(timestamp, '%Y-%m-%d %H:%M:%S')) AS id,
  agent_id, memory_type, round(importance + 1e-9, 6) AS importance, role AS tag, agent_id AS meta_agent, token_count FROM items"""))
def add_memories(spark, sf):
    return mem.add_memories(t.memory_items(spark, sf).drop("id", "token_count")).select(
        "id", "agent_id", "memory_type", "importance", F.col("tags")[0].alias("tag"),
        F.try_element_at("metadata", F.lit("agent_id")).alias("meta_agent"), "token_count")


def _moved(k: int, factor: str, where: str, tags: str, origin: str) -> str:
    return S.with_(*_M, _rank("top", _IMPORTANT, k), select=f"""SELECT agent_id || '-next' AS agent_id, content, memory_type,
      md5(agent_id || '-next_' || content || '_2024-02-01 00:00:00_' || id) AS id, {tags} AS tags, signal, CAST(pnl AS VARCHAR) AS pnl, {origin} AS transferred_from,
      agent_id || '-next' AS owner, round(importance * {factor} + 1e-9, 6) AS importance, token_count FROM top {where}""")


_MOVED = ["agent_id", "content", "memory_type", "id", "array_join(tags, ',') AS tags", "metadata['signal'] AS signal",
          "metadata['pnl'] AS pnl", "metadata['transferred_from'] AS transferred_from", "metadata['agent_id'] AS owner",
          "importance", "token_count"]


@query("transfer_memories", _moved(100, "0.8", "WHERE importance > 0.6", "role || ',transferred'", "agent_id"))
def transfer_memories(spark, sf):
    return mem.transfer_memories(t.memory_items(spark, sf), t.successors(spark, sf),
                                 t.memory_as_of()).selectExpr(*_MOVED)


@query("transfer_on_retire", _moved(50, "1.0", "", "role", "CAST(NULL AS VARCHAR)"))
def transfer_on_retire(spark, sf):
    return mem.transfer_on_retire(t.memory_items(spark, sf), t.successors(spark, sf),
                                  t.memory_as_of()).selectExpr(*_MOVED)


@query("retention", S.with_(*_M, select="""SELECT id, agent_id FROM items
  WHERE NOT (timestamp < TIMESTAMP '2024-02-01' - INTERVAL 30 DAYS AND importance < 0.3)"""))
def retention(spark, sf):
    return mem.retention(t.memory_items(spark, sf), t.memory_as_of()).select("id", "agent_id")


@query("retention_report", S.with_(*_M, select="""SELECT count(*) FILTER (timestamp < TIMESTAMP '2024-02-01' - INTERVAL 30 DAYS AND importance < 0.3) AS removed,
  count(*) FILTER (NOT (timestamp < TIMESTAMP '2024-02-01' - INTERVAL 30 DAYS AND importance < 0.3)) AS kept FROM items"""))
def retention_report(spark, sf):
    return mem.retention_report(t.memory_items(spark, sf), t.memory_as_of())


_LIMITS = {"default": (400, 6, 700, 0.6), "conservative": (300, 4, 700, 0.7),
           "aggressive": (500, 7, 700, 0.5), "research": (600, 7, 700, 0.4)}


@query("retirement_candidates", S.with_(*_A, "lim AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {a}, {b}, {c}, {d})" for k, (a, b, c, d) in _LIMITS.items())
    + ") v(agent_type, tok, items_max, hours, rate))", select="""SELECT agent_id, agent_type FROM agents JOIN lim USING (agent_type)
  WHERE total_tokens_used > tok OR memory_count > items_max
    OR epoch(TIMESTAMP '2024-02-01' - created_at) / 3600.0 > hours OR (win_rate < rate AND memory_count * 2 > 10)"""))
def retirement_candidates(spark, sf):
    return mem.retirement_candidates(t.agents(spark, sf), t.memory_as_of(), _LIMITS).select(
        "agent_id", "agent_type")


@query("initial_memories", S.with_(*_A, "g AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', '{s}')" for k, v in mem.GUIDELINES.items() for s in v)
    + ") v(agent_type, content))", select=f"""SELECT agent_id, content, 'guideline' AS memory_type, round(0.8 + 1e-9, 6) AS importance,
  agent_type AS last_tag, len(regexp_extract_all(content, '{S.TOKEN}')) AS token_count FROM agents JOIN g USING (agent_type)"""))
def initial_memories(spark, sf):
    return mem.initial_memories(t.agents(spark, sf), t.memory_as_of()).select(
        "agent_id", "content", "memory_type", "importance", F.col("tags")[2].alias("last_tag"),
        "token_count")


@query("session_start_memories", S.with_(*_A, "g AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', '{k}', {w}, '{tags[0]}')" for c, k, w, tags in mem.SESSION_START)
    + ") v(content, memory_type, importance, tag))", select="""SELECT agent_id, content, memory_type,
  round(CAST(importance AS DOUBLE) + 1e-9, 6) AS importance, tag FROM agents JOIN g ON true"""))
def session_start_memories(spark, sf):
    return mem.session_start_memories(t.agents(spark, sf), t.memory_as_of()).select(
        "agent_id", "content", "memory_type", "importance", F.col("tags")[0].alias("tag"))


@query("create_agents", "SELECT DISTINCT CAST(conv_id AS VARCHAR) || '-next' AS agent_id, 'default' AS agent_type, 0 AS total_tokens_used, 0 AS memories, true AS is_active FROM conversations")
def create_agents(spark, sf):
    ids = t.successors(spark, sf).select(F.col("successor_id").alias("agent_id"))
    return mem.create_agents(ids, t.memory_as_of()).select(
        "agent_id", "agent_type", "total_tokens_used", F.size("memory_items").alias("memories"),
        "is_active")


@query("lineage_memory", """SELECT DISTINCT CAST(conv_id AS VARCHAR) || '-next' AS agent_id, 'Successor agent created from ' || conv_id AS content,
  'system' AS memory_type, CAST(conv_id AS VARCHAR) AS parent, 5 AS token_count FROM conversations""")
def lineage_memory(spark, sf):
    return mem.lineage_memory(t.successors(spark, sf), t.memory_as_of()).select(
        "agent_id", "content", "memory_type",
        F.try_element_at("metadata", F.lit("parent_agent_id")).alias("parent"), "token_count")


@query("update_metrics", S.with_(*_A, select=f"""SELECT agent_id, {S.r('CASE WHEN is_active THEN avg_confidence + 1 ELSE win_rate END', 'win_rate')},
  {S.r('total_pnl')}, CASE WHEN is_active THEN CAST(2.5 AS DOUBLE) END AS sharpe_ratio FROM agents"""))
def update_metrics(spark, sf):
    agents = t.agents(spark, sf)
    metric = lambda k: F.try_element_at("performance_metrics", F.lit(k))
    updates = agents.filter("is_active").select("agent_id", F.create_map(
        F.lit("win_rate"), metric("avg_confidence") + 1, F.lit("sharpe_ratio"), F.lit(2.5))
        .alias("metrics"))
    return mem.update_metrics(agents, updates).select(
        "agent_id", *[metric(k).alias(k) for k in ("win_rate", "total_pnl", "sharpe_ratio")])


@query("agent_status", S.with_(*_A, select="""SELECT agent_id, is_active, total_tokens_used, memory_count,
  (SELECT count(*) FROM agents WHERE is_active) AS active_agents, (SELECT count(*) FROM agents) AS total_agents FROM agents"""))
def agent_status(spark, sf):
    return mem.agent_status(t.agents(spark, sf)).select(
        "agent_id", "is_active", "total_tokens_used", "memory_count", "active_agents",
        "total_agents")


_BOTH = (_rank("r20", _RECENT, 20), _rank("i10", _IMPORTANT, 10),
         "lists AS (SELECT *, 'recent' AS list FROM r20 UNION ALL SELECT *, 'important' FROM i10)")


@query("union_memories", S.with_(*_M, *_BOTH, select="SELECT agent_id, id, rank FROM lists"))
def union_memories(spark, sf):
    items = t.memory_items(spark, sf)
    return mem.union_memories(mem.top_recent(items, 20), mem.top_important(items, 10)).select(
        "agent_id", "id", "rank")


@query("memory_insights", S.with_(*_M, *_BOTH, """g AS (SELECT agent_id, count(*) FILTER (list = 'recent') AS recent_activity,
  count(*) FILTER (list = 'important') AS important_insights,
  count(*) FILTER (memory_type = 'analysis' AND signal = 'BUY') AS buy_signals,
  count(*) FILTER (memory_type = 'analysis' AND signal = 'SELL') AS sell_signals,
  count(*) FILTER (memory_type = 'analysis' AND signal = 'HOLD') AS hold_signals,
  count(*) FILTER (memory_type = 'trade_result' AND pnl > 0) / nullif(count(*) FILTER (memory_type = 'trade_result'), 0) AS win_rate
  FROM lists GROUP BY 1)""", select="""SELECT * REPLACE (round(win_rate + 1e-9, 6) AS win_rate), concat_ws('; ',
  CASE WHEN coalesce(win_rate, 0) < 0.5 THEN 'Consider more conservative trading approach' END,
  CASE WHEN buy_signals > sell_signals * 2 THEN 'Consider more balanced signal distribution' END) AS recommendations FROM g"""))
def memory_insights(spark, sf):
    return mem.memory_insights(t.memory_items(spark, sf))


_UPSERT = S.with_(*_M, select="SELECT id, agent_id, round(importance + CASE WHEN role = 'user' THEN 1 ELSE 0 END + 1e-9, 6) AS importance FROM items")


@query("upsert_latest", _UPSERT)
def upsert_latest(spark, sf):
    stored = t.memory_items(spark, sf).select("id", "agent_id", "importance", "timestamp",
                                              F.col("tags")[0].alias("role"))
    newer = stored.filter("role = 'user'").withColumn("importance", F.col("importance") + 1)
    return mem.upsert_latest(stored, newer, ["id"], "timestamp").select(
        "id", "agent_id", "importance")


@query("upsert_store", _UPSERT)
def upsert_store(spark, sf):
    """As ``upsert_latest`` in a stored table: half of the changes replace their buckets, half are added and folded."""
    stored = t.memory_items(spark, sf).select("id", "agent_id", "importance", "timestamp", F.col("tags")[0].alias("role"))
    store = KeyedStore.create(stored, scratch_path(spark, "store"), ["id"], "timestamp", buckets=16)
    newer = stored.filter("role = 'user'").withColumns({"importance": F.col("importance") + 1,
                                                        "timestamp": F.col("timestamp") + F.expr("INTERVAL 1 SECOND")})
    half = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    store.upsert(newer.filter(half))
    store.append(newer.filter(~half))
    store.compact()
    return store.read().select("id", "agent_id", "importance")
