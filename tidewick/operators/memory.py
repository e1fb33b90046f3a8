"""Agent memory tables: adding, ranking, budgeted context, hand-over and retention.

``items`` follow ``schemas.MEMORY_ITEMS``. Ranked lists are ``row_number() <= k`` with small k, which
Spark limits per task before the shuffle, so an agent with very many rows sends k rows per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewick.functions.text import performance_text, token_count
from tidewick.operators.pairs import meet, nearest
from tidewick.session import written

IMPORTANT, RECENT, CONTEXT_TOKENS = 20, 10, 2048

# Guidelines a new agent of each type starts with.
GUIDELINES = {
    "default": ["Always analyze technical indicators before making trading decisions",
                "Consider risk management and position sizing for every trade",
                "Monitor market sentiment and news events",
                "Keep detailed records of all trading decisions and outcomes"],
    "conservative": ["Prioritize capital preservation over aggressive gains",
                     "Use smaller position sizes and tighter stop losses",
                     "Focus on high-probability, low-risk setups",
                     "Avoid trading during high volatility periods"],
    "aggressive": ["Look for high-reward opportunities with calculated risks",
                   "Use larger position sizes for high-confidence setups",
                   "Be willing to take on more volatility for better returns",
                   "Act quickly on market opportunities"],
    "research": ["Focus on deep market analysis and research",
                 "Document all findings and insights thoroughly",
                 "Test strategies before implementing them",
                 "Continuously learn from market data and patterns"],
}
# Memories a trading session starts with (content, type, importance, tags).
SESSION_START = [
    ("Trading session started - monitor market conditions carefully", "system", 0.6,
     ["session_start", "trading"]),
    ("Always verify technical indicators before making trading decisions", "guideline", 0.8,
     ["technical_analysis", "guideline"]),
    ("Risk management is crucial - never risk more than 2% per trade", "guideline", 0.9,
     ["risk_management", "guideline"]),
]
# Retirement limits per agent type
# (tokens, memory items, lifetime hours, least win rate).
RETIREMENT = {"default": (50000, 800, 24, 0.6), "conservative": (30000, 400, 24, 0.7),
              "aggressive": (80000, 1200, 24, 0.5), "research": (100000, 1500, 24, 0.4)}


def add_memories(rows: DataFrame) -> DataFrame:
    """Complete (agent_id, content, memory_type, timestamp) rows; optional columns get defaults.

    ``source_id`` tells rows apart that agree in agent, content and time, as moved memories can.
    """
    has = set(rows.columns)
    source = [F.col("source_id")] if "source_id" in has else []
    meta = F.col("metadata") if "metadata" in has else F.create_map().cast("map<string,string>")
    meta = F.map_filter(F.coalesce(meta, F.create_map().cast("map<string,string>")),
                        lambda k, _: k != "agent_id")
    importance = F.col("importance") if "importance" in has else F.lit(None).cast("double")
    tags = F.col("tags") if "tags" in has else F.lit(None).cast("array<string>")
    return rows.select(
        F.md5(F.concat_ws("_", "agent_id", "content", F.col("timestamp").cast("string"), *source))
        .alias("id"),
        "agent_id", "content", "memory_type", "timestamp",
        F.coalesce(importance, F.lit(0.5)).alias("importance"),
        F.coalesce(tags, F.array().cast("array<string>")).alias("tags"),
        F.map_concat(meta, F.create_map(F.lit("agent_id"), "agent_id")).alias("metadata"),
        token_count(F.col("content")).alias("token_count"))


def agent_filter(items: DataFrame, *agents: str) -> DataFrame:
    return items.filter(F.col("agent_id").isin(*agents))


def _ranked(items: DataFrame, limit: int, *order: Column) -> DataFrame:
    w = Window.partitionBy("agent_id").orderBy(*order, F.col("id"))
    return items.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def top_important(items: DataFrame, limit: int = IMPORTANT) -> DataFrame:
    return _ranked(items, limit, F.col("importance").desc(), F.col("timestamp").desc())


def top_recent(items: DataFrame, limit: int = RECENT) -> DataFrame:
    return _ranked(items, limit, F.col("timestamp").desc())


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)


def unit(vector: Column) -> Column:
    """The vector at length one, in doubles; NULL for the zero vector."""
    x = F.transform(vector, lambda v: v.cast("double"))
    length = F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v))
    # An array of one binds the length; named in the inner function, it would be added up again for each number.
    return F.transform(F.array(length), lambda n: F.when(n > 0, F.transform(x, lambda v: v / n)))[0]


def semantic_topk(items: DataFrame, queries: DataFrame, k: int = IMPORTANT, *,
                  decimals: int | None = None) -> DataFrame:
    """The k items of the query's agent nearest by cosine, per query.

    ``queries`` is (query_id, agent_id, query). Vectors are brought to length one before they meet. Each item meets
    only its own agent's queries, in blocks of an agent's items and queries that are multiplied as matrices; a block
    passes on what can be among a query's first k, with the exact score. ``decimals`` rounds the score before ranking.
    """
    queries = written(queries.select("query_id", "agent_id", unit(F.col("query")).alias("_v")), "queries")
    items = items.select("agent_id", "id", unit(F.col("embedding")).alias("_v"))
    slack = 0.0 if decimals is None else 1.000001 * 10.0 ** -decimals
    pairs = meet(items, queries, nearest(k, slack), "score double", block=8192, chunk=(2048, 4096))
    if decimals is not None:
        pairs = pairs.withColumn("score", F.round("score", decimals))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def memory_hydrate(hits: DataFrame, items: DataFrame) -> DataFrame:
    """Hits by id to full memory rows."""
    extra = [x for x in items.columns if x not in hits.columns or x == "id"]
    return hits.join(items.select(*extra), "id")


def exclude_recent(relevant: DataFrame, recent: DataFrame) -> DataFrame:
    return relevant.join(recent.select("agent_id", "id"), ["agent_id", "id"], "left_anti")


def token_budget_context(recent: DataFrame, relevant: DataFrame,
                         max_tokens: int = CONTEXT_TOKENS) -> DataFrame:
    """Rows that fit the budget, in order, with ``phase`` 1 (recent) or 2 (relevant).

    Each phase stops at its own first overflow. In phase 2 a row already in the recent list is
    skipped, but only after the overflow check. Both inputs carry ``rank`` and at most a few dozen
    rows per agent.
    """
    keep = ["agent_id", "id", "memory_type", "content", "token_count", "rank"]
    both = (recent.select(*keep, F.lit(1).alias("phase"))
            .unionByName(relevant.select(*keep, F.lit(2).alias("phase"))))
    agent = Window.partitionBy("agent_id")
    order = agent.orderBy("phase", "rank")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("phase") == 1
    tokens = F.col("token_count")

    # Phase 1: tokens are never negative, so the first overflow is where the running sum exceeds.
    df = both.withColumn("_sum1", F.sum(F.when(first, tokens).otherwise(0)).over(upto))
    df = df.withColumns({
        "_keep1": first & (F.col("_sum1") <= max_tokens),
        "_dup": ~first & (F.max(first.cast("int")).over(
            Window.partitionBy("agent_id", "id")) == 1)})
    df = df.withColumn("_used1", F.sum(F.when(F.col("_keep1"), tokens).otherwise(0)).over(agent))
    # Phase 2: running tokens of non-duplicates before the row, and a sticky overflow flag.
    counted = F.when(~first & ~F.col("_dup"), tokens).otherwise(0)
    df = df.withColumn("_run2", F.col("_used1")
                       + F.coalesce(F.sum(counted).over(before), F.lit(0)))
    over = (~first & (F.col("_run2") + tokens > max_tokens)).cast("int")
    df = df.withColumn("_over", over).withColumn("_stop", F.max("_over").over(upto))
    kept = F.col("_keep1") | (~first & (F.col("_stop") == 0) & ~F.col("_dup"))
    return df.filter(kept).select(*keep, "phase")


def context_build(fitted: DataFrame, agents: DataFrame, max_tokens: int = CONTEXT_TOKENS
                  ) -> DataFrame:
    """One text per agent: ``[TYPE] content`` parts and, if it still fits, the performance line."""
    part = F.format_string("[%s] %s", F.upper("memory_type"), F.col("content"))
    parts = fitted.groupBy("agent_id").agg(
        F.array_sort(F.collect_list(F.struct("phase", "rank", part.alias("text"))))
        .alias("_parts"), F.sum("token_count").alias("_tokens"))
    df = agents.select("agent_id", "performance_metrics").join(parts, "agent_id", "left")
    tokens = F.coalesce("_tokens", F.lit(0))
    perf = performance_text(F.col("performance_metrics"))
    fits = tokens + token_count(perf) < max_tokens
    texts = F.coalesce(F.transform("_parts", lambda p: p["text"]),
                       F.array().cast("array<string>"))
    line = F.when(fits, F.array(F.concat(F.lit("[PERFORMANCE] "), perf))).otherwise(
        F.array().cast("array<string>"))
    return df.select("agent_id", F.array_join(F.concat(texts, line), "\n\n").alias("context"),
                     (tokens + F.when(fits, token_count(perf)).otherwise(0))
                     .alias("context_tokens"))


def retired_context(important: DataFrame, agents: DataFrame, max_tokens: int = CONTEXT_TOKENS
                    ) -> DataFrame:
    """The retired variant: performance line first, then important rows until the first overflow."""
    perf = performance_text(F.col("performance_metrics"))
    head = agents.select("agent_id", perf.alias("_perf"))
    w = (Window.partitionBy("agent_id").orderBy("rank")
         .rowsBetween(Window.unboundedPreceding, 0))
    fitted = (important.join(head, "agent_id").withColumn(
        "_sum", token_count(F.col("_perf")) + F.sum("token_count").over(w))
        .filter(F.col("_sum") <= max_tokens))
    part = F.format_string("[%s] %s", F.upper("memory_type"), F.col("content"))
    parts = fitted.groupBy("agent_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", part.alias("text")))).alias("_parts"),
        F.max("_sum").alias("_tokens"))
    texts = F.coalesce(F.transform("_parts", lambda p: p["text"]),
                       F.array().cast("array<string>"))
    first = F.array(F.concat(F.lit("[RETIRED_AGENT] "), "_perf"))
    return head.join(parts, "agent_id", "left").select(
        "agent_id", F.array_join(F.concat(first, texts), "\n\n").alias("context"),
        F.coalesce("_tokens", token_count(F.col("_perf"))).alias("context_tokens"))


def transfer_memories(items: DataFrame, successors: DataFrame, as_of: Column) -> DataFrame:
    """Top 100 by importance above 0.6 go to the successor at 0.8 of their importance.

    ``successors`` is (agent_id, successor_id), one row per retired agent.
    """
    top = top_important(items, 100).filter(F.col("importance") > 0.6)
    moved = top.join(successors, "agent_id").select(
        F.col("successor_id").alias("agent_id"), F.col("id").alias("source_id"), "content", "memory_type",
        as_of.alias("timestamp"), (F.col("importance") * 0.8).alias("importance"),
        F.array_append("tags", F.lit("transferred")).alias("tags"),
        F.map_concat(F.map_filter("metadata", lambda k, _: k != "transferred_from"),
                     F.create_map(F.lit("transferred_from"), "agent_id")).alias("metadata"))
    return add_memories(moved)


def transfer_on_retire(items: DataFrame, successors: DataFrame, as_of: Column) -> DataFrame:
    """Top 50 by importance, unchanged."""
    moved = top_important(items, 50).join(successors, "agent_id").select(
        F.col("successor_id").alias("agent_id"), F.col("id").alias("source_id"), "content", "memory_type",
        as_of.alias("timestamp"), "importance", "tags", "metadata")
    return add_memories(moved)


def _stale(as_of: Column, days: int, least: float) -> Column:
    return F.coalesce((F.col("timestamp") < as_of - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col("importance") < least), F.lit(False))


def retention(items: DataFrame, as_of: Column, days: int = 30, least: float = 0.3) -> DataFrame:
    """Drops rows that are both older than ``days`` and less important than ``least``."""
    return items.filter(~_stale(as_of, days, least))


def retention_report(items: DataFrame, as_of: Column, days: int = 30, least: float = 0.3) -> DataFrame:
    """One row: how many rows ``retention`` removes and keeps."""
    stale = _stale(as_of, days, least)
    return items.agg(F.count_if(stale).alias("removed"), F.count_if(~stale).alias("kept"))


def _limit(position: int, limits: Mapping[str, Sequence[float]]) -> Column:
    """A per-type limit; an unknown type uses the default's."""
    table = F.create_map(*[F.lit(x) for t, row in limits.items()
                           for x in (t, float(row[position]))])
    return F.coalesce(F.try_element_at(table, F.col("agent_type")),
                      F.lit(float(limits["default"][position])))


def _memory_count(agents: DataFrame) -> Column:
    """A counter column if the table keeps one, else the size of the id list."""
    return F.col("memory_count") if "memory_count" in agents.columns else F.size("memory_items")


def retirement_candidates(agents: DataFrame, as_of: Column,
                          limits: Mapping[str, Sequence[float]] = RETIREMENT) -> DataFrame:
    """Agents over a token, memory or age limit, or with a poor record over more than ten trades."""
    metric = lambda k: F.try_element_at("performance_metrics", F.lit(k))
    age_h = (F.unix_micros(as_of) - F.unix_micros("created_at")) / 3_600_000_000.0
    over = ((F.col("total_tokens_used") > _limit(0, limits))
            | (_memory_count(agents) > _limit(1, limits)) | (age_h > _limit(2, limits)))
    poor = F.coalesce((F.coalesce(metric("win_rate"), F.lit(0.0)) < _limit(3, limits))
                      & (metric("total_trades") > 10), F.lit(False))
    return agents.filter(over | poor)


def initial_memories(agents: DataFrame, as_of: Column) -> DataFrame:
    """Guideline rows per agent, chosen by its type; exploded from a literal, no join."""
    table = F.create_map(*[x for t, texts in GUIDELINES.items()
                           for x in (F.lit(t), F.array(*[F.lit(s) for s in texts]))])
    texts = F.coalesce(F.try_element_at(table, F.col("agent_type")),
                       F.array(*[F.lit(s) for s in GUIDELINES["default"]]))
    rows = agents.select("agent_id", "agent_type", F.explode(texts).alias("content"))
    return add_memories(rows.select(
        "agent_id", "content", F.lit("guideline").alias("memory_type"), as_of.alias("timestamp"),
        F.lit(0.8).alias("importance"),
        F.array(F.lit("initial"), F.lit("guideline"), "agent_type").alias("tags")))


def session_start_memories(agents: DataFrame, as_of: Column) -> DataFrame:
    rows = F.array(*[F.struct(
        F.lit(content).alias("content"), F.lit(kind).alias("memory_type"),
        F.lit(weight).alias("importance"), F.array(*[F.lit(t) for t in tags]).alias("tags"))
        for content, kind, weight, tags in SESSION_START])
    return add_memories(agents.select("agent_id", F.explode(rows).alias("_m")).select(
        "agent_id", "_m.*", as_of.alias("timestamp")))


def create_agents(ids: DataFrame, as_of: Column) -> DataFrame:
    """(agent_id[, agent_type]) rows to fresh agent rows."""
    kind = F.col("agent_type") if "agent_type" in ids.columns else F.lit("default")
    return ids.select(
        "agent_id", kind.alias("agent_type"), as_of.alias("created_at"),
        as_of.alias("last_active"), F.lit(0).cast("bigint").alias("total_tokens_used"),
        F.lit(0).alias("context_tokens"), F.array().cast("array<string>").alias("memory_items"),
        F.create_map().cast("map<string,double>").alias("performance_metrics"),
        F.lit(True).alias("is_active"))


def lineage_memory(successors: DataFrame, as_of: Column) -> DataFrame:
    return add_memories(successors.select(
        F.col("successor_id").alias("agent_id"),
        F.concat(F.lit("Successor agent created from "), "agent_id").alias("content"),
        F.lit("system").alias("memory_type"), as_of.alias("timestamp"),
        F.lit(0.3).alias("importance"),
        F.array(F.lit("successor"), F.lit("agent_creation")).alias("tags"),
        F.create_map(F.lit("parent_agent_id"), "agent_id").alias("metadata")))


def update_metrics(agents: DataFrame, updates: DataFrame) -> DataFrame:
    """Merge (agent_id, metrics) into the metrics map; the new value wins."""
    df = agents.join(updates, "agent_id", "left")
    old = F.map_filter("performance_metrics", lambda k, _: ~F.coalesce(
        F.map_contains_key("metrics", k), F.lit(False)))
    merged = F.when(F.col("metrics").isNull(), F.col("performance_metrics")).otherwise(
        F.map_concat(old, "metrics"))
    return df.withColumn("performance_metrics", merged).drop("metrics")


def token_usage(items: DataFrame) -> DataFrame:
    return items.groupBy("agent_id").agg(F.sum("token_count").alias("total_tokens_used"))


def agent_status(agents: DataFrame) -> DataFrame:
    """Per-agent state with the table's active and total counts."""
    counts = agents.agg(F.count_if("is_active").alias("a"), F.count(F.lit(1)).alias("n"))
    return agents.select(
        "agent_id", "is_active", "created_at", "last_active", "total_tokens_used",
        _memory_count(agents).alias("memory_count"), "performance_metrics",
        counts.select("a").scalar().alias("active_agents"),
        counts.select("n").scalar().alias("total_agents"))


def union_memories(recent: DataFrame, important: DataFrame) -> DataFrame:
    """Both lists, duplicates kept."""
    return recent.unionByName(important)


def memory_insights(items: DataFrame) -> DataFrame:
    """Signal counts, win rate and advice per agent over recent(20) and important(10) rows."""
    keep = ["agent_id", "id", "memory_type", "metadata"]
    both = union_memories(top_recent(items, 20).select(*keep, F.lit("recent").alias("list")),
                          top_important(items, 10).select(*keep, F.lit("important").alias("list")))
    analysis = F.col("memory_type") == "analysis"
    result = F.col("memory_type") == "trade_result"
    signal = F.coalesce(F.try_element_at("metadata", F.lit("signal")), F.lit("HOLD"))
    pnl = F.coalesce(F.try_element_at("metadata", F.lit("pnl")).try_cast("double"), F.lit(0.0))
    t = both.groupBy("agent_id").agg(
        F.count_if(F.col("list") == "recent").alias("recent_activity"),
        F.count_if(F.col("list") == "important").alias("important_insights"),
        *[F.count_if(analysis & (signal == s)).alias(f"{s.lower()}_signals")
          for s in ("BUY", "SELL", "HOLD")],
        F.count_if(result).alias("_trades"), F.count_if(result & (pnl > 0)).alias("_won"))
    t = t.withColumn("win_rate", F.when(F.col("_trades") > 0, F.col("_won") / F.col("_trades")))
    advice = F.array_compact(F.array(
        F.when(F.coalesce("win_rate", F.lit(0.0)) < 0.5,
               "Consider more conservative trading approach"),
        F.when(F.col("buy_signals") > F.col("sell_signals") * 2,
               "Consider more balanced signal distribution")))
    return t.withColumn("recommendations", F.array_join(advice, "; ")).drop("_trades", "_won")


def upsert_latest(stored: DataFrame, incoming: DataFrame, key: Sequence[str], version: str
                  ) -> DataFrame:
    """One row per key, the one with the highest version; incoming wins a tie.

    ``max_by`` over the packed row, so a key with many versions is reduced before the shuffle.
    """
    cols = stored.columns
    both = (stored.select(*cols, F.lit(0).alias("_new"))
            .unionByName(incoming.select(*cols, F.lit(1).alias("_new"))))
    row = F.struct(*[c for c in cols if c not in key])
    return (both.groupBy(*key).agg(F.max_by(row, F.struct(version, "_new")).alias("_r"))
            .select(*key, "_r.*").select(*cols))
