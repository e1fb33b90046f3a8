"""Queries that read and write: scans, sinks, column types, and streams run to completion."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tidewick import schemas
from tidewick.operators import live, quality, samples as smp
from tidewick.plans import sqltext as S, tables as t
from tidewick.plans.registry import query
from tidewick.session import scratch_path, written
from tidewick.sources import readers, stores, summaries, writers
from tidewick.streaming import jobs, keyed

OHLCV = ["open", "high", "low", "close", "volume"]
_BARS = "SELECT symbol AS product_id, timestamp, open, high, low, close, volume FROM bars"


def _candles(spark, sf):
    return t.candles(spark, sf).withColumnRenamed("symbol", "product_id").select(
        "timestamp", *OHLCV, "product_id")


# --- scans ---------------------------------------------------------------------------------------

@query("scan_candle_arrays", S.with_(S.TICKS, S.bars(), select=_BARS))
def scan_candle_arrays(spark, sf):
    path = scratch_path(spark, "arrays")
    t.candle_arrays(spark, sf).write.json(path)
    return readers.from_candle_arrays(readers.candle_arrays(spark, path))


@query("scan_ohlcv_csv", S.with_(S.TICKS, S.bars(), select=_BARS))
def scan_ohlcv_csv(spark, sf):
    path = scratch_path(spark, "csv")
    _candles(spark, sf).write.option("header", True).csv(path)
    return readers.ohlcv_csv(spark, path)


@query("scan_multi_symbol", S.with_(S.TICKS, S.bars(), select="""SELECT upper(symbol) || '-USD' AS symbol, timestamp, open, high, low, close, volume
  FROM bars WHERE symbol IN ('click', 'view', 'purchase')"""))
def scan_multi_symbol(spark, sf):
    """One candle file for each of three symbols; a fourth that is asked for has none."""
    path = scratch_path(spark, "symbols")
    candles = _candles(spark, sf)
    for symbol in ("click", "view", "purchase"):
        candles.filter(F.col("product_id") == symbol).write.option("header", True).csv(
            f"{path}/{symbol.upper()}_USD_1m_last_5y.csv")
    asked = ["CLICK-USD", "VIEW-USD", "PURCHASE-USD", "ABSENT-USD"]
    return readers.multi_symbol_csv(spark, path, asked).select("symbol", "timestamp", *OHLCV)


@query("scan_json_samples", S.hourly(f"""SELECT symbol, {S.r('close')}, {S.r('rsi')}, trend, signal, {S.r('confidence')} FROM lab""",
                                     S.ADVANCED, S.LABELLED))
def scan_json_samples(spark, sf):
    path = scratch_path(spark, "samples")
    smp.build_sample(t.labelled(spark, sf)).write.json(path)
    df = readers.json_samples(spark, path)
    return df.select("symbol", "price_data.close", "technical_indicators.rsi",
                     "market_context.trend", "signal", "confidence")


@query("scan_json_arrays", S.hourly(f"""SELECT symbol, {S.r('close')}, {S.r('rsi')}, trend, signal, {S.r('confidence')} FROM lab""",
                                    S.ADVANCED, S.LABELLED))
def scan_json_arrays(spark, sf):
    """Samples as top-level arrays, each file split over tasks."""
    path = scratch_path(spark, "arrays")
    writers.write_json_arrays(smp.build_sample(t.labelled(spark, sf)), path)
    df = readers.json_samples(spark, path, array=True, separator=readers.array_separator(2))
    return df.select("symbol", "price_data.close", "technical_indicators.rsi",
                     "market_context.trend", "signal", "confidence")


@query("malformed_array_samples", S.hourly("SELECT count(*) AS objects, count(*) FILTER (signal = 'BUY') AS malformed FROM adv", S.ADVANCED))
def malformed_array_samples(spark, sf):
    """Arrays of samples in which those that say BUY have a bracket too many."""
    path = scratch_path(spark, "arrays")
    text = F.to_json(F.struct("*"))
    broken = F.when(F.col("signal") == "BUY", F.replace(text, F.lit('"price_data":{'), F.lit('"price_data":[{'))).otherwise(text)
    writers.write_json_arrays(smp.build_sample(t.labelled(spark, sf)), path, text=broken)
    return readers.malformed_objects(spark, path, readers.array_separator(2)).agg(
        F.sum("objects").alias("objects"), F.sum("malformed").alias("malformed"))


def _chunked(spark, sf, rows=500):
    path = scratch_path(spark, "chunks")
    writers.write_chunks(_candles(spark, sf), path, rows)
    return path


@query("scan_chunks", S.with_(S.TICKS, S.bars(), select=_BARS))
def scan_chunks(spark, sf):
    return readers.chunks(spark, _chunked(spark, sf)).drop("chunk")


@query("scan_first_chunks", S.with_(S.TICKS, S.bars(), select="SELECT 2 AS chunks, true AS whole FROM bars LIMIT 1"))
def scan_first_chunks(spark, sf):
    """The first two chunk files by name, each with all its rows."""
    path = _chunked(spark, sf)
    sizes = writers.chunk_metadata(spark, path).select(F.col("filename").alias("chunk"), "rows")
    got = readers.chunks(spark, path, max_chunks=2).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    return got.join(sizes, "chunk").agg(F.count(F.lit(1)).cast("int").alias("chunks"),
                                        F.bool_and(F.col("n") == F.col("rows")).alias("whole"))


@query("malformed_samples", S.hourly("SELECT count(*) AS objects, count(*) FILTER (signal = 'BUY') AS malformed FROM adv", S.ADVANCED))
def malformed_samples(spark, sf):
    """Samples of which those that say BUY are cut off in the middle."""
    path = scratch_path(spark, "samples")
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("signal") == "BUY", F.substring(line, 1, 40)).otherwise(line)
    smp.build_sample(t.labelled(spark, sf)).select(cut.alias("value")).write.text(path)
    return readers.malformed_objects(spark, path).agg(F.sum("objects").alias("objects"),
                                                      F.sum("malformed").alias("malformed"))


@query("union_chunks", S.with_(S.TICKS, S.bars(), select="SELECT symbol AS product_id, timestamp, close FROM bars UNION ALL SELECT symbol, timestamp, close FROM bars"))
def union_chunks(spark, sf):
    """Two chunk folders read as one."""
    return spark.read.schema(schemas.CANDLES).parquet(
        _chunked(spark, sf), _chunked(spark, sf, 1000)).select("product_id", "timestamp", "close")


@query("union_samples", S.hourly(f"SELECT symbol, timestamp, signal FROM adv UNION ALL SELECT symbol, timestamp, signal FROM adv WHERE signal <> 'HOLD'", S.ADVANCED))
def union_samples(spark, sf):
    rows = t.labelled(spark, sf).select("symbol", "timestamp", "signal")
    return quality.union_assets(rows, rows.filter("signal <> 'HOLD'"))


@query("scan_event_log", S.with_(S.TRADES, select="""SELECT strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp, type, symbol, price FROM (
  SELECT *, 'trade_execution' AS type FROM trades WHERE action <> 'hold') ORDER BY timestamp DESC,
  to_json({'trade_id': trade_id, 'symbol': symbol, 'price': price}) DESC LIMIT 5"""))
def scan_event_log(spark, sf):
    path = scratch_path(spark, "log")
    trades = t.trades(spark, sf)
    at = F.col("timestamp")
    data = F.struct("trade_id", "symbol", "price")
    live = F.col("action") != "hold"
    for kind, rows in (("trade_execution", trades.filter(live)),
                       ("signal_generation", trades.filter(~live))):
        writers.append_event_log(rows.select(*writers.log_event(kind, data, at)), path)
    recent = readers.recent_of_type(readers.event_log(spark, path), "trade_execution", 5)
    return recent.select(F.substring("timestamp", 1, 19).alias("timestamp"), "type",
                         F.get_json_object("data", "$.symbol").alias("symbol"),
                         F.get_json_object("data", "$.price").cast("double").alias("price"))


@query("historical_bars", S.with_(S.TICKS, S.bars("15 minutes"), select=f"""SELECT symbol, timestamp, open, high, low, close, volume,
  trade_count, {S.r('vwap')} FROM bars WHERE symbol = 'click' AND timestamp >= TIMESTAMP '2024-01-19 12:00:00'
  AND timestamp < TIMESTAMP '2024-01-20 12:00:00' ORDER BY timestamp LIMIT 100"""))
def historical_bars(spark, sf):
    end = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return readers.historical_bars(t.ticks(spark, sf), "click", "15Min", end)


@query("historical_bars_whole", S.with_(S.TICKS, S.bars("1 day"), S.bars("1 hour", "hours"), select=f"""SELECT 'day' AS frame, timestamp, open, close, trade_count
  FROM bars WHERE symbol = 'click' AND timestamp >= TIMESTAMP '2024-01-17 12:30:00' AND timestamp < TIMESTAMP '2024-01-20 12:30:00'
  UNION ALL SELECT 'hour', timestamp, open, close, trade_count FROM hours WHERE symbol = 'click'
  AND timestamp >= TIMESTAMP '2024-01-17 12:30:00' AND timestamp < TIMESTAMP '2024-01-20 12:30:00'"""))
def historical_bars_whole(spark, sf):
    """A range that cuts bars: only those that start in it, and they are whole."""
    end = F.lit("2024-01-20 12:30:00").cast("timestamp")
    parts = [readers.historical_bars(t.ticks(spark, sf), "click", frame, end, hours=72).select(
        F.lit(name).alias("frame"), "timestamp", "open", "close", "trade_count")
        for name, frame in (("day", "1Day"), ("hour", "1Hour"))]
    return parts[0].unionByName(parts[1])


@query("account_scan", """SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_acctbal AS equity, c_acctbal * 0.5 AS cash, c_acctbal * 2 AS buying_power,
  c_acctbal * 1.5 AS portfolio_value, c_acctbal < 0 AS trading_blocked, c_custkey % 2 = 0 AS pattern_day_trader FROM customer""")
def account_scan(spark, sf):
    raw = t.read(spark, sf, "customer").selectExpr(
        "c_custkey AS account_id", "string(c_acctbal) AS equity", "c_acctbal * 0.5 AS cash", "c_acctbal * 2 AS buying_power",
        "c_acctbal * 1.5 AS portfolio_value", "c_acctbal < 0 AS trading_blocked", "c_custkey % 2 = 0 AS pattern_day_trader")
    return readers.account_scan(raw)


@query("dataset_metadata_scan", S.with_(S.TICKS, S.bars(), select="SELECT count(*) AS total_samples, 500 AS chunk_size, 'parquet' AS format FROM bars"))
def dataset_metadata_scan(spark, sf):
    path = scratch_path(spark, "metadata")
    writers.dataset_metadata(spark, _chunked(spark, sf), 500).write.json(path)
    return readers.dataset_metadata(spark, path).select("total_samples", "chunk_size", "format")


# --- sinks ---------------------------------------------------------------------------------------

@query("incremental_append", S.with_(S.TICKS, S.bars(), select=_BARS))
def incremental_append(spark, sf):
    """Bars up to a date are stored; the whole series is delivered again; only new rows append."""
    path = scratch_path(spark, "candles")
    candles = _candles(spark, sf)
    candles.filter("timestamp < TIMESTAMP '2024-01-15'").write.parquet(path)
    writers.incremental_append(spark, candles, path)
    return spark.read.schema(schemas.CANDLES).parquet(path)


@query("incremental_append_summary", S.with_(S.TICKS, S.bars(), select=_BARS))
def incremental_append_summary(spark, sf):
    """As ``incremental_append``, in three loads; last times come from the summaries of the loads."""
    candles = _candles(spark, sf)
    store = stores.SeriesStore(spark, scratch_path(spark, "series"), schemas.CANDLES.simpleString()[7:-1].replace(":", " ")).create()
    for end in ("2024-01-15", "2024-01-20"):
        store.append(candles.filter(F.col("timestamp") < end))
    store.append(candles)
    return store.read()


@query("write_chunks", S.with_(S.TICKS, S.bars(), select="SELECT count(*) AS rows, true AS all_within FROM bars"))
def write_chunks(spark, sf):
    return writers.chunk_metadata(spark, _chunked(spark, sf)).agg(
        F.sum("rows").alias("rows"), F.bool_and(F.col("rows") <= 500).alias("all_within"))


@query("write_ordered_chunks", S.with_(S.TICKS, S.bars(), select="""SELECT n // 500 AS chunk, count(*) AS rows, arg_min(symbol, n) AS first_symbol,
  min(n) AS first_row, arg_max(timestamp, n) AS last_time FROM (SELECT *, row_number() OVER (ORDER BY symbol, timestamp) - 1 AS n FROM bars) GROUP BY 1"""))
def write_ordered_chunks(spark, sf):
    """Chunks of 500 bars in (symbol, time) order."""
    path = scratch_path(spark, "ordered-chunks")
    bars = t.candles(spark, sf)
    writers.write_ordered_chunks(bars, path, ["symbol", "timestamp"], rows_per_file=500)
    order = F.struct("symbol", "timestamp")
    return spark.read.parquet(path).groupBy(F.col("chunk").cast("bigint").alias("chunk")).agg(
        F.count(F.lit(1)).alias("rows"), F.min_by("symbol", order).alias("first_symbol"),
        F.max_by("timestamp", order).alias("last_time")).withColumn("first_row", F.col("chunk") * 500)


def _ordered(spark, sf):
    path = scratch_path(spark, "ordered-chunks")
    writers.write_ordered_chunks(t.candles(spark, sf), path, ["symbol", "timestamp"], rows_per_file=500)
    return path


@query("dataset_metadata", S.with_(S.TICKS, S.bars(), select="""SELECT count(*) AS total_samples, (count(*) + 499) // 500 AS total_chunks, 500 AS chunk_size,
  true AS size_agrees, 'parquet' AS format, 'snappy' AS compression FROM bars"""))
def dataset_metadata(spark, sf):
    """Totals of chunks of 500 bars; their size is compared with the folder's."""
    path = _ordered(spark, sf)
    stored = writers.folder_bytes(spark, f"{path}/chunk=*").scalar()
    return writers.dataset_metadata(spark, path, 500).withColumn("size_agrees", F.col("size_bytes") == stored).drop("size_bytes")


@query("chunk_list", S.with_(S.TICKS, S.bars(), select="""SELECT n // 500 AS chunk_id, count(*) AS rows, true AS named, true AS sized
  FROM (SELECT row_number() OVER (ORDER BY symbol, timestamp) - 1 AS n FROM bars) GROUP BY 1"""))
def chunk_list(spark, sf):
    """Every chunk with its rows; that it has a name, and a size that fits."""
    path = _ordered(spark, sf)
    sizes = spark.read.format("binaryFile").load(f"{path}/chunk=*").select(
        F.regexp_extract("path", "/chunk=([0-9]+)/", 1).cast("long").alias("chunk_id"),
        F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length"))
    return writers.chunk_list(spark, path).join(sizes, ["chunk_id", "filename"]).select(
        "chunk_id", "rows", F.col("filename").endswith(".parquet").alias("named"),
        ((F.col("size_bytes") == F.col("length")) & (F.abs(F.col("size_mb") * 1048576 - F.col("length")) < 1)).alias("sized"))


@query("chunk_summaries", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS present, true AS near, count(DISTINCT {c}) / count(*) < 0.5 AS low_cardinality FROM orders"""
    for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")))
def chunk_summaries(spark, sf):
    """Cardinalities of two deliveries of chunks from their summaries, within 5 % of the exact counts."""
    path = scratch_path(spark, "summarised")
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    orders = t.read(spark, sf, "orders").select(*names)
    for part in (0, 1):
        orders.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == part).write.option("maxRecordsPerFile", 5000).mode("append").parquet(path)
        summaries.add_summaries(spark, path)
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in names])
    exact = exact.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in names])).alias("x")).select("x.*")
    got = summaries.merged(spark, path).join(summaries.low_cardinality(spark, path).select("column", "low_cardinality"), "column")
    return got.join(exact, "column").select("column", "rows", "present", (F.abs(F.col("distinct") / F.col("exact") - 1) < 0.05).alias("near"),
                                            "low_cardinality")


@query("conversion_report", "SELECT true AS smaller, true AS sizes_agree, count(*) AS rows FROM orders")
def conversion_report(spark, sf):
    """Trades as JSON against the same rows as Parquet chunks."""
    source, target = scratch_path(spark, "json"), scratch_path(spark, "chunks")
    t.trades(spark, sf).write.json(source)
    writers.write_chunks(spark.read.schema(t.trades(spark, sf).schema).json(source), target)
    report = writers.conversion_report(spark, source, target)
    # The same sizes by another path: the length of the lines, and what the chunks' metadata say.
    lines = spark.read.text(source).agg(F.sum(F.octet_length("value") + 1)).scalar()
    stored = writers.chunk_metadata(spark, target).agg(F.sum("size_bytes")).scalar()
    return report.select(
        (F.col("reduction_pct") > 50).alias("smaller"),
        ((F.col("input_bytes") == lines) & (F.col("output_bytes") == stored)
         & (F.abs(100 * stored / lines + F.col("reduction_pct") - 100) < 1e-6)).alias("sizes_agree"),
        spark.read.parquet(target).agg(F.count(F.lit(1))).scalar().alias("rows"))


@query("write_samples_json", S.hourly("SELECT symbol, count(*) AS n, count(*) FILTER (signal = 'BUY') AS buys FROM adv GROUP BY 1", S.ADVANCED))
def write_samples_json(spark, sf):
    path = scratch_path(spark, "samples")
    writers.write_samples_json(smp.build_sample(t.labelled(spark, sf)), path)
    df = spark.read.schema(schemas.SAMPLE).json(path)
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"),
                                    F.count_if(F.col("signal") == "BUY").alias("buys"))


@query("combine_csv", S.with_(S.TICKS, S.bars(), select=_BARS))
def combine_csv(spark, sf):
    path = scratch_path(spark, "combined")
    writers.combine_csv(_candles(spark, sf), path, "product_id", "timestamp")
    return readers.ohlcv_csv(spark, path)


# --- column types --------------------------------------------------------------------------------

def _narrow_sql() -> str:
    ints = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int"}
    rest = {"l_quantity": "float", "l_extendedprice": "float", "l_discount": "float", "l_tax": "float"}
    fixed = {"l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
    parts = [f"""SELECT '{c}' AS "column", '{k}' AS current_type, CASE WHEN max({c}) <= 127 AND min({c}) >= -128 THEN 'tinyint'
      WHEN max({c}) <= 32767 AND min({c}) >= -32768 THEN 'smallint' WHEN max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END AS narrow_type FROM lineitem"""
             for c, k in ints.items()]
    parts += [f"SELECT '{c}', 'double', '{k}'" for c, k in rest.items()]
    parts += [f"SELECT '{c}', '{k}', '{k}'" for c, k in fixed.items()]
    return " UNION ALL ".join(parts)


@query("infer_narrow_schema", _narrow_sql())
def infer_narrow_schema(spark, sf):
    return quality.infer_narrow_schema(t.read(spark, sf, "lineitem"))


@query("narrow_types", """SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_quantity AS DOUBLE) AS l_quantity,
  round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) + 1e-9, 6) AS l_extendedprice FROM lineitem""")
def narrow_types(spark, sf):
    narrow = quality.narrow_types(t.read(spark, sf, "lineitem"))
    return narrow.select("l_orderkey", "l_linenumber", "l_suppkey",
                         F.col("l_quantity").cast("double").alias("l_quantity"),
                         F.col("l_extendedprice").cast("double").alias("l_extendedprice"))


def _as_text(spark, sf):
    return quality.stringify_all(t.read(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderpriority"))


@query("coerce_numeric_strings", "SELECT CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_totalprice, o_orderpriority FROM orders")
def coerce_numeric_strings(spark, sf):
    return quality.coerce_numeric_strings(_as_text(spark, sf))


@query("numeric_string_columns", """SELECT 'o_orderkey' AS "column", count(*) AS "values", count(*) AS parsed, true AS "numeric" FROM orders
  UNION ALL SELECT 'o_totalprice', count(*), count(*), true FROM orders UNION ALL SELECT 'o_orderpriority', count(*), 0, false FROM orders""")
def numeric_string_columns(spark, sf):
    return quality.numeric_string_columns(_as_text(spark, sf))


@query("low_cardinality_columns", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS rows, count(DISTINCT {c}) AS "distinct", count(DISTINCT {c}) / count(*) < 0.5 AS low_cardinality FROM documents"""
    for c in ("text", "lang", "source")))
def low_cardinality_columns(spark, sf):
    return quality.low_cardinality_columns(t.read(spark, sf, "documents"), exact=True)


@query("stringify_all", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def stringify_all(spark, sf):
    return quality.stringify_all(t.read(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"))


# --- streams -------------------------------------------------------------------------------------

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _tick_stream(spark, sf):
    raw = (spark.readStream.schema(_EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf))
    return raw.select(
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("size"),
        F.col("event_id").alias("trade_id"))


def _collected(spark, stream):
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    jobs.run_available(stream, out, checkpoint)
    return spark.read.schema(stream.schema).parquet(out)


#: The same for bars that are known an hour after their time, so that they fall behind quotes and trades.
_KEYED_DELAY = "8 hours"
#: Files of a feed come in time order, but a row may be in the file after its own: it is up to so late.
_DELAY = "6 hours"


def _feed_files(spark, rows, at="timestamp"):
    """A feed of four files that overlap by up to six hours."""
    path = scratch_path(spark, "feed")
    rows = written(rows, "feed-rows")
    late = F.expr("INTERVAL 1 MINUTE") * F.pmod(F.xxhash64(*[c for c, k in rows.dtypes if k != "double"]), F.lit(360))
    part = F.datediff(F.col(at) + late, F.lit("2024-01-01")) / 8
    for n in range(4):  # the first and the last file also hold what lies outside
        inside = (F.lit(True) if n == 0 else part >= n) & (F.lit(True) if n == 3 else part < n + 1)
        rows.filter(inside).coalesce(1).write.mode("append").parquet(path)
    return path


def _bar_stream(spark, sf, frame="1Hour"):
    """One file of bars for each trigger."""
    return jobs.stream_source(spark, _feed_files(spark, t.bars(spark, sf, frame)), "bar", files_per_trigger=1)


def _in_ranges(spark, stream, step):
    """Ranges close behind the overlap of two files, the last one at the end."""
    return jobs.run_ranges(stream, step(scratch_path(spark, "ranges"), _DELAY), scratch_path(spark, "ranges-state"))


def _quotes(spark, sf):
    """Every third tick read as a quote around its price."""
    price = F.col("price")
    return t.ticks(spark, sf).filter("trade_id % 3 = 0").select(
        "timestamp", "symbol", (price - 0.5).alias("bid_price"), (price + 0.5).alias("ask_price"),
        F.col("trade_id").cast("double").alias("bid_size"), F.col("size").alias("ask_size"))


def _trades(spark, sf):
    return t.ticks(spark, sf).filter("trade_id % 3 <> 0").select("timestamp", "symbol", "price", "size", "trade_id")


def _shown_context(df):
    """The lists as what tells them apart: counts, ends, and sums that depend on every row and its place."""
    def placed(values):
        return F.aggregate(F.zip_with(values, F.sequence(F.lit(1), F.size(values)), lambda x, i: x * i), F.lit(0.0), lambda a, x: a + x)

    bids, trades = F.col("quotes.bid_size"), F.transform("trades.trade_id", lambda x: x.cast("double"))
    return df.select(
        "symbol", "timestamp", "latest_price", "sma_5", "trend", F.size("quotes").alias("quotes"), F.size("trades").alias("trades"),
        F.try_element_at("quotes.ask_price", F.lit(-1)).alias("last_ask"), F.try_element_at("trades.price", F.lit(1)).alias("first_price"),
        F.when(F.size("quotes") > 0, placed(bids)).alias("quote_places"), F.when(F.size("trades") > 0, placed(trades)).alias("trade_places"))


_CONTEXT_SQL = S.with_(S.TICKS, S.bars(), """w AS (SELECT *, timestamp + INTERVAL 1 HOUR AS known, row_number() OVER v AS k,
    avg(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 4 PRECEDING) AS s5,
    avg(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING) AS s20 FROM bars WINDOW v AS (PARTITION BY symbol ORDER BY timestamp)),
  x AS (SELECT *, CASE WHEN k >= 5 THEN s5 ELSE close END AS a5, CASE WHEN k >= 20 THEN s20 ELSE close END AS a20 FROM w),
  qs AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp, trade_id) AS n FROM ticks WHERE trade_id % 3 = 0),
  ts AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp, trade_id) AS n FROM ticks WHERE trade_id % 3 <> 0),
  qn AS (SELECT symbol, timestamp, max(n) AS n FROM qs GROUP BY 1, 2), tn AS (SELECT symbol, timestamp, max(n) AS n FROM ts GROUP BY 1, 2),
  qa AS (SELECT x.*, coalesce(qn.n, 0) AS qn FROM x ASOF LEFT JOIN qn ON x.symbol = qn.symbol AND x.known >= qn.timestamp),
  ends AS (SELECT qa.*, coalesce(tn.n, 0) AS tn FROM qa ASOF LEFT JOIN tn ON qa.symbol = tn.symbol AND qa.known >= tn.timestamp),
  ql AS (SELECT e.symbol, e.timestamp, count(*) AS quotes, arg_max(price + 0.5, n) AS last_ask,
    sum(CAST(trade_id AS DOUBLE) * (n - greatest(e.qn - 10, 0))) AS quote_places FROM ends e JOIN qs ON qs.symbol = e.symbol AND n > e.qn - 10 AND n <= e.qn GROUP BY 1, 2),
  tl AS (SELECT e.symbol, e.timestamp, count(*) AS trades, arg_min(price, n) AS first_price,
    sum(CAST(trade_id AS DOUBLE) * (n - greatest(e.tn - 10, 0))) AS trade_places FROM ends e JOIN ts ON ts.symbol = e.symbol AND n > e.tn - 10 AND n <= e.tn GROUP BY 1, 2)""",
  select=f"""SELECT e.symbol, e.timestamp, close AS latest_price, {S.r('CASE WHEN k >= 2 THEN a5 END', 'sma_5')},
  CASE WHEN k >= 2 THEN CASE WHEN a5 > a20 THEN 'bullish' WHEN a5 < a20 THEN 'bearish' ELSE 'neutral' END END AS trend,
  coalesce(quotes, 0) AS quotes, coalesce(trades, 0) AS trades, last_ask, first_price, quote_places, trade_places
  FROM ends e LEFT JOIN ql USING (symbol, timestamp) LEFT JOIN tl USING (symbol, timestamp)""")


@query("live_context", _CONTEXT_SQL)
def live_context(spark, sf):
    """Price, indicators and the last ten quotes and trades when each hourly bar closes."""
    return _shown_context(live.live_context(t.bars(spark, sf), _quotes(spark, sf), _trades(spark, sf), "1 HOUR", digits=None))


def _keyed(spark, sf, build, bars):
    """Runs a keyed stream over bars to its end; heartbeats far behind the last bar let out what waits."""
    keyed.with_state_store(spark)
    out, beats = scratch_path(spark, "keyed"), scratch_path(spark, "heartbeats")
    streams = []

    def built(heartbeats):
        streams.append(build(heartbeats))
        return streams[-1]

    jobs.run_to_end(spark, built, out, scratch_path(spark, "keyed-state"), beats, bars.select("symbol").distinct(),
                    F.lit("2024-03-01").cast("timestamp"))
    return spark.read.schema(streams[-1].schema).parquet(out)


@query("stream_live_context", _CONTEXT_SQL)
def stream_live_context(spark, sf):
    """As ``live_context``, from three feeds, with a symbol's last rows as keyed state."""
    bars = t.bars(spark, sf)
    feeds = [(_feed_files(spark, rows), kind) for rows, kind in ((bars, "bar"), (_quotes(spark, sf), "quote"), (_trades(spark, sf), "trade"))]

    def build(heartbeats):
        streams = [jobs.stream_source(spark, path, kind, files_per_trigger=1) for path, kind in feeds]
        return jobs.keyed_context(*streams, "1 HOUR", _KEYED_DELAY, heartbeats=heartbeats)

    return _shown_context(_keyed(spark, sf, build, bars))


@query("stream_sources", S.with_(S.TICKS, select="SELECT trade_id, symbol, timestamp, price, size FROM ticks WHERE symbol IN ('click', 'view')"))
def stream_sources(spark, sf):
    path = scratch_path(spark, "ticks")
    t.ticks(spark, sf).write.parquet(path)
    return _collected(spark, jobs.stream_source(spark, path, "trade", symbols=["click", "view"]))


@query("stream_ingest", S.with_(S.TICKS, select="SELECT trade_id, symbol, timestamp, price, size FROM ticks"))
def stream_ingest(spark, sf):
    return _collected(spark, jobs.stream_ingest(_tick_stream(spark, sf), "trade"))


@query("stream_bars", S.with_(S.TICKS, S.bars(), select=f"""SELECT symbol, timestamp, open, high, low, close, volume, trade_count, {S.r('vwap')}
  FROM bars WHERE timestamp + INTERVAL 1 HOUR <= (SELECT max(timestamp) FROM ticks) - INTERVAL 10 MINUTES"""))
def stream_bars(spark, sf):
    """Closed windows only: the last ones stay open until the watermark passes them."""
    return _collected(spark, jobs.stream_bars(_tick_stream(spark, sf), "1Hour", "10 minutes"))


@query("stream_last_n", S.with_(S.TICKS, S.bars(), """w AS (SELECT *, row_number() OVER v AS k, lag(close) OVER v AS prev,
    avg(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 4 PRECEDING) AS s5,
    avg(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING) AS s20,
    avg(volume) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING) AS av,
    list(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS 19 PRECEDING) AS c FROM bars WINDOW v AS (PARTITION BY symbol ORDER BY timestamp)),
  x AS (SELECT *, CASE WHEN k >= 5 THEN s5 ELSE close END AS a5, CASE WHEN k >= 20 THEN s20 ELSE close END AS a20,
    list_transform(range(1, least(len(c), 10)), lambda i: (c[i + 1] - c[i]) / c[i]) AS rets FROM w)""",
  select=f"""SELECT symbol, timestamp, close AS latest_price, least(k, 1000) AS bars, {S.r('CASE WHEN k >= 2 THEN a5 END', 'sma_5')},
  {S.r('CASE WHEN k >= 2 THEN a20 END', 'sma_20')}, {S.r('close - prev', 'price_change')}, {S.r('(close - prev) / prev * 100', 'price_change_pct')},
  {S.r('CASE WHEN k >= 2 THEN CASE WHEN av > 0 THEN volume / av ELSE 1 END END', 'volume_ratio')},
  {S.r('CASE WHEN k >= 10 THEN sqrt(list_sum(list_transform(rets, lambda q: q * q)) / len(rets)) * 100 WHEN k >= 2 THEN 0 END', 'volatility')},
  CASE WHEN k >= 2 THEN CASE WHEN a5 > a20 THEN 'bullish' WHEN a5 < a20 THEN 'bearish' ELSE 'neutral' END END AS trend FROM x"""))
def stream_last_n(spark, sf):
    return _in_ranges(spark, _bar_stream(spark, sf), jobs.stream_last_n)


_MOMENTUM_SQL = S.with_(S.TICKS, S.bars(), """m AS (SELECT symbol, timestamp, close, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) AS n,
    avg(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS ra,
    avg(close) OVER (PARTITION BY symbol ORDER BY timestamp ROWS BETWEEN 9 PRECEDING AND 5 PRECEDING) AS oa FROM bars)""",
  select="""SELECT symbol, timestamp, close, least(n, 100) AS history, CASE WHEN n >= 10 THEN round(ra + 1e-9, 6) END AS recent_avg,
    CASE WHEN n >= 10 THEN round(oa + 1e-9, 6) END AS older_avg,
    CASE WHEN n >= 10 THEN CASE WHEN ra > oa * 1.02 THEN 'bullish' WHEN ra < oa * 0.98 THEN 'bearish' ELSE 'none' END END AS momentum FROM m""")


@query("stream_momentum", _MOMENTUM_SQL)
def stream_momentum(spark, sf):
    return _in_ranges(spark, _bar_stream(spark, sf), jobs.stream_momentum)


@query("stream_momentum_keyed", _MOMENTUM_SQL)
def stream_momentum_keyed(spark, sf):
    """As ``stream_momentum``, with a symbol's last closes as keyed state."""
    bars = t.bars(spark, sf)
    path = _feed_files(spark, bars)
    return _keyed(spark, sf, lambda beats: jobs.keyed_momentum(
        jobs.stream_source(spark, path, "bar", files_per_trigger=1), _DELAY, heartbeats=beats), bars)


@query("stream_decide", S.hourly(f"""SELECT symbol, timestamp, close, action, {S.r('confidence')}, reason IS NULL AS is_valid, reason FROM (
  SELECT *, CASE WHEN NOT symbol IN ('click', 'view', 'purchase') THEN 'invalid signal format' WHEN done >= 40 THEN 'daily trade limit reached'
    WHEN lost <= -5000 THEN 'daily loss limit exceeded' WHEN NOT (action = 'hold' OR symbol <> 'view') THEN 'position limits exceeded'
    WHEN confidence < 0.6 THEN 'signal confidence too low' END AS reason FROM verdicts)""", S.ADVANCED, """executed AS (
  SELECT timestamp, sum(CASE WHEN price < 50 THEN price - 50 ELSE 0 END) AS pnl, count(*) AS n FROM ticks WHERE trade_id % 10 = 0 GROUP BY 1)""",
  """verdicts AS (SELECT a.symbol, a.timestamp, a.close, a.confidence, CASE signal WHEN 'BUY' THEN 'buy' WHEN 'SELL' THEN 'sell' ELSE 'hold' END AS action,
  coalesce((SELECT sum(n) FROM executed e WHERE e.timestamp < a.timestamp AND e.timestamp >= date_trunc('day', a.timestamp)), 0) AS done,
  coalesce((SELECT sum(pnl) FROM executed e WHERE e.timestamp < a.timestamp AND e.timestamp >= date_trunc('day', a.timestamp)), 0) AS lost FROM adv a)"""))
def stream_decide(spark, sf):
    """Verdicts of one account that holds 'view'; every tenth tick was a trade of it."""
    limits = jobs.RiskLimits(symbols=("click", "view", "purchase"), max_daily_trades=40, max_daily_loss=5000.0)
    price = F.col("price")
    executed = t.ticks(spark, sf).filter("trade_id % 10 = 0").select(
        "timestamp", F.when(price < 50, price - 50).otherwise(0.0).alias("pnl"))
    positions = spark.createDataFrame([("view", 3.0), ("signup", 0.0)], "symbol string, qty double")
    step = partial(jobs.decide_step, limits=limits, positions=lambda: positions, executed=lambda: executed)
    return _in_ranges(spark, _bar_stream(spark, sf), lambda root, delay: step(root, delay=delay)).select(
        "symbol", "timestamp", "close", "action", "confidence", "is_valid", "reason")


@query("stream_log_sink", S.with_(S.TICKS, select="SELECT 'signal_generation' AS type, symbol, count(*) AS n FROM ticks GROUP BY 2"))
def stream_log_sink(spark, sf):
    out, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "log-state")
    ticks = _tick_stream(spark, sf)
    events = ticks.select(*writers.log_event("signal_generation", F.struct("symbol", "price"),
                                             F.col("timestamp")))
    jobs.stream_log_sink(events, out, checkpoint)
    log = readers.event_log(spark, out)
    return log.groupBy("type", F.get_json_object("data", "$.symbol").alias("symbol")).agg(
        F.count(F.lit(1)).alias("n"))


@query("stream_incremental_load", S.with_(S.TICKS, S.bars(), select="SELECT symbol, timestamp, close FROM bars"))
def stream_incremental_load(spark, sf):
    """Two deliveries and three runs on one checkpoint: each file is loaded once."""
    source, out = scratch_path(spark, "landing"), scratch_path(spark, "loaded")
    checkpoint = scratch_path(spark, "load-state")
    bars = t.bars(spark, sf)
    for part in ("timestamp < TIMESTAMP '2024-01-15'", "timestamp >= TIMESTAMP '2024-01-15'"):
        bars.filter(part).write.mode("append").parquet(source)
        jobs.run_available(jobs.stream_source(spark, source, "bar"), out, checkpoint)
    jobs.run_available(jobs.stream_source(spark, source, "bar"), out, checkpoint)
    return spark.read.schema(schemas.BARS).parquet(out).select("symbol", "timestamp", "close")


@query("stream_dedup", S.with_(S.TICKS, S.bars(), select="SELECT symbol, timestamp FROM bars"))
def stream_dedup(spark, sf):
    path = scratch_path(spark, "redelivered")
    t.redelivered(spark, sf).write.parquet(path)
    stream = spark.readStream.schema(t.redelivered(spark, sf).schema).parquet(path)
    return _collected(spark, jobs.stream_dedup(stream, "40 days", "symbol", "timestamp")).select(
        "symbol", "timestamp")
