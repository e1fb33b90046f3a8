"""Readers and writers on real files."""

import json

import pytest
from pyspark.sql import functions as F

from tidewick import schemas
from tidewick.operators import quality
from tidewick.operators.samples import flatten_nested
from tidewick.sources import readers, writers

HEAD = "timestamp,open,high,low,close,volume,product_id\n"


def test_multi_symbol_names_and_missing_files(spark, tmp_path):
    for name, pid in (("BTC_USD", "BTC-USD"), ("ETH_USD", "ETH-USD")):
        (tmp_path / f"{name}_1m_last_5y.csv").write_text(
            HEAD + f"2024-01-01T00:00:00Z,1,2,0.5,1.5,10,{pid}\n")
    (tmp_path / "notes.csv").write_text("x\n1\n")
    df = readers.multi_symbol_csv(spark, str(tmp_path), ["BTC-USD", "SOL-USD"])
    row = df.first()
    assert df.count() == 1 and (row.symbol, row.close) == ("BTC-USD", 1.5)
    assert readers.multi_symbol_csv(spark, str(tmp_path)).count() == 2


def test_candle_arrays(spark):
    df = spark.createDataFrame([("BTC-USD", [1704067200.0, 1.0, 4.0, 2.0, 3.0, 9.0])],
                               "product_id string, c array<double>")
    r = readers.from_candle_arrays(df).first()
    assert (r.open, r.high, r.low, r.close, r.volume) == (2.0, 4.0, 1.0, 3.0, 9.0)
    assert str(r.timestamp) == "2024-01-01 00:00:00"


def test_malformed_samples(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text('{"symbol":"A","price_data":{"close":1.5},"signal":"BUY"}\n{"symbol": "B", \n'
                    '{"symbol":"C","signal":"HOLD"}\n')
    with pytest.raises(Exception):
        readers.json_samples(spark, str(path)).collect()
    assert {r.symbol for r in readers.json_samples(spark, str(path), skip_malformed=True).collect()} == {"A", "C"}
    assert [tuple(r)[1:] for r in readers.malformed_objects(spark, str(path)).collect()] == [(1, 3)]


def test_sample_array_file(spark, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('[{"symbol":"A","signal":"BUY"},\n {"symbol":"B","signal":"SELL"}]')
    assert readers.json_samples(spark, str(path), array=True).count() == 2


def _sample(i):
    return {"symbol": f"S{i}", "timestamp": "2024", "price_data": {"close": i / 4}, "signal": "BUY",
            "reasoning": f'x }}, {{ \n  }},\n  {{ "{i}" é' if i % 3 == 0 else "[]"}


@pytest.mark.parametrize("indent", [1, 2, 4])
def test_split_array(spark, tmp_path, indent):
    """One array in one file is read by several tasks, whatever bytes the splits fall on."""
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "a.json").write_text(json.dumps([_sample(i) for i in range(400)], indent=indent))
    for name, text in (("empty", "[]"), ("blank", " [\n ]\n"), ("nothing", ""), ("one", json.dumps([_sample(400)], indent=indent))):
        (tmp_path / "a" / f"{name}.json").write_text(text)
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(_sample(i)) for i in range(401)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1009b", "7919b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            df = readers.json_samples(spark, str(tmp_path / "a"), array=True, separator=readers.array_separator(indent))
            assert df.rdd.getNumPartitions() > 5 and df.schema == schemas.SAMPLE
            rows = sorted(df.collect(), key=lambda r: r.symbol)
            assert rows == sorted(readers.json_samples(spark, str(tmp_path / "lines.json")).collect(), key=lambda r: r.symbol)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_malformed_objects_of_an_array(spark, tmp_path):
    path, sep = str(tmp_path / "a.json"), readers.array_separator(None)
    (tmp_path / "a.json").write_text('[{"symbol": "A", "signal": "x"}, {"symbol": ], "signal": 1}, {"symbol": "C", "confidence": 0.5}]')
    with pytest.raises(Exception):
        readers.json_samples(spark, path, array=True, separator=sep).collect()
    assert {r.symbol for r in readers.json_samples(spark, path, array=True, separator=sep, skip_malformed=True).collect()} == {"A", "C"}
    assert [tuple(r)[1:] for r in readers.malformed_objects(spark, path, sep).collect()] == [(1, 3)]


def test_array_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(f"S{i}", f"a}},\n  {{{i}") for i in range(50)], "symbol string, reasoning string").repartition(3)
    path = str(tmp_path / "out")
    writers.write_json_arrays(df, path)
    assert sorted(x["symbol"] for f in (tmp_path / "out").glob("*.txt") for x in json.loads(f.read_text())) == sorted(f"S{i}" for i in range(50))
    back = readers.json_samples(spark, path, array=True, separator=readers.array_separator())
    assert sorted(back.select("symbol", "reasoning").collect()) == sorted(df.collect())
    writers.write_json_arrays(df.limit(0), path)
    assert readers.json_samples(spark, path, array=True, separator=readers.array_separator()).count() == 0


def test_event_log_bad_lines(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text(
        '{"timestamp":"2024-01-01T00:00:00","type":"error","data":"{}"}\nnot json\n\n'
        '{"timestamp":"2024-01-02T00:00:00","type":"trade_execution","data":"{}"}\n')
    with pytest.raises(Exception):
        readers.event_log(spark, str(tmp_path)).collect()
    log = readers.event_log(spark, str(tmp_path), skip_malformed=True)
    assert log.count() == 2
    assert tuple(readers.malformed_lines(spark, str(tmp_path)).first()) == (1, 3)
    assert readers.recent_of_type(log, "trade_execution").count() == 1


def test_chunks_limit_and_corrupt_file(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(95).withColumn("symbol", F.lit("A")).coalesce(1)
    writers.write_chunks(df, path, 10)
    assert writers.dataset_metadata(spark, path, 10).first().total_chunks == 10
    first = readers.chunks(spark, path, max_chunks=3)
    assert first.count() == 30 and first.select("chunk").distinct().count() == 3
    (tmp_path / "c" / "part-99999-bad.snappy.parquet").write_bytes(b"PAR1 nothing useful PAR1")
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "false")
    with pytest.raises(Exception):
        readers.chunks(spark, path).collect()
    assert readers.chunks(spark, path, skip_unreadable=True).count() == 95
    assert [r.chunk for r in readers.unreadable_chunks(spark, path).collect()] == ["part-99999-bad.snappy.parquet"]


def test_missing_metadata_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        readers.dataset_metadata(spark, str(tmp_path / "none")).count()


def test_require_columns(spark):
    with pytest.raises(ValueError, match="volume"):
        quality.require_columns(spark.range(1).selectExpr(
            "id AS timestamp", "1 AS open", "1 AS high", "1 AS low", "1 AS close"))


def test_flatten_keeps_arrays(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.struct(
        F.array(F.lit(2)).alias("c")).alias("b")).alias("p"), F.lit("x").alias("q"))
    assert flatten_nested(df).columns == ["p_a", "p_b_c", "q"]


def test_coerce_is_all_or_nothing(spark):
    df = spark.createDataFrame([("1", "1", None), ("2.5", "x", None)], "a string, b string, c string")
    out = quality.coerce_numeric_strings(df)
    assert [t for _, t in out.dtypes] == ["double", "string", "string"]


def test_narrowing_uses_signed_limits(spark):
    df = spark.createDataFrame([(127, 128, 2**31, 1.5), (-128, 0, 0, 2.0)],
                               "a bigint, b bigint, c bigint, d double")
    got = {r["column"]: r.narrow_type for r in quality.infer_narrow_schema(df).collect()}
    assert got == {"a": "tinyint", "b": "smallint", "c": "bigint", "d": "float"}


def test_conversion_report(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    (tmp_path / "in" / "x").write_bytes(b"a" * 1000)
    (tmp_path / "out" / "y").write_bytes(b"a" * 250)
    r = writers.conversion_report(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()
    assert (r.input_bytes, r.output_bytes, r.reduction_pct) == (1000, 250, 75.0)


def test_incremental_append_per_product(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "product_id string, s int").select(
        "product_id", F.timestamp_seconds("s").alias("timestamp"))
    make([("a", 1), ("a", 5)]).write.parquet(path)
    writers.incremental_append(spark, make([("a", 5), ("a", 6), ("b", 2)]), path)
    assert spark.read.parquet(path).count() == 4


def test_ordered_chunks_are_full(spark, tmp_path):
    path = str(tmp_path / "o")
    df = spark.range(95).select(F.lit("A").alias("symbol"), F.timestamp_seconds("id").alias("timestamp"), "id").repartition(7)
    writers.write_ordered_chunks(df, path, ["symbol", "timestamp"], rows_per_file=10)
    got = spark.read.parquet(path).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo")).collect()
    assert sorted((r.chunk, r.n, r.lo) for r in got) == [(i, 10 if i < 9 else 5, 10 * i) for i in range(10)]


def test_values_that_are_no_numbers(spark, tmp_path):
    (tmp_path / "A_USD_1m_x.csv").write_text(HEAD + "2024-01-01T00:00:00Z,NaN,Infinity,0.5,1.5,10,A\n")
    row = readers.multi_symbol_csv(spark, str(tmp_path)).first()
    assert (row.open, row.high, row.low) == (None, None, 0.5)
    arrays = spark.createDataFrame([("A", [1704067200.0, float("nan"), 4.0, 2.0, float("inf"), 9.0])], "product_id string, c array<double>")
    row = readers.from_candle_arrays(arrays).first()
    assert (row.low, row.close, row.high) == (None, None, 4.0)


def test_historical_bars_are_whole(spark):
    ticks = spark.range(0, 96).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 1800).alias("timestamp"), F.lit("A").alias("symbol"),
        F.col("id").cast("double").alias("price"), F.lit(1.0).alias("size"), F.col("id").alias("trade_id"))
    end = F.lit("2024-01-02 12:30:00").cast("timestamp")
    bars = readers.historical_bars(ticks, "A", "1Day", end, hours=24).collect()
    assert [(str(b.timestamp), b.trade_count) for b in bars] == [("2024-01-02 00:00:00", 48)]
    hours = readers.historical_bars(ticks, "A", "1Hour", end, hours=2).collect()
    assert [(str(b.timestamp)[11:], b.trade_count) for b in hours] == [("11:00:00", 2), ("12:00:00", 2)]
