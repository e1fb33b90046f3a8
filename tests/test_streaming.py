"""Streams against their batch counterparts, over several micro-batches."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewick.operators import live
from tidewick.operators.resample import resample
from tidewick.plans import tables as t
from tidewick.streaming import jobs, keyed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bar_files(spark, tmp_path_factory):
    """Hourly bars as four files that each mix all times."""
    path = str(tmp_path_factory.mktemp("bars") / "files")
    bars = t.bars(spark, SF)
    bars.repartition(4, F.xxhash64("symbol", "timestamp")).write.parquet(path)
    return path


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _run(spark, path, step, tmp_path, **limits):
    stream = jobs.stream_source(spark, path, "bar", **limits)
    return jobs.run_ranges(stream, step(str(tmp_path / "out"), "40 days"), str(tmp_path / "cp"))


def _rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


@pytest.mark.parametrize("step,batch", [(jobs.stream_momentum, jobs.momentum_of), (jobs.stream_last_n, jobs.last_n_of)])
def test_any_split_gives_the_batch_answer(spark, bar_files, tmp_path, step, batch):
    want = _rows(_rounded(batch(spark.read.parquet(bar_files))))
    for limits in ({"files_per_trigger": 1}, {"files_per_trigger": 3}):
        got = _run(spark, bar_files, step, tmp_path / str(limits["files_per_trigger"]), **limits)
        assert _rows(_rounded(got)) == want


def test_ranges_in_time_order_close_early(spark, tmp_path):
    """Files in time order and a short delay: ranges close on the way, late bars are put aside."""
    path, bars = str(tmp_path / "bars"), t.bars(spark, SF).cache()
    cuts = ["2024-01-01", "2024-01-10", "2024-01-20", "2024-02-10"]
    for lo, hi in zip(cuts, cuts[1:]):
        bars.filter(f"timestamp >= '{lo}' AND timestamp < '{hi}'").coalesce(1).write.mode("append").parquet(path)
    bars.filter("timestamp < '2024-01-02'").coalesce(1).write.mode("append").parquet(path)  # once more, too late
    stream = jobs.stream_source(spark, path, "bar", files_per_trigger=1)
    step = jobs.stream_momentum(str(tmp_path / "out"), "1 day", keep=20)
    jobs.run_batches(stream, step, str(tmp_path / "cp"))
    assert 0 < step.results(spark).count() < bars.count()
    step.finish(spark, stream.schema)
    assert _rows(_rounded(step.results(spark))) == _rows(_rounded(jobs.momentum_of(bars, 20)))
    late = spark.read.parquet(str(tmp_path / "out/late"))
    assert late.count() == bars.filter("timestamp < '2024-01-02'").count()


def test_verdicts_equal_the_whole_series(spark, bar_files, tmp_path):
    limits = jobs.RiskLimits(symbols=("click",))
    step = lambda root, delay: jobs.decide_step(root, limits, delay)
    got = _run(spark, bar_files, step, tmp_path, files_per_trigger=1)
    want = jobs.decide(spark.read.parquet(bar_files), limits)
    assert _rows(_rounded(got)) == _rows(_rounded(want))
    assert got.filter("is_valid AND symbol <> 'click'").count() == 0


def test_closed_windows_equal_batch(spark, tmp_path):
    ticks = t.ticks(spark, SF).select("timestamp", "symbol", "price", "size", "trade_id").cache()
    path = str(tmp_path / "ticks")
    ticks.repartition(4).write.parquet(path)
    stream = jobs.stream_bars(jobs.stream_source(spark, path, "trade"), "1Hour", "5 minutes")
    out = str(tmp_path / "out")
    jobs.run_available(stream, out, str(tmp_path / "cp"))
    got = {(r.symbol, r.timestamp): r for r in spark.read.parquet(out).collect()}
    want = {(r.symbol, r.timestamp): r for r in resample(ticks, "1Hour").collect()}
    assert got and set(got) <= set(want) and len(got) >= len(want) - 10
    assert all((g.open, g.close, g.volume) == (want[k].open, want[k].close, want[k].volume)
               for k, g in got.items())


def _files(path, bars, cuts):
    for lo, hi in zip(cuts, cuts[1:]):
        bars.filter(f"timestamp >= '{lo}' AND timestamp < '{hi}'").coalesce(1).write.mode("append").parquet(path)


CUTS = ["2024-01-01", "2024-01-06", "2024-01-12", "2024-01-18", "2024-01-24", "2024-03-01"]


def test_keyed_state_emits_on_the_way_and_stays_small(spark, tmp_path):
    """Same rows as the batch answer; at least three batches of rows before the feed's end; late rows are left out."""
    keyed.with_state_store(spark)
    bars = t.bars(spark, SF).cache()
    _files(str(tmp_path / "bars"), bars, CUTS)
    bars.filter("timestamp < '2024-01-02'").withColumn("close", F.lit(1e9)).coalesce(1).write.mode("append").parquet(str(tmp_path / "bars"))

    def build(beats):
        return jobs.keyed_momentum(jobs.stream_source(spark, str(tmp_path / "bars"), "bar", files_per_trigger=1), "1 day", 20, heartbeats=beats)

    out, cp, beats = (str(tmp_path / x) for x in ("out", "cp", "beats"))
    bars.limit(0).select("symbol", "timestamp").write.parquet(beats)
    first = build(spark.readStream.schema("symbol string, timestamp timestamp").parquet(beats))
    jobs.run_available(first, out, cp)
    early = spark.read.parquet(out)
    assert 0 < early.count() < bars.count()
    # Files of one batch are written together; the batches are told apart by the ranges of times they hold.
    newest = [r[1] for r in early.groupBy("_metadata.file_path").agg(F.max("timestamp")).collect()]
    assert len({x.date() for x in newest}) >= 3
    jobs.run_to_end(spark, build, out, cp, beats, bars.select("symbol").distinct(), F.lit("2024-03-01").cast("timestamp"))
    got = spark.read.schema(first.schema).parquet(out)
    assert _rows(_rounded(got)) == _rows(_rounded(jobs.momentum_of(bars, 20)))


class _Lists:
    """A list state in memory."""

    def __init__(self):
        self.rows = []

    def exists(self):
        return bool(self.rows)

    def get(self):
        return iter(self.rows)

    def put(self, rows):
        self.rows = list(rows)

    def appendList(self, rows):
        self.rows += rows

    def clear(self):
        self.rows = []


class _Handle:
    def __init__(self):
        self.states, self.timers = {}, []

    def getListState(self, name, schema):
        return self.states.setdefault(name, _Lists())

    def registerTimer(self, ms):
        self.timers.append(ms)


class _Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_keyed_state_is_bounded():
    """After any number of rows a symbol holds its last few and what waits."""
    rng, handle = random.Random(6), _Handle()
    work = keyed.LastRows([2, 3])
    work.init(handle)
    rows = [(rng.randint(0, 400) * 1000, rng.randint(0, 1), f"{i:03d}", f"r{i}") for i in range(300)]
    rows.sort(key=lambda x: x[0] + rng.randint(0, 20000))  # up to 20 ms late
    out = []
    for lo in range(0, 300, 30):
        part = rows[lo:lo + 30]
        assert list(work.handleInputRows(("a",), iter([pd.DataFrame(part, columns=["time", "kind", "tie", "body"])]), None)) == []
        mark = max(x[0] for x in rows[:lo + 30]) // 1000 - 21
        for frame in work.handleExpiredTimer(("a",), _Mark(mark), None):
            out += frame.itertuples(index=False, name=None)
        assert len(handle.states["feed0"].rows) <= 2 and len(handle.states["feed1"].rows) <= 3
        assert all(x[0] > mark * 1000 for x in handle.states["waiting"].rows)
        assert not handle.states["waiting"].rows or handle.timers[-1] <= min(x[0] for x in handle.states["waiting"].rows) // 1000 + 1
    for frame in work.handleExpiredTimer(("a",), _Mark(10**6), None):
        out += frame.itertuples(index=False, name=None)
    lists, want = [[], []], []
    for time, kind, _, body in sorted(rows):
        lists[kind].append(body)
        if kind == 1:
            want.append(("a", time, [lists[0][-2:], lists[1][-3:]]))
    assert out == want and not handle.states["waiting"].rows


class _Map(dict):
    """A map state in memory, which counts the rows it gives out."""

    given = 0

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        self.given += len(self[key][0]) if len(self[key]) > 1 else 0
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        del self[key]


class _SlotHandle(_Handle):
    def getMapState(self, name, key, value):
        return self.states.setdefault(name, _Map())


class _Expired:
    def __init__(self, ms):
        self.ms = ms

    def getExpiryTimeInMs(self):
        return self.ms


def test_a_task_holds_one_slot_of_what_waits():
    """However much a trigger brings, a timer reads its own slot; rows on the edge of a slot keep their order."""
    rng, handle, hour = random.Random(9), _SlotHandle(), 3_600_000_000
    work = keyed.SlottedRows([2, 3])
    work.init(handle)
    times = [rng.randint(0, 50 * hour) for _ in range(1900)] + [n * hour + d for n in range(1, 21) for d in (-1000, -1, 0, 1, 1000)]
    rows = [(x, rng.randint(0, 1), f"{i:04d}", f"r{i}") for i, x in enumerate(times)]
    rng.shuffle(rows)
    rows.sort(key=lambda x: x[0] >= 30 * hour)  # two triggers, each in any order
    cut = sum(x[0] < 30 * hour for x in rows)
    out, most = [], 0
    for part, mark in ((rows[:cut], 29 * hour // 1000 + 1234), (rows[cut:], 10**9)):
        frames = [pd.DataFrame(part[i:i + 100], columns=["time", "kind", "tie", "body"]) for i in range(0, len(part), 100)]
        assert list(work.handleInputRows(("a",), iter(frames), None)) == []
        for ms in sorted({x for x in handle.timers if x <= mark}):
            handle.states["waiting"].given = 0
            for frame in work.handleExpiredTimer(("a",), _Mark(mark), _Expired(ms)):
                out += frame.itertuples(index=False, name=None)
            most = max(most, handle.states["waiting"].given)
        handle.timers = [x for x in handle.timers if x > mark]
        assert all(x > mark * 1000 for part in handle.states["waiting"].values() for x in part[0])
    lists, want = [[], []], []
    for time, kind, _, body in sorted(rows):
        lists[kind].append(body)
        if kind == 1:
            want.append(("a", time, [lists[0][-2:], lists[1][-3:]]))
    assert out == want and not handle.states["waiting"] and not handle.states["parts"]
    assert 0 < most < 80  # 2,000 rows in 50 slots


def test_live_context_of_three_feeds_equals_batch(spark, tmp_path):
    keyed.with_state_store(spark)
    ticks = t.ticks(spark, SF).cache()
    bars = t.bars(spark, SF).cache()
    quotes = ticks.filter("trade_id % 3 = 0").select("timestamp", "symbol", F.col("price").alias("bid_price"), F.col("price").alias("ask_price"),
                                                     F.col("size").alias("bid_size"), F.col("trade_id").cast("double").alias("ask_size"))
    trades = ticks.filter("trade_id % 3 = 1").select("timestamp", "symbol", "price", "size", "trade_id")
    for name, rows in (("bar", bars), ("quote", quotes), ("trade", trades)):
        _files(str(tmp_path / name), rows, CUTS)

    def build(beats):
        streams = [jobs.stream_source(spark, str(tmp_path / x), x, files_per_trigger=1) for x in ("bar", "quote", "trade")]
        return jobs.keyed_context(*streams, "1 HOUR", "3 hours", heartbeats=beats)

    out = str(tmp_path / "out")
    jobs.run_to_end(spark, build, out, str(tmp_path / "cp"), str(tmp_path / "beats"), bars.select("symbol").distinct(),
                    F.lit("2024-03-01").cast("timestamp"))
    show = lambda df: _rows(_rounded(df.withColumns({
        "quotes": F.transform("quotes", lambda x: x["ask_size"]), "trades": F.transform("trades", lambda x: x["trade_id"])})))
    want = show(live.live_context(bars, quotes, trades, "1 HOUR", digits=None))
    assert show(spark.read.parquet(out)) == want and len(want) > 500


def test_ranges_close_between_triggers(spark, tmp_path):
    bars = t.bars(spark, SF).cache()
    _files(str(tmp_path / "bars"), bars, CUTS)
    stream = jobs.stream_source(spark, str(tmp_path / "bars"), "bar", files_per_trigger=1)
    step = jobs.stream_last_n(str(tmp_path / "out"), "6 hours")
    jobs.run_batches(stream, step, str(tmp_path / "cp"))
    ranges = spark.read.option("basePath", str(tmp_path / "out/out")).parquet(str(tmp_path / "out/out"))
    assert ranges.select("trigger").distinct().count() >= 3
    waits = spark.read.parquet(str(tmp_path / "out/held/trigger=4")).filter("timestamp > '2024-01-29'").count()
    assert waits < bars.count() / 5
    step.finish(spark, stream.schema)
    assert _rows(_rounded(step.results(spark))) == _rows(_rounded(jobs.last_n_of(bars)))
