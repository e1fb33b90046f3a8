"""Timed headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tests.sparksession import local_spark  # noqa: E402
from tidewick.operators.indicators import full_panel  # noqa: E402
from tidewick.operators.samples import (build_sample, flatten_nested,  # noqa: E402
                                        label_samples, sample_every_n)
from tidewick.plans import tables as t  # noqa: E402
from tidewick.plans.catalog import QUERIES  # noqa: E402
from tidewick.session import prepare_session, scratch_path  # noqa: E402
from tidewick.sources import readers, writers  # noqa: E402

HEADLINE = (
    "flagship resample_bars resample_bars_1hour sma ema rsi macd bollinger indicator_panel "
    "volume_price_trend chunk_local_indicators sample_every_n build_sample signal_advanced "
    "cap_per_symbol positional_split signal_distribution recent_context_indicators momentum_5v5 "
    "tidy_series continuity_check performance_metrics backtest_performance daily_risk_counters "
    "validate_signals rebalance trade_summary evaluate_steps render_sft_text parse_signal "
    "token_count top_important semantic_topk token_budget_context upsert_latest write_chunks "
    "scan_json_samples incremental_append stream_bars stream_momentum").split()


# The published rates are for ten million rows; the table's minute bars are repeated under new symbols
# so that fixed costs do not decide the figure.
COPIES = 12


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def rates(spark, sf: str) -> dict[str, float]:
    """The two figures with a published counterpart: data preparation and JSON to Parquet.

    Preparation is the panel, then labels and nested JSON: once for the sampling positions (as the
    published figure), once for every row.
    """
    path = scratch_path(spark, "minute-bars")
    copies = F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("copy")
    minute = t.candles(spark, sf, "1Min").select("*", copies)
    minute.withColumn("symbol", F.concat_ws("-", "symbol", "copy")).drop("copy").write.parquet(path)
    bars = spark.read.parquet(path)
    rows = bars.count()
    t0 = time.time()
    build_sample(label_samples(sample_every_n(full_panel(bars)))).write.json(
        scratch_path(spark, "samples"))
    sampled = time.time() - t0
    t0 = time.time()
    json_path = scratch_path(spark, "samples-json")
    build_sample(label_samples(full_panel(bars))).write.json(json_path)
    prepared = time.time() - t0
    t0 = time.time()
    chunks = scratch_path(spark, "chunks")
    writers.write_chunks(flatten_nested(readers.json_samples(spark, json_path)), chunks)
    converted = time.time() - t0
    report = writers.conversion_report(spark, json_path, chunks).first()
    return {"minute_rows": rows, "prepare_sampled_rows_per_sec": round(rows / sampled),
            "prepare_all_rows_per_sec": round(rows / prepared),
            "convert_rows_per_sec": round(rows / converted),
            "convert_reduction_pct": round(report["reduction_pct"], 1)}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = prepare_session(local_spark())
    run(QUERIES["flagship"](spark, sf))  # JVM warm-up
    seconds = {}
    for name in HEADLINE:
        t0 = time.time()
        run(QUERIES[name](spark, sf))
        seconds[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf.rstrip("/").rsplit("sf", 1)[-1],
                      "rates": rates(spark, sf)}))


if __name__ == "__main__":
    main()
