"""Writers: resumable candle loads, chunk folders with metadata, JSON, CSV and event logs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewick.operators.series import global_positions

# Event types of the log.
EVENT_TYPES = ("trade_execution", "signal_generation", "performance_update", "error", "risk_event")


def new_rows(stored: DataFrame, incoming: DataFrame, key: str = "product_id",
             time: str = "timestamp") -> DataFrame:
    """Incoming rows later than the last stored one of their key (all rows of a new key)."""
    last = stored.groupBy(key).agg(F.max(time).alias("_last"))
    return (incoming.join(last, key, "left")
            .filter(F.col("_last").isNull() | (F.col(time) > F.col("_last"))).drop("_last"))


def incremental_append(spark: SparkSession, incoming: DataFrame, path: str) -> None:
    stored = spark.read.schema(incoming.schema).parquet(path)
    new_rows(stored, incoming).write.mode("append").parquet(path)


def write_chunks(df: DataFrame, path: str, rows_per_file: int = 10_000) -> None:
    (df.write.mode("overwrite").option("compression", "snappy")
     .option("maxRecordsPerFile", rows_per_file).parquet(path))


def write_ordered_chunks(df: DataFrame, path: str, order: Sequence[str], *, rows_per_file: int = 10_000) -> None:
    """Chunks of exactly ``rows_per_file`` rows in the given order, only the last one shorter.

    One file a chunk, in the folder ``chunk=<number>``.
    """
    placed = global_positions(df, order, name="_pos").drop("_total")
    placed = placed.withColumn("chunk", F.expr(f"_pos div {rows_per_file}"))
    (placed.repartition("chunk").sortWithinPartitions("chunk", "_pos").drop("_pos")
     .write.mode("overwrite").option("compression", "snappy").partitionBy("chunk").parquet(path))


def chunk_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row per chunk file: rows and bytes. Rows come from the Parquet footers' counts."""
    df = spark.read.parquet(path)
    return (df.groupBy(F.col("_metadata.file_name").alias("filename"),
                       F.col("_metadata.file_size").alias("size_bytes"))
            .agg(F.count(F.lit(1)).alias("rows")))


def dataset_metadata(spark: SparkSession, path: str, rows_per_file: int = 10_000) -> DataFrame:
    """Totals over the chunk files; ``chunk_list`` has the files."""
    return chunk_metadata(spark, path).agg(
        F.count(F.lit(1)).alias("total_chunks"), F.sum("rows").alias("total_samples"),
        F.lit(rows_per_file).alias("chunk_size"), F.sum("size_bytes").alias("size_bytes"),
        F.lit("parquet").alias("format"), F.lit("snappy").alias("compression"))


def chunk_list(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_id, filename, rows, size_bytes, size_mb) of chunks that ``write_ordered_chunks`` has numbered."""
    df = spark.read.parquet(path)
    files = df.groupBy(F.col("chunk").cast("long").alias("chunk_id"), F.col("_metadata.file_name").alias("filename"),
                       F.col("_metadata.file_size").alias("size_bytes")).agg(F.count(F.lit(1)).alias("rows"))
    return files.withColumn("size_mb", F.col("size_bytes") / (1 << 20))


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
             .select("length"))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def conversion_report(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Input and output bytes and the reduction in percent."""
    a, b = folder_bytes(spark, source), folder_bytes(spark, target)
    out = a.select(F.col("bytes").alias("input_bytes"), b.scalar().alias("output_bytes"))
    ratio = F.try_divide(F.col("output_bytes"), F.col("input_bytes"))
    return out.withColumn("reduction_pct", (1 - ratio) * 100)


def write_samples_json(samples: DataFrame, path: str) -> None:
    """One folder per symbol; the whole folder is the combined set."""
    samples.write.mode("overwrite").partitionBy("symbol").json(path)


def write_json_arrays(df: DataFrame, path: str, indent: int = 2, *, text: Column | None = None) -> None:
    """Files that each hold one top-level JSON array, laid out for ``readers.array_separator(indent)``.

    ``text`` gives an object's JSON, all columns by default. Objects are written as they come, so a file may be
    larger than a task's memory.
    """
    pad = " " * indent
    inner = F.regexp_replace(F.to_json(F.struct("*")) if text is None else text, r"^\{(.*)\}$", "$1")

    def laid_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            lines = []
            for fields in batch.column(0).to_pylist():
                if last is None:
                    lines.append("[")
                else:
                    lines.append(f"{pad}{{\n{pad * 2}{last}\n{pad}}},")
                last = fields
            yield pa.record_batch([pa.array(lines, pa.string())], ["value"])
        end = ["[]"] if last is None else [f"{pad}{{\n{pad * 2}{last}\n{pad}}}", "]"]
        yield pa.record_batch([pa.array(end, pa.string())], ["value"])

    df.select(inner.alias("value")).mapInArrow(laid_out, "value string").write.mode("overwrite").text(path)


def combine_csv(df: DataFrame, path: str, *order: str) -> None:
    """Globally ordered CSV part files (range partitioned, so no single writer)."""
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def log_event(kind: str, data: Column, at: Column) -> list[Column]:
    """Envelope columns for one event."""
    if kind not in EVENT_TYPES:
        raise ValueError(f"unknown event type: {kind}")
    return [F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.lit(kind).alias("type"), F.to_json(data).alias("data")]


def append_event_log(events: DataFrame, path: str) -> None:
    events.select("timestamp", "type", "data").write.mode("append").partitionBy("type").json(path)
