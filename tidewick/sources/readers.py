"""Readers: vendor candle arrays, candle CSV, sample JSON, chunk folders, event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewick import schemas
from tidewick.functions.numeric import finite
from tidewick.operators.indicators import clean_prices
from tidewick.operators.resample import resample, width_of

# Order of a vendor candle array.
ARRAY_FIELDS = ("time", "low", "high", "open", "close", "volume")
PRICES = ("open", "high", "low", "close", "volume")


def candle_arrays(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CANDLE_ARRAYS).json(path)


def from_candle_arrays(arrays: DataFrame) -> DataFrame:
    """Array rows (unix seconds first) to typed candles; values that are no finite numbers are NULL."""
    at = {name: F.col("c")[i] for i, name in enumerate(ARRAY_FIELDS)}
    return arrays.select(
        F.timestamp_seconds(finite(at["time"]).cast("bigint")).alias("timestamp"),
        *[finite(at[x]).alias(x) for x in PRICES], "product_id")


def product_from_file(name: Column) -> Column:
    """``BTC_USD_1m_last_5y.csv`` to ``BTC-USD``."""
    return F.replace(F.regexp_extract(name, r"^(.+?)_1m_", 1), F.lit("_"), F.lit("-"))


def ohlcv_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return clean_prices(spark.read.schema(schemas.CANDLES).option("header", True).csv(path), PRICES)


def multi_symbol_csv(spark: SparkSession, folder: str, symbols: Sequence[str] | None = None
                     ) -> DataFrame:
    """All ``*_1m_*.csv`` of a folder (files, or folders of part files), symbol from that name.

    Absent symbols are skipped.
    """
    name = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*_1m_[^/]*\.csv)", 1)
    df = (spark.read.schema(schemas.CANDLES).option("header", True).csv(f"{folder}/*_1m_*.csv")
          .withColumn("symbol", product_from_file(name)))
    df = clean_prices(df, PRICES)
    return df.filter(F.col("symbol").isin(*symbols)) if symbols else df


def array_separator(indent: int | None = 2, gap: str = " ") -> str:
    """What lies between two objects of a top-level array: indented by so many blanks, or on one line with ``gap``."""
    return "}," + gap + "{" if indent is None else f"\n{' ' * indent}}},\n{' ' * indent}{{"


def array_objects(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(value, file): the objects of top-level JSON arrays, one file's array read by as many tasks as it has splits.

    The file is cut at ``separator`` by the text source, which seeks to the next one in each split. The braces
    that this takes away are put back; what follows a whole object (the array's end) is not read by ``from_json``.
    No layout has a line break inside a string, so an indented array is cut exactly; on one line, a string
    that holds the separator makes two malformed objects.
    """
    pieces = spark.read.option("lineSep", separator).text(path).select("value", F.col("_metadata.file_name").alias("file"))
    head = r"^[\s\x{FEFF}]*\[\s*"
    pieces = pieces.filter(~F.col("value").rlike(rf"{head}(\]\s*)?$") & (F.trim("value") != ""))
    opened = F.when(F.col("value").rlike(head), F.regexp_replace("value", head, "")).otherwise(F.concat(F.lit("{"), "value"))
    return pieces.select(F.concat(opened, F.lit("}")).alias("value"), "file")


_BAD = "_malformed"
_MARKED_SAMPLE = StructType([*schemas.SAMPLE.fields, StructField(_BAD, StringType())])


def _parsed(values: DataFrame) -> DataFrame:
    return values.withColumn("_parsed", F.from_json("value", _MARKED_SAMPLE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}))


def json_samples(spark: SparkSession, path: str, *, array: bool = False, separator: str | None = None,
                 skip_malformed: bool = False) -> DataFrame:
    """Nested samples, one object per line, or top-level arrays (``array=True``).

    A malformed object is an error unless skipping is asked for; ``malformed_objects`` counts them. Give the
    ``array_separator`` of an array's layout to have it split over tasks; without it each file is one task.
    """
    if array and separator is not None:
        objects = array_objects(spark, path, separator)
        if not skip_malformed:
            return objects.select(F.from_json("value", schemas.SAMPLE, {"mode": "FAILFAST"}).alias("_parsed")).select("_parsed.*")
        return _parsed(objects).filter(F.col("_parsed")[_BAD].isNull()).select(
            *[F.col("_parsed")[f.name].alias(f.name) for f in schemas.SAMPLE.fields])
    return (spark.read.schema(schemas.SAMPLE).option("mode", "DROPMALFORMED" if skip_malformed else "FAILFAST")
            .option("multiLine", array).json(path))


def malformed_objects(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """Per file: objects that ``json_samples`` cannot read, and all objects. Give the separator of arrays."""
    if separator is None:
        values = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file")).filter(F.trim("value") != "")
    else:
        values = array_objects(spark, path, separator)
    bad = _parsed(values).select("file", F.col("_parsed")[_BAD].isNotNull().alias("malformed"))
    return bad.groupBy("file").agg(F.count_if("malformed").alias("malformed"), F.count(F.lit(1)).alias("objects"))


def chunks(spark: SparkSession, path: str, max_chunks: int | None = None, *,
           skip_unreadable: bool = False) -> DataFrame:
    """Chunk files, optionally the first few by name.

    An unreadable file is an error unless skipping is asked for; ``unreadable_chunks`` names them.
    """
    df = spark.read.option("ignoreCorruptFiles", skip_unreadable).parquet(path)
    df = df.withColumn("chunk", F.col("_metadata.file_name"))
    if max_chunks is None:
        return df
    # A list of names as long as the folder: it is kept on the executors and cut to the first few there.
    first = _chunk_files(spark, path).orderBy("chunk").limit(max_chunks)
    return df.join(first, "chunk", "left_semi")


def _chunk_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("chunk"))


def unreadable_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Names of the chunk files from which no row can be read."""
    read = chunks(spark, path, skip_unreadable=True).select("chunk").distinct()
    return _chunk_files(spark, path).join(read, "chunk", "left_anti")


def event_log(spark: SparkSession, path: str, *, skip_malformed: bool = False) -> DataFrame:
    """JSONL envelope rows. A line that is no JSON object is an error unless skipping is asked for.

    Lines without a type are no events; ``malformed_lines`` counts both.
    """
    mode = "PERMISSIVE" if skip_malformed else "FAILFAST"
    df = spark.read.schema(schemas.EVENT_LOG).option("mode", mode).json(path)
    return df.filter(F.col("type").isNotNull())


def malformed_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: lines of a log that give no event, and all lines."""
    df = spark.read.schema(schemas.EVENT_LOG).option("mode", "PERMISSIVE").json(path)
    return df.select("type").agg(F.count_if(F.col("type").isNull()).alias("malformed"),
                                 F.count(F.lit(1)).alias("lines"))


def recent_of_type(log: DataFrame, kind: str, last: int = 5) -> DataFrame:
    return (log.filter(F.col("type") == kind)
            .orderBy(F.col("timestamp").desc(), F.col("data").desc()).limit(last))


def dataset_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def historical_bars(ticks: DataFrame, symbol: str, timeframe: str, end: Column, *,
                    limit: int = 100, hours: int = 24) -> DataFrame:
    """First ``limit`` bars that start within the last ``hours`` before ``end``, for one symbol.

    Bars are whole: the range of ticks runs from the first bar's start to the last one's end, and it is
    applied to the ticks, where it reaches the scan.
    """
    width = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {width_of(timeframe)}"))

    def next_start(time: Column) -> Column:
        return F.timestamp_micros(F.ceil(F.unix_micros(time) / width) * width)

    start = next_start(end - F.expr(f"INTERVAL {int(hours)} HOURS"))
    part = ticks.filter((F.col("symbol") == symbol) & (F.col("timestamp") >= start)
                        & (F.col("timestamp") < next_start(end)))
    return resample(part, timeframe).orderBy("timestamp").limit(limit)


def positions_scan(raw: DataFrame, *keys: str) -> DataFrame:
    return raw.select(*keys, *[F.col(f.name).cast(f.dataType).alias(f.name)
                        for f in schemas.POSITIONS.fields])


def account_scan(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                        for f in schemas.ACCOUNT.fields])
