"""Change-feed source: one JSON change record per line.

Envelope per line::

    {"lsn": "16/B374D848", "seq": 7, "ingest_ts": "2024-06-23T12:00:01+00:00",
     "change": {"action": "U", "table": "orders", "timestamp": "2024-06-23 12:00:00+00",
                "columns":  [{"name": ..., "type": ..., "value": ...}, ...],
                "identity": [{"name": ..., "type": ..., "value": ...}, ...]}}

``value`` is parsed as VARIANT so numerics keep every digit. The same parser serves
batch (``spark.read.text``) and Structured Streaming (``spark.readStream.text``),
and any DataFrame with a string ``value`` column (e.g. a Kafka source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions import lsn_to_int, parse_ts

COLUMN_DDL = "array<struct<name: string, type: string, value: variant>>"
CHANGE_DDL = (f"struct<action: string, `table`: string, timestamp: string, "
              f"columns: {COLUMN_DDL}, identity: {COLUMN_DDL}>")
ENVELOPE_DDL = f"lsn string, seq bigint, ingest_ts string, change {CHANGE_DDL}"

DML_ACTIONS = ("I", "U", "D")


def parse_feed(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Text lines -> typed change rows.

    Rows whose envelope cannot be parsed keep ``_corrupt = true`` so callers can
    route them to rejects instead of losing them silently.
    """
    raw = F.col(value_col).cast("string")
    # One generator row per line: filters on parsed fields cannot be pushed below a
    # Generate, so each line is parsed exactly once however many predicates and
    # lookups follow (a plain projection would be inlined into every one of them).
    p = lines.select(F.inline(F.array(F.struct(
        F.from_json(raw, ENVELOPE_DDL).alias("r"), raw.alias("_raw")))))
    ch = F.col("r.change")
    out = p.select(
        lsn_to_int(F.col("r.lsn")).alias("lsn"),
        F.coalesce(F.col("r.seq"), F.lit(0).cast("bigint")).alias("seq"),
        parse_ts(F.col("r.ingest_ts")).alias("ingest_ts"),
        ch["action"].alias("action"),
        ch["table"].alias("table"),
        parse_ts(ch["timestamp"]).alias("commit_ts"),
        ch["timestamp"].alias("commit_text"),
        F.coalesce(ch["columns"], F.array().cast(COLUMN_DDL)).alias("columns"),
        F.coalesce(ch["identity"], F.array().cast(COLUMN_DDL)).alias("identity"),
        F.col("r.lsn").alias("lsn_text"),
        F.col("_raw"),
    )
    return out.withColumn(
        "_corrupt",
        F.col("lsn").isNull() | F.col("action").isNull()
        | (F.col("commit_text").isNotNull() & F.col("commit_ts").isNull()))


def fence(df: DataFrame) -> DataFrame:
    """Optimizer fence: the same rows and columns, but produced by a generator, so
    later filters are evaluated on the computed columns instead of being pushed
    down (and their expressions re-evaluated) below this point."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def read_feed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    return parse_feed(spark.read.text(paths))


def read_feed_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Streaming change feed from a landing folder of JSON-lines files (T-1, T-2)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return parse_feed(reader.load(path))


def read_feed_kafka(spark: SparkSession, bootstrap_servers: str, topic: str,
                    max_offsets_per_trigger: int | None = None,
                    starting_offsets: str = "earliest") -> DataFrame:
    """Streaming change feed from a Kafka topic (one change record per message).

    Needs the spark-sql-kafka package on the classpath (not bundled here, so this
    path is not exercised by the tests); the parsing is the same as for files.
    ``max_offsets_per_trigger`` is the admission control (T-2).
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return parse_feed(reader.load().select(F.col("value").cast("string").alias("value")))


def table_filter(feed: DataFrame, tables) -> DataFrame:
    """Keep only changes of registered tables."""
    return feed.where(F.col("table").isin(list(tables)))


def dml_filter(feed: DataFrame) -> DataFrame:
    """Keep insert/update/delete; begin, commit and message records are dropped."""
    return feed.where(F.col("action").isin(*DML_ACTIONS))


def entries_map(arr: Column) -> Column:
    """Columns array -> MAP<name, value>; a repeated name keeps its last value."""
    names = F.array_distinct(F.transform(arr, lambda x: x["name"]))
    return F.map_from_arrays(
        names, F.transform(names, lambda n: F.try_element_at(
            F.filter(arr, lambda x: x["name"] == n), F.lit(-1))["value"]))


def types_map(arr: Column) -> Column:
    """Columns array -> MAP<name, type>, missing type = 'text'."""
    names = F.array_distinct(F.transform(arr, lambda x: x["name"]))
    return F.map_from_arrays(
        names, F.transform(names, lambda n: F.coalesce(F.try_element_at(
            F.filter(arr, lambda x: x["name"] == n), F.lit(-1))["type"], F.lit("text"))))


def last_position(arr: Column, name) -> Column:
    """1-based position counted from the end of the last entry named ``name`` (0: absent).

    Codegen-friendly (no lambda): ``array_position`` over the reversed name array.
    """
    n = F.lit(name) if isinstance(name, str) else name
    return F.array_position(F.reverse(arr["name"]), n)


def pick(arr: Column, name) -> Column:
    """Last entry of a columns array with the given name (NULL if absent)."""
    p = last_position(arr, name)
    return F.when(p > 0, F.element_at(arr, -p.cast("int")))
