"""Change-record writer: the inverse of :func:`changeflow.sources.feed.parse_feed`.

Builds envelope JSON lines from DataFrame columns, so feeds can be derived from any
table inside one Spark plan and landed as JSON-lines files.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow.functions import int_to_lsn
from changeflow.sources.feed import COLUMN_DDL


def entry(name: str, type_name: str, value: Column, present: Column | None = None) -> Column:
    """One ``{name, type, value}`` element as a 0/1-element array (absent when
    ``present`` is false); :func:`entries` concatenates them without lambdas."""
    s = F.array(F.struct(F.lit(name).alias("name"), F.lit(type_name).alias("type"),
                         value.cast("variant").alias("value"))).cast(COLUMN_DDL)
    return s if present is None else F.when(present, s).otherwise(F.array().cast(COLUMN_DDL))


def entries(items: list[Column]) -> Column:
    if not items:
        return F.array().cast(COLUMN_DDL)
    return F.concat(*items) if len(items) > 1 else items[0]


def wal_ts_text(ts: Column) -> Column:
    """Commit time as the log-decoder prints it: ``yyyy-MM-dd HH:mm:ss.ffffff+00``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00"))


def record(lsn: Column, seq: Column, action: Column, table: str | Column,
           commit_text: Column | None, columns: list[Column], identity: list[Column],
           ingest_text: Column | None = None) -> Column:
    """Envelope JSON text for one change (explicit JSON nulls are kept)."""
    tbl = F.lit(table) if isinstance(table, str) else table
    if commit_text is None:
        commit_text = F.lit(None).cast("string")
    change = F.struct(
        action.alias("action"), tbl.alias("table"),
        commit_text.alias("timestamp"),
        entries(columns).alias("columns"), entries(identity).alias("identity"))
    env = F.struct(int_to_lsn(lsn).alias("lsn"), seq.cast("bigint").alias("seq"),
                   (ingest_text if ingest_text is not None else commit_text).alias("ingest_ts"),
                   change.alias("change"))
    return F.to_json(env, {"ignoreNullFields": "false"})
