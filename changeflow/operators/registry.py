"""Schema registry: tracked columns, drift detection and explicit sync (S4, X1, J4, T-8, T-10).

The registry is a small control table ``(table, column, ordinal)``: one row per column of
the replicated schema. It is a local relation, so Spark knows its size when it plans a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.sources.feed import DML_ACTIONS
from changeflow.specs import FIELD_LSN_PREFIX, FIELD_SEQ_PREFIX, ROW_LSN

REGISTRY_DDL = "table string, column string, ordinal int"


def registry_frame(spark: SparkSession, tracked: dict) -> DataFrame:
    rows = [(t, c, i) for t, cols in tracked.items() for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, REGISTRY_DDL)


def live_columns(source: DataFrame, table: str) -> DataFrame:
    """Column metadata of a live source DataFrame, in ordinal order."""
    rows = [(table, f.name, i) for i, f in enumerate(source.schema.fields)]
    return source.sparkSession.createDataFrame(rows, REGISTRY_DDL)


def feed_columns(feed: DataFrame) -> DataFrame:
    """Columns carried by insert/update records, per table, with occurrence counts."""
    iu = feed.where(~F.col("_corrupt") & F.col("action").isin("I", "U"))
    e = iu.select("table", "lsn", F.posexplode("columns").alias("ordinal", "c"))
    return e.select("table", F.col("c.name").alias("column"), "ordinal", "lsn")


def schema_diff(live: DataFrame, tracked: DataFrame) -> DataFrame:
    """added = live - tracked, removed = tracked - live, per (table, column)."""
    keys = ["table", "column"]
    flagged = lambda df, here, there: df.select(*keys, F.lit(True).alias(here), F.lit(False).alias(there))
    both = flagged(live, "live", "known").unionByName(flagged(tracked, "known", "live"))
    seen = both.groupBy(*keys).agg(F.bool_or("live").alias("live"), F.bool_or("known").alias("known"))
    return seen.where("live <> known").select(*keys, F.when(F.col("live"), "added").otherwise("removed").alias("change"))


def drift(feed: DataFrame, registry: DataFrame) -> DataFrame:
    """J4 + T-8: columns carried by I/U changes that are not registered, reported
    once per (table, column) with the number of records and the first position."""
    reg = registry.select("table", "column")
    cols = feed_columns(feed.where(F.col("action").isin(*DML_ACTIONS)))
    return (cols.join(reg, ["table", "column"], "left_anti")
                .groupBy("table", "column")
                .agg(F.count(F.lit(1)).alias("n_records"), F.min("lsn").alias("first_lsn")))


def backfill(state: DataFrame, added: list[tuple[str, str]]) -> DataFrame:
    """T-10: add newly tracked columns as NULL to every stored row.

    The new field's position is the row's position at sync time, so only changes
    newer than the row's current state can set it.
    """
    out = state
    for name, ddl in added:
        out = out.withColumn(name, F.lit(None).cast(ddl)) \
                 .withColumn(FIELD_LSN_PREFIX + name, F.col(ROW_LSN)) \
                 .withColumn(FIELD_SEQ_PREFIX + name, F.lit((1 << 63) - 1))
    return out
