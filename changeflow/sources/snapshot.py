"""Consistent snapshot of source tables at one position.

A snapshot row carries every tracked column, ``deleted_at`` = NULL and position L0
for the row and every field, so any later change (position > L0) wins and any
change at or before L0 loses. Snapshot loading is an unconditional replace of the
target (re-running gives the same state).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.fold import LAST_SEQ, target_columns
from changeflow.specs import DELETED_AT, FIELD_LSN_PREFIX, FIELD_SEQ_PREFIX, ROW_LSN, TableSpec


def snapshot_state(source: DataFrame, spec: TableSpec, l0: int, tracked=None) -> DataFrame:
    """Typed source rows -> target state stamped with position ``l0``."""
    tracked = [c for c in spec.column_names if tracked is None or c in set(tracked)]
    fields = [c for c in tracked if c != spec.pk]
    pos = F.lit(l0).cast("bigint")
    cols = [F.col(spec.pk).cast(spec.spark_type(spec.pk)).alias("pk")]
    cols += [F.col(c).cast(spec.spark_type(c)).alias(c) for c in fields]
    cols += [F.lit(None).cast("timestamp").alias(DELETED_AT), pos.alias(ROW_LSN)]
    cols += [pos.alias(FIELD_LSN_PREFIX + c) for c in fields + [DELETED_AT]]
    # after every change at the snapshot's own position: those are part of it
    cols += [F.lit(LAST_SEQ).cast("bigint").alias(FIELD_SEQ_PREFIX + c) for c in fields + [DELETED_AT]]
    return source.select(*cols).select(*target_columns(fields))


def snapshot_tables(spark: SparkSession, sources: dict, specs, l0: int) -> tuple[dict, DataFrame]:
    """S3: snapshot several tables at one position, parents first.

    ``sources`` maps table name -> DataFrame. Returns ({name: state}, counts) where
    counts has one row (table, ordinal, rows) per table; counting is a distributed
    aggregate per table, unioned into one small result.
    """
    states, counts = {}, None
    for i, spec in enumerate(specs):
        st = snapshot_state(sources[spec.name], spec, l0)
        states[spec.name] = st
        c = st.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(spec.name).alias("table"), F.lit(i).alias("ordinal"), "rows")
        counts = c if counts is None else counts.unionByName(c)
    return states, counts


def read_jdbc_snapshot(spark: SparkSession, url: str, table: str, pk: str, lower: int, upper: int,
                       partitions: int, fetchsize: int = 5000, snapshot_name: str | None = None,
                       properties: dict | None = None) -> DataFrame:
    """S2 from a database: a key-range-partitioned JDBC scan (``partitions`` parallel
    readers over ``[lower, upper]`` of ``pk``), ``fetchsize`` rows per round trip.

    ``snapshot_name`` pins every reader to one exported transaction snapshot
    (REPEATABLE READ + SET TRANSACTION SNAPSHOT), so all partitions see the database
    at the same position L0. Needs the database's JDBC driver on the classpath; not
    exercised by the tests (no database is run here).
    """
    opts = dict(properties or {})
    opts["fetchsize"] = str(fetchsize)
    if snapshot_name:
        opts["sessionInitStatement"] = (
            "BEGIN TRANSACTION ISOLATION LEVEL REPEATABLE READ; "
            f"SET TRANSACTION SNAPSHOT '{snapshot_name}'")
    return spark.read.jdbc(url, table, column=pk, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=opts)
