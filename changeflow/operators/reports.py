"""Reports over source and target tables.

All are distributed joins/aggregations; results are small (per column, per table
or per batch) but nothing is gathered on the driver to compute them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions import canonical_of_typed, canonical_ts, event_lag_seconds, rate
from changeflow.specs import DELETED_AT


def _canon(df: DataFrame, c: str) -> Column:
    return canonical_of_typed(F.col(c), df.schema[c].dataType)


def _side_by_side(source: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Every source row with its target row, if there is one (``_found``), values as canonical text."""
    s = source.select(F.col(key).alias("_k"), *[_canon(source, c).alias("s_" + c) for c in columns])
    t = target.select(F.col(key).alias("_k"), F.lit(True).alias("_found"),
                      *[_canon(target, c).alias("t_" + c) for c in columns])
    return s.join(t, "_k", "left").withColumn("_found", F.coalesce("_found", F.lit(False)))


def _differs(c: str) -> Column:
    """A row that the target lacks differs in every field."""
    return ~F.col("_found") | ~F.col("s_" + c).eqNullSafe(F.col("t_" + c))


def parity(source: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per source key and column, source vs target values that differ (canonical text):
    (key, column, source, target, found). Of a row missing in the target, all fields differ."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col("s_" + c).alias("source"), F.col("t_" + c).alias("target"),
                               _differs(c).alias("differs")) for c in columns])
    return (_side_by_side(source, target, key, columns)
            .select(F.col("_k").alias(key), F.col("_found").alias("found"), F.inline(cells)).where("differs").drop("differs"))


def parity_summary(source: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per column, source rows, rows the target lacks, and rows that differ among all
    (rows, not fields, Q12); ``rows_matched`` are found and equal in the column."""
    r = _side_by_side(source, target, key, columns).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~F.col("_found")).alias("_missing"),
        *[F.count_if(_differs(c)).alias("m_" + c) for c in columns])
    stack = F.array(*[F.struct(F.lit(c).alias("column"), F.col("_n").alias("rows_compared"),
                               F.col("_missing").alias("rows_missing"), (F.col("_n") - F.col("m_" + c)).alias("rows_matched"),
                               F.col("m_" + c).alias("rows_mismatched")) for c in columns])
    return r.select(F.inline(stack))


def sample_keys(df: DataFrame, key: str, n: int, seed: str = "") -> DataFrame:
    """O3: a sample of ``n`` keys of a unique key column, the least by a seeded hash: the same keys in each
    run, another sample for each seed."""
    rank = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))
    return df.select(key).orderBy(rank, F.col(key)).limit(n)


def equal_rows(target: DataFrame, column: str, value) -> DataFrame:
    """Rows whose column has exactly this value (decimals compared as decimals)."""
    return target.where(F.col(column) == F.lit(value).cast(target.schema[column].dataType))


def present_keys(keys: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys present in the target."""
    return keys.join(target.select(key), key, "left_semi")


def missing_keys(keys: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys absent from the target."""
    return keys.join(target.select(key), key, "left_anti")


def orphans(children: DataFrame, fk: str, live_parents: DataFrame, pk: str) -> DataFrame:
    """Child rows whose parent key is not live, counted per parent key."""
    parents = live_parents.select(F.col(pk).alias(fk))
    return children.join(parents, fk, "left_anti").groupBy(fk).agg(F.count(F.lit(1)).alias("n_children"))


def table_counts(name: str, source: DataFrame | None, target: DataFrame) -> DataFrame:
    """Source rows vs target rows, live rows and tombstones."""
    t = target.agg(F.count(F.lit(1)).alias("target_rows"),
                   F.count_if(F.col(DELETED_AT).isNull()).alias("live_rows"),
                   F.count_if(F.col(DELETED_AT).isNotNull()).alias("tombstones"))
    return t.withColumn("source_rows", source.agg(F.count(F.lit(1))).scalar()).select(
        F.lit(name).alias("table"), "source_rows", "target_rows", "live_rows", "tombstones",
        (F.col("source_rows") == F.col("live_rows")).alias("converged"))


def op_mix(feed: DataFrame) -> DataFrame:
    """A10: operations per (table, action) and their rate over the feed's event-time span."""
    micros = F.unix_micros("commit_ts")
    g = feed.groupBy("table", "action").agg(F.count(F.lit(1)).alias("n"), F.min(micros).alias("_lo"), F.max(micros).alias("_hi"))
    # one pass over the feed; the span comes from the few groups
    all_ = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    span = (F.max("_hi").over(all_) - F.min("_lo").over(all_)) / F.lit(1e6)
    return g.withColumn("_span", span).select("table", "action", "n", rate(F.col("n"), F.col("_span")).alias("per_sec"))


def batch_stats(ops_feed: DataFrame, batch: Column) -> DataFrame:
    """A2, A3, A5: per batch, events before coalescing, keys after, high-water
    position, last non-null commit time (arrival order)."""
    f = ops_feed.withColumn("_b", batch)
    return f.groupBy("_b").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_distinct("table", "pk").alias("keys"),
        F.max("lsn").alias("max_lsn"),
        canonical_ts(F.max_by("commit_ts", F.when(F.col("commit_ts").isNotNull(),
                                                  F.struct("lsn", "seq")))).alias("last_commit"),
    ).withColumnRenamed("_b", "batch")


def lag_by_batch(ops_feed: DataFrame, batch: Column, applied_at: Column, slo_seconds: float = 5.0) -> DataFrame:
    """Per batch, from the time each was applied (``applied_at``, of the batch's commit).

    ``read_lag_s``: event-time lag of the batch's last change behind what the reader has read by then, the
    close of the next batch (floored at 0, 0 when unknown); ``e2e_max_lag_s``: the longest time a change of the batch waited
    from its commit to its application, against the SLO. Batches are consecutive integers; the next one is found by an
    equi-join on ``b + 1``, not by a global window.
    """
    per = ops_feed.withColumn("_b", batch).groupBy("_b").agg(
        F.count(F.lit(1)).alias("events"), F.max("commit_ts").alias("_close"), F.min("commit_ts").alias("_open"),
        F.max(applied_at).alias("_applied"))
    nxt = per.select((F.col("_b") - 1).alias("_b"), F.col("_close").alias("_next_close"))
    e2e = event_lag_seconds(F.col("_applied"), F.col("_open"))
    return per.join(nxt, "_b", "left").select(
        F.col("_b").alias("batch"), "events", event_lag_seconds(F.col("_next_close"), F.col("_close")).alias("read_lag_s"),
        e2e.alias("e2e_max_lag_s"), (e2e <= F.lit(float(slo_seconds))).alias("within_slo"))


def backlog_by_batch(ops_feed: DataFrame, width: int) -> DataFrame:
    """after each batch of ``width`` positions, distance from the applied position to the feed head. Batches
    are position ranges, so a batch's own maximum is the running one; the head is the maximum of the batches'."""
    per = ops_feed.groupBy(F.expr(f"lsn div {int(width)}").alias("batch")).agg(F.max("lsn").alias("applied_lsn"))
    head = per.agg(F.max("applied_lsn")).scalar()
    return per.select("batch", "applied_lsn", (head - F.col("applied_lsn")).alias("backlog"))


def max_id(name: str, target: DataFrame, key: str) -> DataFrame:
    """``COALESCE(max(id), 0)``."""
    return target.agg(F.coalesce(F.max(key), F.lit(0).cast(T.LongType())).alias("max_id")) \
        .select(F.lit(name).alias("table"), "max_id")
