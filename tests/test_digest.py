"""Parity by digests gives what parity gives, and reads rows only where copies differ."""

import pytest
from pyspark.sql import functions as F

from changeflow.operators import digest as dg
from changeflow.operators import reports as rp

COLS = ["label", "size", "price", "at"]
DDL = "id long, label string, size int, price decimal(12,2), at timestamp"


def table(spark, n):
    i = F.col("id")
    return spark.range(n).select("id", F.concat(F.lit("l"), i % 7).alias("label"), (i % 5).cast("int").alias("size"),
                                 (i / 4).cast("decimal(12,2)").alias("price"), F.timestamp_seconds(i * 60).alias("at"))


def cells(df):
    return sorted(map(str, df.collect()))


def same_reports(source, target, **how):
    at = dg.narrow(source, target, "id", COLS, **how)
    assert cells(dg.parity(source, target, "id", COLS, at)) == cells(rp.parity(source, target, "id", COLS))
    assert cells(dg.parity_summary(source, target, "id", COLS, at)) == cells(rp.parity_summary(source, target, "id", COLS))
    assert cells(dg.extra_keys(source, target, "id", COLS, at)) == cells(rp.missing_keys(target.select("id"), source, "id"))
    return at


def test_equal_copies_move_digests_only(spark):
    source = table(spark, 8_000)
    at = same_reports(source, source.repartition(7, "label"))
    assert (at.nodes, at.n_nodes, at.rows_left, at.source_rows, at.target_rows) == (None, 0, 0, 8_000, 8_000)


@pytest.mark.parametrize("bits", [4, 12])
def test_few_differences_are_narrowed_down(spark, bits):
    source = table(spark, 8_000)
    target = (source.where("id <> 77").withColumn("label", F.when(F.col("id") == 123, F.lit(None)).otherwise(F.col("label")))
              .withColumn("price", F.when(F.col("id") == 7_999, F.col("price") + 1).otherwise(F.col("price")))
              .unionByName(table(spark, 8_001).where("id = 8000")))
    at = same_reports(source, target, bits=bits, leaf_rows=16)
    assert at.n_nodes in (3, 4) and at.rows_left <= 2 * 16 * 4


def test_swapped_values_and_moved_text_are_seen(spark):
    source = spark.createDataFrame([(1, "ab", 1, None, None), (2, "a", 1, None, None), (3, None, 1, None, None), (4, "", 1, None, None)], DDL)
    swap = spark.createDataFrame([(1, "a", 1, None, None), (2, "ab", 1, None, None), (3, "", 1, None, None), (4, None, 1, None, None)], DDL)
    assert same_reports(source, swap).n_nodes == 4


def test_where_all_rows_differ_digests_stay_few(spark):
    source = table(spark, 5_000)
    at = same_reports(source, source.withColumn("size", F.col("size") + 1), bits=4, leaf_rows=100)
    assert (at.level, at.n_nodes, at.rows_left) == (6, 64, 5_000)


def test_null_keys_empty_tables_and_many_nodes(spark, monkeypatch):
    empty = spark.createDataFrame([], DDL)
    assert same_reports(empty, empty).nodes is None
    assert same_reports(table(spark, 50), empty).rows_left == 50 and same_reports(empty, table(spark, 50)).target_rows == 50
    nulls = spark.createDataFrame([(None, "x", 1, None, None), (1, "y", 2, None, None)], DDL)
    assert same_reports(nulls, nulls).n_nodes == 1              # a null key is found nowhere
    monkeypatch.setattr(dg, "SHARED", 2)                        # nodes joined by a shuffle
    assert 50 <= same_reports(table(spark, 300), table(spark, 250)).rows_left < 60


def test_key_types_may_differ(spark):
    source, target = table(spark, 100), table(spark, 100).withColumn("id", F.col("id").cast("int"))
    assert same_reports(source, target).nodes is None


def test_a_task_sends_a_row_a_node(spark):
    source = table(spark, 50_000)
    plan = dg.node_digests(source, source, "id", COLS, 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan
