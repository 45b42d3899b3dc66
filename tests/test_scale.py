"""What keeps the work in proportion to the table: compiled staging, one pass of the long form, batches of half a
feed, a feed landed once, landings dealt over all cores."""

import contextlib
import datetime
import io
import re

import pytest
from pyspark.sql import functions as F

from changeflow.operators.ops import stage_ops, to_generic_ops, to_ops
from changeflow.plans import feeds as fd
from changeflow.plans import queries as q
from changeflow.sources.feed import parse_feed
from changeflow.sources.store import VersionedStore
from changeflow.specs import TPCH_ORDERS, USERS, TableSpec
from changeflow.streaming.stream import run_stream

COMPILED = 8000                        # the JVM runs longer methods uncompiled
WIDE = TableSpec("wide", "id", (("id", "bigint"), *[(f"c{i}", ("string", "decimal(12,2)", "timestamp")[i % 3]) for i in range(14)]))


def _largest_method(df) -> int:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())))


def _lines(spark, tmp_path, lines):
    (tmp_path / "feed.json").write_text("\n".join(lines))
    return spark.read.text(str(tmp_path / "feed.json"))


@pytest.mark.parametrize("spec", [USERS, TPCH_ORDERS, WIDE], ids=lambda s: s.name)
def test_staging_stays_small_enough_to_be_compiled(spark, tmp_path, spec):
    assert _largest_method(stage_ops(parse_feed(_lines(spark, tmp_path, ["{}"])), spec)) < COMPILED


def test_generic_form_is_compiled_and_parses_once(spark, tmp_path):
    df = to_generic_ops(parse_feed(_lines(spark, tmp_path, ["{}"])), {USERS.name: USERS.pk}, {USERS.name: USERS.column_names})
    assert _largest_method(df) < COMPILED
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_wide_table_is_staged_in_several_steps(spark, tmp_path):
    cell = '{"name": "%s", "type": "text", "value": %s}'
    new = [cell % ("id", "7"), cell % ("c0", '"x"'), cell % ("c1", '"bad"'), cell % ("c3", "null"), cell % ("c12", '"a"'), cell % ("c12", '"z"')]
    old = [cell % ("id", "7"), cell % ("c0", '"x"'), cell % ("c12", '"y"')]
    line = '{"lsn": "0/1", "seq": 0, "change": {"action": "%s", "table": "wide", "timestamp": "2024-01-01 00:00:00+00", "columns": [%s], "identity": [%s]}}'
    feed = parse_feed(_lines(spark, tmp_path, [line % ("U", ", ".join(new), ", ".join(old)), line % ("D", "", ", ".join(old))]))
    staged = {r["action"]: r for r in stage_ops(feed, WIDE).collect()}
    u, d = staged["U"], staged["D"]
    assert (u["pk"], u["_p_c0"], u["c0"], u["_p_c3"], u["c3"], u["_p_c4"], u["c12"], u["_bad"]) == (7, False, None, True, None, False, "z", ["c1"])
    assert d["pk"] == 7 and d["is_delete"] and not d["_p_c12"] and d["deleted_at"] == datetime.datetime(2024, 1, 1) and d["_bad"] == []
    assert [r["pk"] for r in to_ops(feed, WIDE).collect()] == [7]


def test_empty_partitions_count_for_no_batch(spark):
    lines = spark.range(0, 8000, 1, 16).where("id >= 5000").select(F.col("id").cast("string").alias("value"))
    dealt, half = q._dealt(lines)
    assert dealt.count() == 3000 and half == 3          # six of sixteen partitions hold lines
    few, half = q._dealt(lines.where("id >= 7600"))
    assert few.rdd.getNumPartitions() == q.FEED_FILES and half == 2 and few.count() == 400


def test_status_reads_the_feed_that_landed(spark, tmp_path, monkeypatch):
    at = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(i, i % 7, "O", i + 0.5, at, "1-URGENT") for i in range(1, 200)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                          "o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(fd, "land", lambda *a: pytest.fail("landed again"))
    r = q.status(spark, str(tmp_path)).first()
    assert (r["applied_lsn"], r["backlog"], r["snapshot_rows"]) == (fd.POS_INSERT + 195, 0, 199)


def test_landings_of_the_log_are_dealt_over_all_cores(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(i, at, i % 9, "view", 1.0, '{"k": 1}') for i in range(1, 4000)],
                          "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
                          ).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    _, lines, width = q._users_log(spark, str(tmp_path), "t")
    first = lines.where(F.col("at") < width).select(F.spark_partition_id().alias("p")).distinct().count()
    assert first >= spark.sparkContext.defaultParallelism


def test_a_micro_batch_takes_no_storage_memory(spark, tmp_path, monkeypatch):
    cell = '{"name": "%s", "type": "text", "value": %s}'
    line = '{"lsn": "0/%X", "seq": 0, "change": {"action": "I", "table": "wide", "timestamp": "2024-01-01 00:00:00+00", "columns": [%s]}}'
    lines = [line % (i, ", ".join([cell % ("id", f'"{i}"'), cell % ("c0", '"%s"' % ("x" * 100)), cell % ("c1", '"bad"' if i % 10 == 0 else "1")])) for i in range(1, 501)]
    (tmp_path / "in").mkdir()
    _lines(spark, tmp_path / "in", lines)
    store = VersionedStore(spark, str(tmp_path / "store"), buckets=2)
    stored = lambda: {i.id(): (i.memSize(), i.diskSize()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    before, at, apply = stored(), {}, store.apply_batch
    monkeypatch.setattr(store, "apply_batch", lambda *a, **b: (at.update(stored()), apply(*a, **b))[1])
    run_stream(spark, str(tmp_path / "in"), store, [WIDE])
    parsed, staged = [at[i] for i in sorted(at) if i not in before]
    assert parsed[0] == staged[0] == 0 and 0 < staged[1] < parsed[1] / 2      # staged rows leave the text behind
    assert store.read("wide").count() == 450
    bad = {r["lsn"]: r["record"] for r in store.rejects().collect()}
    assert bad == {i: lines[i - 1] for i in range(10, 501, 10)}               # that of rejects is there in full
