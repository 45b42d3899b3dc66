"""From change record to op, by example: what a record of the item table does to its row."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changeflow.functions import (
    backlog, canonical_text, canonical_ts, event_lag_seconds, guard, int_to_lsn, lsn_to_int, parse_ts,
)
from changeflow.operators import fold as fo
from changeflow.operators.ops import envelope_rejects, pk_changes, to_ops, to_ops_with_rejects
from changeflow.sources.feed import dml_filter, entries_map, parse_feed, table_filter, types_map
from changeflow.specs import TableSpec

ITEM = TableSpec("item", "id", (("id", "bigint"), ("label", "string"), ("price", "decimal(9,3)"), ("sold", "boolean"),
                                ("seen", "timestamp"), ("stock", "int")))
TYPES = {"id": "int8", "label": "varchar", "price": "numeric(9,3)", "sold": "bool", "seen": "timestamptz", "stock": "integer"}


def image(**values):
    return [{"name": k, "type": TYPES.get(k, "text"), "value": v} for k, v in values.items()]


def line(action, at, new=None, old=None, seq=0, time="2025-02-03 04:05:06+00", table="item"):
    change = {"action": action, "table": table, "timestamp": time, "columns": image(**new or {}), "identity": image(**old or {})}
    return json.dumps({"lsn": at, "seq": seq, "ingest_ts": "2025-02-03 09:00:00+00", "change": change})


def feed(spark, *lines):
    return parse_feed(spark.createDataFrame([(x,) for x in lines], "value string"))


def state(spark, *lines, **how):
    return {r["pk"]: r for r in fo.coalesce(to_ops(feed(spark, *lines), ITEM, **how), ITEM.fields).collect()}


@pytest.mark.parametrize("kind,value,want", [
    ("numeric(9,3)", "0.100", "0.100"), ("money", 7, "7"), ("numeric", "1,5", None), ("BOOL", 1, "true"), ("boolean", "no", "false"),
    ("int4", " 12 ", "12"), ("int8", "12.5", None), ("date", "2025-02-03", "2025-02-03T00:00:00+00:00"),
    ("timestamp", "2025-02-03T04:05:06.5Z", "2025-02-03T04:05:06.500000+00:00"), ("timestamptz", "2025-02-03 06:05:06+02", "2025-02-03T04:05:06+00:00"),
    ("timestamptz", "soon", None), ("varchar", "t", "t"), (None, "as is", "as is"), ("numeric", None, None), ("jsonb", {"a": 1}, '{"a":1}')])
def test_values_in_canonical_form(spark, kind, value, want):
    row = spark.createDataFrame([(json.dumps({"t": kind, "v": value}),)], "j string").select(F.from_json("j", "t string, v variant").alias("r"))
    assert row.select(canonical_text(F.col("r.t"), F.col("r.v"))).first()[0] == want


@pytest.mark.parametrize("text,want", [("0/0", 0), ("1/0", 1 << 32), ("A/ff", (10 << 32) + 255), (" 2/1 ", (2 << 32) + 1), ("0/ZZ", None),
                                       ("xyz/10", None), ("0/1G", None), ("7", None), ("1/2/3", None), ("/1", None), (None, None)])
def test_positions(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string").select(lsn_to_int(F.col("t")).alias("n"))
    assert df.first()["n"] == want
    if want is not None:
        assert df.select(lsn_to_int(int_to_lsn(F.col("n")))).first()[0] == want


def test_positions_that_do_not_parse_are_rejects(spark):
    f = feed(spark, line("I", "0/ZZ", {"id": 1}), line("I", "0/1", {"id": 2}), "{broken", line("U", "0/2", {"id": 3}, table="elsewhere"))
    assert [r["pk"] for r in to_ops(f, ITEM).collect()] == [2]
    assert sorted(r["reason"] for r in envelope_rejects(f, ["item"]).collect()) == ["corrupt", "corrupt", "unknown_table"]


@pytest.mark.parametrize("lines,want", [
    # an insert carries what is tracked; an update what changed against the old image
    ([line("I", "0/1", {"id": 4, "label": "a", "hidden": "x", "price": "2.500"})], {"label": "a", "price": Decimal("2.500"), "sold": None, "_lsn": 1}),
    ([line("U", "0/2", {"id": 4, "label": "b", "stock": 3}, {"id": 4, "label": "a", "stock": 3})], {"label": "b", "stock": None, "_flsn_stock": None}),
    ([line("U", "0/2", {"id": 4, "label": None}, {"id": 4, "label": "a"})], {"label": None, "_flsn_label": 2}),
    ([line("U", "0/2", {"id": 4, "label": "b", "stock": 3}, {})], {"label": "b", "stock": 3}),                    # no old image: all changed
    ([line("U", "0/2", {"id": 4, "price": "2.50"}, {"id": 4, "price": "2.500"})], {"price": Decimal("2.500")}),
    # fields from different changes meet in one row, whatever the order they come in
    ([line("I", "0/1", {"id": 4, "label": "a", "stock": 1}), line("U", "0/3", {"id": 4, "stock": 2}, {"id": 4, "stock": 1})], {"label": "a", "stock": 2, "_lsn": 3}),
    ([line("U", "0/9", {"id": 4, "label": "late"}), line("U", "0/5", {"id": 4, "label": "early", "stock": 8})], {"label": "late", "stock": 8, "_lsn": 9}),
    # at one position the later sequence number wins; a repeated record changes nothing
    ([line("U", "0/5", {"id": 4, "label": "two"}, seq=2), line("U", "0/5", {"id": 4, "label": "one"}, seq=1)], {"label": "two", "_fseq_label": 2}),
    ([line("U", "0/5", {"id": 4, "label": "x"})] * 3, {"label": "x", "_lsn": 5}),
])
def test_what_a_row_becomes(spark, lines, want):
    row = state(spark, *lines)[4].asDict()
    assert {k: row[k] for k in want} == want


def test_deletes_are_soft_and_stay(spark):
    gone = [line("D", "0/4", old={"id": 1, "label": "a"}), line("I", "0/6", {"id": 1, "label": "again"})]
    row = state(spark, *gone)[1]
    assert str(row["deleted_at"]) == "2025-02-03 04:05:06" and row["label"] == "again"
    assert state(spark, *gone, revive_on_insert=True)[1]["deleted_at"] is None
    late = state(spark, line("D", "0/4", old={"id": 2}, time=None))[2]          # no commit time: when it was read
    assert str(late["deleted_at"]) == "2025-02-03 09:00:00"


def test_only_changes_of_the_table_count(spark):
    f = feed(spark, line("B", "0/1"), line("C", "0/2"), line("M", "0/3"), line("I", "0/4", {"id": 1}), line("I", "0/5", {"id": 1}, table="other"))
    assert dml_filter(f).count() == 2 and table_filter(dml_filter(f), ["item"]).count() == 1 and to_ops(f, ITEM).count() == 1


def test_values_that_do_not_fit_are_rejected_by_name(spark):
    f = feed(spark, line("I", "0/1", {"id": "one", "label": "a"}), line("I", "0/2", {"id": 2, "price": "dear", "stock": "few"}),
             line("U", "0/3", {"label": "no key"}), line("I", "0/4", {"id": 4, "price": None}))
    ops, bad = to_ops_with_rejects(f, ITEM)
    assert [r["pk"] for r in ops.collect()] == [4]
    assert {(r["lsn"], r["reason"]) for r in bad.collect()} == {(1, "id"), (2, "price,stock"), (3, "id")}


def test_key_changes_are_listed(spark):
    f = feed(spark, line("U", "0/1", {"id": 8}, {"id": 7}), line("U", "0/2", {"id": 8}, {"id": 8}))
    assert [(r["old_pk"], r["new_pk"]) for r in pk_changes(f, ITEM).collect()] == [("7", "8")]


def test_entries_as_maps_keep_the_last_of_a_name(spark):
    j = json.dumps({"c": [{"name": "a", "type": "int4", "value": 1}, {"name": "b", "value": "x"}, {"name": "a", "type": "int8", "value": 2}]})
    df = spark.createDataFrame([(j,), ('{"c": []}',)], "j string").select(
        F.from_json("j", "c array<struct<name: string, type: string, value: variant>>")["c"].alias("c"))
    got = df.select(F.to_json(entries_map(F.col("c"))), types_map(F.col("c"))).collect()
    assert json.loads(got[0][0]) == {"a": 2, "b": "x"} and got[0][1] == {"a": "int8", "b": "text"} and got[1][1] == {}


def test_guard_lag_and_backlog(spark):
    df = spark.createDataFrame([(5, None), (5, 5), (6, 5)], "n long, s long")
    assert [r[0] for r in df.select(guard(F.col("n"), F.col("s"))).collect()] == [True, False, True]
    assert [r[0] for r in df.select(backlog(F.col("n"), F.col("s"))).collect()] == [5, 0, 1]
    t = spark.createDataFrame([("2025-01-01 00:00:03", "2025-01-01 00:00:01.5"), ("2025-01-01", "2025-01-02"), (None, "2025-01-01")], "a string, b string")
    assert [r[0] for r in t.select(event_lag_seconds(parse_ts(F.col("a")), parse_ts(F.col("b")))).collect()] == [1.5, 0.0, 0.0]
    assert t.select(canonical_ts(parse_ts(F.col("b")))).first()[0] == "2025-01-01T00:00:01.500000+00:00"
