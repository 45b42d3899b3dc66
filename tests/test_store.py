"""The store loses nothing: writers that meet, restarts, syncs, odd records, empty tables."""

import json

import pytest
from pyspark.sql import functions as F

from changeflow.operators import fold as fo
from changeflow.operators import reports as rp
from changeflow.operators.ops import to_ops
from changeflow.session import fresh_dir
from changeflow.sources.feed import parse_feed
from changeflow.sources.snapshot import snapshot_state
from changeflow.sources.store import DamagedRecord, VersionedStore
from changeflow.specs import TableSpec
from changeflow.streaming.stream import drain_and_stop, initialise, position_valid, resnapshot, run_stream, schema_sync, store_status

BOX = TableSpec("box", "id", (("id", "bigint"), ("label", "string"), ("size", "int")))
WIDE = BOX.with_column("colour", "string")


def line(pk, at, seq=0, action="U", table="box", **fields):
    key = [{"name": "id", "type": "int8", "value": pk}]
    cols = key + [{"name": k, "type": "text", "value": v} for k, v in fields.items()]
    change = {"action": action, "table": table, "timestamp": "2025-01-01 00:00:00+00", "columns": cols, "identity": key}
    return json.dumps({"lsn": f"0/{at:X}", "seq": seq, "change": change})


def folded(spark, *lines, spec=BOX):
    ops = to_ops(parse_feed(spark.createDataFrame([(x,) for x in lines], "value string")), spec)
    return {"box": (fo.coalesce(ops, spec.fields), spec.fields)}


def store_of(spark, **how):
    store = VersionedStore(spark, fresh_dir(spark, "t-store"), **({"buckets": 4} | how))
    store.register([BOX])
    return store


def land(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def labels(df):
    return {r["pk"]: r["label"] for r in df.collect()}


def test_two_writers_both_count(spark, monkeypatch):
    one = store_of(spark)
    two = VersionedStore(spark, one.root, buckets=4)
    publish = one._publish

    def late(version, rec):                     # the other writer commits just before this one's rename
        monkeypatch.setattr(one, "_publish", publish)
        two.apply_batch("b", 0, folded(spark, line(2, 2, label="two")), {"max_lsn": 2})
        publish(version, rec)
    monkeypatch.setattr(one, "_publish", late)
    one.apply_batch("a", 0, folded(spark, line(1, 1, label="one")), {"max_lsn": 1})
    assert labels(one.read("box")) == {1: "one", 2: "two"} == labels(two.read("box"))
    assert one.record()["applied_lsn"] == 2 and one.record()["streams"] == {"a": 0, "b": 0}


def test_batch_committed_during_a_sync_stays(spark, monkeypatch):
    store = store_of(spark)
    store.apply_batch("s", 0, folded(spark, line(1, 1, label="one")), {"max_lsn": 1})
    other = VersionedStore(spark, store.root)
    publish = store._publish

    def late(version, rec):
        monkeypatch.setattr(store, "_publish", publish)
        other.apply_batch("s", 1, folded(spark, line(2, 2, label="two")), {"max_lsn": 2})
        publish(version, rec)
    monkeypatch.setattr(store, "_publish", late)
    schema_sync(store, WIDE)
    assert labels(store.read("box")) == {1: "one", 2: "two"} and "colour" in store.read("box").columns


def test_reopened_with_other_buckets(spark):
    store = store_of(spark)
    store.apply_batch("s", 0, folded(spark, *[line(i, 1, label="old") for i in range(40)]), {"max_lsn": 1})
    again = VersionedStore(spark, store.root, buckets=16)
    again.apply_batch("s", 1, folded(spark, *[line(i, 2, label="new") for i in range(0, 40, 2)]), {"max_lsn": 2})
    assert labels(again.read("box")) == {i: "old" if i % 2 else "new" for i in range(40)}
    assert labels(again.lookup("box", [3, 4, 99])) == {3: "old", 4: "new"}


def test_new_checkpoint_on_a_used_store(spark):
    store, path = store_of(spark), fresh_dir(spark, "t-land")
    land(spark, path + "/a", line(1, 1, label="one"))
    run_stream(spark, path + "/a", store, [BOX])
    land(spark, path + "/b", line(2, 2, label="two"))
    run_stream(spark, path + "/b", store, [BOX])
    assert labels(store.read("box")) == {1: "one", 2: "two"}


def test_resnapshot_then_stream(spark):
    store, path = store_of(spark), fresh_dir(spark, "t-land")
    land(spark, path + "/a", line(1, 1, label="one"), line(5, 2, action="D"))
    run_stream(spark, path + "/a", store, [BOX])
    source = spark.createDataFrame([(1, "snap", 1), (3, "three", 3)], "id long, label string, size int")
    resnapshot(store, {"box": source}, [BOX], 10, vanished_deleted_at="2030-01-01 00:00:00")
    land(spark, path + "/b", line(1, 9, label="before the snapshot"), line(1, 10, label="at it"), line(3, 11, label="after it"))
    run_stream(spark, path + "/b", store, [BOX])
    rows = {r["pk"]: r for r in store.read("box").collect()}
    assert rows[1]["label"] == "snap" and rows[3]["label"] == "after it"
    assert str(rows[5]["deleted_at"]) == "2025-01-01 00:00:00"                  # deleted before: keeps its time
    assert store.record()["snapshot"]["counts"] == {"box": 3} and store_status(store).first()["snapshot_rows"] == 3


def test_unreadable_record_is_an_error(spark):
    store = store_of(spark)
    store.apply_batch("s", 0, folded(spark, line(1, 1, label="one")), {"max_lsn": 1})
    version = store.record()["version"]
    open(store._record_path(version + 1).removeprefix("file:"), "w").close()    # records are renamed whole: this is damage
    again = VersionedStore(spark, store.root)
    with pytest.raises(DamagedRecord):
        again.read("box")
    with pytest.raises(DamagedRecord):
        again.apply_batch("s", 1, folded(spark, line(2, 2, label="two")), {"max_lsn": 2})
    assert labels(again.read("box", version)) == {1: "one"}


def test_empty_table(spark):
    store = VersionedStore(spark, fresh_dir(spark, "t-store"))
    empty = spark.createDataFrame([], "id long, label string, size int")
    assert initialise(store, {"box": empty}, [BOX], 1) and not initialise(store, {"box": empty}, [BOX], 1)
    assert store.read("box").count() == 0 and rp.max_id("box", store.read("box"), "pk").first()["max_id"] == 0
    fresh = store_of(spark)
    assert fresh.read("box").columns == fo.target_columns(BOX.fields) and fresh.read("box").count() == 0


def test_a_batch_writes_its_own_rows_only(spark):
    store = store_of(spark, compact_after=4)
    source = spark.range(5000).selectExpr("id", "'base' AS label", "1 AS size")
    initialise(store, {"box": source}, [BOX], 0)
    base = store.table("box")["base"]
    for n in range(3):
        store.apply_batch("s", n, folded(spark, line(n, n + 1, label="new"), line(9, n + 1, label=str(n))), {"max_lsn": n + 1})
    t = store.table("box")
    assert t["base"] == base and [x["rows"] for x in t["deltas"]] == [2, 2, 2]
    store.apply_batch("s", 3, folded(spark, line(7000, 9, label="far")), {"max_lsn": 9})
    t = store.table("box")
    assert t["base"] == base and [x["rows"] for x in t["deltas"]] == [5]        # deltas merged, the table untouched
    store.compact("box", force=True)
    assert store.table("box")["deltas"] == [] and store.table("box")["base"]["rows"] == 5001
    got = labels(store.read("box"))
    assert len(got) == 5001 and got[9] == "2" and got[0] == "new" and got[7000] == "far" and got[4999] == "base"


def test_ties_across_batches_do_not_depend_on_order(spark):
    first, second = line(1, 7, seq=1, label="first"), line(1, 7, seq=2, label="second")
    for order in ([first, second], [second, first], [second, first, second]):
        store = store_of(spark)
        for n, x in enumerate(order):
            store.apply_batch("s", n, folded(spark, x), {"max_lsn": 7})
        assert labels(store.read("box")) == {1: "second"}


def test_row_guard_mode(spark):
    store = store_of(spark)
    for n, x in enumerate([line(1, 7, label="seven"), line(1, 5, size="5"), line(2, 1, label="two")]):
        store.apply_batch("s", n, folded(spark, x), {"max_lsn": 7}, mode="row")
    assert {r["pk"]: (r["label"], r["size"]) for r in store.read("box").collect()} == {1: ("seven", None), 2: ("two", None)}


def test_every_record_is_accounted_for(spark):
    store, path = store_of(spark), fresh_dir(spark, "t-land")
    land(spark, path, line(1, 1, label="good"), line(2, 2, size="big"), "{broken", line(3, 4, action="B"), line(4, 5, table="else", label="x"),
         line(5, 6, extra="drifted"))
    run_stream(spark, path, store, [BOX])
    p = store.progress().first()
    assert (p["read"], p["written"], p["rejected"], p["skipped"]) == (6, 2, 3, 1)
    assert sorted(r["reason"] for r in store.rejects().collect()) == ["corrupt", "size", "unknown_table"]
    assert [tuple(r) for r in store.drift().collect()] == [("box", "extra", 6)]
    assert p["apply_lag_s"] > 0 and p["read_per_s"] > 0 and p["applied_lsn"] == 6
    assert position_valid(store, 7) and position_valid(store, None) and not position_valid(store, 9)


def test_sync_reaches_a_running_stream_and_keeps_removed_columns(spark):
    store, path = store_of(spark), fresh_dir(spark, "t-land")
    land(spark, path, line(1, 1, label="one", colour="unseen"))
    q = run_stream(spark, path, store, [BOX], available_now=False, processing_time="0 seconds")
    try:
        q.processAllAvailable()
        live = spark.createDataFrame([], "id long, size int, colour string")    # label dropped, colour added
        assert sorted(tuple(r) for r in schema_sync(store, BOX, live).collect()) == [("box", "colour", "added"), ("box", "label", "removed")]
        land(spark, path, line(1, 2, label="ignored", colour="red"), line(2, 3, size="4"))
    finally:
        drain_and_stop(q)
    got = {r["pk"]: r for r in store.read("box").collect()}
    assert got[1]["colour"] == "red" and got[2]["size"] == 4 and got[2]["colour"] is None and "label" not in store.read("box").columns
    schema_sync(store, WIDE)
    assert labels(store.read("box"))[1] is None                                 # tracked again: NULL until it next changes


def test_unregistered_table_stops_the_stream(spark):
    from changeflow.streaming.stream import batch_handler
    store = store_of(spark)
    feed = parse_feed(spark.createDataFrame([(line(1, 1, label="x"),)], "value string"))
    with pytest.raises(ValueError, match="not in the registry"):
        batch_handler(store, ["box", "unknown"], "s")(feed, 0)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_layers_are_merged_without_a_shuffle(spark):
    store = store_of(spark, buckets=8, small=0)
    for n in range(3):
        store.apply_batch("s", n, folded(spark, *[line(i, n + 1, label=str(n)) for i in range(n, 200, n + 1)]), {"max_lsn": n, "written": 200})
    df = store.read("box")
    text = plan_of(df)
    assert len(store.table("box")["deltas"]) == 3 and "Exchange" not in text and text.count("SelectedBucketsCount: 8 out of 8") == 3
    want = {i: "0" for i in range(200)} | {i: "1" for i in range(1, 200, 2)} | {i: "2" for i in range(2, 200, 3)}
    assert labels(df) == want
    store.compact("box", force=True)                                            # nothing moves here either
    assert labels(store.read("box")) == want and store.table("box")["base"]["rows"] == 200


def test_only_a_small_delta_is_dealt_to_the_buckets(spark):
    store = store_of(spark, buckets=8, small=10)
    source = spark.range(5000).selectExpr("id", "'base' AS label", "1 AS size")
    initialise(store, {"box": source}, [BOX], 0)
    store.apply_batch("s", 0, folded(spark, line(3, 1, label="new"), line(7000, 1, label="far")), {"max_lsn": 1, "written": 2})
    t = store.table("box")
    assert (t["base"]["buckets"], [x["buckets"] for x in t["deltas"]]) == (8, [0])
    text = plan_of(store.read("box"))
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
    base, delta = text.split("Union")[1].split("SelectedBucketsCount: 8 out of 8")          # the exchange lies above the delta alone
    assert "Exchange" not in base and "Exchange" in delta
    assert store.read("box").where("label <> 'base'").count() == 2 and store.read("box").count() == 5001


def test_lookup_opens_the_buckets_concerned(spark):
    store = store_of(spark, buckets=8, small=0)
    for n in range(2):
        store.apply_batch("s", n, folded(spark, *[line(i, n + 1, label=str(i)) for i in range(200)]), {"max_lsn": 1, "written": 200})
    df = store.lookup("box", [17])
    assert labels(df) == {17: "17"} and plan_of(df).count("SelectedBucketsCount: 1 out of 8") == 2


@pytest.mark.parametrize("compact", [False, True])
def test_a_column_tracked_again_is_null(spark, compact):
    """Track, untrack, change, track again: the old value does not come back (T-10)."""
    store = store_of(spark)
    step = iter(range(9))
    put = lambda spec, *lines: store.apply_batch("s", next(step), folded(spark, *lines, spec=spec), {"max_lsn": 1})
    put(BOX, line(1, 1, label="old", size="1"), line(2, 1, label="kept", size="2"))
    narrow = TableSpec("box", "id", (("id", "bigint"), ("size", "int")))
    schema_sync(store, narrow)
    put(narrow, line(1, 2, label="unseen", size="3"))
    if compact:
        store.compact("box", force=True)
    assert [tuple(r) for r in schema_sync(store, BOX).collect()] == [("box", "label", "added")]
    put(BOX, line(2, 5, label="newer"))
    if compact:
        store.compact("box", force=True)
    assert {r["pk"]: (r["label"], r["size"]) for r in store.read("box").collect()} == {1: (None, 3), 2: ("newer", 2)}
    assert schema_sync(store, BOX).collect() == [] and labels(store.lookup("box", [1])) == {1: None}


def test_a_changed_type_is_reported_and_taken(spark):
    store = store_of(spark)
    store.apply_batch("s", 0, folded(spark, line(1, 1, label="12"), line(2, 1, label="word")), {"max_lsn": 1})
    other = TableSpec("box", "id", (("id", "bigint"), ("label", "bigint"), ("size", "int")))
    assert [tuple(r) for r in schema_sync(store, other).collect()] == [("box", "label", "retyped")]
    store.apply_batch("s", 1, folded(spark, line(3, 2, label="7"), spec=other), {"max_lsn": 2})
    for _ in range(2):
        df = store.read("box")
        assert dict(df.dtypes)["label"] == "bigint" and labels(df) == {1: 12, 2: None, 3: 7}
        store.compact("box", force=True)
    with pytest.raises(ValueError, match="cannot change"):
        schema_sync(store, TableSpec("box", "id", (("id", "string"), ("label", "bigint"), ("size", "int"))))


@pytest.mark.parametrize("mode", ["field", "row"])
def test_every_reject_is_stored(spark, mode):
    """Counted is stored, in both modes; a change without a table name is a reject like any other."""
    store, path = store_of(spark), fresh_dir(spark, "t-land")
    land(spark, path, line(1, 1, label="good"), line(2, 2, size="big"), "{broken", line(3, 4, table=None, label="x"), line(4, 5, table="else"),
         line(5, 6, extra="drifted", size="1"), line(6, 7, action="B", table=None))
    run_stream(spark, path, store, [BOX], mode=mode)
    p = store.progress().first()
    assert (p["read"], p["written"], p["rejected"], p["skipped"]) == (7, 2, 4, 1)
    got = sorted((r["table"], r["reason"]) for r in store.rejects().collect())
    assert got == [("", "corrupt"), ("", "unknown_table"), ("box", "size"), ("else", "unknown_table")]
    assert [tuple(r) for r in store.drift().collect()] == [("box", "extra", 6)]


def test_maintenance_beside_the_stream(spark):
    store = store_of(spark, compact_after=3)
    initialise(store, {"box": spark.range(100).selectExpr("id", "'base' AS label", "1 AS size")}, [BOX], 0)
    assert store.maintain() == []
    for n in range(6):
        store.apply_batch("s", n, folded(spark, *[line(10 * n + i, n + 1, label=str(n)) for i in range(10)]), {"max_lsn": 1, "written": 10})
    t = store.table("box")
    assert t["base"]["rows"] == 100 and len(t["deltas"]) < 3                     # batches never rewrote the base
    assert VersionedStore(spark, store.root).maintain() == ["box"] and store.table("box")["deltas"] == []
    assert labels(store.read("box")) == {i: str(i // 10) if i < 60 else "base" for i in range(100)}


def test_parity_counts_missing_rows(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, label string")
    target = spark.createDataFrame([(1, "a"), (9, "z")], "id long, label string")
    r = rp.parity_summary(source, target, "id", ["label"]).first()
    assert (r["rows_compared"], r["rows_missing"], r["rows_matched"], r["rows_mismatched"]) == (3, 2, 1, 2)
    assert {(x["id"], x["found"]) for x in rp.parity(source, target, "id", ["label"]).collect()} == {(2, False), (3, False)}
    big = spark.createDataFrame([(2 ** 62 + i,) for i in range(50)], "id long")
    a, b = ({x[0] for x in rp.sample_keys(big, "id", 10, seed).collect()} for seed in ("x", "y"))
    assert len(a) == 10 and a != b


def test_batches_of_large_positions(spark):
    ops = spark.createDataFrame([(10 ** 16 + 999,), (10 ** 16 + 1000,)], "lsn long")
    got = {r["batch"]: r["backlog"] for r in rp.backlog_by_batch(ops, 1000).collect()}
    assert got == {10 ** 13: 1, 10 ** 13 + 1: 0}


def test_snapshot_wins_at_its_own_position(spark):
    snap = snapshot_state(spark.createDataFrame([(1, "s", 1)], "id long, label string, size int"), BOX, 5)
    ops = to_ops(parse_feed(spark.createDataFrame([(line(1, 5, seq=9, label="same place"),)], "value string")), BOX)
    for out in (fo.fold_into(snap, ops, BOX.fields), fo.replay(snap, ops, BOX.fields)):
        assert labels(out) == {1: "s"}
