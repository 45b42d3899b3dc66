"""Snapshots in ranges of keys: ended loads go on, live sources, keys of several types, nulls and empty tables."""

import pytest
from pyspark.sql import functions as F
from test_store import BOX, labels, land, line

from changeflow.session import fresh_dir
from changeflow.sources.chunks import in_range, key_cuts, load_chunks, load_progress
from changeflow.sources.store import CommitConflict, VersionedStore
from changeflow.specs import ROW_LSN, TableSpec
from changeflow.streaming.stream import initialise, run_stream


class Ended(Exception):
    pass


def boxes(spark, n, word):
    return {"box": spark.range(n).select("id", F.lit(word).alias("label"), F.lit(1).alias("size"))}


def until(n, position=lambda: 7):
    """A position that ends the load when asked for the n-th time."""
    asked = []

    def at():
        asked.append(0)
        if len(asked) == n:
            raise Ended
        return position()
    return at


def empty_store(spark, root=None):
    return VersionedStore(spark, root or fresh_dir(spark, "t-chunks"), buckets=4)


def test_an_ended_load_reads_only_what_is_missing(spark):
    store = empty_store(spark)
    with pytest.raises(Ended):
        load_chunks(store, boxes(spark, 1000, "first"), [BOX], until(4), chunks=5)
    assert store.read("box") is None                                # nothing is seen before all of it is there
    (table, ranges, done, rows), = load_progress(store).collect()
    assert (table, ranges, done) == ("box", 5, 3) and 300 < rows < 900
    assert store.unreferenced(older_than_s=-60) == []               # vacuum leaves the ranges alone
    again = empty_store(spark, store.root)                          # as after a restart
    rec = load_chunks(again, boxes(spark, 1000, "second"), [BOX], lambda: 7, chunks=5)
    got = labels(again.read("box"))
    assert sorted(got) == list(range(1000)) and sum(x == "first" for x in got.values()) == rows
    assert rec["snapshot"] == {"done": True, "lsn": 7, "counts": {"box": 1000}} and "loading" not in rec
    assert (rec["applied_lsn"], rec["covered"]) == (7, 7) and load_progress(again).count() == 0
    plan = again.read("box")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert not initialise(again, boxes(spark, 1000, "third"), [BOX], 9, chunks=5)     # it is loaded


def test_a_load_ended_while_merging_reads_no_range_again(spark, monkeypatch):
    store = empty_store(spark)
    monkeypatch.setattr("changeflow.sources.chunks._merged", lambda *_: (_ for _ in ()).throw(Ended()))
    with pytest.raises(Ended):
        load_chunks(store, boxes(spark, 100, "first"), [BOX], 7, chunks=3)
    monkeypatch.undo()
    load_chunks(store, boxes(spark, 100, "second"), [BOX], 7, chunks=3)
    assert labels(store.read("box")) == dict.fromkeys(range(100), "first")


def test_another_load_starts_anew(spark):
    store = empty_store(spark)
    at = until(3)
    with pytest.raises(Ended):
        load_chunks(store, boxes(spark, 100, "first"), [BOX], at, chunks=4)
    assert initialise(store, boxes(spark, 100, "second"), [BOX], 9, chunks=4)          # another position: another state
    assert set(labels(store.read("box")).values()) == {"second"} and store.record()["snapshot"]["lsn"] == 9


def test_two_loads_at_once(spark):
    one = empty_store(spark)
    two = empty_store(spark, one.root)

    def meanwhile():                                                # the other load runs to its end before this one's second range
        if not (one.record() or {}).get("snapshot") and load_progress(one).first()["done"] == 1:
            load_chunks(two, boxes(spark, 100, "two"), [BOX], lambda: 7, chunks=4)
        return 7
    with pytest.raises(CommitConflict):
        load_chunks(one, boxes(spark, 100, "one"), [BOX], meanwhile, chunks=4)
    got = labels(two.read("box"))
    assert sorted(got) == list(range(100)) and set(got.values()) == {"one", "two"}     # the first range entered counts


def test_a_live_source_converges(spark):
    """Ranges are read at rising positions while the source changes; the feed from the lowest on makes one state of them."""
    table = {i: "old" for i in range(200)}
    feed, now = [], [10]

    def change():
        """Before each range is read: every 20th row changes, one goes and one comes."""
        now[0] += 10
        for pk in [k for k in table if k % 20 == 3]:
            table[pk] = f"at {now[0]}"
            feed.append(line(pk, now[0] - 3, label=table[pk]))
        gone, new = max(table), min(table) - 1
        del table[gone]
        table[new] = "new"
        feed.append(line(gone, now[0] - 2, action="D"))
        feed.append(line(new, now[0] - 1, action="I", label="new"))
        return now[0]

    class Live:
        schema = boxes(spark, 1, "")["box"].schema

        def where(self, condition):
            return spark.createDataFrame([(k, v, 1) for k, v in table.items()], self.schema).where(condition)

        def select(self, *cols):
            return spark.createDataFrame([(k, v, 1) for k, v in table.items()], self.schema).select(*cols)

    store = empty_store(spark)
    rec = load_chunks(store, {"box": Live()}, [BOX], change, chunks=4)
    assert rec["snapshot"]["lsn"] == 20 and rec["covered"] == 20
    assert store.read("box").select(ROW_LSN).distinct().count() == 4
    path = fresh_dir(spark, "t-land")
    land(spark, path, *feed)
    run_stream(spark, path, store, [BOX])
    assert labels(store.read("box").where("deleted_at is null")) == table


@pytest.mark.parametrize("kind", ["string", "timestamp", "double", "decimal(20,2)", "date"])
def test_ranges_hold_every_key_once(spark, kind):
    values = {"string": F.concat(F.lit("é'k"), F.col("i")), "timestamp": F.timestamp_micros(F.col("i") * 1234567),
              "date": F.date_add(F.lit("2020-01-01"), F.col("i").cast("int"))}
    keys = spark.range(300).select(F.col("id").alias("i")).select(values.get(kind, F.col("i") / 7).cast(kind).alias("k"))
    keys = keys.unionByName(spark.sql(f"SELECT CAST(NULL AS {kind}) AS k"))
    cuts = key_cuts(keys, "k", 6)
    ranges = [keys.where(in_range(F.col("k"), kind, cuts, i)) for i in range(len(cuts) + 1)]
    sizes = [r.count() for r in ranges]
    assert len(cuts) == 5 and sum(sizes) == 301 and min(sizes) >= 25
    assert ranges[0].where("k is null").count() == 1
    both = ranges[0]
    for r in ranges[1:]:
        both = both.unionByName(r)
    assert both.exceptAll(keys).isEmpty() and keys.exceptAll(both).isEmpty()


def test_few_rows_equal_keys_and_none(spark):
    store = empty_store(spark)
    two = TableSpec("two", "id", (("id", "string"), ("label", "string")))
    none = spark.createDataFrame([], "id string, label string, extra int")
    rec = load_chunks(store, boxes(spark, 2, "x") | {"two": none}, [BOX, two], 3, chunks=8)
    assert rec["snapshot"]["counts"] == {"box": 2, "two": 0}
    assert labels(store.read("box")) == {0: "x", 1: "x"} and store.read("two").count() == 0
    with pytest.raises(ValueError, match="binary"):
        key_cuts(spark.createDataFrame([(b"k",)], "id binary"), "id", 2)


def test_a_range_is_a_filter_of_the_scan(spark):
    path = fresh_dir(spark, "t-source")
    boxes(spark, 1000, "x")["box"].write.parquet(path)
    source = spark.read.parquet(path)
    plan = source.where(in_range(F.col("id"), "bigint", key_cuts(source, "id", 4), 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id," in plan and "LessThan(id," in plan
