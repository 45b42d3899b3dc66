"""Supervised streams: pauses, restarts, poison records set aside, nothing else lost."""

import pytest
from pyspark.sql import functions as F
from test_store import BOX, labels, land, line, store_of

from changeflow.session import fresh_dir
from changeflow.sources.feed import parse_feed
from changeflow.sources.log import ChangeLog
from changeflow.streaming import supervise as sv
from changeflow.streaming.stream import run_log, run_stream


def strict(*places):
    """A preparation that fails at the given positions."""
    return lambda df: df.withColumn("action", F.when(F.col("lsn").isin(*places), F.raise_error(F.lit("cannot decode"))).otherwise(F.col("action")))


class Versions:
    """Stands for a store whose version the test sets."""
    version = 0

    def latest_version(self):
        return self.version


def test_pauses_double_up_to_the_cap():
    assert [sv.pause(n, 0.5, 3.0) for n in (1, 2, 3, 4, 5, 1000)] == [0.5, 1.0, 2.0, 3.0, 3.0, 3.0]


def test_a_new_version_begins_the_count_anew():
    store, asked, slept = Versions(), [], []

    def start(isolate):
        asked.append(isolate)
        if len(asked) == 3:
            store.version += 1                                  # one batch was applied before this failure
        if len(asked) < 6:
            raise RuntimeError("lost connection")
        return "done"
    assert sv.supervise(store, start, attempts=4, isolate_after=2, first=1.0, sleep=slept.append) == "done"
    assert asked == [False, False, True, False, True, True] and slept == [1.0, 2.0, 1.0, 2.0, 4.0]


def test_it_gives_up_after_the_last_attempt_and_at_once_when_fatal():
    def failing(error, made):
        def start(isolate):
            made.append(isolate)
            raise error
        return start
    made = []
    with pytest.raises(RuntimeError, match="down"):
        sv.supervise(Versions(), failing(RuntimeError("down"), made), attempts=3, sleep=lambda s: None)
    assert len(made) == 3
    made = []
    with pytest.raises(RuntimeError):
        sv.supervise(Versions(), failing(RuntimeError("changeflow.sources.log.FeedGap: lacks"), made), sleep=lambda s: None)
    assert len(made) == 1


def feed_of(spark, *lines):
    return parse_feed(spark.createDataFrame([(x,) for x in lines], "value string")).persist()


def test_poison_is_found_record_by_record(spark):
    batch = feed_of(spark, *[line(i, i, label=str(i)) for i in range(1, 41)], line(7, 7, label="7"), "{broken")
    work = lambda df: strict(7, 30)(df).write.format("noop").mode("overwrite").save()
    found = sv.poisoned(batch, work)
    assert sorted(r["lsn"] for r in sv.poison_rejects(batch, found).collect()) == [7, 7, 30]      # equal copies together
    assert sv.without(batch, found).count() == 39 and all("cannot decode" in c for c in found.values())
    assert sv.poisoned(batch, lambda df: df.count()) == {}
    with pytest.raises(sv.TooManyPoisoned):
        sv.poisoned(batch, work, most=1)


def test_what_fails_as_a_whole_only_is_no_poison(spark):
    batch = feed_of(spark, *[line(i, i, label=str(i)) for i in range(1, 9)])

    def work(df):
        if df.count() > 5:
            raise MemoryError("too large together")
    assert sv.poisoned(batch, work) == {}

    def down(df):
        raise OSError("down")
    with pytest.raises(OSError, match="down"):
        sv.poisoned(batch.where("lsn < 0"), down)


@pytest.mark.parametrize("kind", ["field", "row", "log"])
def test_all_other_records_are_applied(spark, kind):
    lines = [line(i, i, label=str(i)) for i in range(1, 21)]
    store, ckpt = store_of(spark), fresh_dir(spark, "t-ckpt")
    if kind == "log":
        log = ChangeLog(spark, fresh_dir(spark, "t-log"))
        log.append(spark.createDataFrame([(x,) for x in lines], "value string"))
        start = lambda isolate: run_log(spark, log, store, [BOX], checkpoint=ckpt, prepare=strict(4, 20), isolate=isolate)
    else:
        path = fresh_dir(spark, "t-land")
        land(spark, path, *lines)
        start = lambda isolate: run_stream(spark, path, store, [BOX], checkpoint=ckpt, mode=kind, prepare=strict(4, 20), isolate=isolate)
    slept = []
    sv.supervise(store, start, isolate_after=1, first=0.01, sleep=slept.append)
    assert len(slept) == 1 and labels(store.read("box")) == {i: str(i) for i in range(1, 20) if i != 4}
    p = store.progress().first()
    assert (p["read"], p["written"], p["rejected"], p["skipped"]) == (20, 18, 2, 0) and store.record()["applied_lsn"] == 20
    aside = store.rejects().collect()
    assert sorted(r["lsn"] for r in aside) == [4, 20] and all(r["reason"].startswith("poison: ") and "cannot decode" in r["reason"] for r in aside)
    start(False)                                                # nothing is left to do: the batch is committed
    assert store.progress().first()["read"] == 20


def test_preparation_alone_changes_what_is_applied(spark):
    store, path = store_of(spark), fresh_dir(spark, "t-land")
    land(spark, path, line(1, 1, label="keep"), line(2, 2, label="drop", action="X"))
    run_stream(spark, path, store, [BOX], prepare=lambda df: df.withColumn("seq", F.col("seq") + 5))
    assert labels(store.read("box")) == {1: "keep"} and store.progress().first()["skipped"] == 1
