"""The change log: landings, gaps, restarts by position, files opened."""

import pytest
from pyspark.errors import StreamingQueryException
from test_store import BOX, labels, line

from changeflow.session import fresh_dir
from changeflow.sources.log import ChangeLog
from changeflow.sources.store import VersionedStore
from changeflow.streaming.stream import initialise, run_log


@pytest.fixture
def log(spark):
    return ChangeLog(spark, fresh_dir(spark, "t-log"))


def texts(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def store_of(spark):
    store = VersionedStore(spark, fresh_dir(spark, "t-store"), buckets=4)
    store.register([BOX])
    return store


def gaps(log, position=0):
    return sorted(tuple(r) for r in log.gaps(position).collect())


def test_landings_follow_each_other(spark, log):
    assert log.end() is None and log.reaches(0) and gaps(log) == []
    assert log.append(texts(spark, line(1, 5, label="a"), line(2, 9, label="b"))) == 9
    assert log.append(texts(spark, line(3, 12, label="c")), upto=20) == 20
    assert log.append(texts(spark), upto=25) == 25 and log.append(texts(spark)) == 25     # nothing happened in between; nothing landed
    assert sorted((r["after"], r["upto"], r["records"]) for r in log.landings().collect()) == [(0, 9, 2), (9, 20, 1), (20, 25, 0)]
    assert log.reaches(0) and log.reaches(14) and log.reaches(25) and not log.reaches(None)


def test_a_large_feed_becomes_bounded_landings(spark, log):
    log.append(texts(spark, *[line(i, i, label=str(i)) for i in range(1, 101)], "{broken"), records=30)
    rows = sorted((r["after"], r["upto"], r["records"]) for r in log.landings().collect())
    assert len(rows) == 4 and max(r[2] for r in rows) <= 31 and sum(r[2] for r in rows) == 101
    assert [r[0] for r in rows][1:] == [r[1] for r in rows][:-1] and gaps(log) == []
    store = store_of(spark)
    run_log(spark, log, store, [BOX], landings_per_trigger=1)
    p = store.progress().first()
    assert (p["batches"], p["read"], p["written"], p["rejected"]) == (4, 101, 100, 1)
    assert labels(store.read("box")) == {i: str(i) for i in range(1, 101)} and store.record()["covered"] == 100


def test_a_gap_stops_the_stream_and_a_new_snapshot_goes_on(spark, log):
    store = store_of(spark)
    source = lambda *rows: {"box": spark.createDataFrame(list(rows), "id long, label string, size int")}
    assert initialise(store, source((1, "snap", 1)), [BOX], 3, log)
    log.append(texts(spark, line(1, 5, label="five")), after=0, upto=9)
    assert not initialise(store, source((1, "unused", 1)), [BOX], 3, log)
    ckpt = fresh_dir(spark, "t-ckpt")
    run_log(spark, log, store, [BOX], checkpoint=ckpt)
    log.append(texts(spark, line(1, 25, label="beyond")), after=20, upto=30)              # 10 to 20 never landed
    assert gaps(log) == [(9, 20)] == gaps(log, 5) and not log.reaches(9) and log.reaches(20)
    with pytest.raises(StreamingQueryException, match="lacks the changes after position 9 up to 20"):
        run_log(spark, log, store, [BOX], checkpoint=ckpt)
    assert labels(store.read("box")) == {1: "five"} and store.record()["covered"] == 9    # nothing beyond was applied
    assert initialise(store, source((1, "again", 1), (2, "new", 2)), [BOX], 22, log)      # redone at 22
    run_log(spark, log, store, [BOX], checkpoint=ckpt)
    assert labels(store.read("box")) == {1: "beyond", 2: "new"} and not initialise(store, source(), [BOX], 30, log)


def test_a_landing_repeated_or_overlapping_is_no_gap(spark, log):
    for after, upto in ((0, 10), (10, 20), (0, 10), (5, 30), (30, 40)):
        log.append(texts(spark, line(1, upto, label=str(upto))), after=after, upto=upto)
    assert gaps(log) == [] and gaps(log, 12) == []


def test_a_lost_checkpoint_goes_on_by_position(spark, log, monkeypatch):
    store = store_of(spark)
    log.append(texts(spark, line(1, 5, label="five"), line(2, 6, label="six")))
    run_log(spark, log, store, [BOX])
    log.append(texts(spark, line(2, 8, label="eight")))
    opened = []
    read = log.read
    monkeypatch.setattr(log, "read", lambda files, position=0: opened.append(len(files)) or read(files, position))
    run_log(spark, log, store, [BOX])                                                     # a new checkpoint
    assert opened == [1] and store.progress().first()["read"] == 3
    assert labels(store.read("box")) == {1: "five", 2: "eight"}


def test_only_files_of_registered_tables_are_opened(spark, log):
    log.append(texts(spark, line(1, 5, label="mine"), line(1, 6, table="other", label="x"), line(1, 7, action="B"), "{broken", line(4, 8, table=None)))
    files = log.files(["box"]).collect()
    assert sorted((r["table"] or "", r["records"]) for r in files) == [("", 2), ("box", 1)]
    assert log.files(["box"], 7).count() == 1 and log.files(["box"], 8).count() == 0
    store = store_of(spark)
    run_log(spark, log, store, [BOX])
    p = store.progress().first()
    assert (p["read"], p["written"], p["rejected"]) == (3, 1, 2) and labels(store.read("box")) == {1: "mine"}
