"""Structured Streaming change application (T-1 ... T-12).

``readStream`` (JSON-lines landing folder) -> parse -> ``foreachBatch``: read the registry
from the store's head (T-9), split each table's ops from rejects, coalesce (A1), append the
deltas and commit (S5/S7). The offset log advances only after ``foreachBatch`` returns, i.e.
after the commit (T-3); a re-run batch id that this stream committed already is skipped (T-5);
another stream's ids are its own. No watermark: late and out-of-order changes are resolved by
position, never dropped (T-6). Every record is applied, skipped (not a change, or part of the
snapshot) or rejected, and counted as such.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.functions import backlog, canonical_ts
from changeflow.operators import fold as fo
from changeflow.operators.ops import envelope_rejects, split_staged, stage_ops
from changeflow.operators.registry import feed_columns, live_columns, registry_frame, schema_diff
from changeflow.session import ensure_utc, fresh_dir
from changeflow.sources.chunks import load_chunks
from changeflow.sources.feed import DML_ACTIONS, read_feed_stream
from changeflow.sources.log import ChangeLog, FeedGap
from changeflow.sources.snapshot import snapshot_state
from changeflow.sources.store import VersionedStore
from changeflow.specs import DELETED_AT, FIELD_LSN_PREFIX, FIELD_SEQ_PREFIX, TableSpec
from changeflow.streaming.supervise import poison_rejects, poisoned, without

# A micro-batch is read several times and grows with the feed. Kept in memory first, it fills all that Spark counts on before
# any of it goes to disk, and reading it back takes as much again that is not counted: the heap ran out at large batches.
KEPT = StorageLevel.DISK_ONLY


def batch_metrics(batch: DataFrame, tables: list[str], after: int | None) -> dict:
    """A2, A3, A5: what a batch holds, in one small row: records read, those the envelope rejects, changes to
    apply, the high-water position and the commit times of the first and last change."""
    dml = ~F.col("_corrupt") & F.col("action").isin(*DML_ACTIONS)
    due = dml & F.col("table").isin(tables) & (F.lit(True) if after is None else F.col("lsn") > F.lit(after))
    unknown = F.col("_corrupt") | (dml & ~F.coalesce(F.col("table").isin(tables), F.lit(False)))
    r = batch.agg(F.count(F.lit(1)).alias("read"), F.count_if(unknown).alias("envelope"), F.count_if(due).alias("due"),
                  F.max(F.when(dml, F.col("lsn"))).alias("max_lsn"), canonical_ts(F.min(F.when(due, F.col("commit_ts")))).alias("first_commit"),
                  canonical_ts(F.max_by("commit_ts", F.when(due & F.col("commit_ts").isNotNull(), F.struct("lsn", "seq")))).alias("last_commit")).first()
    return r.asDict()


def batch_drift(batch: DataFrame, registered: dict) -> dict:
    """T-8: unregistered columns of the tables in this batch with their first position; as many rows as columns."""
    known = F.lit(False)
    for table, cols in registered.items():
        known = known | ((F.col("table") == table) & F.col("column").isin(list(cols)))
    new = feed_columns(batch).where(F.col("table").isin(list(registered)) & ~known)
    out: dict = {}
    for r in new.groupBy("table", "column").agg(F.min("lsn").alias("lsn")).collect():
        out.setdefault(r["table"], {})[r["column"]] = r["lsn"]
    return out


def batch_handler(store: VersionedStore, names: list[str], stream: str, mode: str = "field", prepare=None, isolate: bool = False):
    """Apply one micro-batch of parsed changes. ``covered``: the position up to which the feed is then applied.

    ``prepare`` turns parsed records into parsed records, one for one (decoding, masking), before they are applied. With
    ``isolate``, a batch that fails is searched for the records that make it fail (:mod:`supervise`): those become rejects.
    """
    ready = prepare or (lambda records: records)

    def work(records: DataFrame, specs: dict) -> None:
        """What applying does with each record, without writing anything (folding only compares places)."""
        for spec in specs.values():
            stage_ops(ready(records), spec).write.format("noop").mode("overwrite").save()

    def handle(batch: DataFrame, batch_id: int, covered: int | None = None) -> None:
        if batch_id <= store.batch_of(stream):
            return
        ensure_utc(batch.sparkSession)
        rec = store.record() or {}
        specs = {n: store.spec(n, rec) for n in names}
        missing = [n for n, s in specs.items() if s is None]
        if missing:
            raise ValueError(f"not in the registry: {', '.join(missing)}; load a snapshot or register them")
        batch = batch.persist(KEPT)
        try:
            apply(batch, batch_id, covered, rec, specs, {})
        except Exception:
            found = poisoned(batch, lambda records: work(records, specs)) if isolate else {}
            if not found:
                raise
            apply(batch, batch_id, covered, rec, specs, found)
        finally:
            batch.unpersist()

    def apply(records: DataFrame, batch_id: int, covered: int | None, rec: dict, specs: dict, poison: dict) -> None:
        begun = time.time()
        after = (rec.get("snapshot") or {}).get("lsn")
        batch = ready(without(records, poison) if poison else records)
        kept = []
        try:
            if prepare or poison:
                kept.append(batch := batch.persist(KEPT))
            m = batch_metrics(batch, names, after)
            due = batch if after is None else batch.where(F.col("lsn") > F.lit(after))
            folded, rejects, n_bad = {}, envelope_rejects(batch, names), 0
            for name, spec in specs.items():
                staged = stage_ops(due, spec)
                staged = staged.withColumn("_raw", F.when(F.size("_bad") > 0, F.col("_raw"))).persist(KEPT)     # the text of rejects only
                kept.append(staged)
                ops, bad = split_staged(staged, name)
                folded[name] = (fo.coalesce(ops, spec.fields), spec.fields)
                rejects = rejects.unionByName(bad)
                n_bad += staged.where(F.size("_bad") > 0).count()
            n_poison, places = 0, [m["max_lsn"]]
            if poison:
                aside = poison_rejects(records, poison)
                rejects = rejects.unionByName(aside)
                n_poison, high = aside.agg(F.count(F.lit(1)), F.max("lsn")).first()
                places.append(high)
            meta = {"read": m["read"] + n_poison, "rejected": m["envelope"] + n_bad + n_poison, "written": m["due"] - n_bad,
                    "skipped": m["read"] - m["due"] - m["envelope"], "max_lsn": max((x for x in places if x is not None), default=None),
                    "first_commit": m["first_commit"], "last_commit": m["last_commit"], "seconds": time.time() - begun}
            drift = batch_drift(batch, {n: s.column_names for n, s in specs.items()})
            syncs = {n: rec["tables"][n]["syncs"] for n in names}
            store.apply_batch(stream, batch_id, folded, meta, rejects, drift, mode, syncs, covered)
        finally:
            for df in kept:
                df.unpersist()
    return handle


def initialise(store: VersionedStore, sources: dict, specs, l0: int, log: ChangeLog | None = None, chunks: int | None = None) -> bool:
    """T-7: load the snapshot as the first version unless a completed one is recorded and the log, if given,
    still follows on what is applied; if it does not, the snapshot is taken anew (:func:`resnapshot`). With
    ``chunks``, the first one is loaded in ranges of keys and goes on where an ended load stopped. Returns
    True when a snapshot was loaded; its row counts are in the record."""
    rec = store.record() or {}
    snap = rec.get("snapshot") or {}
    if snap.get("done") and snap.get("lsn") is not None:
        if log is None or log.reaches(rec.get("covered")):
            return False
        resnapshot(store, sources, specs, l0)
        return True
    if chunks:
        load_chunks(store, sources, specs, l0, chunks)
        return True
    states = {s.name: snapshot_state(sources[s.name], s, l0) for s in specs}
    store.replace(states, specs, meta={"snapshot": {"done": True, "lsn": l0}})
    return True


def position_valid(store: VersionedStore, oldest: int | None) -> bool:
    """T-7: whether a feed that reaches back to position ``oldest`` still follows on what is applied; if not, the
    changes between are lost and the tables need :func:`resnapshot`."""
    applied = (store.record() or {}).get("applied_lsn")
    return applied is not None and (oldest is None or oldest <= applied + 1)


def resnapshot(store: VersionedStore, sources: dict, specs, l0: int,
               vanished_deleted_at: str | None = None) -> dict:
    """T-7 redo (position lost): replace every table with a fresh snapshot at ``l0``.

    By default keys that vanished from the source since the last state disappear (Q9). With
    ``vanished_deleted_at`` (a UTC timestamp text) they are kept as tombstones instead: live rows whose
    key is absent from the new snapshot get that deletion time at position ``l0``; rows deleted before keep theirs.
    """
    states = {}
    for spec in specs:
        st = snapshot_state(sources[spec.name], spec, l0)
        old = store.read(spec.name)
        if vanished_deleted_at is not None and old is not None:
            alive = F.col(DELETED_AT).isNull()
            gone = old.join(st.select("pk"), "pk", "left_anti")
            gone = (gone.withColumn(FIELD_LSN_PREFIX + DELETED_AT, F.when(alive, F.lit(l0)).otherwise(F.col(FIELD_LSN_PREFIX + DELETED_AT)))
                    .withColumn(FIELD_SEQ_PREFIX + DELETED_AT, F.when(alive, F.lit(fo.LAST_SEQ)).otherwise(F.col(FIELD_SEQ_PREFIX + DELETED_AT)))
                    .withColumn(DELETED_AT, F.coalesce(F.col(DELETED_AT), F.lit(vanished_deleted_at).cast("timestamp"))))
            for c in [c for c in st.columns if c not in gone.columns]:
                gone = gone.withColumn(c, F.lit(None).cast(st.schema[c].dataType))
            st = st.unionByName(gone.select(*st.columns))
        states[spec.name] = st
    return store.replace(states, specs, meta={"snapshot": {"done": True, "lsn": l0}})


def run_stream(spark: SparkSession, feed_path: str, store: VersionedStore, specs,
               checkpoint: str | None = None, max_files_per_trigger: int | None = None,
               available_now: bool = True, processing_time: str = "500 milliseconds",
               mode: str = "field", max_bytes_per_trigger: str | None = None, prepare=None, isolate: bool = False):
    """Start (and for ``available_now`` drain to completion) the change stream. Tables the registry does not know
    are registered first. A batch is bounded by bytes or files (T-2). ``prepare``, ``isolate``: see :func:`batch_handler`."""
    ensure_utc(spark)
    ckpt = checkpoint or fresh_dir(spark, "checkpoint")
    store.register(specs)
    feed = read_feed_stream(spark, feed_path, max_files_per_trigger, max_bytes_per_trigger)
    writer = (feed.writeStream.foreachBatch(batch_handler(store, [s.name for s in specs], ckpt, mode, prepare, isolate))
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def log_handler(log: ChangeLog, store: VersionedStore, names: list[str], stream: str, mode: str = "field", prepare=None, isolate: bool = False):
    """Apply the landings a micro-batch of the manifest names: those not applied yet, in order, from the files
    of the registered tables. A gap stops the stream before anything beyond it is applied."""
    apply = batch_handler(store, names, stream, mode, prepare, isolate)

    def handle(batch: DataFrame, batch_id: int) -> None:
        covered = (store.record() or {}).get("covered") or 0
        due = batch.where(F.col("upto") > F.lit(covered))
        at = covered
        landed = due.where("kind = 'none'").select("after", "upto").collect()    # a row for each landing of the batch
        for after, upto in sorted(map(tuple, landed)):
            if after > at:
                raise FeedGap(at, after)
            at = max(at, upto)
        wanted = due.where((F.col("kind") == "dml") & (F.col("table").isin(names) | F.col("table").isNull()))
        files = [r["file"] for r in wanted.select("file").collect()]             # bounded by the landings of the batch
        apply(log.read(files, covered), batch_id, at)
    return handle


def run_log(spark: SparkSession, log: ChangeLog, store: VersionedStore, specs, checkpoint: str | None = None,
            landings_per_trigger: int | None = None, available_now: bool = True, processing_time: str = "500 milliseconds",
            mode: str = "field", prepare=None, isolate: bool = False):
    """Start (and for ``available_now`` drain) the stream of a change log into the store. It goes on from the position
    the store has applied, also with a new checkpoint; a batch is bounded by landings, those by records (T-2)."""
    ensure_utc(spark)
    ckpt = checkpoint or fresh_dir(spark, "checkpoint")
    store.register(specs)
    writer = (log.stream(landings_per_trigger).writeStream
              .foreachBatch(log_handler(log, store, [s.name for s in specs], ckpt, mode, prepare, isolate)).option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def drain_and_stop(query) -> None:
    """T-12: let a continuously triggered query apply everything already landed,
    then stop it (its checkpoint and the store stay consistent for a restart)."""
    query.processAllAvailable()
    query.stop()


def schema_sync(store: VersionedStore, live: TableSpec, source: DataFrame | None = None) -> DataFrame:
    """T-10 / X1 on the store: align the registry with the live table (``source``'s column metadata, S4, or the
    spec) and return what changed as (table, column, change). The store's files stay as they are; a running
    stream picks the new registry up with its next batch (T-9). With nothing to change no version is written.
    """
    spark = store.spark
    if source is not None:
        names = [r["column"] for r in live_columns(source, live.name).orderBy("ordinal").collect()]
        live = TableSpec(live.name, live.pk, tuple((c, source.schema[c].dataType.simpleString()) for c in names))
    known = store.spec(live.name)
    diff = schema_diff(registry_frame(spark, {live.name: live.column_names}),
                       registry_frame(spark, {live.name: known.column_names if known else []}))
    rows = [tuple(r) for r in diff.collect()]                       # a row for each changed column
    if known:
        types = dict(known.columns)
        rows += [(live.name, c, "retyped") for c in live.column_names
                 if c in types and known.spark_type(c) != live.spark_type(c)]
    store.sync_columns(live)
    return spark.createDataFrame(rows, diff.schema)


def store_status(store: VersionedStore, feed: DataFrame | None = None) -> DataFrame:
    """T-14: applied position, backlog to the feed's head, versions and the rows the snapshot loaded."""
    rec = store.record() or {}
    counts = (rec.get("snapshot") or {}).get("counts") or {}
    base = store.spark.createDataFrame([(rec.get("applied_lsn"), (rec.get("version", -1)) + 1, sum(counts.values()))],
                                       "applied_lsn bigint, versions int, snapshot_rows bigint")
    head = F.lit(None).cast("bigint") if feed is None else feed.agg(F.max("lsn")).scalar()
    return base.withColumn("backlog", backlog(head, F.col("applied_lsn")) if feed is not None else head)
