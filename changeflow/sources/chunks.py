"""Snapshots taken in chunks of keys, each committed by itself, so that a load goes on where it ended (S2, S6, T-7).

A table is cut into ranges of its key. Each range is read (the range reaches the scan as a filter on the key), stamped
with the position at which it was read, written as a layer and entered in the store's commit record, the ledger: under
``loading``, so no reader sees it yet and :meth:`VersionedStore.vacuum` leaves it alone. A load that was ended, by whatever,
reads the ledger and only the ranges that are not in it. When all are there, a table's layers are merged bucket
by bucket, without a shuffle, and one commit makes all tables' snapshots the current version.

``position`` may be a number, for a source that offers one state as long as the load takes (files, an exported
snapshot), or a function, asked before each range is read, for a live source: ranges then carry different positions.
The snapshot counts as taken at the lowest of them; changes after that are applied on top, and in ranges read later
those that the range holds already lose by their position. Once the feed is applied beyond the highest position, the state
is that of a snapshot at one position, but for keys deleted before their range was read, which
are tombstones without values.

Defined cases: rows with a null key are in the first range; an empty table is one empty range; a load of other tables,
columns, types, or from another fixed position starts anew; of two loads at once, the range entered first counts.
The cuts are quantiles of a bounded sample (``SAMPLE`` keys a range, those of the least hashes): they steer the sizes of
ranges only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from changeflow.sources.snapshot import snapshot_state
from changeflow.sources.store import CommitConflict, VersionedStore, typed_fields

SAMPLE = 200


def key_cuts(source: DataFrame, pk: str, chunks: int) -> list[str]:
    """Up to ``chunks - 1`` keys, in order and as text, that cut a table into ranges of about equal size."""
    if isinstance(source.schema[pk].dataType, BinaryType):
        raise ValueError(f"{pk}: ranges of binary keys are not supported")
    keys = source.select(F.col(pk).alias("k")).where("k is not null")
    some = keys.orderBy(F.xxhash64("k"), "k").limit(SAMPLE * chunks).orderBy("k").select(F.col("k").cast("string").alias("k"))
    sample = [r["k"] for r in some.collect()]                       # SAMPLE * chunks keys at most
    return list(dict.fromkeys(sample[len(sample) * i // chunks] for i in range(1, chunks))) if sample else []


def in_range(key: Column, key_type: str, cuts: list[str], i: int) -> Column:
    """Whether a key lies in the i-th of the ``len(cuts) + 1`` ranges."""
    at = [F.lit(c).cast(key_type) for c in cuts[max(0, i - 1):i + 1]]
    if not cuts:
        return F.lit(True)
    if i == 0:
        return key.isNull() | (key < at[0])
    return key >= at[0] if i == len(cuts) else (key >= at[0]) & (key < at[1])


def _begin(store: VersionedStore, sources: dict, specs, fixed: int | None, chunks: int) -> dict:
    """The load in the ledger if it is this one, else a new one."""
    layout = json.loads(json.dumps({s.name: store._new_table(s) for s in specs}))       # as the record holds it
    found = (store.record() or {}).get("loading")
    if found and found["fixed"] == fixed and {n: t["layout"] for n, t in found["tables"].items()} == layout:
        return found
    new = {"id": uuid.uuid4().hex, "fixed": fixed, "tables": {
        s.name: {"layout": layout[s.name], "cuts": key_cuts(sources[s.name], s.pk, chunks), "parts": {}, "base": None} for s in specs}}
    store.commit(lambda rec: rec | {"loading": new, "meta": {}, "batch_id": None, "rejects": None})
    return new


def _enter(store: VersionedStore, load: dict, table: str, change) -> dict:
    """Enter what is done for a table in the ledger; returns the ledger."""
    def commit(rec):
        now = rec.get("loading") or {}
        if now.get("id") != load["id"]:
            raise CommitConflict("another load has begun or ended")
        change(now["tables"][table])
        return rec | {"meta": {}, "batch_id": None, "rejects": None}
    return store.commit(commit)["loading"]


def load_chunks(store: VersionedStore, sources: dict, specs, position, chunks: int = 16) -> dict:
    """Load the snapshot of all tables in ranges of keys and return the record of the version that holds it. Called
    again after it was ended midway, it goes on with the ranges that are missing."""
    at = position if callable(position) else lambda: position
    load = _begin(store, sources, specs, None if callable(position) else position, chunks)
    for spec in specs:
        source = sources[spec.name]
        cuts = load["tables"][spec.name]["cuts"]
        key_type = source.schema[spec.pk].dataType.simpleString()
        for i in range(len(cuts) + 1):
            if str(i) in load["tables"][spec.name]["parts"]:
                continue
            lsn = at()
            rows = source.where(in_range(F.col(spec.pk), key_type, cuts, i))
            layer = store._write(spec.name, snapshot_state(rows, spec, lsn), typed_fields(spec), 0) | {"lsn": lsn}
            load = _enter(store, load, spec.name, lambda t, i=i, layer=layer: t["parts"].setdefault(str(i), layer))
        if load["tables"][spec.name]["base"] is None:
            base = _merged(store, spec.name, load["tables"][spec.name])
            load = _enter(store, load, spec.name, lambda t, base=base: t.update(base=base))
    lowest = min(p["lsn"] for t in load["tables"].values() for p in t["parts"].values())
    return store.adopt({n: t["base"] for n, t in load["tables"].items()}, specs, {"snapshot": {"done": True, "lsn": lowest}})


def _merged(store: VersionedStore, name: str, table: dict) -> dict:
    """One layer of a table's ranges; those of equal buckets stay where they lie."""
    parts = [p for _, p in sorted(table["parts"].items(), key=lambda x: int(x[0]))]
    if len(parts) == 1:
        return parts[0]
    dealt = all(p["buckets"] == store.buckets for p in parts)
    return store._write(name, store._state(table["layout"], parts), table["layout"]["fields"], 0, dealt=dealt)


def load_progress(store: VersionedStore) -> DataFrame:
    """(table, ranges, done, rows) of the load under way; no rows without one."""
    load = (store.record() or {}).get("loading") or {"tables": {}}
    rows = [(n, len(t["cuts"]) + 1, len(t["parts"]), sum(p["rows"] for p in t["parts"].values())) for n, t in load["tables"].items()]
    return store.spark.createDataFrame(rows, "`table` string, ranges int, done int, rows bigint")
