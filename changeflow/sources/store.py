"""Versioned target: co-bucketed layers merged on read without a shuffle, and atomic commits.

Layout under ``root`` (any Hadoop file system, e.g. the cluster's shared folder)::

    data/<table>/<attempt>/part-*_<bucket>.parquet   rows of one write, bucketed and sorted by key
    data/<table>/<attempt>/part-*.parquet            rows of a small write, in few files
    rejects/attempt=<attempt>/part-*.parquet         records a batch could not apply
    _versions/<n>.json                               commit record of version n

A table is a list of layers: a base (snapshot or compaction) and the deltas of later
batches, all in target layout. A batch only appends a delta of its own coalesced rows, so
what it writes follows the batch and not the table; reading merges the layers by key
(:func:`fold.merge_states`). Layers are bucketed Spark tables with equal buckets, so a bucket's
files of all layers meet in one task and the merge moves nothing; only small deltas (fewer than ``small``
rows a bucket, written in few files) are dealt to the buckets when read. Lookups open the buckets
of their keys.

A batch merges deltas with deltas only, when ``compact_after`` have gathered, and leaves those alone that
outweigh all later ones. Rewriting the base is left to :meth:`compact` (``force``) and
:meth:`maintain`, run outside the stream, also by another process; both merge bucket by bucket.

Every layer remembers its buckets, its columns with their types, and the state of the registry it was
written under. A column tracked (again) since then is NULL in that layer at the row's position, without
rewriting a file; a column whose type changed is cast, NULL where that fails.

A commit record is written to a temporary name and renamed without overwriting: a version
exists iff its record does, and a record that cannot be read is damage, not a dead writer. A commit reads
the head once and derives record and number from it; if the number was taken meanwhile, it starts again from
the new head. What one commit adds (a delta, a column list) is valid on any head, so no update is lost.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from changeflow.operators import fold as fo
from changeflow.specs import DELETED_AT, FIELD_LSN_PREFIX, FIELD_SEQ_PREFIX, ROW_LSN, TableSpec

RETRIES = 50
REJECTS_DDL = "`table` string, lsn bigint, seq bigint, action string, reason string, record string"
HISTORY_DDL = ("version int, committed_at string, batch_id bigint, stream string, applied_lsn bigint, "
               "meta struct<read: bigint, written: bigint, rejected: bigint, skipped: bigint, max_lsn: bigint, "
               "first_commit: string, last_commit: string, seconds: double>, rejects string")


class CommitConflict(RuntimeError):
    pass


class DamagedRecord(RuntimeError):
    pass


def typed_fields(spec: TableSpec, columns=None) -> list[list[str]]:
    """[name, type] of a spec's columns without the key."""
    return [[c, t] for c, t in spec.columns if c != spec.pk and (columns is None or c in set(columns))]


class VersionedStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, compact_after: int = 16, rebase: int = 4, small: int = 1000):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.compact_after = compact_after
        self.rebase = rebase
        self.small = small
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._latest: int | None = None      # newest version known to exist

    # ------------------------------------------------------------ file system
    def _fs(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def _versions_dir(self) -> str:
        return f"{self.root}/_versions"

    def versions(self) -> list[int]:
        fs, p = self._fs(self._versions_dir())
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _record_path(self, version: int) -> str:
        return f"{self._versions_dir()}/{version:012d}.json"

    def latest_version(self) -> int | None:
        """Newest committed version. One listing on first use, then probing forward
        from the last known version, so the cost does not grow with history."""
        if self._latest is None:
            vs = self.versions()
            self._latest = vs[-1] if vs else None
            if self._latest is None:
                return None
        while True:
            fs, p = self._fs(self._record_path(self._latest + 1))
            if not fs.exists(p):
                return self._latest
            self._latest += 1

    def record(self, version: int | None = None) -> dict | None:
        """The record of a version, the latest by default; None if there is none. One that is there but cannot be
        read is an error: to build on an older version would drop what it committed."""
        v = self.latest_version() if version is None else version
        return None if v is None else self._load(v)

    def _load(self, version: int) -> dict | None:
        fs, p = self._fs(self._record_path(version))
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError as e:
            raise DamagedRecord(f"{self._record_path(version)} cannot be read; restore it or remove it knowingly") from e

    def _publish(self, version: int, rec: dict) -> None:
        path = self._record_path(version)
        fs, tmp = self._fs(f"{self._versions_dir()}/_{uuid.uuid4().hex}.tmp")
        out = fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(rec, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        to = self._jvm.org.apache.hadoop.fs.Path(path)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        kind = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = kind.getEnumConstants()[0]                         # NONE: fail if the name is taken
        try:
            context.rename(fs.makeQualified(tmp), fs.makeQualified(to), how)
        except Exception as e:  # noqa: BLE001 - FileAlreadyExistsException via py4j
            if not fs.exists(to):
                raise
            raise CommitConflict(f"version {version} already committed") from e
        self._latest = version if self._latest is None else max(self._latest, version)

    def commit(self, change) -> dict | None:
        """Publish ``change(head)`` (the head's record, changed; None: nothing to do) as the next version.
        One head is read per attempt; after a conflict the change is made anew on the new head."""
        for _ in range(RETRIES):
            latest = self.latest_version()
            head = self.record() or {}
            rec = change(json.loads(json.dumps(head)))
            if rec is None:
                return None
            rec["version"] = 0 if latest is None else latest + 1
            rec["committed_at"] = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime()) + f".{time.time_ns() // 1000 % 1_000_000:06d}+00:00"
            try:
                self._publish(rec["version"], rec)
                return rec
            except CommitConflict:
                continue
        raise CommitConflict(f"no free version after {RETRIES} attempts")

    # ------------------------------------------------------------ registry
    def table(self, name: str, version: int | None = None) -> dict | None:
        return ((self.record(version) or {}).get("tables") or {}).get(name)

    def tracked(self, table: str) -> list[str] | None:
        t = self.table(table)
        return t["columns"] if t else None

    def spec(self, table: str, rec: dict | None = None) -> TableSpec | None:
        """The tracked columns with their types, as the registry has them now (or in a record)."""
        t = self.table(table) if rec is None else (rec.get("tables") or {}).get(table)
        if t is None:
            return None
        types = dict(map(tuple, t["fields"])) | {t["pk"]: t["pk_type"]}
        return TableSpec(table, t["pk"], tuple((c, types[c]) for c in t["columns"]))

    def _new_table(self, spec: TableSpec) -> dict:
        return {"pk": spec.pk, "pk_type": spec.spark_type(spec.pk).simpleString(), "fields": typed_fields(spec),
                "columns": spec.column_names, "base": None, "deltas": [], "syncs": 0, "epochs": {}}

    def register(self, specs) -> None:
        """Seed the registry with tables it does not know yet."""
        def change(rec):
            tables = rec.setdefault("tables", {})
            new = [s for s in specs if s.name not in tables]
            for s in new:
                tables[s.name] = self._new_table(s)
            return rec | {"meta": {}, "batch_id": None, "rejects": None} if new else None
        self.commit(change)

    # ------------------------------------------------------------ reads
    def _stored(self, layer: dict, t: dict) -> DataFrame:
        """A layer as it was written: a bucketed table, registered in this session's catalog when first read."""
        types = dict(map(tuple, layer["fields"])) | {DELETED_AT: "timestamp"}
        every = [c for c, _ in layer["fields"]] + [DELETED_AT]
        ddl = ", ".join([f"pk {t['pk_type']}", *[f"`{c}` {types[c]}" for c in every], f"{ROW_LSN} bigint",
                         *[f"`{p}{c}` bigint" for p in (FIELD_LSN_PREFIX, FIELD_SEQ_PREFIX) for c in every]])
        if not layer["buckets"]:
            return self.spark.read.schema(ddl).parquet(layer["path"])
        name = self._catalog_name(layer["path"])
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet CLUSTERED BY (pk) SORTED BY (pk) "
                       f"INTO {layer['buckets']} BUCKETS LOCATION '{layer['path']}'")
        return self.spark.table(name)

    @staticmethod
    def _catalog_name(path: str) -> str:
        return "changeflow_layer_" + path.rsplit("/", 1)[-1]

    def _layer(self, layer: dict, t: dict) -> DataFrame:
        """A layer in the layout of all the table's fields."""
        df = self._stored(layer, t)
        have = dict(map(tuple, layer["fields"]))
        for c, ddl in t["fields"]:
            if layer["sync"] < t["epochs"].get(c, 0):
                # tracked (again) after this layer: NULL at the row's place
                df = (df.withColumn(c, F.lit(None).cast(ddl)).withColumn(FIELD_LSN_PREFIX + c, F.col(ROW_LSN))
                      .withColumn(FIELD_SEQ_PREFIX + c, F.lit(fo.LAST_SEQ)))
            elif c not in have:                                     # known but not tracked then: not set here
                df = (df.withColumn(c, F.lit(None).cast(ddl)).withColumn(FIELD_LSN_PREFIX + c, F.lit(None).cast("bigint"))
                      .withColumn(FIELD_SEQ_PREFIX + c, F.lit(None).cast("bigint")))
            elif have[c] != ddl:
                df = df.withColumn(c, F.col(c).try_cast(ddl))
        return df

    def _state(self, t: dict, layers: list[dict], keys=None) -> DataFrame:
        """The layers merged, all stored fields; with ``keys`` only these, from their buckets."""
        fields = [c for c, _ in t["fields"]]
        cols = fo.target_columns(fields)
        buckets = max([x["buckets"] for x in layers], default=0)
        parts = []
        for layer in layers:
            df = self._layer(layer, t)
            if keys is not None:
                df = df.where(F.col("pk").isin(list(keys)))
            if buckets and not layer["buckets"] and len(layers) > 1:
                df = df.repartition(buckets, "pk")                  # a small delta joins the buckets of the others
            # Spark 4.1 puts equal buckets together in a union of rows, but not in one of column batches although it
            # plans it as if: a filter (every row has a position) makes rows of the scanned batches
            parts.append(df.where(F.col(ROW_LSN).isNotNull()).select(*cols))
        if not parts:
            schema = ", ".join([f"pk {t['pk_type']}", *[f"`{c}` {d}" for c, d in t["fields"]], f"{DELETED_AT} timestamp", f"{ROW_LSN} bigint",
                                *[f"`{p}{c}` bigint" for p in (FIELD_LSN_PREFIX, FIELD_SEQ_PREFIX) for c in [*fields, DELETED_AT]]])
            return self.spark.createDataFrame([], schema).select(*cols)
        df = parts[0]
        for p in parts[1:]:
            df = df.unionByName(p)
        return fo.merge_states(df, fields) if len(parts) > 1 else df

    @staticmethod
    def _layers(t: dict) -> list[dict]:
        return ([t["base"]] if t["base"] else []) + t["deltas"]

    def read(self, table: str, version: int | None = None) -> DataFrame | None:
        """State of ``table`` at a version (latest by default), tracked columns and their places."""
        t = self.table(table, version)
        if t is None:
            return None
        view = [c for c in t["columns"] if c != t["pk"]]
        return self._state(t, self._layers(t)).select(*fo.target_columns(view))

    def lookup(self, table: str, keys) -> DataFrame:
        """The rows of some keys; only their buckets are opened."""
        t = self.table(table)
        view = [c for c in t["columns"] if c != t["pk"]]
        return self._state(t, self._layers(t), list(keys)).select(*fo.target_columns(view))

    def batch_of(self, stream: str) -> int:
        """The last batch of a stream that was committed, -1 if none."""
        return ((self.record() or {}).get("streams") or {}).get(stream, -1)

    # ------------------------------------------------------------ writes
    def _write(self, table: str, state: DataFrame, fields: list, sync: int, at_most: int | None = None, dealt: bool = False) -> dict:
        """Write rows as a new layer: a folder per attempt, read only if a commit record names it. ``at_most``
        rows that are too few for the buckets go into few files; ``dealt``: the rows lie by bucket already."""
        path = f"{self.root}/data/{table}/{uuid.uuid4().hex}"
        buckets = 0 if at_most is not None and at_most < self.small * self.buckets else self.buckets
        rows = Observation()
        out = state.select(*fo.target_columns([c for c, _ in fields]))
        if buckets:
            out = (out if dealt else out.repartition(buckets, "pk")).observe(rows, F.count(F.lit(1)).alias("rows"))
            out.write.format("parquet").bucketBy(buckets, "pk").sortBy("pk").option("path", path).saveAsTable(self._catalog_name(path))
        else:
            out = out.repartition(max(1, -(-at_most // (self.small * 16)))).observe(rows, F.count(F.lit(1)).alias("rows"))
            out.write.parquet(path)
        return {"path": path, "buckets": buckets, "fields": [list(x) for x in fields], "rows": rows.get["rows"], "sync": sync}

    def replace(self, states: dict, specs, meta: dict | None = None) -> dict:
        """Write whole tables as a new version (snapshot load): ``states`` maps names to DataFrames in target
        layout. Their counts go into the record; tables not named stay."""
        return self.adopt({s.name: self._write(s.name, states[s.name], typed_fields(s), 0) for s in specs}, specs, meta)

    def adopt(self, layers: dict, specs, meta: dict | None = None) -> dict:
        """Make layers that are written the whole of their tables, in a new version; a load in chunks ends with it."""
        def change(rec):
            tables = rec.setdefault("tables", {})
            for s in specs:
                tables[s.name] = self._new_table(s) | {"base": layers[s.name]}
            rec |= {"meta": {}, "batch_id": None, "rejects": None}
            rec.pop("loading", None)
            if meta and "snapshot" in meta:
                rec["snapshot"] = meta["snapshot"] | {"counts": {n: x["rows"] for n, x in layers.items()}}
                rec["applied_lsn"] = max([x for x in (rec.get("applied_lsn"), meta["snapshot"]["lsn"]) if x is not None], default=None)
                rec["covered"] = max([x for x in (rec.get("covered"), meta["snapshot"]["lsn"]) if x is not None], default=None)
            return rec
        return self.commit(change)

    def apply_batch(self, stream: str, batch_id: int, folded: dict, meta: dict, rejects: DataFrame | None = None,
                    drift: dict | None = None, mode: str = "field", syncs: dict | None = None, covered: int | None = None) -> dict | None:
        """Append a batch's coalesced rows as deltas; a batch of ``stream`` that is committed already is skipped.

        ``folded``: name -> (coalesced ops, fields). ``syncs``: the state of the registry they were made
        under, by table (now, by default). ``covered``: the position up to which the feed is applied without a gap.
        ``mode="row"`` depends on arrival order, so it reads the table, applies the row guard and writes a new base.
        """
        if batch_id <= self.batch_of(stream):
            return None                                             # replay of a committed batch
        head = self.record() or {}
        bad = None
        if rejects is not None and meta.get("rejected"):
            bad = uuid.uuid4().hex
            rejects.write.parquet(f"{self.root}/rejects/attempt={bad}")
        done = {"rejects": bad, "drift": drift, "covered": covered}
        if mode == "row":
            return self._apply_rows(stream, batch_id, folded, meta, done)
        layers = {}
        for n, (ops, fields) in folded.items():
            t = head["tables"][n]
            typed = [x for x in t["fields"] if x[0] in set(fields)]
            layers[n] = self._write(n, fo.coalesce_to_target(ops, [c for c, _ in typed]), typed,
                                    t["syncs"] if syncs is None else syncs[n], meta.get("written"))

        def change(rec):
            if batch_id <= (rec.get("streams") or {}).get(stream, -1):
                return None
            for n, layer in layers.items():
                if layer["rows"]:
                    rec["tables"][n]["deltas"].append(layer)
            return self._advance(rec, stream, batch_id, meta, done)
        rec = self.commit(change)
        for n in layers:
            self.compact(n)
        return rec

    def _advance(self, rec: dict, stream: str, batch_id: int, meta: dict, done: dict) -> dict:
        rec.setdefault("streams", {})[stream] = batch_id
        rec["covered"] = max([x for x in (rec.get("covered"), done["covered"]) if x is not None], default=None)
        rec["applied_lsn"] = max([x for x in (rec.get("applied_lsn"), meta.get("max_lsn")) if x is not None], default=None)
        return rec | {"meta": meta, "batch_id": batch_id, "stream": stream, "rejects": done["rejects"], "drift": self._drifted(rec, done["drift"])}

    @staticmethod
    def _drifted(rec: dict, drift: dict | None) -> dict:
        """Unregistered columns seen so far, each with its first position: reported once."""
        seen = rec.get("drift") or {}
        for table, cols in (drift or {}).items():
            old = seen.get(table, {})
            seen[table] = old | {c: min(lsn, old.get(c, lsn)) for c, lsn in cols.items()}
        return seen

    def _apply_rows(self, stream, batch_id, folded, meta, done):
        for _ in range(RETRIES):
            head = self.record() or {}
            layers = {}
            for n, (ops, fields) in folded.items():
                t = head["tables"][n]
                stored = [c for c, _ in t["fields"]]
                if sorted(stored) != sorted(fields):
                    raise ValueError(f"{n}: the row guard needs all stored columns tracked")
                layers[n] = self._write(n, fo.apply(self._state(t, self._layers(t)), ops, stored, mode="row"), t["fields"], t["syncs"])

            def change(rec):
                if batch_id <= (rec.get("streams") or {}).get(stream, -1):
                    return None
                if rec.get("version") != head.get("version"):
                    raise CommitConflict("the table changed")       # the merge is stale: start again
                for n, layer in layers.items():
                    rec["tables"][n] |= {"base": layer, "deltas": []}
                return self._advance(rec, stream, batch_id, meta, done)
            try:
                return self.commit(change)
            except CommitConflict:
                continue
        raise CommitConflict("the table kept changing")

    def compact(self, table: str, force: bool = False) -> dict | None:
        """Merge the youngest deltas into one, those aside that outweigh all younger ones; with ``force`` all
        layers into a new base. Deltas committed meanwhile are kept behind it."""
        t = self.table(table)
        if t is None or not t["deltas"] or (len(t["deltas"]) < self.compact_after and not force):
            return None
        if force:
            old = self._layers(t)
        else:
            sizes = [x["rows"] for x in t["deltas"]]
            keep = next(i for i in range(len(sizes)) if sizes[i] <= sum(sizes[i + 1:]) or i == len(sizes) - 1)
            old = t["deltas"][keep:]
            if len(old) < 2:
                return None
        rows = sum(x["rows"] for x in old)
        # rows that are merged over equal buckets lie by bucket: they are written where they are
        dealt = len(old) > 1 and max(x["buckets"] for x in old) == self.buckets
        dealt = dealt and all(x["buckets"] in (0, self.buckets) for x in old)
        layer = self._write(table, self._state(t, old), t["fields"], t["syncs"], None if force else rows, dealt)
        paths = {x["path"] for x in old}

        def change(rec):
            now = rec["tables"][table]
            if not paths <= {x["path"] for x in self._layers(now)}:
                return None                                         # replaced meanwhile
            before, rest = [], []
            for x in now["deltas"]:
                if x["path"] not in paths:
                    (before if x["path"] in {y["path"] for y in t["deltas"]} else rest).append(x)
            now |= {"base": layer, "deltas": rest} if force else {"deltas": [*before, layer, *rest]}
            return rec | {"meta": {}, "batch_id": None, "rejects": None}
        return self.commit(change)

    def maintain(self) -> list[str]:
        """Rewrite the base of every table whose deltas hold ``1 / rebase`` of its rows: to be run beside the
        streams, by any process; returns the names."""
        done = []
        for name, t in ((self.record() or {}).get("tables") or {}).items():
            gathered = sum(x["rows"] for x in t["deltas"])
            if gathered and (t["base"] is None or gathered * self.rebase >= t["base"]["rows"]) and self.compact(name, force=True):
                done.append(name)
        return done

    def sync_columns(self, live: TableSpec) -> dict | None:
        """Set the tracked columns of a table to ``live``'s: the registry alone changes. Columns tracked newly or
        again are NULL for rows stored so far; columns no longer tracked leave the view and stay stored; a column of
        another type is read as that from now on. The key's type cannot change."""
        def change(rec):
            t = (rec.get("tables") or {}).get(live.name)
            if t is None:
                raise ValueError(f"{live.name}: not registered; load a snapshot or register it first")
            if live.pk != t["pk"] or live.spark_type(live.pk).simpleString() != t["pk_type"]:
                raise ValueError(f"{live.name}: the key is {t['pk']} {t['pk_type']} and cannot change")
            types, wanted = dict(map(tuple, t["fields"])), dict(map(tuple, typed_fields(live)))
            if t["columns"] == live.column_names and all(types[c] == d for c, d in wanted.items()):
                return None
            t["syncs"] += 1
            for c in wanted:
                if c not in t["columns"]:
                    t["epochs"][c] = t["syncs"]
            t["fields"] = [[c, wanted.get(c, d)] for c, d in t["fields"]] + [[c, d] for c, d in wanted.items() if c not in types]
            t["columns"] = live.column_names
            return rec | {"meta": {}, "batch_id": None, "rejects": None}
        return self.commit(change)

    # ------------------------------------------------------------ maintenance and reports
    def unreferenced(self, keep_last: int = 1, older_than_s: float = 86_400) -> list[str]:
        """Folders of layers that none of the last ``keep_last`` versions reads and that are older than an age
        no running write or read reaches."""
        latest = self.latest_version()
        if latest is None:
            return []
        records = [self.record(v) or {} for v in range(max(0, latest - keep_last + 1), latest + 1)]
        used = {x["path"] for rec in records for t in (rec.get("tables") or {}).values() for x in self._layers(t)}
        used |= {x["path"] for rec in records for t in (rec.get("loading") or {"tables": {}})["tables"].values()
                 for x in [*t["parts"].values(), *([t["base"]] if t["base"] else [])]}     # a load under way
        names = {u.rsplit("/", 2)[-2] + "/" + u.rsplit("/", 1)[-1] for u in used}
        fs, data = self._fs(f"{self.root}/data")
        out, limit = [], (time.time() - older_than_s) * 1000
        for tdir in fs.listStatus(data) if fs.exists(data) else []:
            name = tdir.getPath().getName()
            for st in fs.listStatus(tdir.getPath()):
                if f"{name}/{st.getPath().getName()}" not in names and st.getModificationTime() <= limit:
                    out.append(f"{self.root}/data/{name}/{st.getPath().getName()}")
        return sorted(out)

    def vacuum(self, keep_last: int = 1, dry_run: bool = True, older_than_s: float = 86_400) -> list[str]:
        """Remove folders no recent version reads (time travel to older versions is lost for them).
        ``dry_run`` only lists them."""
        paths = self.unreferenced(keep_last, older_than_s)
        if not dry_run:
            for p in paths:
                fs, hp = self._fs(p)
                self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(p)}")
                fs.delete(hp, True)
        return paths

    def history(self) -> DataFrame:
        """One row per committed version, read by Spark from the records."""
        if not self.versions():
            return self.spark.createDataFrame([], HISTORY_DDL)
        return self.spark.read.schema(HISTORY_DDL).json(f"{self._versions_dir()}/*.json")

    def progress(self) -> DataFrame:
        """T-13, A5: batches, records read, written, rejected and skipped, rates over the time at work, the applied
        position, and the lags of the last batch: apply behind commit time (A11), and of its last change behind
        the newest change seen by any batch (F12)."""
        from changeflow.functions import event_lag_seconds, parse_ts, rate
        h = self.history().where("batch_id is not null").withColumn("last", parse_ts(F.col("meta.last_commit")))
        total = h.agg(F.count(F.lit(1)).alias("batches"), *[F.sum("meta." + c).alias(c) for c in ("read", "written", "rejected", "skipped")],
                      F.sum("meta.seconds").alias("seconds"), F.max("applied_lsn").alias("applied_lsn"), F.max("last").alias("newest"),
                      F.max_by(F.struct("committed_at", "last"), "version").alias("x"))
        applied = parse_ts(F.col("x.committed_at"))
        return total.select("batches", "read", "written", "rejected", "skipped", rate(F.col("read"), F.col("seconds")).alias("read_per_s"),
                            rate(F.col("written"), F.col("seconds")).alias("written_per_s"), "applied_lsn",
                            event_lag_seconds(F.col("newest"), F.col("x.last")).alias("read_lag_s"),
                            event_lag_seconds(applied, F.col("x.last")).alias("apply_lag_s"))

    def rejects(self) -> DataFrame:
        """The records that could not be applied, of all committed batches."""
        named = self.history().where("rejects is not null").select(F.col("rejects").alias("attempt"))
        fs, p = self._fs(f"{self.root}/rejects")
        if not fs.exists(p):
            return self.spark.createDataFrame([], REJECTS_DDL)
        found = self.spark.read.schema(REJECTS_DDL + ", attempt string").parquet(f"{self.root}/rejects")
        return found.join(named, "attempt", "left_semi").drop("attempt")

    def drift(self) -> DataFrame:
        """T-8: (table, column, first_lsn), once for each unregistered column the stream met."""
        rows = [(t, c, lsn) for t, cols in ((self.record() or {}).get("drift") or {}).items() for c, lsn in cols.items()]
        return self.spark.createDataFrame(rows, "`table` string, column string, first_lsn bigint")
