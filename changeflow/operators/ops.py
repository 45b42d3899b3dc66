"""Change records -> write ops (P5-P8), in wide typed form.

For one table and its tracked columns an op row is::

    pk, lsn, seq, commit_ts, action, is_delete,
    <c>, _p_<c>            for every tracked column c (value, presence)
    deleted_at, _p_deleted_at

Presence is kept apart from the value: a column *set to NULL* (present, value NULL)
is not the same as a column the op does not touch (absent).

* ``I``: every tracked column carried by the record.
* ``U``: tracked columns whose new value differs from the before-image (``identity``);
  a column missing from the before-image counts as changed (P6).
* ``D``: soft delete: only ``deleted_at`` = commit time, else the envelope's
  ingest time, so replays agree (P8).
* anything else: no op (P2).

Everything is a column expression evaluated inside whole-stage codegen; no Python
runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import (
    canonical_of_text, canonical_text, canonical_ts, parse_ts, type_family, typed_from_text, variant_json, variant_text,
)
from changeflow.sources.feed import COLUMN_DDL, dml_filter, fence, pick, table_filter
from changeflow.specs import DELETED_AT, PRESENT_PREFIX, TableSpec

FIELDS_AT_ONCE = 4    # columns a step of :func:`stage_ops` takes: more make methods beyond 8000 bytes, which run uncompiled


def changed(new_entry: Column, old_entry: Column) -> Column:
    """The new column differs from the old image, or is absent from it."""
    return new_entry.isNotNull() & (
        old_entry.isNull()
        | ~variant_json(new_entry["value"]).eqNullSafe(variant_json(old_entry["value"])))


def _at(arr: str, names: str, name: str) -> Column:
    """:func:`feed.pick` with the reversed names at hand: the last entry of that name (NULL if absent)."""
    return F.get(F.col(arr), F.size(F.col(arr)) - F.array_position(F.col(names), name).cast("int"))


def _check_tracked(spec: TableSpec, tracked) -> list[str]:
    tracked = [c for c in (tracked if tracked is not None else spec.column_names)]
    if not tracked:
        raise ValueError(f"registry has no tracked columns for table {spec.name!r}; seed it first")
    return [c for c in spec.column_names if c in set(tracked)]


def stage_ops(feed: DataFrame, spec: TableSpec, tracked=None, revive_on_insert: bool = False) -> DataFrame:
    """Parsed feed -> op rows of one table with the names of columns that do not coerce (``_bad``).

    Steps that each compute a sub-result once: the names of both images, where every tracked column lies and its
    value there, raw text and changed flags, typed values. A step takes ``FIELDS_AT_ONCE`` columns and is
    fenced: its generated method stays small enough for the JVM to compile, also for wide tables.
    """
    tracked = _check_tracked(spec, tracked)
    fields = [c for c in tracked if c != spec.pk]
    f = dml_filter(table_filter(feed.where(~F.col("_corrupt")), [spec.name]))
    base = ["lsn", "seq", "commit_ts", "ingest_ts", "action", "_raw"]

    action = F.col("action")
    is_i, is_u, is_d = action == "I", action == "U", action == "D"
    df = fence(f.select(*base, "columns", "identity", F.reverse(F.col("columns.name")).alias("_nn"),
                        F.reverse(F.col("identity.name")).alias("_on")))
    df = fence(df.select(*base, "columns", "identity", "_nn", "_on", variant_text(F.when(
        is_d, _at("identity", "_on", spec.pk)).otherwise(_at("columns", "_nn", spec.pk))["value"]).alias("_kt")))
    carried = [*base, "_kt"]

    groups = [fields[i:i + FIELDS_AT_ONCE] for i in range(0, len(fields), FIELDS_AT_ONCE)]
    for n, some in enumerate(groups):
        images = [] if n == len(groups) - 1 else ["columns", "identity", "_nn", "_on"]
        # lookups
        looked = fence(df.select(*carried, *images, *[_at("columns", "_nn", c).alias("_n_" + c) for c in some],
                                 *[F.when(is_u, _at("identity", "_on", c)).alias("_o_" + c) for c in some]))
        # raw text + presence
        texts = []
        for c in some:
            new, old = F.col("_n_" + c), F.col("_o_" + c)
            present = (F.when(is_i, new.isNotNull())
                       .when(is_u, changed(new, old))
                       .otherwise(F.lit(False)))
            texts += [present.alias(PRESENT_PREFIX + c), variant_text(new["value"]).alias("_t_" + c)]
        read = fence(looked.select(*carried, *images, *texts))
        # typed values and whether they do not coerce
        typed = []
        for c in some:
            p, t = F.col(PRESENT_PREFIX + c), F.col("_t_" + c)
            typed += [F.when(p, typed_from_text(t, spec.spark_type(c))).alias(c), p,
                      (p & t.isNotNull()).alias("_s_" + c)]
        df = fence(read.select(*carried, *images, *typed))
        carried += [x for c in some for x in (c, PRESENT_PREFIX + c, "_s_" + c)]

    # key, rejects
    pk_val = typed_from_text(F.col("_kt"), spec.spark_type(spec.pk))
    cols = [pk_val.alias("pk"), "lsn", "seq", "commit_ts", "action", is_d.alias("is_delete")]
    bad = [F.when(pk_val.isNull(), F.lit(spec.pk))]
    for c in fields:
        cols += [c, PRESENT_PREFIX + c]
        bad.append(F.when(F.col("_s_" + c) & F.col(c).isNull(), F.lit(c)))
    delete_ts = F.coalesce(F.col("commit_ts"), F.col("ingest_ts"))
    # Q6: by default an insert never clears a tombstone (sticky, as in the reference);
    # revive_on_insert makes an insert set deleted_at to NULL at its position
    del_present = (is_d | is_i) if revive_on_insert else is_d
    cols += [F.when(is_d, delete_ts).alias(DELETED_AT), del_present.alias(PRESENT_PREFIX + DELETED_AT)]
    reason = F.array_compact(F.array(*bad))
    return fence(df.select(*cols, reason.alias("_bad"), F.col("_raw")))


def split_staged(staged: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(ops, rejects) of staged rows."""
    ops = staged.where(F.size("_bad") == 0).drop("_bad", "_raw")
    rejects = staged.where(F.size("_bad") > 0).select(
        F.lit(table).alias("table"), "lsn", "seq", "action",
        F.array_join("_bad", ",").alias("reason"), F.col("_raw").alias("record"))
    return ops, rejects


def to_ops_with_rejects(feed: DataFrame, spec: TableSpec, tracked=None,
                        revive_on_insert: bool = False) -> tuple[DataFrame, DataFrame]:
    """Parsed feed -> (ops, rejects) for one table.

    ``rejects`` holds change rows whose key or a carried tracked value does not
    coerce to the declared type, with the failing column names in ``reason``.
    """
    return split_staged(stage_ops(feed, spec, tracked, revive_on_insert), spec.name)


def to_ops(feed: DataFrame, spec: TableSpec, tracked=None, revive_on_insert: bool = False) -> DataFrame:
    return to_ops_with_rejects(feed, spec, tracked, revive_on_insert)[0]


def pk_changes(feed: DataFrame, spec: TableSpec) -> DataFrame:
    """Q7: updates whose key differs from the before-image's key. They are applied
    as the reference does (the new key is written, the old row stays live); this
    report lists them: (table, lsn, old_pk, new_pk) as canonical text."""
    f = table_filter(feed.where(~F.col("_corrupt") & (F.col("action") == "U")), [spec.name])
    new, old = pick(F.col("columns"), spec.pk), pick(F.col("identity"), spec.pk)
    out = fence(f.select("table", "lsn",
                         canonical_text(old["type"], old["value"]).alias("old_pk"),
                         canonical_text(new["type"], new["value"]).alias("new_pk")))
    return out.where(F.col("old_pk").isNotNull() & ~F.col("old_pk").eqNullSafe(F.col("new_pk")))


def envelope_rejects(feed: DataFrame, tables) -> DataFrame:
    """Records that are corrupt or address an unknown table or none (J feed)."""
    known = F.coalesce(F.col("table").isin(list(tables)), F.lit(False))
    bad = F.col("_corrupt") | (F.col("action").isin("I", "U", "D") & ~known)
    return feed.where(bad).select(
        F.coalesce(F.col("table"), F.lit("")).alias("table"), "lsn", "seq", "action",
        F.when(F.col("_corrupt"), F.lit("corrupt")).otherwise(F.lit("unknown_table")).alias("reason"),
        F.col("_raw").alias("record"))


def to_generic_ops(feed: DataFrame, pk_of: dict, tracked_of: dict) -> DataFrame:
    """Long (MAP-free) form for any set of tables: one row per (table, pk, field).

    Output: table, pk (STRING canonical), field, value (STRING canonical), lsn, seq,
    pos (element position, orders repeated names within one record), is_delete.
    Used when column sets are not known statically. Lambda-free: the change arrays are exploded and the
    before-image is looked up with the same codegen'd ``pick`` as the wide form.
    """
    tables = list(pk_of)
    f = dml_filter(table_filter(feed.where(~F.col("_corrupt")), tables))
    pk_map = F.create_map(*[x for t in tables for x in (F.lit(t), F.lit(pk_of[t]))])
    tracked_map = F.create_map(*[x for t in tables
                                 for x in (F.lit(t), F.array(*[F.lit(c) for c in tracked_of[t]]))])
    is_d = F.col("action") == "D"
    pk_name = pk_map[F.col("table")]
    gone = F.array(F.struct(F.lit(DELETED_AT).alias("name"), F.lit(None).cast("string").alias("type"),
                            F.lit(None).cast("variant").alias("value"))).cast(COLUMN_DDL)
    base = fence(f.select(
        "table", "lsn", "seq", "action", "identity", F.when(is_d, gone).otherwise(F.col("columns")).alias("cells"),
        pick(F.when(is_d, F.col("identity")).otherwise(F.col("columns")), pk_name).alias("_k"),
        F.when(is_d, F.coalesce(F.col("commit_ts"), F.col("ingest_ts"))).alias("_del_ts"),
        tracked_map[F.col("table")].alias("_tracked"), pk_name.alias("_pk_name")))
    base = _canonical(base, "_k", "pk")
    # a deletion is one cell of its own, so that all changes come from one pass over the feed
    ex = fence(base.select(
        "table", "pk", "lsn", "seq", "action", "identity", "_del_ts", "_tracked", "_pk_name",
        F.posexplode("cells").alias("pos", "e")).select("*", F.col("e")["name"].alias("field")))
    ex = fence(ex.select("table", "pk", "lsn", "seq", "action", "_del_ts", "pos", "e", "field",
                         (F.array_contains(F.col("_tracked"), F.col("field")) & (F.col("field") != F.col("_pk_name"))).alias("_mine"),
                         F.when(F.col("action") == "U", pick(F.col("identity"), F.col("field"))).alias("_old")))
    keep = is_d | (F.col("_mine") & ((F.col("action") == "I") | changed(F.col("e"), F.col("_old"))))
    cells = _canonical(ex.where(keep).select("table", "pk", "field", "lsn", "seq", "pos", is_d.alias("is_delete"), "_del_ts", "e"), "e", "value")
    return cells.select("table", "pk", "field", F.when(F.col("is_delete"), canonical_ts(F.col("_del_ts"))).otherwise(F.col("value")).alias("value"),
                        "lsn", "seq", "pos", "is_delete")


def _canonical(df: DataFrame, entry: str, to: str) -> DataFrame:
    """``canonical_text`` of an entry column, which it takes the place of, in fenced steps: text and family, the instant of timestamps, the text of each family."""
    rest = [c for c in df.columns if c != entry]
    read = fence(df.select(*rest, type_family(F.col(entry)["type"]).alias("_fam"), variant_text(F.col(entry)["value"]).alias("_s")))
    at = fence(read.select(*rest, "_fam", "_s", F.when(F.col("_fam") == "timestamp", parse_ts(F.col("_s"))).alias("_at")))
    return fence(at.select(*rest, canonical_of_text(F.col("_fam"), F.col("_s"), F.col("_at")).alias(to)))
