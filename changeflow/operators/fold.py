"""Per-key coalesce (A1) and the position-guarded upsert.

State layout of a replicated table (the "target")::

    pk, <c>..., deleted_at, _lsn, _flsn_<c>..., _flsn_deleted_at, _fseq_<c>..., _fseq_deleted_at

``(_flsn_<c>, _fseq_<c>)`` is the place of the change that last set column ``c`` (NULL: never
set). Keeping it per field makes applying ops commutative and idempotent: batches may
arrive in any order or twice, also with several changes at one position, and the result
equals one ordered pass (``mode="field"``). The single row position ``_lsn`` alone gives
the strict row guard (``mode="row"``), exact only when batches arrive in ascending order.

Physical plan: :func:`coalesce` and :func:`merge_states` are one hash-partitioned
aggregation on ``pk`` with map-side partial aggregation (one maximum of
``(position, seq, value)`` per field), so a hot key is reduced inside each map task before the
shuffle. :func:`apply` is one equi-join on the unique key; both inputs are unique per key
after coalescing, so the join cannot fan out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions import guard
from changeflow.specs import DELETED_AT, FIELD_LSN_PREFIX, FIELD_SEQ_PREFIX, PRESENT_PREFIX, ROW_LSN

LAST_SEQ = (1 << 63) - 1


def _order(*cols) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def _newest(c: str, lsn: Column, seq: Column, present: Column) -> Column:
    """The newest (position, seq, value) of a field among the rows that carry it."""
    return F.max(F.when(present, F.struct(lsn.alias("lsn"), seq.alias("seq"), F.col(c).alias("value")))).alias("_x_" + c)


def _spread_newest(df: DataFrame, keep: list, fields: list[str]) -> DataFrame:
    every = [*fields, DELETED_AT]
    return df.select(*keep, *[F.col(f"_x_{c}.value").alias(c) for c in every],
                     *[F.col(f"_x_{c}.lsn").alias(FIELD_LSN_PREFIX + c) for c in every],
                     *[F.col(f"_x_{c}.seq").alias(FIELD_SEQ_PREFIX + c) for c in every])


def coalesce(ops: DataFrame, fields: list[str], key: str = "pk",
             group: list[str] | None = None) -> DataFrame:
    """A1: one row per key; newest value per field by (lsn, seq).

    Ties on ``lsn`` go to the higher ``seq`` (later arrival), ties on both to the larger
    value, so the result never depends on arrival. A field set to NULL by the newest op
    that carries it stays NULL; ops that do not carry a field are ignored for it.
    ``_flsn_<c>`` is NULL when no op carried the field.
    """
    keys = (group or []) + [key]
    lsn, seq = F.col("lsn"), F.col("seq")
    aggs = [_newest(c, lsn, seq, F.col(PRESENT_PREFIX + c)) for c in [*fields, DELETED_AT]]
    aggs += [F.max("lsn").alias(ROW_LSN), F.max_by(F.col("is_delete"), _order("lsn", "seq")).alias("is_delete"),
             F.count(F.lit(1)).alias("_n_ops")]
    return _spread_newest(ops.groupBy(*keys).agg(*aggs), [*keys, ROW_LSN, "is_delete", "_n_ops"], fields)


def target_columns(fields: list[str], key: str = "pk") -> list[str]:
    every = [*fields, DELETED_AT]
    return [key, *every, ROW_LSN, *[FIELD_LSN_PREFIX + c for c in every], *[FIELD_SEQ_PREFIX + c for c in every]]


def coalesce_to_target(folded: DataFrame, fields: list[str], key: str = "pk") -> DataFrame:
    """Folded ops as a target state (first load into an empty table)."""
    return folded.select(*target_columns(fields, key))


def merge_states(states: DataFrame, fields: list[str], key: str = "pk") -> DataFrame:
    """Rows in target layout (a state and any number of later deltas) -> one row per key, the
    newest value per field: merge on read, and J1 without a join."""
    aggs = []
    for c in [*fields, DELETED_AT]:
        lsn, seq = F.col(FIELD_LSN_PREFIX + c), F.col(FIELD_SEQ_PREFIX + c)
        aggs.append(_newest(c, lsn, seq, lsn.isNotNull()))
    aggs.append(F.max(ROW_LSN).alias(ROW_LSN))
    return _spread_newest(states.groupBy(key).agg(*aggs), [key, ROW_LSN], fields).select(*target_columns(fields, key))


def apply(target: DataFrame, folded: DataFrame, fields: list[str], key: str = "pk",
          mode: str = "field") -> DataFrame:
    """Apply coalesced ops to a target state.

    ``mode="field"``: column c takes the op's value iff the op carries c at a later
    place (position, then seq) than the stored one (commutative, idempotent).
    ``mode="row"``: every carried column takes the op's value iff the op's row
    position is greater than the stored ``_lsn`` (strict ``>``; missing = -1).
    Keys absent from the target are inserted (sparse rows for U/D ops on unknown
    keys). Keys without ops are kept unchanged.
    """
    if mode not in ("field", "row"):
        raise ValueError("mode must be 'field' or 'row'")
    t = target.select(*[F.col(c).alias("t_" + c) for c in target_columns(fields, key)])
    o = folded.select(*[F.col(c).alias("o_" + c) for c in target_columns(fields, key)])
    j = t.join(o, F.col("t_" + key) == F.col("o_" + key), "full_outer")
    row_ok = guard(F.col("o_" + ROW_LSN), F.col("t_" + ROW_LSN))
    out = [F.coalesce(F.col("t_" + key), F.col("o_" + key)).alias(key)]
    lsns, seqs = [], []
    for c in list(fields) + [DELETED_AT]:
        o_l, t_l = F.col("o_" + FIELD_LSN_PREFIX + c), F.col("t_" + FIELD_LSN_PREFIX + c)
        o_s, t_s = F.col("o_" + FIELD_SEQ_PREFIX + c), F.col("t_" + FIELD_SEQ_PREFIX + c)
        if mode == "field":
            take = o_l.isNotNull() & (guard(o_l, t_l) | ((o_l == t_l) & (o_s > t_s)))
        else:
            take = o_l.isNotNull() & row_ok
        out.append(F.when(take, F.col("o_" + c)).otherwise(F.col("t_" + c)).alias(c))
        lsns.append(F.when(take, o_l).otherwise(t_l).alias(FIELD_LSN_PREFIX + c))
        seqs.append(F.when(take, o_s).otherwise(t_s).alias(FIELD_SEQ_PREFIX + c))
    if mode == "field":
        row_lsn = F.greatest(F.col("t_" + ROW_LSN), F.col("o_" + ROW_LSN))
    else:
        row_lsn = F.when(F.col("o_" + ROW_LSN).isNotNull() & row_ok,
                         F.col("o_" + ROW_LSN)).otherwise(F.col("t_" + ROW_LSN))
    return j.select(*out, row_lsn.alias(ROW_LSN), *lsns, *seqs)


def replay(target: DataFrame, ops: DataFrame, fields: list[str], key: str = "pk",
           mode: str = "field") -> DataFrame:
    """Coalesce a batch of ops and apply it."""
    return apply(target, coalesce(ops, fields, key), fields, key, mode)


def ops_as_states(ops: DataFrame, fields: list[str], key: str = "pk") -> DataFrame:
    """Ops in target layout: each carried field at the op's place."""
    every = [*fields, DELETED_AT]
    return ops.select(F.col("pk").alias(key), *every, F.col("lsn").alias(ROW_LSN),
                      *[F.when(F.col(PRESENT_PREFIX + c), F.col("lsn")).alias(FIELD_LSN_PREFIX + c) for c in every],
                      *[F.when(F.col(PRESENT_PREFIX + c), F.col("seq")).alias(FIELD_SEQ_PREFIX + c) for c in every])


def fold_into(target: DataFrame, ops: DataFrame, fields: list[str], key: str = "pk") -> DataFrame:
    """J1 alternative with one aggregation and no join: stored rows and ops are merged alike.
    The result equals ``apply(..., mode="field")``."""
    return merge_states(target.select(*target_columns(fields, key)).unionByName(ops_as_states(ops, fields, key)), fields, key)


def live(target: DataFrame) -> DataFrame:
    """P10: rows not soft-deleted."""
    return target.where(F.col(DELETED_AT).isNull())


def tombstones(target: DataFrame) -> DataFrame:
    """Soft-deleted rows."""
    return target.where(F.col(DELETED_AT).isNotNull())


def coalesce_generic(long_ops: DataFrame) -> DataFrame:
    """A1 in long form: newest value per (table, pk, field) for any column set;
    a name repeated inside one record keeps its last occurrence."""
    order = _order("lsn", "seq", "pos")
    return (long_ops.where(F.col("field").isNotNull())
            .groupBy("table", "pk", "field")
            .agg(F.max_by("value", order).alias("value"), F.max("lsn").alias("field_lsn")))
