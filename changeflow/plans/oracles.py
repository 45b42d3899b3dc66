"""DuckDB SQL equivalents of the driver queries (the correctness oracles).

They are written directly against the source tables, independent of the Spark
implementation: they restate each feed's definition and fold it with
``arg_max_null(value, position) FILTER (WHERE present)`` (DuckDB's ``arg_max``
skips NULL values; the ``_null`` variant keeps them, as the engine must).
"""

from __future__ import annotations

from changeflow.plans import feeds as fd


def cts(x: str) -> str:
    """Canonical ISO-8601 UTC text of a naive UTC timestamp expression."""
    return (f"CASE WHEN ({x}) IS NULL THEN NULL ELSE strftime(({x}), '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN epoch_us({x}) % 1000000 <> 0 THEN '.' || "
            f"lpad(CAST(epoch_us({x}) % 1000000 AS VARCHAR), 6, '0') ELSE '' END || '+00:00' END")


def dec_text(x: str) -> str:
    """Decimal text without trailing zeros (how a JSON number reads back)."""
    s = f"CAST({x} AS VARCHAR)"
    return f"CASE WHEN {s} LIKE '%.%' THEN rtrim(rtrim({s}, '0'), '.') ELSE {s} END"


AMT = "CAST(value AS DECIMAL(12,2))"
KV = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
L0, UPD, DEL, INS, OFF = fd.L0, fd.POS_UPDATE, fd.POS_DELETE, fd.POS_INSERT, fd.INSERT_OFFSET
O_TS = f"make_timestamp({fd.O_EPOCH_MICROS} + o_orderkey * {fd.O_STEP_MICROS})"


def _user_fold(status_expr="event_type", status_filter="event_type IN ('signup','click')",
               src="events", extra="") -> str:
    return f"""
SELECT user_id,
  arg_max_null({status_expr}, event_id) FILTER (WHERE {status_filter}) AS status,
  arg_max_null({AMT}, event_id) FILTER (WHERE event_type IN ('signup','purchase')) AS amount,
  arg_max_null({KV}, event_id) FILTER (WHERE event_type IN ('signup','view')) AS k,
  {cts("arg_max(ts, event_id) FILTER (WHERE event_type = 'error')")} AS deleted_at,
  max(event_id) AS _lsn{extra}
FROM {src} GROUP BY user_id"""


USER_STATE = _user_fold()

STREAM_POISON = _user_fold(src="(SELECT * FROM events WHERE event_id NOT IN (7, 701))")

STREAM_POISON_REJECTS = """
WITH n AS (SELECT count(*) AS read, count(*) FILTER (WHERE event_id IN (7, 701)) AS rejected FROM events)
SELECT 'users' AS "table", event_id AS lsn,
       CASE event_type WHEN 'error' THEN 'D' ELSE 'U' END AS action, 'poison' AS reason,
       read, read - rejected AS written, rejected, CAST(0 AS BIGINT) AS skipped
FROM events, n WHERE event_id IN (7, 701)"""

USER_NULLS = _user_fold(
    status_expr=f"CASE WHEN event_id % {fd.NULL_STATUS_EVERY} = 0 THEN NULL ELSE event_type END",
    status_filter=(f"event_type <> 'error' AND (event_type IN ('signup','click') "
                   f"OR event_id % {fd.NULL_STATUS_EVERY} = 0)"))

IMAGES = f"""
WITH e AS (
  SELECT event_id, user_id, event_type, ts, {AMT} AS amount, {KV} AS k,
         lag(event_type) OVER w AS p_status, lag({AMT}) OVER w AS p_amount,
         lag({KV}) OVER w AS p_k, row_number() OVER w AS rn
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))"""

USER_STATE_IMAGES = IMAGES + f"""
SELECT user_id,
  arg_max_null(event_type, event_id) FILTER (WHERE event_type <> 'error'
      AND (rn = 1 OR event_type IS DISTINCT FROM p_status)) AS status,
  arg_max_null(amount, event_id) FILTER (WHERE event_type <> 'error'
      AND (rn = 1 OR amount IS DISTINCT FROM p_amount)) AS amount,
  arg_max_null(k, event_id) FILTER (WHERE event_type <> 'error'
      AND (rn = 1 OR k IS DISTINCT FROM p_k)) AS k,
  {cts("arg_max(ts, event_id) FILTER (WHERE event_type = 'error')")} AS deleted_at,
  max(event_id) AS _lsn
FROM e GROUP BY user_id"""

DIFF_CHANGED = IMAGES + """
SELECT event_id, field FROM (
  SELECT event_id, 'status' AS field FROM e
   WHERE rn > 1 AND event_type <> 'error' AND event_type IS DISTINCT FROM p_status
  UNION ALL
  SELECT event_id, 'amount' FROM e
   WHERE rn > 1 AND event_type <> 'error' AND amount IS DISTINCT FROM p_amount
  UNION ALL
  SELECT event_id, 'k' FROM e
   WHERE rn > 1 AND event_type <> 'error' AND k IS DISTINCT FROM p_k)"""

COALESCE_GENERIC = f"""
SELECT 'users' AS "table", CAST(user_id AS VARCHAR) AS pk, field, value, field_lsn FROM (
  SELECT user_id, 'status' AS field, arg_max(event_type, event_id) AS value, max(event_id) AS field_lsn
    FROM events WHERE event_type IN ('signup','click') GROUP BY user_id
  UNION ALL
  SELECT user_id, 'amount', arg_max({dec_text(AMT)}, event_id), max(event_id)
    FROM events WHERE event_type IN ('signup','purchase') GROUP BY user_id
  UNION ALL
  SELECT user_id, 'k', arg_max(CAST({KV} AS VARCHAR), event_id), max(event_id)
    FROM events WHERE event_type IN ('signup','view') GROUP BY user_id
  UNION ALL
  SELECT user_id, 'deleted_at', arg_max({cts('ts')}, event_id), max(event_id)
    FROM events WHERE event_type = 'error' GROUP BY user_id)"""

# ---------------------------------------------------------------- orders (O)

_SRC = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS p, " \
       "o_orderdate, o_orderpriority FROM orders"


def orders_final(price_rule: str, cols: str = "all") -> str:
    body = f"""
WITH src AS ({_SRC})
SELECT o_orderkey, o_custkey, o_orderstatus, CAST({price_rule} AS DECIMAL(12,2)) AS o_totalprice,
       {cts('o_orderdate')} AS o_orderdate, o_orderpriority,
       CASE WHEN o_orderkey % 7 = 0 THEN {cts(O_TS)} END AS deleted_at,
       CASE WHEN o_orderkey % 7 = 0 THEN {DEL} + o_orderkey
            WHEN o_orderkey % 3 = 0 THEN {UPD} + o_orderkey ELSE {L0} END AS _lsn
FROM src
UNION ALL
SELECT o_orderkey + {OFF}, o_custkey, o_orderstatus, p, {cts('o_orderdate')}, o_orderpriority,
       NULL, {INS} + o_orderkey
FROM src WHERE o_orderkey % 5 = 0"""
    if cols == "all":
        return body
    return f"SELECT {cols} FROM ({body})"


ORDERS_FIELD = orders_final("CASE WHEN o_orderkey % 3 = 0 THEN p + 1 ELSE p END")
ORDERS_ROW = orders_final("CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0 THEN p + 1 ELSE p END")
ORDERS_TIES = orders_final("CASE WHEN o_orderkey % 3 = 0 THEN p + 2 ELSE p END",
                           "o_orderkey, o_totalprice, _lsn")

SNAPSHOT_DOCS = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
       {cts('o_orderdate')} AS o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS deleted_at,
       CAST({L0} AS BIGINT) AS _lsn
FROM orders"""

SNAPSHOT_COUNTS = """
SELECT 'tpch_customer' AS "table", 0 AS ordinal, count(*) AS "rows" FROM customer
UNION ALL SELECT 'tpch_orders', 1, count(*) FROM orders"""

# ---------------------------------------------------------------- feed / types

FEED_PARSE = f"""
SELECT event_id AS lsn, CAST(0 AS BIGINT) AS seq,
       CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS action, 'users' AS "table",
       {cts('ts')} AS commit_ts, user_id,
       CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1
         + CASE WHEN event_type IN ('signup','click') THEN 1 ELSE 0 END
         + CASE WHEN event_type IN ('signup','purchase') THEN 1 ELSE 0 END
         + CASE WHEN event_type IN ('signup','view') THEN 1 ELSE 0 END END AS INTEGER) AS n_columns,
       CAST(1 AS INTEGER) AS n_identity
FROM events"""

_BAD = f"event_id % {fd.BAD_EVERY} = 0"
_KIND = f"(event_id // {fd.BAD_EVERY}) % 4"

FEED_FILTER = f"""
SELECT 'users' AS "table", action, count(*) AS n FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS action FROM events
  UNION ALL
  SELECT 'U' FROM events WHERE {_BAD} AND {_KIND} IN (0, 1))
GROUP BY action"""

REJECTS = f"""
SELECT CASE WHEN {_KIND} = 2 THEN 'ghost' ELSE 'users' END AS "table", event_id AS lsn, 'U' AS action,
       CASE {_KIND} WHEN 0 THEN 'amount' WHEN 1 THEN 'corrupt' ELSE 'unknown_table' END AS reason
FROM events WHERE {_BAD} AND {_KIND} IN (0, 1, 2)"""

COERCE_ALL = f"""
SELECT event_id AS lsn, {AMT} AS n, {AMT} AS ns,
       CASE WHEN event_id % 2 = 0 THEN value > 25 END AS b, value > 25 AS bj,
       {KV} AS i, {cts('ts')} AS ts, event_type AS x
FROM events"""


def _ts_variants_sql() -> str:
    base = "'%Y-%m-%d %H:%M:%S.%f'"
    tee = "'%Y-%m-%dT%H:%M:%S.%f'"
    return (f"CASE event_id % 6 WHEN 0 THEN strftime(ts, {base}) || '+00' "
            f"WHEN 1 THEN strftime(ts, {tee}) || 'Z' "
            f"WHEN 2 THEN strftime(ts, {base}) || '+0000' "
            f"WHEN 3 THEN strftime(ts, {tee}) || '+00:00' "
            f"WHEN 4 THEN strftime(ts, {base}) "
            f"ELSE strftime(ts + INTERVAL 330 MINUTE, {base}) || '+05:30' END")


CANONICAL_TS = f"SELECT event_id, {_ts_variants_sql()} AS input, {cts('ts')} AS canonical FROM events"

LSN_DECODE = """
SELECT event_id, printf('%X/%X', pos >> 32, pos & 4294967295) AS lsn_text, pos AS lsn
FROM (SELECT event_id, event_id * 4294967311 + 17 AS pos FROM events)"""

# ---------------------------------------------------------------- registry

DRIFT_COLUMNS = """
SELECT 'users' AS "table", 'promo_code' AS "column", count(*) AS n_records, min(event_id) AS first_lsn
FROM events WHERE event_id % 2 = 0 AND event_type <> 'error' HAVING count(*) > 0"""

SCHEMA_DIFF = """
SELECT 'users' AS "table", 'promo_code' AS "column", 'added' AS change
FROM events WHERE event_id % 2 = 0 AND event_type <> 'error' HAVING count(*) > 0
UNION ALL SELECT 'users', 'legacy_note', 'removed'"""

SCHEMA_BACKFILL = f"""
SELECT s.*, b.promo_code FROM ({USER_STATE}) s LEFT JOIN (
  SELECT user_id, arg_max_null('P' || CAST(event_id % 13 AS VARCHAR), event_id) AS promo_code
  FROM events WHERE event_id % 2 = 0 AND event_type <> 'error'
    AND ts >= TIMESTAMP '2024-01-16 00:00:00' GROUP BY user_id) b USING (user_id)"""

# ---------------------------------------------------------------- reports

_TARGET = f"({ORDERS_FIELD})"

_GONE = "t.o_orderkey IS NULL"
PARITY_REPORT = f"""
WITH s AS ({_SRC}), a AS {_TARGET}, t AS (SELECT * FROM a WHERE o_orderkey % 11 <> 0),
j AS (SELECT {_GONE} AS gone, {_GONE} OR s.o_custkey IS DISTINCT FROM t.o_custkey AS o_custkey,
             {_GONE} OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus AS o_orderstatus,
             {_GONE} OR s.p IS DISTINCT FROM t.o_totalprice AS o_totalprice,
             {_GONE} OR {cts('s.o_orderdate')} IS DISTINCT FROM t.o_orderdate AS o_orderdate,
             {_GONE} OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority AS o_orderpriority,
             {_GONE} OR t.deleted_at IS NOT NULL AS deleted_at
      FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey),
u AS (UNPIVOT j ON o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, deleted_at INTO NAME "column" VALUE bad)
SELECT "column", count(*) AS rows_compared, count(*) FILTER (WHERE gone) AS rows_missing,
       count(*) FILTER (WHERE NOT bad) AS rows_matched, count(*) FILTER (WHERE bad) AS rows_mismatched
FROM u GROUP BY 1"""

PARITY_DIGEST = f"""
WITH s AS ({_SRC}), t AS (SELECT * REPLACE (CASE WHEN o_orderkey % 997 = 0 THEN CAST(p + 1 AS DECIMAL(12,2)) ELSE p END AS p) FROM s WHERE o_orderkey % 1009 <> 0),
sx AS (SELECT o_orderkey, unnest(['o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS "column",
              unnest([CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(p AS VARCHAR), {cts('o_orderdate')}, o_orderpriority]) AS source FROM s),
tx AS (SELECT o_orderkey, unnest(['o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS "column",
              unnest([CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(p AS VARCHAR), {cts('o_orderdate')}, o_orderpriority]) AS target FROM t)
SELECT sx.o_orderkey, sx."column", sx.source, tx.target, tx.o_orderkey IS NOT NULL AS found
FROM sx LEFT JOIN tx ON sx.o_orderkey = tx.o_orderkey AND sx."column" = tx."column"
WHERE tx.o_orderkey IS NULL OR sx.source IS DISTINCT FROM tx.target
UNION ALL SELECT -1 - o_orderkey, NULL, NULL, NULL, true FROM s WHERE o_orderkey % 1013 = 0"""

PARITY_SAMPLE = """
WITH keys AS (SELECT o_orderkey FROM orders ORDER BY md5('parity' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100)
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 11 = 0 THEN 6 ELSE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END)
                        + (CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) END AS BIGINT) AS fields_mismatched
FROM keys"""

VALUE_EQUALITY = f"""
WITH t AS (SELECT o_orderkey, o_totalprice FROM {_TARGET} x)
SELECT * FROM t WHERE o_totalprice = (SELECT arg_min(o_totalprice, o_orderkey) FROM t)"""

PRESENCE = f"SELECT o_orderkey + {OFF} AS o_orderkey FROM orders WHERE o_orderkey % 5 = 0"

MISSING_KEYS = "SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0"

ORPHANS = f"""
WITH live AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0
              UNION ALL SELECT o_orderkey + {OFF} FROM orders WHERE o_orderkey % 5 = 0)
SELECT l_orderkey, count(*) AS n_children FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM live WHERE live.o_orderkey = lineitem.l_orderkey)
GROUP BY l_orderkey"""

CONVERGENCE = f"""
WITH o AS (SELECT count(*) FILTER (WHERE o_orderkey % 7 <> 0) AS keep,
                  count(*) FILTER (WHERE o_orderkey % 7 = 0) AS del,
                  count(*) FILTER (WHERE o_orderkey % 5 = 0) AS ins, count(*) AS n FROM orders),
     u AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS e FROM events GROUP BY user_id)
SELECT 'tpch_orders' AS "table", keep + ins AS source_rows, n + ins AS target_rows,
       keep + ins AS live_rows, del AS tombstones, true AS converged FROM o
UNION ALL
SELECT 'users', count(*) FILTER (WHERE e = 0), count(*), count(*) FILTER (WHERE e = 0),
       count(*) FILTER (WHERE e > 0), true FROM u"""

OP_MIX = f"""
WITH f AS (SELECT CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS action, ts FROM events
           UNION ALL SELECT 'U', ts FROM events WHERE {_BAD} AND {_KIND} = 0),
     span AS (SELECT (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS s FROM f)
SELECT 'users' AS "table", action, count(*) AS n,
       round(count(*) / greatest(any_value(span.s), 1e-6), 1) AS per_sec
FROM f, span GROUP BY action"""

BATCH_HIGHWATER = f"""
SELECT event_id // 1000 AS batch, count(*) AS events, count(DISTINCT user_id) AS keys,
       max(event_id) AS max_lsn, {cts('arg_max(ts, event_id)')} AS last_commit
FROM events GROUP BY 1"""

MAX_ID = f"""
SELECT 'users' AS "table", coalesce(max(user_id), 0) AS max_id FROM events
UNION ALL
SELECT 'tpch_orders', coalesce(max(k), 0) FROM (
  SELECT o_orderkey AS k FROM orders UNION ALL SELECT o_orderkey + {OFF} FROM orders WHERE o_orderkey % 5 = 0)"""

LAG_REPORT = """
WITH per AS (SELECT event_id // 1000 AS batch, count(*) AS events,
                    epoch_us(max(ts)) AS c, epoch_us(min(ts)) AS o FROM events GROUP BY 1)
SELECT a.batch, a.events, coalesce(greatest(0, b.c - a.c), 0) / 1e6 AS read_lag_s,
       (a.c + 3000000 - a.o) / 1e6 AS e2e_max_lag_s, a.c + 3000000 - a.o <= 5000000 AS within_slo
FROM per a LEFT JOIN per b ON b.batch = a.batch + 1"""

BACKLOG = """
WITH per AS (SELECT event_id // 1000 AS batch, max(event_id) AS m FROM events GROUP BY 1)
SELECT batch, max(m) OVER (ORDER BY batch) AS applied_lsn,
       (SELECT max(event_id) FROM events) - max(m) OVER (ORDER BY batch) AS backlog FROM per"""

STATUS = f"""
SELECT 'tpch_orders' AS "table", max(p) AS applied_lsn, CAST(0 AS BIGINT) AS backlog,
       count(*) FILTER (WHERE kind = 0) AS snapshot_rows,
       count(*) FILTER (WHERE kind = 0) + count(*) FILTER (WHERE kind = 2) AS "rows",
       count(*) FILTER (WHERE kind = 0) + count(*) FILTER (WHERE kind = 2)
         - count(*) FILTER (WHERE kind = 1) AS live_rows
FROM (SELECT 0 AS kind, {L0} AS p FROM orders
      UNION ALL SELECT 1, {DEL} + o_orderkey FROM orders WHERE o_orderkey % 7 = 0
      UNION ALL SELECT 2, {INS} + o_orderkey FROM orders WHERE o_orderkey % 5 = 0
      UNION ALL SELECT 3, {UPD} + o_orderkey FROM orders WHERE o_orderkey % 3 = 0)"""


PROGRESS = f"""
SELECT CAST(2 AS BIGINT) AS batches, count(*) + count(*) FILTER (WHERE {_BAD}) AS read,
       count(*) AS written, count(*) FILTER (WHERE {_BAD} AND {_KIND} < 3) AS rejected,
       count(*) FILTER (WHERE {_BAD} AND {_KIND} = 3) AS skipped, max(event_id) AS applied_lsn,
       true AS has_read_per_s, true AS has_written_per_s, true AS has_apply_lag_s, true AS has_read_lag_s
FROM events"""

STREAM_DRIFT = """
SELECT 'users' AS "table", 'promo_code' AS "column", min(event_id) AS first_lsn
FROM events WHERE event_id % 2 = 0 AND event_type <> 'error' HAVING count(*) > 0"""

STREAM_TWO = f"""
SELECT 'users' AS "table", count(*) AS "rows", count(*) FILTER (WHERE deleted_at IS NULL) AS live_rows, max(_lsn) AS max_lsn FROM ({USER_STATE})
UNION ALL
SELECT 'tpch_orders', count(DISTINCT k), count(DISTINCT k) - count(DISTINCT k) FILTER (WHERE del), max(p) FROM (
  SELECT o_orderkey AS k, false AS del, {UPD} + o_orderkey AS p FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey, true, {DEL} + o_orderkey FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL SELECT o_orderkey + {OFF}, false, {INS} + o_orderkey FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey, false, 0 FROM orders WHERE o_orderkey % 11 = 0)"""

MAX_ID_EMPTY = f"SELECT 'users' AS \"table\", coalesce(max(user_id), 0) AS max_id FROM ({USER_STATE}) WHERE deleted_at IS NULL"

REJECTS_ROW = f"""
{REJECTS}
UNION ALL SELECT '' AS "table", event_id, 'U', 'unknown_table' FROM events WHERE event_id % {fd.BAD_EVERY} = {fd.BAD_EVERY // 2}"""

LOG_GAPS = f"""
WITH w AS (SELECT max(event_id) // 4 + 1 AS w FROM events)
SELECT 2 * any_value(w) - 1 AS lost_after, 3 * any_value(w) - 1 AS lost_upto,
       count(*) + count(*) FILTER (WHERE {_BAD}) AS records_held, CAST(3 AS BIGINT) AS landings
FROM events, w WHERE event_id < 2 * w OR event_id >= 3 * w"""

COLUMN_USAGE = """
WITH n AS (SELECT count(*) FILTER (WHERE o_orderkey % 3 = 0) + count(*) FILTER (WHERE o_orderkey % 5 = 0) + count(*) FILTER (WHERE o_orderkey % 11 = 0) AS n
           FROM orders),
c AS (SELECT * FROM (VALUES ('o_orderkey', 0, 'bigint'), ('o_custkey', 1, 'bigint'), ('o_orderstatus', 2, 'text'), ('o_totalprice', 3, 'numeric'),
      ('o_orderdate', 4, 'timestamp with time zone'), ('o_orderpriority', 5, 'text')) AS t("column", ordinal, type))
SELECT 'tpch_orders' AS "table", "column", CAST(ordinal AS INTEGER) AS ordinal, n AS n_records, n AS n_values, type AS type_min, type AS type_max FROM c, n"""


def _live(q: str, cond: str) -> str:
    return f"SELECT * FROM ({q}) WHERE {cond}"


ORACLES = {
    "user_state": USER_STATE,
    "user_live": _live(USER_STATE, "deleted_at IS NULL"),
    "user_tombstones": _live(USER_STATE, "deleted_at IS NOT NULL"),
    "session_live": _live(_user_fold(src="(SELECT * REPLACE (event_id // 3 AS user_id) FROM events)"), "deleted_at IS NULL"),
    "orders_live": _live(ORDERS_FIELD, "deleted_at IS NULL"),
    "user_nulls": USER_NULLS,
    "user_state_images": USER_STATE_IMAGES,
    "coalesce_generic": COALESCE_GENERIC,
    "coalesce_ties": ORDERS_TIES,
    "diff_changed": DIFF_CHANGED,
    "feed_parse": FEED_PARSE,
    "feed_filter": FEED_FILTER,
    "rejects": REJECTS,
    "coerce_all": COERCE_ALL,
    "canonical_ts": CANONICAL_TS,
    "lsn_decode": LSN_DECODE,
    "tracked_projection": USER_STATE,
    "drift_columns": DRIFT_COLUMNS,
    "schema_diff": SCHEMA_DIFF,
    "schema_backfill": SCHEMA_BACKFILL,
    "snapshot_docs": SNAPSHOT_DOCS,
    "snapshot_counts": SNAPSHOT_COUNTS,
    "guarded_upsert_field": ORDERS_FIELD,
    "guarded_upsert_row": ORDERS_ROW,
    "handoff": ORDERS_FIELD,
    "stream_fold": USER_STATE,
    "stream_replay": USER_STATE,
    "stream_restart": USER_STATE,
    "stream_rejects": REJECTS,
    "stream_poison": STREAM_POISON,
    "stream_poison_rejects": STREAM_POISON_REJECTS,
    "stream_rejects_row": REJECTS_ROW,
    "stream_drift": STREAM_DRIFT,
    "stream_resync": SCHEMA_BACKFILL,
    "log_stream": USER_STATE,
    "log_gaps": LOG_GAPS,
    "column_usage": COLUMN_USAGE,
    "stream_schema_sync": SCHEMA_BACKFILL,
    "stream_two_tables": STREAM_TWO,
    "point_lookup": f"SELECT * FROM ({SNAPSHOT_DOCS}) WHERE o_orderkey IN (1, 2, 500, 999)",
    "value_equality": VALUE_EQUALITY,
    "max_id_empty": MAX_ID_EMPTY,
    "stream_snapshot": ORDERS_FIELD,
    "snapshot_resume": ORDERS_FIELD,
    "status": STATUS,
    "progress": PROGRESS,
    "parity_report": PARITY_REPORT,
    "parity_digest": PARITY_DIGEST,
    "parity_digest_report": PARITY_REPORT,
    "parity_sample": PARITY_SAMPLE,
    "presence": PRESENCE,
    "missing_keys": MISSING_KEYS,
    "orphans": ORPHANS,
    "convergence": CONVERGENCE,
    "op_mix": OP_MIX,
    "batch_highwater": BATCH_HIGHWATER,
    "max_id": MAX_ID,
    "lag_report": LAG_REPORT,
    "backlog": BACKLOG,
}
