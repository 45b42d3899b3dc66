"""Change feeds derived from the driver's test tables.

Every feed is a DataFrame with a JSON-lines ``value`` column (plus ``lsn_sort`` and
helper columns) computed by Spark from the whole source table, so its size grows
with the data. Definitions (positions are ours, chosen so ranges never overlap for
keys below 10**15):

U  events as partial updates of ``users``: pk user_id, position event_id, commit ts.
   signup sets status, amount, k; click sets status; purchase sets amount; view
   sets k; error deletes.
N  U, where events with event_id % 97 = 0 (not errors) also set status to NULL.
I  events as full row images: first event of a user inserts, later ones update
   with the previous image as before-image, errors delete.
O  tpch orders snapshot at L0, then: update price + 1 (key % 3 = 0), delete
   (key % 7 = 0), insert key + INSERT_OFFSET (key % 5 = 0), stale status 'X' at a
   position below L0 (key % 11 = 0, must lose).
T  O plus a second update at the same position with seq 2 (price + 2, must win).
J  U plus bad records on event_id % 50 = 0: bad decimal, bad timestamp, unknown
   table, begin record.
K  J plus changes that name no table on event_id % 50 = 25.
D  U with an extra, unregistered column promo_code on even event_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.images import previous_by_key
from changeflow.session import fresh_dir
from changeflow.sources.records import entry, record, wal_ts_text
from changeflow.specs import TPCH_ORDERS, USERS

# Fixed values of the derived feeds.
L0 = 10 ** 16
POS_UPDATE = 2 * 10 ** 16
POS_DELETE = 3 * 10 ** 16
POS_INSERT = 4 * 10 ** 16
INSERT_OFFSET = 10 ** 15
O_EPOCH_MICROS = 1_735_689_600_000_000     # 2025-01-01 00:00:00 UTC
O_STEP_MICROS = 1_000_001
NULL_STATUS_EVERY = 97
BAD_EVERY = 50
DRIFT_COLUMN = "promo_code"


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    return df


def land(feed: DataFrame, name: str) -> DataFrame:
    """Land a derived feed as JSON-lines files in the shared folder; read it back.

    Feeds reach the engine as files (or a message bus), never as an expression
    tree: parsing text that was just built in the same plan would let the optimizer
    fold the encoder into every field lookup. Landing also cuts the lineage.
    """
    spark = feed.sparkSession
    path = fresh_dir(spark, f"feed-{name}")
    feed.select("value").write.text(path)
    return spark.read.text(path)


def land_rows(df: DataFrame, name: str) -> DataFrame:
    """Land typed rows (parsed changes that several steps read) as parquet, so that the feed is parsed once."""
    path = fresh_dir(df.sparkSession, f"rows-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _user_img(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id", "ts", "user_id", "event_type",
        F.col("value").cast("decimal(12,2)").alias("amount"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def events_ops_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    return _user_img(ev)


def _u_record(e: DataFrame, null_status: bool = False, drift: bool = False) -> DataFrame:
    t = F.col("event_type")
    st_present = t.isin("signup", "click")
    st_value = F.col("event_type")
    if null_status:
        nul = (F.col("event_id") % NULL_STATUS_EVERY == 0)
        st_present = st_present | nul
        st_value = F.when(nul, F.lit(None).cast("string")).otherwise(st_value)
    cols = [entry("user_id", "bigint", F.col("user_id")),
            entry("status", "text", st_value, st_present),
            entry("amount", "numeric", F.col("amount"), t.isin("signup", "purchase")),
            entry("k", "bigint", F.col("k"), t.isin("signup", "view"))]
    if drift:
        cols.append(entry(DRIFT_COLUMN, "text",
                          F.concat(F.lit("P"), (F.col("event_id") % 13).cast("string")),
                          F.col("event_id") % 2 == 0))
    is_err = t == "error"
    commit = wal_ts_text(F.col("ts"))
    v = F.when(is_err, record(F.col("event_id"), F.lit(0), F.lit("D"), USERS.name, commit, [],
                              [entry("user_id", "bigint", F.col("user_id"))])) \
         .otherwise(record(F.col("event_id"), F.lit(0), F.lit("U"), USERS.name, commit, cols,
                           [entry("user_id", "bigint", F.col("user_id"))]))
    return e.select(v.alias("value"), F.col("event_id").alias("lsn_sort"), "event_id", "user_id")


def feed_u(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _u_record(events_ops_frame(spark, sf_dir))


def feed_s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed U keyed by sessions of three events: some keys are deleted, most live."""
    e = events_ops_frame(spark, sf_dir)
    return _u_record(e.withColumn("user_id", F.expr("event_id div 3")))


def feed_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _u_record(events_ops_frame(spark, sf_dir), null_status=True)


def feed_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _u_record(events_ops_frame(spark, sf_dir), drift=True)


def feed_j(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events_ops_frame(spark, sf_dir)
    good = _u_record(e)
    bad = e.where(F.col("event_id") % BAD_EVERY == 0)
    kind = (F.col("event_id") / BAD_EVERY).cast("bigint") % 4
    uid = [entry("user_id", "bigint", F.col("user_id"))]
    commit = wal_ts_text(F.col("ts"))
    lsn = F.col("event_id")
    v = (F.when(kind == 0, record(lsn, F.lit(1), F.lit("U"), USERS.name, commit,
                                  uid + [entry("amount", "numeric", F.lit("abc"))], uid))
          .when(kind == 1, record(lsn, F.lit(1), F.lit("U"), USERS.name, F.lit("nope"),
                                  uid + [entry("status", "text", F.lit("late"))], uid))
          .when(kind == 2, record(lsn, F.lit(1), F.lit("U"), "ghost", commit, uid, uid))
          .otherwise(record(lsn, F.lit(1), F.lit("B"), F.lit(None).cast("string"), commit, [], [])))
    badf = bad.select(v.alias("value"), F.col("event_id").alias("lsn_sort"), "event_id", "user_id")
    return good.unionByName(badf)


def feed_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J, and changes that name no table (event_id % BAD_EVERY = 25)."""
    e = events_ops_frame(spark, sf_dir).where(F.col("event_id") % BAD_EVERY == BAD_EVERY // 2)
    uid = [entry("user_id", "bigint", F.col("user_id"))]
    v = record(F.col("event_id"), F.lit(1), F.lit("U"), F.lit(None).cast("string"), wal_ts_text(F.col("ts")), uid, uid)
    return feed_j(spark, sf_dir).unionByName(e.select(v.alias("value"), F.col("event_id").alias("lsn_sort"), "event_id", "user_id"))


def feed_i(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = previous_by_key(events_ops_frame(spark, sf_dir), "user_id", "event_id",
                        ["event_type", "amount", "k"])
    has_prev = F.col("prev_event_id").isNotNull()

    def image(prefix: str, present: Column | None = None) -> list[Column]:
        return [entry("status", "text", F.col(prefix + "event_type"), present),
                entry("amount", "numeric", F.col(prefix + "amount"), present),
                entry("k", "bigint", F.col(prefix + "k"), present)]

    uid = [entry("user_id", "bigint", F.col("user_id"))]
    commit = wal_ts_text(F.col("ts"))
    lsn = F.col("event_id")
    v = (F.when(F.col("event_type") == "error",
                record(lsn, F.lit(0), F.lit("D"), USERS.name, commit, [], uid + image("prev_", has_prev)))
          .when(~has_prev, record(lsn, F.lit(0), F.lit("I"), USERS.name, commit, uid + image(""), []))
          .otherwise(record(lsn, F.lit(0), F.lit("U"), USERS.name, commit, uid + image(""),
                            uid + image("prev_"))))
    return e.select(v.alias("value"), F.col("event_id").alias("lsn_sort"), "event_id", "user_id")


# ---------------------------------------------------------------- orders (O, T)

def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tpch orders typed as the replicated table (price as exact decimal)."""
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                        "o_orderdate", "o_orderpriority"])
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"),
                    F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
                    "o_orderpriority")


def _order_entries(key: Column | None = None, status: Column | None = None,
                   price: Column | None = None) -> list[Column]:
    return [entry("o_orderkey", "bigint", key if key is not None else F.col("o_orderkey")),
            entry("o_custkey", "bigint", F.col("o_custkey")),
            entry("o_orderstatus", "text", status if status is not None else F.col("o_orderstatus")),
            entry("o_totalprice", "numeric", price if price is not None else F.col("o_totalprice")),
            entry("o_orderdate", "timestamp with time zone", wal_ts_text(F.col("o_orderdate"))),
            entry("o_orderpriority", "text", F.col("o_orderpriority"))]


def o_commit_ts(key: Column) -> Column:
    return F.timestamp_micros(F.lit(O_EPOCH_MICROS) + key * F.lit(O_STEP_MICROS))


def feed_o(spark: SparkSession, sf_dir: str, ties: bool = False) -> DataFrame:
    """Changes after the snapshot of ``tpch_orders`` (the snapshot is ``orders_source``)."""
    o = orders_source(spark, sf_dir)
    key = F.col("o_orderkey")
    commit = wal_ts_text(o_commit_ts(key))
    name = TPCH_ORDERS.name
    old = _order_entries()
    kinds = [
        (key % 3 == 0, F.lit(POS_UPDATE) + key, 0,
         record(F.lit(POS_UPDATE) + key, F.lit(0), F.lit("U"), name, commit,
                _order_entries(price=F.col("o_totalprice") + F.lit(1)), old)),
        (key % 7 == 0, F.lit(POS_DELETE) + key, 0,
         record(F.lit(POS_DELETE) + key, F.lit(0), F.lit("D"), name, commit, [], old)),
        (key % 5 == 0, F.lit(POS_INSERT) + key, 0,
         record(F.lit(POS_INSERT) + key, F.lit(0), F.lit("I"), name, commit,
                _order_entries(key=key + F.lit(INSERT_OFFSET)), [])),
        (key % 11 == 0, key, 0,
         record(key, F.lit(0), F.lit("U"), name, commit,
                _order_entries(status=F.lit("X")), old)),
    ]
    if ties:
        kinds.append((key % 3 == 0, F.lit(POS_UPDATE) + key, 1,
                      record(F.lit(POS_UPDATE) + key, F.lit(1), F.lit("U"), name, commit,
                             _order_entries(price=F.col("o_totalprice") + F.lit(2)), old)))
    parts = [o.where(cond).select(v.alias("value"), pos.alias("lsn_sort"), F.lit(i).alias("kind"), key)
             for i, (cond, pos, _, v) in enumerate(kinds)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
