"""Benchmark: headline change-data operators at one scale.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Feeds are derived and landed as JSON-lines files first (not timed); then each
operator runs twice and the second (warm) run is timed. Prints one JSON line.

  fold      parse + route + coalesce (A1) of the partial-update feed   -> changes/s
  upsert    snapshot state + coalesced O changes, guarded merge (J1)   -> rows/s
  snapshot  typed source -> target layout -> versioned store (S2, P9)  -> rows/s
  stream    Structured Streaming, foreachBatch into the store (T-1..5) -> changes/s
            (two micro-batches: the second merges into buckets the first wrote)
  flagship  user_state end to end, including deriving and landing the feed
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changeflow.operators import fold as fo  # noqa: E402
from changeflow.operators.ops import to_ops  # noqa: E402
from changeflow.plans import feeds as fd  # noqa: E402
from changeflow.plans.queries import user_state  # noqa: E402
from changeflow.session import build_session, fresh_dir  # noqa: E402
from changeflow.sources.feed import parse_feed  # noqa: E402
from changeflow.sources.snapshot import snapshot_state  # noqa: E402
from changeflow.sources.store import VersionedStore  # noqa: E402
from changeflow.specs import TPCH_ORDERS, USERS  # noqa: E402
from changeflow.streaming.stream import run_stream  # noqa: E402


def timed(fn, runs: int = 2) -> float:
    """Seconds of the last of ``runs`` runs (the first warms up the JVM)."""
    dt = 0.0
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        dt = time.perf_counter() - t
    return dt


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    sf = sf_dir.rsplit("sf", 1)[-1]

    # setup (not timed): land the feeds
    u_path = fresh_dir(spark, "bench-u")
    fd.feed_u(spark, sf_dir).select("value").repartition(cpus).write.text(u_path)
    o_path = fresh_dir(spark, "bench-o")
    fd.feed_o(spark, sf_dir).select("value").repartition(cpus).write.text(o_path)
    n_events = spark.read.text(u_path).count()
    n_o_changes = spark.read.text(o_path).count()
    n_orders = fd.orders_source(spark, sf_dir).count()

    def q_fold():
        ops = to_ops(parse_feed(spark.read.text(u_path)), USERS)
        fo.coalesce(ops, USERS.fields).write.format("noop").mode("overwrite").save()

    def q_upsert():
        snap = snapshot_state(fd.orders_source(spark, sf_dir), TPCH_ORDERS, fd.L0)
        ops = to_ops(parse_feed(spark.read.text(o_path)), TPCH_ORDERS)
        fo.replay(snap, ops, TPCH_ORDERS.fields).write.format("noop").mode("overwrite").save()

    def q_snapshot():
        store = VersionedStore(spark, fresh_dir(spark, "bench-store"), buckets=cpus)
        snap = snapshot_state(fd.orders_source(spark, sf_dir), TPCH_ORDERS, fd.L0)
        store.replace({TPCH_ORDERS.name: snap}, [TPCH_ORDERS])

    def q_stream():
        store = VersionedStore(spark, fresh_dir(spark, "bench-stream"), buckets=cpus)
        run_stream(spark, u_path, store, [USERS], max_files_per_trigger=max(1, cpus // 2))

    def q_flagship():
        user_state(spark, sf_dir).write.format("noop").mode("overwrite").save()

    queries = {"fold": q_fold, "upsert": q_upsert, "snapshot": q_snapshot,
               "stream": q_stream, "flagship": q_flagship}
    secs = {name: round(timed(fn), 3) for name, fn in queries.items()}
    rates = {
        "fold_changes_per_s": round(n_events / secs["fold"], 1),
        "upsert_changes_per_s": round(n_o_changes / secs["upsert"], 1),
        "snapshot_rows_per_s": round(n_orders / secs["snapshot"], 1),
        "stream_changes_per_s": round(n_events / secs["stream"], 1),
    }
    print(json.dumps({"metric": "total_time", "value": round(sum(secs.values()), 3), "unit": "sec",
                      "queries": secs, "rates": rates, "sf": float(sf) if sf else sf,
                      "rows": {"events": n_events, "orders": n_orders, "order_changes": n_o_changes},
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
