"""Connected components of a table of links, by large-star / small-star rounds.

Each round is two aggregations and two joins over the links; the hub of a large
component is reduced map-side by ``min`` and its join is one Spark can split. Rounds are
written to the shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); root is the component's least node."""
    edges = cut(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "links")
    state = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        # large star: larger neighbours move to the least of the neighbourhood
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: a node and its smaller neighbours move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u")
        small = (moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(moved.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = cut(small, "links")
        now = edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
