"""Connected components of an edge table by alternating star steps; every step is a join and a combined minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.session import ensure_checkpoint_dir

#: Edges for each task at least; a small graph on many shuffle partitions would leave thousands of tiny files a round.
TASK_EDGES = 50_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(node, root)`` for every node of an edge, ``root`` the smallest node of its component.

    Large stars hang all larger neighbours of a node on its least neighbour, small stars all others; the edge set
    never grows in total and settles after a number of rounds that is logarithmic in the longest chain. Each round is
    checkpointed in the shared folder. Self loops keep single nodes in the result; nulls are left out.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    whole = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = whole.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
    pairs = pairs.distinct().checkpoint()
    before, parts = None, max(1, pairs.count() // TASK_EDGES)
    while True:
        both = pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        # large star: each edge seen from its smaller end moves to the least neighbour of that end
        large = pairs.join(least, pairs.lo == least.u).select(F.least("m", "hi").alias("lo"), F.greatest("m", "hi").alias("hi"))
        large = large.unionAll(least.select(F.col("m").alias("lo"), F.col("u").alias("hi"))).distinct().coalesce(parts)
        # small star: every smaller neighbour of a node moves to the least of them
        below = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(below, "hi").select(F.least("m", "lo").alias("lo"), F.greatest("m", "lo").alias("hi"))
        pairs = small.unionAll(below.select(F.col("m").alias("lo"), "hi")).distinct().coalesce(parts).checkpoint()
        # settled once no root hangs on another node: compare order-free digests of two rounds
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("s")).first()
        if before == now:
            break
        before = now
    return pairs.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root"))
