"""Written intermediate tables of known size, and connected components of a link table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.session import cut_lineage

ROWS_PER_TASK = 100_000


def tasks_for(n: int, rows: int = ROWS_PER_TASK) -> int:
    return max(1, -(-n // rows))


def written(df: DataFrame, rows: int = ROWS_PER_TASK) -> tuple[DataFrame, int]:
    """Checkpoint of ``df`` and its number of rows, counted while it is written.

    Read back in about one task for ``rows`` rows (never more tasks than it
    was written by), so small tables do not start hundreds of tasks.
    """
    seen = Observation()
    out = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")))
    n = seen.get["n"]
    return out.coalesce(tasks_for(n, rows)), n


@contextmanager
def shuffled_joins(spark: SparkSession) -> Iterator[None]:
    """What is executed inside keeps joins shuffled that are planned so.

    A job of many steps would else turn most of its joins into broadcasts at
    run time: each table is gathered and hashed on the driver, which holds it
    until its garbage is collected, though the rows were shuffled already.
    """
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every id in ``links``; component is the smallest id reachable.

    Alternates two steps until nothing changes. Large star: every larger
    neighbour of a node is linked to the node's smallest neighbour. Small
    star: a node and its smaller neighbours are linked to the smallest of
    them. Both are one aggregate and one join on the link table, so a node
    with very many links is split by the join and summed by the aggregate.
    The number of rounds grows with the logarithm of the longest chain.
    Links with a null end and loops are ignored; no links give no rows.
    """
    edges, n = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                       .where((F.col(a) != F.col(b)) & F.col(a).isNotNull() & F.col(b).isNotNull()).distinct())
    mark = None
    for _ in range(max_rounds):
        width = tasks_for(n)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("low", "u").alias("low"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .coalesce(width).repartition("u"))
        # each node has few links now; the aggregate and the join share the partitioning
        floor = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (large.join(floor, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
                 .unionByName(floor.select("u", F.col("low").alias("v"))).where("u <> v").coalesce(2 * width).distinct())
        # a fingerprint of the whole table shows whether the round changed it
        seen = Observation()
        edges = cut_lineage(small.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))).coalesce(width)
        state = seen.get
        n = state["n"]
        if mark == (n, state["h"]):
            break
        mark = n, state["h"]
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
