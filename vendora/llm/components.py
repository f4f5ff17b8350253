"""Connected components of a distributed edge list by alternating stars.

Each round is two aggregations and joins over the edges; rounds are cut by a written table, so neither
lineage nor driver memory grows. A vertex with very many edges meets them through partial minima.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import shared_dir

#: Rows of one key that a task may meet in :func:`spread_join`.
HOT = 5_000
#: A list of hot keys is broadcast up to this many rows.
HOT_KEYS = 1 << 20


def _saved(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.scratch = path
    return out


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """k, h, t: the id (0 for none), a hash of the text and of whether there is an id, and the text.

    k and h tell texts apart however rows are dealt. Neither is ever null: pandas would turn the ids of a batch that holds
    a null into doubles.
    """
    ident = F.col(key).cast("long")
    return df.select(F.coalesce(ident, F.lit(0)).alias("k"), F.xxhash64(F.col(text), ident.isNull()).alias("h"), F.col(text).alias("t"))


def spread_join(left: DataFrame, right: DataFrame, on: list[str], counts: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one row for each key; keys that ``counts(*on, n)`` gives over HOT rows of ``left`` are dealt over as many tasks as they need.

    Only the list of hot keys is broadcast, if it is short enough; it has a row for each HOT rows of ``left`` at most.
    """
    hot = _saved(counts.filter(F.col("n") > HOT).select(*on, F.ceil(F.col("n") / HOT).cast("int").alias("__parts")), "hot")
    n = hot.count()
    if not n:
        return left.join(right, on, how)
    hot = F.broadcast(hot) if n <= HOT_KEYS else hot
    parts = F.coalesce("__parts", F.lit(1))
    dealt = left.join(hot, on, "left").withColumn("__part", F.pmod(F.xxhash64(*left.columns), parts).cast("int")).drop("__parts")
    copies = right.join(hot, on, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return dealt.join(copies, [*on, "__part"], how).drop("__part")


def free(spark, *tables: DataFrame) -> None:
    """Delete written tables that no later step reads, and let Spark drop the shuffle files of plans that nothing holds any more."""
    jvm = spark._jvm
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``edges(a, b)``; component is the smallest id that can be reached."""
    e = _saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        # every larger neighbour of u, and u itself, is tied to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        # then every smaller neighbour of u
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = _saved(small.filter("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
