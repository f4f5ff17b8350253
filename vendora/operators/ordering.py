"""Global positions and running sums without a single-partition window.

Rows are dealt by ranges of the key and written once, so that ranges are fixed; each range is numbered on its own and
shifted by what lies before it, which is one row for each range.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shared_dir(spark, name: str) -> str:
    """A new folder in the one that all nodes share: spark.checkpoint.dir, which only a local session may leave unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all nodes share")
        base = f"{tempfile.gettempdir()}/vendora-checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in the shared folder: lineage ends here, and a lost executor loses nothing."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def running(df: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with inclusive running sums over the global order, which must be total for the result to be definite."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = saved(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    whole = dealt.groupBy("__part").agg(*(F.sum(c).alias(f"__t{i}") for i, c in enumerate(sums.values())))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    whole = whole.select("__part", *(F.coalesce(F.sum(f"__t{i}").over(before), F.lit(0)).alias(f"__b{i}") for i in range(len(sums))))
    own = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = dealt.join(F.broadcast(whole), "__part")
    for i, (name, c) in enumerate(sums.items()):
        out = out.withColumn(name, F.sum(c).over(own) + F.col(f"__b{i}"))
    return out.drop("__part", *(f"__b{i}" for i in range(len(sums))))


def running_by(df: DataFrame, group: list[str], order: list[str], name: str, amount: Column) -> DataFrame:
    """``df`` with the inclusive running sum of a non-negative amount within each group, however large one is: the global running sum less what lies before the group.

    Calling it writes a table, as :func:`running` does.
    """
    r = running(df, [*group, *order], {"__run": amount}).withColumn("__before", F.col("__run") - amount)
    start = r.groupBy(*(F.col(g).alias(f"__{g}") for g in group)).agg(F.min("__before").alias("__start"))
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    return r.join(start, same).withColumn(name, F.col("__run") - F.col("__start")).drop("__run", "__before", "__start", *(f"__{g}" for g in group))


def quantiles(df: DataFrame, value: str, at: list[float], by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The group, n and q0, q1, ...: exact quantiles, interpolated between neighbours, of the values that are not null.

    Values are counted and the counts summed over a range partitioning, so no task holds a group's values. Calling it writes a table.
    """
    c = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("__v")).agg(F.count("*").alias("__c"))
    r = running(c, [*by, "__v"], {"__upto": F.col("__c")})
    ends = r.groupBy(*(F.col(b).alias(f"__{b}") for b in by)).agg(F.min(F.col("__upto") - F.col("__c")).alias("__from"), F.sum("__c").alias("n"))
    r = r.join(ends, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by]) if by else r.crossJoin(F.broadcast(ends))  # one row
    first, last = F.col("__upto") - F.col("__c") - F.col("__from"), F.col("__upto") - F.col("__from")
    out, shown = [], []
    for i, q in enumerate(at):
        place = F.lit(q) * (F.col("n") - 1)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            out.append(F.max(F.when((first <= rank) & (rank < last), F.col("__v"))).alias(f"__{side}{i}"))
        part = place - F.floor(place)
        shown.append(F.when(part == 0, F.col(f"__lo{i}")).otherwise((1 - part) * F.col(f"__lo{i}") + part * F.col(f"__hi{i}")).alias(f"q{i}"))
    return r.groupBy(*by, "n").agg(*out).select(*by, "n", *shown)


def positions(df: DataFrame, order: list[str], out: str = "position") -> DataFrame:
    """1-based global position."""
    return running(df, order, {out: F.lit(1)}).withColumn(out, F.col(out).cast("long"))


def position_range(df: DataFrame, order: list[str], first: int = 1, last: int | None = None, limit: int | None = None) -> DataFrame:
    """Rows from first to last, both inclusive; a limit is a length."""
    if limit is not None:
        last = min(last, first + limit - 1) if last is not None else first + limit - 1
    if first < 1 or (last is not None and last < first):
        raise ValueError(f"not a range: {first}..{last}")
    out = positions(df, order)
    return out.filter(F.col("position") >= first) if last is None else out.filter(F.col("position").between(first, last))
