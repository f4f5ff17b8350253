"""Segment, distribution and correlation analytics over a customer table.

One-row facts (lowest, highest, counts) come in by a join with the one-row aggregate; nothing is collected.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import positions, quantiles, running, saved


def mean(c: Column, kind: str = "decimal(18,4)") -> Column:
    """A mean whose sum is exact, so that it does not depend on how rows are dealt."""
    return F.sum(c.cast(kind)).cast("double") / F.count(c)


def corr(x: Column, y: Column) -> Column:
    """Pearson's r; null, not an error, where a side is constant. Both sides must be null together."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def prepare(df: DataFrame, numeric: list[str], categories: list[str]) -> DataFrame:
    """Lower-case names; missing columns come in as null numbers and 'Missing' categories; infinite numbers become null."""
    from ..functions.scalars import category_clean, finite

    df = df.toDF(*(c.strip().lower() for c in df.columns))
    have = set(df.columns)
    num = {c: finite(F.col(c).try_cast("double")) if c in have else F.lit(None).cast("double") for c in numeric}
    cat = {c: category_clean(F.col(c).cast("string")) if c in have else F.lit("Missing") for c in categories}
    return df.withColumns(num | cat)


def segment_filter(df: DataFrame, members: dict[str, list[str]], ranges: dict[str, tuple[float, float]]) -> DataFrame:
    """Memberships and ranges; a range at the column's full extent keeps nulls too."""
    for c, values in members.items():
        df = df.filter(F.col(c).isin(*values))
    if not ranges:
        return df
    extent = df.agg(*(x for c in ranges for x in (F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}"))))
    cols = df.columns
    df = df.crossJoin(F.broadcast(extent))
    for c, (lo, hi) in ranges.items():
        df = df.filter(F.col(c).between(lo, hi) | (F.col(c).isNull() & (F.lit(lo) <= F.col(f"__lo_{c}")) & (F.lit(hi) >= F.col(f"__hi_{c}"))))
    return df.select(*cols)


def kpis(part: DataFrame, whole: DataFrame) -> DataFrame:
    """Size, share of all, churn rate and its distance from all in points, high-risk retained, mean charge, revenue (null without a value)."""
    rate = F.try_divide(F.count_if(F.col("churn_flag") == 1) * 100.0, F.count("*"))
    a = part.agg(
        F.count("*").alias("customers"), rate.alias("churn_rate"), F.count_if((F.col("churn_flag") == 0) & (F.col("churn_score") >= 70)).alias("high_risk_retained"),
        mean(F.col("monthly_charges")).alias("mean_charge"), F.sum(F.col("total_revenue").cast("decimal(18,2)")).cast("double").alias("revenue"),
    )
    b = whole.agg(F.count("*").alias("n_all"), rate.alias("base_rate"))
    out = a.crossJoin(b)
    return out.withColumn("share_pct", F.try_divide(F.col("customers") * 100.0, F.col("n_all"))).withColumn("delta_pp", F.col("churn_rate") - F.col("base_rate")).drop("n_all", "base_rate")


def segment_rollup(df: DataFrame, levels: list[str], null_as_zero: bool = False) -> DataFrame:
    """Totals at every level of a hierarchy. With ``null_as_zero``, means count a missing value as zero."""
    v = (lambda c: F.coalesce(F.col(c), F.lit(0))) if null_as_zero else F.col
    return df.rollup(*levels).agg(
        F.grouping_id().cast("long").alias("level"), F.count("*").alias("customers"), mean(F.col("churn_flag")).alias("churn_rate"), mean(v("monthly_charges")).alias("avg_charge"),
        F.sum(F.col("total_revenue").cast("decimal(18,2)")).cast("double").alias("revenue"), mean(v("satisfaction")).alias("avg_satisfaction"),
    )


def flow_links(df: DataFrame, stages: list[str]) -> DataFrame:
    """(stage, source, target, customers) between neighbouring stages, in one pass."""
    pairs = F.array(*(F.struct(F.lit(i).alias("stage"), F.col(a).alias("source"), F.col(b).alias("target")) for i, (a, b) in enumerate(zip(stages, stages[1:], strict=False))))
    return df.select(F.explode(pairs).alias("x")).groupBy("x.stage", "x.source", "x.target").agg(F.count("*").alias("customers"))


def risk_matrix(df: DataFrame) -> DataFrame:
    """Contract by rounded satisfaction 1-5; labelled if the cell is not among the smallest quarter."""
    cell = F.least(F.greatest(F.bround("satisfaction"), F.lit(1)), F.lit(5)).cast("int")
    m = df.filter("satisfaction IS NOT NULL").groupBy("contract", cell.alias("satisfaction_display")).agg(
        F.count("*").alias("customers"), mean(F.col("churn_flag")).alias("churn_rate"), mean(F.col("monthly_charges")).alias("avg_charge"), mean(F.col("churn_score")).alias("avg_risk"))
    q1 = m.agg(F.greatest(F.lit(2), F.floor(F.percentile("customers", F.lit(0.25)))).alias("least"))
    return m.crossJoin(F.broadcast(q1)).withColumn("labelled", F.col("customers") >= F.col("least")).drop("least")


def binary_adoption(df: DataFrame, flags: list[str]) -> DataFrame:
    """feature, answered, yes, yes_pct from a wide table of flags."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("int").alias("v")) for c in flags))).alias("x"))
    v = F.col("x.v")
    return long.groupBy("x.feature").agg(F.count(v).alias("answered"), F.count_if(v == 1).alias("yes"), F.try_divide(F.count_if(v == 1) * 100.0, F.count(v)).alias("yes_pct"))


def by_category(df: DataFrame, category: str, value: str, missing: str = "Missing") -> DataFrame:
    """Mean and median by category, without the missing one unless there is no other."""
    out = df.groupBy(category).agg(F.count(value).alias("n"), mean(F.col(value)).alias("mean"))
    middle = quantiles(df, value, [0.5], [category]).select(F.col(category).alias("__c"), F.col("q0").alias("median"))
    out = out.join(middle, F.col(category).eqNullSafe(F.col("__c")), "left").drop("__c")
    known = out.agg(F.count_if(F.col(category) != missing).alias("known"))
    return out.crossJoin(F.broadcast(known)).filter((F.col(category) != missing) | (F.col("known") == 0)).drop("known")


def share_of_total(df: DataFrame, by: str, flag: Column) -> DataFrame:
    g = df.groupBy(by).agg(F.count("*").alias("n"), F.count_if(flag).alias("hits"))
    total = g.agg(F.sum("hits").alias("all_hits"))
    return g.crossJoin(F.broadcast(total)).select(by, "n", "hits", F.try_divide(F.col("hits") * 100.0, F.col("n")).alias("rate"), F.try_divide(F.col("hits") * 100.0, F.col("all_hits")).alias("share"))


def composition(df: DataFrame, by: str, outcomes: list[str], outcome: str) -> DataFrame:
    """Counts of each outcome in a fixed order for each group, absent ones as zero."""
    return df.groupBy(by).agg(*(F.count_if(F.col(outcome) == o).alias(o) for o in outcomes))


def histogram(df: DataFrame, value: str, by: str, bins: int) -> DataFrame:
    """Equal-width bins over the whole extent: bin (from 1), count and density for each group."""
    known = df.filter(F.col(value).isNotNull())
    ends = known.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    x = known.crossJoin(F.broadcast(ends))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), 1).otherwise(F.least(F.floor(F.try_divide(F.col(value) - F.col("lo"), width)) + 1, F.lit(bins))).cast("int")
    counts = x.groupBy(by, b.alias("bin")).agg(F.count("*").alias("n"), F.first(width).alias("w"))
    total = known.groupBy(by).agg(F.count("*").alias("of"))
    return counts.join(total, by).select(by, "bin", "n", F.try_divide(F.col("n").cast("double"), F.col("of") * F.col("w")).alias("density"))


def distribution_summary(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, mean and values beyond 1.5 times the interquartile range."""
    parts = quantiles(df, value, [0.25, 0.5, 0.75], [by]).select(F.col(by).alias("__b"), F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = df.groupBy(by).agg(F.count(value).alias("n"), mean(F.col(value)).alias("mean"))
    q = saved(q.join(parts, F.col(by).eqNullSafe(F.col("__b")), "left").drop("__b"), "quartiles")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    far = df.join(q.select(by, "q1", "q3"), by).filter((F.col(value) < F.col("q1") - reach) | (F.col(value) > F.col("q3") + reach)).groupBy(by).agg(F.count("*").alias("outliers"))
    return q.join(far, by, "left").withColumn("outliers", F.coalesce("outliers", F.lit(0)))


def gini(df: DataFrame, value: str) -> DataFrame:
    """Gini coefficient of a column clipped at zero, from distinct values and a two-pass running count; 0 if empty or all zero."""
    v = F.greatest(F.col(value).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    c = df.filter(F.col(value).isNotNull()).groupBy(v.alias("v")).agg(F.count("*").alias("c"))
    r = running(c, ["v"], {"upto": F.col("c")})
    before = F.col("upto") - F.col("c")
    ranked = F.col("v") * (F.col("c") * before + F.col("c") * (F.col("c") + 1) / 2).cast("decimal(20,0)")
    s = r.agg(F.sum(ranked).cast("double").alias("s"), F.sum(F.col("v") * F.col("c")).cast("double").alias("t"), F.sum("c").alias("n"))
    n = F.col("n").cast("double")
    return s.select(F.when((F.coalesce(n, F.lit(0.0)) == 0) | (F.col("t") == 0), 0.0).otherwise(F.try_divide(2 * F.col("s"), n * F.col("t")) - F.try_divide(n + 1, n)).alias("gini"))


def lorenz(df: DataFrame, value: str, points: int = 350) -> DataFrame:
    """(population, share): cumulative shares by value, thinned to at most ``points`` and the last."""
    v = F.greatest(F.col(value).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))
    c = df.filter(F.col(value).isNotNull()).groupBy(v.alias("v")).agg(F.count("*").alias("c"))
    r = saved(running(c, ["v"], {"upto": F.col("c"), "sum": F.col("v") * F.col("c"), "rank": F.lit(1)}), "lorenz")
    top = r.agg(F.max("upto").alias("n"), F.max("sum").alias("t"), F.max("rank").alias("k"))
    step = F.greatest(F.ceil(F.col("k") / (points - 1)), F.lit(1))
    out = r.crossJoin(F.broadcast(top)).filter((F.col("rank") % step == 0) | (F.col("rank") == F.col("k")))
    return out.select((F.col("upto").cast("double") / F.col("n")).alias("population"), F.try_divide(F.col("sum").cast("double"), F.col("t").cast("double")).alias("share"))


def pearson_pairs(df: DataFrame, columns: list[str], least: int | None = None) -> DataFrame:
    """a, b, r, n for all pairs in one aggregate; null r under the least number of complete pairs or for a constant column."""
    pairs = list(combinations(columns, 2))
    both = {(a, b): F.col(a).isNotNull() & F.col(b).isNotNull() for a, b in pairs}
    aggs = [F.count("*").alias("__all")]
    for i, (a, b) in enumerate(pairs):
        x, y = F.when(both[a, b], F.col(a)), F.when(both[a, b], F.col(b))
        aggs += [corr(x, y).alias(f"r{i}"), F.count_if(both[a, b]).alias(f"n{i}"), ((F.max(x) > F.min(x)) & (F.max(y) > F.min(y))).alias(f"v{i}")]
    one = df.agg(*aggs)
    need = F.lit(least) if least is not None else F.least(F.col("__all"), F.greatest(F.lit(3), F.least(F.lit(30), F.floor(F.col("__all") / 10))))
    rows = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.when(F.col(f"v{i}") & (F.col(f"n{i}") >= need), F.col(f"r{i}")).alias("r"), F.col(f"n{i}").alias("n")) for i, (a, b) in enumerate(pairs)))
    return one.select(F.explode(rows).alias("p")).select("p.a", "p.b", "p.r", "p.n")


def average_rank(df: DataFrame, column: str, out: str) -> DataFrame:
    """value -> average rank, ties sharing theirs, by the two-pass running count."""
    c = df.groupBy(column).agg(F.count("*").alias("c"))
    return running(c, [column], {"upto": F.col("c")}).select(column, (F.col("upto") - (F.col("c") - 1) / 2).alias(out))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    ranked = both.join(average_rank(both, a, "__ra"), a).join(average_rank(both, b, "__rb"), b)
    return ranked.agg(corr(F.col("__ra"), F.col("__rb")).alias("rho"), F.count("*").alias("n"))


def group_fit(df: DataFrame, by: str, x: str, y: str, least: int = 10) -> DataFrame:
    """Least-squares line of each group with enough rows and two different x."""
    g = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(by).agg(
        F.count("*").alias("n"), F.try_divide(F.covar_pop(x, y), F.var_pop(x)).alias("slope"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.min(x).alias("x0"), F.max(x).alias("x1"))
    g = g.withColumn("intercept", F.col("my") - F.col("slope") * F.col("mx")).drop("mx", "my")
    return g.filter((F.col("n") >= least) & (F.col("x1") > F.col("x0"))).withColumn("y0", F.col("intercept") + F.col("slope") * F.col("x0")).withColumn("y1", F.col("intercept") + F.col("slope") * F.col("x1"))


def correlation_network(pairs: DataFrame, target: str, threshold: float, direct: int = 8, nodes: int = 14) -> DataFrame:
    """Edges among the nodes nearest to the target and those of the strongest pairs. ``pairs`` is the small table of :func:`pearson_pairs`."""
    sides = pairs.filter("r IS NOT NULL").withColumn("other", F.when(F.col("a") == target, F.col("b")).when(F.col("b") == target, F.col("a")))
    strength = F.abs("r")
    near = sides.filter("other IS NOT NULL").withColumn("s", strength).orderBy(F.desc("s"), "other").limit(direct).select(F.col("other").alias("node"), F.lit(0).alias("wave"), (-F.col("s")).alias("o"))
    # nodes of other pairs join by their strongest pair, in order of that pair
    rest = sides.filter("other IS NULL").withColumn("s", strength).select("s", F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.lit(1).alias("wave"), (-F.max("s")).alias("o"))
    chosen = near.unionByName(rest).groupBy("node").agg(F.min(F.struct("wave", "o", "node")).alias("k")).orderBy("k").limit(nodes - 1).select("node")
    chosen = chosen.unionByName(pairs.sparkSession.createDataFrame([(target,)], "node string"))
    edges = pairs.filter(strength >= threshold)
    return edges.join(chosen.withColumnRenamed("node", "a"), "a", "left_semi").join(chosen.withColumnRenamed("node", "b"), "b", "left_semi").select("a", "b", "r")


def hotspot(df: DataFrame, by: list[str]) -> DataFrame:
    """The segment with the highest churn rate among those with at least max(5, 1 %) rows, or among all if none has."""
    g = df.groupBy(*by).agg(F.count("*").alias("customers"), F.count_if(F.col("churn_flag") == 1).alias("hits")).withColumn("churn_rate", F.col("hits") / F.col("customers"))
    n = df.agg(F.greatest(F.lit(5), F.ceil(F.count("*") * 0.01)).alias("least"))
    return g.crossJoin(F.broadcast(n)).orderBy(F.desc(F.col("customers") >= F.col("least")), F.desc("churn_rate"), F.desc("customers"), *by).limit(1).select(*by, "customers", "churn_rate")


def top_and_other(df: DataFrame, column: str, keep: int = 3, when_over: int = 4) -> DataFrame:
    """``df`` with ``grouped``: the most frequent values and 'Other', if there are more than ``when_over`` of them."""
    counts = df.groupBy(column).agg(F.count("*").alias("__n"))
    best = counts.orderBy(F.desc("__n"), column).limit(keep).select(column, F.lit(True).alias("__top"))
    how_many = counts.agg(F.count("*").alias("__k"))
    out = df.join(best, column, "left").crossJoin(F.broadcast(how_many))
    return out.withColumn("grouped", F.when((F.col("__k") <= when_over) | F.col("__top"), F.col(column)).otherwise("Other")).drop("__top", "__k")


def scaled(df: DataFrame, value: str, out: str = "scaled") -> DataFrame:
    """Square root of the min-max position; missing values stand at the median; 0 for a constant column."""
    facts = df.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi")).join(quantiles(df, value, [0.5]).select(F.col("q0").alias("__mid")), how="left")
    x = F.coalesce(F.col(value), F.col("__mid"))
    return df.crossJoin(F.broadcast(facts)).withColumn(out, F.coalesce(F.sqrt(F.try_divide(x - F.col("__lo"), F.col("__hi") - F.col("__lo"))), F.lit(0.0))).drop("__lo", "__hi", "__mid")


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows by a hash of their key: the same whatever the partitions are."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


def hash_jitter(key: Column) -> Column:
    part = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % 1000
    return (part / 1000 - 0.5) * 0.18


def preferred_order(df: DataFrame, column: str, preferred: list[str]) -> DataFrame:
    """Distinct values, the preferred ones first in their order, the others by the alphabet; ``position`` from 1."""
    values = df.select(column).distinct()
    at = F.array_position(F.array(*map(F.lit, preferred)), F.col(column))
    return positions(values.withColumn("__at", F.when(at > 0, at).otherwise(len(preferred) + 1)), ["__at", column]).drop("__at")
