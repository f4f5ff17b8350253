"""Retention queries: customers with their orders; segment is the contract, region the service, nation the city."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import retention as op
from .registry import query, table

FACTS = """(SELECT c_custkey AS customer_id, c_mktsegment AS contract, r_name AS service, n_name AS city, c_acctbal AS monthly_charges, o.total_revenue, o.orders AS tenure_months,
  CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS churn_flag, CAST(c_custkey * 37 % 101 AS DOUBLE) AS churn_score, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 1 + (c_custkey % 9) * 0.5::DOUBLE END AS satisfaction
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total_revenue, CAST(count(*) AS DOUBLE) AS orders FROM orders GROUP BY 1) o ON o_custkey = c_custkey)"""


def facts(spark, d):
    geo = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    spent = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(14,2)")).cast("double").alias("total_revenue"), F.count("*").cast("double").alias("tenure_months"))
    c = table(spark, d, "customer").join(geo, F.col("c_nationkey") == F.col("n_nationkey")).join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    k = F.col("c_custkey")
    return c.select(
        k.alias("customer_id"), F.col("c_mktsegment").alias("contract"), F.col("r_name").alias("service"), F.col("n_name").alias("city"), F.col("c_acctbal").alias("monthly_charges"), "total_revenue", "tenure_months",
        F.when(k % 4 == 0, 1).otherwise(0).alias("churn_flag"), (k * 37 % 101).cast("double").alias("churn_score"), F.when(k % 11 != 0, 1 + (k % 9) * 0.5).cast("double").alias("satisfaction"),
    )


def _mean(c: str) -> str:
    return f"CAST(sum(CAST({c} AS DECIMAL(18,4))) AS DOUBLE) / count({c})"


_SEG = "contract IN ('BUILDING', 'HOUSEHOLD') AND monthly_charges BETWEEN -500 AND 9000"


def _segment(spark, d):
    return op.segment_filter(facts(spark, d), {"contract": ["BUILDING", "HOUSEHOLD"]}, {"monthly_charges": (-500, 9000), "satisfaction": (0, 10)})


@query(f"SELECT customer_id FROM {FACTS} WHERE {_SEG}")
def segment_filter(spark, d):
    """A set and two ranges; the second is at full extent and keeps nulls."""
    return _segment(spark, d).select("customer_id")


@query(f"""WITH f AS (SELECT * FROM {FACTS}), s AS (SELECT * FROM f WHERE {_SEG})
SELECT count(*) AS customers, sum(churn_flag) * 100.0::DOUBLE / count(*) AS churn_rate, count(*) FILTER (churn_flag = 0 AND churn_score >= 70) AS high_risk_retained, {_mean('monthly_charges')} AS mean_charge,
  CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM f) AS share_pct,
  sum(churn_flag) * 100.0::DOUBLE / count(*) - (SELECT sum(churn_flag) * 100.0::DOUBLE / count(*) FROM f) AS delta_pp FROM s""")
def retention_kpis(spark, d):
    return op.kpis(_segment(spark, d), facts(spark, d))


@query(f"""SELECT contract, service, grouping(contract, service)::BIGINT AS level, count(*) AS customers, {_mean('churn_flag')} AS churn_rate, {_mean('monthly_charges')} AS avg_charge,
  CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue, {_mean('satisfaction')} AS avg_satisfaction FROM {FACTS} GROUP BY ROLLUP (contract, service)""")
def segment_rollup(spark, d):
    return op.segment_rollup(facts(spark, d), ["contract", "service"])


@query(f"""SELECT 0 AS stage, contract AS source, service AS target, count(*) AS customers FROM {FACTS} GROUP BY ALL
UNION ALL SELECT 1, service, CAST(churn_flag AS VARCHAR), count(*) FROM {FACTS} GROUP BY ALL""")
def flow_links(spark, d):
    return op.flow_links(facts(spark, d).withColumn("outcome", F.col("churn_flag").cast("string")), ["contract", "service", "outcome"])


@query(f"""WITH m AS (SELECT contract, CAST(least(greatest(round_even(satisfaction, 0), 1), 5) AS INTEGER) AS satisfaction_display, count(*) AS customers, {_mean('churn_flag')} AS churn_rate,
  {_mean('monthly_charges')} AS avg_charge, {_mean('churn_score')} AS avg_risk FROM {FACTS} WHERE satisfaction IS NOT NULL GROUP BY ALL)
SELECT *, customers >= greatest(2, floor((SELECT quantile_cont(customers, 0.25) FROM m))) AS labelled FROM m""")
def risk_matrix(spark, d):
    return op.risk_matrix(facts(spark, d))


_FLAGS = {"returned": "l_returnflag = 'R'", "filled": "l_linestatus = 'F'", "cheap": "l_discount > 0.05"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS feature, count(*) AS answered, count(*) FILTER ({v}) AS yes, count(*) FILTER ({v}) * 100.0::DOUBLE / count(*) AS yes_pct FROM lineitem" for k, v in _FLAGS.items()))
def binary_adoption(spark, d):
    return op.binary_adoption(table(spark, d, "lineitem").select(*(F.expr(v).alias(k) for k, v in _FLAGS.items())), list(_FLAGS))


@query(f"SELECT contract, count(monthly_charges) AS n, {_mean('monthly_charges')} AS mean, median(monthly_charges) AS median FROM {FACTS} WHERE contract <> 'BUILDING' GROUP BY contract")
def mean_median_by_category(spark, d):
    return op.by_category(facts(spark, d), "contract", "monthly_charges", missing="BUILDING")


@query(f"SELECT contract, count(*) AS n, sum(churn_flag)::BIGINT AS hits, sum(churn_flag) * 100.0::DOUBLE / count(*) AS rate, sum(churn_flag) * 100.0::DOUBLE / (SELECT sum(churn_flag) FROM {FACTS}) AS share FROM {FACTS} GROUP BY contract")
def share_of_total(spark, d):
    return op.share_of_total(facts(spark, d), "contract", F.col("churn_flag") == 1)


@query(f"SELECT service, sum(churn_score)::BIGINT AS total, count(churn_score) AS n, {_mean('churn_score')} AS mean FROM {FACTS} GROUP BY service")
def sum_mean_by_status(spark, d):
    return facts(spark, d).groupBy("service").agg(F.sum("churn_score").cast("long").alias("total"), F.count("churn_score").alias("n"), op.mean(F.col("churn_score")).alias("mean"))


@query("SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'P') AS P, count(*) FILTER (o_orderstatus = 'X') AS X FROM orders GROUP BY 1")
def outcome_composition(spark, d):
    """Outcomes in a fixed order, one of which never occurs."""
    return op.composition(table(spark, d, "orders").withColumnRenamed("o_orderpriority", "priority"), "priority", ["O", "F", "P", "X"], "o_orderstatus")


@query(f"SELECT city, count(*) AS customers, count(*) FILTER (churn_flag = 1 AND churn_score > 95) AS subset FROM {FACTS} GROUP BY city")
def base_vs_subset(spark, d):
    return facts(spark, d).groupBy("city").agg(F.count("*").alias("customers"), F.count_if((F.col("churn_flag") == 1) & (F.col("churn_score") > 95)).alias("subset"))


@query(f"""WITH f AS (SELECT contract, churn_score AS v FROM {FACTS}), e AS (SELECT min(v) AS lo, max(v) AS hi FROM f), n AS (SELECT contract, count(*) AS of FROM f GROUP BY 1)
SELECT contract, bin, c AS n, c / (of * w) AS density FROM (SELECT contract, CAST(least(floor((v - lo) / ((hi - lo) / 22)) + 1, 22) AS INTEGER) AS bin, count(*) AS c, any_value((hi - lo) / 22) AS w FROM f, e GROUP BY ALL) JOIN n USING (contract)""")
def histogram(spark, d):
    return op.histogram(facts(spark, d), "churn_score", "contract", 22)


@query(f"""WITH f AS (SELECT contract, monthly_charges AS v FROM {FACTS}), q AS (SELECT contract, count(v) AS n, {_mean('v')} AS mean, quantile_cont(v, 0.25) AS q1, median(v) AS median, quantile_cont(v, 0.75) AS q3 FROM f GROUP BY 1)
SELECT q.contract, n, round(mean, 6) AS mean, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, (SELECT count(*) FROM f WHERE f.contract = q.contract AND (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))) AS outliers FROM q""")
def distribution_summary(spark, d):
    out = op.distribution_summary(facts(spark, d), "monthly_charges", "contract")
    return out.select("contract", "n", *(F.round(c, 6).alias(c) for c in ("mean", "q1", "median", "q3")), "outliers")


@query("""WITH x AS (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS v, row_number() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(18,2)), o_orderkey) AS i FROM orders)
SELECT round(2 * CAST(sum(v * i) AS DOUBLE) / (count(*) * CAST(sum(v) AS DOUBLE)) - (count(*) + 1) / count(*), 9) AS gini FROM x""")
def gini(spark, d):
    return op.gini(table(spark, d, "orders"), "o_totalprice").select(F.round("gini", 9).alias("gini"))


@query("""WITH g AS (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS v, count(*) AS c FROM orders GROUP BY 1), r AS (SELECT sum(c) OVER (ORDER BY v) AS upto, sum(v * c) OVER (ORDER BY v) AS s, row_number() OVER (ORDER BY v) AS rank, count(*) OVER () AS k FROM g)
SELECT CAST(upto AS DOUBLE) / max(upto) OVER () AS population, CAST(s AS DOUBLE) / CAST(max(s) OVER () AS DOUBLE) AS share FROM r QUALIFY rank % greatest(CAST(ceil(k / 349) AS BIGINT), 1) = 0 OR rank = k""")
def lorenz(spark, d):
    """A curve of at most 350 points."""
    return op.lorenz(table(spark, d, "orders"), "o_totalprice")


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(_NUM) for b in _NUM[i + 1 :]]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r, count(*) AS n FROM lineitem" for a, b in _PAIRS))
def pearson_pairs(spark, d):
    return op.pearson_pairs(table(spark, d, "lineitem"), _NUM).withColumn("r", F.round("r", 6))


@query("SELECT round(corr(ra, rb), 6) AS rho, count(*) AS n FROM (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS ra, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS rb FROM lineitem)")
def spearman(spark, d):
    return op.spearman(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice").withColumn("rho", F.round("rho", 6))


@query("SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, min(l_quantity) AS x0, max(l_quantity) AS x1 FROM lineitem GROUP BY 1 HAVING count(*) >= 10")
def group_fit(spark, d):
    out = op.group_fit(table(spark, d, "lineitem"), "l_returnflag", "l_quantity", "l_extendedprice")
    return out.select("l_returnflag", "n", F.round("slope", 5).alias("slope"), F.round("intercept", 4).alias("intercept"), "x0", "x1")


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem HAVING abs(corr({a}, {b})) >= 0.002" for a, b in _PAIRS))
def corr_network(spark, d):
    return op.correlation_network(op.pearson_pairs(table(spark, d, "lineitem"), _NUM), "l_extendedprice", 0.002).withColumn("r", F.round("r", 6))


@query(f"""WITH g AS (SELECT contract, service, count(*) AS customers, sum(churn_flag)::DOUBLE / count(*) AS churn_rate FROM {FACTS} GROUP BY ALL)
SELECT * FROM g ORDER BY customers >= greatest(5, ceil((SELECT count(*) FROM {FACTS}) * 0.01)) DESC, churn_rate DESC, customers DESC, contract, service LIMIT 1""")
def hotspot(spark, d):
    """The one segment with the highest rate."""
    return op.hotspot(facts(spark, d), ["contract", "service"])


@query(f"""WITH t AS (SELECT contract FROM {FACTS} GROUP BY 1 ORDER BY count(*) DESC, contract LIMIT 3)
SELECT CASE WHEN contract IN (SELECT contract FROM t) THEN contract ELSE 'Other' END AS grouped, count(*) AS customers FROM {FACTS} GROUP BY 1""")
def top3_other(spark, d):
    return op.top_and_other(facts(spark, d), "contract").groupBy("grouped").agg(F.count("*").alias("customers"))


@query(f"WITH f AS (SELECT customer_id, satisfaction AS v FROM {FACTS}) SELECT customer_id, sqrt((coalesce(v, (SELECT median(v) FROM f)) - (SELECT min(v) FROM f)) / ((SELECT max(v) FROM f) - (SELECT min(v) FROM f))) AS scaled FROM f")
def scaled_measure(spark, d):
    return op.scaled(facts(spark, d), "satisfaction").select("customer_id", "scaled")


@query("SELECT c_custkey AS customer_id FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':42'), c_custkey LIMIT 200")
def hash_sample(spark, d):
    """A seeded sample of 200 rows: a sampling operator."""
    return op.hash_sample(table(spark, d, "customer"), "c_custkey", 200).select(F.col("c_custkey").alias("customer_id"))


@query("SELECT c_custkey AS customer_id, (('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT % 1000 / 1000 - 0.5::DOUBLE) * 0.18::DOUBLE AS jitter FROM customer")
def hash_jitter(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"), op.hash_jitter(F.col("c_custkey")).alias("jitter"))


@query("SELECT DISTINCT c_mktsegment AS value, CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 2 + dense_rank() OVER (PARTITION BY c_mktsegment NOT IN ('MACHINERY', 'BUILDING') ORDER BY c_mktsegment) END::BIGINT AS position FROM customer")
def preferred_order(spark, d):
    return op.preferred_order(table(spark, d, "customer").select(F.col("c_mktsegment").alias("value")), "value", ["MACHINERY", "BUILDING"])


@query("SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 THEN 'Missing' ELSE c_mktsegment END AS contract, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal END AS charge, 'Missing' AS gender FROM customer")
def category_prepare(spark, d):
    k = F.col("c_custkey")
    raw = table(spark, d, "customer").select(
        k.alias(" Customer_ID "), F.when(k % 5 == 0, "nan").when(k % 7 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("CONTRACT"), F.when(k % 3 == 0, float("inf")).otherwise(F.col("c_acctbal")).alias("Charge"))
    return op.prepare(raw, ["charge"], ["contract", "gender"]).select("customer_id", "contract", "charge", "gender")


@query(f"""SELECT customer_id, CASE WHEN churn_score < 30 THEN 'Low risk' WHEN churn_score < 70 THEN 'Medium risk' ELSE 'High risk' END AS risk,
  CASE WHEN satisfaction IS NULL THEN 'Unknown' WHEN satisfaction < 2.5 THEN 'Low' WHEN satisfaction < 3.5 THEN 'Neutral' WHEN satisfaction < 4.5 THEN 'Good' ELSE 'Excellent' END AS satisfaction_band,
  CASE WHEN tenure_months IS NULL THEN 'Unknown' WHEN tenure_months < 6 THEN '0-5' WHEN tenure_months < 12 THEN '6-11' WHEN tenure_months < 24 THEN '12-23' WHEN tenure_months < 48 THEN '24-47' ELSE '48+' END AS tenure_band FROM {FACTS}""")
def bands(spark, d):
    return facts(spark, d).select(
        "customer_id", s.band(F.col("churn_score"), [30, 70], ["Low risk", "Medium risk", "High risk"], "Unknown risk").alias("risk"),
        s.band(F.col("satisfaction"), [2.5, 3.5, 4.5], ["Low", "Neutral", "Good", "Excellent"]).alias("satisfaction_band"),
        s.band(F.col("tenure_months"), [6, 12, 24, 48], ["0-5", "6-11", "12-23", "24-47", "48+"]).alias("tenure_band"),
    )


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END WHEN o_orderkey % 3 = 1 THEN 1 ELSE 0 END AS churn_flag FROM orders")
def churn_flags(spark, d):
    """Flags from text, from numbers, and from the status where the flag is blank."""
    k = F.col("o_orderkey")
    flag = F.when(k % 3 == 0, "").when(k % 3 == 1, " Yes ").otherwise("0.0")
    status = F.when(F.col("o_orderstatus") == "F", "Churned").otherwise("Stayed")
    return table(spark, d, "orders").select(k.alias("id"), s.churn_flag(flag, status).alias("churn_flag"))


@query("SELECT p_partkey AS product_id FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND (CASE WHEN p_size % 4 = 0 THEN 'Unknown' ELSE p_type END) IN ('Unknown', 'ECONOMY') AND (p_size % 9 = 0 OR p_size BETWEEN 5 AND 40) AND p_retailprice < 1500")
def product_filter(spark, d):
    """Companies, screens with null as Unknown, years with nulls kept, and a flag."""
    size = F.col("p_size")
    p = table(spark, d, "part").withColumn("screen", F.when(size % 4 != 0, F.col("p_type"))).withColumn("year", F.when(size % 9 != 0, size))
    keep = F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3") & F.coalesce("screen", F.lit("Unknown")).isin("Unknown", "ECONOMY") & (F.col("year").isNull() | F.col("year").between(5, 40)) & (F.col("p_retailprice") < 1500)
    return p.filter(keep).select(F.col("p_partkey").alias("product_id"))
