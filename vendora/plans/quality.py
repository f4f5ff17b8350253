"""Data-quality queries with planted errors in the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import validation as op
from .registry import query, table


@query("SELECT l_orderkey, l_partkey FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 7 = 0 THEN l_partkey + 1000000 WHEN l_orderkey % 7 = 1 THEN NULL ELSE l_partkey END AS l_partkey FROM lineitem) WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)")
def fk_violations(spark, d):
    k = F.col("l_orderkey") % 7
    child = table(spark, d, "lineitem").select("l_orderkey", F.when(k == 0, F.col("l_partkey") + 1000000).when(k != 1, F.col("l_partkey")).alias("l_partkey"))
    return op.fk_violations(child, "l_partkey", table(spark, d, "part"), "p_partkey").select("l_orderkey", "l_partkey")


@query("SELECT p_brand, p_name, count(*) AS rows FROM part WHERE p_size % 10 <> 0 GROUP BY ALL HAVING count(*) > 1")
def unique_violations(spark, d):
    part = table(spark, d, "part").select("p_brand", F.when(F.col("p_size") % 10 != 0, F.col("p_name")).alias("p_name"))
    return op.unique_violations(part, ["p_brand", "p_name"])


@query("""SELECT line, col AS "column", rule, value FROM (
SELECT p_partkey AS line, 'size' AS col, 'int' AS rule, p_size || 'x' AS value FROM part WHERE p_size % 9 = 0 UNION ALL SELECT p_partkey, 'name', 'not_null', '' FROM part WHERE p_size % 8 = 0
UNION ALL SELECT p_partkey, 'price', 'decimal', 'NaN' FROM part WHERE p_size % 11 = 0 UNION ALL SELECT p_partkey, 'colors', 'array', '[a]' FROM part WHERE p_size % 13 = 0
UNION ALL SELECT p_partkey, 'currency', 'currency', 'Pkr' FROM part WHERE p_size % 6 = 0 UNION ALL SELECT p_partkey, 'month', 'month', 'JUNE' FROM part WHERE p_size % 7 = 0 UNION ALL SELECT p_partkey, 'ident', 'positive', CAST(-p_partkey AS VARCHAR) FROM part WHERE p_size % 12 = 0)""")
def typed_violations(spark, d):
    n = F.col("p_size")
    rows = table(spark, d, "part").select(
        F.col("p_partkey").alias("line"), F.when(n % 9 == 0, F.concat(n.cast("string"), F.lit("x"))).otherwise(n.cast("string")).alias("size"), F.when(n % 8 == 0, "").otherwise(F.col("p_name")).alias("name"),
        F.when(n % 11 == 0, "NaN").otherwise(F.col("p_retailprice").cast("string")).alias("price"), F.when(n % 13 == 0, "[a]").otherwise('{"a","b"}').alias("colors"),
        F.when(n % 6 == 0, "Pkr").otherwise("PKR").alias("currency"), F.when(n % 7 == 0, "JUNE").otherwise("JUN").alias("month"),
        F.when(n % 12 == 0, -F.col("p_partkey")).otherwise(F.col("p_partkey") + 1).cast("string").alias("ident"),
    )
    return op.violations(rows, "line", ["name"], {"size": "int", "price": "decimal", "colors": "array"}, {"currency": "currency", "month": "month", "ident": "positive"})


def _tables(spark, d):
    return {t: table(spark, d, t) for t in ("part", "orders", "lineitem", "customer")}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in ("part", "orders", "lineitem", "customer")))
def rows_by_table(spark, d):
    return op.row_counts(_tables(spark, d))


@query(" UNION ALL ".join(f"""SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS expected, (SELECT count(*) FROM {t} WHERE {k} % 10 = 0) AS failed, (SELECT count(*) FROM {t} WHERE {k} % 10 <> 0 AND {k} % 97 <> 5) AS actual,
  (SELECT count(*) FROM {t} WHERE {k} % 10 <> 0 AND {k} % 97 = 5) = 0 AS ok""" for t, k in (("part", "p_partkey"), ("orders", "o_orderkey"))))
def reconcile_counts(spark, d):
    """What was sent, less what failed, against what is there; some rows were lost."""
    t = {"part": (table(spark, d, "part"), "p_partkey"), "orders": (table(spark, d, "orders"), "o_orderkey")}
    return op.reconcile(*(op.row_counts({n: df.filter(cond.format(k)) for n, (df, k) in t.items()}) for cond in ("true", "{0} % 10 = 0", "{0} % 10 <> 0 AND {0} % 97 <> 5")))


_FILLED = "(CASE WHEN trim(text) <> '' THEN 1 ELSE 0 END + CASE WHEN lang <> '' AND doc_id % 4 <> 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 0 END + 1)"


def _scored(spark, d):
    docs = table(spark, d, "documents").withColumn("l", F.when(F.col("doc_id") % 4 != 0, F.col("lang")).otherwise(" ")).withColumn("s", F.when(F.col("doc_id") % 3 != 0, F.array("source")).otherwise(F.array().cast("array<string>")))
    return op.completeness(docs, [op.populated(F.col("text")), op.populated(F.col("l")), op.populated(F.col("s"), "array"), op.populated(F.col("n_chars"), "number")])


@query(f"SELECT doc_id, {_FILLED}::INTEGER AS fields_populated, 4 AS fields_total, {_FILLED} * 25.0::DOUBLE AS completeness_pct FROM documents")
def completeness(spark, d):
    return _scored(spark, d).select("doc_id", "fields_populated", "fields_total", F.col("completeness_pct").cast("double").alias("completeness_pct"))


@query(f"SELECT source, count(*) AS n, CAST(sum({_FILLED} * 25) AS DOUBLE) / count(*) AS mean_pct FROM documents GROUP BY source")
def completeness_table(spark, d):
    return _scored(spark, d).groupBy("source").agg(F.count("*").alias("n"), (F.sum("completeness_pct").cast("double") / F.count("*")).alias("mean_pct"))


@query("SELECT d.doc_id, quality FROM documents d LEFT JOIN labels USING (doc_id) WHERE quality < 1 OR quality IS NULL")
def low_completeness(spark, d):
    """Low or missing scores."""
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").filter("quality < 1 OR quality IS NULL")


@query("SELECT source, count(*) AS records_processed, count(*) FILTER (n_chars >= 400) AS records_succeeded, count(*) FILTER (n_chars < 400) AS records_failed, CASE WHEN count(*) FILTER (n_chars < 400) = 0 THEN 'completed' ELSE 'completed_with_errors' END AS run_status FROM documents GROUP BY source")
def run_accounting(spark, d):
    return op.run_accounting(table(spark, d, "documents"), "source", F.col("n_chars") < 400)


@query("""SELECT source, count(*) AS staged, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS loaded FROM documents GROUP BY source""")
def load_run(spark, d):
    """Staged rows less those with an open reject."""
    docs, bad = table(spark, d, "documents"), table(spark, d, "labels").filter("toxic = 1").select("doc_id")
    lost = docs.join(bad, "doc_id", "left_semi").groupBy("source").agg(F.count("*").alias("r"))
    return docs.groupBy("source").agg(F.count("*").alias("staged")).join(lost, "source", "left").select("source", "staged", (F.col("staged") - F.coalesce("r", F.lit(0))).alias("loaded"))


_REJECTS = "(SELECT doc_id, CASE WHEN quality = 0 THEN 'INVALID_PAYLOAD' ELSE 'UNMATCHED' END AS reject_reason, CASE WHEN doc_id % 3 = 0 THEN 1 END AS resolved_at FROM labels WHERE toxic = 1 OR quality = 0)"


def _rejects(spark, d):
    x = table(spark, d, "labels").filter("toxic = 1 OR quality = 0")
    return x.select("doc_id", F.when(F.col("quality") == 0, "INVALID_PAYLOAD").otherwise("UNMATCHED").alias("reject_reason"), F.when(F.col("doc_id") % 3 == 0, 1).alias("resolved_at"))


@query(f"SELECT * FROM {_REJECTS}")
def reject_table(spark, d):
    return _rejects(spark, d)


@query(f"SELECT doc_id FROM {_REJECTS} WHERE reject_reason = 'UNMATCHED' AND resolved_at IS NULL")
def open_rejects(spark, d):
    return _rejects(spark, d).filter("reject_reason = 'UNMATCHED' AND resolved_at IS NULL").select("doc_id")
