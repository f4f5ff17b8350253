"""Constraint checks over the table catalogue: each returns violations as rows, none stops at the first."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import MONTHS


def unique_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys met twice or more; a key with a null is exempt."""
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return df.filter(full).groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Children whose reference is set and has no parent."""
    return child.filter(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def type_rule(column: str, kind: str) -> Column:
    """Whether a text column's value, if not blank, fails to parse as ``kind``."""
    t = F.nullif(F.trim(F.col(column)), F.lit(""))
    parsed = {
        "bigint": t.try_cast("long").isNotNull(), "int": t.try_cast("int").isNotNull(), "bool": F.lower(t).isin("true", "false", "t", "f", "1", "0"),
        "decimal": t.try_cast("double").isNotNull() & ~F.isnan(t.try_cast("double")) & (F.abs(t.try_cast("double")) != float("inf")),
        "json": F.try_parse_json(t).isNotNull(), "array": t.rlike(r"^\{.*\}$"), "timestamp": F.try_to_timestamp(t).isNotNull(),
    }[kind]
    return t.isNotNull() & ~F.coalesce(parsed, F.lit(False))


def domain_rule(column: str, kind: str) -> Column:
    c = F.col(column)
    bad = {"currency": ~c.rlike("^[A-Z]{3}$"), "month": ~c.isin(*MONTHS), "url": ~c.rlike("(?i)^https?://"), "positive": c.try_cast("long") <= 0}[kind]
    return c.isNotNull() & bad


def violations(df: DataFrame, line: str, not_null: list[str] = (), types: dict[str, str] | None = None, domains: dict[str, str] | None = None) -> DataFrame:
    """line, column, rule, value for every broken rule, in one pass."""
    found = [F.when(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNull(), F.struct(F.lit(c).alias("column"), F.lit("not_null").alias("rule"), F.col(c).cast("string").alias("value"))) for c in not_null]
    for rules, how in ((types or {}, type_rule), (domains or {}, domain_rule)):
        found += [F.when(how(c, k), F.struct(F.lit(c).alias("column"), F.lit(k).alias("rule"), F.col(c).cast("string").alias("value"))) for c, k in rules.items()]
    return df.select(line, F.explode(F.array_compact(F.array(*found))).alias("v")).select(line, "v.column", "v.rule", "v.value")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, rows: one aggregate for each table."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()])


def reconcile(expected: DataFrame, failed: DataFrame, actual: DataFrame, exact: bool = True) -> DataFrame:
    """table_name, expected, failed, actual, ok: whether what is there is what was sent less what failed."""
    e = expected.select("table_name", F.col("rows").alias("expected"))
    out = e.join(failed.select("table_name", F.col("rows").alias("failed")), "table_name", "left").join(actual.select("table_name", F.col("rows").alias("actual")), "table_name", "left")
    out = out.fillna(0, ["failed", "actual"])
    want = F.col("expected") - F.col("failed")
    return out.withColumn("ok", F.col("actual") == want if exact else F.col("actual") >= want)


def completeness(df: DataFrame, paths: list[Column], total: int | None = None) -> DataFrame:
    """``df`` with fields_populated, fields_total and completeness_pct: a blank text, an empty list and null don't count."""
    filled = sum((F.when(p, 1).otherwise(0) for p in paths), F.lit(0))
    n = total or len(paths)
    return df.withColumn("fields_populated", filled.cast("int")).withColumn("fields_total", F.lit(n)).withColumn("completeness_pct", F.round(F.col("fields_populated").cast("decimal(10,4)") * 100 / n, 2).cast("decimal(5,2)"))


def populated(c: Column, kind: str = "string") -> Column:
    if kind == "string":
        return F.coalesce(F.trim(c) != "", F.lit(False))
    if kind == "array":
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull()


def run_accounting(records: DataFrame, source: str, failed: Column) -> DataFrame:
    """Records processed, succeeded, failed and the status of each source's run."""
    out = records.groupBy(source).agg(F.count("*").alias("records_processed"), F.count_if(~failed).alias("records_succeeded"), F.count_if(failed).alias("records_failed"))
    status = F.when(F.col("records_failed") == 0, "completed").otherwise("completed_with_errors")
    return out.withColumn("run_status", status)
