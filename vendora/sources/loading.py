"""Loads that can be stopped and run again: one committed step for each table, bad rows set aside, one input for the whole load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import convert
from ..operators.validation import type_rule
from ..schema import TABLES, Table
from .publish import write_tables
from .records import discover, load, read_csv_table

_RULES = {"bigint": "bigint", "int": "int", "boolean": "bool", "timestamp": "timestamp", "array<string>": "json"}


def contract(df: DataFrame) -> DataFrame:
    """One row: rows and an order-free hash of all values; equal for equal tables however they are dealt."""
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.bit_xor(F.xxhash64(*df.columns)), F.lit(0).cast("long")).alias("hash"))


def row_failed(table: Table) -> Column:
    """Whether a row of texts breaks a type or lacks a required value."""
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit("")).isNull()
    rules = [blank(c) for c in (table.key, *table.not_null)]
    rules += [type_rule(c, _RULES.get(k, "decimal")) for c, k in table.columns.items() if k in _RULES or k.startswith("decimal")]
    return reduce(lambda a, b: a | b, rules)


def _state(spark: SparkSession, root: str, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_state/{name}/_SUCCESS")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.json(f"{root}/_state/{name}").first()


def load_table(df: DataFrame, table: Table, root: str) -> DataFrame:
    """Write the good rows of a table of texts to ``root/rows/<name>`` and the others to ``root/bad/<name>``, then commit; returns the committed row: table_name, rows, hash, bad.

    A table that is committed already is left alone; if its input has changed since, the load is refused.
    """
    spark = df.sparkSession
    now, then = contract(df).first(), _state(spark, root, table.name)
    if then is not None:
        if (then["rows"], then["hash"]) != (now["rows"], now["hash"]):
            raise ValueError(f"{table.name} is not the table that this load began with")
        return spark.read.json(f"{root}/_state/{table.name}")
    failed = row_failed(table)
    df.filter(~failed).write.mode("overwrite").parquet(f"{root}/rows/{table.name}")
    df.filter(failed).write.mode("overwrite").parquet(f"{root}/bad/{table.name}")
    done = spark.read.parquet(f"{root}/bad/{table.name}").agg(F.count("*").alias("bad"))
    done = done.select(F.lit(table.name).alias("table_name"), F.lit(now["rows"]).alias("rows"), F.lit(now["hash"]).alias("hash"), "bad")
    done.coalesce(1).write.mode("overwrite").json(f"{root}/_state/{table.name}")
    return spark.read.json(f"{root}/_state/{table.name}")


def load_csv_tables(spark: SparkSession, source: str, root: str, names: list[str] | None = None) -> DataFrame:
    """Load ``source/<table>`` for each table, parents first; the committed rows."""
    steps = [load_table(read_csv_table(spark, f"{source}/{n}", TABLES[n]), TABLES[n], root) for n in TABLES if names is None or n in names]
    return reduce(DataFrame.unionByName, steps)


def load_source(spark: SparkSession, records: str, out: str, run: str, generated_at: Column, canonical_source: str, domains: list[str] | None = None) -> DataFrame:
    """Record files of some sources to a published run of all tables; its manifest."""
    good, bad = load(discover(spark, records, domains))
    return write_tables(convert(good, bad, generated_at, canonical_source), out, run)


def load_all(spark: SparkSession, records: str, out: str, run: str, generated_at: Column, canonical_source: str) -> DataFrame:
    """:func:`load_source` for every source there is."""
    return load_source(spark, records, out, run, generated_at, canonical_source)
