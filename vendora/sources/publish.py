"""Sinks: a run-stamped folder of tables that a pointer makes current, and its manifest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TABLES
from . import pointer


def write_tables(tables: dict[str, DataFrame], root: str, run: str, file_format: str = "parquet") -> DataFrame:
    """Write every table under ``root/run=<run>/<name>``, then the manifest, last the pointer; readers follow the pointer, which one rename puts in place, so a run that fails is never seen and there is always one to read.

    Returns the manifest: table_name, rows, position (parents before children).
    """
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if file_format == "csv":
            flat = [F.to_json(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
            df.select(*(x.alias(c) for x, c in zip(flat, df.columns, strict=True))).write.mode("overwrite").option("header", "true").option("escape", '"').csv(f"{root}/run={run}/{name}")
        else:
            writer.format(file_format).save(f"{root}/run={run}/{name}")
    order = {n: i for i, n in enumerate(TABLES)}
    read = lambda n: spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').format(file_format).load(f"{root}/run={run}/{n}")
    counts = [read(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows", F.lit(order.get(n, len(order))).alias("position")) for n in tables]
    manifest = reduce(DataFrame.unionByName, counts)
    manifest.coalesce(1).write.mode("overwrite").json(f"{root}/run={run}/_manifest")
    pointer.put(spark, root, {"run": run})
    return spark.read.json(f"{root}/run={run}/_manifest")


def summary(records: DataFrame, errors: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row: records discovered, written, rejected, of the canonical source and listed, with rows by table and the import order."""
    r = records.agg(F.count("*").alias("records_written"), F.count_if("is_canonical").alias("canonical_records"), F.count_if(~F.col("is_canonical")).alias("marketplace_listings"))
    t = manifest.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("table_name", "rows")))).alias("rows_by_table"), F.transform(F.array_sort(F.collect_list(F.struct("position", "table_name"))), lambda x: x["table_name"]).alias("import_order"))  # one row for each table
    out = r.crossJoin(errors.agg(F.count("*").alias("records_rejected"))).crossJoin(t)
    return out.withColumn("records_discovered", F.col("records_written") + F.col("records_rejected"))


def run_files(spark: SparkSession, root: str, run: str) -> DataFrame:
    """path and length of every file of a run; their contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/run={run}")
    return found.select(F.regexp_extract("path", r"/run=[^/]*/(.*)$", 1).alias("path"), "length")


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current run."""
    return spark.read.parquet(f"{root}/run={pointer.get(spark, root)['run']}/{name}")


def export(df: DataFrame, path: str, file_format: str = "csv") -> None:
    """Filtered rows as CSV with a header, or as JSON."""
    (df.write.option("header", "true").csv if file_format == "csv" else df.write.json)(path)
