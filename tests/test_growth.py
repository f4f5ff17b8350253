"""Queries whose work must grow no faster than their input: many rows of one key, and expressions computed once."""

import pytest
from pyspark.sql import functions as F

from vendora.llm import warc
from vendora.operators import identity
from vendora.operators.finalise import RAW
from vendora.plans import QUERIES

DATA = "/root/testdata/sf0.001"


def _rows_made(df) -> int:
    """The most rows that a join or a generator of the executed plan has put out."""
    df.collect()
    plan, most, todo = df._jdf.queryExecution().executedPlan(), 0, []
    todo.append(plan)
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if "Join" in name:
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_match_either_many_rows_of_one_key(spark):
    """300 rows on each side share a price and a name: a join of all made 90,000 rows for each equality."""
    left = spark.range(300).select(F.col("id").alias("lid"), F.lit("n").alias("name"), F.when(F.col("id") != 7, 1.5).alias("price"))
    right = spark.range(300).select((500 - F.col("id")).alias("rid"), F.lit("n").alias("rname"), F.when(F.col("id") < 200, 1.5).alias("rprice"))
    out = identity.match_either(left, right, [(F.col("price"), F.col("rprice")), (F.col("name"), F.col("rname"))], "lid", [F.col("rid")])
    assert _rows_made(out) <= 600
    # the price counts before the name; the smallest id with the price is 301, without one 201
    assert {(r["lid"], r["rid"], r["rprice"], r["match_rank"]) for r in out.collect()} == {(i, 201, None, 1) if i == 7 else (i, 301, 1.5, 0) for i in range(300)}


@pytest.mark.parametrize("name", ["evidence_record", "raw_leaves", "finalised_records"])
def test_leaves_are_read_once(spark, name):
    """A raw record is parsed once, and no leaf's kind or text is taken from it more than once or twice: every use held its own copy of them."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    leaves = sum(len(x or "1") for x in RAW.values())
    assert 1 <= plan.count("from_json(") <= 4  # the two records and their lists; 48 and 57 in the first two queries before
    assert 1 <= plan.count("try_variant_get(") <= 3 * leaves  # 975 in the last before


@pytest.mark.parametrize("name", ["evidence_record", "raw_leaves", "finalised_records"])
def test_leaves_are_read_by_all_cores(spark, name):
    """A file of one row group is read by one task: before, that task did all the work on its rows."""
    assert QUERIES[name](spark, DATA).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_archive_moves_single_payloads_once(spark, tmp_path):
    """A payload that one record has is stored with its header and read without a join: before, every payload was shuffled again to meet its record."""
    rows = [(i, f"u{i}", f"<p>{i}</p>" * 40) for i in range(8)] + [(20, "u", "<b>" * 90), (21, "v", "<b>" * 90), (22, "w", None)]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"))
    assert {r["page_id"] for r in spark.read.parquet(str(tmp_path / "a/records")).collect()} == {20, 21}
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 10
    got = {r["page_id"]: r for r in warc.read_records(spark, str(tmp_path / "a")).collect()}
    assert sorted(got) == [*range(8), 20, 21, 22] and all(r["verified"] for r in got.values())
    assert all(bytes(r["payload"]).decode() == (html or "") and bytes(r["record"]).startswith(b"WARC/1.0") for k, _, html in rows for r in [got[k]])
    assert [k for k, r in got.items() if r["kind"] == "revisit"] == [21] and bytes(got[3]["record"]).endswith(("<p>3</p>" * 40).encode() + b"\r\n\r\n")


def test_rows_are_cut_from_pages_once(spark):
    """The rows of pages are written before their labels are named: before, pages were cut twice, once for the distinct labels."""
    plan = QUERIES["spec_pivot"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "Window" not in plan
