"""Filter interaction audit: what each filter removes alone, first, or after others, in every order.

Each document's failures are a set of bits. Four filters look at the text alone. The fifth, E, is an existential
self-join: a document fails it if a left-semi join finds its hash and its exact text with a smaller id. The other side of
that join has one row for each text, its smallest id, so a text that very many documents share is never joined with
itself; and both sides hold only texts whose hash is found twice. The ids that E finds are put together with those that
fail the others, their bits combined, and counted by part and combination. Every order of the filters is then read off
the at most 32 counts of a part: no document is looked at again.

Defined cases: a null text is empty and a null source the empty string; a null id is smaller than none and larger than
none, so such rows neither fail E nor make others fail it; repeated rows count as often as they stand; labels of one id
are combined (good or toxic if any row says so); an empty table gives no part.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import saved
from .components import HOT, HOT_KEYS

FILTERS = "ABCDE"
E_BIT = 1 << FILTERS.index("E")
_UPPER, _SYMBOLS = bytes(range(65, 91)), b"#$%&*|"


def _failures(texts: pd.Series) -> pd.Series:
    """Bits of A to D for UTF-8 texts."""

    def bits(t: bytes | None) -> int:
        t = t or b""
        words = t.split()
        n, points = len(words), len(t) if t.isascii() else len(t.decode("utf-8", "replace"))
        upper = len(t) - len(t.translate(None, _UPPER))
        return (n < 200) | (100 * len(set(words)) < 50 * n) << 1 | (100 * upper > 2 * points) << 2 | (len(t.translate(None, _SYMBOLS)) < len(t)) << 3

    return texts.map(bits)


def smaller_copies(rows: DataFrame) -> DataFrame:
    """The (id, h) of ``rows(id, h, t)`` whose exact text ``t``, with hash ``h``, another row has with a smaller id."""
    rows = rows.filter("id IS NOT NULL")
    twice = saved(rows.groupBy("h").agg(F.count("*").alias("n"), F.ceil(F.count("*") / HOT).cast("int").alias("parts")).filter("n > 1").drop("n"), "twice")
    few = twice.count() <= HOT_KEYS
    near = rows.join(F.broadcast(twice) if few else twice, "h")
    first = near.groupBy("h", "t", "parts").agg(F.min("id").alias("least"))
    first = first.select(F.col("h").alias("first_h"), F.col("t").alias("first_t"), "least", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("first_part"))
    dealt = near.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    found = dealt.join(first, (F.col("h") == F.col("first_h")) & (F.col("part") == F.col("first_part")) & (F.col("t") == F.col("first_t")) & (F.col("least") < F.col("id")), "left_semi")
    return found.select("id", "h").distinct()


def combinations(docs: DataFrame, labels: DataFrame, part: Column) -> DataFrame:
    """part, mask, n, good, toxic: the rows of ``docs(doc_id, text)`` by the set of filters they fail, bit 0 for A."""
    t = F.coalesce("text", F.lit(""))
    hashed = docs.select(F.col("doc_id").alias("id"), F.xxhash64(t).alias("h"), t.alias("t"))
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64(t).alias("h"), part.alias("part"), F.pandas_udf(_failures, "int")(t.cast("binary")).alias("bits"))
    rows = saved(rows.groupBy("id", "h", "part", "bits").agg(F.count("*").alias("n")), "failures")
    failed = rows.filter("bits <> 0").select("id", "h", "bits").unionByName(smaller_copies(hashed).select("id", "h", F.lit(E_BIT).alias("bits")))
    failed = failed.groupBy("id", "h").agg(F.bit_or("bits").alias("mask"))
    said = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    out = rows.alias("r").join(failed.alias("f"), F.col("r.id").eqNullSafe(F.col("f.id")) & (F.col("r.h") == F.col("f.h")), "left").join(said, F.col("r.id") == F.col("doc_id"), "left")
    n = F.col("r.n")
    return out.groupBy("part", F.coalesce("mask", F.lit(0)).alias("mask")).agg(F.sum(n).alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of every order and step, from :func:`combinations`; a part has one list of at most 32 counts."""
    each = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("c"))
    each = each.withColumn("filter_order", F.explode(F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))))
    each = each.select("part", "c", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    bit = lambda i: F.element_at(F.array(*(F.lit(1 << k) for k in range(len(FILTERS)))), F.instr(F.lit(FILTERS), F.substring("filter_order", i, F.lit(1))))
    before = F.aggregate(F.sequence(F.lit(0), F.col("step") - 1), F.lit(0), lambda s, i: F.when(i == 0, 0).otherwise(s.bitwiseOR(bit(i))))
    each = each.withColumn("bit", bit(F.col("step"))).withColumn("before", before)

    def total(of: str, where) -> Column:
        return F.aggregate("c", F.lit(0).cast("long"), lambda s, x: s + F.when(where(x["mask"]), x[of]).otherwise(0))

    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    alive = lambda m: m.bitwiseAND(F.col("before")) == 0
    here = lambda m: fails(m) & alive(m)
    # of the orders, one in bit_count(mask) meets this filter first among those that a document fails
    orders = len(list(permutations(FILTERS)))
    share = F.array(*(F.lit(orders // k) for k in range(1, len(FILTERS) + 1)))
    shapley = F.aggregate("c", F.lit(0).cast("long"), lambda s, x: s + F.when(fails(x["mask"]), x["n"] * F.element_at(share, F.bit_count(x["mask"]))).otherwise(0))
    return each.select(
        "part", "filter_order", "step", total("n", lambda m: alive(m) & ~fails(m)).alias("kept"), total("n", here).alias("removed"), total("n", lambda m: fails(m) & ~alive(m)).alias("redundant"),
        total("n", lambda m: m == F.col("bit")).alias("unique_fails"), total("good", here).alias("good_lost"), total("toxic", here).alias("toxic_lost"), shapley.alias("shapley"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the audit of the five filters over ``documents``, by source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return audit(combinations(docs, labels, F.coalesce("source", F.lit(""))))


SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM t),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    MAP {'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
      'D': regexp_matches(t, '[#$%&*|]'), 'E': doc_id > min(doc_id) OVER (PARTITION BY t)} AS fails
  FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, good, toxic, fails['A'] AS a, fails['B'] AS b, fails['C'] AS c, fails['D'] AS d, fails['E'] AS e, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM x p, x q, x r, x s, x u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
k AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
y AS (SELECT g.*, filter_order, step::INTEGER AS step, filter_order[step] AS own,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda z: CASE z WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS failed FROM g, k),
z AS (SELECT *, list_contains(failed, own) AS hit, len(list_filter(failed, lambda v: instr(filter_order, v) < step)) = 0 AS alive FROM y),
r AS (SELECT part, filter_order, step, any_value(own) AS own, sum(CASE WHEN alive AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN alive AND hit THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN hit AND NOT alive THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN failed = [own] THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN alive AND hit AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN alive AND hit AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost FROM z GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""
