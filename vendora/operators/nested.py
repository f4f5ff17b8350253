"""Nested JSON: walks of trees, canonical form, the product in a page's embedded data.

Trees are walked level by level over VARIANT, each level written, so that a tree's nodes are dealt over tasks however many
there are and any depth is reached. Where the order of an object's fields or the spelling of a number counts, VARIANT
cannot serve (it sorts fields, reads 1.0 as 1 and stops at the end of the first value); there a small helper reads the text.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import saved


def walk_tree(df: DataFrame, key: str, tree: str, children: str = "children") -> DataFrame:
    """key, position, parent, depth, node: every node of the JSON tree in ``tree``, in pre-order from 1.

    ``node`` is a VARIANT, ``parent`` the position of the node above. Values that are no objects are no nodes, and neither is
    anything below them; a text that is no JSON has none. Keys must be unique.
    """
    at = f"$.{children}"
    level = df.select(key, F.array().cast("array<int>").alias("place"), F.try_parse_json(tree).alias("node"))
    levels = []
    while True:
        level = saved(level.filter(F.startswith(F.schema_of_variant("node"), F.lit("OBJECT"))), "level")
        if level.isEmpty():
            break
        levels.append(level)
        below = level.select(key, "place", F.posexplode(F.try_variant_get("node", at, "array<variant>")).alias("i", "node"))
        level = below.select(key, F.concat("place", F.array("i")).alias("place"), "node")
    if not levels:
        return level.select(key, F.lit(1).alias("position"), F.lit(1).alias("parent"), F.size("place").alias("depth"), "node")
    found = functools.reduce(DataFrame.unionByName, levels)
    # the nodes of one tree have come from one row
    found = found.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy("place")))
    up = found.select(key, F.col("place").alias("above"), F.col("position").alias("parent"))
    out = found.withColumn("above", F.when(F.size("place") > 0, F.slice("place", F.lit(1), F.size("place") - 1)))
    return out.join(up, [key, "above"], "left").select(key, "position", "parent", F.size("place").alias("depth"), "node")


def _canonical(texts: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        try:
            return None if t is None else json.dumps(json.loads(t), ensure_ascii=False, separators=(",", ":"), sort_keys=True)
        except (ValueError, RecursionError):
            return None

    return texts.map(one)


def canonical_json(text: Column) -> Column:
    """A JSON text without white space, the fields of every object in order of their names, lists as they are; null if it is none.

    Of fields with one name the last counts; numbers are those that a double or an integer of any length gives.
    """
    return _udf(_canonical, "string")(text)


@functools.cache
def _udf(f, kind: str):
    """One function object for each helper, so that Spark runs it once for equal columns."""
    return F.pandas_udf(f, kind)


def _objects(value) -> Iterator[dict]:
    """The objects in a JSON value, outer before inner, in order."""
    stack = [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            yield v
        if isinstance(v, (dict, list)):
            stack.extend(reversed(list(v.values()) if isinstance(v, dict) else v))


def _is_product(node: dict) -> bool:
    kinds = node.get("@type")
    return any(str(k).lower() == "product" for k in (kinds if isinstance(kinds, list) else [kinds]))


def _offer(node: dict) -> str | None:
    offers = node.get("offers")
    for o in offers if isinstance(offers, list) else [offers]:
        for name in ("price", "lowPrice"):
            if isinstance(o, dict) and isinstance(o.get(name), (int, float, str)) and not isinstance(o[name], bool) and str(o[name]).strip():
                return str(o[name])
    return None


def _products(blocks: pd.Series) -> pd.DataFrame:
    rows = []
    for some in blocks:
        first = None
        for text in [] if some is None else some:
            try:
                products = [p for p in _objects(json.loads(text.strip())) if _is_product(p)]
            except (ValueError, RecursionError, AttributeError):
                continue
            priced = next((p for p in products if _offer(p)), None)
            if priced or (first is None and products):
                first = priced or products[0]
            if priced:
                break
        text_of = lambda k: first[k] if isinstance(first.get(k), str) else None
        rows.append((True, text_of("name"), text_of("description"), _offer(first)) if first else (False, None, None, None))
    return pd.DataFrame(rows, columns=["found", "name", "description", "price"])


def embedded_product(html: Column) -> Column:
    """struct(found, name, description, price) of a page's embedded data: the first product, in any list, graph or object, that has an offer with a price; without one the first product."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    return _udf(_products, "found boolean, name string, description string, price string")(blocks)
