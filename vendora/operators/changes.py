"""Upserts and other idempotent merges, as joins over whole tables; a writer publishes the result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .identity import pick_one


def upsert(existing: DataFrame, batch: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Existing rows without a newer one, and the batch's last row of each key. Applying a batch twice changes nothing."""
    last = pick_one(batch, key, order)
    return existing.join(last, key, "left_anti").unionByName(last.select(*existing.columns))


def insert_absent(existing: DataFrame, batch: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Existing rows, and the batch's first row of each key that was not there."""
    return existing.unionByName(pick_one(batch.join(existing, key, "left_anti"), key, order).select(*existing.columns))


def replace_children(existing: DataFrame, batch: DataFrame, parent: str, touched: DataFrame | None = None) -> DataFrame:
    """All children of the touched parents go, the batch's come in; a parent without new children is left with none."""
    touched = (batch if touched is None else touched).select(parent).distinct()
    return existing.join(touched, parent, "left_anti").unionByName(batch.select(*existing.columns))


def append_new(existing: DataFrame, batch: DataFrame, dedupe: list[str], order: list[Column]) -> DataFrame:
    """The rows to append: those whose dedupe key is neither there nor earlier in the batch."""
    return pick_one(batch.join(existing.select(*dedupe).distinct(), dedupe, "left_anti"), dedupe, order)


def update_from(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows that change: the source's value where it has one and differs, null-safe."""
    s = source.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    both = target.join(s, key, "left")
    new = {c: F.coalesce(F.col(f"__{c}"), F.col(c)) for c in columns}
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~new[c].eqNullSafe(F.col(c))
    return both.filter(changed).withColumns(new).select(*target.columns)


def resolve_rejects(rejects: DataFrame, matched: DataFrame, key: str, at: Column) -> DataFrame:
    """Open rejects that a later batch matches become resolved; others stay as they are."""
    hit = matched.select(key).distinct().withColumn("__hit", F.lit(True))
    now = F.col("resolved_at").isNull() & F.col("__hit").isNotNull()
    return rejects.join(hit, key, "left").withColumn("resolved_at", F.when(now, at).otherwise(F.col("resolved_at"))).drop("__hit")
