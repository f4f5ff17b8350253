"""Periodic runs of words, found as branching tandem repeats on an enhanced suffix array.

The words of some documents become numbers that no two documents share, each document closed by a number of its own,
so that nothing matches across documents. Their suffixes are put in order by doubling prefixes, which also gives the
lengths of common prefixes of neighbours (LCP). For every LCP interval of depth d, the suffixes of all child intervals
but the largest look up whether the suffix d words further, or d words before, lies in the interval too: the inverse
suffix array answers, no tree is built. Such a pair is a square of period d; where the next words differ it cannot be
rotated to the right, so it is the last square of a run. Rotating it to the left gives the run; of squares with one
end, the smallest period comes first and takes up its multiples. Every document costs O(n log n) whatever it repeats.

Defined cases: a null or wordless text has no word and no run; repeated rows and null ids are judged row by row; an
empty table gives an empty table; runs may overlap, and all are kept; other columns are handed on if named.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .quality import SPACE, _let

#: Words whose suffixes are put in order at once; a longer text is taken alone.
SLICE_WORDS = 1 << 17
RUN = "struct<start: bigint, length: bigint, period: bigint>"
FOUND = f"n_words bigint, runs array<{RUN}>, collapsed string"


def suffix_array(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order, their places, LCP with the one before) of numbers from 0 whose last one is found once, as must be the number at the end of each part."""
    n = len(x)
    count = np.bincount(x)
    place = (np.cumsum(count) - count)[x]
    order, lcp = np.argsort(x, kind="stable"), np.zeros(n, np.int64)
    bits, levels, h = n.bit_length(), [], 1
    at = np.flatnonzero(count[x[order]] > 1)  # places whose suffix is not yet told apart
    while len(at):
        levels.append(place.copy())
        i = order[at]
        a, b = place[i], place[i + h]
        if 3 * bits < 64:
            packed = np.sort(a << 2 * bits | b << bits | i)
            a, b, i = packed >> 2 * bits, packed >> bits & (1 << bits) - 1, packed & (1 << bits) - 1
        else:
            s = np.lexsort((b, a))
            a, b, i = a[s], b[s], i[s]
        order[at] = i
        new = np.ones(len(at), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        place[i] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        parted = np.flatnonzero(new[1:] & (a[1:] == a[:-1])) + 1
        left, right, known = i[parted - 1] + h, i[parted] + h, np.full(len(parted), h)
        for k in range(len(levels) - 2, -1, -1):
            same = (levels[k][left] == levels[k][right]).astype(np.int64) << k
            left, right, known = left + same, right + same, known + same
        lcp[at[parted]] = known
        alone = new.copy()
        alone[:-1] &= new[1:]
        at, h = at[~alone], 2 * h
    return order, place, lcp


def _nearest(lcp: np.ndarray, at: np.ndarray, step: int, strict: bool) -> np.ndarray:
    """For the places ``at``, the next one before (-1) or after (1) with a smaller LCP, or one not larger; those between point on."""
    to = np.arange(len(lcp)) + step
    left = at
    while True:
        there = lcp[to[left]]
        left = left[there >= lcp[left] if strict else there > lcp[left]]
        if not len(left):
            return to[at]
        to[left] = to[to[left]]


def branching_squares(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of every square of ``x`` whose rotation by one to the right is none; ``x`` as for :func:`suffix_array`."""
    order, place, lcp = suffix_array(x)
    lcp = np.append(lcp, -1)
    lcp[0] = -1
    at = np.flatnonzero(lcp > 0)
    if not len(at):
        return at, at
    first, last = _nearest(lcp, at, -1, True), _nearest(lcp, at, 1, True)  # the interval of each boundary: places first to last - 1
    opens = _nearest(lcp, at, -1, False) == first
    begin = np.concatenate((at, first[opens]))
    size = np.concatenate((_nearest(lcp, at, 1, False) - at, at[opens] - first[opens]))
    of = np.concatenate((np.arange(len(at)), np.flatnonzero(opens)))
    s = np.lexsort((size, last[of], first[of]))
    begin, size, of = begin[s], size[s], of[s]
    small = np.zeros(len(s), bool)  # all children but the largest, the last of its interval
    small[:-1] = (first[of[1:]] == first[of[:-1]]) & (last[of[1:]] == last[of[:-1]])
    begin, size, of = begin[small], size[small], of[small]
    each = np.repeat(np.arange(len(size)), size)
    i = order[begin[each] + np.arange(len(each)) - (np.cumsum(size) - size)[each]]
    of = of[each]
    d, lo, hi = lcp[at[of]], first[of], last[of]
    on = place[i + d]
    starts, periods = [i[k := (on >= lo) & (on < hi)]], [d[k]]
    back = np.flatnonzero(i >= d)
    on = place[i[back] - d[back]]
    k = back[(on >= lo[back]) & (on < hi[back])]
    start, period = np.concatenate((*starts, i[k] - d[k])), np.concatenate((*periods, d[k]))
    ends = x[start + period] != x[start + 2 * period]
    return start[ends], period[ends]


def _rotations(x: np.ndarray, start: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The start of the leftmost rotation of each square."""
    start, live = start.copy(), np.arange(len(start))
    for _ in range(16):
        live = live[start[live] > 0]
        live = live[x[start[live] - 1] == x[start[live] - 1 + period[live]]]
        start[live] -= 1
    for k in live:
        end, q, block = start[k], period[k], 64
        while end:
            low = max(0, end - block)
            differ = np.flatnonzero(x[low:end] != x[low + q : end + q])
            if len(differ):
                end = low + differ[-1] + 1
                break
            end, block = low, 4 * block
        start[k] = end
    return start


def runs_of(x: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least twice their smallest period, by start and period."""
    start, period = branching_squares(x)
    end = start + 2 * period
    s = np.lexsort((period, end))
    start, period, end = start[s], period[s], end[s]
    same = np.zeros(len(s), bool)
    same[1:] = (end[1:] == end[:-1]) & (period[1:] == period[:-1])
    start, period, end = start[~same], period[~same], end[~same]
    found = []
    while len(start):
        head = np.ones(len(start), bool)
        head[1:] = end[1:] != end[:-1]
        at, group = np.flatnonzero(head), np.cumsum(head) - 1
        begin = _rotations(x, start[at], period[at])
        found.append(np.stack((begin, end[at] - begin, period[at]), 1))
        rest = ~head & ~((period % period[at][group] == 0) & (begin[group] <= start))
        start, period, end = start[rest], period[rest], end[rest]
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _slice(texts: list[list[bytes]], least: int, times: int) -> tuple[list[np.ndarray], list[bytes]]:
    """Runs and collapsed text of each list of words."""
    codes, n = [], 0
    for words in texts:
        names: dict[bytes, int] = {}
        codes += [n + names.setdefault(w, len(names)) for w in words]
        codes.append(n + len(names))
        n += len(names) + 1
    x = np.array(codes, np.int64)
    edge = np.cumsum([0, *(len(w) + 1 for w in texts)])
    runs = runs_of(x)
    runs = runs[runs[:, 1] >= np.maximum(least, times * runs[:, 2])]
    drop = np.zeros(len(x) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(drop) == 0
    cut = np.searchsorted(runs[:, 0], edge)
    own, out = [], []
    for words, (a, _), (r, s) in zip(texts, pairwise(edge), pairwise(cut), strict=True):
        own.append(runs[r:s] - [a, 0, 0])
        out.append(b" ".join(words[i] for i in np.flatnonzero(kept[a : a + len(words)])) if s > r else b" ".join(words))
    return own, out


def _batch(keep: list[pa.Array], names: list[str], texts: list[list[bytes]], least: int, times: int) -> pa.RecordBatch:
    runs, collapsed = _slice(texts, least, times)
    flat = np.concatenate([*runs, np.zeros((0, 3), np.int64)]).astype(np.int64)
    rows = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, runs)]), pa.int32()), rows)
    found = pa.StructArray.from_arrays([pa.array([len(w) for w in texts], pa.int64()), lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])
    return pa.RecordBatch.from_arrays([*keep, found], [*names, "__runs"])


def find_runs(df: DataFrame, keep: list[str], text: str = "text", least: int = 6, times: int = 4) -> DataFrame:
    """The columns ``keep`` and a struct ``__runs``: n_words, runs (start, length, period; in words, from 0), collapsed.

    A run has at least ``least`` words and ``times`` periods. ``collapsed`` is the text, its words joined by one blank, without
    the words that a run holds after its first period.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first, n = batch.column(len(keep)).cast(pa.binary()), 0, 0
            held: list[list[bytes]] = []
            for i in range(batch.num_rows):
                held.append((texts[i].as_py() or b"").split())
                n += len(held[-1]) + 1
                if n >= SLICE_WORDS or i == batch.num_rows - 1:
                    yield _batch(batch.slice(first, len(held)).columns[: len(keep)], keep, held, least, times)
                    held, first, n = [], i + 1, 0

    rows = df.select(*keep, F.col(text).alias("__text"))
    schema = StructType(df.select(*keep).schema.fields).add("__runs", StructType.fromDDL(FOUND))
    return rows.mapInArrow(scan, schema)


def with_loop(text: Column, key: Column) -> Column:
    """The contract's texts: in one of ten, by the id's checksum, the words from one on repeat those of a stretch; a null id has none."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def looped(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(_let(F.struct(a.alias("a"), p.alias("p")), lambda c: F.transform(words, lambda w, i: F.when(i < c["a"], w).otherwise(F.get(words, c["a"] + (i - c["a"]) % c["p"])))), " ")

    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    return F.when(h % 10 == 0, _let(words, lambda w: F.when(F.size(w) > 0, looped(w)))).otherwise(text)


def query(spark, sf_dir: str) -> DataFrame:
    """op11: the runs of every text of ``documents``, some with a loop put in, as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", with_loop(F.col("text"), F.col("doc_id")).alias("text"))
    found = find_runs(docs, ["doc_id"]).select("doc_id", "__runs.*")
    # exact comparison of length / period: a is larger if a.length * b.period is over b.length * a.period; runs come by start and period
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", F.lit(0)), lambda m, r: F.when(r["length"] * m["period"] > m["length"] * r["period"], r).otherwise(m))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
