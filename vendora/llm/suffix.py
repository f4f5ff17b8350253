"""Deduplication of long repeated strings by sampled anchors.

Wanted are all bytes covered by a string of ``length`` bytes that also starts elsewhere. The dealt method, a suffix array
of every byte by external induced sorting, moves a tuple of suffix and common prefix for each byte of the corpus (some
12 GB for 0.9 GB of text). What induced sorting does first, choosing suffixes by a rule that depends on the text alone and
deriving the others from them, is all that finding repeats needs; no suffixes are put in order and no prefixes carried:

1. Anchor. A string's anchor is where the 16-byte names in it are least, names being compared in a fixed random order,
   as S*-suffixes are local minima of a text. The choice depends on the string alone, so equal
   strings have equal anchors; strings with the same anchor start next to each other.
2. Group. One tuple for each anchor (about one for 60 bytes) carries the name of the common core of its
   strings and of their full extent. A core met once has no repeated string. If all tuples of a core agree in full
   extent, every string does.
3. Tell apart. Only where tuples share the core but not the extent, strings are compared one by one: for one tuple of
   each extent each string is named by its own bytes, and names are grouped again.

Names are 64-bit polynomials over mixed eight-byte windows; two strings count as equal if the names of core and
string agree (128 bits). Cores and strings that very many places share are dealt over several tasks.

Defined cases: a null text counts as empty; texts under ``length`` bytes lose nothing; repeated rows repeat each
other's strings; a null id is an id like others; texts of any length are cut in parts that overlap by a string; an empty
table gives an empty result; other columns stay, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import _saved, free, keyed, spread_join
from .text import U, give_back, mix

LENGTH = 200
SEGMENT = 1 << 20
#: Passes of the sort that tells strings apart.
PARTS = 4
_BASES = [(b := 0xD6E8FEB86659FD93), pow(b, -1, 1 << 64)], [(b := 0xA0761D6478BD642F), pow(b, -1, 1 << 64)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _margins(length: int) -> tuple[int, int, int]:
    """Bytes before the range in which a string's sample is sought, places in that range, and bytes of a name."""
    return length * 18 // 100, max(1, length * 60 // 100), max(1, min(16, length * 8 // 100))


def windows(buffer: np.ndarray, width: int) -> np.ndarray:
    """A mixed number for each ``width`` (at most 8) bytes of a buffer."""
    w, have = buffer.astype(U), 1
    while have < width:
        step = min(have, width - have)
        w = w[:-step] | w[step:] << U(8 * step) if step == have else (w[:-step] << U(8 * step)) ^ mix(w[step:])
        have += step
    return mix(w)


class Names:
    """Names of substrings of a buffer that are ``width`` bytes or longer: names(start, end)."""

    def __init__(self, values: np.ndarray, which: int, width: int):
        n, self.short = len(values), width - 1
        if which not in _powers or len(_powers[which][0]) < n + 1:
            tables = []
            for b in _BASES[which]:
                x = np.full(max(n + 1, SEGMENT + SEGMENT // 2), U(b))
                x[0] = 1
                tables.append(np.cumprod(x, dtype=U))
            _powers[which] = tables[0], tables[1]
        up, self.down = _powers[which]
        self.total = np.zeros(n + 1, U)
        np.cumsum(values * up[:n], out=self.total[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end - self.short] - self.total[start]) * self.down[start] + (end - start).astype(U))


def samples(names: Names, n_bytes: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lo, hi, sample): strings that start from lo to hi have that sample; over one buffer without regard to texts."""
    left, places, size = _margins(length)
    n = n_bytes - length + 1
    at = np.arange(n_bytes - size + 1)
    # the name's upper half orders, the place in the lower half makes ties go to the left
    least = (names(at, at + size) & U(0xFFFFFFFF00000000)) | at.astype(U)
    width = 1
    while width * 2 <= places:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < places:
        least = np.minimum(least[: -(places - width)], least[places - width :])
    sample = (least[left : left + n] & U(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(sample[1:] != sample[:-1]) + 1
    lo = np.concatenate(([0], cut))
    return lo, np.concatenate((cut, [n])) - 1, sample[lo]


def _segments(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Buffers of about SEGMENT bytes with (text, offset in it, start, end in the buffer); a long text is cut so that each string lies in one part."""
    held, parts, size = [], [], 0
    for i, t in enumerate(texts):
        for off in range(0, max(len(t) - length + 1, 0), SEGMENT):
            piece = t[off : off + SEGMENT + length - 1]
            held.append(piece)
            parts.append((i, off, size, size + len(piece)))
            size += len(piece)
            if size >= SEGMENT:
                yield np.frombuffer(b"".join(held), np.uint8), parts
                held, parts, size = [], [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), parts


def _texts(batch: pd.DataFrame) -> list[bytes]:
    return [t.encode() if isinstance(t, str) else b"" for t in batch["t"]]


def _tuples(length: int):
    left, places, size = _margins(length)
    width = min(8, size)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for buffer, parts in _segments(_texts(batch), length):
                values = windows(buffer, width)
                core, extent = Names(values, 0, width), Names(values, 1, width)
                lo, hi, sample = samples(core, len(buffer), length)
                starts, ends = np.array([p[2] for p in parts]), np.array([p[3] for p in parts])
                # cut ranges where a text ends: strings that would cross it don't exist
                out = []
                first = np.searchsorted(hi, starts)
                last = np.searchsorted(lo, ends - length, "right")
                for (i, off, s, e), a, b in zip(parts, first, last, strict=True):
                    l, h, p = np.maximum(lo[a:b], s), np.minimum(hi[a:b], e - length), sample[a:b]
                    out.append((np.full(len(l), i), np.full(len(l), off - s), l, h, p))
                text, shift, lo, hi, sample = (np.concatenate(x) for x in zip(*out, strict=True))
                # all strings of a sample hold this much around it
                r = core(sample - left, sample - left - places + 1 + length)
                u = mix(extent(lo, hi + length) + mix((sample - lo).astype(U)))
                yield pd.DataFrame({"k": batch["k"].to_numpy()[text], "h": batch["h"].to_numpy()[text], "lo": (lo + shift).astype(np.int64), "n": (hi - lo + 1).astype(np.int32), "r": r.view(np.int64), "u": u.view(np.int64)})
        give_back()

    return rows


def _strings(length: int):
    width = min(8, _margins(length)[2])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, wanted in zip(_texts(batch), batch["w"], strict=True):
                for at in range(0, len(wanted), 4000):
                    some = wanted[at : at + 4000]
                    lo = np.array([x["lo"] for x in some])
                    n = np.array([x["n"] for x in some])
                    start = np.repeat(lo, n) + np.concatenate([np.arange(k) for k in n])
                    origin = int(start.min())
                    buffer = np.frombuffer(text, np.uint8)[origin : int(start.max()) + length]
                    name = Names(windows(buffer, width), 1, width)(start - origin, start - origin + length)
                    yield pd.DataFrame({
                        "r": np.repeat(np.array([x["r"] for x in some]), n), "u": np.repeat(np.array([x["u"] for x in some]), n), "m": np.repeat(np.array([x["m"] for x in some]), n),
                        "d": (start - np.repeat(lo, n)).astype(np.int32), "s": name.view(np.int64),
                    })
        give_back()

    return rows


def _covered(n: int, starts, ends) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


CUT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"


def _cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    rows = []
    for t, a, b in zip(texts, starts, ends, strict=True):
        kept = text = t.encode() if isinstance(t, str) else b""
        gone = runs = 0
        if a is not None and len(a):
            hit = _covered(len(text), a, b)
            gone, runs = int(hit.sum()), int(hit[0]) + int((hit[1:] & ~hit[:-1]).sum())
            kept = np.frombuffer(text, np.uint8)[~hit].tobytes()
        rows.append((len(text), gone, runs, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
    return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(k, h, spans): for each text with a repeated string, by id and hash of the text, byte ranges [a, b) that cover its repeats."""
    spark, docs = df.sparkSession, keyed(df, key, text)
    tuples = _saved(docs.mapInPandas(_tuples(length), "k long, h long, lo long, n int, r long, u long"), "tuples")
    cores = tuples.groupBy("r").agg(F.count("*").alias("n"), F.min("u").alias("u1"), F.max("u").alias("u2")).filter("n > 1")
    cores = _saved(cores.select("r", "n", (F.col("u1") != F.col("u2")).alias("mixed")), "cores")
    shared = _saved(spread_join(tuples, cores.select("r", "mixed"), ["r"], cores.select("r", "n")), "shared")
    free(spark, tuples, cores)
    extents = _saved(shared.filter("mixed").groupBy("r", "u").agg(F.count("*").alias("m"), F.min(F.struct("k", "h", "lo", "n")).alias("one")), "extents")
    wanted = extents.groupBy(F.col("one.k").alias("k"), F.col("one.h").alias("h")).agg(F.collect_list(F.struct(F.col("one.lo").alias("lo"), F.col("one.n").alias("n"), "r", "u", "m")).alias("w"))
    named = _saved(docs.join(wanted, ["k", "h"]).mapInPandas(_strings(length), "r long, u long, m long, d int, s long"), "strings")
    free(spark)
    # the sort of all strings is done in parts by name of the core, so that one part's files are on disk at a time
    singles = []
    for part in range(PARTS):
        some = named.filter(F.pmod("r", F.lit(PARTS)) == part)
        again = _saved(some.groupBy("r", "s").agg(F.sum("m").alias("m"), F.count("*").alias("n")).filter("m > 1").select("r", "s", "n"), "again")
        singles.append(_saved(spread_join(some.filter("m = 1"), again.select("r", "s"), ["r", "s"], again).groupBy("r", "u").agg(F.collect_list("d").alias("ds")), "singles"))
        free(spark, again)
    free(spark, named)
    single = reduce(DataFrame.unionByName, singles)
    whole = F.struct(F.col("lo").alias("a"), (F.col("lo") + F.col("n") - 1 + length).alias("b"))
    full = shared.filter("NOT mixed").select("k", "h", whole.alias("span"))
    told = extents.select("r", "u", "m").join(single, ["r", "u"], "left")
    mixed = spread_join(shared.filter("mixed"), told, ["r", "u"], extents.select("r", "u", F.col("m").alias("n")))
    full = full.unionByName(mixed.filter("m > 1").select("k", "h", whole.alias("span")))
    some = mixed.filter("m = 1").select("k", "h", "lo", F.explode("ds").alias("d")).select("k", "h", F.struct((F.col("lo") + F.col("d")).alias("a"), (F.col("lo") + F.col("d") + length).alias("b")).alias("span"))
    spans = _saved(full.unionByName(some).groupBy("k", "h").agg(F.collect_set("span").alias("spans")), "spans")
    free(spark, shared, extents, *singles)
    return spans


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with a struct ``__cut``: n_bytes, n_removed, n_spans, kept_sha256 of the remaining bytes and kept_text, which drops parts of characters that a cut leaves. A column that has this name already is replaced."""
    spans = repeated_spans(df, key, text, length)
    spans = spans.select(F.col("k").alias("__k"), F.col("h").alias("__h"), F.transform("spans", lambda x: x["a"]).alias("__a"), F.transform("spans", lambda x: x["b"]).alias("__b"))
    ident = df[key].cast("long")
    both = df.join(spans, (F.xxhash64(df[text], ident.isNull()) == F.col("__h")) & (F.coalesce(ident, F.lit(0)) == F.col("__k")), "left")
    return both.select(*(df[c] for c in df.columns if c != "__cut"), F.pandas_udf(_cut, CUT)(df[text], F.col("__a"), F.col("__b")).alias("__cut"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: what is left of every text of ``documents`` without its repeated 200-byte strings."""
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", *(F.col(f"__cut.{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")))
