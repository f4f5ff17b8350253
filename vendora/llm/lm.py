"""Language-model scores from a hierarchical Pitman-Yor model.

Restaurants: one for each previous word, however rare (a text's start counts as one). Their parents are four class restaurants (start of
text, after a sentence, after a clause, elsewhere), which share the unigram restaurant; its parent spells words with byte restaurants of two, one
and no preceding bytes, down to a uniform base, so that any word has a probability. The end of a text is a word. As in the
base score, all words outside the training texts are one type: its probability is what the model leaves for
new words, times the spelling's mass outside the known ones, so that both are distributions over the same types.

Texts are cut into blocks of some BLOCK_TOKENS tokens; a block keeps its texts as numbers of its different pairs and sends these, packed in arrays, to the
shards of their words. A shard has all pairs of its words, with the words' spellings; owners have the tables of previous words. In a sweep shards and owners
send each other nothing but the numbers of tables, in an order fixed once. A pair met once has one table for ever and is not moved. All customers of a dish leave a
restaurant, with their tables' part in the parent, and the number of tables at which they are seated again is drawn from its conditional distribution under the Chinese-restaurant
rule, given the other dishes and restaurants as the sweep before left them (exactly up to EXACT customers, beyond from a saddle point). The strengths of class and unigram restaurants
are sampled after each sweep from their customers and tables; that of previous words is one for all, from expectations; discounts are the estimate n1 / (n1 + 2 n2) of each level.
Predictive probabilities are averaged over the sweeps kept. Byte restaurants hold at most 257 ** 3 counts and are sampled on the driver, as are strengths.

Scores: shards send each block the log10 probabilities of its pairs, in the block's order and rounded to 1 / LOG_STEPS, and the block sums them up by text.

Defined cases: a null text counts as empty and is the end token alone; repeated rows each get their score;
a null id is neither held out nor used to learn; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import shared_dir
from .components import free
from .langid import fold
from .text import _LOWER, U, Words, give_back, mix, runs

CLASSES = 4
BURN, KEEP = 2, 3
STRENGTH, SPELLING_DISCOUNT = 1.0, 0.5
#: Tokens of a block, bytes of text for each shard of pairs, turns in which shards are merged and answer, and steps of a log10 probability.
BLOCK_TOKENS, SHARD_BYTES, PARTS, LOG_STEPS = 4_000_000, 12 << 20, 4, 1 << 26
ROW = "part int, shard long, other long, q double, data array<binary>"
#: Tables of a restaurant whose indicators are drawn one by one when its strength is sampled.
DRAWN_TABLES = 20_000
#: Customers of a dish up to which their tables are drawn from the exact weights; numbers held at once for that.
EXACT, ROOM = 256, 500_000
WIDTHS = (2, 3, 4, 6, 9, 13, 20, 30, 45, 68, 100, 160)
#: Ratio of the numbers of customers beyond for which weights are tabled.
STEP = 1.05
_END_CLASS = np.full(256, 3, np.int64)
_END_CLASS[list(b".!?")] = 1
_END_CLASS[list(b",;:")] = 2
_END_NAME = mix(np.array([0xE0D], U))[0]


def _encoded(texts) -> Iterator[bytes]:
    """UTF-8 of each text, one at a time; null counts as empty."""
    return (t.encode() if isinstance(t, str) else b"" for t in texts)


def _giving_back(rows):
    """The function of a task; at the end its worker, which lives on beside the next stage's, returns the memory that it does not use."""

    @functools.wraps(rows)
    def run(batches: Iterator) -> Iterator:
        yield from rows(batches)
        give_back()

    return run


def tokens(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, and of every token (words, then an end for each text): name, class of context, name of the word before (0: none), text; and the place of its word (-1: an end)."""
    w = Words(texts)
    n = np.diff(w.first)
    text = np.repeat(np.arange(len(texts)), n + 1)
    place = np.full(len(text), -1)
    is_end = np.zeros(len(text), bool)
    is_end[np.cumsum(n + 1) - 1] = True
    place[~is_end] = np.arange(len(w.names))
    name = np.full(len(text), _END_NAME)
    name[~is_end] = w.names
    last = _END_CLASS[w.buffer[w.end - 1]] if len(w.names) else np.zeros(0, np.int64)
    kind, before = np.zeros(len(text), np.int64), np.zeros(len(text), U)
    # a token's context is the word before it in its text, or that word's class
    follows = np.flatnonzero(np.concatenate(([False], ~is_end[:-1]))) if len(text) else np.zeros(0, np.int64)
    kind[follows] = last[place[follows - 1]]
    before[follows] = w.names[place[follows - 1]]
    return w, name, kind, before, text, place


def _uniform(name: np.ndarray, draw: int) -> np.ndarray:
    return (mix(name + U(draw * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> U(11)).astype(np.float64) / (1 << 53)


@functools.cache
def _ways(discount: float) -> np.ndarray:
    """log of the weight of all ways to seat c customers at t tables (generalised Stirling numbers), row c, for c up to EXACT."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(EXACT + 1)
    for c in range(1, EXACT):
        with np.errstate(divide="ignore"):
            out[c + 1] = np.logaddexp(np.append(-np.inf, out[c, :-1]), out[c] + np.log(np.maximum(c - t * discount, 0)))
    return out


def _saddle(c: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log of the same weights for any c and t < c, less log(c! / t!) and a constant, from the saddle point 1 - y of their generating function ((1 - (1 - z) ** d) / d) ** t."""
    x = np.log(t) - np.log(c + t)  # log y
    for _ in range(25):
        y = np.exp(x)
        f = np.log(t * discount / c) + np.log1p(-y) + (discount - 1) * x - np.log(-np.expm1(discount * x))
        slope = -y / (1 - y) + (discount - 1) + discount * np.exp(discount * x) / -np.expm1(discount * x)
        x = np.minimum(x - np.clip(f / slope, -1, 1), -1e-12)
    y, inside = np.exp(x), -np.expm1(discount * x) / discount
    bend = t * ((1 - y) ** 2 * (1 - discount) * np.exp((discount - 2) * x) / inside + c / t - (c / t) ** 2)
    return t * np.log(inside) - c * np.log1p(-y) - 0.5 * np.log(bend)


@functools.cache
def _row(step: int, discount: float) -> np.ndarray:
    """log weights of 1 to EXACT // 2 tables for about EXACT * STEP ** step customers; what the saddle point misses is taken from the last exact row."""
    t = np.arange(1, EXACT // 2 + 1, dtype=np.float64)
    return _saddle(np.float64(EXACT * STEP**step), t, discount) + _ways(discount)[EXACT, 1 : len(t) + 1] - _saddle(np.float64(EXACT), t, discount)


def _many(c: np.ndarray, weight, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """(mode, variance) of the tables of ``c`` customers, ``weight(t)`` being that of one table more.

    With a constant weight a, the ways to seat c customers have the generating function exp(a (1 - (1 - z) ** d) / d): the saddle point z = 1 - y
    solves a (1 - y) y ** (d - 1) = c, and a (1 - y ** d) / d tables are expected there.
    """

    def expected(a: np.ndarray) -> np.ndarray:
        x = np.log(a) - np.log(a + c)  # log y; its equation falls in it and is convex enough for Newton's steps
        for _ in range(12):
            y = np.exp(x)
            f = np.log(a) + np.log1p(-y) + (discount - 1) * x - np.log(c)
            x = np.minimum(x - f / (-y / (1 - y) + discount - 1), -1e-12)
        return a * -np.expm1(discount * x) / discount

    low, high = np.zeros(len(c)), np.log(c)
    for _ in range(15):  # where as many are expected as there are
        middle = np.exp((low + high) / 2)
        more = expected(weight(middle)) > middle
        low, high = np.where(more, (low + high) / 2, low), np.where(more, high, (low + high) / 2)
    t = np.exp((low + high) / 2)
    a = weight(t)
    v = np.maximum((expected(a * 1.01) - expected(a)) / np.log(1.01), 1e-9)
    slope = np.log(weight(t + 1)) - np.log(a)
    return t, v / np.maximum(1 - v * slope, 0.1)


def seat(customers: np.ndarray, others: np.ndarray, strength: np.ndarray | float, discount: float, above: np.ndarray, total: np.ndarray | float, name: np.ndarray, draw: int, feeds: int = 1) -> np.ndarray:
    """Tables of the ``customers`` of each dish in a restaurant that they had left, drawn given all else.

    t tables have the weight of all seatings of so many customers at t tables times that of each new table: (strength + discount *
    tables there) * the parent's probability. ``others`` is the number of tables that serve other dishes; with t tables here, the parent's
    probability is (above + feeds * t) / (total + feeds * t), as each of them is a customer there. Up to EXACT customers the draw is
    exact; for more, few tables are drawn from weights by a saddle point, many from the normal curve there.
    """
    tables = (customers > 0).astype(np.int64)
    full = [np.broadcast_to(np.asarray(x, np.float64), customers.shape) for x in (others, strength, above, total)]

    def weight(at: np.ndarray):
        o, s, up, all_ = (x[at] for x in full)
        return lambda t: (s + discount * (o + t)) * (up + feeds * t) / (all_ + feeds * t)

    def drawn(at: np.ndarray, ways: np.ndarray) -> None:
        for part in np.array_split(np.arange(len(at)), ways.size // ROOM + 1):
            o, s, up, all_ = (x[at[part]][:, None] for x in full)
            t = np.arange(1, ways.shape[1])
            new = np.log((s + discount * (o + t)) * (up + feeds * t) / (all_ + feeds * t))
            p = ways[part]
            p[:, 1:] += np.cumsum(new, 1)  # the first table is certain
            p = np.cumsum(np.exp(p - p.max(1, keepdims=True)), 1)
            tables[at[part]] = 1 + (p < (_uniform(name[at[part]], draw) * p[:, -1])[:, None]).sum(1)

    few = np.flatnonzero((customers > 1) & (customers <= EXACT))
    few = few[np.argsort(customers[few], kind="stable")]
    # those of similar size together, in rows as long as the largest needs
    for at in np.split(few, np.searchsorted(customers[few], WIDTHS, "right")):
        if len(at):
            drawn(at, _ways(discount)[customers[at], 1 : customers[at[-1]] + 1])
    at = np.flatnonzero(customers > EXACT)
    if len(at):
        c = customers[at].astype(np.float64)
        mode, v = _many(c, weight(at), discount)
        low = mode + 8 * np.sqrt(v) + 8 < EXACT // 2
        step = np.round(np.log(c / EXACT) / np.log(STEP)).astype(int)
        if low.any():
            steps, of = np.unique(step[low], return_inverse=True)
            drawn(at[low], np.stack([_row(int(i), discount) for i in steps])[of])
        at, mode, v = at[~low], mode[~low], v[~low]
        z = np.sqrt(-2 * np.log(np.maximum(_uniform(name[at], draw + 1), 1e-300))) * np.cos(2 * np.pi * _uniform(name[at], draw + 2))
        tables[at] = np.clip(np.floor(mode + z * np.sqrt(v) + _uniform(name[at], draw + 3)), 1, customers[at])
    return tables


@dataclass
class Spelling:
    """Byte restaurants: ``table[b2, b1, b]`` is log10 P(b after b2, b1) over the ``symbols`` met, the last row an unmet one; symbol 256 ends a word."""

    index: np.ndarray
    table: np.ndarray

    def log10(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        size = np.array([len(x) + 1 for x in words])
        flat = np.full(int(size.sum()), self.index[256], np.int64)
        at = np.cumsum(size)
        inner = np.ones(len(flat), bool)
        inner[at - 1] = False
        flat[inner] = self.index[np.frombuffer(b"".join(words), np.uint8)]
        before1 = np.concatenate(([self.index[256]], flat[:-1]))
        before2 = np.concatenate(([self.index[256]], before1[:-1]))
        start = at - size
        before2[start] = self.index[256]
        before2[np.minimum(start + 1, len(flat) - 1)[size > 1]] = self.index[256]
        before1[start] = self.index[256]
        return np.add.reduceat(self.table[before2, before1, flat], start)


def spelling(counts: pd.DataFrame, discount: float, draw: int) -> Spelling:
    """Sampled from counts of (b2, b1, b), coded to base 257."""
    code, n = counts["code"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    met = np.unique(np.concatenate((code // 257**2, code // 257 % 257, code % 257, [256])))
    index = np.full(257, len(met), np.int64)
    index[met] = np.arange(len(met))
    m = len(met) + 1
    c2 = np.zeros((m, m, m), np.int64)
    c2[index[code // 257**2], index[code // 257 % 257], index[code % 257]] = n
    base = np.full(m, 1 / 257)

    def draw_tables(c: np.ndarray, parent: np.ndarray, salt: int) -> np.ndarray:
        others = np.broadcast_to((c > 0).sum(-1, keepdims=True) - 1, c.shape)
        met, out = np.nonzero(c), np.zeros_like(c)
        name = mix(np.ravel_multi_index(met, c.shape).astype(U) + U(salt << 40))
        out[met] = seat(c[met], others[met], STRENGTH, discount, np.broadcast_to(parent, c.shape)[met], 1.0, name, draw, feeds=0)
        return out

    def predict(c: np.ndarray, t: np.ndarray, parent: np.ndarray) -> np.ndarray:
        total, opened = c.sum(-1, keepdims=True), t.sum(-1, keepdims=True)
        return (c - discount * t + (STRENGTH + discount * opened) * parent) / (STRENGTH + total)

    # a first guess of the parents from minimal seating, then one draw from the longest contexts down
    c1 = (c2 > 0).sum(0)
    c0 = (c1 > 0).sum(0)
    p1 = predict(c1, (c1 > 0).astype(np.int64), predict(c0, (c0 > 0).astype(np.int64), base))
    t2 = draw_tables(c2, p1[None], 1)
    c1 = t2.sum(0)
    t1 = draw_tables(c1, predict(c0, (c0 > 0).astype(np.int64), base)[None], 2)
    c0 = t1.sum(0)
    t0 = draw_tables(c0, base, 3)
    p2 = predict(c2, t2, predict(c1, t1, predict(c0, t0, base))[None])
    return Spelling(index, np.log10(p2))


@dataclass
class State:
    """One sweep: customers, tables and strength of each class, of the unigram restaurant (the last of each), both levels' discounts, the spelling, and the strength and discount of all previous words' restaurants."""

    customers: np.ndarray
    tables: np.ndarray
    strength: np.ndarray
    discounts: tuple[float, float]
    spell: Spelling
    word: tuple[float, float] = (STRENGTH, 0.5)

    def unigram(self, c, t, spelled):
        d = self.discounts[1]
        return (c - d * t + (self.strength[-1] + d * self.tables[-1]) * spelled) / (self.strength[-1] + self.customers[-1])

    def share(self, k):
        """What contexts leave to their parent."""
        return (self.strength[k] + self.discounts[0] * self.tables[k]) / (self.strength[k] + self.customers[k])

    def in_context(self, k, c, t, unigram):
        return (c - self.discounts[0] * t) / (self.strength[k] + self.customers[k]) + self.share(k) * unigram


def draw_strength(theta: float, discount: float, customers: float, tables: float, rng: np.random.Generator) -> float:
    """A strength given the seating of its restaurant, under a Gamma(1, 1) prior, by the usual auxiliary variables."""
    if customers < 2:
        return theta
    x = max(rng.beta(theta + 1, customers - 1), 1e-300)
    i = np.arange(1, min(tables, DRAWN_TABLES))
    y = int((rng.random(len(i)) < theta / (theta + discount * i)).sum())
    if tables > DRAWN_TABLES:
        y += rng.poisson(theta / discount * np.log(tables / DRAWN_TABLES))
    return rng.gamma(1 + y) / (1 - np.log(x))


def reseat(row: np.ndarray, k: np.ndarray, c: np.ndarray, s: np.ndarray, t: np.ndarray, names: np.ndarray, spelled: np.ndarray, st: State, draw: int) -> tuple[np.ndarray, np.ndarray]:
    """New tables of each word in each context (``row``, ``k``, customers ``c``, tables ``s``) and in the unigram restaurant (``t``).

    A word's customers leave a restaurant before they are seated again: its own tables count neither there nor, as customers, in the
    parent, where tables go with those who leave in proportion. All restaurants do so at once, each given the others of the sweep before.
    """
    d0, d1 = st.discounts
    name = names[row]
    whole = np.bincount(row, s, len(t))
    stay = whole[row] - s
    left = np.clip(np.floor(t[row] * stay / np.maximum(whole[row], 1) + _uniform(name + mix(k.astype(U) + U(7)), draw)), stay > 0, stay)
    above = stay - d1 * left + (st.strength[-1] + d1 * (st.tables[-1] - t[row] + left)) * spelled[row]
    new = seat(c, st.tables[k] - s, st.strength[k], d0, above, st.strength[-1] + st.customers[-1] - s, mix(name + mix(k.astype(U) + U(1))), draw)
    up = seat(np.bincount(row, new, len(t)).astype(np.int64), st.tables[-1] - t, st.strength[-1], d1, spelled, 1.0, names, draw << 4, feeds=0)
    return new, up

def _digamma(x):
    """For x > 0, by recurrence and its asymptotic series."""
    x = np.asarray(x, np.float64)
    y, less = x + 8, sum(1 / (x + i) for i in range(8))
    return np.log(y) - 1 / (2 * y) - 1 / (12 * y**2) + 1 / (120 * y**4) - 1 / (252 * y**6) - less


def shared_strength(theta: float, discount: float, customers: pd.DataFrame, tables: pd.DataFrame) -> float:
    """The strength that many restaurants share, under a Gamma(1, 1) prior, from numbers ``m`` of those with ``x`` customers and with ``x`` tables.

    The auxiliary variables of :func:`draw_strength` stand at their expectations, until the strength stays as it is.
    """
    c, nc, t, nt = (f[x].to_numpy(np.float64) for f in (customers, tables) for x in ("x", "m"))
    for _ in range(50):
        opened = theta / discount * (_digamma(theta / discount + np.maximum(t, 1)) - _digamma(theta / discount + 1))
        theta = (1 + (nt * opened).sum()) / (1 + (nc * (_digamma(theta + np.maximum(c, 1)) - _digamma(theta + 1))).sum())
    return float(theta)


def _discount(n1: int, n2: int) -> float:
    return min(max(n1 / max(n1 + 2 * n2, 1), 0.05), 0.95)


def _pair_names(name: np.ndarray, k: np.ndarray) -> np.ndarray:
    return mix(name + mix(k.astype(U) + U(1)))


def _pack(x: np.ndarray, ascending: bool = False) -> bytes:
    """An array as its length and its bytes by significance, compressed; of an ascending one the steps."""
    x = np.ascontiguousarray(np.diff(x, prepend=x.dtype.type(0)) if ascending else x)
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def _unpack(x: bytes, kind=np.int64, ascending: bool = False) -> np.ndarray:
    n, size = int.from_bytes(x[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.decompress(x[8:], n, "zstd", asbytes=True), np.uint8)
    out = np.array(planes.reshape(size, n // size).T, order="C").view(kind).reshape(-1)
    return np.cumsum(out, dtype=kind) if ascending else out


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ROW: part, shard, other, q, data."""
    kinds = pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["part", "shard", "other", "q", "data"])


def _read(x) -> list[tuple]:
    """The rows of a table or batch, in the order of part and other."""
    return sorted(zip(*(x.column(c).to_pylist() for c in ("part", "shard", "other", "q", "data")), strict=True), key=lambda r: (r[0], r[2]))


def _grouped(df: DataFrame, by: str, f) -> DataFrame:
    """``f`` of the rows of each key, at the end of which the worker gives back memory."""

    def group(table: pa.Table) -> pa.Table:
        out = pa.Table.from_batches([_rows(f(_read(table)))])
        del table
        give_back()
        return out

    return df.groupBy(by).applyInArrow(group, ROW)


class Parts:
    """A written table of rows of ROW; a part is read, and deleted, on its own."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, shared_dir(df.sparkSession, name)
        df.write.partitionBy("part").option("compression", "uncompressed").parquet(self.path)

    def of(self, part: int, mark: int | None = None) -> DataFrame:
        """A part's rows, with ``mark`` as their part."""
        out = self.spark.read.schema(ROW).parquet(self.path).filter(F.col("part") == part)
        out = out.select(F.lit(part if mark is None else mark).alias("part"), "shard", "other", "q", "data")
        out.scratch = f"{self.path}/part={part}"
        return out

    def free(self, *parts: int) -> None:
        free(self.spark, *(self.of(p) for p in parts))


def _gathered(buffer: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of ``buffer``, one after another."""
    at = np.cumsum(size) - size
    return buffer[np.arange(int(size.sum())) + np.repeat(start - at, size)]


class Block:
    """Tokens of many texts, until they are cut into pairs for each shard."""

    def __init__(self, shards: int):
        self.shards, self.n = shards, 0
        self.docs, self.runs, self.words = [], [], []

    def add(self, texts: list[bytes], keys: np.ndarray, none: np.ndarray, outs: np.ndarray, learn: np.ndarray) -> None:
        w, name, kind, before, text, place = tokens(texts)
        own, first, where = np.unique(_pair_names(name, before), return_index=True, return_inverse=True)
        n = np.bincount(where, learn[text], len(own)).astype(np.int64)
        self.runs.append((name[first], before[first], kind[first].astype(np.uint8), n, where.astype(np.int32)))
        self.docs.append((keys, none, outs, np.bincount(text, minlength=len(texts))))
        names, at = np.unique(name[first], return_index=True)
        at = place[first[at]]
        size = np.where(at >= 0, w.end[at] - w.start[at], 0) if len(w.names) else np.zeros(len(at), np.int64)  # the end of a text is the empty word
        start = w.start[at] if len(w.names) else np.zeros(len(at), np.int64)
        self.words.append((names, size, _LOWER[_gathered(w.buffer, start, size)]))
        self.n += len(name)

    def rows(self, block: int) -> Iterator[tuple]:
        """The block's texts as numbers of pairs, and its pairs for each shard, by word and previous word."""
        name, before, kind, n = (np.concatenate([r[i] for r in self.runs]) for i in range(4))
        names, name_of = np.unique(name, return_inverse=True)
        order = np.argsort(names % U(self.shards), kind="stable")
        rank = np.empty(len(names), np.int64)
        rank[order] = np.arange(len(names))
        names = names[order]
        ks, k_of = np.unique(before, return_inverse=True)
        kinds = np.zeros(len(ks), np.uint8)
        kinds[k_of] = kind
        pairs, where = np.unique(rank[name_of] << 32 | k_of, return_inverse=True)
        n = np.bincount(where, n, len(pairs)).astype(np.int64)
        at = np.cumsum([0, *(len(r[0]) for r in self.runs)])
        idx = np.concatenate([where[a:b].astype(np.int32)[r[4]] for a, b, r in zip(at[:-1], at[1:], self.runs, strict=True)])
        yield PARTS, block, block, 0.0, [_pack(np.concatenate([d[i] for d in self.docs])) for i in range(4)] + [_pack(idx)]
        named, sizes = (np.concatenate([x[i] for x in self.words]) for i in range(2))
        _, pick = np.unique(named, return_index=True)
        pick, buffer, start = pick[order], np.concatenate([x[2] for x in self.words]), np.cumsum(sizes) - sizes
        word, k = pairs >> 32, pairs & 0xFFFFFFFF
        to = (names % U(self.shards)).astype(np.int64)
        edges = np.flatnonzero(np.diff(to, prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(names)], strict=True):
            c, d = np.searchsorted(word, (a, b))
            own, of = np.unique(k[c:d], return_inverse=True)
            size = sizes[pick[a:b]]
            text = _gathered(buffer, start[pick[a:b]], size)
            data = [_pack(names[a:b], True), _pack(np.bincount(word[c:d] - a, minlength=b - a)), _pack(ks[own], True), _pack(kinds[own]), _pack(of.astype(np.int32)), _pack(n[c:d]), _pack(size), _pack(text)]
            yield int(to[a]) % PARTS, int(to[a]), block, 0.0, data


def _cut(shards: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, block = TaskContext.get().partitionId() << 24, 0, Block(shards)
        for batch in batches:
            keys, none, outs, learn = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "no", "held_out", "learn"))
            for at, run in runs(x.as_py().encode() if x.is_valid else b"" for x in batch.column("text")):
                s = slice(at, at + len(run))
                block.add(run, keys[s], none[s], outs[s], learn[s])
                if block.n >= BLOCK_TOKENS:
                    for r in block.rows(part + seq):
                        yield _rows([r])
                    seq, block = seq + 1, Block(shards)
        if block.n:
            for r in block.rows(part + seq):
                yield _rows([r])

    return rows


class Pairs:
    """Pairs of a shard by word and previous word: words ``names``, previous words ``ks`` with classes ``kinds``; of each pair ``word`` and ``k`` in these and its number ``n``."""

    def __init__(self, data: list[bytes]):
        self.names, sizes, self.ks, self.kinds = _unpack(data[0], U, True), _unpack(data[1]), _unpack(data[2], U, True), _unpack(data[3], np.uint8)
        self.word, self.k, self.n = np.repeat(np.arange(len(sizes)), sizes), _unpack(data[4], np.int32).astype(np.int64), _unpack(data[5])


def _merge(shards: int, learns: bool):
    """From the pairs that blocks send to a shard: its pairs (0), where those of each block stand (1), customers and tables of previous words for their owners (2), its words and
    the pairs met more than once (3), and numbers for the discounts (4)."""

    def shard(rows: list[tuple]) -> list[tuple]:
        at, got = rows[0][1], [Pairs(r[4]) for r in rows]
        names, ks = np.unique(np.concatenate([p.names for p in got])), np.unique(np.concatenate([p.ks for p in got]))
        kinds, code = np.zeros(len(ks), np.uint8), []
        for p in got:
            k = np.searchsorted(ks, p.ks)
            kinds[k] = p.kinds
            code.append(np.searchsorted(names, p.names)[p.word] << 32 | k[p.k])
        n = np.concatenate([p.n for p in got])
        edges = np.cumsum([len(x) for x in code])[:-1]
        pairs, where = np.unique(np.concatenate(code), return_inverse=True)
        n = np.bincount(where, n, len(pairs)).astype(np.int64)
        del code, got
        word, k = pairs >> 32, pairs & 0xFFFFFFFF
        out = [(0, at, 0, 0.0, [_pack(names, True), _pack(np.bincount(word, minlength=len(names))), _pack(ks, True), _pack(kinds), _pack(k.astype(np.int32)), _pack(n)])]
        out += [(1, at, r[2], 0.0, [_pack(x.astype(np.int32), True)]) for r, x in zip(rows, np.split(where, edges), strict=True) if r[2] >= 0]
        if not learns:
            return out
        words, sizes = [b""] * len(names), np.zeros(len(names), np.int64)
        for r in rows:
            here, size, text = np.searchsorted(names, _unpack(r[4][0], U, True)), _unpack(r[4][6]), _unpack(r[4][7], np.uint8)
            end = np.cumsum(size)
            new = np.flatnonzero(sizes[here] == 0)
            raw = text.tobytes()
            for i, a, b in zip(here[new].tolist(), (end - size)[new].tolist(), end[new].tolist(), strict=True):
                words[i] = raw[a:b]
            sizes[here] = size
        one, many, kind = n == 1, n > 1, kinds[k]
        sums = [np.bincount(k, x, len(ks)).astype(np.int64) for x in (n, one, many)]
        to = (ks % U(shards)).astype(np.int64)
        for owner in np.unique(to):
            own = to == owner
            out.append((2, int(owner), at, 0.0, [_pack(ks[own], True), *(_pack(x[own]) for x in sums)]))
        by_class = lambda x: np.bincount((kind * np.int64(len(names)) + word)[x], minlength=CLASSES * len(names))
        single, cs, wn = by_class(one), by_class(n > 0), np.bincount(word, n, len(names)).astype(np.int64)
        known = cs.reshape(CLASSES, -1)
        state = [_pack(names, True), _pack(wn), _pack(sizes), _pack(np.frombuffer(b"".join(words), np.uint8)), _pack(single), _pack(ks, True), _pack(kinds), _pack(word[many], True), _pack(k[many].astype(np.int32)), _pack(n[many])]
        out.append((3, at, 0, 0.0, [*state, _pack(cs), _pack(np.minimum(cs, 1)), _pack((known.sum(0) > 0).astype(np.int64)), _pack(np.ones(int(many.sum()), np.int64))]))
        numbers = [n.sum(), one.sum(), (n == 2).sum(), (wn > 0).sum(), *(((known > 0).sum(0) == i).sum() for i in (1, 2)), *((known == i).any(0).sum() for i in (1, 2))]
        return [*out, (4, at, 0, 0.0, [_pack(np.array(numbers, np.int64))])]

    return shard


#: Arrays of a shard's state that never change; after them come class customers and tables, unigram tables, tables of pairs, and what is kept of each kept sweep.
STATIC = 10


class Shard:
    """The state of a shard: its words with their customers (``cs``) and tables (``ss``) in each class and tables ``t`` in the unigram restaurant, and pairs met more than once (``c`` customers, ``s`` tables)."""

    def __init__(self, data: list[bytes]):
        self.data, self.names, self.n = data, _unpack(data[0], U, True), _unpack(data[1])
        size, raw = _unpack(data[2]), _unpack(data[3], np.uint8).tobytes()
        end = np.cumsum(size)
        self.words = [raw[a:b] for a, b in zip((end - size).tolist(), end.tolist(), strict=True)]
        self.cs, self.ss = (_unpack(data[i]).reshape(CLASSES, -1) for i in (STATIC, STATIC + 1))
        self.t = _unpack(data[STATIC + 2])

    def kept(self, st: State, u: np.ndarray) -> list[bytes]:
        """What predictions of a sweep need: customers and tables in classes, unigram probabilities, and tables of pairs."""
        return [_pack(self.cs.reshape(-1)), _pack(self.ss.reshape(-1)), _pack(u), self.data[STATIC + 3]]

    def spelled(self, st: State) -> np.ndarray:
        return 10 ** st.spell.log10(self.words)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, code, n): customers (0) and tables (1) of each class, the unigram's tables (2), and counts of letters to spell (3)."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        for r in _read(batch):
            t = Shard(r[4])
            size = np.array([len(x) + 1 for x in t.words], np.int64)
            flat = np.full(int(size.sum()), 256, np.int64)
            at = np.cumsum(size)
            inner = np.ones(len(flat), bool)
            inner[at - 1] = False
            flat[inner] = np.frombuffer(b"".join(t.words), np.uint8)
            b1 = np.concatenate(([256], flat[:-1]))
            b2 = np.concatenate(([256], b1[:-1]))
            start = at - size
            b2[start] = b1[start] = 256
            b2[(start + 1)[size > 1]] = 256
            code = 3 << 32 | b2 * 257**2 + b1 * 257 + flat
            sums = [(np.arange(CLASSES), t.cs.sum(1)), (1 << 32 | np.arange(CLASSES), t.ss.sum(1)), (np.array([2 << 32]), np.array([t.t.sum()])), (code, np.repeat(t.t, size))]
            every = np.concatenate([codes, *(x for x, _ in sums)])
            codes, of = np.unique(every, return_inverse=True)
            counts = np.bincount(of, np.concatenate([counts, *(x for _, x in sums)]), len(codes)).astype(np.int64)
    if len(codes):
        met = counts > 0
        yield pa.RecordBatch.from_arrays([pa.array((codes >> 32)[met].astype(np.int32)), pa.array((codes & 0xFFFFFFFF)[met]), pa.array(counts[met])], ["kind", "code", "n"])


def _owned(rows: list[tuple]) -> list[tuple]:
    """From what shards say of an owner's previous words: names, customers, tables of pairs met once and those of this sweep; and where each shard's stand."""
    got = [[_unpack(x, U if i == 0 else np.int64, i == 0) for i, x in enumerate(r[4])] for r in rows]
    ks, where = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
    sums = [np.bincount(where, np.concatenate([g[i] for g in got]), len(ks)).astype(np.int64) for i in (1, 2)]
    places = np.split(where, np.cumsum([len(g[0]) for g in got])[:-1])
    froms = np.array([r[2] for r in rows], np.int64)
    return [(0, rows[0][1], 0, 0.0, [_pack(ks, True), *map(_pack, sums), _pack(froms), *(_pack(x.astype(np.int32), True) for x in places)])]


def _seated(keep: bool):
    """An owner's previous words, then the tables that shards have counted: the owner's row, with the tables if they are ``keep``-t at its end (0), what each shard asks for (1), and how many have each number of customers and tables (2)."""

    def owner(rows: list[tuple]) -> list[tuple]:
        own, at = rows[0][4], rows[0][1]
        customers, tables, froms = _unpack(own[1]), _unpack(own[2]), _unpack(own[3]).tolist()
        places = {f: _unpack(own[4 + i], np.int32, True) for i, f in enumerate(froms)}
        for r in rows[1:]:
            tables[places[r[2]]] += _unpack(r[4][0])
        out = [(0, at, 0, 0.0, [*own, *([_pack(tables)] if keep else [])])]
        out += [(1, f, at, 0.0, [_pack(tables[p])]) for f, p in places.items()]
        counted = [np.unique(x[customers > 0], return_counts=True) for x in (customers, tables)]
        return [*out, (2, at, 0, 0.0, [_pack(x) for pair in counted for x in pair])]

    return owner


def _by_owner(ks: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    to = (ks % U(shards)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    edges = np.flatnonzero(np.diff(to[order], prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
        yield int(to[order[a]]), order[a:b]


def _sweep(j: int, state, shards: int):
    """From the seats of sweep j those of the next: first pairs, whose own tables leave the class restaurant above, then classes and unigram for their new customers.

    Gives the state (0) and the new tables of each previous word for its owner (1)."""

    def shard(rows: list[tuple]) -> list[tuple]:
        st: State = state.value
        data, at = rows[0][4], rows[0][1]
        t, w = Shard(data), len(_unpack(data[1]))
        single, ks, kinds = _unpack(data[4]).reshape(CLASSES, -1), _unpack(data[5], U, True), _unpack(data[6], np.uint8).astype(np.int64)
        word, k, c, s = _unpack(data[7], ascending=True), _unpack(data[8], np.int32), _unpack(data[9]), _unpack(data[STATIC + 3])
        here, replies = np.zeros(len(ks), np.int64), {r[2]: r[4][0] for r in rows[1:]}
        for owner, own in _by_owner(ks, shards):
            here[own] = _unpack(replies[owner])
        spelled = t.spelled(st)
        u = st.unigram(t.ss.sum(0), t.t, spelled)
        (strength, d), up, draw, kind = st.word, st.discounts[0], (j + 1) << 40, kinds[k]
        cc, ss = t.cs[kind, word], t.ss[kind, word]
        own, stay = _pair_names(t.names[word], ks[k]), cc - s
        left = np.clip(np.floor(ss * stay / np.maximum(cc, 1) + _uniform(mix(own + U(7)), draw)), stay > 0, stay)
        above = stay - up * left + (st.strength[kind] + up * (st.tables[kind] - ss + left)) * u[word]
        new = seat(c, here[k] - s, strength, d, above, st.strength[kind] + st.customers[kind] - s, own, draw)
        cs = single + np.bincount(kind * w + word, new, CLASSES * w).astype(np.int64).reshape(CLASSES, -1)
        row, cl = np.nonzero(cs.T)
        seats, opened = reseat(row, cl, cs[cl, row], t.ss[cl, row], t.t, t.names, spelled, st, (j + 1) << 32)
        tables = np.zeros_like(cs)
        tables[cl, row] = seats
        kept = t.kept(st, u) if j >= BURN else []
        out = [(0, at, 0, float(spelled[t.n > 0].sum()), [*data[:STATIC], _pack(cs.reshape(-1)), _pack(tables.reshape(-1)), _pack(opened), _pack(new), *data[STATIC + 4 :], *kept])]
        sums = np.bincount(k, new, len(ks)).astype(np.int64)
        return out + [(1, owner, at, 0.0, [_pack(sums[own])]) for owner, own in _by_owner(ks, shards)]

    return shard


def _last(state):
    """Of the last sweep's state what predictions need: names, numbers, and what was kept of each sweep."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _read(batch):
                t, st = Shard(r[4]), state.value
                spelled = t.spelled(st)
                kept = t.kept(st, st.unigram(t.ss.sum(0), t.t, spelled))
                yield _rows([(0, r[1], 0, float(spelled[t.n > 0].sum()), [*r[4][:2], *r[4][STATIC + 4 :], *kept])])

    return rows


@dataclass
class Corpus:
    """Texts as numbers of pairs in blocks, and the pairs of each shard with the places of each block's (parts 0 and 1 of ``merged``)."""

    cut: Parts
    merged: list[Parts]
    shards: int


@dataclass
class Model:
    """``corpus`` has the pairs; ``words`` of each shard the words and what was kept of each kept sweep; ``owners`` the previous words, their customers and, at the end, tables in
    kept sweeps; ``states`` are the kept sweeps' by number, ``spelled`` the sums of spellings of known words."""

    corpus: Corpus
    words: Parts
    owners: Parts
    n_tokens: int
    n_types: int
    states: dict[int, State]
    spelled: dict[int, float]


def _all(parts: list[Parts], part: int, mark: int | None = None) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, (p.of(part, mark) for p in parts))


def gather(df: DataFrame, learn: Column, text: str = "text", key: str | None = None, held_out: str | None = None, model: Model | None = None) -> Corpus:
    """Cut texts into blocks, and merge their pairs by word in shards; pairs of texts that are not to ``learn`` from count nothing. With ``model`` its pairs are merged with these.

    Shards go in PARTS turns, and what blocks sent to those of a turn is deleted after it."""
    spark = df.sparkSession
    ident = F.col(key).cast("long") if key else F.lit(0).cast("long")
    docs = df.select(
        F.coalesce(ident, F.lit(0)).alias("key"), F.when(ident.isNull(), 1).otherwise(0).cast("long").alias("no"), (F.coalesce(F.col(held_out), F.lit(False)) if held_out else F.lit(False)).cast("long").alias("held_out"),
        F.coalesce(learn, F.lit(False)).cast("long").alias("learn"), F.col(text).alias("text"),
    )
    shards = model.corpus.shards if model else max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SHARD_BYTES))
    cut, merged = Parts(docs.mapInArrow(_giving_back(_cut(shards)), ROW), "blocks"), []
    for g in range(PARTS):
        sent = cut.of(g)
        if model:
            own = _all(model.corpus.merged, 0).filter(F.col("shard") % PARTS == g).withColumn("other", F.lit(-1).cast("long"))
            sent = own.withColumn("part", F.lit(g)).unionByName(sent)
        merged.append(Parts(_grouped(sent, "shard", _merge(shards, model is None)), "pairs"))
        del sent
        cut.free(g)
    return Corpus(cut, merged, shards)


def fit(corpus: Corpus) -> Model:
    """Sample the seating."""
    spark, shards = corpus.cut.spark, corpus.shards
    numbers = sum((_unpack(r["data"][0]) for r in _all(corpus.merged, 4).select("data").collect()), np.zeros(8, np.int64))
    n, n1, n2, v, k1, k2, c1, c2 = map(int, numbers)
    discounts, d = (_discount(c1, c2), _discount(k1, k2)), _discount(n1, n2)
    owners, words = Parts(_grouped(_all(corpus.merged, 2), "shard", _owned), "owners"), None
    # tables of the first sweep, one for each pair
    first = lambda: _all(corpus.merged, 2, 1).withColumn("data", F.slice("data", 4, 1))
    rng, strength, own, states, spelled = np.random.default_rng(20260404), np.full(CLASSES + 1, STRENGTH), STRENGTH, {}, {}
    for j in range(BURN + KEEP):
        sent, old = words.of(1) if words else first(), owners
        owners = Parts(_grouped(owners.of(0).unionByName(sent), "shard", _seated(j >= BURN)), "owners")
        old.free(0)
        counted = [[_unpack(x) for x in r["data"]] for r in owners.of(2).select("data").collect()]  # a number of different sizes for each owner
        sizes, opened = (pd.DataFrame({"x": np.concatenate([c[i] for c in counted] or [[]]), "m": np.concatenate([c[i + 1] for c in counted] or [[]])}).groupby("x", as_index=False).sum() for i in (0, 2))
        own = shared_strength(own, d, sizes, opened)
        seats = words.of(0) if words else _all(corpus.merged, 3, 0)
        sums = seats.mapInArrow(_giving_back(_totals), "kind int, code long, n long").groupBy("kind", "code").agg(F.sum("n").alias("n")).toArrow().to_pandas()  # classes, and at most 257 ** 3 codes
        customers, tables = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
        for kind, out in ((0, customers), (1, tables)):
            part = sums[sums["kind"] == kind]
            out[part["code"].to_numpy(np.int64)] = part["n"]
        customers[-1], tables[-1] = tables[:-1].sum(), sums[sums["kind"] == 2]["n"].sum()
        strength = np.array([draw_strength(strength[k], discounts[k == CLASSES], customers[k], tables[k], rng) for k in range(CLASSES + 1)])
        state = State(customers, tables, strength, discounts, spelling(sums[sums["kind"] == 3], SPELLING_DISCOUNT, (j + 1) << 44), (own, d))
        told = spark.sparkContext.broadcast(state)
        if j >= BURN:
            states[j] = state
        if j < BURN + KEEP - 1:
            new = Parts(_grouped(seats.unionByName(owners.of(1)), "shard", _sweep(j, told, shards)), "words")
        else:
            new = Parts(seats.mapInArrow(_giving_back(_last(told)), ROW), "words")
        spelled[j] = new.of(0).agg(F.coalesce(F.sum("q"), F.lit(0.0))).first()[0]
        before, words = words, new
        del seats, sent
        told.unpersist()
        owners.free(1)
        if before:
            before.free(0, 1)
        else:
            for m in corpus.merged:
                m.free(2, 3)
    return Model(corpus, words, owners, n, v, states, spelled)


def train(df: DataFrame, text: str = "text") -> Model:
    """Count words by the word before and sample the seating."""
    return fit(gather(df, F.lit(True), text))


def _asked(shards: int):
    """The previous words of a shard, for each of their owners."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _read(batch):
                ks = _unpack(r[4][2], U, True)
                yield _rows([(1, owner, r[1], 0.0, [_pack(ks[own], True)]) for owner, own in _by_owner(ks, shards)])

    return rows


def _told(rows: list[tuple]) -> list[tuple]:
    """An owner's previous words, then those that shards ask for: of each customers and tables in kept sweeps, 0 if it is not known."""
    own = rows[0][4] if rows[0][0] == 0 else None
    ks, values = (_unpack(own[0], U, True), [_unpack(own[i]) for i in (1, *range(-KEEP, 0))]) if own else (np.zeros(0, U), [np.zeros(0, np.int64)] * (KEEP + 1))
    out = []
    for r in rows:
        if r[0] == 1:
            at, found = _found(ks, _unpack(r[4][0], U, True))
            out.append((3, r[2], r[1], 0.0, [_pack(np.where(found, x[at], 0) if len(x) else np.zeros(len(found), np.int64)) for x in values]))
    return out


def _found(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    spot = np.minimum(np.searchsorted(table, x), max(len(table) - 1, 0))
    return spot, table[spot] == x if len(table) else np.zeros(len(x), bool)


def _answers(states, new: dict[int, float], shards: int):
    """A shard's pairs (0), places of blocks' pairs (1), words (2) and previous words (3): for each block the log10 probability of its pairs, in STEPs, and their words' numbers.

    Pairs that the model has not met have what their restaurants leave to the class, and that to the word."""

    def shard(rows: list[tuple]) -> list[tuple]:
        of = [[r for r in rows if r[0] == i] for i in range(4)]
        if not of[0]:
            return []
        p, at, replies = Pairs(of[0][0][4]), rows[0][1], {r[2]: r[4] for r in of[3]}
        context = np.zeros((KEEP + 1, len(p.ks)), np.int64)
        for owner, own in _by_owner(p.ks, shards):
            context[:, own] = [_unpack(x) for x in replies[owner]]
        data = of[2][0][4] if of[2] else None
        names = _unpack(data[0], U, True) if data else np.zeros(0, U)
        spot, known = _found(names, p.names)
        known_n = np.where(known, _unpack(data[1])[spot], 0) if data else np.zeros(len(p.names), np.int64)
        kind, several, total = p.kinds[p.k].astype(np.int64), np.flatnonzero(p.n > 1), np.zeros(len(p.n))
        for i, (j, st) in enumerate(states.value.items()):
            u, cs, ss = np.full(len(p.names), new[j]), *np.zeros((2, CLASSES, len(p.names)), np.int64)
            seats = np.minimum(p.n, 1)
            if data:
                kept = data[2 + 4 * i : 6 + 4 * i]
                met = known & (known_n > 0)
                u = np.where(met, _unpack(kept[2], np.float64)[spot], u)
                cs, ss = (np.where(met, _unpack(x).reshape(CLASSES, -1)[:, spot], 0) for x in kept[:2])
                seats[several] = _unpack(kept[3])
            above = st.in_context(kind, cs[kind, p.word], ss[kind, p.word], u[p.word])
            strength, d = st.word
            total += (p.n - d * seats + (strength + d * context[1 + i][p.k]) * above) / (strength + context[0][p.k])
        logs = np.round(np.log10(total / len(states.value)) * LOG_STEPS).astype(np.int64)
        count = known_n[p.word]
        return [(0, at, r[2], 0.0, [_pack(logs[x]), _pack(count[x])]) for r in of[1] for x in [_unpack(r[4][0], np.int32, True)]]

    return shard


def _scores(n: int, v: int):
    """A block's texts as numbers of pairs, then shards' answers in the same order: a row for each text."""

    def block(table: pa.Table) -> pa.Table:
        rows = _read(table)
        home = next(r for r in rows if r[0] == 1)[4]
        answers = sorted((r for r in rows if r[0] == 0), key=lambda r: r[1])
        logs, count = (np.concatenate([_unpack(r[4][i]) for r in answers]) for i in (0, 1))
        keys, none, outs, size = map(_unpack, home[:4])
        idx = _unpack(home[4], np.int32)
        at = np.cumsum(size) - size  # every text has an end
        sums = [np.add.reduceat(x[idx], at) for x in ((count > 0).astype(np.int64), np.log10((count + 1) / (n + v + 1)), logs / LOG_STEPS)]
        columns = [pa.array(keys, mask=none > 0), pa.array(outs > 0), pa.array(size), pa.array(sums[0]), pa.array(np.full(len(keys), n, np.int64)), pa.array(sums[1]), pa.array(sums[2])]
        out = pa.Table.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        del table, rows, home, answers
        give_back()
        return out

    return block


def judge(corpus: Corpus, model: Model) -> DataFrame:
    """One row per text of ``corpus``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Shards answer in PARTS turns, so that few of their pairs are moved at a time."""
    spark, shards = corpus.cut.spark, corpus.shards
    new = {j: float(st.unigram(0, 0, max(1 - model.spelled[j], 1e-12))) for j, st in model.states.items()}
    states = spark.sparkContext.broadcast({j: replace(st, spell=None) for j, st in model.states.items()})
    answers = []
    for g, m in enumerate(corpus.merged):
        asked = m.of(0).mapInArrow(_asked(shards), ROW)
        told = _grouped(model.owners.of(0).unionByName(asked), "shard", _told)
        mine = model.words.of(0, 2).filter(F.col("shard") % PARTS == g)
        met = m.of(0).unionByName(m.of(1)).unionByName(mine).unionByName(told)
        answers.append(Parts(_grouped(met, "shard", _answers(states, new, shards)), "answers"))
        del asked, told, mine, met
        m.free(1) if corpus is not model.corpus else m.free(0, 1)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return corpus.cut.of(PARTS, 1).unionByName(_all(answers, 0)).groupBy("other").applyInArrow(_scores(model.n_tokens, model.n_types), schema)


def score(df: DataFrame, model: Model, text: str = "text", key: str = "doc_id", held_out: str = "held_out") -> DataFrame:
    """One row per row of ``df``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    return judge(gather(df, F.lit(False), text, key, held_out, model), model)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: learn from six sevenths of ``documents``, score all."""
    out = F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", out.alias("held_out"))
    corpus = gather(docs, ~F.col("held_out") & F.col("doc_id").isNotNull(), key="doc_id", held_out="held_out")
    return judge(corpus, fit(corpus))
