"""Language identification with hyperdimensional profiles.

Each letter has a random vector of -1 and 1. A three-letter sequence binds its letters' vectors, rotated by
their place, by multiplication; a text bundles those of all its sequences by addition, and so does a
language over its training texts. A text gets the language whose vector has the largest cosine with its own.
Sequences run over lower-cased letters; each run of anything else counts as one blank.

Only sums leave the tasks: one vector per language and partition, added up by Spark. The vectors of
languages come to the driver, at most ``MAX_LANGUAGES`` of ``DIMENSIONS`` numbers each.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is every text where nothing
could be learned; equal cosines go to the first language by name; a null id is neither held out nor used
to learn; repeated rows count as often as they stand; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
MAX_LANGUAGES = 4096
KEPT_ROWS = 30_000
#: Sequences whose vectors are widened at once: those of a text of a million distinct ones take no more memory than others; its codes still do.
BLOCK = 8_192
SLICE_CHARS = 500_000
_letter = np.array([chr(c).isalpha() for c in range(1 << 16)])
_lower = np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(1 << 16)], np.uint32)


def letter_vector(code: int) -> np.ndarray:
    return np.random.default_rng(code + 7_000_003).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1


class Space:
    """Vectors of letter sequences; those met are kept up to KEPT_ROWS, others are bound anew."""

    def __init__(self):
        self.letters: dict[int, np.ndarray] = {}
        self.codes, self.rows = np.zeros(0, np.int64), np.zeros((0, DIMENSIONS), np.int8)

    def letter(self, code: int, turn: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > 5000:
                self.letters.clear()
            self.letters[code] = letter_vector(code)
        return np.roll(self.letters[code], turn)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row for each of some distinct, ascending codes."""
        new = np.setdiff1d(codes, self.codes, assume_unique=True)
        if len(new):
            bound = np.array([self.letter(int(c) >> 42, 2) * self.letter(int(c) >> 21 & 0x1FFFFF, 1) * self.letter(int(c) & 0x1FFFFF, 0) for c in new], np.int8)
            if len(self.codes) + len(new) > KEPT_ROWS:
                self.codes, self.rows = np.zeros(0, np.int64), np.zeros((0, DIMENSIONS), np.int8)
                if len(new) < len(codes):
                    return self.vectors(codes)
                return bound
            every = np.concatenate((self.codes, new))
            order = np.argsort(every)
            self.codes, self.rows = every[order], np.concatenate((self.rows, bound))[order]
        return self.rows[np.searchsorted(self.codes, codes)]

    def bundle(self, codes: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The sum of the vectors of some distinct, ascending codes, each ``n`` times."""
        out = np.zeros(DIMENSIONS)
        for a in range(0, len(codes), BLOCK):
            out += n[a : a + BLOCK].astype(np.float64) @ self.vectors(codes[a : a + BLOCK])
        return out


def grams(texts: list[str]) -> list[np.ndarray]:
    """The codes of each text's three-letter sequences, in order; empty for a text without a letter."""
    joined = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    small = np.minimum(joined, (1 << 16) - 1)
    letter, low = _letter[small], _lower[small]
    if (joined >> 16).any():
        at = np.flatnonzero(joined >> 16)
        letter[at] = [chr(c).isalpha() for c in joined[at]]
        low[at] = [ord(x) if len(x := chr(c).lower()) == 1 else c for c in joined[at]]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[:-1] |= letter[1:] & ~letter[:-1]  # one blank before a run of letters
    low = np.where(letter, low, 32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    out = []
    for a, b in zip(np.concatenate(([0], ends[:-1])), ends, strict=True):
        part = slice(a, b + 1)
        some = kept[part]
        s, is_letter = low[part][some].astype(np.int64), letter[part][some]
        s = np.concatenate((s[:1], s[1:][is_letter[1:] | is_letter[:-1]]))  # of what stands between letters one blank
        out.append(s[:-2] << 42 | s[1:-1] << 21 | s[2:] if letter[part].any() else np.zeros(0, np.int64))
    return out


def _runs(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, held, n = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t)
        n += len(t)
        if n >= SLICE_CHARS:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held


_space: list[Space] = []


def _shared_space() -> Space:
    if not _space:
        _space.append(Space())
    return _space[0]


def _learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    space, sums = _shared_space(), {}
    for batch in batches:
        langs = batch["lang"].to_numpy()
        for at, run in _runs(batch["text"].fillna("").tolist()):
            of: dict[str, list[np.ndarray]] = {}
            for name, g in zip(langs[at : at + len(run)], grams(run), strict=True):
                of.setdefault(name, []).append(g)
            for name, parts in of.items():
                codes, n = np.unique(np.concatenate(parts), return_counts=True)
                if len(codes):
                    sums[name] = sums.get(name, 0) + np.rint(space.bundle(codes, n)).astype(np.int64)
    if sums:  # a frame of empty lists has no element type
        yield pd.DataFrame({"lang": list(sums), "vector": list(sums.values())})


def profiles(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The bundled vector of each language of ``df``."""
    parts = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL").mapInPandas(_learn, "lang string, vector array<long>")
    rows = parts.select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    rows = rows.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda v: v["x"]).alias("vector"))
    found = rows.limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    return {r["lang"]: np.array(r["vector"], np.float64) for r in found}


def predictor(spark, learned: dict[str, np.ndarray]):
    """A column function: text -> struct(lang_pred, score)."""
    names = sorted(learned)
    table = np.array([learned[n] / max(np.linalg.norm(learned[n]), 1e-300) for n in names], np.float32).reshape(len(names), DIMENSIONS)
    sent = spark.sparkContext.broadcast((names, table))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        space, (names, table) = _shared_space(), sent.value
        for texts in batches:
            pred, score = [], []
            for _, run in _runs(texts.fillna("").tolist()):
                parts = [np.unique(g, return_counts=True) for g in grams(run)]
                every = np.unique(np.concatenate([c for c, _ in parts]))
                rows = space.vectors(every) if 0 < len(every) <= KEPT_ROWS else None
                for codes, n in parts:
                    if not len(codes) or not names:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    v = space.bundle(codes, n).astype(np.float32) if rows is None else n.astype(np.float32) @ rows[np.searchsorted(every, codes)].astype(np.float32)
                    cos = table @ v / max(float(np.linalg.norm(v)), 1e-30)
                    best = int(np.argmax(cos))
                    pred.append(names[best])
                    score.append(float(min(max(cos[best], 0.0), 1.0)))
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    return predict


def fold(key: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def identify(df: DataFrame, learned: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``df`` with a struct ``__lang`` of lang_pred and score."""
    return df.withColumn("__lang", predictor(df.sparkSession, learned)(F.col(text)))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: learn from two thirds of ``documents``, predict all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    learned = profiles(docs.filter(~out & F.col("doc_id").isNotNull()))
    done = identify(docs.select("doc_id", "text", out.alias("held_out")), learned)
    return done.select("doc_id", "held_out", "__lang.lang_pred", "__lang.score")
