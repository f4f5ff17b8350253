"""Token counts by a whole-token shortcut.

Once, on the driver, every vocabulary string is encoded alone; those that come back as one id are proven
whole tokens. In the tasks a text is cut where no token can cross, pre-tokens that are proven count as one,
and only the rest is merged by the library, each distinct string once per batch.

Defined cases: a null text counts as empty and has no token; special strings inside a text count as the
library's default has them (one token each); texts with code points that this Python's Unicode tables
don't know go to the library whole; repeated rows, null ids and extra columns pass through untouched.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than blank and line feed.
ODD_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0                　"
SLICE_CHARS = 1_000_000
CACHE_ENTRIES = 300_000


def default_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """The library's tokenizer without padding and truncation, on one thread."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_padding()
    tok.no_truncation()
    return tok


def unknown_code_points() -> re.Pattern:
    """Matches a code point that this Python's tables have no category for; other libraries may know it."""
    spans, start = [], None
    for c in range(sys.maxunicode + 2):
        cn = c <= sys.maxunicode and unicodedata.category(chr(c)) == "Cn"
        if cn and start is None:
            start = c
        elif not cn and start is not None:
            spans.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return re.compile(f"[{''.join(spans)}]")


class Unknown:
    """Whether a text holds a code point outside the tables; built on first need, as Latin-1 texts never do."""

    pattern: re.Pattern | None = None

    def __call__(self, text: str) -> bool:
        try:
            text.encode("latin-1")
            return False
        except UnicodeEncodeError:
            if self.pattern is None:
                self.pattern = unknown_code_points()
            return self.pattern.search(text) is not None


def proven_whole(path: str) -> frozenset[str]:
    """Vocabulary strings whose own encoding is exactly their id."""
    tok = load(path)
    ids = sorted(tok.get_vocab(with_added_tokens=False).values())
    texts = [tok.decode([i], skip_special_tokens=False) for i in ids]
    found = tok.encode_batch(texts, add_special_tokens=False)
    return frozenset(s for i, s, e in zip(ids, texts, found, strict=True) if e.ids == [i])


def slices(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts with about SLICE_CHARS characters, so that what is held per run is bounded by that or by one text."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= SLICE_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


class Counter:
    """Counts tokens of whole texts; one per Python worker."""

    def __init__(self, path: str, whole: frozenset[str]):
        import regex

        self.tok, self.whole, self.pattern, self.unknown = load(path), whole, regex.compile(PATTERN), Unknown()
        self.special = [str(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.merged: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def plain(self, text: str) -> bool:
        """Blanks and line feeds only, never two beside each other unless both are line feeds, none at an end.

        Then a blank followed by a chunk is encoded alike wherever it stands."""
        if any(s in text for s in self.special) or any(c in text for c in ODD_SPACE) or "  " in text or " \n" in text or "\n " in text:
            return False
        return text[:1] not in (" ", "\n", "") and text[-1:] not in (" ", "\n") and not self.unknown(text)

    def fill(self, pretokens: set[str]) -> None:
        rest = [t for t in pretokens if t not in self.whole and t not in self.merged]
        if rest:
            for t, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False), strict=True):
                self.merged[t] = len(e)

    def cost(self, pretokens: list[str]) -> int:
        return sum(1 if t in self.whole else self.merged[t] for t in pretokens)

    def counts(self, texts: list[str]) -> list[int]:
        if len(self.chunks) > CACHE_ENTRIES:
            self.chunks.clear()
        if len(self.merged) > CACHE_ENTRIES:
            self.merged.clear()
        plain = {i: t.split(" ") for i, t in enumerate(texts) if self.plain(t)}
        new: set[str] = set().union(*(p[1:] for p in plain.values())) - self.chunks.keys()
        cut = {c: self.pattern.findall(" " + c) for c in new}
        heads = {i: self.pattern.findall(p[0]) for i, p in plain.items()}
        self.fill({t for x in (cut, heads) for v in x.values() for t in v})
        self.chunks.update((c, self.cost(v)) for c, v in cut.items())
        other = [i for i in range(len(texts)) if i not in plain]
        out = [0] * len(texts)
        for i, p in plain.items():
            out[i] = self.cost(heads[i]) + sum(map(self.chunks.__getitem__, p[1:]))
        for i, n in zip(other, self.others([texts[i] for i in other]), strict=True):
            out[i] = n
        return out

    def others(self, texts: list[str]) -> list[int]:
        cut, alone = [], []
        for t in texts:
            if self.unknown(t) or any(c in t for c in "\x1c\x1d\x1e\x1f\x85"):
                alone.append(len(self.tok.encode(t, add_special_tokens=False)))
                cut.append([])
                continue
            pieces = re.split("|".join(map(re.escape, self.special)), t) if self.special else [t]
            alone.append(len(pieces) - 1)
            cut.append([x for p in pieces for x in self.pattern.findall(p)])
        self.fill({x for c in cut for x in c})
        return [a + self.cost(c) for a, c in zip(alone, cut, strict=True)]


_counters: dict[str, Counter] = {}


def token_counter(spark, path: str):
    """A column function: text -> number of tokens. The proven strings are broadcast: at most one per vocabulary entry."""
    whole = spark.sparkContext.broadcast(proven_whole(path))

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if path not in _counters:
            _counters[path] = Counter(path, whole.value)
        counter = _counters[path]
        for texts in batches:
            done = [n for run in slices(texts.fillna("").tolist()) for n in counter.counts(run)]
            yield pd.Series(done, dtype="int64")

    return n_tokens


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with the token count of each whole text in ``out``."""
    return df.withColumn(out, token_counter(df.sparkSession, path)(F.col(text)))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: bytes and tokens of every row of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = count_tokens(docs, default_file("byte_bpe_50k.json"))
    return out.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))
