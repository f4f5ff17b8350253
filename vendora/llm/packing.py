"""Harmonic packing of tokenised documents into fixed-length sequences.

Every task packs the documents it reads on its own, so nothing is shuffled. What a document has beyond full sequences is of
class k if k such pieces, but not k + 1, fit a sequence of ``capacity`` tokens. A class keeps one open sequence, which
takes a fixed number of pieces, k. The gap that is then left, less than a piece, is closed with a part cut from the next
document, so that full sequences need no padding and a document is cut once for each gap it closes. A task's open sequences
(classes have about twice the root of the capacity different numbers) are joined and cut again at its end, the last by the binary
digits of its length: each of these has a power of two as its length and needs no padding either.

Defined cases: a null text counts as empty and is the end id alone; a repeated row is packed as often as it
stands there; a null id is kept; an empty table packs into nothing; of the input only id and text are read.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import _saved
from .text import give_back
from .tokencount import Unknown, default_file, load, slices

CAPACITY = 4096
END_ID = 2
CACHE_ENTRIES = 600_000
#: Fixed value: the pre-token pattern of the word-end vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, int]:
    """Bytes as the letters that a byte-level vocabulary writes them with: printable ones stand for themselves, others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(others)}


_LETTERS = _byte_letters()
_CLOSING = frozenset(".,;:!?")


class Encoder:
    """Ids of whole texts as little-endian bytes; strings between white space are encoded once per worker."""

    def __init__(self, path: str):
        import regex

        self.tok, self.pattern, self.unknown = load(path), regex.compile(PATTERN), Unknown()
        self.special = {str(t.content): struct.pack("<I", i) for i, t in self.tok.get_added_tokens_decoder().items()}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.model = self.tok.model
        self.merged: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str] | None:
        """Parts between special strings, normalised; None if this Python may normalise or cut unlike the library."""
        if self.unknown(text) or "Σ" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return None
        parts = self.split.split(text) if self.split and any(s in text for s in self.special) else [text]
        return [p if i % 2 else unicodedata.normalize("NFC", p).lower() for i, p in enumerate(parts)]

    def merge(self, pretoken: str) -> bytes:
        letters = pretoken if pretoken.isascii() and pretoken.isprintable() else pretoken.encode().decode("latin-1").translate(_LETTERS)
        ids = [t.id for t in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def forget(self) -> None:
        self.merged.clear()
        self.chunks.clear()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.chunks) > CACHE_ENTRIES:
            self.chunks.clear()
        if len(self.merged) > CACHE_ENTRIES:
            self.merged.clear()
        parts = [self.pieces(t) for t in texts]
        words = [[x if i % 2 else x.split() for i, x in enumerate(p)] if p is not None else None for p in parts]
        new = set().union(*(x for w in words if w for x in w[::2])) - self.chunks.keys()
        merged, chunks = self.merged, self.chunks
        for c in new:
            # a run of letters is one pre-token, and a closing mark after it another
            cut = (c,) if c.isalpha() else (c[:-1], c[-1]) if c[-1] in _CLOSING and c[:-1].isalpha() else self.pattern.findall(c)
            for t in cut:
                if t not in merged:
                    merged[t] = self.merge(t)
            chunks[c] = merged[cut[0]] if len(cut) == 1 else b"".join([merged[t] for t in cut])
        get = self.chunks.__getitem__
        out = []
        for t, w in zip(texts, words, strict=True):
            if w is None:
                ids = self.tok.encode(t, add_special_tokens=False).ids
                out.append(struct.pack(f"<{len(ids)}I", *ids))
            else:
                out.append(b"".join([self.special[x] if i % 2 else b"".join(map(get, x)) for i, x in enumerate(w)]))
        return out


_encoders: dict[str, Encoder] = {}


class Piece(NamedTuple):
    """A part of a document: its id, whether it has none, the document's ids before the part, the part's ids, and the document's number of ids."""

    key: int
    no: bool
    start: int
    ids: bytes
    whole: int

    def split(self, n: int) -> tuple[Piece, Piece]:
        """The first n ids, and the others."""
        return self._replace(ids=self.ids[: 4 * n]), self._replace(ids=self.ids[4 * n :], start=self.start + n)

    @property
    def size(self) -> int:
        return len(self.ids) // 4


class Packer:
    """Sequences of one task, each a list of pieces."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity
        self.open: dict[int, list[Piece]] = {}
        self.gaps: list[tuple[int, list[Piece]]] = []

    def add(self, p: Piece) -> Iterator[list[Piece]]:
        """Take a document; yields the sequences that it completes."""
        while p.size and self.gaps:
            gap, held = self.gaps.pop()
            part, p = p.split(min(gap, p.size))
            held.append(part)
            if part.size < gap:
                self.gaps.append((gap - part.size, held))
            else:
                yield held
        full = p.size // self.capacity * self.capacity
        for at in range(0, full, self.capacity):
            yield [p._replace(ids=p.ids[4 * at : 4 * (at + self.capacity)], start=p.start + at)]
        p = p.split(full)[1] if full else p
        if p.size:
            k = self.capacity // p.size
            held = self.open.setdefault(k, [])
            held.append(p)
            if len(held) == k:
                gap = self.capacity - sum(x.size for x in self.open.pop(k))
                if gap:
                    self.gaps.append((gap, held))
                else:
                    yield held

    def close(self) -> Iterator[list[Piece]]:
        """Join what is open: full sequences, then one for each binary digit of the rest."""
        left = [p for _, held in self.gaps for p in held] + [p for k in sorted(self.open) for p in self.open[k]]
        total = sum(p.size for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        for size in sizes:
            held = []
            while size:
                part, more = left.pop(0).split(size)
                held.append(part)
                size -= part.size
                if more.size:
                    left.insert(0, more)
            yield held
        self.open, self.gaps = {}, []


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False, keep: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ``ids`` (little-endian bytes).

    The rows are written in the shared folder, so that each sequence is packed once. ``keep`` leaves what a worker has learned about
    strings to its next task; without it workers give that memory back, which other stages of a long job need.
    """
    schema = "doc_id long, no boolean, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids binary" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    end = struct.pack("<I", END_ID)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        packer, number = Packer(capacity), TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def put(sequences: Iterator[list[Piece]]) -> None:
            nonlocal number
            for held in sequences:
                at = 0
                for p in held:
                    rows.append((p.key, p.no, p.start, p.size, zlib.crc32(p.ids), p.whole, number, at, *([p.ids] if with_ids else [])))
                    at += p.size
                number += 1

        for batch in batches:
            keys, nos, at = batch["k"].tolist(), batch["no"].tolist(), 0
            for run in slices(batch["t"].fillna("").tolist()):
                for i, ids in enumerate(_encoders[path].encode(run), at):
                    put(packer.add(Piece(keys[i], nos[i], 0, ids + end, len(ids) // 4 + 1)))
                at += len(run)
                yield pd.DataFrame(rows, columns=names)
                rows.clear()
        put(packer.close())
        if not keep:
            _encoders[path].forget()
            give_back()
        yield pd.DataFrame(rows, columns=names)

    ident = F.col(key).cast("long")
    found = df.select(F.coalesce(ident, F.lit(0)).alias("k"), ident.isNull().alias("no"), F.col(text).alias("t")).mapInPandas(packed, schema)
    return _saved(found.withColumn("doc_id", F.when(~F.col("no"), F.col("doc_id"))).drop("no"), "packed")


def query(spark, sf_dir: str) -> DataFrame:
    """op5: pack every row of ``documents``."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_file("word_bpe_49k.json"))
