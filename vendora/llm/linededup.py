"""Line dedup by a sharded minimal perfect hash over all distinct lines.

Documents are cut into blocks of lines, each line a 128-bit name, and the blocks are written once. Their distinct lines,
with the smallest and largest id that hold them, are dealt into shards of bounded size. A shard's minimal perfect hash
is a cascade of bit arrays: in each level, every name that meets no other at its bit is placed there and the rest go on;
a name's index is the number of bits set before its own. Beside it stand compact arrays by index: a fingerprint, the
count of documents, the smallest id.

Blocks then probe the arrays: a block sends each shard its own distinct names once, however often they stand in it, so a line
that a third of all documents hold makes one probe for each block. What is shared comes back to the block by the line's
place, the block decides line by line, and only documents that lose a line receive a list of flags.
Texts move once, to meet those flags.

Defined cases: a null or empty text is one empty line; rows of one id are one document; a null id counts as the
largest there is, all such rows as one document; an empty table gives an empty table; other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import saved
from .components import spread_join
from .text import U, mix

#: Distinct lines of a shard, on average.
SHARD_LINES = 8_192
#: Lines of a block; a longer document is a block by itself.
BLOCK_LINES = 1 << 16
SPACE = b" \t\n\x0b\x0c\r"
NO_ID = (1 << 63) - 1
BLOCK = "block string, id binary, h binary, n_lines binary, doc binary, line binary, hi binary, lo binary"
SHARD = "sizes binary, bits binary, prints binary, counts binary, firsts binary"


def _names(lines: list[bytes], least: int) -> tuple[list[int], list[bytes]]:
    """(places, 128-bit names) of the lines whose key has ``least`` code points."""
    at, names = [], []
    for i, x in enumerate(lines):
        key = x.strip(SPACE)
        if len(key) >= least and (key.isascii() or len(key.decode("utf-8", "replace")) >= least):
            at.append(i)
            names.append(hashlib.blake2b(key.lower(), digest_size=16).digest())
    return at, names


def _cut(least: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy() for i in range(2))
            texts, first, sizes, docs, places, names = batch.column(2).cast(pa.binary()), 0, [], [], [], []
            for i in range(batch.num_rows):
                lines = (texts[i].as_py() or b"").split(b"\n")
                at, own = _names(lines, least)
                sizes.append(len(lines))
                docs.append(np.full(len(at), i - first, np.int32))
                places.append(np.array(at, np.int32))
                names += own
                if len(names) >= BLOCK_LINES or i == batch.num_rows - 1:
                    n = np.frombuffer(b"".join(names), np.int64).reshape(-1, 2)
                    row = [uuid.uuid4().hex, ids[first : i + 1], hashes[first : i + 1], np.array(sizes, np.int32), np.concatenate(docs), np.concatenate(places), n[:, 0], n[:, 1]]
                    yield pa.RecordBatch.from_arrays([pa.array([x if isinstance(x, str) else x.tobytes()]) for x in row], BLOCK_COLUMNS)
                    first, sizes, docs, places, names = i + 1, [], [], [], []

    return cut


BLOCK_COLUMNS = [x.split()[0] for x in BLOCK.split(", ")]
SHARD_COLUMNS = [x.split()[0] for x in SHARD.split(", ")]


def _numbers(b: pa.BinaryScalar, kind=np.int64) -> np.ndarray:
    return np.frombuffer(b.as_py(), kind)


def _distinct(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct name, the number of each name among them), in an order that the names alone decide."""
    s = np.lexsort((lo, hi))
    new = np.ones(len(s), bool)
    new[1:] = (hi[s[1:]] != hi[s[:-1]]) | (lo[s[1:]] != lo[s[:-1]])
    of = np.empty(len(s), np.int64)
    of[s] = np.cumsum(new) - 1
    return s[new], of


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block: its distinct names, the smallest and largest id that hold them, in how many documents."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {k: batch.column(k)[r] for k in ("id", "doc", "hi", "lo")}
            hi, lo = _numbers(row["hi"]), _numbers(row["lo"])
            if not len(hi):
                continue
            ids = _numbers(row["id"])[_numbers(row["doc"], np.int32)]
            s = np.lexsort((ids, lo, hi))
            hi, lo, ids = hi[s], lo[s], ids[s]
            new = np.ones(len(s), bool)
            new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            at = np.flatnonzero(new)
            other = new.copy()
            other[1:] |= ids[1:] != ids[:-1]
            columns = hi[at], lo[at], ids[at], ids[np.append(at[1:], len(s)) - 1], np.add.reduceat(other, at, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["hi", "lo", "least", "most", "n"])


def _bit(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(lo.view(U) ^ mix(hi.view(U) + U(level))) % U(size)).astype(np.int64)


def build_hash(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes of the levels, their bits, the index of each name) of a minimal perfect hash of distinct names."""
    left, sizes, levels, spot, base = np.arange(len(hi)), [], [], np.zeros(len(hi), np.int64), 0
    while len(left):
        size = 2 * len(left)
        at = _bit(hi[left], lo[left], len(sizes), size)
        bits = np.bincount(at, minlength=size) == 1
        alone = bits[at]
        spot[left[alone]] = base + at[alone]
        sizes.append(size)
        levels.append(bits)
        left, base = left[~alone], base + size
    bits = np.concatenate([*levels, np.zeros(0, bool)])
    return np.array(sizes, np.int64), bits, np.cumsum(bits)[spot] - 1 if len(hi) else spot


def look_up(sizes: np.ndarray, bits: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The index of each name, or -1 of one that no level has; a name that was not built in may get any index."""
    rank, out, left, base = np.cumsum(bits) - 1, np.full(len(hi), -1, np.int64), np.arange(len(hi)), 0
    for level, size in enumerate(sizes):
        at = base + _bit(hi[left], lo[left], level, size)
        there = bits[at]
        out[left[there]] = rank[at[there]]
        left, base = left[~there], base + size
    return out


def _print(lo: np.ndarray) -> np.ndarray:
    return (lo.view(U) >> U(32)).astype(np.uint32)


def _shard(key: tuple, rows: pa.Table) -> pa.Table:
    hi, lo, least, most, n = (rows.column(c).to_numpy() for c in ("hi", "lo", "least", "most", "n"))
    sizes, bits, at = build_hash(hi, lo)
    prints, counts, firsts = np.empty(len(hi), np.uint32), np.empty(len(hi), np.uint8), np.empty(len(hi), np.int64)
    # rows of one id in several blocks are one document
    prints[at], counts[at], firsts[at] = _print(lo), np.where(least == most, 1, np.clip(n, 2, 255)), least
    arrays = (sizes, np.packbits(bits), prints, counts, firsts)
    return pa.table([pa.array([key[0].as_py()]), *(pa.array([a.tobytes()]) for a in arrays)], names=["shard", *SHARD_COLUMNS])


def _probes(shards: int):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                hi, lo = _numbers(batch.column("hi")[r]), _numbers(batch.column("lo")[r])
                at, _ = _distinct(hi, lo)
                hi, lo = hi[at], lo[at]
                to = hi % shards
                s = np.argsort(to, kind="stable")
                parts = np.split(s, np.flatnonzero(np.diff(to[s])) + 1) if len(s) else []
                columns = [[int(to[p[0]]) for p in parts], [batch.column("block")[r].as_py()] * len(parts), [hi[p].tobytes() for p in parts], [lo[p].tobytes() for p in parts], [p.astype(np.int32).tobytes() for p in parts]]
                kinds = pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["shard", "block", "hi", "lo", "spot"])

    return route


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's arrays, then its probes: for each probe, the places of the names that two documents or more hold, and their first holders."""
    index = None
    for batch in batches:
        out: tuple[list, list, list] = [], [], []
        for r in range(batch.num_rows):
            if batch.column("probe")[r].as_py() == 0:
                sizes, bits, prints, counts, firsts = (_numbers(batch.column(c)[r], t) for c, t in zip(SHARD_COLUMNS, (np.int64, np.uint8, np.uint32, np.uint8, np.int64), strict=True))
                index = sizes, np.unpackbits(bits)[: int(sizes.sum())].astype(bool), prints, counts, firsts
                continue
            hi, lo, spot = _numbers(batch.column("hi")[r]), _numbers(batch.column("lo")[r]), _numbers(batch.column("spot")[r], np.int32)
            sizes, bits, prints, counts, firsts = index
            at = look_up(sizes, bits, hi, lo)
            shared = (at >= 0) & (prints[at] == _print(lo)) & (counts[at] > 1)
            if shared.any():
                for to, x in zip(out, (batch.column("block")[r].as_py(), spot[shared].tobytes(), firsts[at[shared]].tobytes()), strict=True):
                    to.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.string(), pa.binary(), pa.binary()), strict=True)], ["block", "spot", "first"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block, then what is shared of it: flags of the lines that go, for each document that loses one."""

    def decided(home: dict, spots: list[np.ndarray], firsts: list[np.ndarray]) -> pa.RecordBatch:
        ids, hashes, sizes = _numbers(home["id"]), _numbers(home["h"]), _numbers(home["n_lines"], np.int32)
        doc, line = _numbers(home["doc"], np.int32), _numbers(home["line"], np.int32)
        at, of = _distinct(_numbers(home["hi"]), _numbers(home["lo"]))
        first, shared = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
        for s, f in zip(spots, firsts, strict=True):
            first[s], shared[s] = f, True
        goes = shared[of] & (first[of] != ids[doc]) if len(doc) else np.zeros(0, bool)
        loses = np.unique(doc[goes])
        begin = np.cumsum(sizes) - sizes
        flags = np.zeros(int(sizes.sum()), bool)
        flags[begin[doc[goes]] + line[goes]] = True
        own = np.concatenate([flags[begin[d] : begin[d] + sizes[d]] for d in loses]) if len(loses) else np.zeros(0, bool)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes[loses]]), pa.int32()), pa.array(own))
        return pa.RecordBatch.from_arrays([pa.array(ids[loses]), pa.array(hashes[loses]), lists], ["id", "h", "goes"])

    home, spots, firsts = None, [], []
    for batch in batches:
        for r in range(batch.num_rows):
            if batch.column("hit")[r].as_py() == 0:
                if home is not None:
                    yield decided(home, spots, firsts)
                home, spots, firsts = {c: batch.column(c)[r] for c in BLOCK_COLUMNS[1:]}, [], []
            else:
                spots.append(_numbers(batch.column("spot")[r], np.int32))
                firsts.append(_numbers(batch.column("first")[r]))
    if home is not None:
        yield decided(home, spots, firsts)


def _either(a: DataFrame, b: DataFrame, key: str, flag: str) -> DataFrame:
    """The row of ``a`` for each key, and after it those of ``b``, in one task."""
    both = a.withColumn(flag, F.lit(0)).unionByName(b.withColumn(flag, F.lit(1)), allowMissingColumns=True)
    return both.repartition(key).sortWithinPartitions(key, flag)


def line_index(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(shard and its arrays, number of shards) over all distinct lines of ``blocks``."""
    lines = blocks.select("id", "doc", "hi", "lo").mapInArrow(_held, "hi long, lo long, least long, most long, n long")
    lines = saved(lines.groupBy("hi", "lo").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n")), "lines")
    shards = max(1, -(-lines.count() // SHARD_LINES))
    return saved(lines.withColumn("shard", F.pmod("hi", F.lit(shards))).groupBy("shard").applyInArrow(_shard, f"shard long, {SHARD}"), "shards"), shards


def drop_shared_lines(df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """``df`` with a struct ``__lines``: n_lines, n_dropped, kept_text.

    Of a line that two documents or more hold, compared without white space at its ends and with A-Z lower-cased, all stay in the
    document with the smallest id and go from the others; lines whose key has fewer than ``least`` code points stay.
    """
    ident = F.col(key).cast("long")
    docs = df.withColumns({"__id": F.coalesce(ident, F.lit(NO_ID)), "__h": F.xxhash64(F.col(text), ident.isNull())})
    blocks = saved(docs.select("__id", "__h", F.col(text).alias("t")).mapInArrow(_cut(least), BLOCK), "blocks")
    index, shards = line_index(blocks)
    probes = blocks.select("block", "hi", "lo").mapInArrow(_probes(shards), "shard long, block string, hi binary, lo binary, spot binary")
    hits = _either(index, probes, "shard", "probe").mapInArrow(_look, "block string, spot binary, first binary")
    flags = _either(blocks, hits.select("block", "spot", "first"), "block", "hit").mapInArrow(_decide, "id long, h long, goes array<boolean>")
    flags = flags.select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("goes").alias("__goes")).dropDuplicates(["__id", "__h"])
    out = spread_join(docs, flags, ["__id", "__h"], docs.groupBy("__id", "__h").agg(F.count("*").alias("n")), "left")
    t = F.coalesce(F.col(text), F.lit(""))
    loses = F.col("__goes").isNotNull()
    kept = F.when(loses, F.array_join(F.filter(F.split(t, "\n"), lambda x, i: ~F.get("__goes", i)), "\n")).otherwise(t)
    dropped = F.when(loses, F.size(F.filter("__goes", lambda x: x))).otherwise(0)
    lines = F.struct((F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"), dropped.cast("long").alias("n_dropped"), kept.alias("kept_text"))
    return out.withColumn("__lines", lines).select(*df.columns, "__lines")


def query(spark, sf_dir: str) -> DataFrame:
    """op13: what ``documents`` keep when shared lines stay only where they stand first."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_shared_lines(docs).select("doc_id", "__lines.n_lines", "__lines.n_dropped", F.sha2(F.col("__lines.kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = """
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
j AS (SELECT k.*, coalesce(first <> doc_id, false) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id"""
