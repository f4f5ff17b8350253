"""Periodic runs, filter audit and line dedup against brute force, odd rows and odd layouts of the tables."""

import hashlib
import itertools
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendora.llm import audit, linededup, periodic
from vendora.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
BIG = 2**53 + 1
TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def all_runs(w):
    """Every run of at least twice its smallest period, by trying all periods."""
    out = set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            part = w[i : j + q]
            if j - i >= q and not any(part[:-p] == part[p:] for p in range(1, q)):
                out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_row(doc_id, text):
    w = (text or "").encode().split()
    w = [x.decode() for x in w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = [r for r in all_runs(w) if r[1] >= max(6, 4 * r[2])]
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, best[1] and 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(w, runs)))


def written(spark, path, rows, parts=1):
    """``rows`` as a folder with the documents in ``parts`` files more or less, and small other tables."""
    spark.createDataFrame(rows, TEXTS).repartition(parts).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, i % 2, i % 3 % 2) for i, k in enumerate(r[0] for r in rows)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


ODD = [
    None, "", " \t\n ", "a a a a a a", "a b a b a b a", "x y z " * 4, "é É " * 9, "w " * 5000, "one line of words\nONE LINE OF WORDS \n\nshort", "  one line of words\nother", "w " * 5000,
    "The # sign", "A B C D E f", " ".join(f"v{i}" for i in range(250)), "tail\n", "tail\n", "ééééééééé\néééééééééé", "ééééééééé\néééééééééé\n\n",
]


def odd_rows():
    rows = [(i, t, "en" if i % 2 else None, (None, "s", "")[i % 3], 0) for i, t in enumerate(ODD)]
    return [*rows, (BIG, ODD[8], "en", "s", 0), (-7, ODD[13], "en", "s", 0), (None, ODD[8], None, None, 0), (None, ODD[8], None, None, 0), (3, ODD[3], "en", "s", 0), (3, ODD[3], "en", "s", 0)]


def prose_rows(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    return [tuple(r) for r in rows if len(r["text"] or "") < 6000]


def test_runs_of_small_alphabets():
    rng = random.Random(5)
    for _ in range(400):
        texts = [[bytes([97 + rng.randrange(k)]) for _ in range(rng.randrange(40))] for k in (1, 2, 2, 3)]
        own, out = periodic._slice(texts, 1, 2)
        for w, r, c in zip(texts, own, out, strict=True):
            want = all_runs(w)
            assert [tuple(x) for x in r.tolist()] == want
            assert c.decode() == collapsed([x.decode() for x in w], want)


def test_suffixes_in_order():
    rng = np.random.default_rng(3)
    x = np.append(rng.integers(0, 3, 300), 3)
    order, place, lcp = periodic.suffix_array(x)
    suffixes = [x[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes) and (place[order] == np.arange(len(x))).all()
    for a, b, n in zip(suffixes, suffixes[1:], lcp[1:], strict=False):
        assert a[:n] == b[:n] and a[n] != b[n]


def test_long_loops_stay_cheap():
    own, out = periodic._slice([[b"a"] * 200_000, [b"a", b"b"] * 100_000 + [b"c"]], 6, 4)
    assert own[0].tolist() == [[0, 200_000, 1]] and own[1].tolist() == [[0, 200_000, 2]] and out[1] == b"a b c"


@pytest.mark.parametrize("rows", ["odd", "prose"])
def test_periodic_query(spark, tmp_path, rows):
    rows = odd_rows() if rows == "odd" else prose_rows(spark)
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, written(spark, tmp_path, rows, 3)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[6:])
    assert sorted(got, key=key) == sorted((periodic_row(r[0], r[1]) for r in rows), key=key)


def audit_rows(rows, labels):
    def fails(k, t):
        t = t or ""
        w = t.encode().split()
        smaller = k is not None and any(r[0] is not None and r[0] < k and (r[1] or "") == t for r in rows)
        return {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t), "E": smaller}

    good, toxic = ({k for k, *v in labels if v[i] == 1} for i in range(2))
    every = [(r[3] or "", r[0], fails(r[0], r[1])) for r in rows]
    out, removals = {}, {}
    for part in {p for p, _, _ in every}:
        mine = [(k, f) for p, k, f in every if p == part]
        for order in itertools.permutations("ABCDE"):
            alive = list(range(len(mine)))
            for step, x in enumerate(order, 1):
                gone = [i for i in alive if mine[i][1][x]]
                alive = [i for i in alive if not mine[i][1][x]]
                failing = sum(f[x] for _, f in mine)
                lost = [sum(mine[i][0] in s for i in gone) for s in (good, toxic)]
                out[part, "".join(order), step] = [len(alive), len(gone), failing - len(gone), sum(f[x] and sum(f.values()) == 1 for _, f in mine), *lost]
                removals[part, x] = removals.get((part, x), 0) + len(gone)
    return {(*k, *v, removals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("rows", ["odd", "prose"])
def test_audit_query(spark, tmp_path, rows):
    rows = odd_rows() if rows == "odd" else prose_rows(spark)
    path = written(spark, tmp_path, rows, 3)
    labels = [tuple(r) for r in spark.read.parquet(f"{path}/labels.parquet").collect() if r["doc_id"] is not None]
    got = [tuple(r) for r in QUERIES["op12_filter_audit"](spark, path).collect()]
    assert len(got) == len(set(got)) and set(got) == audit_rows(rows, labels)


def test_hot_copies_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(audit, "HOT", 10)
    rows = spark.range(200).select(F.col("id"), F.lit(1).cast("long").alias("h"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("t"))  # two texts of one hash
    assert {r["id"] for r in audit.smaller_copies(rows).collect()} == set(range(200)) - {0, 1}


def line_rows(rows, least=10):
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(SPACE))
    ident = lambda k: 2**63 - 1 if k is None else k
    held = {}
    for k, t, *_ in rows:
        for x in (t or "").split("\n"):
            held.setdefault(key(x), set()).add(ident(k))
    out = []
    for k, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or min(held[key(x)]) == ident(k)]
        out.append((k, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


@pytest.mark.parametrize("rows", ["odd", "prose"])
def test_line_query(spark, tmp_path, monkeypatch, rows):
    rows = odd_rows() if rows == "odd" else prose_rows(spark)
    monkeypatch.setattr(linededup, "SHARD_LINES", 16)
    monkeypatch.setattr(linededup, "BLOCK_LINES", 20)
    got = [tuple(r) for r in QUERIES["op13_line_dedup"](spark, written(spark, tmp_path, rows, 3)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(line_rows(rows), key=key)


def test_line_columns_stay(spark):
    d = spark.createDataFrame([(2, "a line of text\nmine", "own", 7), (1, "A line of text", "own", 8)], "doc_id long, text string, h string, line int")
    out = linededup.drop_shared_lines(d)
    assert out.columns == [*d.columns, "__lines"]
    assert {(r["doc_id"], r["h"], r["line"], r["__lines"]["kept_text"]) for r in out.collect()} == {(2, "own", 7, "mine"), (1, "own", 8, "A line of text")}


def test_minimal_perfect_hash():
    rng = np.random.default_rng(9)
    hi, lo = rng.integers(-(1 << 62), 1 << 62, 5000), rng.integers(0, 3, 5000)
    hi[1::2] = hi[::2]  # pairs that differ in one half only
    lo[1::2] = lo[::2] + 5
    sizes, bits, at = linededup.build_hash(hi, lo)
    assert sorted(at) == list(range(5000)) and (linededup.look_up(sizes, bits, hi, lo) == at).all()
    assert len(bits) < 4 * len(hi)
    none = linededup.build_hash(hi[:0], lo[:0])
    assert (linededup.look_up(none[0], none[1], hi[:3], lo[:3]) == -1).all()


SMALL = ["op7_language_id", "op3_token_counts", "op9_quality_rules", "op10_license_scan", "op11_periodic_runs", "op12_filter_audit", "op13_line_dedup"]


@pytest.mark.parametrize("name", [*SMALL, "op2_benchmark_decontamination", "op4_suffix_array_dedup", "op5_packing", "op6_minhash_near_dedup", "op8_lm_scoring"])
def test_many_files(spark, tmp_path, name):
    """A file without a row, one of null texts without a language, more files than rows: a row for each document."""
    d = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(i, " ".join(f"word{(i * 7 + j) % 90}" for j in range(60)), "en", "s", 0) for i in range(3)], TEXTS).repartition(6).write.parquet(d)
    for k, rows in ((50, []), (60, [(k, None, None, None, None) for k in (60, 61)])):
        spark.createDataFrame(rows, TEXTS).coalesce(1).write.mode("append").parquet(d)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"item{j}" for j in range(30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = QUERIES[name](spark, str(tmp_path)).collect()
    if name == "op12_filter_audit":
        assert {r["part"] for r in rows} == {"", "s"} and len(rows) == 1200
    elif name not in ("op10_license_scan", "op2_benchmark_decontamination"):
        assert {r["doc_id"] for r in rows} == {0, 1, 2, 60, 61}


@pytest.mark.parametrize("name", SMALL)
def test_empty_table(spark, tmp_path, name):
    assert QUERIES[name](spark, written(spark, tmp_path, [], 1)).collect() == []
