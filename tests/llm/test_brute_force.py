"""The language profiles and the whole pipeline against plain versions of themselves."""

import collections
import itertools
import re
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from vendora.llm import langid, quality, tokencount
from vendora.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORDS = re.compile("[^\x20\x09-\x0d]+")
TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return WORDS.findall((t or "").translate(LOWER))


def sample(spark, n):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").select("doc_id", "text", "lang", "source", "n_chars").collect()
    return [tuple(r) for r in rows if len(r["text"] or "") < 8000][:n]


def profile(text):
    """The sum of the bound vectors of a text's three-letter sequences, letter by letter."""
    s = "".join(c.lower() if c.isalpha() else " " for c in f" {text} ")
    s = re.sub(" +", " ", s)
    out = np.zeros(langid.DIMENSIONS)
    if s.strip():
        for a, b, c in zip(s, s[1:], s[2:], strict=False):
            out += np.roll(langid.letter_vector(ord(a)), 2).astype(int) * np.roll(langid.letter_vector(ord(b)), 1) * langid.letter_vector(ord(c))
    return out


def test_language_profiles(spark, tmp_path):
    rows = [*sample(spark, 70), (9001, None, "en", "s", 0), (9002, "12 34", "en", "s", 0), (9003, "Été!! où", None, "s", 0)]
    spark.createDataFrame(rows, TEXTS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    fold = {k: zlib.crc32(str(k).encode()) % 3 == 1 for k, *_ in rows}
    own = {k: profile(t or "") for k, t, *_ in rows}
    learned = {}
    for k, t, lang, *_ in rows:
        if not fold[k] and lang and t is not None:
            learned[lang] = learned.get(lang, 0) + own[k]
    unit = lambda v: v / max(np.linalg.norm(v), 1e-30)
    got = {r["doc_id"]: r for r in QUERIES["op7_language_id"](spark, str(tmp_path)).collect()}
    assert got.keys() == own.keys()
    for k, v in own.items():
        cos = {x: float(unit(p) @ unit(v)) for x, p in learned.items()}
        best = max(cos, key=cos.get)
        want = (fold[k], best, max(cos[best], 0.0)) if v.any() else (fold[k], "und", 0.0)
        assert (got[k]["held_out"], got[k]["lang_pred"]) == want[:2] and abs(got[k]["score"] - want[2]) < 1e-4


def keep_one(rows):
    """One row of each group at 0.8 of five-word shingles, by all pairs."""
    w = [words(r[1]) for r in rows]
    sets = [set(zip(*(x[i:] for i in range(5)))) if len(x) >= 5 else {tuple(x)} for x in w]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        i = len(sets[a] & sets[b])
        if i and 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return [r for i, r in enumerate(rows) if top(i) == i]


def cut_repeats(rows, length=200):
    raw = [r[1].encode() for r in rows]
    seen = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for r, b in zip(rows, raw, strict=True):
        gone = {j for i in range(len(b) - length + 1) if seen[b[i : i + length]] > 1 for j in range(i, i + length)}
        kept = bytes(x for i, x in enumerate(b) if i not in gone).decode(errors="ignore")
        if kept or not gone:
            out.append((r[0], kept))
    return out


def holds(text, item):
    t, it = words(text), words(item)
    shingles = lambda w: collections.Counter(zip(*(w[i:] for i in range(5))))
    b = shingles(it)
    if len(it) < 5 or not set(b) & set(shingles(t)):
        return False
    for s in range(len(t)):
        a = shingles(t[s : s + len(it)])
        same = (a & b).total()
        if same and same * 100 >= (a.total() + b.total() - same) * 80:
            return True
    return False


def test_pipeline_by_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = sorted(sample(spark, 90))
    prose = [r for r in rows if len(words(r[1])) > 150]
    items = [r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()][:12]
    item = max(items, key=len)
    block = " ".join(rng.choice(words(prose[0][1]), 70))
    planted = [
        prose[1][1], prose[1][1] + " one more", " ".join(words(prose[2][1])[:-1]), f"{prose[3][1]} {block}", f"{prose[4][1][::-1]} {block}", f"{prose[5][1]} {block} {prose[6][1]}", f"{prose[7][1]} {item}", f"{item.upper()} {prose[8][1]}",
        None, "", "too short",
    ]
    rows += [(10_000 + i, t, "en", "s", len(t or "")) for i, t in enumerate(planted)]
    spark.createDataFrame(rows, TEXTS).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    good = {k for k, ok in con.execute(f"SELECT doc_id, kept FROM ({quality.SQL})").fetchall() if ok}
    left = cut_repeats(keep_one([r for r in rows if r[0] in good]))
    left = {k: t for k, t in left if not any(holds(t, x) for x in items)}

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tok = tokencount.load(tokencount.default_file("word_bpe_49k.json"))
    ids = {k: [*tok.encode(t, add_special_tokens=False).ids, 2] for k, t in left.items()}
    assert {r["doc_id"] for r in pieces} == set(left) and 20 < len(left) < len(rows)
    covered = collections.Counter()
    for r in pieces:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        covered[r["doc_id"]] += r["length"]
    assert covered == {k: len(x) for k, x in ids.items()}


def test_stages_keep_columns(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet").filter(F.col("doc_id") < 0)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "packing"]
    assert corpus_pipeline.quality_rules(spark, d, DATA).columns == d.columns
