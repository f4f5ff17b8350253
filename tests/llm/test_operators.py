"""Edge cases and brute-force comparisons of the training-data operators on small tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendora.llm import decontam, langid, licenses, lm, neardup, packing, quality, suffix, text, tokencount, warc

DATA = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORDS = re.compile("[^\x20\x09-\x0d]+")
ODD = "doc_id long, text string, n_words string, start int"  # two names clash with the operators' own


def docs(spark, texts, schema="doc_id long, text string"):
    rows = [(i, t) for i, t in enumerate(texts)]
    if schema == ODD:
        rows = [(*r, "own", 7) for r in rows]
    return spark.createDataFrame(rows, schema)


def words(t):
    return WORDS.findall((t or "").translate(LOWER))


@pytest.fixture(scope="module")
def sample(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


def test_words_and_shingles():
    texts = [b"One  two\tTHREE four five", b"", b"  \n", "Été x".encode()]
    w = text.Words(texts)
    assert [w.word(i) for i in range(len(w.names))] == [b"one", b"two", b"three", b"four", b"five", "Été".encode(), b"x"]
    assert [len(x) for x in w.shingles(4)] == [2, 0, 0, 1]
    assert len(set(text.Words([b"ab ba abc a b c"]).names.tolist())) == 6


def test_quality_edges(spark):
    long = " ".join(f"the of w{i}" for i in range(20000))
    d = docs(spark, [None, "", "  \n\t", "the of " + " ".join(f"word{i}" for i in range(60)), "a b c " * 40, long], ODD)
    q = {r["doc_id"]: r for r in quality.judge(d).collect()}
    assert [q[i]["__quality"]["kept"] for i in range(6)] == [False, False, False, True, False, True]
    assert q[4]["__quality"]["n_repeat_words"] == 120 and q[5]["__quality"]["n_words"] == 60000
    kept = quality.quality_filter(d)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 5] and kept.first()["n_words"] == "own"
    assert quality.quality_filter(d.limit(0)).count() == 0


def test_archive_round_trip(spark, tmp_path):
    big = "<p>é</p>" * 30
    rows = [(3, "u3", big), (1, "u1", big), (1, "u1", big), (4, "u4", None), (5, "u5", "short"), (6, "u6", "short"), (None, None, big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"))
    back = warc.read_records(spark, str(tmp_path / "a"))
    got = warc.parse_records(back).collect()
    assert len(got) == len(rows) and all(r["verified"] for r in got)
    kinds = collections.Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == {(None, "response", None): 1, (1, "revisit", None): 2, (3, "revisit", None): 1, (4, "response", None): 1, (5, "response", None): 1, (6, "response", None): 1}
    raw = back.filter("page_id = 5").first()["record"]
    head, body = bytes(raw).split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.0\r\n") and body.endswith(b"short\r\n\r\n")
    declared = int(re.search(rb"Content-Length: (\d+)", head)[1])
    assert declared == len(body) - 4
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == 3
    warc.write_archive(pages.limit(0), str(tmp_path / "b"))
    assert warc.parse_records(warc.read_records(spark, str(tmp_path / "b"))).count() == 0


def test_token_counts(spark, sample):
    path = tokencount.default_file("byte_bpe_50k.json")
    odd = [None, "", " a", "a  b\n c", "It's <|endoftext|> x", "汉字 🙂 é", "x" * 5000, "a\x85b\x1cc", "͸ Ᲊ", "\n\n\na \n"]
    texts = odd + [t for _, t in sample[:60]]
    got = {r["doc_id"]: r["n_tokens"] for r in tokencount.count_tokens(docs(spark, texts, ODD), path).collect()}
    tok = tokencount.load(path)
    assert [got[i] for i in range(len(texts))] == [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert tokencount.count_tokens(docs(spark, ["x"]).limit(0), path).count() == 0


def test_packing(spark, sample):
    path = tokencount.default_file("word_bpe_49k.json")
    texts = [None, "", "It's Σ ΑΣ", "<|endoftext|>é a", "x " * 6000, "x " * 6000, "\x00\x01 a\x7f"] + [t for _, t in sample[:60]]
    rows = packing.pack(docs(spark, texts, ODD), path).collect()
    tok = tokencount.load(path)
    ids = [[*tok.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    covered = collections.Counter()
    for r in rows:
        part = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        covered[r["doc_id"]] += r["length"]
    assert covered == {i: len(x) for i, x in enumerate(ids)}
    for _, g in itertools.groupby(sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in g:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096 and at & (at - 1) == 0  # a full sequence or another power of two: no padding
    assert packing.pack(docs(spark, ["x"]).limit(0), path).count() == 0


def test_near_duplicates(spark, sample):
    base = " ".join(f"w{i}" for i in range(300))
    near = base.split()
    near[100] = "changed"
    chain = near[:]
    chain[30] = chain[200] = chain[250] = "more"
    texts = [None, "", "one two", "ONE two", base, " ".join(near), " ".join(chain), base, "x " * 50] + [t for _, t in sample]
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs(spark, texts, ODD)).collect()}
    sets = []
    for t in texts:
        w = words(t)
        sets.append(set(zip(*(w[i:] for i in range(4)))) if len(w) >= 4 else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for i, x in enumerate(sets):
        for sh in x:
            holders[sh].append(i)
    for a, b in {p for h in holders.values() for p in itertools.combinations(h, 2)}:
        i = len(sets[a] & sets[b])
        if 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert [got[i]["component_id"] for i in range(len(texts))] == [root(i) for i in range(len(texts))]
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(x) for x in sets]
    d = docs(spark, ["a b c d e f"] * 3 + ["z"], ODD).unionByName(spark.createDataFrame([(None, "a b c d e f", "own", 7), (0, "a b c d e f", "own", 7)], ODD))
    left = neardup.drop_near_duplicates(d)
    assert left.columns == d.columns and sorted(str(r["doc_id"]) for r in left.collect()) == ["0", "3", "None"]


def test_long_repeats(spark, sample):
    rng = np.random.default_rng(5)
    part = "".join(rng.choice(list("abcdefgh "), 700))
    more = "".join(rng.choice(list("ijklmnop "), 900))
    texts = [None, "", "short", part, more[:300] + part[100:500] + more[300:], "ab" * 400, "é" * 150, more[:199], part[:199] + "é" + part[199:]] + [t for _, t in sample[:80]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, part)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix.remove_repeats(d).collect()
    seen = collections.Counter()
    raw = [(t or "").encode() for _, t in rows]
    for b in raw:
        seen.update(b[i : i + 200] for i in range(len(b) - 199))
    for r in got:
        b = (r["text"] or "").encode()
        hit = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                hit[i : i + 200] = True
        kept = bytes(x for x, h in zip(b, hit) if not h)
        c = r["__cut"]
        assert (c["n_bytes"], c["n_removed"], c["kept_sha256"]) == (len(b), int(hit.sum()), hashlib.sha256(kept).hexdigest())
        assert c["n_spans"] == sum(1 for i in range(len(hit)) if hit[i] and (i == 0 or not hit[i - 1]))
    assert len(got) == len(rows)
    assert suffix.remove_repeats(d.limit(0)).count() == 0


def test_decontamination(spark):
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 8)))
    items = [" ".join(word() for _ in range(n)) for n in (6, 20, 33, 47, 60, 200)]
    clean = [" ".join(word() for _ in range(300)) for _ in range(12)]
    texts = [f"{c} {items[i % 6]} {c[::-1]}" for i, c in enumerate(clean[:6])] + clean[6:]
    long = items[4].split()
    long[30] = "other"  # one word in sixty: similarity 51 / 61
    texts += [f"{clean[0]} {' '.join(long)}", f"{clean[1]} {' '.join(items[3].split()[:20])}", None, "", items[1].upper()]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, "two words")], "item_id long, text string")
    d = docs(spark, texts, ODD)
    got = {(r["k"], r["item_id"]) for r in decontam.contaminated(d, bench).collect()}
    assert got == {(i, i) for i in range(6)} | {(12, 4), (16, 1)}
    left = decontam.decontaminate(d, bench)
    assert left.columns == d.columns and {r["doc_id"] for r in left.collect()} == {6, 7, 8, 9, 10, 11, 13, 14, 15}
    assert decontam.decontaminate(d, bench.limit(0)).count() == len(texts) and decontam.contaminated(d.limit(0), bench).count() == 0


def test_decontamination_finds_every_window(spark):
    rng = np.random.default_rng(11)
    draw = lambda n: ["".join(rng.choice(list("abcdefghij"), rng.integers(3, 8))) for _ in range(n)]
    items = [draw(n) for n in (13, 40, 200, 600)] + [["a", "b", "c", "d", "e"] * 6]
    texts = []
    for it in items:
        n = len(it)
        k = max(1, n // 10)
        one, many = it[:], it[:]
        one[n // 2] = "other"
        many[0] = many[n // 3] = many[-1] = "other"
        for edited in (it, it[k:], it[:-k], it[k // 2 :], one, many, [*it[: n // 2], "more", *it[n // 2 :]]):
            texts.append([*draw(30), *edited, *draw(30)])
            texts.append([*draw(9), *edited])
            texts.append(edited)
    got = decontam.contaminated(docs(spark, [" ".join(t) for t in texts]), docs(spark, [" ".join(i) for i in items]), item_key="doc_id").collect()

    def shingles(w):
        return collections.Counter(zip(*(w[i:] for i in range(5))))

    want = {}
    for d, t in enumerate(texts):
        for i, it in enumerate(items):
            if not set(shingles(it)) & set(shingles(t)):
                continue
            b, good = shingles(it), []
            for s in range(len(t)):
                a = shingles(t[s : s + len(it)])
                same = (a & b).total()
                if same * 100 >= (a.total() + b.total() - same) * 80:
                    good.append((-same / (a.total() + b.total() - same), s))
            if good:
                want[d, i] = (min(good)[1], len(good))
    assert {(r["k"], r["item_id"]): (r["start"], r["n_windows"]) for r in got} == want
    assert len(want) > 60


def test_language_id(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet")
    test = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    learned = langid.profiles(rows.filter(~test))
    done = langid.identify(rows.filter(test), learned)
    right, n = done.agg(F.count_if(F.col("__lang.lang_pred") == F.col("lang")), F.count("*")).first()
    assert right / n > 0.95
    odd = langid.identify(docs(spark, [None, "", "123 !!", "é"], ODD), learned).collect()
    assert [r["__lang"]["lang_pred"] == "und" for r in odd] == [True, True, True, False]
    assert all(0 <= r["__lang"]["score"] <= 1 for r in odd)
    assert langid.identify(docs(spark, ["some words"]), {}).first()["__lang"]["lang_pred"] == "und"
    codes = langid.grams(["Ab c", "", "!!x."])
    spelled = [[chr(int(c) >> 42) + chr(int(c) >> 21 & 0x1FFFFF) + chr(int(c) & 0x1FFFFF) for c in g] for g in codes]
    assert spelled[0] == [" ab", "ab ", "b c", " c "] and spelled[1] == [] and spelled[2] == [" x "]


def test_language_id_of_a_very_varied_text():
    """Bundling in blocks, with more sequences than are kept, is the plain sum over all letters' vectors."""
    space, n_codes = langid.Space(), langid.KEPT_ROWS + 3 * langid.BLOCK
    letters = np.array([x for x in range(0x4E00, 0x4E00 + 400)], np.int64)
    every = np.unique(letters[:, None] << 42 | letters[None, :] << 21 | 0x61)[:n_codes]
    n = np.arange(len(every)) % 5 + 1
    plain = np.zeros(langid.DIMENSIONS, np.int64)
    own = {c: langid.letter_vector(c).astype(np.int64) for c in [*letters.tolist(), 0x61]}
    for c, m in zip(every.tolist(), n.tolist(), strict=True):
        plain += m * np.roll(own[c >> 42], 2) * np.roll(own[c >> 21 & 0x1FFFFF], 1) * own[c & 0x1FFFFF]
    assert len(every) == n_codes and (space.bundle(every, n) == plain).all()
    assert len(space.codes) <= langid.KEPT_ROWS


def test_language_model(spark, sample):
    rows = [(*r, zlib.crc32(str(r[0]).encode()) % 7 == 2) for r in sample] + [(None, "a b", False), (10**9, None, True), (10**9, None, True)]
    d = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    train = [r for r in rows if r[0] is not None and not r[2]]
    count = collections.Counter(w for _, t, _ in train for w in [*words(t), None])
    n, v = sum(count.values()), len(count)
    got = lm.score(d, lm.train(d.filter("NOT held_out AND doc_id IS NOT NULL"))).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for key, t, _ in rows:
        w, r = [*words(t), None], by[key]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in count for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
    held = [by[k] for k, _, h in rows if h]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_seating_matches_expectation():
    name = text.mix(np.arange(4000, dtype=np.uint64))
    t = lm.seat(np.full(4000, 3), np.zeros(4000), 4.0, 0.5, np.full(4000, 0.4), 1.0, name, 1, feeds=0)
    # a table more weighs (4 + t / 2) * 0.4; three customers sit at one table in (1 - d)(2 - d) ways, at two in 3 (1 - d), at three in one
    one, two, three = 0.5 * 1.5, 3 * 0.5 * 4.5 * 0.4, 4.5 * 0.4 * 5 * 0.4
    want = (one + 2 * two + 3 * three) / (one + two + three)
    assert abs(t.mean() - want) < 0.05


def test_licenses(spark):
    texts = [None, "", "no notice here", "Text.\nReleased under the MIT License.", "Licensed under the Apache License, Version 2.0.\nmore", "Licensed under CC BY 4.0.", "This work is licensed under the GNU General Public License, version 2.",
             "we discussed the license of a driver at length and then went home", "All rights reserved.", "This work is licensed under the GNU General Public Licence, version 3."]
    got = {r["k"]: r for r in licenses.license_scan(docs(spark, texts, ODD)).collect()}
    assert {k: r["license"] for k, r in got.items()} == {3: "MIT", 4: "Apache-2.0", 5: "CC-BY-4.0", 6: "GPL-2.0", 8: "Proprietary", 9: "GPL-3.0"}
    assert (got[9]["missing"], got[9]["added"]) == ("license", "licence") and got[3]["missing"] == "" and texts[3][got[3]["start"] : got[3]["end"]] == "Released under the MIT License."


def test_licenses_over_lines_and_in_prose(spark):
    by = {name: wording for name, wording, _ in licenses.TEMPLATES}
    prose = "We walked along the river and talked about nothing in particular."
    wrap = lambda t, n: "\n".join(" ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    mit, apache = licenses.TEMPLATES[3][1], licenses.TEMPLATES[5][1]
    texts = [
        "Released under the\nMIT License.",
        f"{prose}\n{wrap(mit, 9)}\n{prose}",
        f"{wrap(prose + ' ' + apache, 7)}\n{prose}",
        f"{prose} {by['MPL-2.0']} {prose}",
        wrap(f"{' '.join([prose] * 200)} {mit} {' '.join([prose] * 200)}", 12),
        f"{prose} All rights\nreserved.",
        f"{' '.join([prose] * 200)} {apache}. {' '.join([prose] * 200)}",
    ]
    got = licenses.license_scan(docs(spark, texts, ODD)).collect()
    assert sorted((r["k"], r["license"]) for r in got) == [(0, "MIT"), (1, "MIT"), (2, "Apache-2.0"), (3, "MPL-2.0"), (4, "MIT"), (5, "Proprietary"), (6, "Apache-2.0")]
    assert all(r["similarity"] > 0.9 for r in got)


def test_pipeline(spark):
    import corpus_pipeline

    source = spark.read.parquet(f"{DATA}/documents.parquet")
    d = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, DATA)
        assert out.columns == source.columns, name
        path = warc.shared_dir(spark, name)
        out.write.parquet(path)
        d = spark.read.parquet(path)
    packed = corpus_pipeline.STAGES[-1][1](spark, d, DATA)
    assert packed.agg(F.sum("length")).first()[0] == packed.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]


def _groups(texts, n=4):
    """Brute force: the smallest index that each text reaches over pairs at 0.8."""
    sets = [set(zip(*(w[i:] for i in range(n)))) if len(w) >= n else {tuple(w)} if w else set() for w in map(words, texts)]
    root = list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        i = len(sets[a] & sets[b])
        if i and 100 * i >= 80 * (len(sets[a]) + len(sets[b]) - i):
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return [top(i) for i in range(len(texts))]


def test_near_duplicates_in_large_nodes(spark):
    # documents that share half of their words, so that they meet in many nodes, with some real copies among them
    rng = np.random.default_rng(3)
    shared = [f"s{i}" for i in range(200)]
    texts = []
    for i in range(60):
        own = [f"o{i}x{j}" for j in range(70)]
        texts.append(" ".join(shared + own))
        if i % 5 == 0:
            own[int(rng.integers(70))] = "other"
            texts.append(" ".join(shared + own))
    want = _groups(texts)
    for limit in (10, 10**6):
        got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(spark, texts), pairs_at_most=limit).collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_near_duplicates_of_one_id(spark):
    a, b, c = (" ".join(f"{p}{i}" for i in range(40)) for p in "abc")
    near = lambda t: t.replace(t.split()[39], "other")
    rows = [(1, a), (1, b), (2, near(a)), (3, near(b)), (4, c), (1, a)]
    got = sorted((r["doc_id"], r["component_id"], r["n_shingles"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1, 37), (1, 1, 37), (1, 1, 37), (2, 1, 37), (3, 1, 37), (4, 4, 37)]
    assert neardup.near_duplicates(docs(spark, ["x"]).limit(0)).count() == 0


BIG = 2**53 + 1  # a double cannot hold it
PROSE = " ".join(f"wörd{i} of the" for i in range(120)) + "\nReleased under the MIT License."
LONG = " ".join(f"x{i * 7919 % 999983}" for i in range(190_000))  # over 1 MiB
ROWS = [(BIG, PROSE), (None, PROSE), (0, None), (-5, ""), (7, PROSE), (7, PROSE), (9, LONG)]


def _same_ids(rows, key="doc_id"):
    assert sorted(map(str, (r[key] for r in rows))) == sorted(str(k) for k, _ in ROWS)


def _each(name, spark, d, bench):
    """Rows of an operator over odd rows, after what must hold for it."""
    by = lambda rows, key="doc_id": {r[key]: r for r in rows}
    if name == "warc":
        pages = d.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"), "n_words", "start")
        path = warc.shared_dir(spark, "edge")
        warc.write_archive(pages, path)
        rows = warc.parse_records(warc.read_records(spark, path)).collect()
        _same_ids(rows, "page_id")
        assert by(rows, "page_id")[9]["payload_bytes"] == len(LONG) and sum(r["record_type"] == "revisit" for r in rows) == 3
    elif name == "decontam":
        assert {r["k"] for r in decontam.contaminated(d, bench).collect()} == {BIG, None, 7}
        assert {r["doc_id"] for r in decontam.decontaminate(d, bench).collect()} == {0, -5, 9}
    elif name == "tokencount":
        rows = tokencount.count_tokens(d, tokencount.default_file("byte_bpe_50k.json")).collect()
        _same_ids(rows)
        assert by(rows)[BIG]["n_tokens"] == by(rows)[7]["n_tokens"] > 300 and by(rows)[0]["n_tokens"] == 0
    elif name == "suffix":
        rows = suffix.remove_repeats(d).collect()
        _same_ids(rows)
        n = len(PROSE.encode())
        assert {r["doc_id"]: r["__cut"]["n_removed"] for r in rows} == {BIG: n, None: n, 7: n, 0: 0, -5: 0, 9: 0}
    elif name == "packing":
        rows = packing.pack(d, tokencount.default_file("word_bpe_49k.json")).collect()
        assert {r["doc_id"] for r in rows} == {k for k, _ in ROWS}
        assert sum(r["length"] for r in rows if r["doc_id"] == 7) == 2 * by(rows)[BIG]["doc_tokens"] and by(rows)[0]["doc_tokens"] == 1
    elif name == "neardup":
        rows = neardup.near_duplicates(d).collect()
        _same_ids(rows)
        assert {r["doc_id"]: r["component_id"] for r in rows} == {BIG: 7, 7: 7, None: None, 0: 0, -5: -5, 9: 9}
    elif name == "langid":
        rows = langid.identify(d, langid.profiles(d.withColumn("lang", F.lit("xx")))).collect()
        _same_ids(rows)
        assert by(rows)[0]["__lang"]["lang_pred"] == "und" and by(rows)[BIG]["__lang"] == by(rows)[7]["__lang"]
        tied = {k: np.ones(langid.DIMENSIONS) for k in "ba"}
        assert {r["__lang"]["lang_pred"] for r in langid.identify(d.filter("doc_id = 7"), tied).collect()} == {"a"}
    elif name == "lm":
        rows = lm.score(d.withColumn("held_out", F.lit(False)), lm.train(d.filter("doc_id IS NOT NULL"))).collect()
        _same_ids(rows)
        assert math.isclose(by(rows)[BIG]["score"], by(rows)[7]["score"]) and by(rows)[9]["n_tokens"] == 190_001
        assert lm.score(d.limit(0).withColumn("held_out", F.lit(False)), lm.train(d.limit(0))).count() == 0
    elif name == "quality":
        rows = quality.judge(d).collect()
        _same_ids(rows)
        assert by(rows)[9]["__quality"]["n_words"] == 190_000 and by(rows)[BIG]["n_words"] == "own"
    else:
        rows = licenses.license_scan(d).collect()
        assert sorted(str(r["k"]) for r in rows) == sorted(map(str, [BIG, None, 7, 7])) and licenses.license_scan(d.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["warc", "decontam", "tokencount", "suffix", "packing", "neardup", "langid", "lm", "quality", "licenses"])
def test_odd_rows(spark, name):
    # one partition, so that a null id shares a batch with one that a double cannot hold
    d = spark.createDataFrame([(*r, "own", 7) for r in ROWS], ODD).coalesce(1)
    _each(name, spark, d, spark.createDataFrame([(1, PROSE)], "item_id long, text string"))


def test_license_notices_in_full(spark):
    by = {(name, wording[:20]): wording for name, wording, _ in licenses.TEMPLATES}
    gpl = next(w for n, w, _ in licenses.TEMPLATES if n == "GPL-3.0" and w.startswith("This program is free"))
    lgpl = next(w for n, w, _ in licenses.TEMPLATES if n == "LGPL-2.1")
    mpl = next(w for n, w, _ in licenses.TEMPLATES if n == "MPL-2.0" and "obtain" in w)
    texts = [gpl, f"Some tool.\n\n{gpl}\n\nParts of it: {lgpl}\n\nMore.", mpl, "\n".join(gpl.split(", "))]
    got = licenses.license_scan(docs(spark, texts)).collect()
    assert len(by) > 30 and sorted((r["k"], r["license"]) for r in got) == [(0, "GPL-3.0"), (1, "GPL-3.0"), (1, "LGPL-2.1"), (2, "MPL-2.0"), (3, "GPL-3.0")]


def test_packer_cuts_little():
    rng = np.random.default_rng(1)
    packer, sequences = packing.Packer(4096), []
    sizes = rng.integers(1, 9000, 3000).tolist()
    for i, n in enumerate(sizes):
        sequences += list(packer.add(packing.Piece(i, False, 0, b"\1\0\0\0" * n, n)))
    assert all(sum(p.size for p in q) == 4096 for q in sequences)
    sequences += list(packer.close())
    pieces = [p for q in sequences for p in q]
    assert sum(p.size for p in pieces) == sum(sizes) and len(sequences) - sum(sizes) // 4096 <= 12
    assert len(pieces) - sum(n // 4096 for n in sizes) < 2 * len(sizes)  # fewer than two pieces a document besides its full sequences


def test_draws_of_strengths():
    rng = np.random.default_rng(2)
    # many tables for the customers there are ask for a large strength, few for a small one
    many = np.mean([lm.draw_strength(5.0, 0.5, 1000, 400, rng) for _ in range(50)])
    few = np.mean([lm.draw_strength(5.0, 0.5, 1000, 3, rng) for _ in range(50)])
    assert many > 2 * few > 0 and lm.draw_strength(1.0, 0.5, 1, 1, rng) == 1.0
