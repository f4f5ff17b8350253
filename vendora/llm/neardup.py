"""Near-duplicate groups by a chosen-path set similarity join.

A document's shingle set becomes ``WIDTH`` minwise tokens. In each of ``trees`` independent trees a node
draws one coordinate, and a quarter of the nodes a second (1 / 0.8 on average), from its own path; a
document goes down the branch of its token there. Two sets of similarity 0.8 share a node of depth 4 in
one tree with probability 0.576, so that 14 trees miss such a pair with probability 6e-6. A path depends on
the document alone, so all nodes of that depth come from one pass over the texts without a shuffle.

Nodes are then compared: first each document with the most central one of all its nodes, then members that are still in another
group with their node's most central document, then those that this leaves outside its group with the most central of them, and at last all pairs of members that are still in
different groups. Where those are more than ``PAIRS`` in a node, it branches on before: its members go down ``AGAIN`` new trees from
there, ``DEPTH`` levels at a time, until nodes are small or ``DEEPEST`` is reached (a pair at 0.8 is lost by that in 3 of 100 of its nodes,
of which it has eight on average); large nodes that stay are compared in parts. Sketches of two bits per minwise token drop pairs at 4.5 deviations below the
threshold; every link is confirmed on the full sets.

Sets that are equal (128-bit digest and size) are one class from the start, so thousands of copies are one
member. Defined cases: null or wordless text: empty set, linked with nothing; a null id takes part in
nothing, is kept and has a null component; rows that share an id are one document per distinct set, each with its own
links, and a group is named by the smallest id of its documents; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import _saved, components, spread_join
from .text import U, Words, as_bytes, give_back, mix, runs

WIDTH, DEPTH, TREES = 1024, 4, 14
#: Pairs that are compared in a node before it branches on, trees that it then has, and the depth at which all are compared.
PAIRS, AGAIN, DEEPEST = 4_000_000, 4, 12
#: Members of a large node that one part compares with the others.
PART = 1_000
#: Two bits of each token make the sketch, 32 tokens to a number.
BITS = [f"b{i}" for i in range(WIDTH // 32)]
_rng = np.random.default_rng(20260202)
_SCALE = _rng.integers(0, 1 << 32, WIDTH, dtype=np.uint32) | np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, WIDTH, dtype=np.uint32)
_SEEDS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """WIDTH minwise tokens of each of some non-empty sets."""
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    low = (np.concatenate(sets) >> U(32)).astype(np.uint32)
    out = np.empty((len(sets), WIDTH), np.uint32)
    for i in range(WIDTH):
        h = low * _SCALE[i] + _SHIFT[i]
        out[:, i] = np.minimum.reduceat(h ^ (h >> np.uint32(15)), first)
    return out


def paths(tokens: np.ndarray, row: np.ndarray, path: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) for every node that is reached from ``path``, each that of a row of tokens, ``depth`` levels down."""
    for _ in range(depth):
        also = (mix(path + U(11)) & U(3)) == 0
        row = np.concatenate((row, row[also]))
        draw = np.concatenate((mix(path + U(1)), mix(path[also] + U(2)))) % U(WIDTH)
        path = np.concatenate((path, path[also]))
        path = mix(path + mix(draw * U(1 << 32) + tokens[row, draw.astype(np.int64)]))
    return row, path


def roots(rows: int, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, path) of each of some rows at the root of each tree."""
    return np.repeat(np.arange(rows), trees), np.tile(mix(_SEEDS[:trees]), rows)


def _digests(x: np.ndarray) -> tuple[np.int64, np.int64]:
    return mix(x).sum(dtype=U).view(np.int64), mix(x ^ U(0x5555555555555555)).sum(dtype=U).view(np.int64)


def _bits(tokens: np.ndarray) -> np.ndarray:
    """Two bits of each token, as len(BITS) 64-bit numbers a row."""
    two = (mix(tokens.astype(U)) & U(3)).reshape(len(tokens), -1, 32)
    return np.bitwise_or.reduce(two << (U(2) * np.arange(32, dtype=U)), axis=2).view(np.int64)


def _set_rows(shingle: int, trees: int, depth: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, marks = batch["k"].to_numpy(), batch["h"].to_numpy()
            for at, run in runs(as_bytes(batch["t"])):
                sets = Words(run).shingles(shingle)
                size = np.array([len(s) for s in sets])
                full = np.flatnonzero(size)
                d1, d2 = np.zeros(len(run), np.int64), np.zeros(len(run), np.int64)
                bits = np.zeros((len(run), len(BITS)), np.int64)
                nodes = [np.zeros(0, np.int64)] * len(run)
                if len(full):
                    tokens = minwise([sets[i] for i in full])
                    bits[full] = _bits(tokens)
                    row, path = paths(tokens, *roots(len(full), trees), depth)
                    order = np.lexsort((path, row))
                    parts = np.split(path[order].view(np.int64), np.cumsum(np.bincount(row, minlength=len(full)))[:-1])
                    for i, p in zip(full, parts, strict=True):
                        nodes[i] = np.unique(p)
                        d1[i], d2[i] = _digests(sets[i])
                yield pd.DataFrame({"doc_id": keys[at : at + len(run)], "text_hash": marks[at : at + len(run)], "n": size, "d1": d1, "d2": d2} | {b: bits[:, i] for i, b in enumerate(BITS)} | {"nodes": nodes})
        give_back()

    return rows


def _full_sets(shingle: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["k"].to_numpy()
            for at, run in runs(as_bytes(batch["t"])):
                sets = Words(run).shingles(shingle)
                d = [_digests(s) for s in sets]
                yield pd.DataFrame({"doc": keys[at : at + len(run)], "n": [len(s) for s in sets], "d1": [x for x, _ in d], "d2": [y for _, y in d], "set": [s.view(np.int64) for s in sets]})
        give_back()

    return rows


def _children(shingle: int, again: int, depth: int):
    """From each text's large nodes (k, t, ds: its digests with the nodes of their class) the nodes below: (id, node)."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            wanted = batch["ds"].tolist()
            for at, run in runs(as_bytes(batch["t"])):
                sets = Words(run).shingles(shingle)
                ids, nodes = [], []
                for s, ds in zip(sets, wanted[at : at + len(run)], strict=True):
                    mine = [d for d in ds if (d["d1"], d["d2"]) == _digests(s)] if len(s) else []
                    if mine:
                        start = np.array([mix(np.array([n], np.int64).view(U) + U(77 * (i + 1)))[0] for d in mine for n in d["nodes"] for i in range(again)], U)
                        _, path = paths(minwise([s]), np.zeros(len(start), np.int64), start, depth)
                        nodes.append(np.unique(path).view(np.int64))
                        ids.append(np.full(len(nodes[-1]), mine[0]["id"]))
                if ids:
                    yield pd.DataFrame({"id": np.concatenate(ids), "node": np.concatenate(nodes)})
        give_back()

    return rows


def _near(a: str, b: str, percent: int) -> Column:
    """Sizes allow the similarity, and sketches are within 4.5 deviations of what it gives on average."""
    far = F.lit(0)
    for c in BITS:
        x = F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))
        far = far + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    p = percent / 100 + (1 - percent / 100) / 4
    most = int(WIDTH * (1 - p) + 4.5 * (WIDTH * p * (1 - p)) ** 0.5) + 1
    sizes = (F.col(f"{a}.n") * 100 >= F.col(f"{b}.n") * percent) & (F.col(f"{b}.n") * 100 >= F.col(f"{a}.n") * percent)
    return sizes & (far <= most)


def _texts(live: DataFrame, classes: DataFrame) -> DataFrame:
    """Texts of the classes' smallest ids."""
    return live.join(classes.select(F.col("doc").alias("k")).distinct(), "k", "left_semi")


def _branch_on(named: DataFrame, large: DataFrame, live: DataFrame, classes: DataFrame, shingle: int, depth: int) -> DataFrame:
    """Members of the ``large(node)`` nodes in nodes ``depth`` levels below, as ``named`` has them."""
    of = named.join(large, "node", "left_semi")
    nodes = of.groupBy("id").agg(F.collect_set("node").alias("nodes"))
    wanted = classes.select("id", "doc", "d1", "d2").join(nodes, "id")
    per_doc = wanted.groupBy(F.col("doc").alias("k")).agg(F.collect_list(F.struct("id", "d1", "d2", "nodes")).alias("ds"))
    found = live.join(per_doc, "k").mapInPandas(_children(shingle, AGAIN, depth), "id long, node long").distinct()
    about = of.groupBy("id").agg(F.first("g").alias("g"), F.max("out").alias("out"))
    return found.join(about, "id").select("node", "id", "g", "out")


def _rest(named: DataFrame, live: DataFrame, classes: DataFrame, shingle: int, percent: int, pairs_at_most: int, depth: int) -> DataFrame:
    """(a, b): pairs in different groups of which one is outside its node's first group, ``named(node, id, g, out)``, by sketch."""
    level, done = depth, None
    while True:
        sizes = _saved(named.groupBy("node").agg(F.count_if("out").alias("o"), F.count("*").alias("n")).filter("o > 0"), "sizes")
        large = sizes.filter(F.col("o") * F.col("n") > pairs_at_most).select("node")
        if done is None and sizes.isEmpty():
            return sizes.select(F.col("node").alias("a"), F.col("node").alias("b"))
        if level >= DEEPEST or large.isEmpty():
            break
        small = named.join(sizes.filter(F.col("o") * F.col("n") <= pairs_at_most), "node", "left_semi")
        done = small if done is None else done.unionByName(small)
        named, level = _saved(_branch_on(named, large, live, classes, shingle, depth), "branches"), level + depth
    named = named if done is None else done.unionByName(named)
    counts = named.groupBy("node").agg(F.count_if("out").alias("o")).filter("o > 0")
    open_ = named.join(counts.select("node", F.ceil(F.col("o") / PART).cast("int").alias("parts")), "node")
    # a pair is taken up in the least node that it shares, not in each
    full = classes.select("id", "n", *BITS).join(open_.groupBy("id").agg(F.collect_set("node").alias("nodes")), "id")
    once = F.array_min(F.array_intersect("x.nodes", "y.nodes")) == F.col("x.node")
    x = open_.filter("out").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).join(full, "id").alias("x")
    y = open_.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(full, "id").alias("y")
    both = x.join(y, (F.col("x.node") == F.col("y.node")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.g") != F.col("y.g")) & _near("x", "y", percent) & once)
    return both.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, percent: int = 80, trees: int = TREES, depth: int = DEPTH, pairs_at_most: int = PAIRS) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id (smallest id of its group), xxhash64 of the text, kept."""
    docs = df.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("t"))
    live = docs.filter("k IS NOT NULL")
    kinds = "doc_id long, text_hash long, n long, d1 long, d2 long, " + ", ".join(f"{b} long" for b in BITS) + ", nodes array<long>"
    rows = _saved(live.mapInPandas(_set_rows(shingle, trees, depth), kinds), "sets")
    same = ["n", "d1", "d2"]
    classes = _saved(rows.filter("n > 0").groupBy(*same).agg(F.min("doc_id").alias("doc"), *(F.first(b).alias(b) for b in BITS), F.first("nodes").alias("nodes")), "classes")
    # a class has its smallest id as its own; where several have the same, a hash
    shared = classes.groupBy("doc").agg(F.count("*").alias("c")).filter("c > 1").select("doc", F.lit(True).alias("many"))
    several = not shared.isEmpty()
    if several:
        classes = classes.join(shared, "doc", "left").withColumn("id", F.when(F.col("many"), F.xxhash64("doc", *same)).otherwise(F.col("doc")))
    else:
        classes = classes.withColumn("many", F.lit(None).cast("boolean")).withColumn("id", F.col("doc"))
    sketch = classes.select("id", "n", *BITS)
    member = classes.select(F.explode("nodes").alias("node"), "id")
    size = _saved(member.groupBy("node").agg(F.count("*").alias("c")).filter("c > 1"), "nodes")
    by_node = size.select("node", F.col("c").alias("n"))
    member = spread_join(member, size, ["node"], by_node)
    # who meets most others stands in the middle of a group: copies are nearer to their original than to each other
    degree = member.groupBy("id").agg(F.sum("c").alias("degree"))
    member = _saved(member.select("node", "id").join(degree, "id").withColumn("rank", F.struct("degree", (-F.col("id")).alias("last"))), "members")
    centre = member.groupBy("node").agg(F.max("rank").alias("m")).select("node", "m", (-F.col("m.last")).alias("first"))
    member = _saved(spread_join(member, centre, ["node"], by_node), "members")

    group = member.select("id", F.col("id").alias("component")).limit(0)
    for step in ("centre", "first", "outside", "rest"):
        named = member.join(group, "id", "left").withColumn("g", F.coalesce("component", "id")).drop("component")
        named = named.join(group.select(F.col("id").alias("first"), F.col("component").alias("fg")), "first", "left").withColumn("fg", F.coalesce("fg", "first"))
        named = named.withColumn("out", F.col("g") != F.col("fg"))
        if step == "centre":
            # of the central documents of its nodes, the one that meets most
            pairs = member.filter("id <> first").groupBy("id").agg(F.max("m").alias("m")).select((-F.col("m.last")).alias("a"), F.col("id").alias("b"))
        elif step == "first":
            pairs = named.filter("out").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
        elif step == "outside":
            second = named.filter("out").groupBy("node").agg(F.max(F.struct("rank", "g")).alias("s"))
            pairs = named.join(second, "node").filter("g <> s.g AND id <> first").select((-F.col("s.rank.last")).alias("a"), F.col("id").alias("b")).distinct()
        else:
            pairs = _rest(named.select("node", "id", "g", "out"), live, classes, shingle, percent, pairs_at_most, depth)
        pairs = _saved(pairs, "pairs")
        if pairs.isEmpty():
            continue
        near = pairs  # the rest are by sketch already
        if step != "rest":
            # a node's central document is in many pairs
            counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
            ours = sketch.select(F.col("id").alias("a"), F.struct("n", *BITS).alias("p"))
            theirs = sketch.select(F.col("id").alias("b"), F.struct("n", *BITS).alias("q"))
            near = _saved(spread_join(pairs, ours, ["a"], counts).join(theirs, "b").filter(_near("p", "q", percent)).select("a", "b"), "near")
        found = _saved(_confirm(near, live, classes, shingle, percent), "links") if not near.isEmpty() else near
        if not found.isEmpty():
            group = components(found.unionByName(group.select(F.col("id").alias("a"), F.col("component").alias("b"))))

    label = classes.select("id", "doc", "many", *same).join(group, "id", "left").withColumn("c", F.coalesce("component", "id"))
    if several:
        # groups with a class that is named by a hash
        least = label.join(label.filter("many").select("c").distinct(), "c", "left_semi").groupBy("c").agg(F.min("doc").alias("least"))
        label = label.join(least, "c", "left").withColumn("c", F.coalesce("least", "c"))
    label = label.select(*same, "c")
    done = rows.select("doc_id", "text_hash", *same).join(label, same, "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "doc_id").alias("component_id"), "text_hash")
    lost = docs.filter("k IS NULL").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.col("h").alias("text_hash"))
    return done.unionByName(lost).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with one row of each group and every row without an id, in the columns it had."""
    kept = near_duplicates(df, key, text, shingle, percent).filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__k"), F.col("text_hash").alias("__h")).distinct()
    rows = df.withColumn("__k", F.col(key).cast("long")).withColumn("__h", F.xxhash64(F.col(text)))
    one = rows.join(kept, ["__k", "__h"], "left_semi").dropDuplicates(["__k", "__h"])
    return one.unionByName(rows.filter("__k IS NULL")).select(*df.columns)


def _confirm(near: DataFrame, live: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs ``near(a, b)`` of classes whose full sets have the similarity."""
    ids = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct()
    wanted = classes.select("id", "doc", "n", "d1", "d2").join(ids, "id", "left_semi")
    sets = _texts(live, wanted).mapInPandas(_full_sets(shingle), "doc long, n long, d1 long, d2 long, set array<long>")
    sets = _saved(sets.join(wanted, ["doc", "n", "d1", "d2"]).select("id", "set").dropDuplicates(["id"]), "full")
    counts = near.groupBy("a").agg(F.count("*").alias("n"))
    both = spread_join(near, sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), ["a"], counts).join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("i"))
    return both.filter(F.col("i") * 100 >= (F.col("na") + F.col("nb") - F.col("i")) * percent).select("a", "b")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: near-duplicate groups of ``documents`` on four-word shingles at 0.8."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")
