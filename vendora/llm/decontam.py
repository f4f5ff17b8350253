"""Benchmark decontamination, in DataFrame operations only.

1. Anchors. A window that reaches the similarity holds one at least of an item's rarest shingles, as many as the
   similarity allows to miss and one more. Only windows of the item's size near such a shingle are looked at.
2. Fingerprints. Each of them has a 64-bit SimHash of its word pairs. Counters of all bits are running sums, sixteen
   bits wide and four to a number, so that a window of any size costs one difference of two rows.
3. Index. Fingerprints are cut into eight blocks. If two differ in at most RADIUS bits, some block differs in at most
   two, so an index of each item's blocks with all changes of up to two bits finds every pair within the radius.
4. Verification. The shingles of the item and of the window, weighted by how often they occur, must have a
   similarity of 0.8 or more.

The radius: a window of the item's size at similarity 0.8 lacks at most a ninth of its shingles, and no more pairs than
shingles (a run of e changed words costs e + 4 shingles and e + 1 pairs inside, e and e at an edge). Where pairs hardly repeat that
is a cosine of 8 / 9, and each bit differs with probability 0.152: more than 23 of 64 do in 1 of 50,000 such windows, while an item
that stands in the text usually has several. Repeated pairs can move a fingerprint further, so windows and items in
which more than half the root of their pairs are repeats do not depend on it: they are verified as they are, as are items of more
than LONGEST words, whose counters would not fit. Windows that share too few shingle places with the item to reach the similarity are left out before.

Defined cases: null texts count as empty; texts and items of under five words match nothing; a null id is an id like
others; repeated rows are judged once and reported once; of equally similar windows the first is reported; empty
tables give an empty result; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .components import _saved, spread_join
from .quality import SPACE, _let

SHINGLE = 5
RADIUS, BLOCKS, BLOCK_BITS = 23, 8, 8
LANES, LANE_BITS = 0x0001000100010001, 16
#: Words of the longest item whose counters fit their lanes.
LONGEST = 1 << 14
#: A table of items is broadcast up to this size, and joined by shuffle beyond.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")


def _shingles(words: Column) -> Column:
    """Five-word shingles in order, as text."""
    def each(w: Column) -> Column:
        places = F.when(F.size(w) >= SHINGLE, F.sequence(F.lit(0), F.size(w) - SHINGLE)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat_ws(" ", *(F.get(w, i + j) for j in range(SHINGLE))))

    return _let(words, each)


def _hashes(words: Column, size: int) -> Column:
    def each(w: Column) -> Column:
        places = F.when(F.size(w) >= size, F.sequence(F.lit(0), F.size(w) - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(size))))

    return _let(words, each)


def _with(docs: DataFrame, more: DataFrame, column: str) -> DataFrame:
    more = more.select(F.col("k").alias("k2"), F.col("h").alias("h2"), column)
    return docs.join(more, (docs["h"] == F.col("h2")) & docs["k"].eqNullSafe(F.col("k2"))).drop("k2", "h2")


def _keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("k"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("t"))


def _lanes(pair: str) -> list[Column]:
    """The 64 bits of a hash as LANE_BITS numbers of four counters each."""
    return [F.shiftrightunsigned(pair, j).bitwiseAND(F.lit(LANES)) for j in range(LANE_BITS)]


def _simhash(counts: list[Column], n: Column) -> Column:
    """Bits that are set in more than half of ``n`` hashes."""
    # a lane's bit 14 is set if its count is a majority
    over = F.lit(LANES) * (F.lit(1 << 14) - F.floor(n / 2).cast("long") - 1)
    fp = F.lit(0).cast("long")
    for j, c in enumerate(counts):
        fp = fp.bitwiseOR(F.shiftleft(F.shiftrightunsigned((c + over).bitwiseAND(F.lit(LANES << 14)), 14), j))
    return fp


def item_fingerprints(items: DataFrame) -> DataFrame:
    """(iid, ifp) of items whose counters fit."""
    pairs = items.filter(F.size("iw") <= LONGEST).select("iid", F.explode(_hashes(F.col("iw"), 2)).alias("f"))
    sums = pairs.groupBy("iid").agg(*(F.sum(c).alias(f"l{j}") for j, c in enumerate(_lanes("f"))), F.count("*").alias("n"))
    return sums.select("iid", _simhash([F.col(f"l{j}") for j in range(LANE_BITS)], F.col("n")).alias("ifp"))


def _changes() -> list[int]:
    """All changes of up to two bits of a block: RADIUS // BLOCKS."""
    one = [1 << i for i in range(BLOCK_BITS)]
    return [0, *one, *(a | b for i, a in enumerate(one) for b in one[:i])]


def _blocks(fp: str) -> Column:
    return F.array(*(F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("v")) for b in range(BLOCKS)))


def block_index(first: DataFrame) -> DataFrame:
    """(iid, ifp, block, v): each block of each item's fingerprint with every change that the radius leaves one block."""
    rows = first.select("iid", "ifp", F.explode(_blocks("ifp")).alias("b"))
    changed = F.transform(F.array(*map(F.lit, _changes())), lambda m: F.col("b.v").bitwiseXOR(m.cast("long")))
    return rows.select("iid", "ifp", F.col("b.block").alias("block"), F.explode(changed).alias("v"))


def _counted(shingles: Column) -> Column:
    """A multiset as a set of strings: an element again has the number of its occurrence as a sixth word."""
    def each(s: Column) -> Column:
        again = F.transform(s, lambda x, i: _let(i + 1 - F.array_position(s, x), lambda n: F.when(n > 0, F.concat_ws(" ", x, n.cast("string"))).otherwise(x)))
        return F.when(F.size(F.array_distinct(s)) == F.size(s), s).otherwise(again)

    return _let(F.sort_array(shingles), each)


def _least(m: Column, whole: Column, percent: int) -> Column:
    """Shingles that a window shares at least with an item of ``m``: one as large as the item, or one that the text's end cuts short."""
    return F.when(whole, F.floor((m * (2 * percent) + 99 + percent) / (100 + percent))).otherwise(F.floor((m * percent + 99) / 100)).cast("int")


def _rarest(items: DataFrame, seen: DataFrame, percent: int) -> DataFrame:
    """(iid, m, s): shingles of each item of m words of which a window that reaches the similarity holds one at least; ``seen(s, f)`` says how often they occur."""
    of = items.select("iid", F.size("iw").alias("m"), F.explode(_hashes(F.col("iw"), SHINGLE)).alias("s")).join(seen, "s", "left")
    of = of.groupBy("iid", "m").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "s"))).alias("x"))
    some = F.slice("x", F.lit(1), F.size("x") - _least(F.size("x"), F.lit(False), percent) + 1)
    return of.select("iid", "m", F.explode(F.array_distinct(F.transform(some, lambda x: x["s"]))).alias("s"))


def surroundings(docs: DataFrame, rarest: DataFrame) -> DataFrame:
    """(k, h, iid, m, nd, at, part): for texts ``docs(k, h, w)`` of nd words, the words from ``at`` on in which windows of m words around an anchor lie.

    Starts are taken in blocks as long as the item, so a row holds two items' words at most. While the items are few enough
    to be broadcast, no text is shuffled, however many hold an anchor.
    """
    rarest, few = _small(rarest)
    if few:
        near = docs.select("k", "h", "w", F.posexplode(_hashes(F.col("w"), SHINGLE)).alias("pos", "s")).join(rarest, "s")
    else:
        anchors = _saved(docs.select("k", "h", F.posexplode(_hashes(F.col("w"), SHINGLE)).alias("pos", "s")).join(rarest, "s"), "anchors")
        words = _with(docs, anchors.select("k", "h").distinct().withColumn("hit", F.lit(1)), "hit").drop("hit").dropDuplicates(["k", "h"])
        near = _with(anchors, words, "w")
    # a window holds the shingle if it begins at most m - SHINGLE words before
    first, last = F.floor(F.greatest(F.col("pos") - F.col("m") + SHINGLE, F.lit(0)) / F.col("m")), F.floor(F.col("pos") / F.col("m"))
    near = near.select("k", "h", "iid", "m", "w", F.explode(F.array_distinct(F.array(first, last))).alias("base")).withColumn("at", (F.col("base") * F.col("m")).cast("int"))
    near = near.select("k", "h", "iid", "m", F.size("w").alias("nd"), "at", F.slice("w", F.col("at") + 1, 2 * F.col("m")).alias("part"))
    return near.groupBy("k", "h", "iid", "m", "nd", "at").agg(F.first("part").alias("part"))


def windows(near: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """(k, h, iid, at, start, fp): windows of the item's size in ``near`` that share places enough with the item, and their SimHash.

    Of windows that the text's end cuts short, what is there counts.
    """
    def hashes(w: Column) -> Column:
        def at(i: Column) -> Column:
            shingle = F.when(i + SHINGLE <= F.size(w), F.xxhash64(*(F.get(w, i + j) for j in range(SHINGLE))))
            return F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1)).alias("f"), shingle.alias("s"))

        return F.when(F.size(w) >= 2, F.transform(F.sequence(F.lit(0), F.size(w) - 2), at))

    both = _let(F.col("part"), hashes)
    rows = near.select("k", "h", "iid", "m", "nd", "at", F.posexplode(both).alias("i", "x")).select("k", "h", "iid", "m", "nd", "at", "i", F.col("x.f").alias("f"), F.col("x.s").alias("s"))
    mine, _ = _small(_item_shingles(items).withColumn("a", F.lit(1)))
    rows = rows.join(mine, ["iid", "s"], "left").withColumn("a", F.coalesce("a", F.lit(0)))
    by = Window.partitionBy("k", "h", "iid", "at").orderBy("i")
    run = by.rowsBetween(Window.unboundedPreceding, 0)
    # a shingle begins at its first pair and ends with its fourth
    rows = rows.withColumn("b", F.coalesce(F.lag("a", SHINGLE - 2).over(by), F.lit(0)))
    sums = rows.select("k", "h", "iid", "m", "nd", "at", "i", *(F.sum(c).over(run).alias(f"l{j}") for j, c in enumerate(_lanes("f"))), F.sum("a").over(run).alias("a"), F.sum("b").over(run).alias("b"))
    # a window from s to e is the sum up to e less the sum before s
    whole, most = F.col("i") - F.col("m") + 2, F.least(F.col("i") - SHINGLE + 2, F.col("m") - 1)
    short = (F.col("at") + F.col("i") == F.col("nd") - 2) & (F.greatest(whole, F.lit(0)) <= most)
    ending = F.when(short, F.sequence(F.greatest(whole, F.lit(0)), most)).otherwise(F.array(whole))
    roles = F.concat(F.transform(ending, lambda s: F.struct(s.alias("s"), F.lit(1).alias("sign"))), F.array(F.struct((F.col("i") + 1).alias("s"), F.lit(-1).alias("sign"))))
    ev = sums.select("k", "h", "iid", "m", "nd", "at", *(f"l{j}" for j in range(LANE_BITS)), "a", "b", F.explode(roles).alias("x"))
    ev = ev.filter((F.col("x.s") >= 0) & (F.col("x.s") < F.col("m")))
    lanes = [F.sum(F.col(f"l{j}") * F.col("x.sign")).alias(f"l{j}") for j in range(LANE_BITS)]
    shared = F.sum(F.when(F.col("x.sign") > 0, F.col("b")).otherwise(-F.col("a"))).alias("c")
    out = ev.groupBy("k", "h", "iid", "m", "nd", "at", F.col("x.s").alias("s")).agg(*lanes, shared, F.max("x.sign").alias("ended")).filter("ended = 1")
    out = out.withColumn("start", F.col("at") + F.col("s"))
    whole = F.col("start") + F.col("m") <= F.col("nd")
    out = out.filter(F.col("c") >= _least(F.col("m") - SHINGLE + 1, whole, percent))
    n = F.least(F.col("m"), F.col("nd") - F.col("start")) - 1
    return out.select("k", "h", "iid", "at", "start", _simhash([F.col(f"l{j}") for j in range(LANE_BITS)], n).alias("fp"))


def _item_shingles(items: DataFrame) -> DataFrame:
    return items.select("iid", F.explode(F.array_distinct(_hashes(F.col("iw"), SHINGLE))).alias("s"))


def _small(table: DataFrame) -> tuple[DataFrame, bool]:
    """A written table of the items, marked for broadcast if its rows are few enough, and whether they are."""
    table = _saved(table, "items")
    few = table.count() * ROW_BYTES <= BROADCAST_BYTES
    return (F.broadcast(table) if few else table), few


def _repeats(words: Column) -> Column:
    """More than half the root of the pairs are repeats."""
    return _let(_hashes(words, 2), lambda f: (F.size(f) - F.size(F.array_distinct(f))) * 2 > F.sqrt(F.size(f)))


def contaminated(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", percent: int = 80) -> DataFrame:
    """(k, h, item_id, start, similarity, n_windows) for each text, by id and hash, and item that it holds; start is the best window's first word."""
    items = benchmark.select(F.col(item_key).cast("long").alias("item_id"), _words(F.col(item_text)).alias("iw")).distinct().filter(F.size("iw") >= SHINGLE)
    items = _saved(items.withColumn("iid", F.xxhash64("item_id", "iw")), "items")
    docs = _keyed(df, key, text).select("k", "h", _words(F.col("t")).alias("w"))
    known, _ = _small(_item_shingles(items).select("s").distinct())
    often = docs.select(F.explode(_hashes(F.col("w"), SHINGLE)).alias("s")).join(known, "s", "left_semi").groupBy("s").agg(F.count("*").alias("f"))
    near = _saved(surroundings(docs, _rarest(items, often, percent)), "near")
    seen = _saved(windows(near, items, percent), "windows")
    index, _ = _small(block_index(item_fingerprints(items)))
    found = seen.select("*", F.explode(_blocks("fp")).alias("b")).select("k", "h", "iid", "start", "fp", F.col("b.block").alias("block"), F.col("b.v").alias("v"))
    found = found.join(index, ["iid", "block", "v"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= RADIUS)
    found = found.groupBy("k", "h", "iid", "start").agg(F.lit(True).alias("near"))
    same = lambda *names: [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in names]
    pairs = seen.alias("x").join(found.alias("y"), same("k", "h", "iid", "start"), "left").select("x.k", "x.h", "x.iid", "x.at", "x.start", F.col("y.near").isNotNull().alias("near"))

    full = pairs.alias("x").join(near.alias("y"), same("k", "h", "iid", "at")).select("x.*", F.slice("y.part", F.col("x.start") - F.col("x.at") + 1, F.col("y.m")).alias("v"))
    # an item may stand in very many texts
    full = spread_join(full, items.select("iid", "item_id", "iw"), ["iid"], seen.groupBy("iid").agg(F.count("*").alias("n")))
    full = full.filter(F.col("near") | (F.size("iw") > LONGEST) | _repeats(F.col("iw")) | _repeats(F.col("v")))
    both = full.withColumn("a", _counted(_shingles(F.col("v")))).withColumn("b", _counted(_shingles(F.col("iw"))))
    both = both.select("k", "h", "item_id", "start", F.size(F.array_intersect("a", "b")).alias("i"), F.size("a").alias("na"), F.size("b").alias("nb"))
    good = both.filter(F.col("i") * 100 >= (F.col("na") + F.col("nb") - F.col("i")) * percent).withColumn("similarity", F.col("i") / (F.col("na") + F.col("nb") - F.col("i")))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s")))
    out = good.groupBy("k", "h", "item_id").agg(best.alias("m"), F.count("*").alias("n_windows"))
    return out.select("k", "h", "item_id", (-F.col("m.s")).cast("int").alias("start"), F.col("m.similarity").alias("similarity"), "n_windows")


def decontaminate(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``df`` whose text holds no item, with the columns they had."""
    bad = contaminated(df, benchmark, key, text).select("k", "h").distinct()
    bad = bad.select(F.col("k").alias("__k"), F.col("h").alias("__h"))
    return df.join(bad, (F.xxhash64(df[text]) == F.col("__h")) & df[key].cast("long").eqNullSafe(F.col("__k")), "left_anti")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: items of ``benchmark`` that texts of ``documents`` hold."""
    found = contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("k").alias("doc_id"), "item_id", "start", "similarity", "n_windows")
