"""Streams with state, keyed tables and pointers: late, repeated and restarted input, runs that stop half-way."""

import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from vendora.operators import changes, market
from vendora.sources import pointer, publish
from vendora.sources.keyed import KeyedTable
from vendora.streaming import stateful
from vendora.streaming.incremental import drain, latest

EVENTS = "k long, ts timestamp, event_id long, v long"
LATEST = "k long, ts timestamp, v long, seen long"


def events(spark, ids):
    i = F.col("id")
    return spark.createDataFrame([(x,) for x in ids], "id long").select((i % 7).alias("k"), F.timestamp_seconds(i * 17 % 50).alias("ts"), i.alias("event_id"), (i * 2).alias("v"))


def add(df, folder):
    df.coalesce(1).write.mode("append").parquet(folder)


def schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def table(spark, root, ddl, key, buckets=4):
    return KeyedTable(spark, str(root), schema(spark, ddl), key, buckets)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_history_equals_batch(spark, tmp_path):
    """Late rows in any order, rows that come again in the same and in later runs, three runs on one checkpoint."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    ids = list(range(60))
    random.Random(1).shuffle(ids)
    done = []
    for some in (ids[:20], ids[10:40] + ids[:5], ids):
        add(events(spark, some), source)
        add(events(spark, some[:3]), source)
        done.append(stateful.append_once(spark, source, schema(spark, EVENTS), ["k", "ts", "v"], out, str(tmp_path / "ck"), per_batch=1, partitions=2))
    want = rows(events(spark, range(60)).select("k", "ts", "v").distinct())
    assert rows(spark.read.parquet(out).select("k", "ts", "v")) == want
    assert [d["batches"] for d in done] == [2, 2, 2] and sum(d["rows_late"] for d in done) == 0
    # nothing new, nothing done
    assert stateful.append_once(spark, source, schema(spark, EVENTS), ["k", "ts", "v"], out, str(tmp_path / "ck"), per_batch=1, partitions=2)["rows_in"] == 0


def test_history_with_a_watermark(spark, tmp_path):
    """Repeats within the delay are found, in a later run too; what comes behind the watermark is counted."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda *pairs: spark.createDataFrame(list(pairs), "u int, s int").select("u", F.timestamp_seconds("s").alias("ts"))
    run = lambda: stateful.append_once(spark, source, schema(spark, "u int, ts timestamp"), ["u"], out, str(tmp_path / "ck"), "ts", "100 seconds", 1, 2)
    add(at((1, 1000), (1, 1001), (2, 1010)), source)
    first = run()
    add(at((2, 950), (3, 940), (1, 1050)), source)  # late, but within the delay
    second = run()
    add(at((4, 5000)), source)
    run()
    add(at((5, 1000), (6, 5001)), source)
    last = run()
    assert (first["rows_late"], second["rows_late"], last["rows_late"]) == (0, 0, 1)
    assert sorted(r["u"] for r in spark.read.parquet(out).collect()) == [1, 2, 3, 4, 6]


def test_latest_equals_batch(spark, tmp_path):
    source, kept = str(tmp_path / "in"), table(spark, tmp_path / "t", LATEST, ["k"])
    ids = list(range(300))
    random.Random(2).shuffle(ids)
    seen = []
    for i, some in enumerate((ids[:150], ids[150:290], [x for x in ids[290:] if x % 7 in (1, 3)])):
        add(events(spark, some), source)
        done = stateful.keep_latest(spark, source, schema(spark, EVENTS), ["k"], "ts", "event_id", ["v"], kept, str(tmp_path / "ck"), per_batch=1, partitions=2)
        seen += some
        assert rows(kept.read()) == rows(latest(events(spark, seen), ["k"], "ts", "event_id", ["v"]))
        assert (done["batches"], done["rows_updated"]) == (1, len({x % 7 for x in some}))  # a batch hands on the keys it has
        assert spark.read.parquet(f"{kept.root}/batch").count() == len({x % 7 for x in some})
        assert i == 0 or done["rows_in"] == len(some)


def reject_rows(spark, *found):
    return spark.createDataFrame(list(found), "record_key string, reason_code string, ok boolean, s int").select("record_key", "reason_code", "ok", F.timestamp_seconds("s").alias("at"))


def fold(found):
    """The same by hand, event by event."""
    out, count = {}, {}
    for key, reason, ok, s in sorted(found, key=lambda e: (e[3], e[2])):
        n = count.get((key, reason), 0)
        is_open = n and out[key, reason, n][1] is None
        if ok and is_open:
            out[key, reason, n][1] = s
        elif not ok and not is_open:
            count[key, reason] = n + 1
            out[key, reason, n + 1] = [s, None]
    return sorted(((*k, *v) for k, v in out.items()), key=str)


def test_rejects_open_resolve_and_come_back(spark, tmp_path):
    source, kept = str(tmp_path / "in"), table(spark, tmp_path / "t", stateful.REJECTS, ["record_key"])
    rng, found = random.Random(3), []
    for i in range(3):
        part = [(f"r{rng.randrange(6)}", f"c{rng.randrange(2)}", rng.random() < 0.5, 100 * i + s) for s in rng.sample(range(100), 25)] + [("same", "c", ok, 100 * i) for ok in (True, False)]
        found += part
        add(reject_rows(spark, *part), source)
        stateful.follow_rejects(spark, source, schema(spark, "record_key string, reason_code string, ok boolean, at timestamp"), kept, str(tmp_path / "ck"), partitions=2)
        s = lambda c: F.unix_seconds(c).cast("int")
        got = rows(kept.read().select("record_key", "reason_code", "occurrence", s("opened_at"), s("resolved_at")))
        assert got == fold(found)
    assert any(r[2] > 1 for r in got) and any(r[4] is None for r in got)
    # a batch that is run again changes nothing
    again = reject_rows(spark, ("same", "c", False, 5), ("new", "c", False, 5))
    assert kept.merge(again, stateful.reject_step, (str(tmp_path / "ck"), 2)) == [] and kept.read().count() == len(got)


def files(root):
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(root) for n in names if n.startswith("part-")}


def test_merge_touches_its_buckets_only(spark, tmp_path):
    kept = table(spark, tmp_path / "t", "k long, v string", ["k"], 16)
    base = spark.range(400).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    assert len(kept.merge(base, lambda old, new: old.unionByName(new))) == 16
    before = files(tmp_path / "t")
    batch = spark.createDataFrame([(7, "x", 1), (7, "y", 2), (1000, "z", 1)], "k long, v string, seq int")
    step = lambda old, new: changes.upsert(old, new, ["k"], [F.desc("seq")])
    touched = kept.merge(batch, step)
    after = files(tmp_path / "t")
    assert 1 <= len(touched) <= 2 and before.items() <= after.items() and len(after) - len(before) == len(touched)
    assert rows(kept.read()) == rows(changes.upsert(base, batch, ["k"], [F.desc("seq")]))
    only = kept.read(touched)
    assert {r["v"] for r in only.collect()} == {"a", "y", "z"} and len(only.inputFiles()) == len(touched)
    kept.merge(batch, step)
    assert rows(kept.read()) == rows(changes.upsert(base, batch, ["k"], [F.desc("seq")]))
    kept.prune()
    assert rows(kept.read()) == rows(changes.upsert(base, batch, ["k"], [F.desc("seq")])) and len(files(tmp_path / "t")) == 16
    with pytest.raises(ValueError, match="buckets"):
        table(spark, tmp_path / "t", "k long, v string", ["k"], 8).read()


def test_children_of_touched_parents(spark, tmp_path):
    kept = table(spark, tmp_path / "t", "parent long, child long", ["parent"])
    base = spark.createDataFrame([(p, c) for p in range(20) for c in range(3)], "parent long, child long")
    kept.merge(base, lambda old, new: old.unionByName(new))
    batch = spark.createDataFrame([(3, 9), (3, 10), (50, 1), (4, None)], "parent long, child long")  # 4 is left without children
    step = lambda old, new: changes.replace_children(old, new.filter("child IS NOT NULL"), "parent", new)
    kept.merge(batch, step)
    assert rows(kept.read()) == rows(changes.replace_children(base, batch.filter("child IS NOT NULL"), "parent", batch))
    # a bucket that a merge leaves empty has no files
    one = table(spark, tmp_path / "u", "parent long, child long", ["parent"], 1)
    one.merge(base, lambda old, new: new)
    one.merge(base, lambda old, new: old.limit(0))
    assert one.read().count() == 0
    assert one.merge(base.limit(0), lambda old, new: new) == []


def test_merge_that_stops_changes_nothing(spark, tmp_path, monkeypatch):
    kept = table(spark, tmp_path / "t", "k long, v string", ["k"])
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    kept.merge(base, lambda old, new: new)
    batch = spark.createDataFrame([(2, "c", 1)], "k long, v string, seq int")
    step = lambda old, new: changes.upsert(old, new, ["k"], [F.desc("seq")])

    def stop(*a):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(pointer, "put", stop)
        with pytest.raises(OSError, match="stopped"):
            kept.merge(batch, step, ("feed", 0))
    assert rows(kept.read()) == [(1, "a"), (2, "b")]
    kept.merge(batch, step, ("feed", 0))
    assert rows(kept.read()) == [(1, "a"), (2, "c")]


def test_readers_always_find_a_run(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    t = lambda n: {"catalog.products": spark.range(n)}
    publish.write_tables(t(1), root, "r0")
    found, stop, failed = set(), threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                found.add(pointer.get(spark, root)["run"])
            except Exception as e:
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 4):
        publish.write_tables(t(i + 1), root, f"r{i}")
    stop.set()
    reader.join()
    assert not failed and "r0" in found and publish.read_current(spark, root, "catalog.products").count() == 4

    def crash(*a):
        raise OSError("crash")

    with monkeypatch.context() as m:
        m.setattr(pointer, "put", crash)
        with pytest.raises(OSError, match="crash"):
            publish.write_tables(t(9), root, "r9")
    assert publish.read_current(spark, root, "catalog.products").count() == 4
    # a draft that was never renamed is no pointer
    (tmp_path / "out" / pointer.FOLDER / ".draft").write_text("{")
    assert pointer.get(spark, root)["run"] == "r3" and pointer.numbers(spark, root) == [0, 1, 2, 3]
    assert pointer.get(spark, str(tmp_path / "none")) is None


def test_deep_pages(spark, tmp_path):
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 11 > 0, F.col("id") * 7919 % 1000).alias("price"), F.lit("x").alias("kind"))
    order = (F.col("price").desc_nulls_last(), F.col("id"))
    root = str(tmp_path / "pages")
    assert market.write_pages(df, order, root, rows=300) == 5000
    for limit, offset in ((25, 0), (100, 250), (1000, 4321), (50, 4980), (25, 5000), (25, -3)):
        want, _ = market.registry_page(df, ["id", "price", "kind"], {}, (), order=order, limit=limit, offset=offset)
        got = market.read_page(spark, root, limit, offset)
        assert [tuple(r)[:3] for r in got.select("id", "price", "kind").collect()] == [tuple(r) for r in want.collect()]
        assert len(got.inputFiles()) <= 4
    assert market.write_pages(df.limit(0), order, root) == 0 and market.read_page(spark, root).count() == 0


def test_drain_remembers_files(spark, tmp_path):
    add(events(spark, range(10)), str(tmp_path / "in"))
    seen = []
    for _ in range(2):
        drain(spark, str(tmp_path / "in"), schema(spark, EVENTS), str(tmp_path / "ck"), lambda b, i: seen.append((i, b.count())))
    assert seen == [(0, 10)]
