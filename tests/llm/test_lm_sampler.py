"""The language model's tables against all seatings there are, and against a sampler that moves one customer at a time."""

import itertools

import numpy as np
import pandas as pd
import pytest

from vendora.llm import lm
from vendora.llm.text import U, mix


def partitions(n):
    """Sizes of the tables of every seating of n customers, one after another."""
    out = [[1]]
    for _ in range(n - 1):
        out = [p[:i] + [p[i] + 1] + p[i + 1 :] for p in out for i in range(len(p))] + [[*p, 1] for p in out]
    return out


@pytest.mark.parametrize("customers", [2, 5, 7])
def test_all_seatings(customers):
    strength, d, others, above, total = 1.5, 0.4, 3, 2.0, 20.0
    weight = np.zeros(customers + 1)
    for sizes in partitions(customers):
        w = np.prod([np.prod([i - d for i in range(1, n)]) for n in sizes])
        for t in range(len(sizes)):
            w *= (strength + d * (others + t)) * (above + t) / (total + t)
        weight[len(sizes)] += w
    n = 40_000
    t = lm.seat(np.full(n, customers), np.full(n, others), strength, d, np.full(n, above), total, mix(np.arange(n).astype(U) + U(9)), 1 << 32)
    assert np.abs(np.bincount(t, minlength=customers + 1) / n - weight / weight.sum()).max() < 0.01


def test_many_customers(monkeypatch):
    """The saddle point against exact weights, for few and for many tables."""
    name = mix(np.arange(4000).astype(U) + U(5))
    for others, above, total, d, feeds in ((50, 2.0, 100.0, 0.6, 1), (2000, 40.0, 1000.0, 0.7, 1), (5, 0.3, 1.0, 0.4, 0)):
        drawn = []
        for exact in (256, 700):
            with monkeypatch.context() as m:
                m.setattr(lm, "EXACT", exact)
                lm._ways.cache_clear()
                drawn.append(lm.seat(np.full(4000, 600), np.full(4000, others), 1.0, d, np.full(4000, above), total, name, 7 << 32, feeds))
        lm._ways.cache_clear()
        a, b = drawn
        assert abs(a.mean() / b.mean() - 1) < 0.03 and abs(a.std() / b.std() - 1) < 0.1
    alone = lm.seat(np.array([0, 1, 10**9]), np.zeros(3), 1.0, 0.5, np.full(3, 0.01), 1.0, name[:3], 1, 0)
    assert alone[:2].tolist() == [0, 1] and 1 <= alone[2] < 10**6


COUNTS = np.array([[9, 1, 0, 3, 0], [2, 5, 1, 0, 1], [0, 0, 1, 30, 2]])
BASE = np.array([0.4, 0.3, 0.1, 0.1, 0.1])
STRENGTH, D0, D1 = 1.0, 0.6, 0.4


def one_by_one(sweeps, rng):
    """Gibbs: every customer in turn leaves its table, and its table's customer in the parent with it if it was the last, and sits down again."""
    k, w = COUNTS.shape
    rooms, parent = [[[] for _ in range(w)] for _ in range(k)], [[] for _ in range(w)]
    everyone = [(i, j) for i, j in itertools.product(range(k), range(w)) for _ in range(COUNTS[i, j])]

    def tables(room):
        return sum(map(len, room))

    def above(j):
        return (sum(parent[j]) - D1 * len(parent[j]) + (STRENGTH + D1 * tables(parent)) * BASE[j]) / (STRENGTH + sum(map(sum, parent)))

    def sit(room, j, d, p):
        weights = np.array([*(n - d for n in room[j]), (STRENGTH + d * tables(room)) * p])
        at = rng.choice(len(weights), p=weights / weights.sum())
        if at < len(room[j]):
            room[j][at] += 1
            return False
        room[j].append(1)
        return True

    def leave(room, j):
        at = rng.choice(len(room[j]), p=np.array(room[j]) / sum(room[j]))
        room[j][at] -= 1
        return room[j][at] == 0 and (room[j].pop(at) == 0)

    total = np.zeros(COUNTS.shape)
    for i, j in everyone:
        if sit(rooms[i], j, D0, above(j)):
            sit(parent, j, D1, BASE[j])
    for s in range(sweeps + 50):
        for i, j in everyone:
            if leave(rooms[i], j):
                leave(parent, j)
            if sit(rooms[i], j, D0, above(j)):
                sit(parent, j, D1, BASE[j])
        if s >= 50:
            p = np.array([above(j) for j in range(w)])
            for i in range(k):
                own = np.array([len(x) for x in rooms[i]])
                total[i] += (COUNTS[i] - D0 * own + (STRENGTH + D0 * own.sum()) * p) / (STRENGTH + COUNTS[i].sum())
    return total / sweeps


def all_at_once(sweeps):
    k, w = np.nonzero(COUNTS)
    c, s, t = COUNTS[k, w], np.ones(len(k), np.int64), np.ones(len(BASE), np.int64)
    names, total, n = mix(np.arange(len(BASE)).astype(U) + U(99)), np.zeros(COUNTS.shape), len(COUNTS)
    for j in range(sweeps + 50):
        st = lm.State(np.append(np.bincount(k, c, n), s.sum()), np.append(np.bincount(k, s, n), t.sum()), np.full(n + 1, STRENGTH), (D0, D1), None)
        if j >= 50:
            u = st.unigram(np.bincount(w, s, len(BASE)), t, BASE)
            own = np.zeros(COUNTS.shape)
            own[k, w] = s
            for i in range(n):
                total[i] += st.in_context(i, COUNTS[i], own[i], u)
        s, t = lm.reseat(w, k, c, s, t, names, BASE, st, (j + 1) << 32)
    return total / sweeps


def test_predictions_of_a_sequential_sampler():
    a, b = one_by_one(600, np.random.default_rng(1)), all_at_once(3000)
    assert np.allclose(b.sum(1), 1) and np.abs(b / a - 1).max() < 0.1 and np.abs(b - a).max() < 0.015


def test_rare_previous_words_have_restaurants(spark):
    """Words that follow one rare word each, at less than one in 1,000 tokens: before, rare words shared a restaurant, and every partner was as likely after each of them."""
    rng = np.random.default_rng(3)
    filler = [" ".join(f"f{i}" for i in rng.integers(0, 40, 400)) for _ in range(50)]
    rows = [(i, t) for i, t in enumerate(filler)] + [(100 + 10 * i + j, f"f1 rare{i} partner{i} f{j}") for i in range(4) for j in range(4)]
    model = lm.train(spark.createDataFrame(rows, "doc_id long, text string"))
    asked = [(i, f"rare0 partner{i}") for i in range(4)] + [(10, "nowhere partner0"), (11, "rare0 nowhere"), (12, "nowhere nowhere"), (13, "partner0")]
    got = {r["doc_id"]: r for r in lm.score(spark.createDataFrame([(*a, True) for a in asked], "doc_id long, text string, held_out boolean"), model).collect()}
    assert all(got[0]["score"] > got[i]["score"] + 1 for i in (1, 2, 3))
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got.values()) and [got[i]["n_known"] for i in (0, 10, 11, 12)] == [3, 2, 2, 1]
    # the end after a partner is as likely in each of these, so that rare0 leaves less than all to its own partner
    assert got[0]["score"] < got[13]["score"]


def test_shared_strength():
    """Restaurants of 100 customers with many tables ask for a larger strength than with few."""
    f = lambda x, m: pd.DataFrame({"x": [x], "m": [m]})
    many, few = (lm.shared_strength(1.0, 0.5, f(100, 50), f(t, 50)) for t in (60, 3))
    assert many > 2 * few > 0 and np.isclose(lm._digamma(1.0), -0.5772156649015329) and np.isclose(lm._digamma(10.5), 2.3030010334)


def test_pairs_in_shards_of_packed_arrays(spark, monkeypatch):
    """Many shards score as one does, and pairs take few bytes: before, each was a row that sorts and joins moved in every sweep."""
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 5000), i % 5 == 2) for i in range(60)] + [(60, None, False), (None, "w1 w2", False)]
    d = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    got = []
    for size in (1 << 30, 4000):
        monkeypatch.setattr(lm, "SHARD_BYTES", size)
        corpus = lm.gather(d, ~lm.F.col("held_out") & lm.F.col("doc_id").isNotNull(), key="doc_id", held_out="held_out")
        got.append({r["doc_id"]: r for r in lm.judge(corpus, lm.fit(corpus)).collect()})
    one, many = got
    assert len(one) == len(many) == len(rows) and corpus.shards > 3
    for k in one:
        assert one[k][:5] == many[k][:5] and np.isclose(one[k]["base_score"], many[k]["base_score"], rtol=1e-9) and np.isclose(one[k]["score"], many[k]["score"], rtol=1e-4)
    x = np.sort(rng.integers(0, 1 << 20, 10_000))
    assert (lm._unpack(lm._pack(x, True), ascending=True) == x).all() and len(lm._pack(x, True)) < 2 * len(x) and len(lm._unpack(lm._pack(x[:0]))) == 0
