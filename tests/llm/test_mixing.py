"""Source mixing: targets by the stated rounds, knapsack against enumeration, sums near targets."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.llm import mixing, queries
from tests.conftest import SMALL


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        left, among = sum(sizes.values()) - sum(capped.values()), sum(w[s] for s in names if s not in capped)
        share = {s: left * w[s] / among for s in names if s not in capped}
        over = [s for s in share if share[s] > cap * sizes[s]]
        if not over:
            return {**share, **capped}
        capped |= {s: cap * sizes[s] for s in over}


def test_reach_is_nearest():
    rng = np.random.default_rng(0)
    for _ in range(150):
        sizes = np.unique(rng.integers(1, 30, rng.integers(1, 5)))
        counts = rng.integers(0, 4, len(sizes))
        goal = int(rng.integers(0, 130))
        got = mixing.reach(sizes, counts, goal)
        assert (got <= counts).all() and (got >= 0).all()
        sums = [int(np.dot(sizes, c)) for c in itertools.product(*(range(c + 1) for c in counts))]
        assert abs(int(np.dot(sizes, got)) - goal) == min(abs(s - goal) for s in sums)


def test_fit_closes_large_budgets_exactly(monkeypatch):
    monkeypatch.setattr(mixing, "SPACE", 2_000)
    rng = np.random.default_rng(1)
    for _ in range(40):
        sizes = np.unique(np.concatenate([[1, 2, 3], rng.integers(1, 5000, 60)]))
        counts = rng.integers(1, 400, len(sizes))
        total = int(np.dot(sizes, counts))
        budget = int(rng.integers(0, total))
        got = mixing.fit(sizes, counts, budget)
        assert (got <= counts).all() and (got >= 0).all()
        assert abs(int(np.dot(sizes, got)) - budget) <= 2
        big = sizes > 2000  # proportions hold for all but the knapsack's lengths
        assert (np.abs(got[big] - counts[big] * (budget / total)) <= 2).all()
    assert mixing.fit(np.array([5_000_000]), np.array([1]), 4_900_000).tolist() == [1]


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text").collect()
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    source, per = {r.doc_id: r.source for r in docs}, Counter()
    for r in docs:
        per[r.source] += size[r.doc_id]
    want = brute_targets(per)
    got = queries.QUERIES["op11_mixing"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(size)
    sums, again = Counter(), defaultdict(set)
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == size[r.doc_id] and r.source_size == per[s] and r.target == pytest.approx(want[s], rel=1e-12)
        assert r.taken in {r["size"] * k for k in range(4)}
        sums[s] += r.taken
        again[s].add(r.taken // r["size"] if r["size"] else None)
    for s, own in per.items():  # no subset of the source's documents on top of the whole copies is nearer
        full = min(int(round(want[s], 6) // own), 3)
        met, goal = 1, round(want[s]) - full * own
        for d in size:
            if source[d] == s and full < 3:
                met |= met << size[d]
        nearest = min(abs(k - goal) for k in range(met.bit_length()) if met >> k & 1)
        assert abs(sums[s] - round(want[s])) == nearest
    assert all(len(k - {None}) <= 2 for k in again.values())
    assert sorted(map(tuple, queries.QUERIES["op11_mixing"](spark, sf_dir).collect())) == sorted(map(tuple, got))


def test_edge_rows(spark, rng, monkeypatch):
    monkeypatch.setattr(mixing, "HOT_GROUPS", 4)
    rows = [(i, "w " * rng.choice([1, 2, 7, 7, 7, 40]), rng.choice(["a", "a", "a", "b", "", None]), "z") for i in range(400)]
    rows += [rows[0], rows[0], (None, "x y", "b", "z"), (1000, None, "empty", "z"), (1001, "", "empty", "z"), (1002, "   ", "\U0001f600", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    out = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    per = Counter()
    for _, t, s, _ in rows:
        per[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want, sums = brute_targets(per), Counter()
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == per[r.source] and 0 <= r.copies <= 3
        sums[r.source] += r["size"] * r.copies
    assert {s: sums[s] - want[s] for s in per if abs(sums[s] - want[s]) > 2} == {}
    assert mixing.mix(docs.limit(0)).count() == 0
    one = mixing.mix(docs.where(F.col("source") == "empty")).collect()
    assert all(r.target == 0 and r["size"] == 0 for r in one)
