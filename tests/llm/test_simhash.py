import numpy as np
import pytest
import xxhash

from eventlens.llm import components, queries, simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=4):
    ids = sorted(prints)
    least = {}
    for i in ids:
        if i in least:
            continue
        least[i], todo = i, [i]
        while todo:
            u = todo.pop()
            for v in ids:
                if v not in least and (prints[u] ^ prints[v]).bit_count() <= bits:
                    least[v] = i
                    todo.append(v)
    return least


@pytest.mark.parametrize("bits", range(6))
def test_anchors_lose_no_pair(bits):
    rng = np.random.default_rng(bits)
    values = set()
    for base in rng.integers(0, 2**63, 25).tolist():
        for _ in range(5):
            v = base * 2
            for k in rng.choice(64, rng.integers(0, bits + 3), replace=False):
                v ^= 1 << int(k)
            values.add(v)
    fp = np.array(sorted(values), np.uint64)
    homes, reached = {}, {}
    for block, rows, anchor, home in simhash._anchors(fp, bits):
        for r, a, h in zip(rows.tolist(), anchor.tolist(), home.tolist(), strict=True):
            reached.setdefault((block, a), set()).add(r)
            if h:
                homes.setdefault((block, a), set()).add(r)
    met = {(min(h, r), max(h, r)) for a, hs in homes.items() for h in hs for r in reached[a] if h != r}
    near = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if int(fp[i] ^ fp[j]).bit_count() <= bits}
    assert near <= met


@pytest.mark.parametrize("cells", [(4096, 16384, 100_000), (2, 3, 40)])
def test_query_equals_brute_force(spark, monkeypatch, cells):
    from tests.conftest import SMALL

    monkeypatch.setattr(simhash, "CELL_HOMES", cells[0])
    monkeypatch.setattr(simhash, "CELL_REACHED", cells[1])
    monkeypatch.setattr(simhash, "GROUP_ROWS", cells[2])
    prints = {r.doc_id: brute_print(r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    least = brute_components(prints)
    got = queries.QUERIES["op7_simhash"](spark, SMALL).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{p:016x}", least[i]) for i, p in prints.items()}


def test_nulls_repeats_and_one_of_each(spark, documents):
    docs = documents(["a b c d e f", None, "", "A b\tc d e f", "only three words", "x"])
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {(0, 0), (1, 1), (2, 1), (3, 0), (4, 4), (5, 5), (None, 5)}
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [0, 1, 4, 5]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_long_chain_of_links(spark):
    n = 70
    nodes = spark.createDataFrame([(i * 11 % 997, i + 5) for i in range(n)], "node long, label long")
    edges = spark.createDataFrame([(i * 11 % 997, (i + 1) * 11 % 997) for i in range(n - 1)], "a long, b long")
    got = components.smallest_reachable(edges, nodes).collect()
    assert len(got) == n and {r.label for r in got} == {5}


def test_labels_may_be_null_or_repeat(spark):
    nodes = spark.createDataFrame([(1, 9), (2, None), (3, 4), (4, 9), (5, 9), (6, None), (7, None)], "node long, label long")
    edges = spark.createDataFrame([(3, 2), (2, 1), (4, 5), (6, 7)], "a long, b long")
    got = sorted(components.smallest_reachable(edges, nodes).collect())
    assert got == [(1, 4), (2, 4), (3, 4), (4, 9), (5, 9), (6, None), (7, None)]
