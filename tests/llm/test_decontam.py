"""Decontamination: the query against a brute-force version, and long runs of equal words."""

import hashlib
import re
import time

import numpy as np
import pytest

from eventlens.llm import decontam, queries
from tests.conftest import SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - window + 1, min(len(w), 1))):
            wins.setdefault(tuple(w[i : i + window]), set()).add(item)
    sizes = {len(k) for k in wins}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                key = tuple(w[i : i + n])
                if key in wins:
                    hit.update(range(i, i + n))
                    found |= wins[key]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = queries.QUERIES["op9_decontamination"](spark, sf_dir).collect()
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == brute(docs, items)


def test_longest_match_by_brute_force(rng):
    letters = ["a", "b", "a", "c"]
    for _ in range(60):
        items = [(f"i{k}", " ".join(rng.choice(letters) for _ in range(rng.randrange(0, 14)))) for k in range(5)]
        texts = [" ".join(rng.choice([*letters, "zz"]) for _ in range(rng.randrange(0, 40))) for _ in range(4)]
        got = decontam._scan(texts, decontam.Windows(items, 4), [None] * 4)
        for text, found in zip(texts, got, strict=True):
            w, best = text.split(), 0
            for _, item in items:
                t = item.split()
                for i in range(len(w)):
                    for j in range(len(t)):
                        n = 0
                        while i + n < len(w) and j + n < len(t) and w[i + n] == t[j + n]:
                            n += 1
                        if n >= 4 or (n == len(t) and len(t) < 4):
                            best = max(best, n)
            assert (found["longest"]["n_words"] if found["longest"] else 0) == best


def test_equal_words_cost_their_number():
    w = decontam.Windows([("i", "der " * 200)], 10)
    start = time.time()
    found = decontam._scan(["Der " * 50_000], w, [None])[0]
    assert found["hits"] == [0, 50_000] and found["longest"]["n_words"] == 200
    assert time.time() - start < 10


def test_blocks_are_written_and_agree(spark, documents):
    texts = ["one two three four five", None, "", "x one two three y", "four five six"]
    bench = spark.createDataFrame([(f"b{k}", t) for k, t in enumerate(["one two three", "four five six seven", None, "x"])], "item_id string, text string")
    rows = lambda df: sorted((str(r.asDict(recursive=True)) for r in df.collect()))
    one = decontam.matches(documents(texts), bench, window=3)
    many = decontam.matches(documents(texts), bench, window=3, block_bytes=20)
    assert rows(one.drop("longest")) == rows(many.drop("longest"))
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert np.array_equal(sorted(decontam.matches(documents(texts).limit(0), bench).collect()), [])
