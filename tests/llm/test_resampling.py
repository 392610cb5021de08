"""Importance resampling against a brute-force version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from eventlens.llm import queries, resampling
from tests.conftest import SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, Counter(
        zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)
    )


def brute(docs, target):
    met = [(k, *features(t)) for k, t in docs]
    s, t = sum((c for *_, c in met), Counter()), sum((features(x)[1] for x in target), Counter())
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows, able = [], []
    for k, words, c in met:
        w = sum(gain[b] * n for b, n in c.items())
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        rows.append([k, sum(c.values()), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if len(words) >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0]))
    for i, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, rows), key=str)


def collected(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert collected(queries.QUERIES["op13_resampling"](spark, sf_dir)) == brute(docs, target)


def test_edge_texts(spark, documents, rng, monkeypatch):
    monkeypatch.setattr(resampling, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(resampling, "TEXT_BYTES", 300)
    texts = ["a b a b a b a b", None, "", "  ,. ", "ÀÉ É x\u0000y ß中文 z", "Z" * 5000 + " q " + "é" * 3000, "tail", "!x"]
    texts += [" ".join(rng.choice(["aa", "b", "Cc", "9", "é"]) for _ in range(rng.randrange(60))) for _ in range(80)]
    target = spark.createDataFrame([("aa b cc",), (None,)], "text string")
    rows = [(r.doc_id, r.text) for r in documents(texts).collect()]
    assert collected(resampling.resample(documents(texts), target, key="doc_id")) == brute(rows, ["aa b cc", None])
    none = target.limit(0)
    assert collected(resampling.resample(documents(texts), none)) == brute(rows, [])
    assert resampling.resample(documents(texts).limit(0), target).count() == 0


def test_gain_planes_add_up_to_the_gains():
    gain = np.array([0, 5, -5, 4096, -1, 7, -9000] + [0] * 9993)
    back = sum(p * np.unpackbits(plane, bitorder="little").astype(np.int64) for p, plane in resampling.gain_planes(gain))
    assert (back == gain).all()
