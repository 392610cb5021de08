"""Toxicity by a linear-chain conditional random field over the words of a text.

Fit (driver, on a bounded sample of labelled rows): words and word prefixes that
are far more frequent in toxic than in other documents (a G² test on document
counts) label the tokens of toxic documents; a two-label CRF learns weights of
word, prefix and suffix features, of the start and of the four label changes by
gradient ascent on the penalised likelihood.  A logistic curve fitted on the
same sample turns the marginals of a document into its score.

Score (Spark, whole texts): one forward and one backward pass over a document
give each word's probability of being toxic; the score combines their sum
and maximum; runs of words at 0.5 or more are the offending spans.  The chains of
many documents are worked off together in rows of fixed length, so a very long
text costs no more per word than a short one.

The sample: labelled rows up to ``max_docs`` documents and ``max_bytes`` bytes of
text in expectation (chosen by a hash of the id, so the choice is the same in
every run), half of each for each label.

Defined cases: a null or wordless text has no tokens and gets the score of
"no evidence"; repeated rows get equal scores; labels that are null are not used,
of several labels for one id the largest counts; with no labelled rows, or only
one label, every score is that label's share (0 with none).  Only the key
columns and the text are read.
"""

from __future__ import annotations

import dataclasses
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import sliced

MAX_DOCS, MAX_BYTES = 4_000, 4 << 20
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W\d_]+")
_ROW = 64
_KNOWN_WORDS = 150_000


def units(word: str) -> list[str]:
    """What may mark a word as toxic: itself, and its first four and five letters if it is longer."""
    w = word.lower()
    return [w, *(w[:k] + "*" for k in (4, 5) if len(w) > k)]


def features(word: str) -> list[str]:
    w = word.lower()
    return [*units(word), "*" + w[-3:]]


def marginals(emission: np.ndarray, first: np.ndarray, change: np.ndarray, start: np.ndarray):
    """(p, forward, backward, m): probability of label 1 for every token, and what it comes from.

    ``first`` has the place of each document's first token; all documents lie
    one after the other.  ``m[i][j]`` holds the weights of label i before and j
    at each token (at a first token the label before does not matter, so the
    documents stay apart); ``forward`` and ``backward`` are the odds of label 1
    from the left and from the right.  Rows of ``_ROW`` tokens are multiplied
    out side by side, a short loop over the row products gives the odds at the
    row ends, and a second sweep fills the rows.
    """
    n = len(emission)
    rows = -(-n // _ROW)
    w = np.exp(np.clip(emission, -30, 30))
    (t00, t01), (t10, t11) = np.exp(change)
    s0, s1 = np.exp(start)

    def grid(plain: np.ndarray | float, at_first: np.ndarray | float, pad: float) -> np.ndarray:
        out = np.full(rows * _ROW, pad)
        out[:n] = plain
        out[first] = at_first
        return np.ascontiguousarray(out.reshape(rows, _ROW).T)

    g00, g01 = grid(t00, s0, 1.0), grid(t01 * w, s1 * w[first], 0.0)
    g10, g11 = grid(t10, s0, 0.0), grid(t11 * w, s1 * w[first], 1.0)
    a, b, c, d = g00[0], g01[0], g10[0], g11[0]
    for k in range(1, _ROW):
        x, y, z, v = g00[k], g01[k], g10[k], g11[k]
        a, b, c, d = a * x + b * z, a * y + b * v, c * x + d * z, c * y + d * v
        scale = 1 / (a + b + c + d)
        a, b, c, d = a * scale, b * scale, c * scale, d * scale
    left, right = np.ones(rows), np.ones(rows)
    products = list(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True))
    odds = 1.0
    for k, (x, y, z, v) in enumerate(products):
        left[k] = odds
        odds = (y + odds * v) / (x + odds * z)
    odds = 1.0
    for k in range(rows - 1, -1, -1):
        right[k] = odds
        x, y, z, v = products[k]
        odds = (z + v * odds) / (x + y * odds)
    forward, backward = np.empty((_ROW, rows)), np.empty((_ROW, rows))
    for k in range(_ROW):
        left = (g01[k] + left * g11[k]) / (g00[k] + left * g10[k])
        forward[k] = left
    for k in range(_ROW - 1, -1, -1):
        backward[k] = right
        right = (g10[k] + g11[k] * right) / (g00[k] + g01[k] * right)
    forward, backward, *m = (x.T.reshape(-1)[:n] for x in (forward, backward, g00, g01, g10, g11))
    both = forward * backward
    return both / (1 + both), forward, backward, m


@dataclasses.dataclass
class Model:
    weights: dict[str, float]
    change: np.ndarray
    start: np.ndarray
    curve: np.ndarray  # of 1, log of expected toxic words, largest marginal

    def emission(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word)) + self.weights[""]

    def score(self, expected: np.ndarray, most: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence(expected, most) @ self.curve, -30, 30)))


def evidence(expected: np.ndarray, most: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(expected)), np.log(expected + 1e-3), most], axis=1)


def one_per_copy_group(words: list[list[str]]) -> np.ndarray:
    """Places of texts that share none of three min-hashes of word triples with an earlier text.

    Near copies of one toxic text would otherwise make all of its words look toxic.
    """
    taken: set[tuple[int, int]] = set()
    out = []
    for k, ws in enumerate(words):
        triples = {" ".join(ws[i : i + 3]).lower() for i in range(max(1, len(ws) - 2))}
        marks = {(seed, min(xxhash.xxh64_intdigest(t, seed) for t in triples)) for seed in (1, 2, 3)}
        if taken.isdisjoint(marks):
            out.append(k)
        taken |= marks
    return np.array(out, np.int64)


def toxic_units(docs: list[list[str]], labels: np.ndarray, least: float = 20.0) -> set[str]:
    """Units with a G² of at least ``least`` and eight times the share in toxic documents."""
    seen = [Counter(), Counter()]
    for words, y in zip(docs, labels, strict=True):
        seen[int(y)].update({u for w in set(words) for u in units(w)})
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    out = set()
    for u, a in seen[1].items():
        b = seen[0].get(u, 0)
        if a < 3 or a / n1 < 8 * b / n0:
            continue
        share = (a + b) / (n1 + n0)
        g2 = sum(2 * x * np.log(x / e) for x, e in ((a, n1 * share), (b, n0 * share)) if x)
        if g2 >= least:
            out.add(u)
    return out


def fit(docs: list[str | None], labels: np.ndarray, weights: np.ndarray, steps: int = 40, penalty: float = 1e-3) -> Model:
    """Model of the given labelled texts; ``weights`` stand for the rows that a text speaks for."""
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.0  # of all rows, copies too
    base = np.log(np.clip(share, 1e-13, 1 - 1e-13) / np.clip(1 - share, 1e-13, 1))
    words = [_WORD.findall(t) if t else [] for t in docs]
    alone = one_per_copy_group(words)
    words, labels, weights = [words[k] for k in alone], labels[alone], weights[alone]
    marks = toxic_units(words, labels) if 0 < labels.sum() < len(labels) else set()
    if not marks:
        return Model({"": -10.0}, np.zeros((2, 2)), np.zeros(2), np.array([base, 0.0, 0.0]))
    vocab: dict[str, int] = {}
    token = np.array([vocab.setdefault(w, len(vocab)) for ws in words for w in ws], np.int64)
    sizes = np.array([len(ws) for ws in words], np.int64)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    marked = np.fromiter((any(u in marks for u in units(w)) for w in vocab), bool, len(vocab))
    y = (marked[token] & np.repeat(labels > 0, sizes)).astype(np.float64)
    names: dict[str, int] = {"": 0}
    per_word = [[0, *(names.setdefault(f, len(names)) for f in features(w))] for w in vocab]
    of = np.repeat(np.arange(len(vocab)), [len(x) for x in per_word])
    feature = np.concatenate([np.array(x) for x in per_word])
    begins = np.zeros(len(token), bool)
    begins[first] = True
    later = np.flatnonzero(~begins)
    pair = np.bincount((y[later - 1] * 2 + y[later]).astype(np.int64), minlength=4).reshape(2, 2)
    opening = np.bincount(y[first].astype(np.int64), minlength=2)
    theta, change, start = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    theta[0] = -4.0
    params = [theta, change, start]
    first_moment = [np.zeros_like(p) for p in params]
    second_moment = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        emission = np.bincount(of, theta[feature], len(vocab))[token]
        p, forward, backward, m = marginals(emission, first, change, start)
        by_word = np.bincount(token, y - p, len(vocab))
        before, after = forward[later - 1], backward[later]
        joint = np.stack([m[0][later], m[1][later] * after, before * m[2][later], before * m[3][later] * after])
        joint = (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        slopes = [
            np.bincount(feature, by_word[of], len(names)) / len(first),
            (pair - joint) / len(first),
            (opening - np.array([(1 - p[first]).sum(), p[first].sum()])) / len(first),
        ]
        for k, (param, slope) in enumerate(zip(params, slopes, strict=True)):
            slope = slope - penalty * param
            first_moment[k] = 0.9 * first_moment[k] + 0.1 * slope
            second_moment[k] = 0.99 * second_moment[k] + 0.01 * slope * slope
            param += 0.25 * first_moment[k] / (1 - 0.9**step) / (np.sqrt(second_moment[k] / (1 - 0.99**step)) + 1e-8)
    emission = np.bincount(of, theta[feature], len(vocab))[token]
    p = marginals(emission, first, change, start)[0]
    expected, most = per_document(p, sizes)
    return Model(
        {f: float(theta[k]) for f, k in names.items() if abs(theta[k]) > 1e-4 or f == ""},
        change, start, _logistic(evidence(expected, most), labels, weights / weights.mean()),
    )


def per_document(p: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and maximum of the marginals of each document (0 without words)."""
    total, most = np.zeros(len(sizes)), np.zeros(len(sizes))
    full = np.flatnonzero(sizes)
    if full.size:
        first = (np.cumsum(sizes) - sizes)[full]
        total[full], most[full] = np.add.reduceat(p, first), np.maximum.reduceat(p, first)
    return total, most


def _logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weights * q * (1 - q))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        move = np.linalg.solve(h, x.T @ (weights * (y - q)) - penalty * beta)
        beta = beta + move / max(1.0, np.abs(move).max() / 2)
        if np.abs(move).max() < 1e-8:
            break
    return beta


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_bytes: int = MAX_BYTES, steps: int = 40) -> Model:
    """Fit on rows of ``docs (doc_id, text)`` that ``labels (doc_id, toxic)`` labels.

    The bound holds in expectation; the ids' hash chooses the rows.
    """
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("__y"))
    rows = docs.select("doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).alias("__size")).join(known, "doc_id")
    sums = rows.groupBy("__y").agg(F.count("*").alias("n"), F.sum("__size").alias("size")).collect()
    if not sums:
        return fit([], np.empty(0), np.empty(0))
    keep = {r["__y"]: min(1.0, max_docs / 2 / r["n"], max_bytes / 2 / max(r["size"], 1)) for r in sums}
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    kept = F.lit(False)
    for y, share in keep.items():
        kept = kept | ((F.col("__y") == y) & (draw < share))
    sample = rows.where(kept).select("text", "__y").toPandas().sort_values(["__y", "text"], na_position="first")
    y = (sample["__y"].to_numpy() > 0).astype(np.float64)
    return fit(sample["text"].tolist(), y, np.array([1 / keep[k] for k in sample["__y"]]), steps)


class _Emissions(dict):
    """Emission score of a word, computed when first met."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > _KNOWN_WORDS:
            self.clear()
        value = self[word] = self.model.emission(word)
        return value


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _spans(text: str, p: np.ndarray) -> list[dict]:
    out: list[dict] = []
    last = -2
    for k, m in enumerate(_WORD.finditer(text)):
        if p[k] >= 0.5:
            if last == k - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"start": m.start(), "end": m.end()})
            last = k
    return out


def tag(texts: list[str | None], model: Model, emissions: dict) -> tuple[np.ndarray, np.ndarray, list[list[dict]]]:
    """Scores, expected toxic words and offending spans (code points) of each text."""
    words = [_WORD.findall(t) if t else [] for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    e = np.fromiter(map(emissions.__getitem__, itertools.chain.from_iterable(words)), np.float64, int(sizes.sum()))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    p = marginals(e, first, model.change, model.start)[0]
    expected, most = per_document(p, sizes)
    upto = np.cumsum(sizes)
    spans = [_spans(t, p[b - n : b]) if n and m >= 0.5 else [] for t, n, b, m in zip(texts, sizes, upto, most, strict=True)]
    return model.score(expected, most), expected, spans


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score``, ``expected`` (toxic words) and ``spans`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = _Emissions(shared.value)
        for part in sliced(batches, "__text"):
            s, expected, spans = tag(part.column(part.num_columns - 1).to_pylist(), shared.value, emissions)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(s), pa.array(expected), pa.array(spans, _SPANS)],
                [*part.schema.names[:-1], "score", "expected", "spans"],
            )

    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    fields = [T.StructField("score", T.DoubleType()), T.StructField("expected", T.DoubleType()), T.StructField("spans", T.ArrayType(span))]
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *fields]))


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows that score under ``threshold``, with their columns as they are."""
    names = [f"__c{k}" for k in range(len(docs.columns))]
    scored = score(docs.toDF(*names), model, names[docs.columns.index(text_col)], tuple(names))
    return scored.where(F.col("score") < threshold).select(*names).toDF(*docs.columns)
