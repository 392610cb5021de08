"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: lines, at sentence ends (ASCII and CJK), and, where
neither comes for ``LONG_UNIT`` characters, by content into pieces of ``LEAST`` to
``GREATEST`` characters: after a place whose last ``WINDOW`` characters have a hash that is
a multiple of ``SPREAD``, or else after the place of the least hash, so that repeated and
unbroken text is cut too and falls into step again behind a change.  Each paragraph's digest
(the j-th copy of one paragraph counts as another) goes into one cell of each of
``TABLES`` tables; a cell holds a count, the sum of digests and the sum of
their check values.  The fingerprint is the sketch of ``CELLS`` cells.

Two fingerprints are compared by subtracting their cells and peeling: a cell with one
digest left gives it away, it is taken out of its other cells, and so on.  If cells
are left over, the difference did not fit (:func:`compare` says so) and the pair's texts
are sketched again with ``GROWTH`` times the cells until it does.  The digests recovered
are exactly the paragraphs that differ, and a fingerprint's counts add up to ``TABLES``
times its paragraphs; likeness is the shared part of all paragraphs (1 for equal
texts, 0 with nothing in common; two texts without paragraphs are alike).

``with_next`` pairs every document with the next by id.  Documents are dealt by
ranges of the id and sorted; the least document of each range is sent to the
range before too, so texts are shuffled once and no task sees the whole order.

Defined cases: a null text is empty; the next document of the greatest id is
that of the least; rows that share an id all get the next greater id's
document (its least text, if it has several); a null id is the smallest; other
columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import sliced

TABLES = 3
CELLS = 12
GROWTH = 4
LONG_UNIT = 240
WINDOW, LEAST, GREATEST, SPREAD = 8, 16, 120, 32
BATCH_BYTES = 1 << 20
_ENDS = "\n.!?。．｡！？"
_UNIT = re.compile(f"[^{_ENDS}]*[{_ENDS}]+|[^{_ENDS}]+")
_NO_ID = -(1 << 63)
#: Check values and their sums are kept modulo 2^32.
_CHECK_BITS = np.uint64(0xFFFFFFFF)
_CELL = np.dtype([("count", ">i4"), ("total", ">u8"), ("check", ">u4")])


def paragraphs(text: str | None) -> list[str]:
    """The units of a text, in order; white space at their ends is no part of them."""
    out = []
    for unit in _UNIT.findall(text) if text else []:
        unit = unit.strip()
        if len(unit) > LONG_UNIT:
            out += _pieces(" ".join(unit.split()))
        elif unit:
            out.append(unit)
    return out


def _pieces(unit: str) -> list[str]:
    """A long unit cut by content; where to cut depends on the piece alone, not on what comes after ``GREATEST``."""
    codes = np.frombuffer(unit.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    rolled = np.zeros(max(len(codes) - WINDOW + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(WINDOW):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + len(rolled)]
    hashes = _mix(rolled, 60)  # hashes[p - WINDOW]: of the characters before place p
    places = np.flatnonzero(hashes % np.uint64(SPREAD) == 0) + WINDOW
    out, at = [], 0
    while at + LEAST < len(unit):
        i = int(np.searchsorted(places, at + LEAST))
        if i < len(places) and places[i] <= at + GREATEST:
            end = int(places[i])
        elif at + GREATEST < len(unit):
            end = at + LEAST + int(np.argmin(hashes[at + LEAST - WINDOW : at + GREATEST - WINDOW + 1]))
        else:
            break
        out.append(unit[at:end].strip())
        at = end
    if rest := unit[at:].strip():
        out.append(rest)
    return out


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def digests(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all paragraphs of all texts, and how many each text has."""
    units = [paragraphs(t) for t in texts]
    sizes = np.array([len(u) for u in units], np.int64)
    digest = xxhash.xxh3_64_intdigest
    raw = np.fromiter((digest(u) for us in units for u in us), np.uint64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    order = np.lexsort((raw, text))
    d, t = raw[order], text[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1])
    copy = np.arange(len(d)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(d) else np.empty(0, np.int64)
    out = np.empty_like(raw)
    out[order] = _mix(d + copy.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 9)
    return out, sizes


def _cells(keys: np.ndarray, sketch: np.ndarray, cells: int) -> np.ndarray:
    """Place of every key in every table; ``sketch`` numbers the sketch that a key belongs to."""
    width = cells // TABLES
    own = [sketch * cells + t * width + (_mix(keys, 20 + t) % np.uint64(width)).astype(np.int64) for t in range(TABLES)]
    return np.stack(own)


def _check(keys: np.ndarray) -> np.ndarray:
    return _mix(keys, 40) & _CHECK_BITS


def sketches(keys: np.ndarray, sketch: np.ndarray, sign: np.ndarray, n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, sum of keys, sum of checks) of ``n`` sketches; keys with sign -1 are subtracted."""
    count, total, check = np.zeros(n * cells, np.int64), np.zeros(n * cells, np.uint64), np.zeros(n * cells, np.uint64)
    _put(count, total, check, keys, sketch, sign, cells)
    return count, total, check


def _put(count, total, check, keys, sketch, sign, cells) -> None:
    with np.errstate(over="ignore"):
        u = sign.astype(np.uint64)  # -1 wraps, and so do the sums
        signed, checks = keys * u, _check(keys) * u
    for at in _cells(keys, sketch, cells):
        np.add.at(count, at, sign)
        np.add.at(total, at, signed)
        np.add.at(check, at, checks)


def peel(count, total, check, n: int, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digests recovered, their sketch, which sketches came out empty)."""
    found, of = [], []
    while True:
        single = np.flatnonzero(np.abs(count) == 1)
        with np.errstate(over="ignore"):
            u = count[single].astype(np.uint64)
            keys = total[single] * u
            pure = (check[single] - _check(keys) * u) & _CHECK_BITS == 0
        single, keys = single[pure], keys[pure]
        if not single.size:
            break
        sketch, sign = single // cells, count[single]
        order = np.lexsort((keys, sketch))
        k, s = keys[order], sketch[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1])
        keys, sketch, sign = k[new], s[new], sign[order][new]
        _put(count, total, check, keys, sketch, -sign, cells)
        found.append(keys)
        of.append(sketch)
    left = (count != 0) | (total != 0) | (check & _CHECK_BITS != 0)
    done = ~left.reshape(n, cells).any(axis=1)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), done
    return np.concatenate(found), np.concatenate(of), done


def differing(
    a: np.ndarray, a_of: np.ndarray, b: np.ndarray, b_of: np.ndarray, n: int, todo: np.ndarray | None = None, cells: int = CELLS
) -> tuple[np.ndarray, np.ndarray]:
    """Digests that only one text of pair ``i`` has (``a_of``, ``b_of``: the pair of each digest), with their pairs.

    ``todo`` names the pairs to work on (all by default), ``cells`` is the first size tried."""
    keys, pair = np.concatenate([a, b]), np.concatenate([a_of, b_of])
    sign = np.concatenate([np.ones(len(a), np.int64), -np.ones(len(b), np.int64)])
    todo, out, out_of = np.arange(n) if todo is None else todo, [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    while todo.size:
        place = np.full(n, -1)
        place[todo] = np.arange(len(todo))
        live = place[pair] >= 0
        keys, pair, sign = keys[live], pair[live], sign[live]
        found, of, done = peel(*sketches(keys, place[pair], sign, len(todo), cells), len(todo), cells)
        good = done[of]
        out.append(found[good])
        out_of.append(todo[of[good]])
        todo = todo[~done]
        cells *= GROWTH
    return np.concatenate(out), np.concatenate(out_of)


def hex_sketches(keys: np.ndarray, sizes: np.ndarray) -> list[str]:
    """Fingerprints: per cell the count (32 bits), the sum of digests (64) and of checks (32) in hex."""
    n = len(sizes)
    count, total, check = sketches(keys, np.repeat(np.arange(n), sizes), np.ones(len(keys), np.int64), n, CELLS)
    raw = np.empty(n * CELLS, _CELL)
    raw["count"], raw["total"], raw["check"] = count, total, check & _CHECK_BITS
    line = raw.tobytes().hex()
    step = CELLS * 2 * _CELL.itemsize
    return [line[i * step : (i + 1) * step] for i in range(n)]


def parsed(prints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, sum of digests, sum of checks) of all cells of the fingerprints, as :func:`sketches` gives them."""
    if any(len(p) != CELLS * 2 * _CELL.itemsize for p in prints):
        raise ValueError(f"a fingerprint has {CELLS * 2 * _CELL.itemsize} hex digits")
    raw = np.frombuffer(bytes.fromhex("".join(prints)), _CELL)
    return raw["count"].astype(np.int64), raw["total"].astype(np.uint64), raw["check"].astype(np.uint64)


def compare(a: list[str], b: list[str]) -> np.ndarray:
    """Likeness of fingerprint ``i`` of ``a`` and fingerprint ``i`` of ``b``; NaN where the difference does not fit their cells."""
    n = len(a)
    left, right = parsed(a), parsed(b)
    both = (left[0] + right[0]).reshape(n, CELLS).sum(axis=1) // TABLES
    with np.errstate(over="ignore"):
        rest = [x - y for x, y in zip(left, right, strict=True)]
    _, of, done = peel(*rest, n, CELLS)
    return np.where(done, _alike(both, np.bincount(of, minlength=n)), np.nan)


def _alike(both: np.ndarray, apart: np.ndarray) -> np.ndarray:
    return np.where(both > 0, (both - apart) / np.maximum(both + apart, 1), 1.0)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], prints: tuple[list[str], list[str]] | None = None) -> np.ndarray:
    """Likeness of text ``i`` of ``a`` and text ``i`` of ``b`` (:func:`digests`): of their fingerprints, or else of larger sketches."""
    n = len(a[1])
    near = compare(*(prints or (hex_sketches(*a), hex_sketches(*b))))
    todo = np.flatnonzero(np.isnan(near))
    if todo.size:
        of = [np.repeat(np.arange(n), x[1]) for x in (a, b)]
        _, pair = differing(a[0], of[0], b[0], of[1], n, todo, CELLS * GROWTH)
        near[todo] = _alike(a[1] + b[1], np.bincount(pair, minlength=n))[todo]
    return near


def compare_columns(rows: DataFrame, a_col: str, b_col: str, name: str = "likeness") -> DataFrame:
    """``rows`` and the likeness of two fingerprint columns.

    Null where a fingerprint is null or the pair differs by more than the cells hold; the texts decide then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.num_columns - 2
            a, b = (batch.column(k + i).to_pylist() for i in (0, 1))
            out = np.full(len(a), np.nan)
            known = [i for i in range(len(a)) if a[i] is not None and b[i] is not None]
            if known:
                out[known] = compare([a[i] for i in known], [b[i] for i in known])
            near = pa.array(out, pa.float64(), mask=np.isnan(out))
            yield pa.RecordBatch.from_arrays([*batch.columns[:k], near], [*batch.schema.names[:k], "near"])

    plain = rows.toDF(*[f"c{i}" for i in range(len(rows.columns))])
    pair = plain.select("*", *[plain[f"c{rows.columns.index(c)}"].alias(x) for c, x in ((a_col, "a"), (b_col, "b"))])
    schema = T.StructType([*plain.schema.fields, T.StructField("near", T.DoubleType())])
    return pair.mapInArrow(run, schema).toDF(*rows.columns, name)


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``fingerprint`` of every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "__text", BATCH_BYTES):
            prints = hex_sketches(*digests(part.column(part.num_columns - 1).to_pylist()))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(prints, pa.string())], [*part.schema.names[:-1], "fingerprint"])

    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("fingerprint", T.StringType())]))


def _ranges(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``bucket, extra, k, id, text``: id ranges, each with the least document of the next range as an extra row."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = docs.select(key.alias("k"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.select(F.col("k").cast("double").alias("k")).approxQuantile("k", [i / parts for i in range(1, parts)], 0.2 / parts)
    splits = [-math.inf, *sorted(set(cuts) or {0.0}), math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol="k", outputCol="bucket")
    rows = bucketizer.transform(rows).withColumn("bucket", F.col("bucket").cast("int"))
    # one row per range: a bounded number
    heads = sorted((r["bucket"], r["k"]) for r in rows.groupBy("bucket").agg(F.min("k").alias("k")).collect())
    before = {heads[i][1]: heads[i - 1][0] for i in range(len(heads))}
    target = F.create_map(*[F.lit(x) for item in before.items() for x in item])[F.col("k")] if before else F.lit(None).cast("int")
    own = F.struct(F.col("bucket"), F.lit(0).alias("extra"))
    also = F.struct(target.alias("bucket"), F.lit(1).alias("extra"))
    places = F.when(target.isNull(), F.array(own)).otherwise(F.array(own, also))
    return rows.select(F.explode(places).alias("p"), "k", "id", "text").select("p.*", "k", "id", "text")


_COMPARED = T.StructType(
    [
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, its text edited with the next document, and the likeness to both.

    Columns: ``id_col, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    rows = _ranges(docs, id_col, text_col)
    kind = rows.schema["id"]
    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "extra", "k", F.coalesce("text", F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []  # rows of one document as [id, text, copies]; normally one
        at = None
        ready: list[tuple] = []
        size = 0
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(3).type
            for bucket, extra, k, own, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                if at is not None and at[0] == bucket and at[1] == extra and at[2] == k:
                    if extra:
                        continue
                    if held[-1][1] == text:
                        held[-1][2] += 1
                    else:
                        held.append([own, text, 1])
                    continue
                if at is not None and at[0] == bucket and not at[1]:
                    for x, t, copies in held:
                        ready.append((x, t, text, copies))
                        size += len(t) + len(text)
                    if size >= BATCH_BYTES:
                        yield _compared(ready, id_type, kind.name)
                        ready, size = [], 0
                at, held = (bucket, extra, k), [[own, text, 1]]
        if ready:
            yield _compared(ready, id_type, kind.name)

    out = dealt.mapInArrow(run, T.StructType([T.StructField("id", kind.dataType), *_COMPARED.fields]))
    return out.withColumnRenamed("id", id_col)


def _compared(ready: list[tuple], id_type: pa.DataType, name: str) -> pa.RecordBatch:
    texts, after = [r[1] for r in ready], [r[2] for r in ready]
    changed = [edited(t, x) for t, x in zip(texts, after, strict=True)]
    own, new, following = digests(texts), digests(changed), digests(after)
    own_prints, new_prints, next_prints = hex_sketches(*own), hex_sketches(*new), hex_sketches(*following)
    columns = [
        pa.array([r[0] for r in ready], id_type),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array(changed, pa.string()),
        pa.array(own_prints, pa.string()),
        pa.array(new_prints, pa.string()),
        pa.array(likeness(own, new, (own_prints, new_prints)), pa.float64()),
        pa.array(likeness(own, following, (own_prints, next_prints)), pa.float64()),
    ]
    copies = np.array([r[3] for r in ready])
    take = pa.array(np.repeat(np.arange(len(ready)), copies))
    return pa.RecordBatch.from_arrays([c.take(take) for c in columns], ["id", *_COMPARED.fieldNames()])
