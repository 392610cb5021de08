import hashlib

import public_tokenizers as P
import pytest
import tiktoken

from eventlens.llm import bpe, queries

PATH = P.path(queries.RANKS)


@pytest.fixture(scope="module")
def encoder():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


TEXTS = ["", None, " \n\t x  ", "a" * 1500, "l'été <|endoftext|> 日本語 don't 12345", "é" * 300, "\x00\x85 ok", "Word " * 3000, "xyzzy" * 150]


def test_round_trip_equals_the_library(spark, documents, encoder):
    docs = documents(TEXTS)
    got = bpe.round_trip(docs, PATH, P.PATTERN).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        text = TEXTS[-1 if r.doc_id is None else r.doc_id] or ""
        assert list(r.ids) == encoder.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


def test_small_caches_and_piles_change_nothing(spark, documents, encoder, monkeypatch):
    codec = bpe.Codec(bpe.load_ranks(PATH), P.PATTERN)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "PILE_ROWS", 50)
    for text in TEXTS:
        ids, counts = codec.encode([text, "zz qqqq"])
        assert ids[: counts[0]].tolist() == encoder.encode_ordinary(text or "")


def test_keyed_form_equals_the_library(encoder, monkeypatch, rng):
    monkeypatch.setattr(bpe, "LONG_WORD", 2)
    codec = bpe.Codec(bpe.load_ranks(PATH), P.PATTERN)
    texts = [*TEXTS, "a" * 70_001, *("".join(rng.choices(letters, k=60)) for letters in ("ab", "aé", "then", "日本語") for _ in range(10))]
    ids, counts = codec.encode(texts)
    assert ids.tolist() == [i for t in texts for i in encoder.encode_ordinary(t or "")]
    assert len(counts) == len(texts)


def test_decode_of_null_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [5, 6])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in bpe.decode(rows, PATH, P.PATTERN).collect()}
    back = {v: k for k, v in bpe.load_ranks(PATH).items()}
    assert got == {1: b"", 2: b"", 3: back[5] + back[6]}
    with pytest.raises(Exception, match="unknown token id"):
        bpe.decode(spark.createDataFrame([(1, [999_999])], "doc_id long, ids array<int>"), PATH, P.PATTERN).collect()


def test_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH, P.PATTERN).collect() == []


def test_query(spark, encoder):
    from tests.conftest import SMALL

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.QUERIES["op1_bpe"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = encoder.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
