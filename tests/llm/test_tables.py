"""Toxicity, packing, URL rules, chat formatting and the pipeline."""

import itertools
import json
import zlib

import numpy as np
from pyspark.sql import functions as F
import pytest

import corpus_pipeline
from eventlens.llm import chat, packing, queries, secrets, simhash, toxicity, urls
from tests.conftest import SMALL

MEDIUM = "/root/testdata/sf0.1"


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    for sizes in ([3, 1, 4], [5], [1, 1], [7, 2]):
        n = sum(sizes)
        e, change, start = rng.normal(size=n) * 2, rng.normal(size=(2, 2)), rng.normal(size=2)
        first = np.cumsum([0, *sizes[:-1]])
        p = toxicity.marginals(e, first, change, start)[0]
        for a, k in zip(first, sizes, strict=True):
            total, one = 0.0, np.zeros(k)
            for ys in itertools.product((0, 1), repeat=k):
                s = start[ys[0]] + sum(e[a + i] * ys[i] for i in range(k)) + sum(change[ys[i], ys[i + 1]] for i in range(k - 1))
                total, one = total + np.exp(s), one + np.exp(s) * np.array(ys)
            assert np.allclose(p[a : a + k], one / total)


def test_rows_of_the_grid_do_not_matter(monkeypatch):
    rng = np.random.default_rng(1)
    e, first = rng.normal(size=1000), np.array([0, 700])
    args = (e, first, rng.normal(size=(2, 2)), rng.normal(size=2))
    whole = toxicity.marginals(*args)[0]
    monkeypatch.setattr(toxicity, "_ROW", 7)
    assert np.allclose(whole, toxicity.marginals(*args)[0])


def test_toxicity_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    got = queries.QUERIES["op3_toxicity"](spark, MEDIUM).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(r.score, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    pos, neg = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([[p > n for n in neg] for p in pos]) > 0.95
    assert np.mean([n >= 0.3 for n in neg]) < 0.05


def test_toxicity_edge_cases(spark, documents):
    docs = documents(["you idiot " * 3, None, "", "fine words", "12 34"])
    labels = spark.createDataFrame([(0, 1), (0, None), (3, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0), labels.where("toxic = 1")):
        model = toxicity.train(docs, known)
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == 7 and len({r.score for r in rows if r.doc_id in (1, 2, 4)}) == 1
    assert toxicity.clean(docs, model).columns == docs.columns
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_packing_is_best_fit_decreasing_and_lossless():
    rng = np.random.default_rng(0)
    for _ in range(40):
        width = int(rng.integers(1, 40))
        sizes = rng.integers(1, width + 1, rng.integers(0, 150))
        rows, free = packing.best_fit_decreasing(sizes, width), {}
        for k in np.argsort(-sizes, kind="stable"):
            r, room = int(rows[k]), [f for f in free.values() if f >= sizes[k]]
            assert free[r] == min(room) if r in free else not room
            free[r] = free.get(r, width) - sizes[k]


def test_packed_rows_give_the_documents_back(spark):
    import io

    docs = [(1, list(range(50))), (2, []), (3, None), (4, [7] * 8), (5, [9]), (5, [9]), (None, [3, 3])]
    packed = packing.pack(spark.createDataFrame(docs, "doc_id long, ids array<int>"), width=8, pad=0, dtype="<u2").cache()
    back = {}
    for r in packed.collect():
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == 8 and not ids[r.cu_seqlens[-1] :].any()
        for d, p, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            back.setdefault((d, p), []).append(ids[a:b].tolist())
            assert positions[a:b].tolist() == list(range(b - a))
    assert sum((x for k, v in sorted((k, v) for k, v in back.items() if k[0] == 1) for x in v), []) == list(range(50))
    assert back[4, 0] == [[7] * 8] and back[5, 0] == [[9], [9]] and back[None, 0] == [[3, 3]]
    assert not {2, 3} & {d for d, _ in back}
    m = packing.matrices(packed, width=8, dtype="<u2").collect()
    assert sum(np.load(io.BytesIO(x.ids)).shape[0] for x in m) == packed.count()
    assert packing.pack(spark.createDataFrame([], "doc_id long, ids array<int>")).count() == 0


def test_packing_query_keeps_all_tokens(spark):
    tokens = sum(r.n_tokens for r in queries.QUERIES["op1_bpe"](spark, SMALL).collect())
    assert sum(r.n_tokens for r in queries.QUERIES["op4_packing"](spark, SMALL).collect()) == tokens


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), path[:stop]


def brute_rule(host, path):
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return (best.text, best.verdict) if best else (None, None)


URLS = [None, "", "no scheme", "http://", "http://A.NET", "HTTP://x.NET/EN/", "a://example.net/en/?q#f", "https://É.org/fr/x", "http://xorg/fr/", "http://net/", "x://a?b://c/", "ftp://w.example.com/de/1#/", "http://u@h.net:80/p\nq"]


def test_fixed_url_rules(spark):
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(URLS + URLS)], "id long, url string")
    none = spark.createDataFrame([], "id long, bad boolean")
    got = urls.judge(rows, urls.mine(rows, none), queries.URL_RULES).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path = brute_url(r.url)
        rule, verdict = brute_rule(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def test_mined_url_rules_equal_brute_force(spark):
    rows = [(i, f"http://{'spam' if i % 3 == 0 else 'good'}-site.example.com/{'buy' if i % 2 else 'read'}/{i}") for i in range(120)]
    pages = spark.createDataFrame(rows, "id long, url string")
    labels = spark.createDataFrame([(i, i % 3 == 0 and i % 2 == 1) for i in range(0, 120)] + [(1, None)], "id long, bad boolean")
    mined = urls.mine(pages, labels, min_support=0.05, min_confidence=0.9)
    assert all({"host:spam-site", "word:spam"} & set(r.tokens) and "path:buy" in r.tokens and r.confidence == 1.0 for r in mined.collect())
    got = urls.judge(pages, mined, []).collect()
    assert all((r.verdict == "block") == (r.id % 3 == 0 and r.id % 2 == 1) for r in got) and len(got) == 120


def test_long_templates_are_one_item(spark):
    words = "/".join(f"word{k}x" for k in range(30))
    rows = [(i, f"http://a.example.com/{words}/p{i}q" if i % 4 == 0 else f"http://a.example.com/other{i % 3}z") for i in range(160)]
    pages = spark.createDataFrame(rows, "id long, url string")
    mined = urls.mine(pages, pages.select("id", (F.col("id") % 4 == 0).alias("bad"))).collect()
    assert {tuple(r.tokens) for r in mined} == {("path:word9x",)} and {r.key for r in mined} == {f"path:word{k}x" for k in range(30)}
    again = pages.union(spark.createDataFrame([(500, "http://b.org/word7x")], pages.schema))
    got = {r.id: r.verdict for r in urls.judge(again, urls.mine(pages, pages.select("id", (F.col("id") % 4 == 0).alias("bad"))), []).collect()}
    assert all((v == "block") == (i % 4 == 0) for i, v in got.items())


def test_rules_equal_enumeration(spark):
    rng = np.random.default_rng(5)
    sets = [sorted(rng.choice(["aa", "bb", "cc", "dd", "ee"], rng.integers(1, 5), replace=False)) for _ in range(200)]
    bad = [("aa" in s and "cc" in s and rng.random() < 0.95) or rng.random() < 0.1 for s in sets]
    pages = spark.createDataFrame([(i, "http://h/" + "/".join(s)) for i, s in enumerate(sets)], "id long, url string")
    labels = spark.createDataFrame([(i, bool(b)) for i, b in enumerate(bad)], "id long, bad boolean")
    got = {tuple(r.tokens): (round(r.confidence, 9), round(r.support, 9)) for r in urls.mine(pages, labels, 0.05, 0.6, 1.2).collect()}
    want, base = {}, sum(bad) / 200
    for k in range(1, 6):
        for combo in itertools.combinations(["aa", "bb", "cc", "dd", "ee"], k):
            hold = [b for s, b in zip(sets, bad, strict=True) if set(combo) <= set(s)]
            sure = sum(hold) / max(len(hold), 1)
            if sum(hold) >= max(10, 10) and sure >= 0.6 and sure / base >= 1.2:
                want[tuple(f"path:{w}" for w in combo)] = (round(sure, 9), round(sum(hold) / 200, 9))
    want = {r: v for r, v in want.items() if not any(set(q) < set(r) and u[0] >= v[0] for q, u in want.items())}
    assert got == want and want


def test_url_edge_tables(spark):
    pages = spark.createDataFrame([(1, "http://a/b", "x")], "id long, url string, host string").select("id", "url")
    none = spark.createDataFrame([], "id long, bad boolean")
    assert urls.judge(pages.limit(0), urls.mine(pages.limit(0), none), queries.URL_RULES).count() == 0


def test_url_query_rules(spark):
    for r in queries.QUERIES["op5_url_rules"](spark, SMALL).collect():
        rule, verdict = brute_rule(r.host, r.path)
        assert r.rule == rule and (rule is None or r.verdict == verdict)


def test_chat_links_orders_and_validates(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi \"there\"\n"), (1, 2, "assistant", "yes"), (1, 3, "assistant", "again"),
        (2, 0, "assistant", "early"), (2, 5, "user", None), (2, 2000, "user", "x"), (2, 4000, "assistant", "late"), (3, 0, None, "?"),
    ]
    messages, needs = chat.from_turns(spark.createDataFrame(rows + rows[:1], "conv_id long, turn int, role string, text string"))
    got = {(r.conv, r.turn): r for r in chat.format_chat(messages, needs, queries.REPLY_SCHEMA).collect()}
    assert {k: v.link for k, v in got.items() if v.link} == {
        (1, 1): "linked", (1, 2): "linked", (1, 3): "extra", (2, 0): "orphan", (2, 5): "unanswered", (2, 2000): "linked", (2, 4000): "linked",
    }
    assert got[2, 5].faults == ["text:least"] and got[1, 1].faults == []
    assert got[1, 1].line == '{"role":"user","tool_calls":[{"arguments":{"text":"hi \\"there\\"\\n","turn":1},"id":"call-1-1","name":"reply"}]}'
    assert got[1, 3].line == '{"content":"again","role":"assistant","tool_call_id":"call-1-1"}' and got[3, 0].line == '{"content":"?"}'
    assert [got[2, t].place for t in (0, 5, 2000, 4000)] == [1, 2, 3, 4]


def test_calls_move_behind_what_they_need(spark):
    calls = spark.createDataFrame([(1, c, t) for t, c in enumerate("abcd")] + [(2, "p", 0), (2, "q", 1)], "conv long, call_id string, turn int")
    needs = [(1, "a", "c"), (1, "c", "d"), (1, "b", "gone"), (2, "p", "q"), (2, "q", "p")]
    got = {(r.conv, r.call_id): r for r in chat.order(calls, spark.createDataFrame(needs, "conv long, call_id string, needed string")).collect()}
    assert got[1, "d"].level < got[1, "c"].level < got[1, "a"].level and not any(got[1, c].cyclic for c in "abcd")
    assert got[2, "p"].cyclic or got[2, "q"].cyclic


def test_chat_validates_given_arguments(spark):
    schema = [("find", "q", "string", True, 2), ("find", "n", "integer", False, 1), ("find", "how", "object", False, None)]
    made = [
        ({"q": '"ab"', "n": "3", "how": '{"a":[1,{"b":null}]}'}, ""),
        ({"n": "0"}, "n:least,q:missing"),
        ({"q": None, "n": '"x"', "z": "1", "y": None}, "n:type,q:missing,z:unknown"),
        ({"q": '"\\n"', "how": "[]"}, "how:type,q:least"),
        (None, "q:missing"),
    ]
    rows = [(1, i, i + 1, "assistant", "", f"c{i}", "find", a, False) for i, (a, _) in enumerate(made)]
    rows += [(1, 9, 6, "tool", "done", "c0", None, None, True), (1, 10, 7, "assistant", "no result", None, None, None, False)]
    names = "conv long, turn int, place long, role string, text string, call_id string, name string, arguments map<string,string>, is_result boolean"
    none = spark.createDataFrame([], "conv long, call_id string, needed string")
    got = {r.turn: r for r in chat.format_chat(spark.createDataFrame(rows, names), none, schema).collect()}
    assert [",".join(got[i].faults) for i in range(len(made))] == [f for _, f in made]
    assert json.loads(got[0].line)["tool_calls"][0]["arguments"] == {"q": "ab", "n": 3, "how": {"a": [1, {"b": None}]}}
    assert '"arguments":{"n":"x","z":1}' in got[2].line and '"arguments":{}' in got[4].line
    assert got[0].link == got[9].link == "linked" and got[1].link == "unanswered" and got[10].link is None
    log = spark.createDataFrame([(1, None, "user", "a")], "conv_id long, turn int, role string, text string")
    only = chat.format_chat(*chat.from_turns(log), queries.REPLY_SCHEMA).first()
    assert only.faults == ["turn:missing"] and '"arguments":{"text":"a"}' in only.line


def test_chat_faults(spark):
    from pyspark.sql import functions as F

    schema = F.expr("array(named_struct('name','f','field','n','type','integer','required',true,'least',0L), named_struct('name','f','field','s','type','string','required',false,'least',2L))")
    row = spark.createDataFrame(
        [("f", {"n": "1"}, {"n": 1}), ("f", {"n": "-1", "z": "0"}, {"n": -1}), ("f", {"s": '"a"'}, {"s": 1}), ("g", {}, {}), ("f", {"n": '"1"'}, {})],
        "name string, a map<string,string>, l map<string,long>",
    )
    got = [r[0] for r in row.select(chat.invalid_fields(F.col("name"), F.col("a"), F.col("l"), schema)).collect()]
    assert got == [[], ["n:least", "z:unknown"], ["n:missing", "s:least"], ["name:unknown"], ["n:type"]]


def test_pipeline_stages_equal_the_operators(spark):
    from tests.llm.test_simhash import brute_components, brute_print
    from tests.llm.test_texts import brute_hits

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    free = toxicity.train(docs.where(~queries.held_out()), labels.where(~queries.held_out()))
    kept = {r.doc_id for r in toxicity.score(docs, free).where("score < 0.3").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}
    least = brute_components({i: brute_print(t) for i, t in texts.items()})
    texts = {i: t for i, t in texts.items() if least[i] == i}
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    texts = {i: t for i, t in texts.items() if not brute_hits(t, items, 10)[1]}
    masked = {i: t and secrets.redacted(t, secrets.find_secrets(t)) for i, t in texts.items()}
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, SMALL).collect()}
    import hashlib

    assert got == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in masked.items()}
    assert [name for name, _ in corpus_pipeline.STAGES][1] == "simhash_near_dedup"


@pytest.mark.parametrize("name", ["drop_toxic", "drop_near_duplicates", "drop_contaminated", "mask_secrets", "to_tokens"])
def test_stages_take_odd_rows(spark, name):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "token=abcdefgh é", "en", "s", 16), (2, "", "en", "s", 0), (3, "x " * 20000, None, "s", 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = getattr(corpus_pipeline, name)(spark, docs, SMALL)
    assert out.columns == docs.columns or name == "to_tokens"
    assert {r.doc_id for r in out.collect()} >= {None, 1, 3}
    assert getattr(corpus_pipeline, name)(spark, docs.limit(0), SMALL).count() == 0


def test_simhash_stage_uses_the_operator():
    assert simhash.blocks_of(4) == [(0, 21), (21, 21), (42, 22)]


def test_null_and_text_conversations(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (-1, 0, "user", "c"), (-1, 1, "assistant", "d")]
    for kind in ("long", "string"):
        convs = spark.createDataFrame([(None if c is None else c if kind == "long" else f"c{c}", *r) for c, *r in rows], f"conv_id {kind}, turn long, role string, text string")
        for some in (convs, convs.limit(0), convs.withColumn("line", F.lit("x")).withColumn("level", F.lit(1))):
            out = chat.format_chat(*chat.from_turns(some), queries.REPLY_SCHEMA).collect()
            if out:
                assert {(r.conv, r.turn, r.link) for r in out} == {(c if c is None or kind == "long" else f"c{c}", t, "linked") for c, t, _, _ in rows}


def test_backslash_runs_are_linear():
    import time

    start = time.time()
    text = "-----BEGIN RSA PRIVATE KEY-----" + "\\" * 1_000_000 + "-----END RSA PRIVATE KEY-----"
    assert secrets._ESCAPED.sub("", text) and time.time() - start < 5
