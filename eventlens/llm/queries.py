"""Registered queries of the subpackage: ``QUERIES[name](spark, sf_dir)``, and SQL twins where SQL can say them.

Each query applies its operator with production parameters to its whole table
and derives the digest columns from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.llm import bpe, chat, conv_trie, decontam, fingerprints, mixing, packing, resampling, secrets, simhash, suffixes, toxicity, urls
from eventlens.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def joined_sha(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ","), 256)


def held_out() -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def tokens_of(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    coded = bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=keep)
    return coded.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        joined_sha(F.col("ids").cast("array<string>")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "ids",
    )


@register("op1_bpe")
def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_of(table(spark, sf_dir, "documents")).drop("ids")


#: What a call must carry: a text of at least one character and a turn number from 0 on.
REPLY_SCHEMA = [("reply", "text", "string", True, 1), ("reply", "turn", "integer", True, 0)]

_CHAT_SQL = """
WITH m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text,
         max(CASE WHEN role = 'user' THEN turn END) OVER (
           PARTITION BY conv_id ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM conversations),
named AS (
  SELECT *, CASE WHEN role = 'user' THEN 'call-' || conv_id || '-' || turn
                 WHEN role = 'assistant' AND asked IS NOT NULL THEN 'call-' || conv_id || '-' || asked END AS call_id
  FROM m),
answers AS (SELECT conv_id, call_id, min(turn) AS result_turn FROM named WHERE role = 'assistant' AND call_id IS NOT NULL GROUP BY ALL)
SELECT n.conv_id, n.turn, n.place, n.role, n.call_id,
       CASE WHEN n.role = 'user' THEN CASE WHEN a.result_turn IS NULL THEN 'unanswered' ELSE 'linked' END
            WHEN n.role = 'assistant' THEN CASE WHEN n.call_id IS NULL THEN 'orphan'
                                                WHEN n.turn = a.result_turn THEN 'linked' ELSE 'extra' END END AS link,
       CASE WHEN n.role = 'user' THEN n.turn::BIGINT END AS level,
       CASE WHEN n.role = 'user' THEN CASE WHEN text = '' THEN 'text:least' ELSE '' END END AS faults,
       CASE WHEN n.role = 'user'
            THEN '{"role":"user","tool_calls":[{"arguments":{"text":' || to_json(text)::VARCHAR || ',"turn":' || turn || '},"id":"'
                 || n.call_id || '","name":"reply"}]}'
            ELSE '{"content":' || to_json(text)::VARCHAR || ',"role":' || to_json(role)::VARCHAR
                 || coalesce(',"tool_call_id":"' || n.call_id || '"', '') || '}' END AS line
FROM named n LEFT JOIN answers a USING (conv_id, call_id)
"""


@register("op2_chat", _CHAT_SQL)
def q_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, needs = chat.from_turns(table(spark, sf_dir, "conversations"))
    lines = chat.format_chat(messages, needs, REPLY_SCHEMA)
    return lines.select(
        F.col("conv").alias("conv_id"), "turn", "place", "role", "call_id", "link", "level",
        F.array_join("faults", ",").alias("faults"), "line",
    )


@register("op3_toxicity")
def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs.where(~held_out()), table(spark, sf_dir, "labels").where(~held_out()))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.round("expected", 6).alias("expected"),
        "spans",
    )


@register("op4_packing")
def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tokens = packing.token_ids(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    packed = packing.pack(tokens, width=packing.WIDTH, pad=50256, dtype="<u2")
    return packed.withColumn("n_tokens", F.element_at("cu_seqlens", -1).cast("long"))


#: The contract's fixed rules.
URL_RULES = [
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
]


@register("op5_url_rules")
def q_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    # A page and the document taken from it share their number; low quality is the label that the rules predict.
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 0).alias("bad"))
    judged = urls.judge(pages, urls.mine(pages, labels), URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined"))


@register("op6_fingerprints")
def q_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = fingerprints.with_next(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


@register("op7_simhash")
def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op8_suffix_dedup")
def q_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = suffixes.without_repeats(table(spark, sf_dir, "documents"), length=100)
    dropped = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])
    return rest.select(
        "doc_id",
        "n_bytes",
        dropped.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register("op9_decontamination")
def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    signed = F.transform("hits", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(signed, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        joined_sha(F.array_sort("items")).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.col("longest.n_words").alias("longest_match"),
    )


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@register("op10_secrets")
def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id", *map(count, secrets.BASE), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )


@register("op11_mixing")
def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_repeats=3, seed=42)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def rebuilt(turns: DataFrame, most: int = 6, block: int = 100) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations whose first h turns, at places 1 to h, are those of their block's first conversation."""
    h = F.crc32(F.col("conv").cast("string")) % most
    members = turns.select("conv").distinct()
    firsts = turns.where((F.col("conv") % block == 0) & (F.col("place") < most))
    firsts = firsts.groupBy(F.col("conv").alias("base")).agg(F.collect_list(F.struct("place", "id", "chars")).alias("given"))
    given = members.withColumn("base", F.col("conv") - F.col("conv") % block).join(firsts, "base")
    given = given.select("conv", F.explode("given").alias("t")).select("conv", "t.*").where(F.col("place") <= h)
    return turns.where(F.col("place") > h).unionByName(given.select(turns.columns)), members


@register("op12_prefix_trie")
def q_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = conv_trie.trie(*rebuilt(conv_trie.ordered_turns(table(spark, sf_dir, "conversations"))))
    return nodes.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"),
        "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


@register("op13_resampling")
def q_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    drawn = resampling.resample(docs, target, percent=5, min_words=20, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
