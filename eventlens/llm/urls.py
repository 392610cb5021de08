"""URL filters: fixed host/path rules, then association rules mined from labels.

Mining: the tokens of a labelled page's url (host labels, path words, query keys)
and its label form a transaction.  Tokens that occur in exactly the same
transactions are one item (a template's words come together and would else
double the combinations with each word).  FP-growth finds the frequent combinations
of items, and rules "items, then bad" are kept by support, confidence and lift; a
rule is dropped if one with fewer of its items has no less confidence.
Matching: an inverted index has every rule under the tokens of its rarest item; a
url's tokens look rules up there, and a rule counts if the url has a token
of each of its items.  The rule of greatest confidence (then support, then fewest
items) gives the verdict block; no rule, allow.

Everything is DataFrame work: verdicts are found once per distinct url, joins
are left to the planner (sort-merge with skew splitting, or a broadcast if the
pruned rules are small at run time).  Defined cases: a null url, or one
without ``://``, has empty host and path and no tokens, so it is allowed; a page
with several labels counts as bad if one is; no labels, or none bad: no rules;
repeated rows get equal verdicts.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import stage_table

MIN_SUPPORT = 0.001
#: Labelled pages that a rule must have seen at least, however few there are.
MIN_PAGES = 10
MIN_CONFIDENCE = 0.6
MIN_LIFT = 1.5
BAD = "label=bad"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, or nulls; a rule fits its host and all subdomains."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = lambda r: ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
    return tuple(
        F.coalesce(*[F.when(fits(r), F.lit(value(r))) for r in ordered], F.lit(None).cast("string"))
        for value in (lambda r: r.text, lambda r: r.verdict)
    )


def tokens_of(url: Column) -> Column:
    """Distinct tokens: host labels and their parts, path words, query keys; numbers and single letters are left out."""
    def words(part: Column, mark: str) -> Column:
        found = F.filter(F.split(part, "[^\\p{L}\\p{N}]+"), lambda w: (F.length(w) > 1) & ~w.rlike("^[0-9]+$"))
        return F.transform(found, lambda w: F.concat(F.lit(mark), w))

    host = host_of(url)
    labels = F.transform(F.filter(F.split(host, "\\."), lambda w: F.length(w) > 1), lambda w: F.concat(F.lit("host:"), w))
    query = F.regexp_extract(_after_scheme(url), r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda kv: F.concat(F.lit("key:"), F.split(kv, "=")[0]))
    keys = F.filter(keys, lambda k: k != "key:")
    return F.array_distinct(F.concat(labels, words(host, "word:"), words(lower_ascii(path_of(url)), "path:"), keys))


def mine(
    pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
) -> DataFrame:
    """``tokens, groups, confidence, support, key``: pruned rules that lead to ``bad``.

    ``tokens`` names each item by its greatest token, ``groups`` has all tokens of each item, and ``key`` is one token of
    the rarest item (a row per such token).  ``pages (id, url)`` and ``labels (id, bad boolean)``.
    """
    spark = pages.sparkSession
    known = labels.where(F.col("bad").isNotNull()).groupBy("id").agg(F.max("bad").alias("bad"))
    rows = pages.where(F.col("url").isNotNull()).join(known, "id")
    rows = stage_table(spark, rows.select(F.uuid().alias("page"), "bad", tokens_of(F.col("url")).alias("tokens")), "labelled")
    n, n_bad = rows.agg(F.count("*"), F.count_if("bad")).first()
    if n_bad < MIN_PAGES:
        return spark.createDataFrame([], "tokens array<string>, groups array<array<string>>, confidence double, support double, key string")
    least = max(min_support, MIN_PAGES / n)
    # A token's pages, told by their number and the sums of two hashes.
    pairs = rows.select("page", F.explode("tokens").alias("token"))
    prints = [F.sum(F.xxhash64(F.lit(i), F.col("page")).cast("decimal(20,0)")).alias(f"p{i}") for i in (1, 2)]
    places = pairs.groupBy("token").agg(F.count("*").alias("freq"), *prints).where(F.col("freq") >= least * n)
    # Tokens of one item are all in one url, so an item has no more tokens than a url.
    items = places.groupBy("freq", "p1", "p2").agg(F.max("token").alias("item"), F.collect_list("token").alias("members"))
    items = stage_table(spark, items.select("item", "members", "freq"), "items")
    named = pairs.join(items.select(F.col("item").alias("token")), "token").groupBy("page").agg(F.collect_list("token").alias("items"))
    bad = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    baskets = rows.join(named, "page", "left").select(F.concat(F.coalesce("items", F.array().cast("array<string>")), bad).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(stage_table(spark, baskets, "baskets"))
    rules = model.associationRules.where((F.col("consequent")[0] == BAD) & (F.col("lift") >= min_lift))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    parts = rules.select("*", F.explode("tokens").alias("item")).join(items, "item")
    rules = parts.groupBy("tokens", "confidence", "support").agg(
        F.min_by("item", F.struct("freq", "item")).alias("rarest"), F.min_by("members", F.struct("freq", "item")).alias("keys"),
        F.collect_list("members").alias("groups"),
    )
    rules = stage_table(spark, rules, "rules")
    shorter = rules.select(F.col("rarest").alias("item"), F.col("tokens").alias("less"), F.col("confidence").alias("sure"))
    beaten = rules.select("tokens", "confidence", F.explode("tokens").alias("item")).join(shorter, "item").where(
        (F.size("less") < F.size("tokens")) & (F.col("sure") >= F.col("confidence")) & (F.size(F.array_except("less", "tokens")) == 0)
    )
    kept = rules.join(beaten.select("tokens").distinct(), "tokens", "left_anti")
    return stage_table(spark, kept.select("tokens", "groups", "confidence", "support", F.explode("keys").alias("key")), "kept")


def judge(pages: DataFrame, mined: DataFrame, rules: list[Rule]) -> DataFrame:
    """``pages`` (``id, url``) with ``host, path, rule, verdict, mined`` (the items of the mined rule that decided)."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, by_rule = longest_rule(rules, F.col("host"), F.col("path"))
    rows = pages.select("id", "url", host.alias("host"), path.alias("path")).select("*", rule.alias("rule"), by_rule.alias("by_rule"))
    open_urls = rows.where(F.col("rule").isNull() & F.col("url").isNotNull()).select("url").distinct()
    looked_up = open_urls.select("url", tokens_of(F.col("url")).alias("has")).select("*", F.explode("has").alias("key")).join(mined, "key")
    matched = looked_up.where(F.forall("groups", lambda g: F.arrays_overlap(g, F.col("has"))))
    best = matched.groupBy("url").agg(
        F.max_by("tokens", F.struct("confidence", "support", -F.size("tokens"), F.array_join(F.array_sort("tokens"), " "))).alias("mined")
    )
    out = rows.join(best, "url", "left")
    verdict = F.coalesce("by_rule", F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("id", "url", "host", "path", "rule", verdict.alias("verdict"), F.array_sort("mined").alias("mined"))
