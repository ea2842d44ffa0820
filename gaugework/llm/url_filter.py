"""URL filters by association rules over URL tokens.

Stated rules (host and path start) decide first. For the rest, Spark's FP-growth mines combinations of URL
tokens that go with a label, allow or block, in labelled URLs. The rules mined are kept if their support,
confidence and lift are high enough, and indexed by the rarest token of their condition: a URL's
tokens meet that inverted index in one join, the rest of the condition is checked on the URL's
token set, and the best rule decides (confidence, support, shortest condition, then order of text). A URL
that no rule meets is allowed.

Tokens are the domain suffixes of the host, the path segments with their depth, and the query's keys, from any place
of a URL and of any number. What is mined is made small without losing a verdict:

- tokens of fewer than ``LEAST_URLS`` labelled URLs, or less than the support, cannot be in a rule;
- a token that goes with one label alone is a rule by itself, which outranks every longer rule with it;
- tokens that occur in exactly the same URLs (the suffixes of a host, say) are mined as one, named by the shortest.

What is left is inherent to FP-growth: its work follows the number of frequent sets of undecided tokens.

Edge cases: a null URL or one without ``://`` has an empty host and path, meets no rule and is allowed. Equal
URLs get equal verdicts; repeated rows are rows; null ids stay null. Without labels, or with one label only, nothing is
mined. An empty table gives an empty result. URLs are taken whole. Extra columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from gaugework.llm.common import LOWER, UPPER, written
from gaugework.session import broadcast_if_small

ALLOW, BLOCK = "allow", "block"
#: Least support of a rule: a share of the labelled URLs, and a number of them.
SUPPORT = 0.002
LEAST_URLS = 10
CONFIDENCE = 0.9
LIFT = 1.05
_LABEL = "label="


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


#: The stated rules of the registered query.
RULES = (
    Rule("net/", BLOCK),
    Rule("example.net/en/", ALLOW),
    Rule("example.com/de/", BLOCK),
    Rule("org/fr/", ALLOW),
)


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def stated(host_: Column, path_: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest stated rule that fits, else null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host_ == rule.host) | host_.endswith("." + rule.host)) & path_.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL."""
    names = F.split(host(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(names)), lambda i: F.concat(
        F.lit("host="), F.concat_ws(".", F.slice(names, F.size(names) - i + 1, i))))
    parts = F.array_remove(F.split(path(url), "/"), "")
    segments = F.transform(parts, lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), s))
    query = F.coalesce(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), F.lit(""))
    keys = F.transform(F.array_remove(F.split(query, "&"), ""), lambda p: F.concat(F.lit("key="), F.substring_index(p, "=", 1)))
    return F.array_distinct(F.concat(suffixes, segments, keys))


def mine(labelled: DataFrame, url_col: str = "url", label_col: str = "label", support: float = SUPPORT,
         confidence: float = CONFIDENCE, lift: float = LIFT, least_urls: int = LEAST_URLS) -> DataFrame:
    """Written table of rules (token, condition, verdict, confidence, support): ``token`` is the rarest of ``condition``."""
    known = labelled.filter(F.col(url_col).contains("://") & F.col(label_col).isin(ALLOW, BLOCK))
    named = written(known.select(F.monotonically_increasing_id().alias("row"), F.col(label_col).alias("label"), tokens(F.col(url_col)).alias("tokens")), "url-items")
    of_label = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    total = sum(of_label.values())
    least = max(least_urls, math.ceil(support * total))
    share = F.lit(None).cast("double")
    for name, n in of_label.items():
        share = F.when(F.col("verdict") == name, n / total).otherwise(share)
    each = named.select("row", "label", F.explode("tokens").alias("token"))
    blocked = F.sum((F.col("label") == BLOCK).cast("long"))
    rows = [F.bit_xor(F.xxhash64("row", F.lit(i))).alias(f"rows_{i}") for i in range(2)]  # names the set of rows
    single = written(each.groupBy("token").agg(F.count(F.lit(1)).alias("freq"), blocked.alias("blocked"), *rows).filter(F.col("freq") >= least), "url-tokens")
    pure = single.filter((F.col("blocked") == 0) | (F.col("blocked") == F.col("freq"))).select(
        F.array("token").alias("condition"), F.when(F.col("blocked") == 0, ALLOW).otherwise(BLOCK).alias("verdict"),
        F.lit(1.0).alias("confidence"), (F.col("freq") / F.lit(max(total, 1))).alias("support"))
    undecided = single.filter((F.col("blocked") > 0) & (F.col("blocked") < F.col("freq")))
    items = undecided.groupBy("freq", "blocked", "rows_0", "rows_1").agg(
        F.min(F.struct(F.length("token"), "token"))["token"].alias("token")).select("token")
    baskets = each.join(broadcast_if_small(written(items, "url-items")), "token").groupBy("row", "label").agg(F.collect_list("token").alias("items"))
    baskets = written(baskets.select(F.array_append("items", F.concat(F.lit(_LABEL), F.col("label"))).alias("items")), "url-baskets")
    found, n = pure, baskets.count()
    if n >= least:
        # half a URL less than the least count, as the share is turned into a count again
        model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=confidence).fit(baskets)
        mined = model.associationRules.filter(F.col("consequent")[0].startswith(_LABEL)).select(
            F.array_sort("antecedent").alias("condition"), F.substring_index(F.col("consequent")[0], "=", -1).alias("verdict"),
            "confidence", (F.col("support") * F.lit(n / total)).alias("support"))
        found = pure.unionByName(mined)
    rules = written(found.filter((F.col("confidence") >= confidence) & (F.col("confidence") >= lift * share)), "url-rules")
    key = ["condition", "verdict", "confidence", "support"]
    rarest = rules.select(*key, F.explode("condition").alias("token")).join(single.select("token", "freq"), "token").groupBy(*key).agg(
        F.min(F.struct("freq", "token")).alias("rarest"))
    return written(rarest.select(F.col("rarest.token").alias("token"), *key), "url-index")


def judge(urls: DataFrame, index: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule (stated rule or null), verdict, by (stated, mined or default)."""
    index = broadcast_if_small(index)
    url = F.col("url")
    base = urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select(
        "id", host(url).alias("host"), path(url).alias("path"), tokens(url).alias("tokens"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("stated", stated(F.col("host"), F.col("path"), rules))
    base = base.select("id", "host", "path", "row", F.col("stated.rule").alias("rule"), F.col("stated.verdict").alias("stated_verdict"), "tokens")
    # rows that a stated rule decides bring one empty token, so they stay and match nothing
    exploded = base.select("*", F.explode_outer(F.when(F.col("rule").isNull(), F.col("tokens"))).alias("own"))
    meets = (F.col("own") == index["token"]) & (F.size(F.array_except(index["condition"], F.col("tokens"))) == 0)
    met = F.when(F.col("token").isNotNull(), F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("condition").alias("n"), "condition", F.col("verdict").alias("v")))
    best = exploded.join(index, meets, "left").groupBy("row", "id", "host", "path", "rule", "stated_verdict").agg(F.min(met)["v"].alias("mined"))
    return best.select(
        "id", "host", "path", "rule", F.coalesce("stated_verdict", "mined", F.lit(ALLOW)).alias("verdict"),
        F.when(F.col("rule").isNotNull(), "stated").when(F.col("mined").isNotNull(), "mined").otherwise("default").alias("by"),
    )


def labelled_pages(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(url, label) for mining: the URLs that a stated rule decides, with its verdict."""
    verdict = stated(host(F.col("url")), path(F.col("url")), rules)["verdict"]
    return pages.select("url", verdict.alias("label")).filter("label IS NOT NULL")
