"""URL filters: stated host and path rules, and association rules mined from labelled pages.

FP-growth finds combinations of URL tokens that go with a bad label. Rules below
the least support or confidence are pruned; the rest is filed under its rarest
token, so a URL is compared only with rules that share that token. Only
DataFrame functions and Spark's own FP-growth.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeload.llm.common import written

BAD = "label=bad"
MIN_SHARE, MIN_COUNT, MIN_CONFIDENCE = 0.001, 5, 0.5


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for anything without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def tokens(url: Column) -> Column:
    """Distinct runs of letters and digits, lower-cased; an empty array for null."""
    split = F.split(ascii_lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+")
    return F.array_distinct(F.filter(split, lambda t: t != ""))


def stated_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``struct<rule, verdict>`` of the longest fitting ``(verdict, host, path)`` rule, or null."""
    fits = [
        F.when(
            ((host == h) | host.endswith(f".{h}")) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    if not fits:
        return F.lit(None).cast("struct<rule: string, verdict: string>")
    best = F.array_max(F.array(*fits))  # nulls are skipped
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def mine_rules(
    labelled: DataFrame, min_share: float = MIN_SHARE, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """``tokens array<string>, n long, n_bad long`` of the kept rules from ``url, bad`` rows.

    A rule needs ``max(min_count, min_share of all labelled)`` bad pages and a bad
    share of ``min_confidence`` or more, whatever its number of tokens. Rules
    that add no URL are not mined: a longer rule with a token that is a rule by
    itself, or with a token that all labelled pages hold and that changes no
    count. No labelled page gives no rule.
    """
    pages = written(labelled.select(tokens(F.col("url")).alias("held"), "bad"), "url-baskets")
    n = pages.count()
    if n == 0:
        return labelled.sparkSession.createDataFrame([], "tokens array<string>, n long, n_bad long")
    least = max(min_count, math.ceil(min_share * n))
    each = pages.select(F.explode("held").alias("token"), "bad").groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"))
    alone = written(each.where((F.col("n_bad") >= least) & (F.col("n_bad") >= F.col("n") * min_confidence)), "url-token-rules")
    singles = alone.select(F.array("token").alias("tokens"), "n", "n_bad")
    # a token whose own bad pages are too few is in no rule either
    useful = each.where((F.col("n_bad") >= least) & (F.col("n") < n)).join(alone, "token", "left_anti").select("token")
    posted = pages.select(F.monotonically_increasing_id().alias("page"), "held", "bad")
    posted = written(posted.select("page", "bad", F.explode("held").alias("token")), "url-tokens")
    baskets = posted.join(useful, "token").groupBy("page", "bad").agg(F.collect_list("token").alias("held"))
    baskets = baskets.select(F.when(F.col("bad"), F.array_append("held", F.lit(BAD))).otherwise(F.col("held")).alias("items"))
    baskets = written(baskets, "url-useful-baskets")
    size = baskets.count()
    if size == 0:
        return singles
    # the half keeps the product of share and count from rounding up to one more
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / size), minConfidence=min_confidence).fit(baskets).freqItemsets
    sets = found.select(F.sort_array(F.array_remove("items", BAD)).alias("tokens"), F.array_contains("items", BAD).alias("bad"), "freq")
    sets = sets.where(F.size("tokens") > 0)
    both = sets.groupBy("tokens").agg(
        F.max(F.when(~F.col("bad"), F.col("freq"))).alias("n"), F.max(F.when(F.col("bad"), F.col("freq"))).alias("n_bad")
    )
    longer = both.where((F.size("tokens") > 1) & (F.col("n_bad") >= F.col("n") * min_confidence))
    return singles.unionByName(longer)


def matching_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``url`` values that hold all tokens of some rule."""
    parts = rules.select(F.explode("tokens").alias("token"))
    weight = parts.groupBy("token").agg(F.count("*").alias("weight"))
    filed = rules.select("tokens", F.explode("tokens").alias("token")).join(weight, "token")
    # the token that the fewest rules hold; ties by name
    index = filed.groupBy("tokens").agg(F.min(F.struct("weight", "token"))["token"].alias("token"))
    distinct = urls.select("url").where(F.col("url").isNotNull()).distinct().withColumn("held", tokens(F.col("url")))
    posted = distinct.select("url", "held", F.explode("held").alias("token"))
    return posted.join(index, "token").where(F.size(F.array_except("tokens", "held")) == 0).select("url").distinct()


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page: a stated rule's verdict, else ``block`` if a mined rule matches.

    Null URLs have empty host and path and are allowed. Repeated URLs are judged
    once and joined back; the join can be split where one URL holds many rows.
    """
    matched = matching_urls(pages, mine_rules(labelled)).withColumn("matched", F.lit(True)).withColumnRenamed("url", "matched_url")
    host, path = host_and_path(F.col("url"))
    joined = pages.select("page_id", "url").join(matched, F.col("url") == F.col("matched_url"), "left")
    split = joined.select("page_id", "matched", host.alias("host"), path.alias("path"))
    ruled = split.withColumn("stated", stated_rule(F.col("host"), F.col("path"), rules))
    mined = F.when(F.col("matched"), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", F.col("stated.rule").alias("rule"), F.coalesce("stated.verdict", mined).alias("verdict"))
