"""URL filtering by a policy of host and path rules, and by association rules mined from labelled URLs.

DataFrame operations only. FP-growth finds the token combinations that are frequent among labelled URLs;
those that make the bad label likely enough become rules. A rule is filed in an inverted index under its
rarest token, so that a URL meets only rules that share such a token, and is then compared whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.sources.workspace import stage

#: (host, path, verdict): a rule fits its host and all subdomains where the path starts with its path.
POLICY = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(.*)$"
BAD, GOOD = "label:bad", "label:good"


def url_part(url: Column, number: int) -> Column:
    """Part of a URL: 1 scheme, 2 host, 3 path, 4 query and fragment; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, PARTS, number), F.lit(""))


def host_of(url: Column) -> Column:
    """Host with A-Z lower-cased."""
    return F.translate(url_part(url, 2), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def policy_rule(host: Column, path: Column, policy: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct (length, rule, verdict); NULL if none fits."""
    rules = F.array(
        *[
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path"))
            for h, p, v in policy
        ]
    )
    fits = lambda r: F.endswith(F.concat(F.lit("."), host), F.concat(F.lit("."), r["host"])) & F.startswith(path, r["path"])
    return F.array_max(F.filter(rules, fits))


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, host labels, registered name, path words without numbers, query items, fragment."""
    host, path, rest = host_of(url), url_part(url, 3), url_part(url, 4)
    labels = F.split(host, r"\.")
    words = F.filter(F.split(F.lower(path), r"[/._\-]+"), lambda w: (w != "") & ~w.rlike("^[0-9]+$"))
    query = F.filter(F.split(F.regexp_extract(rest, r"^\?([^#]*)", 1), "&"), lambda w: w != "")
    fragment = F.regexp_extract(rest, r"#(.+)$", 1)
    tagged = lambda tag, words: F.transform(words, lambda w: F.concat(F.lit(f"{tag}:"), w))
    tokens = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.lower(url_part(url, 1)))),
        tagged("host", F.filter(labels, lambda w: w != "")),
        F.array(F.concat(F.lit("site:"), F.array_join(F.slice(F.concat(F.array(F.lit(""), F.lit(""), F.lit("")), labels), -3, 3), "."))),
        tagged("path", words),
        tagged("query", query),
        F.when(fragment != "", F.array(F.concat(F.lit("fragment:"), fragment))).otherwise(F.array().cast("array<string>")),
    )
    return F.when(url.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(tokens))


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(``url``, ``bad``) of pages whose document is labelled: bad if of low quality or toxic.

    The last number in a URL's path names the document. A document labelled more than once is bad if any
    label says so; NULL labels say nothing.
    """
    number = F.regexp_extract(url_part(F.col("url"), 3), r"(?s)^.*?([0-9]{1,18})[^0-9]*$", 1)
    numbered = pages.select("url", number.try_cast("bigint").alias("page_doc"))
    bad = labels.groupBy(F.col("doc_id").alias("page_doc")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return numbered.join(bad.where("bad IS NOT NULL"), "page_doc").select("url", "bad")


RULES = (
    "rule_id long, tokens array<string>, confidence double, lift double, support double, rarest string, "
    "choices array<struct<token: string, members: array<string>>>"
)


def mine_rules(
    labelled: DataFrame,
    min_support: float = 0.001,
    min_count: int = 30,
    min_confidence: float = 0.5,
    min_lift: float = 1.5,
) -> DataFrame:
    """Rules from (``url``, ``bad``): ``rule_id``, ``tokens``, ``confidence``, ``lift``, ``support``, ``rarest``, ``choices``.

    A combination must occur in a share ``min_support`` of all labelled URLs and in ``min_count`` of them,
    be followed by the bad label with ``min_confidence``, and ``min_lift`` times as often as URLs are bad.
    A rule that says no more than a shorter one within it is dropped. No labelled URL gives no rules.

    Tokens that occur in exactly the same labelled URLs are mined as one, so that the many tokens of a URL that
    occurs often make one item and not a combination for each of their subsets. Any one of them says as much as
    all, so a rule fits a URL that has one of each of its ``choices``; ``tokens`` names each choice by its first token.
    """
    baskets = stage(
        labelled.where("url IS NOT NULL").select(
            F.monotonically_increasing_id().alias("basket"),
            url_tokens(F.col("url")).alias("tokens"),
            F.when(F.col("bad"), BAD).otherwise(GOOD).alias("label"),
        ),
        "baskets",
    )
    count = baskets.count()
    # Half an occurrence below the least count, so that rounding cannot raise it.
    least = max(math.ceil(min_support * count), min_count)
    support = (least - 0.5) / max(count, 1)
    if support > 1:
        return labelled.sparkSession.createDataFrame([], RULES)
    classes = stage(token_classes(baskets, least), "token-classes")
    named = classes.select("token", F.explode("members").alias("member"))
    held = baskets.select("basket", F.explode("tokens").alias("member")).join(named, "member")
    held = held.groupBy("basket").agg(F.collect_set("token").alias("items"))
    # A basket without a frequent token still counts.
    items = stage(
        baskets.join(held, "basket", "left").select(
            F.concat(F.coalesce("items", F.array().cast("array<string>")), F.array("label")).alias("items")
        ),
        "items",
    )
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    mined = stage(
        model.associationRules.where((F.element_at("consequent", 1) == BAD) & (F.col("lift") >= min_lift))
        .where(~F.array_contains("antecedent", GOOD))
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "lift", "support"),
        "rules",
    )
    # Each rule is filed under its rarest token; a shorter rule that is as sure makes it needless.
    alone = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), "freq")
    filed = (
        mined.withColumn("token", F.explode("tokens"))
        .join(alone, "token")
        .groupBy("tokens", "confidence", "lift", "support")
        .agg(F.min_by("token", F.struct("freq", "token")).alias("rarest"))
    )
    inner = filed.select(F.col("tokens").alias("short"), F.col("confidence").alias("short_confidence"), F.col("rarest").alias("token"))
    covered = (
        filed.withColumn("token", F.explode("tokens"))
        .join(inner, "token")
        .where((F.size("short") < F.size("tokens")) & (F.col("short_confidence") >= F.col("confidence")))
        .where(F.size(F.array_except("short", "tokens")) == 0)
        .select("tokens")
    )
    kept = filed.join(covered, "tokens", "left_anti")
    choices = kept.select("tokens", F.explode("tokens").alias("token")).join(classes, "token")
    choices = choices.groupBy("tokens").agg(F.collect_list(F.struct("token", "members")).alias("choices"))
    kept = kept.join(choices, "tokens").withColumn("rule_id", F.xxhash64("tokens"))
    return stage(kept.select("rule_id", "tokens", "confidence", "lift", "support", "rarest", "choices"), "kept-rules")


def token_classes(baskets: DataFrame, least: int) -> DataFrame:
    """Tokens of at least ``least`` baskets, those of the same baskets together: ``token`` (the first) and ``members``.

    The baskets of a token are told by their number and by two sums over independent hashes of their ids.
    """
    each = baskets.select("basket", F.explode("tokens").alias("token"))
    marks = each.groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("basket")).alias("x"), F.sum(F.xxhash64(F.lit("+"), "basket").cast("decimal(20,0)")).alias("s")
    )
    same = marks.where(F.col("n") >= least).groupBy("n", "x", "s").agg(F.sort_array(F.collect_list("token")).alias("members"))
    return same.select(F.element_at("members", 1).alias("token"), "members")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct ``url`` that a rule fits: its surest rule (``rule_id``, ``confidence``)."""
    index = rules.select("rule_id", "confidence", F.col("choices.members").alias("needed"), F.explode("choices").alias("choice"), "rarest")
    index = index.where("choice.token = rarest").select(F.explode("choice.members").alias("token"), "rule_id", "needed", "confidence")
    tokens = urls.select("url").where("url IS NOT NULL").distinct().withColumn("tokens", url_tokens(F.col("url")))
    return (
        tokens.withColumn("token", F.explode("tokens"))
        .join(index, "token")
        .where(F.forall("needed", lambda choice: F.arrays_overlap(choice, F.col("tokens"))))
        .groupBy("url")
        .agg(F.max_by(F.struct("rule_id", "confidence"), F.struct("confidence", "rule_id")).alias("best"))
        .select("url", "best.rule_id", "best.confidence")
    )


def judge(pages: DataFrame, policy: Sequence[tuple[str, str, str]], rules: DataFrame) -> DataFrame:
    """A verdict for every page: the longest fitting policy rule's, else block if a mined rule fits, else allow.

    Result: ``page_id``, ``host``, ``path``, ``rule`` (of the policy, or NULL), ``verdict``, ``mined_rule`` (id
    of the surest mined rule that fits, or NULL). A URL that is NULL or has no ``://`` has an empty host and
    path, which no policy rule fits; a NULL URL has no tokens either, so it is allowed. Repeated rows are
    judged each, and extra columns are ignored. An empty table gives no rows.
    """
    rows = pages.select("page_id", "url")
    mined = match_rules(rows, rules).select(F.col("url").alias("mined_url"), F.col("rule_id").alias("mined_rule"))
    return (
        rows.join(mined, F.col("url") == F.col("mined_url"), "left")
        .withColumn("host", host_of(F.col("url")))
        .withColumn("path", url_part(F.col("url"), 3))
        .withColumn("fits", policy_rule(F.col("host"), F.col("path"), policy))
        .select(
            "page_id",
            "host",
            "path",
            F.col("fits.rule").alias("rule"),
            F.coalesce("fits.verdict", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"),
            "mined_rule",
        )
    )
