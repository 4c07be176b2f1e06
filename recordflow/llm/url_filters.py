"""URL filters: fixed rules, and association rules mined from the pages that those label.

A url is the set of its tokens: host labels, path segments with digits read as
``#``, and query keys.  The fixed rules label the pages they fit; FP-growth
mines the token combinations of all labelled pages, and combinations that imply
a label with ``CONFIDENCE`` are kept unless a smaller one implies it as surely.
An inverted index lists each mined rule under its rarest token; a page looks up
its tokens there and checks the rest of each rule found.  The surest, then most
supported, then first rule by text decides; without one a page is allowed.

Edge cases: a url that is null or has no ``://`` has an empty host and path, no
tokens, and is allowed; repeated pages are judged alike; without labelled pages
no rule is mined; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from recordflow.llm.base import pick, saved

#: What each rule does to its host, that host's subdomains, and paths that start with its path.
RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
SUPPORT, CONFIDENCE = 0.002, 0.8
#: Mined rules that are sent to every task at most; more are joined by shuffle.
SENT_RULES = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(rule: str) -> Column:
    own_host, slash, own_path = rule.partition("/")
    named = (F.col("host") == own_host) | F.col("host").endswith("." + own_host)
    return named & F.col("path").startswith(slash + own_path)


def fixed_rule(rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        found = F.when(_fits(rule), F.lit(rule)).otherwise(found)
    return found


def tokens() -> Column:
    """Distinct tokens of ``host``, ``path`` and ``url``."""
    labels = F.transform(F.split("host", r"\."), lambda x: F.concat(F.lit("host:"), x))
    segments = F.transform(
        F.split(F.regexp_replace("path", "[0-9]+", "#"), r"[/.]"), lambda x: F.concat(F.lit("path:"), x)
    )
    query = F.coalesce(F.regexp_extract("url", r"^[^?#]*://[^?#]*\?([^#]*)", 1), F.lit(""))
    keys = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.split(x, "=")[0]))
    last = F.concat(F.lit("top:"), F.element_at(F.split("host", r"\."), -1))
    named = F.filter(F.concat(labels, segments, keys, F.array(last)), lambda x: ~x.endswith(":"))
    return F.array_distinct(named)


def _token_table(baskets: DataFrame, least: int) -> DataFrame:
    """token, n (pages), sure (its only verdict, else null), group (least token on just the same pages): tokens on enough pages of a verdict."""
    at = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "id"))
    per = baskets.select("id", "verdict", F.explode("tokens").alias("token")).groupBy("token", "verdict").agg(
        F.count(F.lit(1)).alias("n"), at(1).alias("x"), at(2).alias("y"))
    whole = per.groupBy("token").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("verdict", F.struct("n", "verdict")).alias("verdict"),
        F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    often = saved(whole.filter(F.col("most") >= least))
    same = ["n", "x", "y"]
    groups = often.groupBy(*same).agg(F.min("token").alias("group"))
    return saved(often.join(groups, same).select("token", "n", F.when(F.col("most") == F.col("n"), F.col("verdict")).alias("sure"), "group"))


def _rarest(rules: DataFrame, known: DataFrame) -> DataFrame:
    """The rules with ``rarest``, their token on the fewest pages, by which others look them up."""
    spread = rules.select("*", F.explode("rule_tokens").alias("token")).join(known.select("token", "n"), "token")
    return spread.groupBy(*rules.columns).agg(F.min_by("token", F.struct("n", "token")).alias("rarest"))


def _spelled_out(rules: DataFrame, known: DataFrame) -> DataFrame:
    """Each rule of group names as all rules with one token of each of its groups."""
    members = known.groupBy("group").agg(F.collect_list("token").alias("members"))
    parts = rules.select("*", F.explode("rule_tokens").alias("group")).join(members, "group")
    lists = parts.groupBy(*rules.columns).agg(F.collect_list("members").alias("lists"))
    longer = lambda made, more: F.flatten(F.transform(made, lambda m: F.transform(more, lambda t: F.array_append(m, t))))
    nothing = F.expr("array(cast(array() as array<string>))")
    combined = lists.withColumn("one", F.explode(F.aggregate("lists", nothing, longer)))
    return combined.select(F.array_sort("one").alias("rule_tokens"), *[c for c in rules.columns if c != "rule_tokens"])


def mine(labelled: DataFrame) -> DataFrame:
    """rule_tokens, verdict, confidence, support, rarest of the rules kept; ``labelled`` has tokens and verdict.

    Two kinds of tokens would fill FP-growth's table with combinations that are
    redundant anyway, and are taken out first.  A token that all its pages of
    one verdict share is a rule of confidence 1, so no longer rule needs it.
    Tokens on the very same pages (by 128 bits of hash) add nothing to each
    other: one stands for them all, and its rules are spelled out afterwards.
    """
    spark = labelled.sparkSession
    baskets = saved(labelled.select("tokens", "verdict", F.monotonically_increasing_id().alias("id")))
    ddl = "rule_tokens array<string>, verdict string, confidence double, support double, rarest string"
    pages = baskets.count()
    if not pages:
        return spark.createDataFrame([], ddl)
    known = _token_table(baskets, math.ceil(SUPPORT * pages))
    sure = known.filter("sure is not null").select(
        F.array("token").alias("rule_tokens"), F.col("sure").alias("verdict"), F.lit(1.0).alias("confidence"),
        (F.col("n") / pages).alias("support"), F.col("token").alias("rarest"))
    unsure = known.filter("sure is null")
    rows = baskets.select("id", "verdict", F.explode_outer("tokens").alias("token")).join(
        unsure.select("token", "group"), "token", "left")
    items = F.array_append(F.collect_set("group"), F.concat(F.lit("verdict:"), "verdict"))
    model = FPGrowth(itemsCol="items", minSupport=SUPPORT, minConfidence=CONFIDENCE).fit(
        saved(rows.groupBy("id", "verdict").agg(items.alias("items"))))
    implied = model.associationRules.filter(
        F.col("consequent")[0].startswith("verdict:") & ~F.exists("antecedent", lambda x: x.startswith("verdict:"))
    )
    rules = saved(_rarest(implied.select(
        F.array_sort("antecedent").alias("rule_tokens"), F.substring(F.col("consequent")[0], len("verdict:") + 1, 20).alias("verdict"),
        "confidence", "support",
    ), unsure))
    # a rule is redundant when some of its tokens imply the same as surely; such a smaller rule is found by its rarest token
    shorter = rules.select(F.col("rule_tokens").alias("sub"), F.col("verdict").alias("v"), F.col("confidence").alias("c"), F.col("rarest").alias("part"))
    less = rules.filter(F.size("rule_tokens") > 1).select("*", F.explode("rule_tokens").alias("part"))
    redundant = less.join(shorter, "part").filter(
        (F.col("verdict") == F.col("v")) & (F.col("c") >= F.col("confidence")) & (F.size("sub") < F.size("rule_tokens"))
        & (F.size(F.array_except("sub", "rule_tokens")) == 0)
    )
    kept = rules.join(redundant.select("rule_tokens", "verdict").distinct(), ["rule_tokens", "verdict"], "left_anti")
    return saved(_rarest(_spelled_out(kept.drop("rarest"), unsure), unsure).unionByName(sure))


def judge(pages: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, mined_rule for every row."""
    rules = RULES if rules is None else rules
    verdicts = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair]) if rules else F.lit(None).cast("map<string,string>")
    rows = pick(pages, "page_id", "url").select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.select("*", fixed_rule(rules).alias("rule"), tokens().alias("tokens")).withColumn("verdict", verdicts[F.col("rule")])
    rows = saved(rows.drop("url").withColumn("at", F.monotonically_increasing_id()))
    mined = mine(rows.filter(F.col("rule").isNotNull()))
    index = mined.select("rarest", F.col("verdict").alias("says"), "rule_tokens", "confidence", "support")
    if mined.count() <= SENT_RULES:
        index = F.broadcast(index)
    looked_up = rows.filter(F.col("rule").isNull()).select("at", "tokens", F.explode("tokens").alias("rarest")).join(index, "rarest")
    fitting = looked_up.filter(F.size(F.array_except("rule_tokens", "tokens")) == 0)
    best = fitting.groupBy("at").agg(
        F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "rule_tokens", "says")).alias("best")
    )
    judged = rows.join(best, "at", "left")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "best.says", F.lit("allow")).alias("verdict"),
        F.array_join("best.rule_tokens", " ").alias("mined_rule"),
    )
