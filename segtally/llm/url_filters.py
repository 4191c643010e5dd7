"""URL filters: pattern rules found by their rarest literal token.

A rule is a regular expression over host and path (the text host || path, where
the host is in lower case) with the literal tokens that every url it fits holds
whole, one list for each branch of an alternation. Tokens of urls, cut at ".", "/"
and "-", are counted over all urls; each branch is indexed under its token that the
fewest urls hold. A url's tokens fetch the rules indexed under them, and only those
run their regular expressions. Rules without a whole token, as those that ask for
the beginning of a label only, are indexed under "", a token that every url has.

Each distinct url is judged once; urls of many rows come back by a join that
adaptive execution splits. Of the rules that fit, those written as host and path
come before patterns, then the longest wins, then block before allow, then order
of the text.

Defined cases: a null url, or one without "://", has empty host and path; no rule
fits it and its verdict is allow, the method's verdict where nothing fits; repeated
rows are judged alike; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import lower_ascii

#: (verdict, host and path) of the contract.
HOST_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
#: (verdict, pattern, literal tokens of each branch) that give the method's own verdict where no host rule fits.
PATTERNS = [("block", r"^(?:[^/]*\.)?adult-[^./]*\.", [["adult"]]), ("block", r"^(?:[^/]*\.)?(?:casino|porn)[^./]*\.", []), ("block", r"/(?:login|signup)(?:/|$)", [["login"], ["signup"]])]
#: More rules than this are joined by a shuffle; fewer are sent to every executor (1,000 bytes a rule at most).
BROADCAST_RULES = 20_000


def host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens(place: Column) -> Column:
    """Labels of the host and segments of the path, cut at dashes too, once each."""
    return F.array_distinct(F.split(place, r"[./-]"))


def rules(spark: SparkSession, host_rules=HOST_RULES, patterns=PATTERNS) -> DataFrame:
    """rule, verdict, regex, tokens, kind (0: host and path, 1: pattern), branch: a row for each branch of a rule."""
    made = []
    for verdict, rule in host_rules:
        h, slash, p = rule.partition("/")
        whole = re.split("[./-]", h + "/" + p.rpartition("/")[0])
        made.append((rule, verdict, rf"^(?:[^/]*\.)?\Q{rule}\E" if slash else rf"^(?:[^/]*\.)?\Q{rule}\E(?:/|$)", [x for x in whole if x], 0, 0))
    made += [(pattern, verdict, pattern, words, 1, k) for verdict, pattern, branches in patterns for k, words in enumerate(branches or [[]])]
    return spark.createDataFrame(made, "rule string, verdict string, regex string, tokens array<string>, kind int, branch int")


def judge(pages: DataFrame, rule_table: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern for every row of pages."""
    small = F.broadcast if rule_table.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else lambda df: df
    urls = pages.select("url").where(F.col("url").isNotNull()).distinct()
    urls = urls.select("url", F.concat(host("url"), path("url")).alias("place")).where("place != ''").select("url", "place", F.explode(F.array_distinct(F.concat(tokens(F.col("place")), F.array(F.lit(""))))).alias("token"))
    literal = rule_table.select(F.explode("tokens").alias("token")).distinct()
    counts = urls.join(small(literal), "token").groupBy("token").count()
    rarest = (
        rule_table.select("rule", "kind", "branch", F.explode_outer("tokens").alias("token")).join(small(counts), "token", "left")
        .groupBy("rule", "kind", "branch").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    )
    index = rule_table.drop("tokens").join(small(rarest), ["rule", "kind", "branch"]).withColumn("token", F.coalesce("token", F.lit("")))
    best = (
        urls.join(small(index), "token").where(F.expr("place rlike regex"))
        .groupBy("url").agg(F.min(F.struct("kind", (-F.length("rule")).alias("_long"), F.col("verdict") == "allow", "rule", "verdict")).alias("best"))
    )
    return pages.select("page_id", "url").join(best, "url", "left").select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        F.when(F.col("best.kind") == 0, F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("best.kind") == 1, F.col("best.rule")).alias("pattern"),
    )


SQL = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
r(rule, h, p, v) AS (VALUES ('com/en/', 'com', '/en/', 'block'), ('example.com/en/7', 'example.com', '/en/7', 'allow'), ('net/de/', 'net', '/de/', 'allow'),
                     ('example.net/de/8', 'example.net', '/de/8', 'block'), ('org/es/', 'org', '/es/', 'block')),
q(pattern, v) AS (VALUES ('^(?:[^/]*\.)?adult-[^./]*\.', 'block'), ('^(?:[^/]*\.)?(?:casino|porn)[^./]*\.', 'block'), ('/(?:login|signup)(?:/|$)', 'block')),
f AS (SELECT p.*, (SELECT max_by(struct_pack(rule := rule, v := v), length(rule)) FROM r WHERE (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p)) AS fit,
             (SELECT max_by(pattern, length(pattern)) FROM q WHERE regexp_matches(p.host || p.path, q.pattern)) AS pat FROM p)
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.v, CASE WHEN pat IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN fit IS NULL THEN pat END AS pattern FROM f
"""
