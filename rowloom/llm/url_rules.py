"""URL filters: given host rules first, else combinations of URL tokens mined by FP-growth."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import ascii_lower
from rowloom.plans.scratch import materialize

BLOCK, ALLOW = "block", "allow"
#: Rules as (rule, verdict); a rule is a host, then a slash and the start of a path.
RULES = (
    ("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK),
    ("com/fr/", ALLOW), ("com/de/", BLOCK),
)
#: A mined rule holds in at least this share of the labelled pages, and in so many at least.
MIN_SUPPORT = 0.002
MIN_PAGES = 15
#: Of the pages that have all its tokens, so many are bad, and so many times the usual share.
MIN_CONFIDENCE = 0.5
MIN_LIFT = 1.5
BAD = "=bad"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    at = F.coalesce(F.position(F.lit("://"), url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return ascii_lower(host), path


def given_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, else null.

    The rules are a short list given by the caller, so they are one expression.
    """
    tests = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, _, start = rule.partition("/")
        on_host = (host == name) | F.endswith(host, F.lit("." + name))
        fits = on_host & F.startswith(path, F.lit("/" + start))
        tests.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*tests)


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: scheme, host and its domain, path segments, query keys, fragment.

    Digits in a segment are replaced by their number, so that ids form a shape.
    """
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    shape = lambda s: F.regexp_replace(s, "^[0-9]+", "#")
    keys = F.regexp_extract_all(url, F.lit(r"[?&]([^=&#]+)="), F.lit(1))
    return F.array_distinct(F.filter(F.concat(
        F.array(F.concat(F.lit("scheme="), ascii_lower(F.substring_index(url, "://", 1)))),
        F.array(F.concat(F.lit("host="), host)),
        F.array(F.concat(F.lit("domain="), F.substring_index(host, ".", -2))),
        F.array(F.concat(F.lit("sub="), F.element_at(labels, 1))),
        F.transform(segments, lambda s: F.concat(F.lit("path="), shape(s))),
        F.transform(keys, lambda k: F.concat(F.lit("key="), k)),
        F.when(F.contains(url, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    ), lambda t: t.isNotNull()))


def labelled_baskets(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``items``: the tokens of a labelled page, and a mark if its document is of low quality or toxic.

    A page shows the document whose id is the last number of its path.
    """
    host, path = parts(F.col("url"))
    known = pages.select(
        F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1).try_cast("long").alias("_doc"),
        tokens(F.col("url"), host, path).alias("_tokens"),
    ).where("_doc is not null")
    bad = labels.select(
        F.col("doc_id").alias("_doc"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("_bad")
    ).where("_doc is not null").groupBy("_doc").agg(F.max(F.coalesce("_bad", F.lit(False))).alias("_bad"))
    marked = F.when(F.col("_bad"), F.array_append("_tokens", BAD)).otherwise(F.col("_tokens"))
    return known.join(bad, "_doc").select(marked.alias("items"))


def mine(baskets: DataFrame) -> DataFrame:
    """``tokens, confidence, lift, support``: token combinations that tell of bad pages.

    A rule is dropped where one of fewer tokens, all among its own, is as
    confident.  Support bounds the number of frequent tokens and combinations
    whatever the number of pages.
    """
    baskets = materialize(baskets, "url-baskets")
    n = baskets.count()
    schema = "tokens array<string>, confidence double, lift double, support double"
    if n < MIN_PAGES:
        return baskets.sparkSession.createDataFrame([], schema)
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, max(MIN_SUPPORT, MIN_PAGES / n)),
        minConfidence=MIN_CONFIDENCE,
    ).fit(baskets)
    found = model.associationRules.where(
        (F.element_at("consequent", 1) == BAD) & (F.col("lift") >= MIN_LIFT)
    )
    return materialize(found.select(
        F.sort_array("antecedent").alias("tokens"), "confidence", "lift", "support"
    ), "url-rules")


def pruned(rules: DataFrame) -> DataFrame:
    """Rules without those that a shorter and as confident rule covers; each with the token that indexes it."""
    a, b = rules.alias("a"), rules.select(
        F.col("tokens").alias("less"), F.col("confidence").alias("other"), F.element_at("tokens", 1).alias("first")
    ).alias("b")
    covered = a.select("*", F.explode("tokens").alias("first")).join(b, "first").where(
        (F.size("less") < F.size("tokens")) & (F.col("other") >= F.col("confidence"))
        & (F.size(F.array_except("less", "tokens")) == 0)
    )
    left = rules.join(covered.select("tokens").distinct(), "tokens", "left_anti")
    uses = left.select(F.explode("tokens").alias("token")).groupBy("token").count()
    index = left.select("*", F.explode("tokens").alias("token")).join(uses, "token")
    return index.groupBy("tokens").agg(
        F.first("confidence").alias("confidence"), F.min(F.struct("count", "token"))["token"].alias("token")
    )


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, confidence``: URLs that have all tokens of a rule, with the highest confidence.

    The inverted index holds each rule once, under its rarest token: a
    URL meets only rules of its own tokens, then the whole combination is tested.
    """
    postings = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    index = rules.select("token", F.col("tokens").alias("_rule"), "confidence")
    hits = postings.join(index, "token").where(F.size(F.array_except("_rule", "tokens")) == 0)
    return hits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(
    pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str], ...] = RULES
) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence`` for every row of ``pages``.

    A given rule decides where one fits; else the page is blocked if a mined
    rule matches, and ``confidence`` is that rule's.  Null URLs and URLs without
    ``://`` have no host, path or rule and are allowed.  Repeated rows are
    judged alike and all returned; null labels count as good.  Without labels
    or pages nothing is mined.
    """
    mined = materialize(pruned(mine(labelled_baskets(pages, labels))), "url-index")
    url = F.col("url")
    host, path = parts(url)
    urls = pages.select("url").where("url is not null").distinct()
    urls = urls.select("url", tokens(url, host, path).alias("tokens"))
    blocked = matched(urls, mined)
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    ruled = rows.select("*", given_rule(F.col("host"), F.col("path"), rules).alias("given"))
    method = F.when(F.col("confidence").isNotNull(), BLOCK).otherwise(ALLOW)
    return ruled.join(blocked, "url", "left").select(
        "page_id", "host", "path", F.col("given.rule").alias("rule"),
        F.coalesce(F.col("given.verdict"), method).alias("verdict"), "confidence",
    )
