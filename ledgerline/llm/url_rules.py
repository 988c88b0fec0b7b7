"""URL filters: stated rules first, then association rules mined from labelled urls.

A url becomes a set of tokens (scheme, host suffixes, path words, query names).  Spark's FP-growth
mines token combinations over the labelled urls, with the label as one more token; combinations
that imply "bad" with enough support, confidence and lift are kept, and a rule that a shorter one
implies at no less confidence is pruned.  An inverted index holds each rule under its rarest token;
a url meets the rules of its tokens and is blocked if all tokens of one are among its own.

Stated rules (verdict, host, path) fit their host and its subdomains, if the url's path starts with
the rule's; the longest wins and overrules the mined ones.

Defined cases: a null url, or one without ``://``, has an empty host and path and no tokens, fits no
rule, and is allowed; null labels don't count; a page labelled more than once is bad if any of its
labels is; without labels nothing is mined; repeated rows each get their result; other columns are
ignored.  Rules are mined from at most about ``SAMPLE_ROWS`` labelled pages, drawn by hash, as FP-growth
gathers the pages of a frequent token in one task; every url is judged.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, checked_broadcast, staged

BAD = "label=bad"
MIN_SUPPORT = 0.002
MIN_COUNT = 20  # labelled urls that a rule must rest on, however few there are
SAMPLE_ROWS = 500_000  # labelled pages that rules are mined from
SEED = 17
MIN_LIFT = 1.5


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


STATED_RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a url; none without a host.  Numbers in paths are one token."""
    host, path = url_host(url), url_path(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")),
    )
    words = F.transform(
        F.filter(F.split(F.lower(path), r"[^\p{L}\p{N}]+"), lambda w: w != ""),
        lambda w: F.concat(F.lit("path="), F.when(w.rlike(r"^\p{N}+$"), F.lit("0")).otherwise(w)),
    )
    parts = F.transform(F.split(host, r"[^\p{L}\p{N}]+"), lambda w: F.concat(F.lit("word="), w))
    query = F.split(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), "&")
    names = F.transform(
        F.filter(query, lambda q: q != ""), lambda q: F.concat(F.lit("query="), F.substring_index(q, "=", 1))
    )
    scheme = F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))))
    tokens = F.array_distinct(F.concat(scheme, suffixes, words, parts, names))
    return F.when(url.isNotNull() & (host != ""), tokens).otherwise(F.array().cast("array<string>"))


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float | None = None,
    min_lift: float = MIN_LIFT,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """``labelled``: url, bad (boolean).  Returns rule (id), tokens, key (the rarest token),
    confidence, support.  Unless given, the least confidence follows from the share of bad urls: ``min_lift``
    times it, but no more than half way from it to 1."""
    spark = labelled.sparkSession
    tokens = labelled.where("bad is not null").select("bad", url_tokens(F.col("url")).alias("tokens")).where(F.size("tokens") > 0)
    items = F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens"))
    items = staged(tokens.select(items.alias("items"), "tokens"), "url_items")
    empty = spark.createDataFrame([], "rule long, tokens array<string>, key string, confidence double, support double")
    n, bad = items.agg(F.count(F.lit(1)), F.count_if(F.array_contains("items", BAD))).first()
    if bad < min_count:
        return empty
    base = bad / n
    if min_confidence is None:
        min_confidence, min_lift = min(min_lift * base, (1 + base) / 2), 1.0
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, min_count / n), minConfidence=min_confidence, numPartitions=tasks).fit(items)
    rules = staged(
        model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
        .where(F.col("lift") >= min_lift)
        .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
        .withColumn("rule", F.xxhash64("tokens")),
        "url_rules",
    )
    if rules.isEmpty():
        return empty
    # a rule goes if one of its parts says the same at no less confidence; parts are met by a shared token
    parts = rules.select(F.col("rule").alias("part"), F.col("tokens").alias("part_tokens"), F.col("confidence").alias("part_confidence"))
    implied = (
        rules.withColumn("token", F.explode("tokens"))
        .join(parts.withColumn("token", F.element_at("part_tokens", 1)), "token")
        .where(F.size("part_tokens") < F.size("tokens"))
        .where(F.forall("part_tokens", lambda t: F.array_contains("tokens", t)))
        .where(F.col("part_confidence") >= F.col("confidence"))
        .select("rule")
        .distinct()
    )
    kept = rules.join(implied, "rule", "left_anti")
    seen = items.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        kept.select("rule", F.explode("tokens").alias("token"))
        .join(seen, "token")
        .groupBy("rule")
        .agg(F.min_by("token", F.struct("n", "token")).alias("key"))
    )
    return kept.join(rarest, "rule").select("rule", "tokens", "key", "confidence", "support")


def stated_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest stated rule that fits, as its text; else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.text)).otherwise(out)
    return out


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[UrlRule] = STATED_RULES, **mining) -> DataFrame:
    """``pages`` (page_id, url) -> page_id, host, path, rule, verdict, confidence (of the best mined
    rule that fits, else null)."""
    mined = checked_broadcast(staged(mine_rules(labelled, **mining), "url_mined"))
    urls = pages.select("page_id", "url")
    blocked = (
        urls.select("url").where("url is not null")
        .withColumn("tokens", url_tokens(F.col("url")))
        .select("url", "tokens", F.explode("tokens").alias("key"))
        .join(mined.withColumnRenamed("tokens", "rule_tokens"), "key")
        .where(F.forall("rule_tokens", lambda t: F.array_contains("tokens", t)))
        .groupBy("url")
        .agg(F.max("confidence").alias("confidence"))
    )
    texts = {r.text: r.verdict for r in rules}
    by_rule = F.lit(None).cast("string")
    for text, verdict in texts.items():
        by_rule = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(by_rule)
    mined_verdict = F.when(F.col("confidence").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return (
        urls.join(blocked, "url", "left")
        .withColumn("host", url_host(F.col("url")))
        .withColumn("path", url_path(F.col("url")))
        .withColumn("rule", stated_rule(F.col("host"), F.col("path"), rules))
        .withColumn("verdict", F.coalesce(by_rule, mined_verdict))
        .select("page_id", "host", "path", "rule", "verdict", "confidence")
    )


def labelled_pages(pages: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """url, bad of the pages that ``labels`` covers (a page's id is its label's doc_id): bad is low
    quality or toxic.  Of more than ``sample_rows`` such pages, about so many are drawn by a hash of the id."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    given = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    known = given.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(bad).alias("bad"))
    found = staged(pages.select("page_id", "url").join(known, "page_id"), "url_labelled")
    share = min(1.0, sample_rows / max(1, found.count()))
    drawn = F.pmod(F.xxhash64(F.lit(SEED), "page_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    return found.where(drawn).select("url", "bad")
