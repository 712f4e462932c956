"""URL filters: a given rule list, and association rules mined by FP-growth where the list is silent.

Only DataFrame functions and Spark's FP-growth are used. A given rule (host, path) fits a URL if its host is the
rule's or a subdomain of it and its path begins with the rule's; the longest one decides.

URLs with a verdict from the list are the labelled ones. Their tokens (the last four host labels, first directory,
file ending, first query key) and the verdict make transactions; FP-growth finds the frequent combinations. Rules
from tokens to a verdict of enough confidence and support judge all other URLs, the most confident first. The support
is a share of the labelled rows (2%), so the floor grows with the table: a combination with a verdict in fewer rows
makes no rule, and URLs that fit no other rule get the default.

Both kinds of rules are matched by an inverted index: a given rule by its host, a mined one by its rarest token. A
URL is judged once, however many rows have it, so a hot host or URL is counted, not gathered. Nothing is broadcast.

Defined cases: null URLs and those without ``://`` have an empty host, path and no tokens and get the default; ties
go to the larger support, then the longer combination, then the last in text order; repeated rows each get the
verdict; without labelled URLs there are no mined rules; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakloom.llm.columns import unused, without
from peakloom.session import Scratch

MIN_SUPPORT, MIN_CONFIDENCE = 0.02, 0.8
VERDICT = "verdict="
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without it."""
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), *_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """At most seven distinct tokens, each marked with its place."""
    labels = F.reverse(F.split(host, "\\."))
    named = [F.get(labels, i) for i in range(4)]
    parts = [F.when(n != "", F.concat(F.lit(f"host{i}="), n)) for i, n in enumerate(named, 1)]
    directory = F.regexp_extract(path, "^/([^/]+)/", 1)
    ending = F.regexp_extract(path, "\\.([A-Za-z0-9]{1,5})$", 1)
    key = F.regexp_extract(url, "^[^?#]*[?]([^=&#]+)", 1)
    for name, value in (("dir", directory), ("ending", ending), ("query", key)):
        parts.append(F.when(value != "", F.concat(F.lit(f"{name}="), value)))
    return F.when(host != "", F.array_compact(F.array(*parts))).otherwise(F.array().cast("array<string>"))


def _with_list(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` with the longest rule (host, path, verdict) of the list that fits."""
    labels = F.split("host", "\\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    met = urls.where(F.col("host") != "").select("url", "path", F.explode(suffixes).alias("suffix"))
    listed = rules.select(
        F.col("host").alias("suffix"), F.col("path").alias("rule_path"), F.concat("host", "path").alias("rule"), "verdict"
    )
    fitting = met.join(listed, "suffix").where(F.col("path").startswith(F.col("rule_path")))
    best = fitting.groupBy("url").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    return urls.join(best.select("url", "best.rule", F.col("best.verdict").alias("listed")), "url", "left")


def mined_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(antecedent, verdict, confidence, support) from rows of ``tokens`` and ``verdict``."""
    items = labelled.select(F.array_append("tokens", F.concat(F.lit(VERDICT), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    to_verdict = F.element_at("consequent", 1).startswith(VERDICT)
    rules = model.associationRules.where(to_verdict & ~F.exists("antecedent", lambda t: t.startswith(VERDICT)))
    verdict = F.substring(F.element_at("consequent", 1), len(VERDICT) + 1, 100)
    return rules.select(F.array_sort("antecedent").alias("antecedent"), verdict.alias("verdict"), "confidence", "support")


def _with_mined(urls: DataFrame, mined: DataFrame, counts: DataFrame) -> DataFrame:
    """``urls`` with the verdict of the best mined rule whose tokens they all have."""
    numbered = mined.withColumn("name", F.array_join("antecedent", " "))
    rarest = numbered.select("name", "verdict", F.explode("antecedent").alias("token")).join(counts, "token")
    rarest = rarest.groupBy("name", "verdict").agg(F.min(F.struct("n", "token"))["token"].alias("token"))
    index = numbered.join(rarest, ["name", "verdict"])
    met = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    fitting = met.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    order = F.struct("confidence", "support", F.size("antecedent").alias("size"), "name", "verdict")
    best = fitting.groupBy("url").agg(F.max(order).alias("best"))
    return urls.join(best.select("url", F.col("best.verdict").alias("mined")), "url", "left")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """``pages`` with host, path, rule (of the list, or null) and verdict.

    Columns that are called so already, in whatever case, are replaced.
    """
    scratch = Scratch(pages.sparkSession)
    pages = without(pages, "host", "path", "rule", "verdict")
    (name,) = unused(pages, "url")
    key = F.coalesce(F.col("url"), F.lit(""))
    urls = pages.select(key.alias("url")).groupBy("url").agg(F.count(F.lit(1)).alias("rows"))
    urls = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    urls = urls.withColumn("tokens", tokens_of(F.col("url"), F.col("host"), F.col("path")))
    urls = scratch.save(_with_list(urls, rules), "listed")
    known = urls.where(F.col("listed").isNotNull())
    # FP-growth takes no weights: a URL of n rows stands n times
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))
    labelled = known.select("tokens", F.col("listed").alias("verdict"), repeated).drop("col")
    mined = scratch.save(mined_rules(labelled, min_support, min_confidence), "mined")
    counts = known.select(F.explode("tokens").alias("token"), "rows").groupBy("token").agg(F.sum("rows").alias("n"))
    unknown = _with_mined(urls.where(F.col("listed").isNull()), mined, counts)
    unknown = unknown.select("url", "host", "path", "rule", F.coalesce("mined", F.lit(default)).alias("verdict"))
    judged = known.select("url", "host", "path", "rule", F.col("listed").alias("verdict")).unionAll(unknown)
    judged = scratch.save(judged, "judged").withColumnRenamed("url", name)
    joined = pages.withColumn(name, key).join(judged, name)
    return joined.select(*pages.columns, "host", "path", "rule", "verdict")
