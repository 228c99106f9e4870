"""Operator 10, URL filters by association rules [native].

A url becomes a set of tokens (scheme, host labels, top domain, path segments
with numbers masked, extension, query keys, fragment). Spark's FP-growth mines
the token sets of the urls that labels block; rules from token combinations to
block that reach the confidence, over all labelled urls, and the support asked
for are kept. They are matched by an inverted index: a rule is
filed under its rarest token only, a url's tokens look the rules up, and a rule
holds when the url has all of its tokens. A short list of given (host, path)
rules goes before the mined ones.

Everything is DataFrame functions and Spark ML; no Python runs on the
executors.

Defined results: a null url, or one without ``://``, has empty host and path
and is allowed, as is any url that no rule fits. Rules of a given list fit a
host and its subdomains; the longest wins (host and path together; of equal
length that with the longer host). Repeated pages are judged each; labels of
one id that differ make it blocked; unlabelled tables, and tables without rows,
mine no rules. Other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import read, staged

#: Blocked urls that a rule must hold for, however few or many there are in all.
MIN_URLS = 20
#: The share of the labelled urls that a rule must hold for besides: none, or
#: what is rare would be lost in a large table.
MIN_SUPPORT = 0.0
MIN_CONFIDENCE = 0.8

#: The rules (verdict, host, path) that go before the mined ones.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """The set of a url's tokens."""
    named = lambda prefix, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))
    h, p = host(url), path(url)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    masked = F.regexp_replace(F.lower(p), "[0-9]+", "#")
    single = F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))),
                     F.concat(F.lit("top="), F.regexp_extract(h, r"([^.]*)$", 1)),
                     F.concat(F.lit("ext="), F.regexp_extract(masked, r"\.([a-z#]+)$", 1)),
                     F.when(F.contains(url, F.lit("#")), "fragment"))
    every = F.concat(F.filter(single, lambda x: x.isNotNull() & ~x.endswith("=")), named("host=", F.split(F.regexp_replace(h, r"\.?[^.]*$", ""), r"\.")),
                     named("path=", F.split(F.regexp_replace(masked, r"\.[a-z#]+$", ""), "/")), named("query=", keys))
    return F.when(F.contains(url, F.lit("://")), F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_urls: int = MIN_URLS) -> DataFrame:
    """Rules ``item, antecedent, confidence, support`` from ``url, blocked``
    rows: token combinations that mean block. ``item`` is the rarest token of
    the antecedent, under which the rule is filed. A rule is left out if one
    token less gives a rule of no less confidence, which fits wherever it does.

    The blocked urls alone are mined, as a rule must hold for ``min_urls`` of
    them; how many urls hold a combination, blocked or not, is counted by the
    inverted index over the distinct token sets of all of them."""
    rows = staged(labelled.select(F.sort_array(tokens(F.col("url"))).alias("tokens"), "blocked").where(F.size("tokens") > 0), "urls")
    spark = rows.sparkSession
    n, bad = rows.agg(F.count(F.lit(1)), F.count_if("blocked")).first()
    least = max(min_urls, min_support * n)
    if not n or bad < least:
        return spark.createDataFrame([], "item string, antecedent array<string>, confidence double, support double")
    items = staged(rows.select(F.explode("tokens").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("held")), "items")
    # a token of every url changes no count of a combination and would only multiply the itemsets
    plain = [r["item"] for r in items.where(F.col("held") == n).collect()]  # no more than a url has tokens
    used = F.array_except("tokens", F.array(*map(F.lit, plain)).cast("array<string>"))
    # half a url less: the learner rounds minSupport up, and least / bad times bad may lie just over least
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / bad)).fit(rows.where("blocked").select(used.alias("items")))
    sets = model.freqItemsets.select(F.sort_array("items").alias("antecedent"), F.col("freq").cast("long").alias("freq"))
    # alone, a token of every url has the confidence of the whole table
    sets = sets.unionAll(spark.createDataFrame([([t], bad) for t in plain], "antecedent array<string>, freq long"))
    rarest = F.min_by(F.struct("item", "held"), F.struct("held", "item"))
    filed = sets.withColumn("item", F.explode("antecedent")).join(items, "item").groupBy("antecedent", "freq").agg(rarest.alias("rarest"))
    filed = staged(filed.select("antecedent", "freq", "rarest.item", "rarest.held"), "itemsets")
    whole = staged(rows.groupBy("tokens").agg(F.count(F.lit(1)).alias("urls")), "token-sets")
    several = filed.where(F.size("antecedent") > 1)
    met = whole.withColumn("item", F.explode("tokens")).join(several.select("item", "antecedent"), "item").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    total = met.groupBy("antecedent").agg(F.sum("urls").alias("total"))
    counted = several.join(total, "antecedent").unionByName(filed.where(F.size("antecedent") == 1).withColumn("total", F.col("held")))
    rules = counted.select("antecedent", (F.col("freq") / F.col("total")).alias("confidence"), (F.col("freq") / F.lit(n)).alias("support"), "item")
    return _needed(staged(rules.where(F.col("confidence") >= min_confidence), "every-rule")).select("item", "antecedent", "confidence", "support")


def _needed(rules: DataFrame) -> DataFrame:
    """``rules`` (antecedents sorted) without those that one token less makes
    no worse."""
    less = rules.select("antecedent", F.explode("antecedent").alias("out")) \
        .select(F.col("antecedent").alias("whole"), F.array_remove("antecedent", F.col("out")).alias("antecedent"))
    best = less.join(rules, "antecedent").groupBy("whole").agg(F.max("confidence").alias("before"))
    joined = rules.join(best, F.col("antecedent") == F.col("whole"), "left")
    return staged(joined.where(F.col("before").isNull() | (F.col("before") < F.col("confidence"))).select(*rules.columns), "rules")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url, antecedent, confidence`` of each distinct url that a rule fits:
    the rule of most confidence, then support."""
    found = urls.select("url").where("url is not null").distinct().withColumn("tokens", tokens(F.col("url")))
    asked = found.withColumn("item", F.explode("tokens"))
    held = asked.join(rules, "item").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = F.max(F.struct("confidence", "support", "antecedent")).alias("best")
    return held.groupBy("url").agg(best).select("url", "best.antecedent", "best.confidence")


def listed(rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The rule (as ``host/path``) of a short list that fits columns ``host``
    and ``path``, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, word).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, labelled: DataFrame, *, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url", min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule, confidence`` of every
    page; ``labelled`` has ``url, blocked``."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    mined = staged(mine(labelled, min_support=min_support, min_confidence=min_confidence), "index")
    # written before pages are joined to it: a join of plain tables is one whose hot urls Spark can split; null urls have no part in it
    hits = staged(match(pages, mined), "hits")
    rule, verdict = listed(rules)
    none = pages.where("url IS NULL").select("url", "page_id", F.lit(None).cast("array<string>").alias("antecedent"), F.lit(None).cast("double").alias("confidence"))
    joined = pages.where("url IS NOT NULL").join(hits, "url", "left").select(*none.columns).unionAll(none).withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    own = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return joined.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                         F.array_join("antecedent", " & ").alias("mined_rule"), "confidence")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Urls of the labelled pages, blocked where a label says poor or toxic."""
    bad = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    return pages.select("page_id", "url").join(bad, "page_id").select("url", F.coalesce("blocked", F.lit(False)).alias("blocked"))


def op10(spark, sf_dir: str) -> DataFrame:
    """Every page's url judged by the given list and by rules mined from the
    labels of the same ids."""
    pages = read(spark, sf_dir, "pages")
    return judge(pages, labelled_urls(pages, read(spark, sf_dir, "labels")))
