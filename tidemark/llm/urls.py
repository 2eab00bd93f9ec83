"""URL filters: listed rules first, then association rules mined from labels. DataFrame functions and Spark's FP-growth.

A listed rule (action, host, path) fits its host and all subdomains where the url's path starts with the rule's; the
longest rule (host and path together) wins. Rules are found by joining the dot suffixes of a host with the rules' hosts,
so their number does not matter.

Association rules: every labelled url is a transaction of its tokens (host labels, path words, query keys) and its label.
FP-growth finds frequent token sets; a rule "tokens -> block" or "tokens -> allow" stays if its support and confidence
reach the given bounds and no rule with fewer of the same tokens is as confident. An inverted index maps the rarest token
of each rule to the rule; urls reach the index by their tokens and must then hold all tokens of the rule. The most
confident fitting rule decides (then the larger support, then block before allow); a url that no rule fits is allowed.

Labels are the urls that a listed rule decides, unless the caller has others; each of their rows is a transaction of all
its frequent tokens. Support is a share of labelled urls, so there are at most (tokens per transaction) / support frequent
tokens, however large the table is. A token whose urls all have one label, or that all urls have, is counted without
FP-growth: a rule of it and more tokens is never more confident than the rule that leaves out one of them.

Cases: a null url, or one without ``://``, has empty host and path, no tokens and verdict allow. Repeated urls and rows
are judged each. With an empty table or no labels there are no mined rules. Other columns are not returned.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import lower_ascii, stored

# (action, host, path): fixed by the query's contract
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SUPPORT, CONFIDENCE = 0.002, 0.8
BLOCK, ALLOW = "\x00block", "\x00allow"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: ``h:`` words of the host, ``p:`` words of the path, ``q:`` names of query parameters."""
    def words(kind: str, text: Column, pattern: str) -> Column:
        found = F.filter(F.split(text, pattern), lambda w: w.rlike("[^0-9]"))
        return F.transform(found, lambda w: F.concat(F.lit(kind), w))

    query = F.coalesce(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), F.lit(""))
    names = F.transform(F.split(query, "&"), lambda w: F.regexp_extract(w, r"(?s)^([^=]*)", 1))
    keys = F.transform(F.filter(names, lambda w: w != ""), lambda w: F.concat(F.lit("q:"), lower_ascii(w)))
    held = F.when(F.contains(url, F.lit("://")), F.array_distinct(F.concat(
        words("h:", host, r"[^\p{L}\p{N}]+"), words("p:", lower_ascii(path), r"[^\p{L}\p{N}]+"), keys)))
    return F.coalesce(held, F.array().cast("array<string>"))


def rule_table(spark, rules) -> DataFrame:
    rows = [(action, host, path, host + path) for action, host, path in rules]
    return spark.createDataFrame(rows, "listed string, rule_host string, rule_path string, rule string")


def parsed(pages: DataFrame) -> DataFrame:
    return (pages.select("page_id", "url").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
            .withColumn("tokens", tokens_of(F.col("url"), F.col("host"), F.col("path"))))


def listed(urls: DataFrame, rules) -> DataFrame:
    """The longest listed rule of each distinct (host, path)."""
    places = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    best = F.max_by(F.struct("rule", "listed"), F.struct(F.length("rule"), F.length("rule_host"), "rule", "listed"))
    return (places.withColumn("rule_host", F.explode(suffixes)).join(rule_table(urls.sparkSession, rules), "rule_host")
            .filter(F.startswith("path", F.col("rule_path"))).groupBy("host", "path").agg(best.alias("best"))
            .select("host", "path", "best.rule", "best.listed"))


def token_counts(labelled: DataFrame, support: float) -> tuple[DataFrame, DataFrame]:
    """(key, label, token) of the labelled urls that have tokens, the label itself a token too, and token, n, blocked and
    alone (no use in longer rules) of frequent tokens."""
    # every row is a transaction, repeated ones too
    known = labelled.filter(F.size("tokens") > 0).withColumn("key", F.monotonically_increasing_id())
    spread = stored(known.select("key", "label", F.explode(F.array_union("tokens", F.array("label"))).alias("token")), "url_tokens")
    total = spread.agg(F.count(F.when(F.col("token") == F.col("label"), 1)).alias("all")).first()["all"]
    counts = (spread.groupBy("token").agg(F.count("*").alias("n"), F.count(F.when(F.col("label") == BLOCK, 1)).alias("blocked"))
              .filter(F.col("n") >= total * support))
    is_label = F.col("token").isin(BLOCK, ALLOW)
    return spread, stored(counts.withColumn("alone", ~is_label & (
        (F.col("blocked") == 0) | (F.col("blocked") == F.col("n")) | (F.col("n") == total))), "url_frequent")


def transactions(spread: DataFrame, counts: DataFrame) -> DataFrame:
    """Sets of frequent tokens of labelled urls with their label."""
    # a label that is not frequent still fills its transactions, which support is a share of
    labels = spread.filter(F.col("token") == F.col("label"))
    rows = spread.filter(F.col("token") != F.col("label")).join(counts.filter("NOT alone").select("token"), "token")
    return rows.select("key", "token").union(labels.select("key", "token")).groupBy("key").agg(F.collect_list("token").alias("items"))


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) after pruning, by FP-growth over labelled urls."""
    spread, counts = token_counts(labelled, support)
    baskets = stored(transactions(spread, counts), "url_baskets")
    sets = FPGrowth(itemsCol="items", minSupport=support).fit(baskets).freqItemsets
    sets = stored(sets.withColumn("items", F.array_sort("items")), "url_itemsets")
    label = F.when(F.array_contains("items", BLOCK), BLOCK).when(F.array_contains("items", ALLOW), ALLOW)
    with_label = (sets.withColumn("label", label).filter(F.col("label").isNotNull())
                  .withColumn("tokens", F.array_remove("items", F.col("label"))).filter(F.size("tokens") > 0)
                  .select("tokens", "label", F.col("freq").alias("hits")))
    found = (with_label.join(sets.select(F.col("items").alias("tokens"), "freq"), "tokens")
             .withColumn("confidence", F.col("hits") / F.col("freq")).filter(F.col("confidence") >= confidence)
             .select("tokens", F.when(F.col("label") == BLOCK, "block").otherwise("allow").alias("action"), "confidence", "hits"))
    single = counts.filter("alone").select(F.array("token").alias("tokens"), "n", F.explode(F.array(
        F.struct(F.lit("block").alias("action"), F.col("blocked").alias("hits")),
        F.struct(F.lit("allow").alias("action"), (F.col("n") - F.col("blocked")).alias("hits")))).alias("of"))
    single = (single.select("tokens", "of.action", (F.col("of.hits") / F.col("n")).alias("confidence"), "of.hits")
              .filter((F.col("confidence") >= confidence) & (F.col("hits") >= baskets.count() * support)))
    found = stored(found.unionByName(single), "url_rules")
    # a rule goes if leaving out one token loses no confidence; by induction the shortest such rules stay
    shorter = (found.withColumn("drop", F.explode("tokens")).filter(F.size("tokens") > 1)
               .select("tokens", "action", "confidence", F.array_remove("tokens", F.col("drop")).alias("less")))
    less = found.select(F.col("tokens").alias("less"), "action", F.col("confidence").alias("less_confidence"))
    beaten = (shorter.join(less, ["less", "action"]).filter(F.col("less_confidence") >= F.col("confidence"))
              .select("tokens", "action").distinct())
    return found.join(beaten, ["tokens", "action"], "left_anti")


def indexed(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rules under their rarest token."""
    df = labelled.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    numbered = rules.withColumn("rule_key", F.xxhash64("tokens", "action"))
    return (numbered.withColumn("token", F.explode("tokens")).join(df, "token")
            .groupBy("rule_key").agg(F.min_by("token", F.struct("df", "token")).alias("token"), F.first("tokens").alias("rule_tokens"),
                                     F.first("action").alias("action"), F.first("confidence").alias("confidence"),
                                     F.first("hits").alias("hits")))


def judged(pages: DataFrame, rules=RULES, labels: DataFrame | None = None, support: float = SUPPORT,
           confidence: float = CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and the mined rule that decided, where one did.

    ``labels``: (page_id, url, label) with label ``block`` or ``allow``; by default the verdicts of listed rules.
    """
    urls = stored(parsed(pages), "urls")
    by_list = stored(listed(urls, rules), "url_listed")
    urls_listed = urls.join(by_list, ["host", "path"], "left")
    if labels is None:
        labelled = urls_listed.filter(F.col("listed").isNotNull()).withColumn("label", F.col("listed"))
    else:
        labelled = parsed(labels).join(labels.select("page_id", "url", "label"), ["page_id", "url"])
    labelled = labelled.select("page_id", "url", "tokens", F.when(F.col("label") == "block", BLOCK).otherwise(ALLOW).alias("label"))
    index = stored(indexed(mined_rules(labelled, support, confidence), labelled), "url_index")
    # urls with equal tokens are matched once
    open_sets = urls_listed.filter(F.col("listed").isNull()).select("tokens").distinct()
    fits = (open_sets.withColumn("token", F.explode("tokens")).join(index, "token")
            .filter(F.size(F.array_except("rule_tokens", "tokens")) == 0)
            .groupBy("tokens").agg(F.max_by(
                F.struct("action", "rule_tokens", "confidence"),
                F.struct("confidence", "hits", F.col("action") == "block", "rule_tokens")).alias("mined")))
    return (urls_listed.join(fits, "tokens", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("listed", F.col("mined.action"), F.lit("allow")).alias("verdict"),
        F.when(F.col("listed").isNull(), F.array_join("mined.rule_tokens", " ")).alias("mined_rule"),
        F.when(F.col("listed").isNull(), F.col("mined.confidence")).alias("confidence")))


def op1_url_filter(pages: DataFrame) -> DataFrame:
    return judged(pages)
