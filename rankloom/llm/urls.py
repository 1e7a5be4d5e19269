"""URL filters: listed rules first, then association rules mined from labelled pages.

A URL's tokens are its host's labels, its path's pieces and the keys of its query.  Labelled
pages (``labels.doc_id`` is the page's id) give transactions of tokens and one of two class
items.  Spark's FP-growth finds the frequent sets; a set with a class item and the same set
without it make a rule ``tokens -> class``, kept if its support and confidence suffice.  The
rules are indexed by their rarest token: only URLs with that token are compared with the
rule.  Of all rules that a URL meets, the most confident decides (then the larger support, then
block); a URL that meets none is allowed.

Size.  Only tokens in at least ``support`` of the transactions stay, so the vocabulary has at
most (tokens of a URL / ``support``) entries at any size of the input, and the rules are
made of these.  Tokens that occur in exactly the same transactions count as one item, so that
a long URL with many labelled copies gives one item, not a power set.  URLs are made
distinct before they are matched, and matching is per distinct set of vocabulary items, so a
hot host or a repeated URL costs one row.  Text bodies (``html``) are never read.

Defined results: a null URL, or one without ``://``, has an empty host and path, no tokens and
no listed rule, and is allowed; a page labelled several times is bad if any of its labels is;
a label with neither quality 0 or 1 nor toxic 1 does not count; null ids have no label; repeated
rows are judged one by one, alike; without labels no rule is mined; an empty table gives no
rows; further columns of the input are not read.  URLs are whole, however long.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import ascii_lower, stash

# The listed rules, (host, path start, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
SUPPORT = 0.001          # least share of the labelled pages that a rule must hold for
LEAST_PAGES = 20         # and the least number of them
CONFIDENCE = 0.8
BLOCK, ALLOW = "=block", "=allow"     # class items; tokens begin with a letter


def _rest(url: Column) -> Column:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest listed rule that fits, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p).otherwise(rule)
        verdict = F.when(fits, v).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL: ``h`` labels of the host, ``p`` pieces of the path, ``q``
    keys of the query."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1))

    def named(kind: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""),
                           lambda x: F.concat(F.lit(kind), ascii_lower(x)))

    return F.array_distinct(F.concat(
        named("h:", F.split(host_of(url), r"\.")),
        named("p:", F.split(path_of(url), r"[/.]")), named("q:", keys)))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, tokens, bad) of every page that has a label."""
    bad = (F.col("quality") == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    marks = stash(
        labels.filter(F.col("quality").isin(0, 1) | (F.col("toxic") == 1))
        .groupBy("doc_id").agg(F.max(F.coalesce(bad, F.lit(True))).alias("bad")), "url-labels")
    return (pages.join(marks, F.col("page_id") == F.col("doc_id"))
            .select(F.monotonically_increasing_id().alias("id"),
                    tokens_of(F.col("url")).alias("tokens"), "bad"))


def vocabulary(rows: DataFrame, least: int) -> DataFrame:
    """(token, item) of the tokens in at least ``least`` rows; tokens in exactly the same rows
    share an item (the first of them in order), known by their number of rows and two sums
    of row hashes."""
    found = rows.select("id", F.explode("tokens").alias("token"))
    same = found.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"),
        F.sum(F.shiftright(F.xxhash64("id", F.lit(1)), 32)).alias("s"))
    same = stash(same.filter(F.col("n") >= least), "url-tokens")
    first = same.groupBy("n", "x", "s").agg(F.min("token").alias("item"))
    return stash(same.join(first, ["n", "x", "s"]).select("token", "item"), "url-vocabulary")


def items_of(rows: DataFrame, key: list[str], known: DataFrame) -> DataFrame:
    """(key, items) of rows with ``tokens`` that have any known token; items are sorted."""
    return (rows.select(*key, F.explode("tokens").alias("token")).join(known, "token")
            .groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items")))


RULE_SCHEMA = ("body array<string>, block boolean, support long, confidence double, "
               "rarest string")


def mine(pages: DataFrame, labels: DataFrame, support: float = SUPPORT,
         least_pages: int = LEAST_PAGES, confidence: float = CONFIDENCE
         ) -> tuple[DataFrame, DataFrame]:
    """Rules (body, block, support, confidence, rarest) and the vocabulary (token, item)."""
    spark = pages.sparkSession
    rows = stash(labelled(pages, labels), "url-labelled")
    n = rows.count()
    least = max(least_pages, -int(-support * n // 1), 1)
    known = vocabulary(rows, least)
    if n < least:
        return spark.createDataFrame([], RULE_SCHEMA), known
    baskets = (items_of(rows, ["id", "bad"], known)
               .select(F.concat("items", F.array(F.when(F.col("bad"), BLOCK).otherwise(ALLOW)))
                       .alias("items")))
    # itemsets need `least` rows: half a row less keeps the product exact; rows without
    # a known token are in no set and only raise the share
    baskets = stash(baskets, "url-baskets")
    share = (least - 0.5) / max(baskets.count(), least)
    sets = stash(FPGrowth(itemsCol="items", minSupport=share, minConfidence=1.0)
                 .fit(baskets).freqItemsets, "url-itemsets")
    is_class = F.exists("items", lambda x: x.isin(BLOCK, ALLOW))
    body = F.array_sort(F.filter("items", lambda x: ~x.isin(BLOCK, ALLOW))).alias("body")
    heads = sets.filter(is_class).select(
        body, F.array_contains("items", BLOCK).alias("block"), F.col("freq").alias("support"))
    bodies = sets.filter(~is_class).select(body, F.col("freq").alias("n"))
    rules = stash(
        heads.join(bodies, "body").withColumn("confidence", F.col("support") / F.col("n"))
        .filter(F.col("confidence") >= confidence).drop("n"), "url-rules")
    single = bodies.filter(F.size("body") == 1).select(F.col("body")[0].alias("item"), "n")
    rarest = (rules.select("body", "block", F.explode("body").alias("item")).join(single, "item")
              .groupBy("body", "block")
              .agg(F.min_by("item", F.struct("n", "item")).alias("rarest")))
    return stash(rules.join(rarest, ["body", "block"]).select(
        "body", "block", "support", "confidence", "rarest"), "url-index"), known


def match(urls: DataFrame, rules: DataFrame, known: DataFrame) -> DataFrame:
    """(url, support, confidence, block) of the deciding rule of every URL that meets one;
    ``urls`` has distinct values of ``url``."""
    used = stash(known.join(rules.select(F.explode("body").alias("item")).distinct(), "item",
                            "left_semi"), "url-used")
    per_url = stash(items_of(urls.select("url", tokens_of(F.col("url")).alias("tokens")),
                             ["url"], used), "url-items")
    each = per_url.select("items").distinct().select("items", F.explode("items").alias("rarest"))
    met = (each.join(rules, "rarest")
           .filter(F.forall("body", lambda x: F.array_contains("items", x)))
           .groupBy("items").agg(F.max(F.struct("confidence", "support", "block")).alias("best")))
    return per_url.join(stash(met, "url-met"), "items").select("url", "best.*")


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES, support: float = SUPPORT,
                least_pages: int = LEAST_PAGES, confidence: float = CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence, support) of every row of ``pages``;
    the last two are those of the mined rule that decided, else null and 0."""
    mined, known = mine(pages, labels, support, least_pages, confidence)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = listed(host, path, rules)
    urls = pages.select("url").filter(F.col("url").isNotNull() & rule.isNull()).distinct()
    found = stash(match(urls, mined, known), "url-found")
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"),
                        rule.alias("rule"), verdict.alias("listed"))
    return rows.join(found, "url", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("listed", F.when(F.col("block"), "block").otherwise("allow"))
        .alias("verdict"), "confidence", F.coalesce("support", F.lit(0)).alias("support"))
