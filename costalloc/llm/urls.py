"""URL filters: a list of host rules, and association rules mined from labels. DataFrame functions only.

Spark's FP-growth mines frequent sets of URL tokens together with the mark of a bad label; tokens of the same pages
count as one item. A set whose pages are bad often enough becomes a rule. Rules stand in an inverted index under their
rarest item; a URL is checked against the rules that its items find there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costalloc.llm.common import materialize

BLOCK, ALLOW = "block", "allow"
BAD = "class:bad"
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.002, 10, 0.8
PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class HostRule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"


def _part(url: Column, k: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, k), F.lit(""))


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(_part(url, 2), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 3)


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL: scheme, whole host, host labels, path segments, query arguments."""

    def marked(mark: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(mark), v))

    host = host_of(url)
    scheme = F.translate(_part(url, 1), UPPER, LOWER)
    return F.array_distinct(
        F.concat(
            marked("s:", F.array(scheme)),
            marked("d:", F.array(host)),
            marked("h:", F.split(host, r"\.")),
            marked("p:", F.split(path_of(url), "/")),
            marked("q:", F.split(F.substring(_part(url, 4), 2, 1 << 30), "&")),
        )
    )


def fitting_rule(host: Column, path: Column, rules: Sequence[HostRule]) -> Column:
    """(rule, verdict) of the longest rule whose host is the URL's or a parent of it and whose path begins its path."""
    ranked = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r))
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in reversed(ranked):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        told = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, told).otherwise(found)
    return found


def equal_tokens(labelled: DataFrame, least_bad: int) -> DataFrame:
    """(token, item): tokens of at least least_bad bad pages; tokens of exactly the same pages share an item.

    labelled: row, tokens, bad. Equal sets of pages are known by their size and 128 summed hash bits. All tokens of an
    item stand in one URL, so none is larger than that. The item is called after its smallest token, so it begins with
    d: if a whole host is in it, else with h: if a host label is.
    """
    found = labelled.select("bad", *[F.xxhash64(F.lit(k), "row").cast("decimal(20,0)").alias(f"r{k}") for k in (1, 2)], F.explode("tokens").alias("token"))
    pages = [F.count("*").alias("pages"), F.sum("r1").alias("s1"), F.sum("r2").alias("s2")]
    counted = found.groupBy("token").agg(F.count_if("bad").alias("n_bad"), *pages).where(F.col("n_bad") >= least_bad)
    shared = counted.groupBy("pages", "s1", "s2").agg(F.min("token").alias("item"), F.collect_list("token").alias("tokens"))
    return shared.select(F.explode("tokens").alias("token"), "item")


def mine_rules(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_count: int = MIN_COUNT,
    min_confidence: float = MIN_CONFIDENCE,
) -> tuple[DataFrame, DataFrame]:
    """(items, pages, bad): item sets whose pages are bad at least min_confidence of the time; and (token, item).

    labelled: tokens, bad (boolean). A set counts if at least min_count bad pages, and min_support of all labelled
    pages, have it together with the mark. Three things keep sets from doubling with tokens that tell nothing new:
    tokens below the limit are left out, tokens of the same pages are one item (a URL has it by any of them), and a
    whole host, which implies its labels, is never put with them in one set: hosts and labels are mined apart. The
    sets lost are those that match no page that a shorter one, with the same counts, doesn't. Sets still double with
    each further token that many bad pages share in changing company. The items, which reach the driver, are at most
    tokens per URL / min_support.
    """
    spark = labelled.sparkSession
    rows = materialize(labelled.select(F.monotonically_increasing_id().alias("row"), "tokens", "bad"), "url-labelled")
    total = rows.count()
    least = max(min_count, 1, math.ceil(round(total * min_support, 6)))
    tokens = materialize(equal_tokens(rows, least), "url-tokens")
    placed = rows.select("row", "bad", F.explode("tokens").alias("token")).join(tokens, "token")
    items = materialize(placed.groupBy("row", "bad").agg(F.collect_set("item").alias("items")), "url-items")
    n = items.count()
    if not n:
        return spark.createDataFrame([], "items array<string>, pages bigint, bad bigint"), tokens
    mark = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    mined = []
    for left_out in ("h:", "d:"):
        some = F.filter("items", lambda item: ~F.startswith(item, F.lit(left_out)))
        # half a page below the count, so that rounding cannot move the limit
        growth = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n), minConfidence=0.0)
        sets = growth.fit(items.select(F.concat(some, mark).alias("items"))).freqItemsets
        mined.append(materialize(sets.select(F.sort_array("items").alias("items"), "freq"), "url-itemsets"))
    sets = mined[0].union(mined[1]).distinct()
    is_bad = F.array_contains("items", BAD)
    with_mark = sets.where(is_bad & (F.size("items") > 1)).select(
        F.array_remove("items", BAD).alias("items"), F.col("freq").alias("bad")
    )
    all_pages = sets.where(~is_bad).select("items", F.col("freq").alias("pages"))
    rules = with_mark.join(all_pages, "items").where(F.col("bad") >= min_confidence * F.col("pages"))
    return rules.select("items", "pages", "bad"), tokens


def match_rules(urls: DataFrame, rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """(url, pattern): for each distinct URL that some rule matches, its most confident rule.

    urls: url, tokens. A rule is indexed under its item that is rarest among the rules' pages, so a token of every
    URL, like the scheme, finds only rules of nothing else.
    """
    single = rules.select(F.explode("items").alias("item"), "pages").groupBy("item").agg(F.sum("pages").alias("weight"))
    placed = rules.select("*", F.explode("items").alias("item")).join(single, "item")
    index = placed.groupBy("items", "pages", "bad").agg(F.min(F.struct("weight", "item"))["item"].alias("item"))
    used = tokens.join(single.select("item"), "item")
    told = urls.select("url", F.explode("tokens").alias("token")).join(used, "token")
    owned = told.groupBy("url").agg(F.collect_set("item").alias("own"))
    posted = owned.select("url", "own", F.explode("own").alias("item"))
    hits = posted.join(index, "item").where(F.size(F.array_except("items", "own")) == 0)
    # best: highest share of bad pages, then most bad pages, then the smallest pattern
    best = F.min(F.struct(-F.col("bad") / F.col("pages"), -F.col("bad"), F.array_join("items", " ").alias("pattern")))
    return hits.groupBy("url").agg(best["pattern"].alias("pattern"))


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[HostRule], **limits) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern) for every row of pages (page_id, url).

    The host rules decide first; else a mined rule blocks (pattern: its items); else the page is allowed. A page is
    labelled by labels whose doc_id is its page_id, and bad if any of them says quality 0 or toxic 1 (null: says
    nothing). A null url, or one without ://, has empty host, path and no tokens. Repeated rows are each judged.
    Without labels no rule is mined. Other columns are ignored.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad")
    )
    url = F.coalesce("url", F.lit(""))
    plain = pages.select("page_id", url.alias("url"))
    labelled = plain.join(known, "page_id").select(tokens_of(F.col("url")).alias("tokens"), "bad")
    mined, tokens = mine_rules(labelled, **limits)
    mined = materialize(mined, "url-rules")
    distinct = plain.select("url").distinct().select("url", tokens_of(F.col("url")).alias("tokens"))
    matched = match_rules(distinct, mined, tokens)
    parts = plain.join(matched, "url", "left").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "pattern"
    )
    fitted = parts.withColumn("fitted", fitting_rule(F.col("host"), F.col("path"), rules))
    by_pattern = F.when(F.col("pattern").isNotNull(), BLOCK).otherwise(ALLOW)
    return fitted.select(
        "page_id", "host", "path", F.col("fitted.rule").alias("rule"),
        F.coalesce("fitted.verdict", by_pattern).alias("verdict"), "pattern",
    )
