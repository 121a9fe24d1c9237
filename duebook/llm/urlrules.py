"""Web addresses by list rules and by association rules mined with Spark's FP-growth.

List rules name a host and the start of a path; the longest that fits decides. For all other
addresses the method decides: address tokens of labelled pages are mined for combinations that go
with blocked pages; all rules that are frequent and sure enough, and not implied by a shorter rule at
least as sure, are matched through an index from each rule's rarest token. No token, page or rule is
left out for its number: tokens that occur on exactly the same pages are mined as one item, and
only blocked pages are mined. A page of n items that are frequent in all combinations still has 2^n
frequent sets; where that many do not fit, a higher support is the remedy.

Defined results: an empty table gives no rows, addresses of any length are used whole, of equally sure rules
the last in token order is named, a null address, or one without ``://``, has an empty host and path and is judged
by the method on no tokens (allow); without labels nothing is mined and all are allowed; labels of
equal addresses are counted each; contradicting labels of a document count as bad; rows without an id are judged like any other; equal rows get equal
results; an unlabelled page is never learnt from; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class ListRule:
    verdict: str
    rule: str  # host and path, such as net/es/

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


@dataclass(frozen=True)
class MiningParameters:
    """``support``: the part of the labelled pages that are blocked and hold a rule's tokens, ``least_pages``
    their number at least. ``z``: the standard errors of the lower bound of a rule's confidence, which must lie
    above the part of all labelled pages that are blocked."""

    support: float = 0.001
    confidence: float = 0.6
    least_pages: int = 2
    z: float = 3.0


def host_of(url: str) -> Column:
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, UPPER.lower())


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def list_rule(host: str, path: str, rules: tuple[ListRule, ...]) -> Column:
    """The longest rule that fits, or null; of equally long ones the first in code point order."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule), reverse=True):
        h, p = F.col(host), F.col(path)
        fits = ((h == r.host) | h.endswith("." + r.host)) & p.startswith(r.path)
        found = F.when(fits, F.lit(r.rule)).otherwise(found)
    return found


def address_tokens(url: str, host: str, path: str) -> Column:
    """Distinct tokens: host labels, path segments, the path's extension, and names of query keys.
    Digits count as one sign, so numbers do not make tokens of their own."""
    query = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))

    def tagged(tag: str, parts: Column) -> Column:
        signs = F.transform(parts, lambda x: F.concat(F.lit(tag), F.regexp_replace(x, "[0-9]+", "0")))
        return F.filter(signs, lambda x: F.length(x) > len(tag))

    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    extension = F.array(F.regexp_extract(F.col(path), r"\.([A-Za-z0-9]+)$", 1))
    return F.array_distinct(
        F.concat(
            tagged("host:", F.split(F.col(host), r"\.")),
            tagged("path:", F.split(F.col(path), "/")),
            tagged("ext:", extension),
            tagged("query:", keys),
        )
    )


def _merged_items(rows: DataFrame, total: int) -> DataFrame:
    """(token, item): tokens on exactly the same token sets are one item, named by the smallest of them; tokens of
    every page say nothing and are left out. Only tokens of blocked pages are looked at."""
    held = rows.select("row", "n", "bad", F.explode("tokens").alias("token"))
    # The pages of a token by their number and two sums over hashes: equal for equal pages.
    marks = [F.sum(F.xxhash64(F.lit(k), "row").cast("decimal(20,0)")).alias(f"h{k}") for k in (1, 2)]
    pages = held.groupBy("token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("rows"), *marks)
    pages = stage(pages.where((F.col("bad") > 0) & (F.col("n") < total)), "url-tokens")
    names = pages.groupBy("rows", "h1", "h2").agg(F.min("token").alias("item"))
    return pages.join(names, ["rows", "h1", "h2"]).select("token", "item", "bad")


def contained(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of ``sets`` (with ``tokens``, distinct) joined to every row of ``rules`` (with ``needed``, distinct) whose
    tokens they hold, by way of an index with one row for each rule, at its rarest token."""
    each = rules.select("needed", F.explode("needed").alias("token")).distinct()
    uses = each.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    rarest = each.join(uses, "token").groupBy("needed").agg(F.min(F.struct("uses", "token"))["token"].alias("token"))
    hits = sets.withColumn("token", F.explode("tokens")).join(rules.join(rarest, "needed"), "token").drop("token")
    return hits.where(F.size(F.array_except("needed", "tokens")) == 0)


def surely_above(base: float, z: float) -> Column:
    """Whether the lower Wilson bound of ``bad`` of ``n`` pages lies above the ``base`` rate."""
    n, part = F.col("n").cast("double"), F.col("bad") / F.col("n")
    spread = z * F.sqrt(part * (1 - part) / n + z * z / (4 * n * n))
    return (part + z * z / (2 * n) - spread) / (1 + z * z / n) > base


def mined_rules(labelled: DataFrame, p: MiningParameters = MiningParameters()) -> DataFrame | None:
    """(tokens, confidence, support) of the rules for blocked pages, or None; ``labelled``: tokens, bad.

    FP-growth lists the token sets that are frequent on blocked pages; each is then counted on all
    labelled pages by a join. A rule is frequent, sure, by its lower confidence bound surer than a page
    without any rule, and surer than each rule on a part of its tokens.
    """
    total = labelled.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("int")).alias("bad")).first()
    if not total["n"] or not total["bad"]:
        return None
    least = max(p.least_pages, ceil(p.support * total["n"]))
    rows = labelled.groupBy(F.array_sort(F.array_distinct("tokens")).alias("tokens")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")
    )
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "url-sets")
    items = stage(_merged_items(rows, total["n"]).where(F.col("bad") >= least), "url-names")
    named = rows.select("row", "n", "bad", F.explode("tokens").alias("token")).join(items.select("token", "item"), "token")
    named = stage(named.groupBy("row", "n", "bad").agg(F.collect_set("item").alias("tokens")), "url-items")
    # One row for each blocked page, as FP-growth has no weights.
    blocked = named.where("bad > 0").select(F.explode(F.sequence(F.lit(1), F.col("bad"))), F.col("tokens").alias("items")).drop("col")
    if blocked.isEmpty():
        return None
    pages = blocked.count()
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / pages)).fit(blocked)
    sets = stage(model.freqItemsets.select(F.array_sort("items").alias("needed")), "url-frequent")
    counted = contained(named, sets).groupBy("needed").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    confidence = F.col("bad") / F.col("n")
    counted = counted.where((F.col("bad") >= least) & (confidence >= p.confidence) & surely_above(total["bad"] / total["n"], p.z))
    counted = stage(counted.select("needed", confidence.alias("confidence"), (F.col("bad") / F.lit(total["n"])).alias("support")), "url-counted")
    # A rule goes if a rule on a part of its tokens is as sure.
    longer = counted.select(F.col("needed").alias("tokens"), F.col("confidence").alias("own"))
    implied = contained(longer, counted).where((F.size("needed") < F.size("tokens")) & (F.col("confidence") >= F.col("own")))
    kept = counted.join(implied.select(F.col("tokens").alias("needed")).distinct(), "needed", "left_anti")
    # Items stand for all their tokens.
    rule = kept.withColumn("rule", F.monotonically_increasing_id())
    rule = stage(rule, "url-kept")
    tokens = rule.select("rule", F.explode("needed").alias("item")).join(items, "item").groupBy("rule")
    tokens = tokens.agg(F.array_sort(F.collect_set("token")).alias("tokens"))
    return stage(tokens.join(rule, "rule").select("tokens", "confidence", "support"), "url-rules")


def mine(labelled: DataFrame, p: MiningParameters = MiningParameters()) -> list[tuple[tuple[str, ...], float, float]]:
    """The rules of ``mined_rules`` as a list, for small tables and tests."""
    rules = mined_rules(labelled, p)
    return [] if rules is None else [(tuple(r["tokens"]), r["confidence"], r["support"]) for r in rules.collect()]


def match(tokens: DataFrame, rules: DataFrame | list[tuple[tuple[str, ...], float, float]]) -> DataFrame:
    """(signature, confidence, matched): the surest rule contained in each token set, by way of an
    inverted index; ``tokens``: signature, tokens (distinct). The index has one row per rule."""
    if not isinstance(rules, DataFrame):
        schema = "tokens array<string>, confidence double, support double"
        rules = tokens.sparkSession.createDataFrame([(list(t), c, s) for t, c, s in rules], schema)
    full = contained(tokens, rules.select(F.col("tokens").alias("needed"), "confidence"))
    best = F.max(F.struct("confidence", "needed")).alias("best")
    return full.groupBy("signature").agg(best).select(
        "signature", F.col("best.confidence").alias("confidence"), F.col("best.needed").alias("matched")
    )


def judge(
    pages: DataFrame, labels: DataFrame, rules: tuple[ListRule, ...], p: MiningParameters = MiningParameters()
) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, and the method's confidence and tokens.

    ``labels``: (doc_id, bad), one row per document; a page is labelled by the document whose number
    ends its path.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", "url", host_of("url").alias("host"), path_of("url").alias("path"))
    rows = rows.withColumn("rule", list_rule("host", "path", rules)).withColumn(
        "tokens", address_tokens("url", "host", "path")
    )
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:[./][^/]*)?$", 1)
    rows = rows.withColumn("number", F.when(number != "", number.cast("long"))).drop("url")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "url-rows")
    blocked = [r.rule for r in rules if r.verdict == "block"]
    labelled = rows.join(labels.select(F.col("doc_id").alias("number"), "bad"), "number").select("tokens", "bad")
    mined = mined_rules(stage(labelled, "url-labelled"), p)
    verdict = F.when(F.col("rule").isNotNull(), F.when(F.col("rule").isin(blocked), "block").otherwise("allow"))
    if mined is None:
        return rows.select(
            "page_id", "host", "path", "rule", F.coalesce(verdict, F.lit("allow")).alias("verdict"),
            F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("array<string>").alias("matched"),
        )
    words = mined.select(F.explode("tokens").alias("token")).distinct()
    useful = rows.select("row", F.explode("tokens").alias("token")).join(words, "token", "left_semi")
    signed = stage(useful.groupBy("row").agg(F.array_sort(F.collect_list("token")).alias("signature")), "url-signed")
    found = match(signed.select("signature", F.col("signature").alias("tokens")).distinct(), mined)
    return rows.join(signed.join(found, "signature").drop("signature"), "row", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(verdict, F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "confidence",
        "matched",
    )
