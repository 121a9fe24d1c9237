"""Mixing sources to target weights, in DataFrame expressions only.

Words are summed by source and hash bucket. The bucket in which a source's budget falls is refined
once more, and within the second bucket the exact hash at which the budget is met is found. A
document is taken if its hash is at or below that threshold, so nothing is sorted and the same
rows always give the same mix.

Defined results: a null text has size 0; rows without a source form a source of their own, last in
order; rows of one id share a hash and therefore their fate; a row without an id is hashed by its
text; an empty table gives an empty mix. A document counts whole: it is taken 0, 1 or 2 times, and
its source meets its target but for half of its largest document. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .staging import stage

WORD = r"[^\x20\x09-\x0D]+"
LEVEL_BITS = 12
HASH_BITS = 60


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def mix_hash(doc_id: str, text: str) -> Column:
    """The first 60 bits of the MD5 digest of the id (of the text, where there is no id)."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit(""))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """(source, source_size, target) from (source, size): shares of ``share`` times all words by weight,
    each stopped at ``most`` times its source and the excess dealt on by weight.

    Sources in the order of the size at which they stop: the common factor is the largest one found
    when all sources before a place stop. One row per source is sorted, never a document.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    choices = F.array(*[F.lit(w) for w in weights])
    ranked = per_source.withColumn("place", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(choices, ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    )
    stops = ranked.withColumn("stop", F.col("source_size") * most)
    earlier = W.orderBy(F.col("stop") / F.col("weight"), "place").rowsBetween(W.unboundedPreceding, -1)
    factors = stops.withColumn(
        "factor",
        (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("stop").over(earlier), F.lit(0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))),
    )
    target = F.least(F.col("stop").cast("double"), F.max("factor").over(everything) * F.col("weight"))
    return factors.select("source", "source_size", target.alias("target"))


def _boundary(rows: DataFrame, bucket: Column) -> DataFrame:
    """Per source, the bucket in which the budget falls and the words below it; no row where all fit."""
    sums = rows.groupBy("source", "budget", "below", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    upto = F.col("below") + F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
    return (
        sums.withColumn("upto", upto)
        .where("upto > budget and upto - words <= budget")
        .select("source", "budget", "bucket", (F.col("upto") - F.col("words")).alias("below"))
    )


def _within(rows: DataFrame, found: DataFrame, shift: int) -> DataFrame:
    f = found.withColumnRenamed("source", "found_source")
    same = F.col("source").eqNullSafe(F.col("found_source")) & (F.shiftright("hash", shift) == F.col("bucket"))
    return rows.join(f, same).select("source", "size", "hash", "budget", "below")


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): hashes up to it are taken, so that their words come nearest to the budget.

    ``rows``: source, size, hash. Sources whose words all fit have no row.
    """
    first, second = HASH_BITS - LEVEL_BITS, HASH_BITS - 2 * LEVEL_BITS
    sums = rows.groupBy("source", F.shiftright("hash", first).alias("hash")).agg(F.sum("size").alias("size"))
    b = budgets.select(F.col("source").alias("budget_source"), "budget")
    coarse = sums.join(b, F.col("source").eqNullSafe(F.col("budget_source"))).withColumn("below", F.lit(0).cast("long"))
    at = _boundary(coarse, F.col("hash"))
    at = _boundary(_within(rows, at, first), F.shiftright("hash", second))
    exact = _within(rows, at, second).groupBy("source", "budget", "below", "hash").agg(F.sum("size").alias("words"))
    upto = F.col("below") + F.sum("words").over(W.partitionBy("source").orderBy("hash"))
    last = (
        exact.withColumn("upto", upto)
        .where("upto > budget and upto - words <= budget")
        .groupBy("source")
        .agg(F.min(F.struct("hash", "upto", "words", "budget")).alias("x"))
    )
    nearer = (F.col("x.upto") - F.col("x.budget")) < (F.col("x.budget") - (F.col("x.upto") - F.col("x.words")))
    return last.select("source", F.when(nearer, F.col("x.hash")).otherwise(F.col("x.hash") - 1).alias("threshold"))


def _plan(rows: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """One row per source: plan_source, source_size, target, base, threshold.

    A target above the source's size takes all documents once and spends the rest on second copies;
    one below it takes a part of the documents once.
    """
    if most != 2:
        raise ValueError("documents are taken at most twice")
    targets = source_targets(rows, weights, share, most)
    whole = F.col("target") >= F.col("source_size")
    budgets = stage(
        targets.withColumn("base", whole.cast("int")).withColumn(
            "budget", F.when(whole, F.col("target") - F.col("source_size")).otherwise(F.col("target"))
        ),
        "mix-budgets",
    )
    cuts = thresholds(rows.select("source", "size", "hash"), budgets).withColumnRenamed("source", "cut_source")
    plan = budgets.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    plan = plan.select(F.col("source").alias("plan_source"), "source_size", "target", "base", "threshold")
    return stage(plan, "mix-plan")


def _sized(documents: DataFrame) -> DataFrame:
    return stage(
        documents.select(
            "doc_id", "source", word_count("text").alias("size"), mix_hash("doc_id", "text").alias("hash")
        ),
        "mix-rows",
    )


def mix(documents: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """Per row of ``documents``: doc_id, source, size, source_size, target, copies, taken."""
    rows = _sized(documents)
    plan = _plan(rows, weights, share, most)
    mixed = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    within = F.col("threshold").isNull() | (F.col("hash") <= F.col("threshold"))  # without one, all fit
    mixed = mixed.withColumn("copies", F.col("base") + within.cast("int"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", taken)


def mixed_documents(
    documents: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """``documents`` that the mix takes, with all their columns and ``mix_copies``, 1 or 2."""
    plan = _plan(_sized(documents), weights, share, most)
    plan = plan.select(*[F.col(c).alias(f"_plan_{c}") for c in ("plan_source", "base", "threshold")])
    joined = documents.join(plan, documents["source"].eqNullSafe(plan["_plan_plan_source"]))
    taken = F.col("_plan_threshold").isNull() | (mix_hash("doc_id", "text") <= F.col("_plan_threshold"))
    joined = joined.withColumn("mix_copies", F.col("_plan_base") + taken.cast("int"))
    return joined.where("mix_copies > 0").drop("_plan_plan_source", "_plan_base", "_plan_threshold")
