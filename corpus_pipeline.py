"""A corpus pipeline of five stages; each works on all that its predecessor kept.

Defined results beyond those of the operators: a stage judges rows and not ids, so a row without an id,
or under an id that another row has, stays or goes by its own text; empty texts stay; an empty table goes
through; extra columns are kept; ties go as in the operators.
"""

from __future__ import annotations

from duebook.llm import decontam, mixing, near_dedup, pii, toxicity
from duebook.llm.staging import broadcast_if_few, class_labels, stage, table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, class_labels(table(spark, sf_dir, "labels"), "toxic"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 0.8 or more, the one with the smallest id."""
    return near_dedup.one_of_each(docs, near_dedup.NearDedup(percent=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row goes if its own text is contaminated, whatever other rows of its id, or without one, hold."""
    found = decontam.contaminated_texts(docs, table(spark, sf_dir, "benchmark"))
    # Written first, so that its size is known where the corpus meets it.
    gone = broadcast_if_few(stage(found.select(F.col("text_key").alias("_gone")), "pipeline-contaminated"))
    return docs.join(gone, decontam.text_key("text") == gone["_gone"], "left_anti")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the number of times each is taken (mix_copies)."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("personal data", mask_personal_data),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs


# The stages use trained models and set similarity, which SQL cannot express.
ORACLE_SQL = None
