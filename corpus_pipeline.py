"""Training corpus from `documents`: quality, language, near duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. `run` writes a stage's result below
the shared folder and reads it back as the next one's docs, so a lost executor costs one stage at
most. All but the last return the columns of docs.

Nulls, empty texts, repeated rows and empty tables are as the operators define them: a null or
empty text is scored by the first stage, is `und` and goes in the second. Texts of any length go through
whole; one of more than a sequence's tokens is cut by the last stage alone. A score or share at its
threshold (ties) stays, containment at its threshold goes; of equal rows near each other the one with the smallest
id stays. Columns of docs may have any names: what a stage adds gets a free one, and all but the last return the
columns of docs. With no labels every document has the same score and stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelode.llm import decontamination, language, packing, quality, simhash
from pagelode.llm.common import stored, table, unused

# Below this share of its letters in one language a text is in none.
MIN_LANGUAGE_SHARE = 1 / 3


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are of label 1 with the classifier's threshold or more."""
    model, score = quality.fit(docs, table(spark, sf_dir, "labels")), unused(docs, "_score")
    return quality.scored(docs, model, score).where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: some letter, and enough of them in one language."""
    lang, share = unused(docs, "_lang"), unused(docs, "_share")
    found = language.identified(docs, language.fit(docs), (lang, share))
    return found.where((F.col(lang) != language.UNKNOWN) & (F.col(share) >= MIN_LANGUAGE_SHARE)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Learned scores and tokens are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
