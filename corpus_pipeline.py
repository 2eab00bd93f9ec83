"""A training corpus from raw documents: junk out, one of each group of near copies, no benchmark text, no personal data,
sources mixed to their weights.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents; the last adds size, source_size, target, copies and taken
and returns the documents that the mix takes at least once.

Every stage takes nulls in any column, texts of any length, repeated rows and ids, empty tables and columns of any other name; the
columns that the last stage adds replace given ones of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, mix, pii, quality
from tidemark.llm.common import read, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers reject go. Null and empty texts are judged like texts without words; equal rows
    alike."""
    return quality.good(docs, read(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (shingles of 5 words, 0.8) stays, the one with the smallest doc_id; ids of
    null come last. Texts without words have no copies but rows of the same id and text, of which one stays."""
    return jaccard.one_of_each(docs, jaccard.USUAL)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with the benchmark go. Texts without words share none and stay."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind. Null stays null; no row goes."""
    return pii.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the copies that the mix takes of them; those of which it takes none go, and so do texts without words. A null
    source is a source like any other, the last."""
    return mix.mixed(docs).filter(F.col("copies") > 0)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mix),
]

# The first stage is a trained classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
