"""The operators as queries over whole tables, and their expected results as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import read
from tidemark.llm.conversations import op13_conversations
from tidemark.llm.decontaminate import op2_decontaminate
from tidemark.llm.html import op4_html
from tidemark.llm.jaccard import op9_jaccard
from tidemark.llm.lexical import op11_lexical
from tidemark.llm.mix import op3_mix
from tidemark.llm.neighbours import op8_neighbours
from tidemark.llm.ngram_lm import op7_lm
from tidemark.llm.pii import op5_pii
from tidemark.llm.quality import op6_quality
from tidemark.llm.token_files import op12_token_files
from tidemark.llm.toxicity import op10_toxicity
from tidemark.llm.urls import op1_url_filter

Query = Callable[[SparkSession, str], DataFrame]


def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return op1_url_filter(read(spark, sf, "pages"))


def decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return op2_decontaminate(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def mix(spark: SparkSession, sf: str) -> DataFrame:
    return op3_mix(read(spark, sf, "documents"))


def neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return op8_neighbours(read(spark, sf, "embeddings"))


def toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return op10_toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))


def quality(spark: SparkSession, sf: str) -> DataFrame:
    return op6_quality(read(spark, sf, "documents"), read(spark, sf, "labels"))


def pii(spark: SparkSession, sf: str) -> DataFrame:
    return op5_pii(read(spark, sf, "documents"))


def jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return op9_jaccard(read(spark, sf, "documents"))


def html(spark: SparkSession, sf: str) -> DataFrame:
    return op4_html(read(spark, sf, "pages"))


def lm(spark: SparkSession, sf: str) -> DataFrame:
    return op7_lm(read(spark, sf, "documents"))


def lexical(spark: SparkSession, sf: str) -> DataFrame:
    return op11_lexical(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def token_files(spark: SparkSession, sf: str) -> DataFrame:
    return op12_token_files(read(spark, sf, "documents"))


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return op13_conversations(read(spark, sf, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": url_filter,
    "op2_decontaminate": decontaminate,
    "op3_mix": mix,
    "op4_html": html,
    "op5_pii": pii,
    "op6_quality": quality,
    "op7_lm": lm,
    "op8_neighbours": neighbours,
    "op9_jaccard": jaccard,
    "op10_toxicity": toxicity,
    "op11_lexical": lexical,
    "op12_token_files": token_files,
    "op13_conversations": conversations,
}
