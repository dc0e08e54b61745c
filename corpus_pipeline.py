"""Documents to training shards, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import given, saved, table
from daybook.llm.decontaminate import decontaminated
from daybook.llm.language import UNDETERMINED, held_out, train, with_language, with_letters
from daybook.llm.mix import mixed_documents
from daybook.llm.shard import shuffled_into_shards
from daybook.llm.simhash import one_of_each

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts whose language can be told; null ones and those without a letter go.

    A low score is not used; README has what it could tell. If nothing could be learned, no
    language can be told, and the texts with a letter stay.
    """
    model = train(docs.where(~held_out()))
    if not model.languages:
        return with_letters(docs)
    names = given(docs, text=F.col("text"))
    scored = with_language(names, model)
    return scored.where(F.col("lang_pred") != UNDETERMINED).select("given.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return one_of_each(docs, shingle=4, most=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it."""
    return shuffled_into_shards(docs, shards=16)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None
"""SQL expresses neither the classifier nor the fingerprints; tests compare with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage: documents with ``shard`` and ``slot``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
