"""The corpus pipeline: stages from documents to packed sequences, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadgrain.llm.common import table, written
from loadgrain.llm.langid import NOTHING, identify, train_language_model
from loadgrain.llm.near_copies import drop_near_copies
from loadgrain.llm.packing import pack_powers_of_two
from loadgrain.llm.pii import mask_personal_data
from loadgrain.llm.queries import held_out, tokenizer
from loadgrain.llm.templates import decontaminate

# calibrated probability below which a text counts as being in no known language
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null ones, and those that are in none of the learned languages."""
    model = train_language_model(docs.filter(~held_out() & F.col("doc_id").isNotNull()))
    found = identify(docs, model)
    return found.filter((F.col("lang_pred") != NOTHING) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near copies: five-word shingles, a similarity of 0.8 or more.

    SimHash fingerprints that are close are found at anchors and compared as sets; the rest by their rare shingles.
    """
    return drop_near_copies(docs, words=5, least=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark, verbatim or with other values in its slots."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts; ``n_chars`` follows."""
    masked = mask_personal_data(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as sequences of power-of-two lengths; ``ids`` as a checksum."""
    pieces = pack_powers_of_two(docs, tokenizer(), end_id=2)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]
# tokenizers, trained models and SimHash have no SQL equivalent; the tests compare with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
