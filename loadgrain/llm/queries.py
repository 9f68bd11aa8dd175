"""The registered queries of the operators on training data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadgrain.llm.alignment import align_tokenizers
from loadgrain.llm.common import table
from loadgrain.llm.embeddings import near_embeddings
from loadgrain.llm.huffman import read_ids, write_ids
from loadgrain.llm.langid import identify, train_language_model
from loadgrain.llm.merkle import LOWER, UPPER, leaf_digest, merkle_manifest, prove
from loadgrain.llm.oracle import ORACLE
from loadgrain.llm.packing import pack_powers_of_two
from loadgrain.llm.page_text import extract_main_text
from loadgrain.llm.passages import remove_repeated_passages
from loadgrain.llm.pii import BASE_KINDS, find_personal_data
from loadgrain.llm.secret_scan import as_text, find_secrets
from loadgrain.llm.simhash import simhash_components
from loadgrain.llm.suffixes import remove_repeated_bytes
from loadgrain.llm.templates import decontaminate
from loadgrain.llm.tokens import read_tokenizer
from loadgrain.plans.scratch import new_folder

__all__ = ["ORACLE", "QUERIES"]

TOKENIZER = "word_bpe_49k.json"


def tokenizer() -> str:
    import public_tokenizers

    return read_tokenizer(public_tokenizers.path(TOKENIZER))


def template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "items", F.size("items").cast("long").alias("n_items"))


def huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "huffman-ids")
    write_ids(table(spark, sf_dir, "documents"), path, tokenizer(), end_id=1)
    return read_ids(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_powers_of_two(table(spark, sf_dir, "documents"), tokenizer(), end_id=2)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "bucket",
    )


def held_out() -> Column:
    """Documents that a classifier must not learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train_language_model(docs.filter(~held_out() & F.col("doc_id").isNotNull()))
    found = identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(table(spark, sf_dir, "embeddings"), least=0.98)


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
        as_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_passages(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(table(spark, sf_dir, "documents"), length=100)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("begins").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(as_text(F.col("base")), 256).alias("base_sha256"),
        as_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    definition = read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    return align_tokenizers(table(spark, sf_dir, "documents"), definition, model)


def merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the documents claims a text with A-Z in lower case."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    claimed = F.when(tampered, leaf_digest(F.translate("text", UPPER, LOWER)))
    found = prove(merkle_manifest(table(spark, sf_dir, "documents"), claimed))
    return found.withColumn("proof_sha256", F.sha2("proof", 256)).drop("proof")


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {
    "op1_template_leaks": template_leaks,
    "op2_huffman_ids": huffman_ids,
    "op3_language_id": language_id,
    "op4_simhash_anchors": simhash,
    "op5_secret_entropy": secrets,
    "op6_pack_powers_of_two": pack,
    "op7_de_bruijn": passages,
    "op8_spherical_caps": spherical_caps,
    "op9_crf_pii": personal_data,
    "op10_bucket_pointers": suffixes,
    "op11_token_spans": alignment,
    "op12_merkle_veb": merkle,
    "op13_line_blocks": main_text,
}
