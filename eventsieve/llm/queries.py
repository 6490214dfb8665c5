"""Registered queries of the training-data operators: opN_<name>(spark, sf_dir) over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventsieve.session import scratch_path

from . import chat, language, licenses, mixing, multi_index, ngram_join, packing, pieces, quality, secrets, signatures, whitening, wrappers
from .common import staged, table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the isolation forest's verdict for every document."""
    stats = staged(quality.rule_stats(table(spark, sf_dir, "documents")), "rule-stats")
    return quality.judge(stats, quality.fit(stats, table(spark, sf_dir, "labels"))).drop("n_lines")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates of every document."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class, links and copies of every document."""
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies")


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, through a blob ledger that starts empty."""
    return secrets.findings_by_document(table(spark, sf_dir, "documents"), scratch_path(spark, "secret-ledger"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text back."""
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op6_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every 50th, over all vectors."""
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every formatted conversation, and of one whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_turns(rows.union(extra)))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document, with its source's target."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document, with a digest of its ids."""
    pieces = staged(packing.token_pieces(table(spark, sf_dir, "documents")), "token-pieces")
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).withColumn("length", F.col("length").cast("long"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened leading components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return signatures.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scans": op2_license_scans,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_secret_scans": op4_secret_scans,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_vector_search": op6_vector_search,
    "op7_page_text": op7_page_text,
    "op8_language_id": op8_language_id,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_source_mix": op10_source_mix,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_ranked_search": op13_ranked_search,
}
