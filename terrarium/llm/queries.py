"""The dealt queries: each applies one operator, with its production
parameters, to a whole table, and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrarium.llm import (
    bpe, decontam, embed_dedup, hnsw, html_text, langid, licenses, oracle, prefix_trie, quality, repeats, simhash,
    toxicity, vector_codes)
from terrarium.llm.common import crc_mod, table


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs, ~held_out)
    return (langid.identify(docs, model, ["doc_id"])
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return (quality.score(docs, model, ["doc_id"])
            .select("doc_id", held_out.alias("held_out"), "score",
                    F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for every document and benchmark item that it leaks."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 nearest of every 50th vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"), html_text.fit(), ["page_id", "url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"),
                        F.length("main_text").cast("long").alias("n_chars"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, the chain's probabilities, and toxic (1 if the last
    one is at least 0.5) of every document."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return (toxicity.score(docs, chain, ["doc_id"])
            .select("doc_id", held_out.alias("held_out"), *toxicity.CATEGORIES, "score",
                    F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("toxic")))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), ["doc_id"])


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, and the template spans of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])

    def names(*columns: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.col(f"{c}.label") for c in columns]))), ",")

    covered = F.array_max(F.col("spans.coverage"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.start")).alias("first_word"),
        F.array_max(F.col("places.start")).alias("last_word"),
        names("places").alias("base_labels"), names("places", "spans").alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(covered, F.lit(0.0))).alias("score"), "spans")


def op10_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, remaining text, spans removed and kept, code points removed, of
    every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda total, s: total + (s["stop"] - s["start"]))
    return (repeats.remove_repeats(docs)
            .select("doc_id", "text", "removed", "kept", gone.alias("chars_removed")))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 of every node."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_decontaminate": op2_decontaminate,
    "op3_language_id": op3_language_id,
    "op4_hnsw": op4_hnsw,
    "op5_html_text": op5_html_text,
    "op6_toxicity": op6_toxicity,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_simhash": op8_simhash,
    "op9_license_scan": op9_license_scan,
    "op10_repeated_units": op10_repeated_units,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_conversation_trie": op13_conversation_trie,
}

#: The others have trained models, merges, automata or hashes that SQL lacks.
ORACLE_SQL: dict[str, str] = oracle.SQL
