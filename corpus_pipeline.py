"""Corpus pipeline: filters and cleans ``documents`` for training.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``; all but the last return the columns of ``documents``, extra
columns included.  Null and empty texts leave with the first stage; an empty
table passes through all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrarium.llm import bpe, decontam, langid, repeats, simhash
from terrarium.llm.common import crc_mod, masked, stored, table, unmasked

#: A document stays if its language is known and its share of the pooled
#: probability is at least this.
MIN_LANGUAGE_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: drops documents without a letter and those whose language
    the model cannot tell."""
    model = langid.fit(docs, F.coalesce(crc_mod("doc_id", 4) != 2, F.lit(False)))
    plain, names = masked(docs)
    scored = langid.identify(plain, model, list(names.values()), names["text"])
    return unmasked(scored.filter((F.col("lang_pred") != langid.UNKNOWN)
                                  & (F.col("score") >= MIN_LANGUAGE_SCORE)), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays, the one with the
    smallest doc_id."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: repeated lines and sentence runs leave all documents
    but the first; a document of which nothing is left goes."""
    plain, names = masked(docs)
    text = names["text"]
    left = repeats.remove_repeats(plain, names["doc_id"], text)
    cut = F.size("removed") > 0
    if "n_chars" in names:
        size = names["n_chars"]
        left = left.withColumn(size, F.when(cut, F.length(text)).otherwise(F.col(size)).cast(plain.schema[size].dataType))
    return unmasked(left.filter(~(cut & ~F.col(text).rlike(r"\S"))), names)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that leak a test item go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: doc_id, the token ids, their number, and the digests of the ids
    and of the text decoded from them."""
    return bpe.round_trip(docs, ["doc_id"], ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Trained models, graph components and merges are not SQL: the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
