"""The corpus pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. run() writes
each stage's result as Parquet in the shared folder and reads it again for the
next, so a lost executor repeats tasks of one stage only. All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, line_dedup, mixing, ngram_join, packing
from tessera.llm.native import documents
from tessera.workspace import materialize, release

#: A text whose best language scores less than this is no known language's text; see langid for what the score's half is.
MIN_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a known language; lang becomes the predicted one.

    Rejected: texts without a letter, and texts under the bounds that the model
    takes from labelled texts it did not learn from: other languages, other
    scripts, random letters. The model is fitted on the labelled
    documents of the stage's own input that are not held out. If there are none,
    every text with a letter stays and lang is as it was.
    """
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    if model is None:
        # Nothing to learn from, so nothing can be told: only texts without a letter go.
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.detect(docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), F.col("text").alias("row_text")), model, "row_text")
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE))
    return kept.select(*[(F.col("lang_pred") if c == "lang" else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents repeat; every document stays, if with an empty text."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8, the smallest doc_id."""
    join = ngram_join.Join(n=5, num=80, den=100)
    groups = ngram_join.jaccard_components(docs.select("doc_id", "text"), join)
    stays = materialize(groups.where("doc_id = component_id").select("doc_id").distinct(), "kept-ids")
    kept = docs.join(stays.hint("merge"), "doc_id", "left_semi").select(*[f"`{c}`" for c in docs.columns])
    # Rows that share a doc_id are one document to the join; a row without one is in no group.
    return kept.union(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws of the documents, so that the words of each source come near its target."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the drawn documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: String kernels and best-fit packing are not SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    before = None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            release(before)
        before = docs
    return docs
