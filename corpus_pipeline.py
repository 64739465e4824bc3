"""A training-data pipeline of five operators: each stage works on all rows that the one before kept.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  The first three return the columns of docs, mix_sources adds ``MIXED``
(the reader keeps no order between files), which encode hands on.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import bpe, dedup, langid, mixing, ngram_join
from reviewlens.llm.common import checked_broadcast, save, small_batches, table
from reviewlens.llm.queries import TOKENIZER

#: SQL cannot express the language model, the mixing order or the encoding: tests hold run() against brute force
ORACLE_SQL = None
#: place in the mixing order: of a row's block, and within the block
MIXED = ("mix_slot", "mix_place")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, no letter) or below the calibrated threshold go."""
    small_batches(spark)
    # the text goes to the tasks' Python once, the other columns beside it as one struct
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"))
    found = langid.predict(rows, langid.train(docs), keep=("row",), keep_text=True).filter("not rejected")
    return found.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest stays (ties: the smallest id)."""
    return dedup.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (similarity 0.8 or more) the one with the smallest id stays.

    Rows with the same id and text stay or go together; rows without an id stay.
    """
    small_batches(spark)
    found = ngram_join.ngram_join(docs, 5, Fraction(4, 5)).filter("doc_id <> component_id")
    dropped = checked_broadcast(save(found.select(F.col("doc_id").alias("_dropped"), F.col("text_hash").alias("_text")).distinct(), "near-dropped"))
    same = (docs["doc_id"].cast("long") == dropped["_dropped"]) & (F.xxhash64(docs["text"].cast("string")) == dropped["_text"])
    return docs.join(dropped, same, "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which their sources keep their target weights (square roots of their sizes), with their places in it (MIXED)."""
    docs = docs.drop(*MIXED)
    mixed = mixing.mix(docs, mixing.flattened_weights(docs))
    return mixing.in_mix_order(mixed.withColumn("row", F.struct("row.*", *MIXED)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the place in the mixing order (as far as docs has it), and the token ids with digests of them and of the text that they decode to."""
    small_batches(spark)
    return bpe.encode_documents(docs, TOKENIZER, ("n_tokens", "ids", "ids_sha256", "decoded_sha256"), keep=("doc_id", "lang", "source", *[c for c in MIXED if c in docs.columns]))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
