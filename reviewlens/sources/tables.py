"""Readers for the parquet test-data tables and the corpus views built on them.

Mapping of the review corpus onto the tables:

* labelled corpus  = ``documents`` inner join ``labels``; label 'pos' when
  ``quality = 1`` else 'neg'
* unlabelled (test) set = ``documents`` left-anti ``labels``

Only the columns a job needs are selected, so the parquet scan reads just
those (column pruning reaches ``ReadSchema``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, label ('pos' | 'neg')."""
    return (table(spark, sf_dir, "labels")
            .select("doc_id",
                    F.when(F.col("quality") == 1, F.lit("pos"))
                     .otherwise(F.lit("neg")).alias("label")))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, label: the training corpus."""
    return documents(spark, sf_dir).join(labels(spark, sf_dir), "doc_id")


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text: documents without a label (the query / test set)."""
    return documents(spark, sf_dir).join(
        table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, html."""
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")
