"""Operator 8: exact dedup by skew-safe combining (DataFrame functions only).

1. Each task merges its own equal texts (the partial aggregation of the first
   shuffle; the salt is the task's number, so a task's copies share it).
2. Salted groups: (digest, salt, text) are merged; a text that any number of
   tasks hold is spread over ``salts`` groups.
3. The salt winners are merged globally, at most ``salts`` rows a text.

Texts are group keys beside their digests, so full content is compared at
every stage and equal digests of different texts never merge.  Each row's
group is then looked up by its digest; where texts share a digest (seen in
stage 3), those rows alone are looked up by the full text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import checked_broadcast, look_up, save, shared_folder

#: deleted before texts are compared
SPACES = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def sha256_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_digest, salts: int | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, keep_id, group_size, kept, text_digest.

    Texts are equal if identical without white space; null counts as empty.
    The row with the most code points in the original text stays, of those the
    smallest id; a null id is the largest.  Of repeated rows (same id, equal
    texts) all are marked kept when their id stays: they are the same row.
    An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_raw"))
    rows = rows.withColumn("_text", normalised(F.col("_raw")))
    rows = rows.withColumn("digest", digest(F.col("_text")))
    points = F.length(F.coalesce("_raw", F.lit(""))).cast("decimal(38,0)")
    # one number for (most points, then smallest id; 0: null id): decimals merge in the hash map, structs would be sorted
    two63, two64 = F.lit("9223372036854775808").cast("decimal(20,0)"), F.lit("18446744073709551616").cast("decimal(20,0)")
    rank = (points.cast("decimal(11,0)") * two64 + F.coalesce(two63 - F.col("doc_id").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))).cast("decimal(38,0)")
    ids = save(rows.select("doc_id", "digest"), "dedup-ids")
    n = salts or max(8, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    parts = rows.select("digest", "_text", rank.alias("best"), (F.spark_partition_id() % n).alias("salt"))
    salted = parts.groupBy("digest", "salt", "_text").agg(F.max("best").alias("best"), F.count(F.lit(1)).alias("n"))
    merged = salted.groupBy("digest", "_text").agg(F.max("best").alias("best"), F.sum("n").alias("n"))
    best_id = F.pmod(F.col("best"), two64)
    keep = F.when(best_id == 0, F.lit(None)).otherwise(two63 - best_id).cast("long")
    # texts are kept only in groups that share a digest; (digest, group) is unique
    groups_path = shared_folder(spark, "dedup-groups")
    (merged.select("digest", "_text", keep.alias("keep_id"), F.col("n").alias("group_size"))
     .groupBy("digest").agg(F.count(F.lit(1)).alias("variants"), F.first("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
     .write.parquet(groups_path))
    groups = spark.read.parquet(groups_path)
    total = ids.count()
    out = look_up(ids, groups, "digest", "group_size", total)
    if groups.filter("variants > 1").limit(1).count():
        shared = rows.join(groups.filter("variants > 1").select("digest"), "digest", "left_semi")
        by_text = merged.select("digest", "_text", keep.alias("keep_id"), F.col("n").alias("group_size"))
        exact = shared.join(by_text, ["digest", "_text"]).select("doc_id", "digest", "group_size", "keep_id")
        out = out.filter("variants = 1").select(*exact.columns).unionByName(exact)
    return out.select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_digest"))


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = 200_000) -> DataFrame:
    """The rows of docs that stay, with all their columns; of repeated rows (same id, equal texts) one stays.

    Where ids are unique, the dropped ids are taken out; else the rows are
    found by (id, digest) and one is taken of each.
    """
    found = save(exact_dedup(docs, id_col, text_col), "dedup-found")
    n, ids = found.agg(F.count(F.lit(1)), F.count_distinct(F.coalesce("doc_id", F.lit(-(2**63))))).first()
    if n == ids:
        dropped = checked_broadcast(save(found.filter("not kept").select(F.col("doc_id").alias("_dropped")), "dedup-dropped"), most)
        return docs.join(dropped, docs[id_col].cast("long").eqNullSafe(dropped["_dropped"]), "left_anti")
    kept = found.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_digest").alias("_digest")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("_rid"), sha256_digest(normalised(F.col(text_col).cast("string"))).alias("_rdigest"), F.length(text_col).alias("_points"))
    rows = rows.join(kept, F.col("_rid").eqNullSafe(F.col("_id")) & (F.col("_rdigest") == F.col("_digest")), "left_semi")
    return rows.groupBy("_rid", "_rdigest").agg(F.max_by("row", F.coalesce("_points", F.lit(0))).alias("row")).select("row.*")
