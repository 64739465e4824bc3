"""Joins of many rows with a model of one row per key, some of whose keys are hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dealt_anew(model: DataFrame, key: str) -> DataFrame:
    """``model`` (one row per ``key``) spread by another hash than a join by ``key``.

    An aggregate by ``key`` would enter such a join with the partitioning it
    has, and adaptive execution splits skewed partitions only where the join
    shuffles both sides.  So the model (small beside the rows that it meets) is
    shuffled once more, and the rows of a word that every review has are split
    over many tasks.
    """
    return model.repartition(F.xxhash64(key))


# A key is hot when it has more than one row in so many; there are at most so many hot keys.
HOT_KEYS = 1024


def split_join(rows: DataFrame, table: DataFrame, key: str, size: str, total: Column) -> DataFrame:
    """``rows`` inner join ``table`` (one row per ``key``) where ``size`` counts
    the rows of a key and ``total`` is at least the number of rows.

    The few keys (``HOT_KEYS`` at most) that hold more than ``total /
    HOT_KEYS`` rows are broadcast and their rows get a random place in the
    shuffle of the others, so a key that every document has is spread over all
    tasks."""
    least = F.floor(total / HOT_KEYS) + 1
    no_place = F.least(F.col(size), F.lit(-1)).cast("int")  # -1, but no constant: those are taken out of a join's keys
    values = [c for c in table.columns if c not in (key, size)]
    hot = table.filter(F.col(size) > least).select(F.col(key), F.struct(*values).alias("_hot"))
    cold = table.filter(F.col(size) <= least).select(F.col(key).alias("_key"), no_place.alias("_place"), F.struct(*values).alias("_cold"))
    spread = F.pmod(F.hash(*rows.columns), F.lit(1 << 20))
    out = rows.join(F.broadcast(hot), key, "left").withColumn("_place", F.when(F.col("_hot").isNotNull(), spread).otherwise(-1))
    out = out.join(cold, (out[key] == cold["_key"]) & (out["_place"] == cold["_place"]), "left")
    out = out.withColumn("_found", F.coalesce("_hot", "_cold")).filter(F.col("_found").isNotNull())
    return out.select(*rows.columns, *[F.col(f"_found.{c}").alias(c) for c in values])
