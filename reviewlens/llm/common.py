"""Helpers of the operators: shared storage, checked broadcasts, skew-safe look-ups.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir`` (Parquet, a new sub-folder for each call), so a lost
executor costs a re-read and never a recomputation of the whole lineage.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: rows of one or two numbers each that may be broadcast; counted before it is done
BROADCAST_ROWS = 1_000_000
#: a key with more than one row in so many is hot, so there are at most so many hot keys
HOT_KEYS = 1024


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir`` (a scratch folder only where that is unset)."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 4 << 20) -> None:
    """Arrow batches of so many rows and bytes at most from here on: what a Python worker and its task hold of a table."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checked_broadcast(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df (a saved table of narrow rows) marked for broadcast if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def look_up(rows: DataFrame, table: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows LEFT JOIN table (unique ``key``, a saved table) where ``size`` says how many rows have the key.

    Keys of more than total / HOT_KEYS rows (at most HOT_KEYS of them) are
    broadcast and their rows stay where they are; all other rows are shuffled
    by the key, of which none is hot.  The rows of hot keys get a key of their
    own for that shuffle, so they spread evenly.
    """
    least = total // HOT_KEYS + 1
    values = [c for c in table.columns if c != key]
    no_salt = F.least(F.col(size), F.lit(-1)).cast("int")  # -1, but no constant: those are taken out of a join's keys
    hot = table.filter(F.col(size) > least).select(F.col(key), *[F.col(c).alias("_h_" + c) for c in values])
    cold = table.filter(F.col(size) <= least).select(F.col(key).alias("_key"), no_salt.alias("_salt"), *values)
    out = rows.join(F.broadcast(hot), key, "left")
    is_hot = F.col("_h_" + size).isNotNull()
    out = out.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), F.pmod(F.hash(*rows.columns), F.lit(1 << 20))).otherwise(-1))
    out = out.join(cold, (out[key] == cold["_key"]) & (out["_salt"] == cold["_salt"]), "left")
    return out.select(*[rows_c for rows_c in rows.columns], *[F.coalesce("_h_" + c, c).alias(c) for c in values])
