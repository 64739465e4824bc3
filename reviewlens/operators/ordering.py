"""Running sequence numbers and exact "first n" by distributed order statistics.

A global ``row_number()`` without a partition key moves every row into one
task.  Here rows are dealt into buckets of neighbouring keys by boundaries from
a hash sample of the keys; counts per bucket (a few thousand rows) give each
bucket's offset, and only places within a bucket are ranked.  Everything is one
lazy plan: the boundaries are a scalar subquery, so no job runs while a
DataFrame is built.  The sample depends on the keys alone, so a repeated task
deals its rows as before.

The input is read once for the sample, once for the counts and once for the
rows: number narrow key columns and join the numbers to what is costly to make.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Keys that the sample holds on average, and boundaries in a step of the search for a bucket.
SAMPLE_KEYS = 256
SEARCH_STEP = 16


def _key(order: str | list[str]) -> Column:
    """The ordering columns as one comparable value (nulls first)."""
    return F.struct(*([order] if isinstance(order, str) else order))


def range_buckets(df: DataFrame, order: str | list[str], sample_keys: int = SAMPLE_KEYS) -> DataFrame:
    """df + _bucket, a number that never falls as the key grows; equal keys share it.

    About ``sample_keys`` + 1 buckets of similar sizes.  The boundaries are
    searched in two steps of some ``SEARCH_STEP`` comparisons."""
    n = df.select(F.count(F.lit(1))).scalar()
    every = F.greatest(F.lit(1), F.floor(n / sample_keys)).cast("long")
    chosen = df.select(_key(order).alias("k")).filter(F.pmod(F.xxhash64("k"), every) == 0)
    keys = chosen.agg(F.sort_array(F.collect_set("k")).alias("keys"))  # distinct keys, so bounded by the share sampled
    steps = F.expr(f"transform(sequence(0, greatest(0, cast((size(keys) - 1) div {SEARCH_STEP} as int))), i -> keys[i * {SEARCH_STEP}])")
    bounds = keys.select(F.when(F.size("keys") > 0, F.struct("keys", steps.alias("steps")))).scalar()
    dealt = df.withColumn("_key", _key(order)).withColumn("_bounds", bounds)  # a lambda takes no subquery
    dealt = dealt.withColumn("_step", F.expr("greatest(size(filter(_bounds.steps, x -> x <= _key)) - 1, 0)"))
    within = F.expr(f"size(filter(slice(_bounds.keys, _step * {SEARCH_STEP} + 1, {SEARCH_STEP}), x -> x <= _key))")
    return dealt.withColumn("_bucket", F.coalesce(F.col("_step") * SEARCH_STEP + within, F.lit(0))).drop("_key", "_bounds", "_step")


def _with_offsets(df: DataFrame, order: str | list[str], sample_keys: int) -> DataFrame:
    """df with _bucket, _off (rows in the buckets before) and _n (rows in the bucket)."""
    dealt = range_buckets(df, order, sample_keys)
    counts = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    # a row for each bucket: a proven bound, so broadcasting is safe
    return dealt.join(F.broadcast(counts.withColumn("_off", before)), "_bucket")


def sequence_numbers(df: DataFrame, order: str | list[str], out: str = "seq",
                     num_partitions: int | None = None, sample_keys: int = SAMPLE_KEYS) -> DataFrame:
    """df + ``out`` (BIGINT, 0-based) numbering rows by ``order``
    (rows with equal keys get distinct numbers in an unspecified order).
    ``num_partitions``: about how many buckets, in place of ``sample_keys``."""
    sample_keys = num_partitions or sample_keys
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(_key(order)))
    return (_with_offsets(df, order, sample_keys)
            .withColumn(out, F.col("_off") + place - 1)
            .drop("_bucket", "_off", "_n"))


def smallest(df: DataFrame, n: int | None, order: str | list[str], sample_keys: int = SAMPLE_KEYS) -> DataFrame:
    """The ``n`` rows of df that come first by ``order`` (None: all of them).

    Buckets that end within the first ``n`` rows are kept as they are; only the
    one in which the n-th row lies is ranked."""
    if n is None:
        return df
    if n == 0:
        return df.limit(0)
    rows = _with_offsets(df, order, sample_keys)
    end = F.col("_off") + F.col("_n")
    edge = rows.filter((F.col("_off") < n) & (end > n))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(_key(order)))
    edge = edge.withColumn("_place", place).filter(F.col("_off") + F.col("_place") <= n).drop("_place")
    return rows.filter(end <= n).unionByName(edge).drop("_bucket", "_off", "_n")
