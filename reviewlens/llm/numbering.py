"""Places of rows within groups, without a task for a whole group.

Rows are range-partitioned and sorted by group and order, so a group of any size
spreads over many tasks; each task counts within its range, and one small row for
each partition tells how many rows of its first group lie in earlier ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import save


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """rows with ``pos``, the 0-based place of a row in its group (null is a group) by ``order`` (nulls first)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, group, *order).sortWithinPartitions(group, *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields) + ", _part long, _seq long, _at long"
    column = ranged.columns.index(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, at, last = TaskContext.get().partitionId(), 0, -1, object()
        for batch in batches:
            places = []
            for g in batch.column(column).to_pylist():
                at = at + 1 if g == last else 0
                last = g
                places.append(at)
            k = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * k, pa.int64()), pa.array(range(seq, seq + k), pa.int64()), pa.array(places, pa.int64())],
                                             [*batch.schema.names, "_part", "_seq", "_at"])
            seq += k

    # saved once: counts and places come from the same partitioning, also where a task is repeated
    out = save(ranged.mapInArrow(run, schema), name)
    last = out.groupBy("_part").agg(F.max(F.struct("_seq", F.col(group).alias("_group"), "_at")).alias("m")).select("_part", "m._group", "m._at")
    before = F.sum(F.col("_at") + 1).over(Window.partitionBy("_group").orderBy("_part"))
    carry = last.select(F.lead("_part").over(Window.orderBy("_part")).alias("_to"), "_group", before.alias("_before"))  # a row for each partition
    out = out.join(F.broadcast(carry), (F.col("_part") == F.col("_to")) & F.col(group).eqNullSafe(F.col("_group")), "left")
    return out.select(*rows.columns, (F.col("_at") + F.coalesce("_before", F.lit(0))).alias("pos"))
