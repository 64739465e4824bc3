"""Operator 2: mixing sources to target weights by Pfair scheduling (DataFrame functions only).

A source's exact weight w is its share of the weights of all sources that have
rows.  Its block k (from 0) is released at slot floor(k / w) and due by slot
ceil((k + 1) / w).  In each slot the released block with the earliest deadline
is taken (ties: the larger weight, then the source's name).  The weights add up
to 1, so no deadline is missed and after any slot a source has had its share to
within less than one block, however long the schedule is.

The slots are cut into windows that are scheduled on their own.  How many
blocks a source has had at a window's first slot T follows from the weights
alone: floor(T * w), and one more if its block that straddles T was taken early.
A set of blocks fits into the slots before T if for every slot s those released
from s on are T - s at most; of the straddling blocks earliest deadline first
takes, in the order of deadlines, each that fits beside those taken and all that
are due by T.  So the windows' schedules together are the one that
earliest deadline first makes from slot 0.

Weights are whole numbers W of a common unit (2^-53 of the power of two above
the largest, the accuracy of a double), and products are decimals, so nothing is rounded.

Rows are numbered within their source in an order by hash: rows are counted by
(source, hash bucket), bucket counts are summed up within the source, and the
rows of a bucket are numbered on their own, so a source that holds a third of
all rows is spread over many tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import save

#: slots of a cycle of whole shares (``cycle_slots``)
CYCLE = 1000
#: blocks that are scheduled as one window (as many as there are sources, if these are more)
WINDOW = 256
BLOCK_ROWS = 16
#: rows that a hash bucket of a source has on average at most
BUCKET_ROWS = 20_000


def shares(weights: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """source, weight -> source, share: whole shares that sum to ``cycle`` (largest remainders; every positive weight gets 1 at least)."""
    everything = Window.partitionBy(F.lit(1))
    w = weights.filter("weight > 0").withColumn("exact", F.lit(cycle) * F.col("weight") / F.sum("weight").over(everything))
    w = w.withColumn("least", F.greatest(F.floor("exact"), F.lit(1)).cast("long"))
    w = w.withColumn("left", F.lit(cycle) - F.sum("least").over(everything))
    w = w.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy((F.col("exact") - F.floor("exact")).desc(), "source")))
    # too many ones were given: they come off the largest share
    w = w.withColumn("size", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("least").desc(), "source")))
    more = F.when(F.col("left") > 0, (F.col("place") <= F.col("left")).cast("long")).otherwise(F.when(F.col("size") == 1, F.col("left")).otherwise(0))
    return w.select("source", (F.col("least") + more).alias("share"))


def cycle_slots(weights: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """source, share, k (block within the cycle), slot (0 .. cycle - 1), release, deadline."""
    one = shares(weights, cycle).groupBy().agg(F.expr("sort_array(collect_list(struct(share, source)))").alias("s"))
    n = F.size("s")
    # state: how many blocks each source has had, and the chosen source of every slot so far
    one = one.withColumn("chosen", F.expr(f"""
        aggregate(sequence(0, {cycle - 1}),
          named_struct('had', transform(s, x -> 0L), 'took', cast(array() as array<int>)),
          (state, t) -> aggregate(array(
              array_min(transform(s, (x, i) ->
                if(state.had[i] < x.share and floor(state.had[i] * {cycle} / x.share) <= t,
                   named_struct('due', ceil((state.had[i] + 1) * {cycle} / x.share), 'small', -x.share, 'i', i),
                   named_struct('due', 9223372036854775807L, 'small', 0L, 'i', i))))),
            state, (st, best) -> named_struct(
              'had', transform(st.had, (h, j) -> if(j = best.i, h + 1L, h)),
              'took', concat(st.took, array(best.i)))),
          state -> state.took)"""))
    slots = one.filter(n > 0).select("s", F.posexplode("chosen").alias("slot", "i")).select(F.expr("s[i].source").alias("source"), F.expr("s[i].share").alias("share"), F.col("slot").cast("long").alias("slot"))
    slots = slots.withColumn("k", (F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1).cast("long"))
    return slots.select("source", "share", "k", "slot", F.floor(F.col("k") * cycle / F.col("share")).alias("release"), F.ceil((F.col("k") + 1) * cycle / F.col("share")).alias("deadline"))


def flattened_weights(docs: DataFrame, power: float = 0.5, source_col: str = "source") -> DataFrame:
    """source, weight: each source's rows to a power below 1, so small sources get more than their size."""
    return docs.groupBy(F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source")).agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(power)).alias("weight"))


def _let(name: str, value: str, body: str) -> str:
    """SQL: body, in which name stands for value (computed once)."""
    return f"transform(array({value}), {name} -> {body})[0]"


def windows(sources: list[tuple[int, int]], window: int) -> list[tuple[int, int, int]]:
    """(first slot, slots of a window, end) of stretches of windows, for (weight, blocks) of each source.

    Where sources that have run out leave less than half of the weight, a new
    stretch begins, whose windows are longer in proportion: the windows' number
    grows with the blocks, not with the slots that stay empty.
    """
    total = sum(w for w, _ in sources)
    out, start, weight, left = [], 0, total, total
    ends = sorted((-(-n * total // w), w) for w, n in sources)
    for end, w in ends:
        left -= w
        if 2 * left < weight:
            if end > start:
                out.append((start, max(window, window * total // weight), end))
            start, weight = max(start, end), left
    return out


def schedule(counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """source, weight (positive), blocks -> source, k, slot, release, deadline of every block of every source; saved."""
    spark = counts.sparkSession
    top = counts.agg(F.max("weight")).first()[0]
    unit = 53 - math.frexp(top)[1] if top else 0
    whole = F.greatest(F.round(F.col("weight") * F.lit(2.0 ** (unit // 2)) * F.lit(2.0 ** (unit - unit // 2))).cast("long"), F.lit(1).cast("long"))
    counts = counts.select("source", whole.alias("w"), F.col("blocks").cast("long").alias("n"))
    # a row for each source
    known = sorted((r.source, r.w, r.n) for r in counts.collect())
    total = sum(w for _, w, _ in known)
    stretches = windows([(w, n) for _, w, n in known], max(window, len(known)))
    if stretches and stretches[-1][2] >= 1 << 62:
        raise ValueError("weights too far apart: slots do not fit into 64 bits")
    firsts = [0]
    for start, step, end in stretches:
        firsts.append(firsts[-1] + -(-(end - start) // step))
    table = spark.createDataFrame(known, "source string, w long, n long")
    one = table.groupBy().agg(F.expr("transform(sort_array(collect_list(struct(source, w, n))), (x, i) -> struct(i, x.source, cast(x.w as decimal(17,0)) as w, x.n))").alias("s"))
    # the first slot of each window, and the last window's end
    stretch = ", ".join(f"struct({f}L as number, {a}L as first, {d}L as step, {e}L as last)" for f, (a, d, e) in zip(firsts, stretches))
    slots = spark.range(firsts[-1] + 1).withColumnRenamed("id", "b") if stretches else spark.range(0).withColumnRenamed("id", "b")
    if stretches:
        slots = slots.withColumn("t", F.expr(_let("y", f"element_at(filter(array({stretch}), y -> y.number <= b), -1)", "least(y.first + (b - y.number) * y.step, y.last)")))
    else:
        slots = slots.withColumn("t", F.lit(0).cast("long"))
    big = f"cast({total} as decimal(38,0))"
    dec = "cast({} as decimal(20,0))".format
    # blocks due by t, and whether one more straddles t
    parts = f"transform(s, x -> struct(x.i, x.w, {dec('t')} * x.w div {big} as f, {dec('t')} * x.w % {big} > 0 as more))"
    straddle = f"sort_array(transform(filter(p, x -> x.more), x -> struct(({dec('x.f + 1')} * {big} + x.w - 1) div x.w as d, -x.w as small, x.i, {dec('x.f')} * {big} div x.w as r)))"
    room = f"""transform(array_distinct(concat(array(0L), c.r)), y -> struct(y as s,
        t - y - aggregate(p, 0L, (n, x) -> n + greatest(0L, x.f - (({dec('y')} * x.w + {big} - 1) div {big}))) as u))"""
    taken = """aggregate(c, struct(room, cast(array() as array<int>) as took), (st, x) ->
        if(forall(st.room, y -> y.s > x.r or y.u > 0),
           struct(transform(st.room, y -> struct(y.s, if(y.s <= x.r, y.u - 1, y.u) as u)) as room, concat(st.took, array(x.i)) as took), st)).took"""
    had = _let("p", parts, _let("c", straddle, _let("room", room, _let("took", taken, "transform(p, x -> x.f + if(array_contains(took, x.i), 1L, 0L))"))))
    states = save(slots.crossJoin(F.broadcast(one)).select("b", "t", F.expr(had).alias("had")), "mix-states")
    # each window's blocks, by deadline; then in each step the first of those released
    both = states.join(states.select((F.col("b") - 1).alias("b"), F.col("had").alias("then")), "b").crossJoin(F.broadcast(one))
    blocks = f"""sort_array(flatten(transform(s, x -> if(least(then[x.i], x.n) > had[x.i],
        transform(sequence(had[x.i], least(then[x.i], x.n) - 1), k -> struct(({dec('k + 1')} * {big} + x.w - 1) div x.w as d, -x.w as small, x.i, {dec('k')} * {big} div x.w as r, k)),
        cast(array() as array<struct<d: bigint, small: decimal(17,0), i: int, r: bigint, k: bigint>>)))))"""
    both = save(both.select("t", F.expr(blocks).alias("j")), "mix-windows")
    now = _let("at", "greatest(st.t, array_min(st.left.r))", _let("x", "filter(st.left, y -> y.r <= at)[0]", """struct(at + 1 as t, array_remove(st.left, x) as left,
        concat(st.out, array(struct(x.i, x.k, at as slot, x.r, x.d))) as out)"""))
    out = F.expr(f"""aggregate(j, struct(t, j as left, cast(array() as array<struct<i: int, k: bigint, slot: bigint, r: bigint, d: bigint>>) as out), (st, z) -> {now}).out""")
    done = both.select(F.explode(out).alias("x")).select("x.*")
    names = one.select(F.explode("s").alias("x")).select("x.i", "x.source")
    return save(done.join(F.broadcast(names), "i").select("source", "k", "slot", F.col("r").alias("release"), F.col("d").alias("deadline")), "mix-schedule")


def mix(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", source_col: str = "source", block_rows: int = BLOCK_ROWS, cycle: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """row (a struct of docs' columns), source, id, mix_slot (of the row's block), mix_place (within the block), mix_block, mix_release, mix_deadline.

    Every row stays, once.  Ordered by (mix_slot, mix_place), sources keep
    their weights for as long as all of them last; when one has run out its
    slots stay empty and the others go on in proportion.  A null source counts
    as ''; rows of a source without a positive weight get null slots (they come
    last).  Rows are ordered within a source by a hash of their id (ties: by
    the id, then in any order; the numbers are distinct all the same).
    ``cycle`` slots are scheduled as one window, on which the order does not depend
    while all sources last.
    """
    weights = weights.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.col("weight").cast("double").alias("weight")).groupBy("source").agg(F.sum("weight").alias("weight"))
    bits = (docs.count() // BUCKET_ROWS).bit_length() if buckets is None else (buckets - 1).bit_length()
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(id_col).alias("id"))
    rows = rows.withColumn("hash", F.xxhash64("id"))
    rows = rows.withColumn("bucket", F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long"))
    counts = save(rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    blocks = counts.groupBy("source").agg(F.ceil(F.sum("n") / block_rows).alias("blocks"))
    slots = schedule(blocks.join(weights.filter("weight > 0"), "source"), cycle)
    # at most sources x buckets rows, and as many in a source's window as there are buckets
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("source", "bucket", "n", before.alias("first"))
    # the slots of a bucket's blocks go to its rows with its count, so rows are not shuffled for them
    each = counts.select("source", "bucket", "first", F.explode(F.expr(f"sequence(first div {block_rows}, (first + n - 1) div {block_rows})")).alias("k")).join(slots, ["source", "k"], "left")
    counts = each.groupBy("source", "bucket", "first").agg(F.sort_array(F.collect_list(F.struct("k", "slot", "release", "deadline"))).alias("slots"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("source", "bucket").orderBy("hash", "id")) - 1)
    at = F.col("first") + F.col("place")
    mine = F.get("slots", (F.floor(at / block_rows) - F.floor(F.col("first") / block_rows)).cast("int"))
    rows = rows.join(counts, ["source", "bucket"]).select("row", "source", "id", (at % block_rows).cast("long").alias("mix_place"), mine.alias("m"))
    return rows.select("row", "source", "id", F.col("m.slot").alias("mix_slot"), "mix_place", F.col("m.k").alias("mix_block"), F.col("m.release").alias("mix_release"), F.col("m.deadline").alias("mix_deadline"))


def in_mix_order(mixed: DataFrame, partitions: int | None = None) -> DataFrame:
    """The rows of mix() as they were, range-partitioned and sorted in mixing order."""
    n = partitions or int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("mix_slot").asc_nulls_last(), F.col("mix_place").asc(), F.col("source").asc(), F.col("id").asc()]
    return mixed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("row.*")
