"""Operator 11: the trie of conversations' prefixes, by a skeleton of splitters.

A conversation is a path of turns; a turn's name is a digest of role and text, so
a path is a string of names of equal length and the members of a node (all paths
that begin with it) are neighbours in sorted order.  Paths are dealt into shards
by splitters, taken from a sample of the sorted (path, conversation) keys.  Only a
node that is a prefix of a splitter can have members in two shards: those nodes are
the skeleton, a trie of the splitters' paths that every task gets.

A task sorts its shard and walks it with a stack of open nodes.  A node off the
skeleton is finished there.  Of a skeleton node the shard gives what it has: its
members, the children, leaves and tokens of the parts off the skeleton, the ids that
end in it.  Those partial aggregates are reduced over the shards by the node, and
what counts once for each skeleton node (being a leaf, one text not saved) is added
to its ancestors in the skeleton.

Equal paths are split between shards by the conversations' ids, so a conversation
that is repeated any number of times spreads over shards.  Paths are cut into
segments of ``SEGMENT`` turns; the tries of later segments, one for each path that
leads to them (its anchor), are built first, and their roots' values go on
into the segment before.  So no row, group or task holds an unbounded path.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import checked_broadcast, look_up, save
from reviewlens.llm.numbering import numbered

#: turns in a segment
SEGMENT = 256
#: characters of a turn's name (120 bits in base 64)
NAME = 20
#: segments in a shard, and sampled keys for each shard
SHARD_ROWS = 1 << 16
SAMPLED = 20
_TOP = "A" * NAME
_CHUNK = 1 << 15


def turn_name(role: Column, text: Column) -> Column:
    return F.substring(F.base64(F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))), 1, NAME)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """c, depth (from 1), name, bytes, total (turns of c) of every turn of the rebuilt conversations, and c, total with
    a null depth for each of them.

    Conversation c begins with the first h turns of conversation c - c % 5 (all if it has fewer, none if it does not
    exist) and goes on with its own turns after its first h; h = crc32(decimal c) % 9.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), turn_name(role, text).alias("name"), F.octet_length(text).cast("long").alias("bytes"))
    rows = numbered(save(rows, "trie-turns"), "c", ["turn", "name"], "trie-numbered")
    sizes = save(rows.groupBy("c").agg(F.count(F.lit(1)).alias("n_own")), "trie-sizes")
    h = F.crc32(F.col("c").cast("string").cast("binary")) % 9
    base = F.col("c") - F.pmod(F.col("c"), F.lit(5))
    of_base = sizes.select(F.col("c").alias("_base"), F.col("n_own").alias("n_base"))
    convs = sizes.withColumn("_b", base).join(of_base, F.col("_b") == F.col("_base"), "left").withColumn("h", h)
    convs = convs.withColumn("first", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = save(convs.select("c", "n_own", "h", "first", (F.col("first") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("total")), "trie-conversations")
    own = rows.select("c", "pos", F.lit(True).alias("own"), "name", "bytes")
    lent = rows.filter((F.pmod("c", F.lit(5)) == 0) & (F.col("pos") < 8)).select(F.explode(F.sequence(F.col("c"), F.col("c") + 4)).alias("c"), "pos", F.lit(False).alias("own"), "name", "bytes")
    all_rows = own.unionByName(lent)
    found = look_up(all_rows, convs, "c", "n_own", convs.agg(F.sum("n_own")).first()[0] or 0)
    kept = F.when(F.col("own"), F.col("pos") >= F.col("h")).otherwise(F.col("pos") < F.col("h"))  # null where c does not exist
    depth = F.when(F.col("own"), F.col("first") + F.col("pos") - F.col("h")).otherwise(F.col("pos")) + 1
    turns = found.filter(kept).select("c", depth.alias("depth"), "name", "bytes", "total")
    null = F.lit(None)
    return turns.unionByName(convs.select("c", null.cast("long").alias("depth"), null.cast("string").alias("name"), null.cast("long").alias("bytes"), "total"))


def segments(turns: DataFrame, segment: int) -> DataFrame:
    """c, seg, anchor, path, bytes (list), ends (whether c ends in it), next_anchor (null but for a full segment); saved.

    Segment s has the turns s * segment + 1 .. (s + 1) * segment; a conversation that ends with a full segment has an
    empty one after it, so that all members of a segment's last node have one.
    """
    depth = F.col("depth")
    segs = F.when(depth.isNull(), F.array(F.lit(0).cast("long"))).when(depth % segment == 0, F.array(F.floor((depth - 1) / segment), F.floor(depth / segment))).otherwise(F.array(F.floor((depth - 1) / segment)))
    rows = turns.withColumn("seg", F.explode(segs))
    mine = F.floor((depth - 1) / segment) == F.col("seg")
    rows = rows.groupBy("c", "seg").agg(F.max("total").alias("total"), F.sort_array(F.collect_list(F.when(mine, F.struct("depth", "name", "bytes")))).alias("t"))  # ``segment`` turns at most
    rows = rows.select("c", "seg", F.array_join(F.col("t.name"), "").alias("path"), F.col("t.bytes").alias("bytes"), (F.col("total") == F.col("seg") * segment + F.size("t")).alias("ends"), (F.size("t") == segment).alias("full"))
    rows = save(rows, "trie-segments")
    # anchors: a hash of all the segments before, in the few conversations that have several
    one = rows.filter((F.col("seg") == 0) & ~F.col("full")).select("*", F.lit(_TOP).alias("anchor"), F.lit(None).cast("string").alias("next_anchor"))
    until = Window.partitionBy("c").orderBy("seg")
    x, y = (F.bit_xor(F.xxhash64(F.lit(k), F.col("seg"), F.col("path"))).over(until) for k in ("x", "y"))
    name = F.substring(F.base64(F.unhex(F.concat(F.lpad(F.hex(x), 16, "0"), F.lpad(F.hex(y), 16, "0")))), 1, NAME)
    several = rows.filter((F.col("seg") > 0) | F.col("full")).withColumn("_all", name)
    several = several.withColumn("anchor", F.coalesce(F.lag("_all").over(until), F.lit(_TOP))).withColumn("next_anchor", F.when(F.col("full"), F.col("_all"))).drop("_all")
    return save(one.unionByName(several).select("c", "seg", "path", "bytes", "ends", "anchor", "next_anchor"), "trie-anchored")


def skeleton_of(splitters: list[tuple[str, int]]) -> tuple[dict[tuple[int, str], int], list[tuple[int, int | None, int, str | None]]]:
    """The trie of the splitters' paths: (node, name) -> child, and (node, parent, index, name) of all nodes.  Node 0 is the empty path."""
    children: dict[tuple[int, str], int] = {}
    nodes: list[tuple[int, int | None, int, str | None]] = [(0, None, 0, None)]
    for key, _ in splitters:
        at = 0
        for k in range(0, len(key), NAME):
            name = key[k:k + NAME]
            to = children.get((at, name))
            if to is None:
                to = children[at, name] = len(nodes)
                nodes.append((to, at, k // NAME + 1, name))
            at = to
    return children, nodes


class _Node:
    __slots__ = ("sid", "name", "least", "n", "children", "leaves", "saved", "bytes", "ends", "n_ends", "waiting", "below")

    def __init__(self, sid: int, name: str, size: int):
        self.sid, self.name, self.bytes = sid, name, size
        self.least, self.n, self.children, self.leaves, self.saved, self.n_ends = None, 0, 0, 0, 0, 0
        self.ends, self.waiting, self.below = None, [], None


NODE, PART, ENDS = 0, 1, 2
_OUT = "kind int, sid long, parent_sid long, shard long, place long, index int, name string, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, bytes long, b_children long, b_leaves long, b_saved long, ends string"
_OUT_TYPES = pa.schema([(c.split()[0], {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[c.split()[1]]) for c in _OUT.split(", ")])
_EMPTY = hashlib.sha256(b"").hexdigest()


class _Walk:
    """The walk over sorted shards; ``out`` gets rows of _OUT."""

    def __init__(self, children: dict[tuple[int, str], int]):
        self.trie, self.out, self.stack, self.key, self.shard, self.place = children, [], [], "", -1, 0

    def _emit(self, kind: int, **values) -> None:
        self.out.append((kind, *(values.get(f.name) for f in list(_OUT_TYPES)[1:])))

    def flush_ends(self, node: _Node) -> None:
        self._emit(ENDS, sid=node.sid, shard=self.shard, place=self.place, ends=",".join(node.ends))
        self.place += 1
        node.ends = []

    def close(self) -> None:
        node, index = self.stack.pop(), len(self.stack)
        parent = self.stack[-1] if self.stack else None
        b = node.below
        if node.sid >= 0:
            node.saved += node.n * node.bytes
            if node.ends:
                self.flush_ends(node)
            self._emit(PART, sid=node.sid, conv_id=node.least, n_convs=node.n, n_children=node.children, n_leaves=node.leaves, saved=node.saved, bytes=node.bytes,
                       b_children=b and b[0], b_leaves=b and b[1], b_saved=b and b[2])
        else:
            node.saved += (node.n - 1) * node.bytes
            if b:
                node.children, node.leaves, node.saved = node.children + b[0], node.leaves + b[1], node.saved + b[2]
            elif not node.children:
                node.leaves = 1
            for row in node.waiting:
                self._emit(NODE, parent_conv_id=node.least, **row)
            row = {"index": index, "name": node.name if index == 1 else None, "conv_id": node.least, "n_convs": node.n, "n_children": node.children, "n_leaves": node.leaves,
                   "saved": node.saved, "ends": node.ends.hexdigest() if node.ends else _EMPTY}
            if parent.sid >= 0:
                self._emit(NODE, parent_sid=parent.sid, **row)
            else:
                parent.waiting.append(row)
            parent.children += 1
        if parent is not None:
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
            parent.n, parent.leaves, parent.saved = parent.n + node.n, parent.leaves + node.leaves, parent.saved + node.saved

    def end(self) -> None:
        while self.stack:
            self.close()

    def add(self, shard: int, key: str, c: int, sizes: list[int], ends: bool, below: tuple[int, int, int] | None) -> None:
        if shard != self.shard:
            self.end()
            self.shard, self.key = shard, ""
        if not self.stack:
            self.stack.append(_Node(0, "", 0))
        before, at, same = self.key, 0, min(len(self.key), len(key))
        while at < same and before[at:at + NAME] == key[at:at + NAME]:
            at += NAME
        while len(self.stack) > at // NAME + 1:
            self.close()
        for k in range(at, len(key), NAME):
            name, parent = key[k:k + NAME], self.stack[-1].sid
            self.stack.append(_Node(self.trie.get((parent, name), -1) if parent >= 0 else -1, name, sizes[k // NAME - 1] if k else 0))
        self.key = key
        node = self.stack[-1]
        node.n += 1
        node.least = c if node.least is None else min(node.least, c)
        if below is not None:
            node.below = below
        if ends:
            if node.sid >= 0:  # the ids themselves, as other shards have some too
                if node.ends is None:
                    node.ends = []
                node.ends.append(str(c))
                if len(node.ends) * 12 > _CHUNK:
                    self.flush_ends(node)
            else:
                if node.ends is None:
                    node.ends = hashlib.sha256()
                node.ends.update(b",%d" % c if node.n_ends else b"%d" % c)
                node.n_ends += 1


def _ends_digests(chunks: DataFrame) -> DataFrame:
    """sid, ends_sha256 of skeleton nodes: their chunks of ids in order (shards and chunks are in order of the ids)."""
    rows = chunks.select("sid", "shard", "place", "ends").repartition("sid").sortWithinPartitions("sid", "shard", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sid, hasher = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([sid], pa.int64()), pa.array([hasher.hexdigest()])], ["sid", "ends_sha256"])

        for batch in batches:
            for s, text in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if s == sid:
                    hasher.update(b",")
                else:
                    if hasher:
                        yield row()
                    sid, hasher = s, hashlib.sha256()
                hasher.update(text.encode())
        if hasher:
            yield row()

    return rows.mapInArrow(run, "sid long, ends_sha256 string")


def _layer(rows: DataFrame, below: DataFrame | None, shard_rows: int) -> DataFrame:
    """All nodes of the tries of one segment (saved): index (1: an anchor), name (of anchors), conv_id, parent_conv_id,
    n_convs, n_children, n_leaves, saved, ends."""
    spark = rows.sparkSession
    null = F.lit(None).cast("long")
    rows = rows.select("c", F.concat("anchor", "path").alias("key"), "bytes", "ends", "next_anchor")
    if below is None:
        rows = rows.select("c", "key", "bytes", "ends", null.alias("b_children"), null.alias("b_leaves"), null.alias("b_saved"))
    else:
        rows = rows.join(below, "next_anchor", "left").select("c", "key", "bytes", "ends", "b_children", "b_leaves", "b_saved")
        rows = save(rows, "trie-rows")
    n = rows.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // shard_rows))
    parts = 1 << 20
    chosen = rows.filter(F.pmod(F.xxhash64("c"), F.lit(parts)) < -(-parts * SAMPLED * shards // max(n, 1))).select("key", "c")
    sample = numbered(chosen.withColumn("g", F.lit(0)), "g", ["key", "c"], "trie-sample")
    m = sample.count()
    step = max(1, m // shards)
    splitters = [(r["key"], r["c"]) for r in sample.filter((F.col("pos") % step == 0) & (F.col("pos") > 0)).select("key", "c").collect()]  # one for each shard
    splitters.sort()
    children, nodes = skeleton_of(splitters)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = [bisect_right(splitters, k) for k in zip(batch.column("key").to_pylist(), batch.column("c").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", shard int"
    dealt = rows.mapInArrow(deal, schema).repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("shard", "key", "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = _Walk(children)

        def rows_of() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*walk.out, strict=True), _OUT_TYPES, strict=True)], schema=_OUT_TYPES)
            walk.out = []
            return b

        for batch in batches:
            for c, key, sizes, ends, x, y, z, shard in zip(*(v.to_pylist() for v in batch.columns), strict=True):
                walk.add(shard, key, c, sizes, ends, None if x is None else (x, y, z))
            if walk.out:
                yield rows_of()
        walk.end()
        if walk.out:
            yield rows_of()

    out = save(dealt.mapInArrow(run, _OUT), "trie-walked")

    # the skeleton: partial aggregates are reduced by the node
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    parts_of = out.filter(F.col("kind") == PART).groupBy("sid").agg(F.min("conv_id").alias("conv_id"), *sums, *[F.max(c).alias(c) for c in ("bytes", "b_children", "b_leaves", "b_saved")])
    up = {s: p for s, p, _, _ in nodes}
    inner: dict[int, int] = {}
    for _, p, _, _ in nodes:
        if p is not None:
            inner[p] = inner.get(p, 0) + 1

    def line(s: int | None) -> list[int]:
        found = []
        while s is not None:
            found.append(s)
            s = up[s]
        return found

    trie = spark.createDataFrame([(s, p, i, name if i == 1 else None, inner.get(s, 0), line(s)) for s, p, i, name in nodes], "sid long, parent_sid long, index int, name string, inner long, line array<long>")
    trie = save(trie, "trie-skeleton")
    skel = save(trie.join(parts_of, "sid").withColumn("n_children", F.col("n_children") + F.col("inner") + F.coalesce("b_children", F.lit(0))), "trie-parts")
    once = skel.select(F.explode("line").alias("sid"), F.coalesce("b_leaves", (F.col("n_children") == 0).cast("long")).alias("l"), (F.coalesce("b_saved", F.lit(0)) - F.col("bytes")).alias("s"))
    once = once.groupBy("sid").agg(F.sum("l").alias("more_leaves"), F.sum("s").alias("more_saved"))
    ends = _ends_digests(out.filter(F.col("kind") == ENDS))
    skel = skel.join(once, "sid").join(ends, "sid", "left")
    skel = skel.select("sid", "parent_sid", "index", "name", "conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("more_leaves")).alias("n_leaves"), (F.col("saved") + F.col("more_saved")).alias("saved"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends"))
    skel = save(skel, "trie-reduced")
    parents = checked_broadcast(skel.select(F.col("sid").alias("parent_sid"), F.col("conv_id").alias("_parent")))  # the skeleton only
    cols = ["index", "name", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    local = out.filter(F.col("kind") == NODE).join(parents, "parent_sid", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
    return local.select(*cols).unionByName(skel.join(parents, "parent_sid", "left").withColumnRenamed("_parent", "parent_conv_id").select(*cols)).filter("index > 0")


def prefix_trie(turns: DataFrame, segment: int = SEGMENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A row for each node of the trie of ``turns`` (as ``rebuilt`` gives them): conv_id (smallest member), depth,
    parent_conv_id (its parent's; null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations without turns are members of the root alone; without conversations there is no node.
    """
    rows = segments(turns, segment)
    last = rows.agg(F.max("seg")).first()[0]
    below, found = None, None
    for s in range(last or 0, -1, -1):
        nodes = _layer(rows.filter(F.col("seg") == s), below, shard_rows)
        if s:
            nodes = save(nodes, "trie-nodes")
            below = nodes.filter("index = 1").select(F.col("name").alias("next_anchor"), F.col("n_children").alias("b_children"), F.col("n_leaves").alias("b_leaves"), F.col("saved").alias("b_saved"))
            nodes = nodes.filter("index > 1")
        depth = (F.col("index") - 1 + s * segment).cast("long").alias("depth")
        first = F.when(F.col("index") > 1, F.col("parent_conv_id")).alias("parent_conv_id")
        nodes = nodes.select("conv_id", depth, first, "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
        found = nodes if found is None else found.unionByName(nodes)
    return found


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    Turns are ordered by ``turn`` (null first), equal ones by a digest of role and text; null role or text counts as
    empty; rows with a null conv_id belong to no conversation and are left out.  Repeated rows are turns of their own.
    Other columns are not read.
    """
    return prefix_trie(rebuilt(conversations), segment, shard_rows)

