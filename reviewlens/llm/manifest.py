"""Operator 12: a Merkle manifest of a dataset by time-forward processing.

Each row is a leaf; the leaves of a group, in order of their ids, form a tree in
which every ``FAN`` neighbours have a parent, and the groups' roots, in order of
the groups, form another.  A node's label is (the place after its last leaf, its
level): every child's label is smaller than its parent's.

Upwards, nodes are worked on in ascending order of labels.  A node that is done
sends its digest to its parent's label through a priority queue, so a node finds
all its children's digests when its turn comes.  Downwards, in descending order,
each node sends every child what the child's proof ends with: the siblings of the
child, then what the node got itself.

The queue is external: what comes from other tasks (leaves, and the nodes in
which subtrees of ``FAN ** LEVELS`` leaves end) is sorted by label by Spark's
shuffle, which spills; a task merges that sorted stream with a heap of the
messages between its own nodes, of which it holds ``FAN`` a level at most.
Subtrees beyond a task's go on in another round, with 1 / ``FAN ** LEVELS`` of
the rows.  No task sees a whole group or level.
"""

from __future__ import annotations

import hashlib
import heapq
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import checked_broadcast, save
from reviewlens.llm.numbering import numbered

FAN = 8
FAN_BITS = 3
#: levels of a subtree that one task works on
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values: list[Column]) -> Column:
    """The digest of some values: each its UTF-8 byte count, ``:`` and itself, or ``-`` where it is null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def height(n: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _end(level: int, number: int, n: int) -> int:
    return min((number + 1) << FAN_BITS * level, n)


_UP = "g string, n long, shard long, level int, number long, until long, children string, digest string"
_UP_TYPES = pa.schema([("g", pa.string()), ("n", pa.int64()), ("shard", pa.int64()), ("level", pa.int32()), ("number", pa.int64()), ("until", pa.int64()), ("children", pa.string()), ("digest", pa.string())])


def _upwards(leaves: DataFrame, levels: int) -> DataFrame:
    """A row for each inner node with its children's digests (saved); subtrees' roots have their digest too."""
    rows = leaves.select("g", "n", F.shiftright("pos", FAN_BITS * levels).alias("shard"), "pos", "digest")
    rows = rows.repartition("g", "shard").sortWithinPartitions("g", "shard", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        queue: list[tuple] = []  # (until, level of the node that gets it, place among its children, digest)

        def settle(now: int | None) -> None:
            """All nodes whose last leaf lies before ``now`` (None: all of them)."""
            g, shard, n, top = key
            while queue and (now is None or queue[0][0] <= now):
                until, level = queue[0][:2]
                children = []
                while queue and queue[0][:2] == (until, level):
                    children.append(heapq.heappop(queue)[3])
                joined = "".join(children)
                made = digest(joined)
                number = (until - 1) >> FAN_BITS * level
                out.append((g, n, shard, level, number, until, joined, made if level == top else None))
                if level < top:
                    send(level, number, made)

        def send(level: int, number: int, value: str) -> None:
            heapq.heappush(queue, (_end(level + 1, number >> FAN_BITS, key[2]), level + 1, number & FAN - 1, value))

        def rows_of() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _UP_TYPES, strict=True)], schema=_UP_TYPES)
            out.clear()
            return b

        key: tuple = ()
        for batch in batches:
            for g, n, shard, pos, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not key or key[:2] != (g, shard):
                    if key:
                        settle(None)
                    key = (g, shard, n, min(levels, height(n)))
                settle(pos)
                if key[3]:
                    send(0, pos, value)
                else:  # a lone leaf
                    out.append((g, n, shard, 0, pos, pos + 1, None, value))
            if out:
                yield rows_of()
        if key:
            settle(None)
        if out:
            yield rows_of()

    return save(rows.mapInArrow(run, _UP), "manifest-nodes")


_DOWN = "g string, n long, pos long, n_below long, id long, digest string, tampered string, lefts array<string>, rights array<string>, subroot string, root string"
_DOWN_TYPES = pa.schema([("g", pa.string()), ("n", pa.int64()), ("pos", pa.int64()), ("n_below", pa.int64()), ("id", pa.int64()), ("digest", pa.string()), ("tampered", pa.string()),
                         ("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())])


def _downwards(leaves: DataFrame, nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """The leaves with the siblings on their way to the root: ``lefts`` and ``rights`` of each level, joined, from the leaf on.

    paths: g, shard, n, and the same for the shards' roots, with subroot and root.
    """
    none = F.lit(None)
    inner = nodes.filter("level > 0").select("g", "shard", "until", "level", "n", "number", "children", none.cast("struct<n_below:long,id:long,digest:string,tampered:string>").alias("leaf"), none.cast("struct<lefts:array<string>,rights:array<string>,subroot:string,root:string>").alias("path"))
    leaf_rows = leaves.select("g", F.shiftright("pos", FAN_BITS * levels).alias("shard"), (F.col("pos") + 1).alias("until"), F.lit(0).alias("level"), "n", F.col("pos").alias("number"), none.cast("string").alias("children"), F.struct("n_below", "id", "digest", "tampered").alias("leaf"), none.cast(inner.schema["path"].dataType).alias("path"))
    path_rows = paths.select("g", "shard", none.cast("long").alias("until"), none.cast("int").alias("level"), "n", none.cast("long").alias("number"), none.cast("string").alias("children"), none.cast(inner.schema["leaf"].dataType).alias("leaf"), F.struct("lefts", "rights", "subroot", "root").alias("path"))
    rows = inner.unionByName(leaf_rows).unionByName(path_rows).repartition("g", "shard")
    rows = rows.sortWithinPartitions(F.col("g"), F.col("shard"), F.col("until").desc_nulls_first(), F.col("level").desc())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue: list[tuple] = []  # (-until, -level, (left siblings, right siblings, the same of the parent))
        roots: tuple = ()
        for batch in batches:
            out: list[tuple] = []
            for g, shard, until, level, n, number, children, leaf, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if path is not None:
                    chain = None
                    for left, right in zip(reversed(path["lefts"]), reversed(path["rights"]), strict=True):
                        chain = (left, right, chain)
                    top = min(levels, height(n))
                    queue.append((-_end(top, shard << FAN_BITS * (levels - top), n), -top, chain))  # the queue is empty between shards
                    roots = (path["subroot"], path["root"])
                    continue
                at = heapq.heappop(queue)
                if at[:2] != (-until, -level):
                    raise ValueError(f"no message for node {(g, shard, until, level)}")
                if leaf is None:
                    digests = [children[k:k + 64] for k in range(0, len(children), 64)]
                    for k in range(len(digests)):
                        child = (number << FAN_BITS) + k
                        heapq.heappush(queue, (-_end(level - 1, child, n), 1 - level, ("".join(digests[:k]), "".join(digests[k + 1:]), at[2])))
                else:
                    lefts, rights, chain = [], [], at[2]
                    while chain:
                        lefts.append(chain[0])
                        rights.append(chain[1])
                        chain = chain[2]
                    out.append((g, n, number, leaf["n_below"], leaf["id"], leaf["digest"], leaf["tampered"], lefts, rights, *roots))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _DOWN_TYPES, strict=True)], schema=_DOWN_TYPES)

    return rows.mapInArrow(run, _DOWN)


def _climb(leaves: DataFrame, levels: int) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """Rounds (leaves, nodes), and the groups' roots: g, n, round, digest.  leaves: g, n, pos, n_below, id, digest, tampered."""
    rounds, tops = [], None
    most = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        nodes = _upwards(leaves, levels)
        rounds.append((leaves, nodes))
        roots = nodes.filter("digest is not null")
        whole = F.col("n") <= FAN ** levels
        done = roots.filter(whole).select("g", "n", F.lit(len(rounds) - 1).alias("round"), "digest")
        tops = done if tops is None else tops.unionByName(done)
        if most <= FAN ** levels:
            return rounds, tops
        most = -(-most // FAN ** levels)
        leaves = roots.filter(~whole).select("g", F.ceil(F.col("n") / FAN ** levels).cast("long").alias("n"), F.col("shard").alias("pos"), F.col("n").alias("n_below"), F.lit(None).cast("long").alias("id"), "digest", F.lit(None).cast("string").alias("tampered"))


def _descend(rounds: list[tuple[DataFrame, DataFrame]], paths: DataFrame, levels: int) -> DataFrame:
    """paths: g, n, round, lefts, rights, subroot, root of the groups' roots."""
    found = None
    for k in reversed(range(len(rounds))):
        here = paths.filter(F.col("round") == k).select("g", F.lit(0).cast("long").alias("shard"), "n", "lefts", "rights", "subroot", "root")
        if found is not None:
            here = here.unionByName(found.select("g", F.col("pos").alias("shard"), F.col("n_below").alias("n"), "lefts", "rights", "subroot", "root"))
        found = _downwards(*rounds[k], here, levels)
        if k:
            found = save(found, "manifest-paths")
    return found


def _folded(found: DataFrame) -> DataFrame:
    """found with proof_sha256 and folded_root."""
    schema = "id long, g string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            proofs, folded = [], []
            for leaf, tampered, lefts, rights in zip(*(batch.column(c).to_pylist() for c in ("digest", "tampered", "lefts", "rights")), strict=True):
                proofs.append(digest(*[x for pair in zip(lefts, rights, strict=True) for x in pair]))
                value = tampered or leaf
                for left, right in zip(lefts, rights, strict=True):
                    value = digest(left, value, right)
                folded.append(value)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "g", "digest", "subroot", "root")), pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
                                             ["id", "g", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return found.select("id", "g", "digest", "tampered", "lefts", "rights", "subroot", "root").mapInArrow(run, schema)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", tampered: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """id, g (the group), leaf, subroot, root, proof_sha256 and folded_root of every row of docs.

    ``tampered``: fields with what an altered copy holds in their place; where that changes the leaf, the altered one is
    folded with the original siblings, so folded_root differs from root.

    Null ids and null groups come first; rows with the same id and group are ordered by their leaves, so repeated rows
    are leaves of their own.  A text of any length is one leaf; other columns than ``fields`` are not read.  An empty
    table has an empty result.
    """
    leaf = leaf_of([F.col(c) for c in fields])
    other = leaf_of([(tampered or {}).get(c, F.col(c)) for c in fields]) if tampered else F.lit(None).cast("string")
    rows = docs.select(F.col(group_col).cast("string").alias("g"), F.col(id_col).cast("long").alias("id"), leaf.alias("digest"), other.alias("tampered"))
    rows = save(rows, "manifest-leaves")
    rows = numbered(rows, "g", ["id", "digest"], "manifest-numbered")
    sizes = save(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "manifest-sizes")
    size = checked_broadcast(sizes.withColumnRenamed("g", "_g"))
    leaves = rows.join(size, F.col("g").eqNullSafe(F.col("_g"))).select("g", "n", "pos", F.lit(0).cast("long").alias("n_below"), "id", "digest", "tampered")
    rounds, tops = _climb(leaves, levels)
    tops = save(tops, "manifest-subroots")

    # the groups' roots as leaves of one tree
    no_group = F.lit("").alias("g")
    n_groups = sizes.count()
    groups = numbered(tops.select(no_group, F.col("g").alias("name"), "digest"), "g", ["name"], "manifest-groups")
    groups = groups.select("g", F.lit(n_groups).cast("long").alias("n"), "pos", F.lit(0).cast("long").alias("n_below"), F.lit(None).cast("long").alias("id"), "digest", F.col("name").alias("tampered"))
    over, top = _climb(groups, levels)
    empty = F.array().cast("array<string>")
    paths = top.select("g", "n", "round", empty.alias("lefts"), empty.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    above = save(_descend(over, paths, levels), "manifest-above").select(F.col("tampered").alias("_g"), "lefts", "rights", F.col("digest").alias("subroot"), "root")
    paths = tops.join(above, F.col("g").eqNullSafe(F.col("_g"))).select("g", "n", "round", "lefts", "rights", "subroot", "root")
    return _folded(_descend(rounds, paths, levels))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
