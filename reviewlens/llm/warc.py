"""Operator 4: WARC archives and their Merkle fixity audit.

Pages are written as resource records, each a gzip member of its own, into
files of a range of page ids.  The index has a row for each record: its number
in the archive, its file, its stored bytes (offset, length) and their hash.

For an audit every replica's stored bytes of each indexed range are hashed
(missing or short ranges too), and record hashes are combined into a tree:
a node is the hash of the hashes of up to ``FANOUT`` neighbouring nodes, in
order of the records' offsets.  Two replicas are compared from the root on;
only children of nodes that differ are read further, down to the records.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import save, shared_folder
from reviewlens.llm.files import new_path, open_input, open_output

FANOUT_BITS = 4
FANOUT = 1 << FANOUT_BITS
FILE_BYTES = 1 << 26
#: the date of all records: an archive of the same pages has the same bytes
DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, body: bytes) -> bytes:
    """A WARC 1.1 resource record (null id or url: empty)."""
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>\r\nWARC-Date: {DATE}\r\n"
            f"WARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    c = zlib.compressobj(1, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of a record (uncompressed)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    return headers, rest[: int(headers["Content-Length"])]


_INDEX = "part long, seq long, path string, place long, page_id long, at long, stored long, size long, record_sha256 string, stored_sha256 string"
_KINDS = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _INDEX.split(", ")])


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", partitions: int | None = None) -> DataFrame:
    """Write an archive in ascending id order; returns its saved index: page_id, number (in the archive), offset and
    size (of the record in the uncompressed archive), path, at and stored (its stored bytes), record_sha256, stored_sha256.

    Null html counts as empty, null ids come first, rows with the same id are ordered by url and html.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.repartitionByRange(n, "page_id").sortWithinPartitions("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, file, path, at, place = TaskContext.get().partitionId(), 0, None, "", 0, 0
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()))), strict=True):
                if file is None:
                    path, at, place = new_path(folder, ".warc.gz"), 0, 0
                    file = open_output(path)
                data = record(page_id, url, html or b"")
                stored = gzip_member(data)
                file.write(stored)
                out.append((part, seq, path, place, page_id, at, len(stored), len(data), hashlib.sha256(data).hexdigest(), hashlib.sha256(stored).hexdigest()))
                at, place = at + len(stored), place + 1
                if at >= FILE_BYTES:
                    file.close()
                    file, seq = None, seq + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _KINDS, strict=True)], schema=_KINDS)
        if file is not None:
            file.close()

    index = save(rows.mapInArrow(run, _INDEX), "warc-index")
    files = index.groupBy("part", "seq").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    in_order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files = files.select("part", "seq", *[F.coalesce(F.sum(c).over(in_order), F.lit(0)).alias(a) for c, a in (("n", "first"), ("bytes", "start"))])
    in_file = Window.partitionBy("part", "seq").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    index = index.join(files, ["part", "seq"]).withColumn("offset", F.col("start") + F.coalesce(F.sum("size").over(in_file), F.lit(0)))
    return save(index.select("page_id", (F.col("first") + F.col("place")).alias("number"), "offset", "size", "path", "at", "stored", "record_sha256", "stored_sha256"), "warc-numbered")


def copy_files(index: DataFrame, folder: str | None = None, damage: str | None = None) -> DataFrame:
    """Copy an archive's files; returns path, copy (saved).  ``damage``: SQL condition on the index; the middle byte of
    such records is changed in the copy (for tests of the audit)."""
    spark = index.sparkSession
    folder = folder or shared_folder(spark, "warc-copy")
    bad = F.expr(damage) if damage else F.lit(False)
    spots = index.groupBy("path").agg(F.collect_list(F.when(bad, F.col("at") + (F.col("stored") / 2).cast("long"))).alias("spots"))  # within one bounded file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                to, place, spots = new_path(folder, ".warc.gz"), 0, sorted(r["spots"])
                with open_input(r["path"]) as src, open_output(to) as dst:
                    while block := bytearray(src.read(1 << 20)):
                        while spots and spots[0] < place + len(block):
                            block[spots.pop(0) - place] ^= 0x55
                        dst.write(bytes(block))
                        place += len(block)
                out.append(to)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["path", "copy"])

    return save(spots.mapInArrow(run, "path string, copy string"), "warc-copies")


def read_warc(index: DataFrame) -> DataFrame:
    """page_id, url, html of every record of the index, from the stored files (null url and '' are one)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data in _stored(batches, ("page_id",)):
            headers, body = parse_record(zlib.decompress(data, 31))
            yield pa.RecordBatch.from_arrays([pa.array([rows[0]], pa.int64()), pa.array([headers["WARC-Target-URI"]]), pa.array([body.decode()])], ["page_id", "url", "html"])

    return index.select("path", "at", "stored", "page_id").mapInArrow(run, "page_id long, url string, html string")


def _stored(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, bytes]]:
    """(the columns, stored bytes) of index rows; a missing file or range gives what is there."""
    path, file = None, None
    for batch in batches:
        for p, at, n, *rest in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "stored", *columns)), strict=True):
            if p != path:
                path = p
                try:
                    file = open_input(p)
                except OSError:
                    file = None
            data = b""
            if file is not None and at < file.size():
                file.seek(at)
                data = file.read(n)
            yield tuple(rest), data


def hash_ranges(index: DataFrame, replica: str, copies: DataFrame | None = None) -> DataFrame:
    """replica, number, hash of the stored bytes of every indexed record (in the copies, where given)."""
    rows = index.select("path", "at", "stored", "number")
    if copies is not None:
        rows = rows.join(copies, "path").select(F.col("copy").alias("path"), "at", "stored", "number")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def rows_of() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array([replica] * len(out)), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["replica", "number", "hash"])
            out.clear()
            return b

        for (number,), data in _stored(batches, ("number",)):
            out.append((number, hashlib.sha256(data).hexdigest()))
            if len(out) >= 10_000:
                yield rows_of()
        if out:
            yield rows_of()

    return rows.sortWithinPartitions("path", "at").mapInArrow(run, "replica string, number long, hash string")


def merkle_tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels (replica, number, hash; saved) from the leaves to a single root node for each replica."""
    levels = [save(leaves, "merkle-0")]
    most = levels[0].agg(F.max("number")).first()[0]
    while most:
        up = levels[-1].groupBy("replica", F.shiftright("number", FANOUT_BITS).alias("number")).agg(F.sort_array(F.collect_list(F.struct("number", "hash"))).alias("c"))  # FANOUT at most
        up = up.select("replica", "number", F.sha2(F.array_join(F.col("c.hash"), ""), 256).alias("hash"))
        levels.append(save(up, f"merkle-{len(levels)}"))
        most >>= FANOUT_BITS
    return levels


def mismatches(levels: list[DataFrame], a: str, b: str) -> DataFrame:
    """number of every record in which the two replicas differ (or that one lacks)."""
    found = None
    for level in reversed(levels):
        x, y = (level.filter(F.col("replica") == r).select("number", F.col("hash").alias("h" + c)) for r, c in ((a, "a"), (b, "b")))
        if found is not None:  # only below nodes that differ
            parents = found.select(F.col("number").alias("parent"))
            x, y = (z.join(parents, F.shiftright("number", FANOUT_BITS) == F.col("parent"), "left_semi") for z in (x, y))
        found = x.join(y, "number", "full").filter(~F.col("ha").eqNullSafe(F.col("hb"))).select("number")
    return found


def audit(index: DataFrame, copies: DataFrame) -> DataFrame:
    """page_id, number, offset, size, record_sha256, damaged for every record: where the copies differ from the archive."""
    leaves = hash_ranges(index, "archive").unionByName(hash_ranges(index, "copy", copies))
    bad = mismatches(merkle_tree(leaves), "archive", "copy").withColumn("damaged", F.lit(True))
    return index.join(bad, "number", "left").select("page_id", "number", "offset", "size", "record_sha256", F.coalesce("damaged", F.lit(False)).alias("damaged"))
