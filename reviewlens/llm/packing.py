"""Operator 3: token ids in bit-packed binary files.

Each id takes the fewest bits that hold the vocabulary.  A file is

    blocks   ``BLOCK_TOKENS`` ids each (the last one may be shorter), packed
             from the lowest bit on, each block padded to a whole byte
    index    int64 little-endian: document ids, documents' first tokens (one
             more than documents), blocks' first bytes (one more than blocks)
    footer   6 x int64: documents, tokens, bits, ids a block, first byte of the
             index, flag for null document ids (1: the first document's id is null)
             and 8 bytes of magic

so any run of tokens is read by its blocks alone and unpacked by numpy.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.chunks import GROUP_BYTES, ChunkCache, by_text
from reviewlens.llm.common import save, shared_folder
from reviewlens.llm.files import new_path, open_input, open_output
from reviewlens.llm.words import as_bytes, groups

BLOCK_TOKENS = 1 << 16
#: a file is closed after so many tokens
FILE_TOKENS = 1 << 24
MAGIC = b"TOKBITS1"


def bits_for(size: int) -> int:
    """Bits that hold the ids 0 .. size - 1."""
    return max(1, (size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):  # whole machine words: the same bytes
        return ids.astype(f"<u{bits // 8}").tobytes()
    return np.packbits((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flags = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flags.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


class PackedWriter:
    def __init__(self, uri: str, bits: int):
        self.uri, self.bits, self.file = uri, bits, open_output(uri)
        self.ids: list = []
        self.starts, self.blocks = [0], [0]
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK_TOKENS:
            self._flush(False)

    def _flush(self, rest: bool) -> None:
        flat = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        at = 0
        while len(flat) - at >= BLOCK_TOKENS or rest and at < len(flat):
            data = pack(flat[at:at + BLOCK_TOKENS], self.bits)
            self.file.write(data)
            self.blocks.append(self.blocks[-1] + len(data))
            at += BLOCK_TOKENS
        self.held = [flat[at:]] if at < len(flat) else []
        self.n_held = max(0, len(flat) - at)

    def close(self) -> tuple[str, int, int]:
        self._flush(True)
        nulls = sum(i is None for i in self.ids)  # in ascending order null ids come first
        ids = [0 if i is None else i for i in self.ids]
        for x in (ids, self.starts, self.blocks, [len(ids), self.starts[-1], self.bits, BLOCK_TOKENS, self.blocks[-1], nulls]):
            self.file.write(np.array(x, "<i8").tobytes())
        self.file.write(MAGIC)
        self.file.close()
        return self.uri, len(ids), self.starts[-1]


class PackedReader:
    def __init__(self, uri: str):
        self.file = open_input(uri)
        size = self.file.size()
        self.file.seek(size - 56)
        tail = self.file.read(56)
        if tail[48:] != MAGIC:
            raise ValueError(f"{uri} is no packed token file")
        n, self.n_tokens, self.bits, self.block, index, nulls = np.frombuffer(tail[:48], "<i8").tolist()
        self.file.seek(index)
        numbers = np.frombuffer(self.file.read(size - 56 - index), "<i8")
        self.ids = [None] * nulls + numbers[nulls:n].tolist()
        self.starts, self.blocks = numbers[n:2 * n + 1], numbers[2 * n + 1:]

    def tokens(self, first: int, end: int) -> np.ndarray:
        """The ids of the tokens first .. end - 1 (uint32): reads the blocks that hold them."""
        if end <= first:
            return np.zeros(0, np.uint32)
        a, b = first // self.block, -(-end // self.block)
        self.file.seek(int(self.blocks[a]))
        data = self.file.read(int(self.blocks[b] - self.blocks[a]))
        out = [unpack(data[self.blocks[k] - self.blocks[a]:self.blocks[k + 1] - self.blocks[a]], min(self.block, self.n_tokens - k * self.block), self.bits) for k in range(a, b)]
        return np.concatenate(out)[first - a * self.block:end - a * self.block]

    def documents(self, at_once: int = 64) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, first token, ids) of every document, read by runs of blocks."""
        lo = 0
        while lo < len(self.ids):
            hi = max(lo + 1, int(np.searchsorted(self.starts, self.starts[lo] + at_once * self.block, "right")) - 1)
            hi = min(hi, len(self.ids))
            run = self.tokens(int(self.starts[lo]), int(self.starts[hi]))
            for i in range(lo, hi):
                yield self.ids[i], int(self.starts[i]), run[self.starts[i] - self.starts[lo]:self.starts[i + 1] - self.starts[lo]]
            lo = hi


#: chunks that are encoded together, joined by spaces, and chunks in each generation of a worker's cache
JOINED, CACHE_CHUNKS = 512, 240_000


def encode_joined(encode: Callable[[str], object], chunks: list[bytes]) -> list[bytes]:
    """The ids (uint32) of chunks without white space, from a few calls of the tokenizer on many of them, joined by spaces.

    The tokenizer never joins symbols over white space, so a chunk's ids are those whose offsets lie in it.  Offsets
    count characters of the text given, so a run in which they do not fit the chunks (or whose chunks hold what the
    tokenizer may take for white space itself) is encoded chunk by chunk.
    """
    out: list[bytes] = []
    for lo in range(0, len(chunks), JOINED):
        texts = [c.decode("utf-8", "replace") for c in chunks[lo:lo + JOINED]]
        run = encode(" ".join(texts))
        starts = np.fromiter((o[0] for o in run.offsets), np.int64, len(run.ids))
        ids = np.array(run.ids, np.uint32)
        first = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
        cut = np.searchsorted(starts, first)
        if len(ids) and (starts[1:] < starts[:-1]).any():
            out += [np.array(encode(t).ids, np.uint32).tobytes() for t in texts]
        else:
            out += [ids[x:y].tobytes() for x, y in zip(cut.tolist(), cut[1:].tolist())]
    return out


@lru_cache(maxsize=2)
def _cache(tokenizer: str) -> ChunkCache:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)

    def encode(text: str) -> object:
        return t.encode(text, add_special_tokens=False)

    return ChunkCache(lambda chunks: encode_joined(encode, chunks), CACHE_CHUNKS)


def vocabulary_size(tokenizer: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)


def write_packed(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Encode whole texts and write packed files in ascending id order; returns the saved list of files:
    part, seq (their order), path, n_docs, n_tokens, start (tokens in all files before).

    Null texts count as empty (the end id alone); null ids come first; rows
    with the same id are ordered by their text.  The texts are range-partitioned
    by id and sorted within partitions, so no task holds more than its range,
    and a writer holds one block.
    """
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "tokens")
    bits = bits_for(max(vocabulary_size(tokenizer), end_id + 1))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    end = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, writer, done = _cache(tokenizer), None, []
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for g in groups(as_bytes(batch.column(1)), GROUP_BYTES):
                for i, pieces in enumerate(by_text(g, cache), g.first):
                    writer = writer or PackedWriter(new_path(folder, ".tok"), bits)
                    writer.add(ids[i], np.frombuffer(b"".join(pieces) + end, np.uint32))
                    if writer.starts[-1] >= FILE_TOKENS:
                        done.append(writer.close())
                        writer = None
        if writer:
            done.append(writer.close())
        part = TaskContext.get().partitionId()
        if done:
            yield pa.RecordBatch.from_pylist([{"part": part, "seq": k, "path": p, "n_docs": d, "n_tokens": t} for k, (p, d, t) in enumerate(done)],
                                             pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    files = save(rows.mapInArrow(run, "part long, seq long, path string, n_docs long, n_tokens long"), "token-files")
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("start", before)  # one row for each file


def read_packed(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files of write_packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                rows: list = [[], [], [], []]
                for doc_id, first, ids in PackedReader(f["path"]).documents():
                    for to, v in zip(rows, (doc_id, f["start"] + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), strict=True):
                        to.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = files.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return files.repartition(int(n)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
