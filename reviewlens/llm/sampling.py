"""Operator 13: document fingerprints by consistent weighted sampling.

A text's terms are its words (A-Z in lower case), weighted by their counts.  For
sample k a term x of weight w has the fixed draws r, c (gamma of shape 2) and b
(uniform), made from the hashes of x and k:

    t = floor(ln w / r + b)        a = ln c - r * (t - b + 1)

and the sample is the pair (x, t) of the least a.  Two texts have the same sample
with a chance of (sum of the lesser weights) / (sum of the greater weights), the
generalised Jaccard similarity.  A fingerprint holds ``BITS`` bits of the hash of
each of ``SAMPLES`` pairs; the share of equal places estimates the similarity
(other pairs are alike in 2 ** -BITS of the cases).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.common import save
from reviewlens.llm.words import Group, give_back, lean, mix

SAMPLES = 64
BITS = 16
#: texts are fingerprinted together in groups of about so many bytes
GROUP_BYTES = 1 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _GOLDEN)
_LOW = np.uint64(0xFFFFFFFF)


def _log_uniform(x: np.ndarray) -> np.ndarray:
    """-ln of uniform numbers in (0, 1) from 32 bits each."""
    return -np.log((x.astype(np.float64) + 0.5) * 2.0 ** -32)


def draws(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of every term (rows) and sample (columns), float32."""
    x = mix(terms[:, None] ^ _SEEDS[None, :])
    r = _log_uniform(x & _LOW) + _log_uniform(x >> np.uint64(32))
    x = mix(x + _GOLDEN)
    c = _log_uniform(x & _LOW) + _log_uniform(x >> np.uint64(32))
    x = mix(x + _GOLDEN)
    b = (x >> np.uint64(32)).astype(np.float64) * 2.0 ** -32
    return r.astype(np.float32), np.log(c).astype(np.float32), b.astype(np.float32)


class Sampler:
    """Fingerprints of groups of texts; the draws of a group's terms are kept for the next one."""

    def __init__(self) -> None:
        self.terms = np.zeros(0, np.uint64)
        self.tables = [np.zeros((0, SAMPLES), np.float32) for _ in range(3)]

    def learn(self, terms: np.ndarray) -> None:
        """Draws of the distinct, sorted terms."""
        if len(self.terms):
            at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
            known = self.terms[at] == terms
        else:
            at, known = np.zeros(len(terms), np.int64), np.zeros(len(terms), bool)
        tables = [np.empty((len(terms), SAMPLES), np.float32) for _ in range(3)]
        fresh = np.flatnonzero(~known)
        for lo in range(0, len(fresh), 4096):
            part = fresh[lo:lo + 4096]
            for to, made in zip(tables, draws(terms[part]), strict=True):
                to[part] = made
        for to, old in zip(tables, self.tables, strict=True):
            to[known] = old[at[known]]
        self.terms, self.tables = terms, tables

    def fingerprints(self, texts: list[bytes]) -> list[bytes]:
        """BITS * SAMPLES bits of every text; b'' for a text without words."""
        _, _, h, at = Group(0, texts).words(lower=True)
        if not len(h):
            return [b""] * len(texts)
        terms, where = np.unique(h, return_inverse=True)
        self.learn(terms)
        r, c, b = self.tables
        first = c - r * (1 - b)  # of terms that occur once: t is 0
        out = []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if lo == hi:
                out.append(b"")
                continue
            mine, n = np.unique(where[lo:hi], return_counts=True)  # in order of the terms' hashes: ties go to the least
            a = first[mine]
            t = np.zeros(a.shape, np.int64) if n.max() > 1 else None
            if t is not None:
                often = np.flatnonzero(n > 1)
                rows = mine[often]
                step = np.floor(np.log(n[often])[:, None].astype(np.float32) / r[rows] + b[rows])
                a[often] = c[rows] - r[rows] * (step - b[rows] + 1)
                t[often] = step
            best = a.argmin(axis=0)
            pair = terms[mine[best]]
            if t is not None:
                pair = mix(pair + t[best, np.arange(SAMPLES)].astype(np.uint64) * _GOLDEN)
            else:
                pair = mix(pair)
            out.append((pair >> np.uint64(64 - BITS)).astype(">u2").tobytes())
        return out


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal samples; texts without words are like each other and nothing else."""
    if not a or not b:
        return float(a == b)
    return float((np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2")).mean())


def edited(text: str, after: str) -> str:
    """text with its last half (rounded down) replaced by as many first code points of ``after`` (or all)."""
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


_ROW = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_EDGE = "part long, edge int, text string"
_TYPES = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int64()), ("edge", pa.int32()), ("text", pa.string())])
FIRST, LAST = 1, 2


def _row(doc_id: int | None, text: str, after: str, own: bytes, changed: bytes, following: bytes) -> tuple:
    return doc_id, len(text), hashlib.sha256(edited(text, after).encode()).digest(), own, changed, likeness(own, changed), likeness(own, following)


def _in_parts(ids: list, texts: list[str]) -> Iterator[tuple[list, list[str]]]:
    """ids and texts in parts of about GROUP_BYTES."""
    lo, held = 0, 0
    for k, x in enumerate(texts):
        if held and held + len(x) > GROUP_BYTES:
            yield ids[lo:k], texts[lo:k]
            lo, held = k, 0
        held += len(x)
    yield ids[lo:], texts[lo:]


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next of every row.

    The next document is that of the next greater id, after the last one the first; rows with the same id are ordered
    by the hash of their text, then the text; null ids come first.  A null text counts as empty.  Texts without words
    have the empty fingerprint: likeness 1 with each other, 0 with any other text.  Other columns are not read.

    Texts are range-partitioned by id and read in order, so a task holds a group of texts and the text before it; only
    the first and last text of each partition are joined with their neighbours afterwards.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    by = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(n, *by).sortWithinPartitions(*by, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sampler, held = TaskContext.get().partitionId(), Sampler(), None  # held: the row that waits for its next one
        blank = (None, None, None, None, None, None, None)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                piece = batch.slice(lo, 1000)
                for ids, texts in _in_parts(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    out = []
                    if held is None:
                        out.append((*blank, part, FIRST, texts[0]))
                    before = [held[1], *texts] if held else texts
                    changed = [edited(a, b) for a, b in zip(before, before[1:])]
                    prints = sampler.fingerprints([x.encode() for x in (*texts, *changed)])
                    own, changed_prints = prints[:len(texts)], prints[len(texts):]
                    all_ids, all_own = ([held[0], *ids], [held[2], *own]) if held else (ids, own)
                    out += [(*_row(all_ids[k], before[k], before[k + 1], all_own[k], changed_prints[k], all_own[k + 1]), None, 0, None) for k in range(len(changed))]
                    held = (ids[-1], texts[-1], own[-1])
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _TYPES, strict=True)], schema=_TYPES)
        if held is not None:
            last = (held[0], *blank[1:], part, LAST, held[1])
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(last, _TYPES, strict=True)], schema=_TYPES)

    made = save(rows.mapInArrow(lean(run), f"{_ROW}, {_EDGE}"), "fingerprints")
    inner = made.filter("edge = 0").drop("part", "edge", "text")
    # the last row of each partition and the first of the next one that has rows: two rows a partition
    edges = made.filter("edge > 0")
    parts = edges.filter(F.col("edge") == LAST).select("part")
    following = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy(F.lit(0))))
    parts = parts.select("part", following.alias("after"))
    firsts = edges.filter(F.col("edge") == FIRST).select(F.col("part").alias("after"), F.col("text").alias("next_text"))
    pairs = edges.filter(F.col("edge") == LAST).select("part", "doc_id", "text").join(parts, "part").join(firsts, "after").select("doc_id", "text", "next_text")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            for r in batch.to_pylist():
                a, b = r["text"], r["next_text"]
                own, changed, following = sampler.fingerprints([x.encode() for x in (a, edited(a, b), b)])
                row = _row(r["doc_id"], a, b, own, changed, following)
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _TYPES)], schema=pa.schema(list(_TYPES)[:7]))
        give_back()

    out = inner.unionByName(pairs.mapInArrow(close, _ROW))
    hexed = [F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    return out.select("doc_id", "n_chars", *hexed, "near_edited", "near_next")
