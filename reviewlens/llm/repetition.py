"""Operator 10: quality rules on repetition, from a suffix array of each text's words.

The suffix array of a group of texts is built by prefix doubling (numpy sorts
of the suffixes that are still tied).  The ranks of each doubling round give
the longest common prefix of neighbouring suffixes.  A suffix whose longest
common prefix with a neighbour is m starts a repeated substring of m words,
which nothing longer at that place repeats (the longest-common-prefix interval
around it); the spans [i, i + m) of all suffixes with m >= ``min_repeat`` are
joined.  A text fails if they cover more than ``max_covered`` of its words or
if one repeat is longer than ``max_repeat`` words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.words import IS_SPACE, Group, as_bytes, groups, slices

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
#: a repeat counts from so many words; at most this share of the words in repeats; the longest repeat allowed
MIN_REPEAT, MAX_COVERED, MAX_REPEAT = 10, 0.30, 100

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IN_WORD = ~IS_SPACE & ((np.arange(256) & 0xC0) != 0x80)  # the first byte of a code point that is no space

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "longest_repeat long, n_covered_words long, repeats array<struct<first_word:long,n_words:long>>")


def suffix_array(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of the word sequences h[at[i]:at[i + 1]], and the rank of every suffix by its first 1, 2, 4, ... words.

    Suffixes of different texts have different ranks.  The rounds end when no two suffixes are tied.
    """
    n = len(h)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    end = at[1:][text]
    word = np.unique(h, return_inverse=True)[1]
    order = np.argsort(text * (int(word.max()) + 1) + word, kind="stable") if n else np.zeros(0, np.int64)
    rank = np.zeros(n, np.int64)
    key = (text[order], word[order])
    new = np.ones(n, bool)
    new[1:] = (key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    ranks, k = [rank.astype(np.int32 if n < 2**31 else np.int64)], 1
    while True:
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n))
        open_ = np.repeat(size > 1, size)  # by place in the order
        if not open_.any():
            return order, ranks
        place = np.flatnonzero(open_)
        i = order[place]
        ahead = i + k
        nxt = np.where(ahead < end[i], rank[np.minimum(ahead, n - 1)] + 1, 0)
        was = rank[i]
        by = np.argsort(was * (n + 1) + nxt, kind="stable")
        i, was, nxt = i[by], was[by], nxt[by]
        order[place] = i
        differs = np.ones(len(i), bool)
        differs[1:] = (was[1:] != was[:-1]) | (nxt[1:] != nxt[:-1])
        new[place] = differs
        rank = rank.copy()
        rank[i] = np.maximum.accumulate(np.where(differs, place, 0))
        ranks.append(rank.astype(ranks[0].dtype))
        k *= 2


def longest_repeats(h: np.ndarray, at: np.ndarray, least: int) -> np.ndarray:
    """For each word, how many words from it on occur elsewhere in its text too (0 if fewer than ``least``)."""
    n = len(h)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    order, ranks = suffix_array(h, at)
    text_end = at[1:][np.repeat(np.arange(len(at) - 1), np.diff(at))]
    level = min(len(ranks) - 1, max(0, least.bit_length() - 1))
    if (1 << level) * 2 <= least and level == len(ranks) - 1 and len(ranks) < least.bit_length():
        return best  # all suffixes differ within fewer words than ``least``
    a, b = order[:-1], order[1:]
    tied = ranks[level][a] == ranks[level][b]
    a, b = a[tied], b[tied]
    length = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + length, b + length
        ok = (x < text_end[a]) & (y < text_end[b])
        ok[ok] = ranks[k][x[ok]] == ranks[k][y[ok]]
        length[ok] += 1 << k
    long_enough = length >= least
    a, b, length = a[long_enough], b[long_enough], length[long_enough]
    np.maximum.at(best, a, length)
    np.maximum.at(best, b, length)
    return best


def covered(first: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a span [first, first + length)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + length, -1)
    return np.cumsum(step[:-1]) > 0


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split(b"\n"):
        if line.strip():  # strips \x09-\x0D and space, as bytes
            n += line in seen
            seen.add(line)
    return n


def measure(g: Group, window: int, min_repeat: int) -> dict[str, list]:
    """The columns of SCHEMA but doc_id, for the texts of a group."""
    _, _, h, at = g.words(lower=False)
    n = np.diff(at)
    best = longest_repeats(h, at, min(window, min_repeat))
    starts = np.flatnonzero(best >= window)
    in_window = covered(starts, np.full(len(starts), window), len(h))
    starts = np.flatnonzero(best >= min_repeat)
    in_repeat = covered(starts, best[starts], len(h))
    flag = np.zeros(len(h) + 2, np.int8)
    flag[1:-1] = in_repeat
    edge = np.diff(flag)
    cut = np.zeros(len(h) + 1, bool)  # a span ends where its text ends
    cut[at] = True
    cut[~np.append(in_repeat, False)] = False
    cut[~np.append(False, in_repeat)] = False
    first = np.sort(np.append(np.flatnonzero(edge == 1), np.flatnonzero(cut)))
    last = np.sort(np.append(np.flatnonzero(edge == -1), np.flatnonzero(cut)))
    at_text = np.searchsorted(at, first, "right") - 1
    spans: list[list] = [[] for _ in n]
    for t, x, y in zip(at_text.tolist(), first.tolist(), last.tolist(), strict=True):
        spans[t].append({"first_word": x - int(at[t]), "n_words": y - x})
    sums = lambda mask: np.diff(np.append(0, np.cumsum(mask))[at])
    longest = [int(best[x:y].max()) if y > x else 0 for x, y in zip(at[:-1], at[1:], strict=True)] if len(starts) else [0] * len(n)
    longest = [x if x >= min_repeat else 0 for x in longest]
    return {"n_words": n.tolist(), "word_chars": g.counts(_IN_WORD[g.data]).tolist(), "n_symbols": g.counts(_IS_SYMBOL[g.data]).tolist(),
            "n_dup_lines": [duplicate_lines(x) for x in g.texts], "n_repeat_words": sums(in_window).tolist(),
            "longest_repeat": longest, "n_covered_words": sums(in_repeat).tolist(), "repeats": spans}


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, min_repeat: int = MIN_REPEAT,
                     max_covered: float = MAX_COVERED, max_repeat: int = MAX_REPEAT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each row of docs: SCHEMA's columns, base_failed, kept.

    Null texts count as empty and fail (too few words); repeated rows each get
    their row; other columns are not read; an empty table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for g in groups(as_bytes(batch.column(1))):
                cols = measure(g, window, min_repeat)
                ids = batch.column(0).slice(g.first, len(g.texts))
                spans = pa.array(cols.pop("repeats"), pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64())])))
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, pa.int64()) for v in cols.values()), spans], ["doc_id", *cols, "repeats"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, SCHEMA)
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return (out.withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("n_covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_repeat)))
