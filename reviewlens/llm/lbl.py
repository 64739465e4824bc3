"""Operator 7: language-model scores of a log-bilinear model trained by noise-contrastive estimation.

Words are lower-cased (A-Z) and each text ends with an end token.  The model
predicts a token's class from the classes of the ``CONTEXT`` tokens before it.
The most frequent training words are classes of their own, in number
``GROWTH`` times the cube root of all training words (``MOST`` at most), so
the vocabulary grows with the counts; a rarer word's class is one of
``ENDINGS``, a hash of its last three bytes; the end token has one.  The
context's vector is the sum of its classes' vectors, each scaled by those of
its place.  A class's probability is a product of two softmaxes, over ranges of
classes of neighbouring ranks and over the classes of the range; scores are
products of the context's vector and an output vector plus a bias.  A rare
word's probability is its class's times (c + 0.5) / (Nr + 0.5 (Vr + 1)) over the
rare training words of the ending, so the probabilities of all words, an unseen
one of each ending among them, sum to 1.

Counting, training and scoring run over all whole texts.  Training goes in
rounds, of which ``PARTS`` make a pass: in each, every task trains on its texts
of one part, from the average of the parameters after the round before; the
averages are weighted by tokens.  After the first pass rounds go on until the
loss on held-back training texts (one in ``HELD_BACK``: counted, but left out of
the rounds) falls by less than ``LEAST_GAIN`` a token, for ``PASSES`` passes at
most.  Words are told apart by 64-bit hashes.  The counts stay a
distributed table: the words that make at least 1 in ``FREQUENT`` training
tokens (at most ``FREQUENT`` of them) are sent to the tasks as two arrays, the
others are joined, none of which is frequent.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import save
from reviewlens.llm.words import Group, as_bytes, groups, mix, slices

GROWTH, MOST, ENDINGS = 32, 1 << 18, 256
FREQUENT = 1 << 20
CONTEXT, DIM, NOISE, SHARED_NOISE, BATCH, RATE = 4, 16, 2, 64, 4096, 0.1
PARTS, PASSES, HELD_BACK, LEAST_GAIN = 4, 2, 64, 0.02
#: a round's texts are trained on by about sqrt(words / WORDS_EACH) tasks at most (LEAST_TASKS where that is less), whose parameters are added up FAN_IN at a time
WORDS_EACH, LEAST_TASKS, FAN_IN = 25_000, 64, 8


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 1; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def endings(g: Group, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of each word, a hash of its last three bytes (A-Z lower-cased) below ENDINGS."""
    key = np.zeros(len(first), np.uint64)
    for k in (1, 2, 3):
        at = end - k
        byte = g.data[np.maximum(at, 0)].astype(np.uint64)
        byte += np.where((byte >= 65) & (byte <= 90), 32, 0).astype(np.uint64)
        key = key * np.uint64(257) + np.where(at >= first, byte + np.uint64(1), np.uint64(0))
    return (mix(key) % np.uint64(ENDINGS)).astype(np.int64)


def count_words(texts: DataFrame) -> DataFrame:
    """word (hash), ending, n of all words of the column text, saved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in groups(as_bytes(batch.column(0)), 1 << 24):
                first, end, h, _ = g.words(lower=True)
                w, i, n = np.unique(h, return_index=True, return_counts=True)
                e = endings(g, first[i], end[i])
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(e.astype(np.int32)), pa.array(n.astype(np.int64))], ["word", "ending", "n"])

    counted = texts.select("text").mapInArrow(run, "word long, ending int, n long")
    return save(counted.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n")), "lm-counts")


@dataclass
class Vocabulary:
    top: np.ndarray  # hashes of the words with a class of their own, sorted
    top_class: np.ndarray  # their classes
    ending_class: np.ndarray  # the class of each ending
    end: int  # the class of the end token
    frequent: np.ndarray  # hashes of frequent words, sorted (the top words among them)
    count: np.ndarray
    n_texts: int
    n_words: int
    n_distinct: int
    class_counts: np.ndarray  # falling
    rare_log: np.ndarray  # of each class, log10 of Nr + 0.5 (Vr + 1); 0 for words of their own and the end

    @property
    def begin(self) -> int:  # of contexts only
        return len(self.class_counts)

    @property
    def total(self) -> float:
        """N + 0.5 (V + 1), the end token among them."""
        return self.n_words + self.n_texts + 0.5 * (self.n_distinct + (self.n_texts > 0) + 1)

    def without_counts(self) -> Vocabulary:
        """What classes need: no frequent words."""
        none = np.zeros(0, np.int64)
        return replace(self, frequent=none.view(np.uint64), count=none)


def vocabulary(counts: DataFrame, n_texts: int, top: int | None = None, frequent: int = FREQUENT) -> Vocabulary:
    per_ending = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()
    rare_n, rare_v = np.zeros(ENDINGS), np.zeros(ENDINGS)
    ending = per_ending["ending"].to_numpy()
    rare_n[ending], rare_v[ending] = per_ending["n"].to_numpy(), per_ending["v"].to_numpy()
    n_words, n_distinct = int(rare_n.sum()), int(rare_v.sum())
    if top is None:
        top = min(MOST, math.ceil(GROWTH * n_words ** (1 / 3)))
    first = counts.orderBy(F.desc("n"), "word").limit(top).toArrow()
    often = counts.filter(F.col("n") >= max(2, n_words / frequent)).select("word", "n").toArrow()  # ``frequent`` rows at most
    w, n, e = first["word"].to_numpy().view(np.uint64), first["n"].to_numpy(), first["ending"].to_numpy()
    rare_n -= np.bincount(e, n, ENDINGS)
    rare_v -= np.bincount(e, minlength=ENDINGS)
    all_counts = np.concatenate([n, rare_n, [n_texts]])  # top words, endings, end
    rank = np.argsort(-all_counts, kind="stable")
    class_of = np.empty(len(rank), np.int64)
    class_of[rank] = np.arange(len(rank))
    rare_log = np.concatenate([np.zeros(len(w)), np.log10(rare_n + 0.5 * (rare_v + 1)), [0.0]])[rank]
    fw, fn = often["word"].to_numpy().view(np.uint64), often["n"].to_numpy()
    extra = ~np.isin(w, fw)
    fw, fn = np.append(fw, w[extra]), np.append(fn, n[extra])
    by, by_word = np.argsort(fw), np.argsort(w)
    return Vocabulary(w[by_word], class_of[:len(w)][by_word], class_of[len(w):-1], int(class_of[-1]), fw[by], fn[by], n_texts, n_words, n_distinct,
                      all_counts[rank].astype(np.float64), rare_log)


def find(sorted_: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value's place in a sorted array, and whether it is there."""
    if not len(sorted_):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    i = np.minimum(np.searchsorted(sorted_, h), len(sorted_) - 1)
    return i, sorted_[i] == h


@dataclass
class Sequence:
    """The texts of a group as tokens (their words and ends)."""

    target: np.ndarray  # class of each token
    back: np.ndarray  # (CONTEXT, tokens): classes of the tokens before it, the nearest first
    starts: np.ndarray  # where each text's tokens begin
    word: np.ndarray  # hashes of the words alone
    at: np.ndarray  # where each text's words begin
    is_rare: np.ndarray  # of the words alone


def sequence(v: Vocabulary, g: Group) -> Sequence:
    first, end, h, at = g.words(lower=True)
    i, is_top = find(v.top, h)
    rare = ~is_top
    classes = np.empty(len(h), np.int64)
    classes[rare] = v.ending_class[endings(g, first[rare], end[rare])]
    if len(v.top):
        classes[is_top] = v.top_class[i[is_top]]
    n = np.diff(at)
    starts = at + np.arange(len(at))
    target = np.full(starts[-1], v.end, np.int32)
    is_word = np.ones(len(target), bool)
    is_word[starts[1:] - 1] = False
    target[is_word] = classes
    back = np.full((CONTEXT, len(target)), v.begin, np.int32)
    place = np.arange(len(target)) - np.repeat(starts[:-1], n + 1)
    for k in range(1, CONTEXT + 1):
        there = np.flatnonzero(place >= k)
        back[k - 1, there] = target[there - k]
    return Sequence(target, back, starts, h, at, rare)


class Model:
    """Parameters in one float32 vector: context classes, scales of each place, outputs and biases of ranges and of classes.

    Range r holds the classes from r * width to (r + 1) * width - 1.
    """

    def __init__(self, class_counts: np.ndarray, flat: np.ndarray | None = None, dim: int = DIM):
        n = len(class_counts)
        self.width = max(1, math.ceil(math.sqrt(n)))
        self.ranges = -(-n // self.width)
        self.shapes = ((n + 1, dim), (CONTEXT, dim), (self.ranges, dim), (self.ranges,), (n, dim), (n,))
        sizes = [math.prod(s) for s in self.shapes]
        new = flat is None
        if new:
            flat = np.random.default_rng(5).normal(0, 0.1, sum(sizes))
        self.flat = np.array(flat, np.float32)
        parts = np.split(self.flat, np.cumsum(sizes)[:-1])
        self.word, self.place, self.range_out, self.range_bias, self.out, self.bias = (p.reshape(s) for p, s in zip(parts, self.shapes, strict=True))
        q = (class_counts + 0.5) / (class_counts + 0.5).sum()
        self.range_q = np.add.reduceat(q, np.arange(0, n, self.width))
        self.q = q / self.range_q[np.arange(n) // self.width]
        if new:
            self.place[:] = 1
            self.range_bias[:], self.bias[:] = np.log(self.range_q), np.log(self.q)

    def log_p(self, back: np.ndarray, target: np.ndarray, rows: int = 1 << 15) -> np.ndarray:
        """Natural logarithm of the probability of each target, normalised over all classes."""
        found = np.empty(len(target))
        placed = self.word[None] * self.place[:, None]
        h = np.ones((min(rows, len(target)), self.word.shape[1] + 1), np.float32)
        for at in range(0, len(target), rows):
            t = target[at:at + rows]
            h = h[:len(t)]
            np.take(placed[0], back[0, at:at + rows], axis=0, out=h[:, :-1], mode="clip")
            for k in range(1, CONTEXT):
                h[:, :-1] += np.take(placed[k], back[k, at:at + rows], axis=0)
            r = t // self.width
            p = normalised(h, self.range_out, self.range_bias, r)
            by = np.argsort(r.astype(np.uint16), kind="stable")  # short numbers sort by radix; at most sqrt(MOST) + 1 ranges
            edge = np.append(np.flatnonzero(np.diff(r[by], prepend=-1)), len(by))
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                i = by[lo:hi]
                a = int(r[i[0]]) * self.width
                p[i] += normalised(h[i], self.out[a:a + self.width], self.bias[a:a + self.width], t[i] - a)
            found[at:at + rows] = p
        return found


def normalised(h: np.ndarray, out: np.ndarray, bias: np.ndarray, chosen: np.ndarray, rows: int = 1024) -> np.ndarray:
    """log softmax of h @ out + bias at the chosen column of each row, whose last element is 1 (for the bias); by blocks
    of rows that fit a core's cache."""
    found = np.empty(len(h), np.float32)
    weights = np.concatenate([out, bias[:, None]], axis=1).T.copy()
    ones = np.ones(len(out), np.float32)
    most = math.sqrt(np.einsum("ij,ij->i", h, h).max() * np.einsum("ij,ij->j", weights, weights).max())
    for at in range(0, len(h), rows):
        s = h[at:at + rows] @ weights
        if most > 80:  # exp() might leave float32
            s -= s.max(axis=1, keepdims=True)
        picked = s[np.arange(len(s)), chosen[at:at + rows]]
        np.exp(s, out=s)
        found[at:at + rows] = picked - np.log(s @ ones)
    return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Trainer:
    """Noise-contrastive estimation with AdaGrad, for ranges (a batch shares its noise samples, weighted to NOISE for
    each token) and for classes within the target's range (NOISE samples for each token)."""

    def __init__(self, model: Model, seed: int):
        self.m, self.rng = model, np.random.default_rng(seed)
        self.range_cumulative = np.cumsum(model.range_q)
        self.log_range = np.log(NOISE * model.range_q).astype(np.float32)
        self.cumulative = np.append(0, np.cumsum(model.q))  # each range adds 1
        self.log_class = np.log(NOISE * model.q).astype(np.float32)
        self.squares = [np.ones((len(p), 1) if p.ndim == 2 else len(p), np.float32) for p in (model.word, model.place, model.range_out, model.range_bias, model.out, model.bias)]

    def change(self, i: np.ndarray, *changes: tuple[int, np.ndarray, np.ndarray]) -> None:
        """One AdaGrad step of the rows i (with repeats) of parameters: (place in squares, parameter, gradient of each
        of i); a row's dimensions share its rate."""
        by = np.argsort(i.astype(np.uint16) if len(self.m.word) <= 1 << 16 else i, kind="stable")  # short numbers sort by radix
        s = i[by]
        first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        s = s[first]
        for k, to, rows in changes:
            x = np.take(rows, by, axis=0)
            if rows.ndim == 2 and rows.dtype == np.float32 and rows.shape[1] % 2 == 0:  # two numbers at a time, as the parts of a complex one
                g = np.add.reduceat(x.view(np.complex64), first, axis=0).view(np.float32)
            else:
                g = np.add.reduceat(x, first, axis=0)
            self.squares[k][s] += (np.einsum("ij,ij->i", g, g) / g.shape[1])[:, None] if g.ndim == 2 else g * g
            to[s] -= RATE * g / np.sqrt(self.squares[k][s])

    def step(self, back: np.ndarray, t: np.ndarray) -> None:
        m = self.m
        x = np.take(m.word, back, axis=0)
        h = np.einsum("kij,kj->ij", x, m.place)
        r = t // m.width
        noise = np.minimum(np.searchsorted(self.range_cumulative, self.rng.random(SHARED_NOISE), side="right"), m.ranges - 1)
        out_t, out_n = np.take(m.range_out, r, axis=0), m.range_out[noise]
        true = sigmoid(np.einsum("ij,ij->i", h, out_t) + m.range_bias[r] - self.log_range[r]) - 1
        false = sigmoid(h @ out_n.T + (m.range_bias[noise] - self.log_range[noise])) * np.float32(NOISE / SHARED_NOISE)
        dh = true[:, None] * out_t + false @ out_n
        self.change(np.append(r, noise), (2, m.range_out, np.concatenate([true[:, None] * h, false.T @ h])), (3, m.range_bias, np.append(true, false.sum(axis=0))))
        by = np.argsort(r.astype(np.uint16), kind="stable")  # neighbouring searches end near each other
        drawn = np.empty((len(t), NOISE), np.int64)
        drawn[by] = np.searchsorted(self.cumulative, (r[:, None] + self.rng.random((len(t), NOISE)))[by], side="right") - 1
        lo = (r * m.width)[:, None]
        drawn = np.clip(drawn, lo, np.minimum(lo + m.width, len(m.bias)) - 1)
        which = np.concatenate([t[:, None], drawn], axis=1)  # the target first
        out = np.take(m.out, which, axis=0)
        g = sigmoid(np.einsum("ij,ikj->ik", h, out) + m.bias[which] - self.log_class[which])
        g[:, 0] -= 1
        dh += np.einsum("ik,ikj->ij", g, out)
        self.change(which.ravel(), (4, m.out, (g[:, :, None] * h[:, None, :]).reshape(-1, h.shape[1])), (5, m.bias, g.ravel()))
        self.change(back.ravel(), (0, m.word, (dh[None] * m.place[:, None]).reshape(-1, h.shape[1])))
        self.change(np.arange(CONTEXT), (1, m.place, np.einsum("kij,ij->kj", x, dh)))


def train_round(texts: DataFrame, v: Vocabulary, start: Model, seed: int) -> Model:
    """Every task trains on all its texts from ``start``; the average of the tasks' parameters, weighted by their tokens."""
    counts, flat = v.class_counts, start.flat
    small = v.without_counts()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Model(counts, flat), 0
        trainer = Trainer(model, seed)
        for batch in slices(batches):
            for g in groups(as_bytes(batch.column(0))):
                s = sequence(small, g)
                by = trainer.rng.permutation(len(s.target))
                for k in range(0, len(by), BATCH):
                    i = by[k:k + BATCH]
                    trainer.step(s.back[:, i], s.target[i])
                seen += len(by)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([model.flat.tobytes()], pa.binary())], ["seen", "flat"])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, mean = average(batches)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([mean.tobytes()], pa.binary())], ["seen", "flat"])

    kind = "seen long, flat binary"
    tasks = max(LEAST_TASKS, math.isqrt(v.n_words // WORDS_EACH))
    parts = save(texts.select("text").coalesce(tasks).mapInArrow(run, kind), "lm-parts")
    n = parts.count()
    while n > FAN_IN:
        parts = save(parts.coalesce(-(-n // FAN_IN)).mapInArrow(add_up, kind), "lm-parts")  # by files, without a shuffle
        n = parts.count()
    return Model(counts, average(parts.toArrow().to_batches())[1]) if n else start


def average(batches: Iterable[pa.RecordBatch]) -> tuple[int, np.ndarray]:
    """Tokens and mean parameters of rows (seen, flat)."""
    seen, total = 0, np.zeros(0)
    for batch in batches:
        for n, flat in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            x = n * np.frombuffer(flat.as_buffer(), np.float32).astype(np.float64)
            total = total + x if seen else x
            seen += n
    return seen, (total / max(1, seen)).astype(np.float32)


def loss(texts: DataFrame, v: Vocabulary, model: Model) -> float:
    """Mean negative log-probability (natural) of the classes of the texts' tokens; 0 without texts."""
    counts, flat, small = v.class_counts, model.flat, v.without_counts()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model(counts, flat)
        for batch in slices(batches):
            for g in groups(as_bytes(batch.column(0))):
                s = sequence(small, g)
                yield pa.RecordBatch.from_arrays([pa.array([len(s.target)], pa.int64()), pa.array([-float(fitted.log_p(s.back, s.target).sum())])], ["n", "loss"])

    n, total = texts.select("text").mapInArrow(run, "n long, loss double").agg(F.sum("n"), F.sum("loss")).first()
    return total / n if n else 0.0


def train(texts: DataFrame, v: Vocabulary) -> Model:
    """The model fitted to texts (doc_id, text) in rounds; parts and held-back texts go by a hash of both columns."""
    model = Model(v.class_counts)
    if not v.n_texts:
        return model
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS * HELD_BACK))
    back = save(texts.filter(dealt < PARTS), "lm-held-back")  # one in HELD_BACK, read after every round
    last = math.inf
    for k in range(PARTS * PASSES):
        model = train_round(texts.filter((dealt >= PARTS) & (dealt % PARTS == k % PARTS)), v, model, 17 + k)
        if k >= PARTS - 2:
            now = loss(back, v, model)
            if k >= PARTS - 1 and last - now < LEAST_GAIN:
                break
            last = now
    return model


def measure(g: Group, v: Vocabulary, model: Model) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Of each text of a group: n_tokens, n_known, base_log, model_log, of all but the words that are not frequent;
    those words, and (len(texts) + 1) where each text's begin."""
    s = sequence(v, g)
    log_p = model.log_p(s.back, s.target) / math.log(10) - v.rare_log[s.target]
    word, which = np.unique(s.word, return_inverse=True)
    i, often = find(v.frequent, word)
    log_c = (np.where(often, np.log10(v.count[i] + 0.5), 0.0) if len(v.frequent) else np.zeros(len(word)))[which]
    often = often[which]
    sums = lambda x, at: np.diff(np.append(0, np.cumsum(x))[at])
    by_doc = lambda x, at: np.array([x[p:q].sum() for p, q in zip(at[:-1], at[1:], strict=True)])
    cols = {"n_tokens": np.diff(s.starts), "n_known": sums(often, s.at) + (v.n_texts > 0), "base_log": by_doc(log_c, s.at) + math.log10(v.n_texts + 0.5),
            "model_log": by_doc(log_p, s.starts) + by_doc(np.where(s.is_rare, log_c, 0.0), s.at)}
    return cols, s.word[~often], np.searchsorted(np.flatnonzero(~often), s.at)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", learn_from=lambda doc_id: ~held_out(doc_id), top: int | None = None, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, learned_from, n_tokens, n_known, train_tokens, base_score, score (log10) of each row of docs.

    Null texts count as empty: one end token.  Each of repeated rows gets its
    row.  Without a training text both scores are those of an unseen token
    (probability 1) and 0.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), learn_from(F.col(id_col)).alias("learned_from"))
    texts = rows.filter("learned_from").select("doc_id", "text")
    counts = count_words(texts)
    v = vocabulary(counts, texts.count(), top, frequent)
    class_counts, flat = v.class_counts, train(texts, v).flat

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(class_counts, flat)
        for batch in slices(batches):
            for g in groups(as_bytes(batch.column(2))):
                cols, rest, at = measure(g, v, model)
                kept = [batch.column(k).slice(g.first, len(g.texts)) for k in (0, 1, 3)]
                kinds = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_log": pa.float64(), "model_log": pa.float64()}
                words = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(rest.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(cols[k], kinds[k]) for k in kinds), words], ["row", "doc_id", "learned_from", *kinds, "words"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "learned_from")
    found = save(numbered.mapInArrow(run, "row long, doc_id long, learned_from boolean, n_tokens long, n_known long, base_log double, model_log double, words array<long>"), "lm-rows")
    few = counts.filter(F.col("n") < max(2, v.n_words / frequent)).select("word", F.col("n").alias("c"))
    c = F.coalesce("c", F.lit(0))
    rest = (found.select("row", F.explode("words").alias("word")).join(few, "word", "left").groupBy("row")
            .agg(F.sum(F.log10(c + 0.5)).alias("rest_log"), F.sum((c > 0).cast("long")).alias("rest_known")))
    out = found.drop("words").join(rest, "row", "left")
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    base = F.col("base_log") + rest_log - F.col("n_tokens") * math.log10(v.total)
    model_score = F.col("model_log") + rest_log
    return out.select("doc_id", "learned_from", "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
                      F.lit(v.n_words + v.n_texts).cast("long").alias("train_tokens"), base.alias("base_score"), (model_score if v.n_texts else base).alias("score"))
