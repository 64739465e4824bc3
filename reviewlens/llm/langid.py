"""Operator 9: language identification with averaged hashed subword embeddings.

A text's vector is the mean of the embeddings of its subwords (byte 3-grams and
4-grams of the lower-cased text, hashed to ``BUCKETS`` rows); a linear softmax
on it gives the languages.  Embeddings and weights are trained together by
stochastic gradient descent in numpy on at most ``ROWS_PER_LANG`` labelled rows
a language, in one task (their hashed counts go there, not their texts, and the
driver gets the model).  The same
texts with their letters shuffled are a background class beside the languages,
so a text that is like none of them scores low even with one language.  A fifth
of the rows is held back to fit a temperature (1 at least) and the rejection
threshold, which is set between the held-back rows' scores and those of texts
that have to be rejected: held-back shuffled texts, and rows of languages that
models fitted without them score (``FOLDS`` models, each without its part of the languages).

Since the softmax is linear in the mean, prediction averages rows of the
(BUCKETS x languages) product of embeddings and weights: the whole text is read
and the model that is sent to the tasks stays small.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.llm.words import Group, as_bytes, groups, lean, slices

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
DIM, EPOCHS, RATE = 16, 12, 0.5
#: labelled rows a language that the model is fitted on: the smallest hashes of their ids
ROWS_PER_LANG = 400
#: share of correctly labelled rows that the threshold may reject, and of foreign rows that it may let pass where both can be had
REJECT_SHARE, PASS_SHARE = 0.002, 0.01
#: models fitted without some of the languages
FOLDS = 4
UNKNOWN = "und"

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PART = np.full(256, 32, np.uint64)  # what is no letter is a boundary
for _b in (*range(65, 91), *range(97, 123), *range(128, 256)):
    _PART[_b] = _b | 32 if _b < 128 else _b


def has_letter(text: bytes) -> bool:
    return bool(_IS_LETTER[np.frombuffer(text, np.uint8)].any()) or (not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace"))))


def subwords(g: Group) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all subwords of a group's texts, and (len(texts) + 1) where each text's begin."""
    b = _PART[g.data]
    if len(b) < 4:
        return np.zeros(0, np.int64), np.zeros(len(g.texts) + 1, np.int64)
    three = b[:-3] << np.uint64(16) | b[1:-2] << np.uint64(8) | b[2:-1]
    four = three << np.uint64(8) | b[3:]
    place = np.flatnonzero((b[1:-2] != 32) & (b[2:-1] != 32))  # both middle bytes are letters
    hashed = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    out = np.empty(2 * len(place), np.int64)
    out[0::2], out[1::2] = hashed(three[place]), hashed(four[place] + np.uint64(1 << 40))
    return out, 2 * np.searchsorted(place, g.at - 1)


def prepared(column: pa.Array) -> list[bytes]:
    """Lower-cased UTF-8, between spaces."""
    return [b" " + x.decode("utf-8", "replace").lower().encode() + b"  " for x in as_bytes(column)]


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # (BUCKETS, languages and the background) float32: embeddings @ weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, means: np.ndarray) -> np.ndarray:
        z = (means + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def best(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest language (its number) of each row, and its probability."""
        p = self.probabilities(means)[:, :len(self.langs)]
        return p.argmax(axis=1), p.max(axis=1)

    def means(self, g: Group) -> tuple[np.ndarray, np.ndarray]:
        """Mean table row of each text, and how many subwords it has."""
        part, at = subwords(g)
        n = np.diff(at)
        sums = np.zeros((len(n), self.table.shape[1]))
        if len(part):
            full = n > 0
            sums[full] = np.add.reduceat(self.table[part].astype(np.float64), at[:-1][full], axis=0)
        return sums / np.maximum(n, 1)[:, None], n


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def shuffled(text: bytes) -> bytes:
    """The text (prepared) with its letters in another order; words keep their lengths."""
    b = np.frombuffer(text, np.uint8).copy()
    letters = _PART[b] != 32
    b[letters] = np.random.default_rng(zlib.crc32(text)).permutation(b[letters])
    return b.tobytes()


def training_rows(labelled: DataFrame, rows_per_lang: int) -> DataFrame:
    """lang, mixed_up, bucket array, count array of at most rows_per_lang rows a language (labelled: doc_id, text, lang),
    and of the same rows with shuffled letters (mixed_up)."""
    # rows are chosen without their texts; equal rows come back together, so they are numbered once more with them
    digest = F.xxhash64("text")
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "_digest")
    first = lambda rows: rows.withColumn("_n", F.row_number().over(by_hash)).filter(F.col("_n") <= rows_per_lang)
    few = (first(labelled.select("doc_id", "lang", digest.alias("_digest")))
           .select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("_digest").alias("_text")).distinct())
    chosen = labelled.withColumn("_digest", digest).join(F.broadcast(few), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang")) & (F.col("_digest") == F.col("_text")))
    chosen = first(chosen.select("doc_id", "lang", "text", "_digest")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = prepared(batch.column(1))
            for mixed_up in (False, True):
                for g in groups([shuffled(x) for x in texts] if mixed_up else texts):
                    part, at = subwords(g)
                    each = [np.unique(part[x:y], return_counts=True) for x, y in zip(at[:-1], at[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(g.first, len(g.texts)), pa.array([mixed_up] * len(each)), *(pa.array([e[k].astype(np.int32) for e in each], pa.list_(pa.int32())) for k in (0, 1))],
                                                     ["lang", "mixed_up", "bucket", "n"])

    return chosen.mapInArrow(lean(run), "lang string, mixed_up boolean, bucket array<int>, n array<int>")


def _fit(examples: list[tuple[str, bool, np.ndarray, np.ndarray]], langs: list[str], train: np.ndarray, rng: np.random.Generator) -> Model:
    """A model of the languages, and of the background, from the examples that train numbers."""
    label = np.array([len(langs) if e[1] else langs.index(e[0]) for e in examples])
    share = 1 / np.maximum(np.bincount(label[train], minlength=len(langs) + 1), 1)
    weight = (share / share.mean()).clip(0.2, 5)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, len(langs) + 1)), np.zeros(len(langs) + 1)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(train):
            _, _, part, n = examples[i]
            share_of = n / n.sum()
            mean = share_of @ emb[part]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            p *= rate * weight[label[i]]
            step = out @ p
            out -= np.outer(mean, p)
            bias -= 0.1 * p
            emb[part] -= np.outer(share_of * np.sqrt(len(part)), step)  # a rare subword still moves
    return Model(langs, (emb @ out).astype(np.float32), bias, 1.0, 0.0)


def fit(examples: list[tuple[str, bool, np.ndarray, np.ndarray]], seed: int = 11) -> Model | None:
    """Train on (lang, mixed_up, buckets, counts); None without a row that has subwords."""
    examples = sorted((e for e in examples if len(e[2])), key=lambda e: (e[0], e[1], len(e[2]), e[2].tobytes(), e[3].tobytes()))
    langs = sorted({e[0] for e in examples})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    back = np.zeros(len(examples), bool)  # every fifth row of a language, if it has five
    for lang in langs:
        for mixed_up in (False, True):
            rows = [i for i, e in enumerate(examples) if e[:2] == (lang, mixed_up)]
            back[rng.permutation(rows)[: len(rows) // 5]] = True
    mixed = np.array([e[1] for e in examples])
    number = np.array([langs.index(e[0]) for e in examples])
    means = lambda m, rows: np.array([(examples[i][3] / examples[i][3].sum()) @ m.table[examples[i][2]] for i in rows])
    model = _fit(examples, langs, np.flatnonzero(~back), rng)
    hold = np.flatnonzero(back & ~mixed if (back & ~mixed).any() else ~mixed)
    label, held = number[hold], means(model, hold)

    def loss(t: float) -> float:
        model.temperature = t
        p = model.probabilities(held)[np.arange(len(hold)), label]
        return -np.log(np.maximum(p, 1e-12)).mean() + 1e-4 * abs(np.log(t))

    # the rows are separable, so a temperature below 1 would only hide how sure the model is
    model.temperature = min(np.exp(np.linspace(0, 3, 31)), key=loss)
    best, score = model.best(held)
    right = score[best == label]
    foreign = [model.best(means(model, np.flatnonzero(back & mixed)))[1]] if (back & mixed).any() else []
    folds = min(FOLDS, len(langs)) if len(langs) > 1 else 0
    for fold in range(folds):
        out = number % folds == fold
        rest = [x for k, x in enumerate(langs) if k % folds != fold]
        part = [i for i in range(len(examples)) if not out[i] and not back[i]]
        without = _fit([examples[i] for i in part], rest, np.arange(len(part)), rng)
        without.temperature = model.temperature
        foreign.append(without.best(means(without, np.flatnonzero(out & ~mixed)))[1])
    model.threshold = threshold(right, np.concatenate(foreign) if foreign else np.zeros(0))
    return model


def threshold(right: np.ndarray, foreign: np.ndarray) -> float:
    """At most the REJECT_SHARE quantile of the scores that have to pass; in the middle (of the log odds) between it
    and the PASS_SHARE upper quantile of those that have not to, if that is lower."""
    if not len(right):
        return 0.0
    odds = lambda x: np.log(np.clip(x, 1e-12, 1 - 1e-12) / (1 - np.clip(x, 1e-12, 1 - 1e-12)))
    most = np.quantile(right, REJECT_SHARE)
    least = np.quantile(foreign, 1 - PASS_SHARE) if len(foreign) else 0.0
    return float(most if least >= most else 1 / (1 + np.exp(-(odds(most) + odds(least)) / 2)))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_lang: int = ROWS_PER_LANG) -> Model | None:
    """Fit a model on rows with a lang whose ids are not held out."""
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        examples = [(a, m, np.asarray(b.values), np.asarray(c.values)) for batch in batches for a, m, b, c in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2), batch.column(3), strict=True)]
        model = fit(examples)
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # a bounded number of rows goes to one task; the driver gets the fitted model alone
    found = training_rows(labelled, rows_per_lang).repartition(1).mapInArrow(lean(run), "model binary").collect()
    return pickle.loads(found[0].model) if found else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), keep_text: bool = False) -> DataFrame:
    """doc_id, lang_pred, score, rejected for each row of docs, with the columns ``keep`` of docs after them
    (and the text, if ``keep_text``).

    ``und`` with score 0, rejected: null text, no letter, or no model (nothing
    to learn from).  Otherwise the likeliest language, its calibrated
    probability beside the other languages and the background, and rejected if that is below the model's threshold.  A text
    with letters but without subwords (one-letter words) gets the prior.
    """
    schema = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"), *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = as_bytes(batch.column(1))
            for g in groups([b" " + x.decode("utf-8", "replace").lower().encode() + b"  " for x in raw], 1 << 18):
                rows = slice(g.first, g.first + len(g.texts))
                known = np.array([model is not None and has_letter(x) for x in raw[rows]])
                if model is None:
                    best, score = np.zeros(len(known), int), np.zeros(len(known))
                else:
                    best, score = model.best(model.means(g)[0])
                    score = np.where(known, score, 0.0)
                lang = [model.langs[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
                rejected = ~known | (score < (model.threshold if model else 0))
                rest = [batch.column(k).slice(g.first, len(g.texts)) for k in range(2, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(g.first, len(g.texts)), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected), *rest, *([batch.column(1).slice(g.first, len(g.texts))] if keep_text else [])],
                                                 ["doc_id", "lang_pred", "score", "rejected", *keep, *(["text"] if keep_text else [])])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.schema.fields[2:])
    return schema.mapInArrow(lean(run), "doc_id long, lang_pred string, score double, rejected boolean" + (", " + kept if kept else "") + (", text string" if keep_text else ""))
