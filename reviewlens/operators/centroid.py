"""Class-mean TF-IDF vectors compared by weighted Jaccard similarity.

Tokens: single-space split pieces with every non letter/digit character
removed; empty results dropped.  Per class c, with f = count of t in d,
L(d) = number of split pieces of d (trailing empty pieces dropped) and
cf_c(t) = occurrences of t over the documents of c:

    mean_c(t) = sum_{d in c} (f / L(d)) * log10(cf_c(t) / f) / N_c

N_c defaults to the class size (``n_docs`` overrides it).  For a review to
classify, T(d) = its in-vocabulary tokens and

    x_c(t) = (f / T(d)) * log10(cf_c(t) / f)      (both 0 if cf_pos or cf_neg is 0)
    sim_c(d) = sum min(x_c, mean_c) / sum max(x_c, mean_c)   over t in d and in V

Positive iff sim_pos > sim_neg (``tie='neg'``) or >= (``tie='pos'``); an
undefined similarity (0/0, or no known word) is negative.

Plan shape: the class means need one aggregation by word; the identity
``sum (f/L) log10(cf/f) = log10(cf) * sum f/L - sum (f/L) log10 f`` removes the
join of every (doc, word) row with its collection frequency.  Scoring needs
one join with the per-word statistics and one shuffle by document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions import text as T
from reviewlens.operators.joins import dealt_anew

# Decision margin as a share of the larger similarity (see bayes.DECISION_SHARE)
DECISION_SHARE = 1e-12


def clean_tokens(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, idx, word (+ keep): space-split pieces stripped to letters and
    digits; empty results dropped."""
    return (docs.select("doc_id", *keep,
                        F.posexplode_outer(T.space_split("text")).alias("idx", "raw"))
            .select("doc_id", *keep, "idx", T.strip_symbols("raw").alias("word"))
            .filter(F.col("word") != ""))


def doc_term_counts(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, word, f, n_pieces (+ keep): term counts per document and the
    document's split length."""
    # The document length is projected *before* the explode: an expression
    # on `text` next to the generator would be evaluated once per exploded
    # token over the whole text (quadratic in document length).  Symbols are
    # deleted from the whole text at once, which leaves the same words between
    # the same spaces.  The texts are dealt by doc_id, so that the words of a
    # document are counted where they are and never shuffled.
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (docs.repartition(n_parts, "doc_id")
              .select("doc_id", *keep, T.split_length("text").alias("n_pieces"),
                      T.space_split(F.regexp_replace("text", T.SYMBOL_NOT_SPACE_RUN, "")).alias("words"))
              .select("doc_id", *keep, "n_pieces", F.explode_outer("words").alias("word")))
    return (pieces.filter(F.col("word") != "")
            .groupBy("doc_id", "word", "n_pieces", *keep)
            .agg(F.count(F.lit(1)).alias("f"))
            .select("doc_id", "word", "n_pieces", *keep, "f"))


def term_collection_freq(train: DataFrame) -> DataFrame:
    """word, cf_pos, cf_neg: occurrences per class over the union vocabulary."""
    return (clean_tokens(train, "label").groupBy("word")
            .agg(F.count_if(F.col("label") == "pos").cast("bigint").alias("cf_pos"),
                 F.count_if(F.col("label") == "neg").cast("bigint").alias("cf_neg")))


def class_stats(train: DataFrame, n_docs: int | None = None) -> DataFrame:
    """word, cf_pos, cf_neg, mean_pos, mean_neg: the vocabulary with its
    collection frequencies and class-mean weights (0 where unseen)."""
    tf = doc_term_counts(train, "label")
    rel = F.col("f") / F.col("n_pieces")
    is_pos = F.col("label") == "pos"
    is_neg = F.col("label") == "neg"
    g = tf.groupBy("word").agg(
        F.sum(F.when(is_pos, F.col("f")).otherwise(0)).cast("bigint").alias("cf_pos"),
        F.sum(F.when(is_neg, F.col("f")).otherwise(0)).cast("bigint").alias("cf_neg"),
        F.max(F.when(is_pos, F.col("f"))).alias("m_pos"),
        F.max(F.when(is_neg, F.col("f"))).alias("m_neg"),
        F.sum(F.when(is_pos, rel).otherwise(0.0)).alias("a_pos"),
        F.sum(F.when(is_neg, rel).otherwise(0.0)).alias("a_neg"),
        F.sum(F.when(is_pos, rel * F.log10("f")).otherwise(0.0)).alias("b_pos"),
        F.sum(F.when(is_neg, rel * F.log10("f")).otherwise(0.0)).alias("b_neg"))
    if n_docs is None:
        n_pos = train.select(F.count_if(is_pos)).scalar()
        n_neg = train.select(F.count_if(is_neg)).scalar()
    else:
        n_pos = n_neg = F.lit(n_docs)

    def mean(cf, m, a, b, n):
        # a word of one document only has log10(1): exactly 0, without rounding noise
        return F.when(F.col(cf) > F.col(m),
                      (F.log10(F.col(cf)) * F.col(a) - F.col(b)) / n).otherwise(F.lit(0.0))

    return g.select("word", "cf_pos", "cf_neg",
                    mean("cf_pos", "m_pos", "a_pos", "b_pos", n_pos).alias("mean_pos"),
                    mean("cf_neg", "m_neg", "a_neg", "b_neg", n_neg).alias("mean_neg"))


def in_vocab_counts(stats: DataFrame, test: DataFrame) -> DataFrame:
    """doc_id, word, f, count_terms, + the word's statistics: test terms that
    are in the training vocabulary, with T(d) = in-vocabulary token count."""
    tf = doc_term_counts(test).select("doc_id", "word", "f")
    j = tf.join(dealt_anew(stats, "word"), "word")
    return j.withColumn("count_terms", F.sum("f").over(Window.partitionBy("doc_id")))


def test_doc_weights(stats: DataFrame, test: DataFrame, weights: str = "per_class") -> DataFrame:
    """doc_id, word, x_pos, x_neg, mean_pos, mean_neg.

    ``weights='shared_neg'`` reproduces the variant where both similarities
    use the negative-class weight."""
    v = in_vocab_counts(stats, test)
    known = (F.col("cf_pos") > 0) & (F.col("cf_neg") > 0)
    tfw = F.col("f") / F.col("count_terms")

    def w(cf):
        return F.when(known, tfw * F.log10(F.col(cf) / F.col("f"))).otherwise(F.lit(0.0))

    x_neg = w("cf_neg")
    x_pos = x_neg if weights == "shared_neg" else w("cf_pos")
    return v.select("doc_id", "word", x_pos.alias("x_pos"), x_neg.alias("x_neg"),
                    "mean_pos", "mean_neg")


def weighted_jaccard(stats: DataFrame, test: DataFrame, weights: str = "per_class") -> DataFrame:
    """doc_id, sim_pos, sim_neg for every test document (NULL when undefined)."""
    x = test_doc_weights(stats, test, weights)
    sims = x.groupBy("doc_id").agg(
        F.try_divide(F.sum(F.least("x_pos", "mean_pos")), F.sum(F.greatest("x_pos", "mean_pos")))
        .alias("sim_pos"),
        F.try_divide(F.sum(F.least("x_neg", "mean_neg")), F.sum(F.greatest("x_neg", "mean_neg")))
        .alias("sim_neg"))
    return test.select("doc_id").join(sims, "doc_id", "left")


def decide(sim_pos, sim_neg, tie: str = "neg"):
    d, margin = sim_pos - sim_neg, DECISION_SHARE * F.greatest(F.abs(sim_pos), F.abs(sim_neg))
    rule = d > margin if tie == "neg" else d >= -margin
    return F.coalesce(rule, F.lit(False)).cast("int")


def centroid_predict(train: DataFrame, test: DataFrame, n_docs: int | None = None,
                     weights: str = "per_class", tie: str = "neg") -> DataFrame:
    """doc_id, prediction."""
    sims = weighted_jaccard(class_stats(train, n_docs), test, weights)
    return sims.select("doc_id", decide(F.col("sim_pos"), F.col("sim_neg"), tie).alias("prediction"))


def heldout_classes(heldout: DataFrame, digest: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id (smallest copy), label, n_copies for each distinct held-out text;
    when copies carry both labels the negative one wins (it is merged last).

    Rows are grouped by a digest, so (digest, doc_id, label) is what every row
    sends through the shuffle.  Only texts whose digest several rows have are
    compared themselves, which keeps different texts with one digest apart."""
    d = heldout.withColumn("_digest", (digest or (lambda c: F.sha2(c, 256)))(F.col("text")))
    copies = [F.min("doc_id").alias("doc_id"), F.max_by("label", F.col("label") == "neg").alias("label"),
              F.count(F.lit(1)).alias("n_copies")]
    by_digest = d.groupBy("_digest").agg(*copies)
    several = by_digest.filter("n_copies > 1").select("_digest")
    by_text = d.join(several, "_digest", "left_semi").groupBy("_digest", "text").agg(*copies)
    return (by_digest.filter("n_copies = 1").drop("_digest")
            .unionByName(by_text.drop("_digest", "text")))


def heldout_dedup(heldout: DataFrame, digest: Callable[[Column], Column] | None = None) -> DataFrame:
    """doc_id, text, label, n_copies: held-out reviews keyed by text."""
    return heldout.select("doc_id", "text").join(heldout_classes(heldout, digest), "doc_id")


def centroid_precision(train: DataFrame, heldout: DataFrame, n_docs: int | None = None,
                       weights: str = "per_class") -> DataFrame:
    """n_correct, n_wrong, precision (= accuracy) on de-duplicated held-out
    reviews; evaluation uses the >= tie rule."""
    d = heldout_dedup(heldout)
    pred = centroid_predict(train, d.select("doc_id", "text"), n_docs, weights, tie="pos")
    j = pred.join(d.select("doc_id", "label"), "doc_id")
    ok = (F.col("prediction") == 1) == (F.col("label") == "pos")
    return (j.agg(F.count_if(ok).cast("bigint").alias("n_correct"),
                  F.count_if(~ok).cast("bigint").alias("n_wrong"))
            .withColumn("precision",
                        F.try_divide(F.col("n_correct").cast("double"),
                                     (F.col("n_correct") + F.col("n_wrong")).cast("double"))))
