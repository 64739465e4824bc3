"""Document-frequency naive Bayes.

Model: for class c, n_c = training documents of c and df_c(t) = documents of
c that contain t (space-split tokens, distinct per document).  A review d
scores ``s_c(d) = sum over occurrences of known t in d of
ln(max(df_c(t), 1) / n_c)``; positive iff ``s_pos > s_neg`` (tie -> negative).
No class prior and no smoothing beyond the max(df, 1) floor.  Words outside
the training vocabulary are ignored; a review with no known word still gets a
prediction (0).

Plan shape: distinct words per document are taken inside each row
(``array_distinct``), so document frequencies need only one shuffle (by word,
with map-side partial counts).  The test side is pre-aggregated to
(doc, word, occurrences) before it meets the vocabulary, and class sizes enter
as scalar subqueries, not joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import text as T
from reviewlens.operators.joins import dealt_anew

# Decision margin as a share of the scores' magnitudes: what the order of a sum
# may change, so it cannot flip an exact tie.
DECISION_SHARE = 1e-12


def space_tokens(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, idx, word (+ ``keep``): single-space split pieces that are not
    blank after a Java-style trim; pieces are kept un-trimmed."""
    return (docs.select("doc_id", *keep,
                        F.posexplode_outer(T.space_split("text")).alias("idx", "word"))
            .filter(T.is_non_blank("word")))


def class_doc_counts(train: DataFrame) -> DataFrame:
    """label, n_docs."""
    return train.groupBy("label").agg(F.count(F.lit(1)).alias("n_docs"))


def _class_size(train: DataFrame, label: str):
    """Documents of a class as a scalar subquery; an empty class raises a
    clear error when the model is evaluated (its probabilities would divide
    by zero)."""
    n = train.select(F.count_if(F.col("label") == label)).scalar()
    return F.when(n > 0, n).otherwise(
        F.raise_error(F.lit(f"naive Bayes needs training documents of class '{label}'")))


def doc_distinct_words(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, word (+ keep): each non-blank space token once per document.
    De-duplicated inside the row (no shuffle); the blank test runs on the
    exploded column, in generated code."""
    words = F.array_distinct(T.space_split("text"))
    return (docs.select("doc_id", *keep, F.explode_outer(words).alias("word"))
            .filter(T.is_non_blank("word")))


def term_doc_freq(train: DataFrame) -> DataFrame:
    """word, df_pos, df_neg over the union vocabulary of both classes
    (a word seen in one class only has 0 for the other)."""
    return (doc_distinct_words(train, "label")
            .groupBy("word")
            .agg(F.count_if(F.col("label") == "pos").cast("bigint").alias("df_pos"),
                 F.count_if(F.col("label") == "neg").cast("bigint").alias("df_neg")))


def word_log_probs(train: DataFrame) -> DataFrame:
    """word, lp_pos, lp_neg: ln(max(df_c, 1) / n_c) per vocabulary word."""
    n_pos = _class_size(train, "pos")
    n_neg = _class_size(train, "neg")
    return term_doc_freq(train).select(
        "word",
        F.ln(F.greatest(F.col("df_pos"), F.lit(1)) / n_pos).alias("lp_pos"),
        F.ln(F.greatest(F.col("df_neg"), F.lit(1)) / n_neg).alias("lp_neg"),
        "df_pos", "df_neg")


def occurrence_counts(docs: DataFrame) -> DataFrame:
    """doc_id, word, n: occurrences of each non-blank space token."""
    return space_tokens(docs).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def bayes_scores(train: DataFrame, test: DataFrame) -> DataFrame:
    """doc_id, score_pos, score_neg: log-space class scores of every test doc."""
    return scores_from_model(dealt_anew(word_log_probs(train), "word"), test)


def scores_from_model(model: DataFrame, test: DataFrame) -> DataFrame:
    """Scores of ``test`` given a fitted model table (word, lp_pos, lp_neg),
    e.g. one written once and reused by every streaming micro-batch."""
    lp = model.select("word", "lp_pos", "lp_neg")
    sums = (occurrence_counts(test).join(lp, "word")
            .groupBy("doc_id")
            .agg(F.sum(F.col("n") * F.col("lp_pos")).alias("score_pos"),
                 F.sum(F.col("n") * F.col("lp_neg")).alias("score_neg")))
    return (test.select("doc_id").join(sums, "doc_id", "left")
            .select("doc_id",
                    F.coalesce("score_pos", F.lit(0.0)).alias("score_pos"),
                    F.coalesce("score_neg", F.lit(0.0)).alias("score_neg")))


def bayes_predict(train: DataFrame, test: DataFrame) -> DataFrame:
    """doc_id, prediction (1 positive, 0 negative)."""
    return decide(bayes_scores(train, test))


def decide(s: DataFrame) -> DataFrame:
    """doc_id, prediction: positive iff score_pos is above score_neg."""
    margin = DECISION_SHARE * (F.abs("score_pos") + F.abs("score_neg"))
    return s.select("doc_id", (F.col("score_pos") - F.col("score_neg") > margin)
                    .cast("int").alias("prediction"))


def bayes_predict_product(train: DataFrame, test: DataFrame) -> DataFrame:
    """doc_id, prediction with plain probability products (parity mode: long
    reviews underflow to 0.0 on both sides and the tie goes negative)."""
    n_pos = _class_size(train, "pos")
    n_neg = _class_size(train, "neg")
    p = term_doc_freq(train).select(
        "word",
        (F.greatest(F.col("df_pos"), F.lit(1)) / n_pos).alias("p_pos"),
        (F.greatest(F.col("df_neg"), F.lit(1)) / n_neg).alias("p_neg"))
    prods = (occurrence_counts(test).join(dealt_anew(p, "word"), "word")
             .groupBy("doc_id")
             .agg(F.product(F.pow("p_pos", "n")).alias("prob_pos"),
                  F.product(F.pow("p_neg", "n")).alias("prob_neg")))
    return (test.select("doc_id").join(prods, "doc_id", "left")
            .select("doc_id",
                    (F.coalesce("prob_pos", F.lit(1.0)) > F.coalesce("prob_neg", F.lit(1.0)))
                    .cast("int").alias("prediction")))
