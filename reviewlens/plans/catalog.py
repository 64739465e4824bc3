"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the test-data tables of ``sf_dir`` (or tables Spark derives
from them) in full.  Doubles in outputs are rounded so that results can be
compared across engines; decisions inside the operators round score
differences before comparing, so summation order cannot flip them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import text as T
from reviewlens.operators import bayes, evaluate
from reviewlens.sinks import writers
from reviewlens.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Hold-out seed and the per-class read limit of the mean-vector
# job (its documented constant).
SEED = 42
READ_LIMIT_PER_CLASS = 10000
SHOWN_LIMIT_PER_CLASS = 50   # of the query limited_docs, so that it cuts
PARITY_N_DOCS = 10000   # fixed divisor of the class means in the original job


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def rnd(c, d: int = 9):
    return F.round(F.col(c) if isinstance(c, str) else c, d)


# ---------------------------------------------------------------------------
# M0: labelled corpus in, Bayes predictions out
# ---------------------------------------------------------------------------

@register("space_tokens")
def q_space_tokens(spark, sf):
    return bayes.space_tokens(tables.documents(spark, sf))


@register("class_doc_counts")
def q_class_doc_counts(spark, sf):
    return bayes.class_doc_counts(tables.labelled(spark, sf))


@register("term_doc_freq")
def q_term_doc_freq(spark, sf):
    return bayes.term_doc_freq(tables.labelled(spark, sf))


@register("bayes_scores")
def q_bayes_scores(spark, sf):
    s = bayes.bayes_scores(tables.labelled(spark, sf), tables.unlabelled(spark, sf))
    return s.select("doc_id", rnd("score_pos", 6).alias("score_pos"),
                    rnd("score_neg", 6).alias("score_neg"))


@register("bayes_predict")
def q_bayes_predict(spark, sf):
    return bayes.bayes_predict(tables.labelled(spark, sf), tables.unlabelled(spark, sf))


# ---------------------------------------------------------------------------
# M1: evaluation and small shared operators
# ---------------------------------------------------------------------------

@register("holdout_split")
def q_holdout_split(spark, sf):
    return evaluate.holdout_split(tables.labelled(spark, sf), SEED).select("doc_id", "label", "split")


@register("holdout_split_exact")
def q_holdout_split_exact(spark, sf):
    return (evaluate.holdout_split_exact(tables.labelled(spark, sf), SEED)
            .select("doc_id", "label", "split"))


def _bayes_eval(spark, sf):
    train, test = evaluate.train_test(tables.labelled(spark, sf), SEED)
    pred = bayes.bayes_predict(train, test.select("doc_id", "text"))
    return evaluate.confusion(pred, test)


@register("bayes_confusion")
def q_bayes_confusion(spark, sf):
    return _bayes_eval(spark, sf).select("tp", "tn", "fp", "fn")


@register("bayes_accuracy")
def q_bayes_accuracy(spark, sf):
    c = _bayes_eval(spark, sf)
    return c.select((F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("n_eval"),
                    rnd("accuracy").alias("accuracy"))


@register("bayes_prediction_lines")
def q_bayes_prediction_lines(spark, sf):
    p = bayes.bayes_predict(tables.labelled(spark, sf), tables.unlabelled(spark, sf))
    lines = writers.prediction_lines(p, "doc_id")
    return lines.select(F.split_part("line", F.lit(" "), F.lit(1)).alias("id"), "line")


@register("bayes_scores_product")
def q_bayes_scores_product(spark, sf):
    return bayes.bayes_predict_product(tables.labelled(spark, sf), tables.unlabelled(spark, sf))


@register("doc_distinct_words")
def q_doc_distinct_words(spark, sf):
    return bayes.doc_distinct_words(tables.labelled(spark, sf))


@register("train_union")
def q_train_union(spark, sf):
    lab = tables.labelled(spark, sf)
    neg = lab.filter(F.col("label") == "neg")
    pos = lab.filter(F.col("label") == "pos")
    u = neg.unionByName(pos)
    return u.select("doc_id", "label", F.md5("text").alias("text_md5"))


def limited(labelled: DataFrame, per_class: int = READ_LIMIT_PER_CLASS) -> DataFrame:
    """The first ``per_class`` reviews of each class by doc_id."""
    parts = [labelled.filter(F.col("label") == c).orderBy("doc_id").limit(per_class)
             for c in ("neg", "pos")]
    return parts[0].unionByName(parts[1])


@register("limited_docs")
def q_limited_docs(spark, sf):
    return limited(tables.labelled(spark, sf), SHOWN_LIMIT_PER_CLASS).select("doc_id", "label")


@register("review_id_from_path")
def q_review_id_from_path(spark, sf):
    return tables.pages(spark, sf).select("page_id", T.id_from_path("url").alias("id"))


@register("label_from_path")
def q_label_from_path(spark, sf):
    lab = tables.labelled(spark, sf)
    path = F.concat(F.lit("processed_data/train/"), F.col("label"), F.lit("/"),
                    F.col("doc_id").cast("string"), F.lit(".json"))
    p = lab.select("doc_id", path.alias("path"))
    return p.select("doc_id", "path", T.label_from_path("path").alias("label"),
                    T.id_from_path("path").alias("id"))


# ---------------------------------------------------------------------------
# M2: class-mean vectors
# ---------------------------------------------------------------------------

from reviewlens.operators import centroid  # noqa: E402
from reviewlens.operators.ordering import sequence_numbers  # noqa: E402
from reviewlens.plans import jobs  # noqa: E402
from reviewlens.session import checkpoint_folder  # noqa: E402
from reviewlens.sources import files  # noqa: E402


@register("clean_tokens")
def q_clean_tokens(spark, sf):
    return centroid.clean_tokens(tables.documents(spark, sf))


@register("term_collection_freq")
def q_term_collection_freq(spark, sf):
    return centroid.term_collection_freq(tables.labelled(spark, sf))


@register("doc_term_counts")
def q_doc_term_counts(spark, sf):
    return centroid.doc_term_counts(tables.documents(spark, sf))


@register("in_vocab_counts")
def q_in_vocab_counts(spark, sf):
    stats = centroid.class_stats(tables.labelled(spark, sf))
    v = centroid.in_vocab_counts(stats, tables.unlabelled(spark, sf))
    return v.select("doc_id", "word", "f", "count_terms")


@register("mean_vectors")
def q_mean_vectors(spark, sf):
    s = centroid.class_stats(tables.labelled(spark, sf))
    return s.select("word", rnd("mean_pos", 12).alias("mean_pos"), rnd("mean_neg", 12).alias("mean_neg"))


@register("test_doc_weights")
def q_test_doc_weights(spark, sf):
    stats = centroid.class_stats(tables.labelled(spark, sf))
    x = centroid.test_doc_weights(stats, tables.unlabelled(spark, sf))
    return x.select("doc_id", "word", rnd("x_pos", 12).alias("x_pos"), rnd("x_neg", 12).alias("x_neg"))


@register("weighted_jaccard")
def q_weighted_jaccard(spark, sf):
    stats = centroid.class_stats(tables.labelled(spark, sf))
    s = centroid.weighted_jaccard(stats, tables.unlabelled(spark, sf))
    return s.select("doc_id", rnd("sim_pos").alias("sim_pos"), rnd("sim_neg").alias("sim_neg"))


@register("centroid_predict")
def q_centroid_predict(spark, sf):
    return centroid.centroid_predict(tables.labelled(spark, sf), tables.unlabelled(spark, sf))


@register("centroid_predict_parity")
def q_centroid_predict_parity(spark, sf):
    # the original's constants: means divided by 10,000 and both similarities
    # computed with the negative-class weights
    return centroid.centroid_predict(tables.labelled(spark, sf), tables.unlabelled(spark, sf),
                                     n_docs=PARITY_N_DOCS, weights="shared_neg")


@register("centroid_predict_numbered")
def q_centroid_predict_numbered(spark, sf):
    test = tables.unlabelled(spark, sf)
    p = centroid.centroid_predict(tables.labelled(spark, sf), test)
    # the ids are numbered, not the predictions, which cost more than an id to make
    n = p.join(sequence_numbers(test.select("doc_id"), "doc_id"), "doc_id")
    seq = T.zero_padded("seq")
    return n.select(seq.alias("seq"), "doc_id", "prediction",
                    F.concat_ws(" ", seq, F.col("prediction").cast("string")).alias("line"))


def _heldout(spark, sf):
    lab = evaluate.holdout_split(tables.labelled(spark, sf), SEED)
    train = lab.filter(F.col("split") == "train").drop("split")
    # held-out: labelled reviews not read for training (anti join on the id)
    held = lab.drop("split").join(train.select("doc_id"), "doc_id", "left_anti")
    return train, held


@register("heldout_docs")
def q_heldout_docs(spark, sf):
    _, held = _heldout(spark, sf)
    return held.select("doc_id", "label")


@register("heldout_dedup")
def q_heldout_dedup(spark, sf):
    _, held = _heldout(spark, sf)
    return centroid.heldout_classes(held).select("doc_id", "label", "n_copies")


@register("centroid_precision")
def q_centroid_precision(spark, sf):
    train, held = _heldout(spark, sf)
    r = centroid.centroid_precision(train, held)
    return r.select("n_correct", "n_wrong", rnd("precision").alias("precision"))


# Reviews read for training and for the evaluation from each
# class by the queries below, so that both limits cut at every size.
SHOWN_TRAIN = 40
SHOWN_TEST = 15


@register("heldout_unread_docs")
def q_heldout_unread_docs(spark, sf):
    # nothing but the anti join keeps the training reviews out
    _, held = jobs.read_limits(tables.labelled(spark, sf), SHOWN_TRAIN, SHOWN_TEST)
    return held.select("doc_id", "label")


@register("centroid_precision_limited")
def q_centroid_precision_limited(spark, sf):
    train, held = jobs.read_limits(tables.labelled(spark, sf), SHOWN_TRAIN, SHOWN_TEST)
    r = centroid.centroid_precision(train, held)
    return r.select("n_correct", "n_wrong", rnd("precision").alias("precision"))


@register("scored_review_round_trip")
def q_scored_review_round_trip(spark, sf):
    """Labelled reviews written as scored JSON by class and read back: the class
    comes from the real paths of the files, the text and scores from their lines."""
    lab = tables.labelled(spark, sf)
    out = checkpoint_folder(spark, "scored-reviews")
    rows = lab.select(F.col("doc_id").cast("string").alias("id"), "text", F.length("text").cast("double").alias("pos_score"),
                      (F.col("doc_id") / 4).alias("neg_score"), "label")
    writers.write_scored_reviews(rows, out)
    r = files.read_scored_reviews(spark, out)
    return r.select("id", "label", F.md5("text").alias("text_md5"), "pos_score", "neg_score")


# ---------------------------------------------------------------------------
# M3: TF-IDF neighbours
# ---------------------------------------------------------------------------

from reviewlens.operators import neighbors as nb  # noqa: E402


@register("analyzed_terms")
def q_analyzed_terms(spark, sf):
    d = tables.documents(spark, sf)
    t = (d.select("doc_id", F.posexplode_outer(T.analyzed_terms("text")).alias("idx", "word"))
         .filter(F.col("word").isNotNull()))
    return t.withColumn("is_stop", F.col("word").isin(T.STOP_WORDS))


@register("normalized_query_text")
def q_normalized_query_text(spark, sf):
    u = tables.unlabelled(spark, sf)
    return u.select("doc_id", T.normalize_query_text("text").alias("query_text"))


@register("tfidf_corpus_stats")
def q_tfidf_corpus_stats(spark, sf):
    s = nb.corpus_stats(tables.labelled(spark, sf))
    return s.select("word", "df", "n_docs", rnd("idf").alias("idf"))


@register("tfidf_pair_scores")
def q_tfidf_pair_scores(spark, sf):
    s = nb.pair_scores(tables.labelled(spark, sf), tables.unlabelled(spark, sf))
    return s.select("qid", "doc_id", "is_pos", rnd("score").alias("score"))


@register("knn_top_hits")
def q_knn_top_hits(spark, sf):
    return nb.knn_hits(tables.labelled(spark, sf), tables.unlabelled(spark, sf), nb.DEFAULT_K) \
        .select("qid", "rn", "doc_id", "is_pos", "score")


@register("knn_votes")
def q_knn_votes(spark, sf):
    test = tables.unlabelled(spark, sf)
    v = nb.votes(nb.knn_hits(tables.labelled(spark, sf), test, nb.DEFAULT_K), test)
    return v.select("qid", "n_hits", "pos_hits", rnd("cos_sum", 6).alias("cos_sum"))


@register("knn_predict_cos")
def q_knn_predict_cos(spark, sf):
    return nb.knn_predict(tables.labelled(spark, sf), tables.unlabelled(spark, sf),
                          nb.DEFAULT_K, "cos")


@register("knn_predict_majority")
def q_knn_predict_majority(spark, sf):
    return nb.knn_predict(tables.labelled(spark, sf), tables.unlabelled(spark, sf),
                          nb.DEFAULT_K, "majority")


# ---------------------------------------------------------------------------
# M4: preprocessing (lexicon scoring with negation)
# ---------------------------------------------------------------------------

from reviewlens.operators import lexicon as lx  # noqa: E402
from reviewlens.sources import fixtures  # noqa: E402


def _lookup(spark, sf):
    docs = tables.documents(spark, sf)
    lex = lx.first_sense(lx.parse_lexicon(fixtures.lexicon_lines(docs)))
    return lx.token_lookup(fixtures.counted_tags(docs), lex)


def _tagged(spark, sf):
    toks = lx.review_tokens(tables.documents(spark, sf))
    return lx.tagged_tokens(toks, _lookup(spark, sf))


@register("html_to_text")
def q_html_to_text(spark, sf):
    return tables.pages(spark, sf).select("page_id", lx.clean_review_text(F.col("html")).alias("text"))


@register("word_tokens")
def q_word_tokens(spark, sf):
    return lx.review_tokens(tables.documents(spark, sf))


@register("lexicon_parse")
def q_lexicon_parse(spark, sf):
    return lx.parse_lexicon(fixtures.lexicon_lines(tables.documents(spark, sf)))


@register("lexicon_first_sense")
def q_lexicon_first_sense(spark, sf):
    return lx.first_sense(lx.parse_lexicon(fixtures.lexicon_lines(tables.documents(spark, sf))))


@register("tagged_tokens")
def q_tagged_tokens(spark, sf):
    return _tagged(spark, sf).select("doc_id", "idx", "token", "tag")


@register("content_words")
def q_content_words(spark, sf):
    return _tagged(spark, sf).filter("content").select("doc_id", "idx", "token", "tag")


@register("negated_tokens")
def q_negated_tokens(spark, sf):
    n = lx.negated_by_review(tables.documents(spark, sf), _lookup(spark, sf))
    return n.filter("content").select("doc_id", "idx", "token", "negated")


@register("token_sentiment")
def q_token_sentiment(spark, sf):
    n = lx.negated_by_review(tables.documents(spark, sf), _lookup(spark, sf))
    return n.filter("content").select("doc_id", "idx", "token", "pos", "neg", "negated")


@register("doc_sentiment")
def q_doc_sentiment(spark, sf):
    s = lx.doc_sentiment(tables.documents(spark, sf), _lookup(spark, sf))
    return s.select("doc_id", "pos_score", "neg_score")


@register("retained_text")
def q_retained_text(spark, sf):
    return lx.doc_sentiment(tables.documents(spark, sf), _lookup(spark, sf)).select("doc_id", "text")


@register("sentiment_disagreement")
def q_sentiment_disagreement(spark, sf):
    lab = tables.labelled(spark, sf)
    s = lx.doc_sentiment(lab.select("doc_id", "text"), _lookup(spark, sf))
    return lx.disagreement(s.join(lab.select("doc_id", "label"), "doc_id"))


# ---------------------------------------------------------------------------
# M5: sentiment-blended votes and the K sweep
# ---------------------------------------------------------------------------

SWEEP_K_MAX = 200


@register("doc_polarity")
def q_doc_polarity(spark, sf):
    s = lx.doc_sentiment(tables.unlabelled(spark, sf), _lookup(spark, sf))
    return s.select("doc_id", rnd(nb.polarity(F.col("pos_score"), F.col("neg_score"))).alias("polarity"))


@register("knn_predict_sentiment")
def q_knn_predict_sentiment(spark, sf):
    test = tables.unlabelled(spark, sf)
    sen = lx.doc_sentiment(test, _lookup(spark, sf))
    return nb.knn_predict(tables.labelled(spark, sf), test, nb.DEFAULT_K, "sentiment", sen)


@register("knn_prefix_votes")
def q_knn_prefix_votes(spark, sf):
    train, test = evaluate.train_test(tables.labelled(spark, sf), SEED)
    hits = nb.knn_hits(train, test, SWEEP_K_MAX)
    pv = nb.prefix_votes(hits, test, SWEEP_K_MAX)
    return pv.select("qid", "k", "pos_hits", rnd("cos_sum", 6).alias("cos_sum"))


@register("knn_sweep")
def q_knn_sweep(spark, sf):
    train, test = evaluate.train_test(tables.labelled(spark, sf), SEED)
    sen = lx.doc_sentiment(test.select("doc_id", "text"), _lookup(spark, sf))
    s = nb.sweep(train, test, sen, 1, SWEEP_K_MAX)
    return s.select("k", rnd("acc_knn").alias("acc_knn"),
                    rnd("acc_knn_sentiment").alias("acc_knn_sentiment"),
                    rnd("acc_cos").alias("acc_cos"))
