"""Hand-sized golden cases for the semantic decisions."""

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import text as T
from reviewlens.operators import bayes, centroid, evaluate, lexicon, neighbors
from reviewlens.operators.ordering import sequence_numbers


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def train(spark):
    return df(spark, [(1, "good movie", "pos"), (2, "good fun", "pos"),
                      (3, "bad movie", "neg"), (4, "bad plot", "neg")],
              "doc_id long, text string, label string")


def test_bayes_golden(spark, train):
    test = df(spark, [(10, "good"), (11, "bad"), (12, "movie"), (13, "unknown words"),
                      (14, "good\nbad"), (15, "good  "), (16, "")], "doc_id long, text string")
    got = {r.doc_id: r.prediction for r in bayes.bayes_predict(train, test).collect()}
    # good: ln(2/2) vs ln(1/2) -> pos; movie: tie -> neg; no known word -> neg (row kept);
    # newline glues words; blank pieces are ignored
    assert got == {10: 1, 11: 0, 12: 0, 13: 0, 14: 0, 15: 1, 16: 0}


def test_bayes_scores_floor_df_at_one(spark, train):
    test = df(spark, [(20, "fun fun")], "doc_id long, text string")
    r = bayes.bayes_scores(train, test).first()
    assert r.score_pos == pytest.approx(2 * __import__("math").log(1 / 2))
    assert r.score_neg == pytest.approx(2 * __import__("math").log(1 / 2))


def test_term_doc_freq_distinct_per_doc(spark):
    t = df(spark, [(1, "a a a b", "pos"), (2, "a\tb", "neg")], "doc_id long, text string, label string")
    got = {r.word: (r.df_pos, r.df_neg) for r in bayes.term_doc_freq(t).collect()}
    assert got == {"a": (1, 0), "b": (1, 0), "a\tb": (0, 1)}


def test_blank_test_is_java_trim(spark):
    d = df(spark, [(1, "x \t   y")], "doc_id long, text string")
    words = [r.word for r in bayes.space_tokens(d).orderBy("idx").collect()]
    # '\t' is blank after a Java trim; a non-breaking space is not
    assert words == ["x", " ", "y"]


@pytest.mark.parametrize("text,n", [("a b  ", 2), ("a b \n", 3), ("", 1), (" a", 2), ("a  b", 3)])
def test_split_length_drops_trailing_empties(spark, text, n):
    d = df(spark, [(text,)], "text string")
    assert d.select(T.split_length("text")).first()[0] == n


def test_centroid_unseen_class_weight_zero_and_undefined_similarity(spark):
    tr = df(spark, [(1, "x y", "pos"), (2, "y z", "neg")], "doc_id long, text string, label string")
    te = df(spark, [(10, "x"), (11, "q"), (12, "")], "doc_id long, text string")
    stats = centroid.class_stats(tr)
    w = {(r.doc_id, r.word): (r.x_pos, r.x_neg) for r in centroid.test_doc_weights(stats, te).collect()}
    assert w == {(10, "x"): (0.0, 0.0)}           # cf_neg(x) = 0 -> both weights 0
    sims = {r.doc_id: (r.sim_pos, r.sim_neg) for r in centroid.weighted_jaccard(stats, te).collect()}
    assert sims[10] == (None, None)               # 0 / 0 -> undefined, not NaN
    assert sims[11] == (None, None)               # no known word
    pred = {r.doc_id: r.prediction for r in centroid.centroid_predict(tr, te).collect()}
    assert pred == {10: 0, 11: 0, 12: 0}


def test_centroid_means_divide_by_class_size_or_parameter(spark):
    tr = df(spark, [(1, "a a b", "pos"), (2, "a", "pos"), (3, "b", "neg")],
            "doc_id long, text string, label string")
    m = {r.word: r for r in centroid.class_stats(tr).collect()}
    import math
    # a in pos: doc1 f=2 L=3 cf=3 ; doc2 f=1 L=1
    want = ((2 / 3) * math.log10(3 / 2) + 1 * math.log10(3 / 1)) / 2
    assert m["a"].mean_pos == pytest.approx(want)
    assert m["a"].mean_neg == 0.0
    m2 = {r.word: r for r in centroid.class_stats(tr, n_docs=10000).collect()}
    assert m2["a"].mean_pos == pytest.approx(want * 2 / 10000)


def test_heldout_dedup_negative_wins(spark):
    h = df(spark, [(1, "same", "pos"), (2, "same", "neg"), (3, "other", "pos")],
           "doc_id long, text string, label string")
    got = {r.text: (r.doc_id, r.label, r.n_copies) for r in centroid.heldout_dedup(h).collect()}
    assert got == {"same": (1, "neg", 2), "other": (3, "pos", 1)}


def _neg_flags(spark, tokens, tags):
    rows = [(1, i, t, g, 0.0, 0.0, bool(__import__("re").match(r"^(JJ|RB|NN|V)", g)))
            for i, (t, g) in enumerate(zip(tokens, tags))]
    t = df(spark, rows, "doc_id long, idx int, token string, tag string, pos double, neg double, "
                        "content boolean")
    return [(r.token, r.negated) for r in
            lexicon.negation_flags(t).filter("content").orderBy("idx").collect()]


def test_negation_scope(spark):
    assert _neg_flags(spark, ["no", "good", "movie", ".", "bad"], ["DT", "JJ", "NN", ".", "JJ"]) == \
        [("good", True), ("movie", True), ("bad", False)]
    # "not" tagged as a content word is kept and does not negate
    assert _neg_flags(spark, ["not", "good"], ["RB", "JJ"]) == [("not", False), ("good", False)]
    # the flag survives content words and is reset by the next other token
    assert _neg_flags(spark, ["not", "very", "good", "the", "film"], ["DT", "RB", "JJ", "DT", "NN"]) == \
        [("very", True), ("good", True), ("film", False)]
    assert _neg_flags(spark, ["no", "no", "fun"], ["DT", "DT", "NN"]) == [("fun", True)]


def test_lexicon_parse_first_line_wins(spark):
    lines = df(spark, [(0, "a 1 0.5 0 good#1 fine#2 gloss"), (1, "v 2 0 0.75 hate#1"),
                       (2, "n 3 1 0 joy#1"), (3, "a 4 0 0.9 good#2"), (4, "# comment"),
                       (5, "a 5 0.25 0.25")], "line_no long, line string")
    got = {r.word: (r.pos, r.neg) for r in lexicon.first_sense(lexicon.parse_lexicon(lines)).collect()}
    assert got == {"good": (0.5, 0.0), "hate": (0.0, 0.75)}


def test_doc_sentiment_swaps_under_negation(spark):
    docs = df(spark, [(1, "<p>No good, not bad</p>"), (2, "")], "doc_id long, text string")
    tags = df(spark, [("no", "DT"), ("good", "JJ"), (",", "."), ("not", "RB"), ("bad", "JJ")],
              "token string, tag string")
    lex = df(spark, [("good", 0.75, 0.0), ("bad", 0.0, 0.5)], "word string, pos double, neg double")
    s = {r.doc_id: r for r in lexicon.doc_sentiment(docs, lexicon.token_lookup(tags, lex)).collect()}
    # "good" negated -> adds to neg; "not" is content (RB), "bad" not negated
    assert (s[1].pos_score, s[1].neg_score) == (0.0, 1.25)
    assert s[1].text == "good not bad "
    assert (s[2].pos_score, s[2].neg_score, s[2].text) == (0.0, 0.0, "")


def test_html_to_text(spark):
    d = df(spark, [("<html><!-- c --><script>var x='<p>';</script><style>p{}</style>"
                    "<p>A&amp;B</p><p>C&lt;D&nbsp;E</p></html>",)], "h string")
    assert d.select(T.html_to_text("h")).first()[0] == "A&BC<D E"


def test_query_normalisation_deletes_characters(spark):
    d = df(spark, [("Don't STOP\nme now! café",)], "t string")
    assert d.select(T.normalize_query_text("t")).first()[0] == "dont stopme now caf"


def test_knn_ratio_divides_by_requested_k_and_null_polarity(spark):
    hits = df(spark, [(1, 1, 10, True, 0.5)], "qid long, rn int, doc_id long, is_pos boolean, score double")
    q = df(spark, [(1,), (2,)], "doc_id long")
    v = neighbors.votes(hits, q)
    sen = df(spark, [(1, 0.0, 0.0), (2, 0.0, 0.0)], "doc_id long, pos_score double, neg_score double")
    maj = {r.doc_id: r.prediction for r in neighbors.predict(v, 3, "majority").collect()}
    assert maj == {1: 0, 2: 0}                      # 2*1/3 - 1 < 0 although every hit is positive
    assert {r.doc_id: r.prediction for r in neighbors.predict(v, 1, "majority").collect()} == {1: 1, 2: 0}
    cos = {r.doc_id: r.prediction for r in neighbors.predict(v, 3, "cos").collect()}
    assert cos == {1: 1, 2: 0}
    senti = {r.doc_id: r.prediction for r in neighbors.predict(v, 1, "sentiment", sen).collect()}
    assert senti == {1: 0, 2: 0}                    # 0/0 polarity is undefined -> negative


def test_holdout_split_is_deterministic(spark):
    d = spark.range(2000).withColumnRenamed("id", "doc_id")
    a = {r.doc_id: r.split for r in evaluate.holdout_split(d, 42).collect()}
    b = {r.doc_id: r.split for r in evaluate.holdout_split(d.repartition(7), 42).collect()}
    assert a == b
    n_test = sum(v == "test" for v in a.values())
    assert 140 < n_test < 260


def test_confusion_counts(spark):
    p = df(spark, [(1, 1), (2, 0), (3, 1), (4, 0)], "doc_id long, prediction int")
    t = df(spark, [(1, "pos"), (2, "pos"), (3, "neg"), (4, "neg")], "doc_id long, label string")
    r = evaluate.confusion(p, t).first()
    assert (r.tp, r.tn, r.fp, r.fn, r.accuracy) == (1, 1, 1, 1, 0.5)
    empty = evaluate.confusion(p.limit(0), t).first()
    assert empty.accuracy is None


def test_sequence_numbers_match_row_number(spark):
    d = spark.range(5000).select((F.col("id") * 7919 % 10007).alias("doc_id")).repartition(9)
    s = sequence_numbers(d, "doc_id", num_partitions=5)
    got = sorted((r.doc_id, r.seq) for r in s.collect())
    assert [q for _, q in got] == list(range(5000))
    assert T.zero_padded(F.lit(123456)) is not None
    assert spark.range(1).select(T.zero_padded(F.lit(7)), T.zero_padded(F.lit(123456))).first() == ("00007", "123456")


def test_exact_holdout_takes_nine_tenths(spark):
    d = spark.range(1003).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("x"))
    s = evaluate.holdout_split_exact(d.repartition(5), 42)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 1003 * 9 // 10, "test": 1003 - 1003 * 9 // 10}
    again = {r.doc_id: r.split for r in evaluate.holdout_split_exact(d, 42).collect()}
    assert again == {r.doc_id: r.split for r in s.collect()}


def test_bayes_empty_class_raises_clear_error(spark):
    tr = df(spark, [(1, "good movie", "pos")], "doc_id long, text string, label string")
    te = df(spark, [(2, "good")], "doc_id long, text string")
    with pytest.raises(Exception, match="needs training documents of class 'neg'"):
        bayes.bayes_predict(tr, te).collect()


def test_product_mode_underflows_where_log_space_decides(spark):
    # 'rare' is in 1 of 3 positive docs and in the only negative doc, 'x' in all.
    tr = df(spark, [(1, "x rare", "pos"), (2, "x y", "pos"), (3, "x y", "pos"), (4, "x rare", "neg"),
                    (5, "z", "neg")], "doc_id long, text string, label string")
    long_review = " ".join(["y"] * 400 + ["rare"] * 400)
    te = df(spark, [(10, long_review), (11, "y")], "doc_id long, text string")
    logp = {r.doc_id: r.prediction for r in bayes.bayes_predict(tr, te).collect()}
    prod = {r.doc_id: r.prediction for r in bayes.bayes_predict_product(tr, te).collect()}
    # log space: pos = 400 ln(2/3) + 400 ln(1/3), neg = 400 ln(1/2) + 400 ln(1/2) -> neg wins
    assert logp == {10: 0, 11: 1}
    # products underflow to 0.0 on both sides for the long review: tie -> negative
    assert prod == {10: 0, 11: 1}
    long_pos = " ".join(["y"] * 2000)
    te2 = df(spark, [(12, long_pos)], "doc_id long, text string")
    assert bayes.bayes_predict(tr, te2).first().prediction == 1          # 2000 ln(2/3) > 2000 ln(1/2)
    assert bayes.bayes_predict_product(tr, te2).first().prediction == 0  # both underflow to 0.0
