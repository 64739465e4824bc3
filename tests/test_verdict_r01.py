"""Cases that the review of round 1 found."""

import os

import pytest
from pyspark.sql import functions as F

from reviewlens.functions.text import html_to_text
from reviewlens.operators import bayes, centroid
from reviewlens.plans import jobs
from reviewlens.sources import tables
from reviewlens.sources.files import read_scored_reviews


@pytest.mark.parametrize(("html", "text"), [
    ("i <3 this movie. great cast, great plot.<br />again", "i <3 this movie. great cast, great plot.again"),
    ("a < b and c > d <b>x</b>", "a < b and c > d x"),
    ("1 <2> 3<!-- gone --><p class='x'>y</p>", "1 <2> 3y"),
])
def test_only_real_tags_are_removed(spark, html, text):
    assert spark.createDataFrame([(html,)], "h string").select(html_to_text(F.col("h"))).first()[0] == text


def reviews(scratch, *lines):
    with open(f"{scratch}/1.json", "w") as f:
        f.write("\n".join(lines))
    return [scratch]


def test_strict_reader_raises_on_a_missing_score_or_text_whatever_is_selected(spark, scratch):
    path = reviews(scratch, '{"text":"good"}')
    with pytest.raises(Exception, match="without text or score"):
        read_scored_reviews(spark, path).select("text").collect()


def test_lenient_reader_keeps_reviews_with_bad_scores(spark, scratch):
    path = reviews(scratch, '{"text":"good","pos_score":"n/a"}', '{"text":"fine","pos_score":0.5,"neg_score":0.25}', '{"pos_score":1}')
    out = read_scored_reviews(spark, path, strict=False)
    assert sorted(r.text for r in out.select("text").collect()) == ["fine", "good"]
    assert sorted((r.text, r.pos_score, r.neg_score) for r in out.collect()) == [("fine", 0.5, 0.25), ("good", 0.0, 0.0)]


def test_small_score_differences_decide(spark):
    s = spark.createDataFrame([(1, -10.0, -10.0000004), (2, -10.0, -10.0), (3, -10.0000004, -10.0), (4, 0.0, 0.0)], "doc_id long, score_pos double, score_neg double")
    assert {r.doc_id: r.prediction for r in bayes.decide(s).collect()} == {1: 1, 2: 0, 3: 0, 4: 0}


def test_scaled_means_decide_alike(spark, sf_dir):
    train, test = tables.labelled(spark, sf_dir), tables.unlabelled(spark, sf_dir)
    sims = centroid.weighted_jaccard(centroid.class_stats(train, 10**10), test)
    plain = {r.doc_id: int(r.sim_pos is not None and r.sim_neg is not None and r.sim_pos > r.sim_neg) for r in sims.collect()}
    assert {r.doc_id: r.prediction for r in centroid.centroid_predict(train, test, 10**10).collect()} == plain


def test_equal_ids_of_two_folders_stay_apart(spark, scratch):
    def write(name, *lines):
        os.makedirs(f"{scratch}/{name}")
        with open(f"{scratch}/{name}/1.json", "w") as f:
            f.write("\n".join(lines))
        return f"{scratch}/{name}"

    review = '{{"text":"{}","pos_score":0,"neg_score":0,"id":"1"{}}}'
    two = lambda text: [review.format(text, f',"source":"{k}"') for k in "pq"]
    train = [write("label=pos", *two("good")), write("label=neg", *two("bad"))]
    test = write("test", review.format("good", ',"source":"a/1.txt"'), review.format("bad", ',"source":"b/1.txt"'))
    jobs.classify_files(spark, train, test, f"{scratch}/out")
    assert sorted(r.value for r in spark.read.text(f"{scratch}/out").collect()) == ["1 0", "1 1"]
    same = write("same", review.format("good", ""), review.format("bad", ""))
    with pytest.raises(Exception, match="several reviews with the id 1"):
        jobs.classify_files(spark, train, same, f"{scratch}/out2")


@pytest.fixture
def skew_conf(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k"}
    was = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("job", [bayes.bayes_predict, bayes.bayes_predict_product, centroid.centroid_predict])
def test_a_hot_word_is_split(spark, skew_conf, job):
    docs = spark.range(0, 20000, 1, 8).select(F.col("id").alias("doc_id"), F.concat(F.lit("film w"), F.col("id").cast("string")).alias("text"),
                                              F.when(F.col("id") % 2 == 0, "pos").otherwise("neg").alias("label"))
    out = job(docs, docs.drop("label"))
    assert len(out.collect()) == 20000
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
