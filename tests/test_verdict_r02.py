"""Cases that the review of round 2 found."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from reviewlens.functions.text import html_to_text
from reviewlens.operators import centroid, joins, lexicon, neighbors
from reviewlens.operators.ordering import range_buckets, sequence_numbers, smallest
from reviewlens.plans import jobs
from reviewlens.sources import files, tables
from tests.test_files import _read_lines, _write


def review(text, pos=0.5, neg=0.25, indent=None):
    return json.dumps({"text": text, "pos_score": pos, "neg_score": neg}, indent=indent)


# Hot words --------------------------------------------------------------------

def test_a_word_in_every_review_is_spread_over_many_tasks(spark):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("the").alias("word"))
    rows = rows.unionByName(spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("word")))
    table = rows.groupBy("word").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.length("word"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = joins.split_join(rows, table, "word", "n", F.lit(43_000))
        assert out.columns == ["doc_id", "word", "v"]
        per_task = out.filter("word = 'the'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(per_task) >= 4 and max(r["count"] for r in per_task) < 15_000
    assert out.count() == 43_000


# Top-K in levels ----------------------------------------------------------------

def test_top_hits_of_many_blocks(spark, sf_dir, monkeypatch):
    lab, unl = tables.labelled(spark, sf_dir), tables.unlabelled(spark, sf_dir)
    whole = neighbors.knn_hits(lab, unl, 5)
    want = {(r.qid, r.rn): (r.doc_id, r.score) for r in whole.collect()}
    small = neighbors.block_candidates(lab, unl, 5, query_block=16, doc_block=8)
    blocks = -(-lab.count() // 8)
    salts = math.isqrt(blocks - 1) + 1
    assert blocks >= 10 and small.select("salt").distinct().count() <= salts
    got = neighbors.top_hits(small, 5, "salt")
    assert {(r.qid, r.rn): (r.doc_id, r.score) for r in got.collect()} == want
    monkeypatch.setattr(neighbors, "BLOCK_LIST", 3)  # an entry stands for several blocks
    listed = neighbors.top_hits(neighbors.block_candidates(lab, unl, 5, query_block=16, doc_block=8), 5, "salt")
    assert {(r.qid, r.rn): (r.doc_id, r.score) for r in listed.collect()} == want
    assert blocks > salts


def test_salted_windows_bound_a_querys_last_group(spark):
    rows = spark.range(2000).select(F.lit(1).alias("qid"), F.col("id").alias("doc_id"), F.lit(True).alias("is_pos"),
                                    (F.col("id") % 97 / 10).alias("score"), (F.col("id") % 6).alias("salt"))
    got = [(r.doc_id, r.rn) for r in neighbors.top_hits(rows, 7, "salt").orderBy("rn").collect()]
    want = sorted(range(2000), key=lambda i: (-(i % 97) / 10, i))[:7]
    assert got == [(d, k + 1) for k, d in enumerate(want)]
    plan = neighbors.top_hits(rows, 7, "salt")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [row_number()") == 2 and "partitionBy" not in plan.split("Window [row_number()")[0]


# Changes in place of K rows a query ----------------------------------------

def test_sweep_equals_votes_at_every_k(spark, sf_dir):
    lab = tables.labelled(spark, sf_dir)
    train, test = lab.filter("doc_id % 3 > 0"), lab.filter("doc_id % 3 = 0")
    sen = test.select("doc_id", (F.col("doc_id") % 5).cast("double").alias("pos_score"), (F.col("doc_id") % 7).cast("double").alias("neg_score"))
    k_max = 60  # more than the training reviews: the requested K counts beyond the last hit
    got = {r.k: (r.acc_knn, r.acc_knn_sentiment, r.acc_cos) for r in neighbors.sweep(train, test, sen, 2, k_max, query_block=8, doc_block=16).collect()}
    assert sorted(got) == list(range(2, k_max + 1))
    hits = neighbors.knn_hits(train, test, k_max)
    truth = {r.doc_id: r.label == "pos" for r in test.collect()}
    pol = {r.doc_id: None if r.pos_score + r.neg_score == 0 else (r.pos_score - r.neg_score) / (r.pos_score + r.neg_score) for r in sen.collect()}
    votes = {(r.qid, r.k): (r.pos_hits, r.cos_sum) for r in neighbors.prefix_votes(hits, test, k_max).collect()}
    assert len(votes) == k_max * len(truth)
    for k in got:
        right = [0, 0, 0]
        for q, t in truth.items():
            p, c = votes[q, k]
            v = None if pol[q] is None else 0.2 * pol[q] + 0.8 * (2 * p / k - 1)
            for i, d in enumerate((round(2 * p / k - 1, 9) > 0, v is not None and round(v, 9) > 0, c > 0)):
                right[i] += d == t
        assert got[k] == pytest.approx(tuple(x / len(truth) for x in right), abs=1e-12), k


def test_vote_steps_stay_near_the_hits(spark, sf_dir):
    lab, unl = tables.labelled(spark, sf_dir), tables.unlabelled(spark, sf_dir)
    hits = neighbors.knn_hits(lab, unl, 10).cache()
    none = unl.count() - hits.select("qid").distinct().count()
    assert neighbors.vote_steps(hits, unl, 100_000).count() == hits.count() + none
    hits.unpersist()


# One object over several lines ---------------------------------------------

def test_objects_over_several_lines_beside_json_lines(spark, scratch):
    d = f"{scratch}/r"
    _write(f"{d}/1.json", review("pretty\nprinted", indent=2))
    _write(f"{d}/2.json", review("one line"))
    _write(f"{d}/3.json", "\n".join(review(f"line {k}") for k in range(3)) + "\n\n")
    _write(f"{d}/4.json", '{\n"text":\n"a { b",\n"meta":\n{"text": "inner"}\n,"pos_score": "1.5",\n"neg_score": 2}')
    want = ["a { b", "line 0", "line 1", "line 2", "one line", "pretty\nprinted"]
    for strict in (True, False):
        got = files.read_scored_reviews(spark, d, strict).collect()
        assert sorted(r.text for r in got) == want
        assert {(r.pos_score, r.neg_score) for r in got if r.text == "a { b"} == {(1.5, 2.0)}


def test_broken_objects_raise_or_are_skipped_alone(spark, scratch):
    d = f"{scratch}/r"
    _write(f"{d}/1.json", review("whole", indent=1))
    _write(f"{d}/2.json", review("cut", indent=1)[:-9])
    _write(f"{d}/3.json", "not json\n" + review("kept"))
    _write(f"{d}/4.json", review("first") + "\n{broken\n" + review("last"))
    _write(f"{d}/5.json", " \n ")
    assert sorted(r.text for r in files.read_scored_reviews(spark, d, strict=False).collect()) == ["first", "kept", "last", "whole"]
    for name in "234":
        with pytest.raises(Exception, match="no review object"):
            files.read_scored_reviews(spark, f"{d}/{name}.json").select("id").collect()
    assert files.read_scored_reviews(spark, f"{d}/1.json").count() == 1


# S5 / J3, E6, E7 -----------------------------------------------------------------------

def corpus(scratch):
    words = {"pos": ["good", "fine", "great"], "neg": ["bad", "poor", "dull"]}
    for label, w in words.items():
        for k in range(9):
            _write(f"{scratch}/{label}/{k + (0 if label == 'pos' else 3)}.json", review(" ".join(w[(k + j) % 3] for j in range(3)) + " film the", indent=k % 3))
    _write(f"{scratch}/pos/5x.json", "{broken")


def test_heldout_files_are_those_not_read(spark, scratch):
    corpus(scratch)
    used = spark.createDataFrame([("pos", "0"), ("pos", "1"), ("neg", "3"), ("neg", "4")], "label string, id string")

    def names(by_name_only, limit=None):
        return sorted(r.id for r in files.read_heldout(spark, f"{scratch}/pos", "pos", used, by_name_only, limit).collect())

    assert names(False) == ["2", "3", "4", "5", "6", "7", "8"]
    assert names(True) == ["2", "5", "6", "7", "8"]  # 3 and 4 are names that the other class has read
    assert names(False, 2) == ["2", "3"] and names(True, 2) == ["2", "5"]  # the limit counts what is left
    assert {r.label for r in files.read_heldout(spark, f"{scratch}/pos", "pos", used).collect()} == {"pos"}


def test_precision_files_with_limits(spark, scratch):
    corpus(scratch)
    r = jobs.precision_files(spark, f"{scratch}/pos", f"{scratch}/neg", n_train=3, n_test=4).first()
    # texts repeat: three rotations of three words a class, of which the held-out files have all
    assert r.n_correct + r.n_wrong == 6
    every = jobs.precision_files(spark, f"{scratch}/pos", f"{scratch}/neg", n_train=9, n_test=4).first()
    assert (every.n_correct, every.n_wrong, every.precision) == (0, 0, None)  # nothing is left to hold out


def test_numbered_prediction_files(spark, scratch):
    corpus(scratch)
    for k in range(23):
        _write(f"{scratch}/test/{k:03d}.json", review("good great film" if k % 2 else "bad dull film", indent=k % 2))
    _write(f"{scratch}/test/007x.json", '{"pos_score": 1')
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        jobs.number_files(spark, [f"{scratch}/pos", f"{scratch}/neg"], f"{scratch}/test", f"{scratch}/out", n_train=6)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lines = _read_lines(f"{scratch}/out")
    assert [x.split()[0] for x in lines] == [f"{k:05d}" for k in range(23)]
    assert len([p for p in os.listdir(f"{scratch}/out") if p.startswith("part-")]) > 1
    want = jobs.centroid_predict(*[jobs._lenient(spark, p).select("doc_id", "text", "label") for p in ([f"{scratch}/pos", f"{scratch}/neg"], f"{scratch}/test")])
    assert {x.split()[1] for x in lines} <= {"0", "1"} and want.count() == 23


def test_centroid_evaluate_with_limits(spark, sf_dir):
    lab = tables.labelled(spark, sf_dir)
    train, held = jobs.read_limits(lab, 30, 5)
    by = {c: sorted(r.doc_id for r in lab.filter(F.col("label") == c).collect()) for c in ("pos", "neg")}
    assert sorted(r.doc_id for r in train.collect()) == sorted(by["pos"][:30] + by["neg"][:30])
    assert sorted(r.doc_id for r in held.collect()) == sorted(by["pos"][30:35] + by["neg"][30:35])
    r = jobs.centroid_evaluate(lab, n_train=10, n_test=4).first()
    assert 0 < r.n_correct + r.n_wrong <= 8


# Lazy numbering -------------------------------------------------------------------

def jobs_run(spark, build):
    """Jobs that ``build()`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup("lazy-numbering", "")
    try:
        out = build()
        return out, len(sc.statusTracker().getJobIdsForGroup("lazy-numbering"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("keys", [4, 100, 5000])
def test_numbers_are_lazy_and_exact(spark, keys):
    d = spark.range(3000).select((F.col("id") * 7919 % 3000).alias("k"), F.concat(F.lit("path/"), F.md5(F.col("id").cast("string"))).alias("s")).repartition(7)
    for order in ("k", ["s"], ["s", "k"]):
        numbered, started = jobs_run(spark, lambda order=order: sequence_numbers(d, order, sample_keys=keys))
        assert started == 0
        cols = [order] if isinstance(order, str) else order
        rows = sorted(numbered.collect(), key=lambda r: r.seq)
        assert [r.seq for r in rows] == list(range(3000))
        assert [tuple(r[c] for c in cols) for r in rows] == sorted(tuple(r[c] for c in cols) for r in rows)
        chosen, started = jobs_run(spark, lambda order=order: smallest(d, 1234, order, keys))
        assert started == 0
        assert {r.s for r in chosen.collect()} == {r.s for r in rows[:1234]}


def test_buckets_are_many_and_even(spark):
    d = spark.range(20_000).select((F.col("id") * F.col("id")).alias("k"))  # far from equally spaced
    n = [r["count"] for r in range_buckets(d, "k").groupBy("_bucket").count().collect()]
    assert len(n) > 150 and max(n) < 1500
    assert smallest(d, 0, "k").count() == 0 and smallest(d, 10**9, "k").count() == 20_000 and smallest(d, None, "k") is d
    empty = d.limit(0)
    assert sequence_numbers(empty, "k").count() == 0 and smallest(empty, 5, "k").count() == 0
    nulls = spark.createDataFrame([(None,), (3,), (1,), (None,), (1,)], "k long")
    assert [r.k for r in sorted(sequence_numbers(nulls, "k").collect(), key=lambda r: r.seq)] == [None, None, 1, 1, 3]


# By digest ------------------------------------------------------------------------------

def test_texts_with_one_digest_stay_apart(spark):
    rows = [(1, "a", "pos"), (2, "b", "neg"), (3, "a", "neg"), (4, "c", "pos"), (5, "c", "pos"), (6, "long " * 1000, "pos")]
    held = spark.createDataFrame(rows, "doc_id long, text string, label string")
    want = {("a", 1, "neg", 2), ("b", 2, "neg", 1), ("c", 4, "pos", 2), ("long " * 1000, 6, "pos", 1)}
    for digest in (None, lambda c: F.lit(0), lambda c: F.length(c)):
        assert {(r.text, r.doc_id, r.label, r.n_copies) for r in centroid.heldout_dedup(held, digest).collect()} == want
    plan = centroid.heldout_classes(held)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha2") >= 1


# Several lexicon files ----------------------------------------------------------------------

def test_first_row_wins_over_files_and_splits(spark, scratch):
    _write(f"{scratch}/lex/a.txt", "".join(f"a {k} 0.{k % 9} 0 w{k % 50}#1\n" for k in range(400)))
    _write(f"{scratch}/lex/b.txt", "a 1 0.99 0 w3#1\nv 2 0 0.5 new#2\na 3 0 0.75 new#1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = files.read_lexicon(spark, f"{scratch}/lex")
        assert lines.rdd.getNumPartitions() > 4
        got = {r.word: (r.pos, r.neg) for r in lexicon.first_sense(lexicon.parse_lexicon(lines.repartition(5))).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {**{f"w{k}": (round(k % 9 / 10, 1), 0.0) for k in range(50)}, "new": (0.0, 0.5)}


# References without ";" -------------------------------------------------------------------------

@pytest.mark.parametrize(("html", "text"), [
    ("&copy 2020 &copy2020", "© 2020 ©2020"), ("a &amp b &ampc", "a & b &c"), ("&notit; &notin; &not", "¬it; ∉ ¬"), ("x &#65 &#x42y &#67;", "x A By C"),
    ("AT&T & co; a&b;", "AT&T & co; a&b;"), ("&hellip &hellip;", "&hellip …"), ("&amp;lt; &lt;b&gt;", "&lt; <b>"), ("no reference", "no reference"),
])
def test_references_without_semicolon(spark, html, text):
    assert spark.createDataFrame([(html,)], "h string").select(html_to_text(F.col("h"))).first()[0] == text
