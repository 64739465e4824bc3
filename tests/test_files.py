"""Round trips through the file sources and sinks, in fresh scratch folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from reviewlens.operators import lexicon
from reviewlens.plans import jobs
from reviewlens.sinks import writers
from reviewlens.sources import files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        f.write(text)


def _read_lines(folder):
    parts = sorted(p for p in os.listdir(folder) if p.startswith("part-"))
    out = []
    for p in parts:
        with open(os.path.join(folder, p), encoding="utf8") as f:
            out += [l.rstrip("\n") for l in f]
    return out


def test_raw_review_scan(spark, scratch):
    _write(f"{scratch}/train/pos/12_7.txt", "<b>Great</b> film!")
    _write(f"{scratch}/train/neg/3_1.txt", "Bad.\nVery bad.")
    _write(f"{scratch}/test/9_0.txt", "ok")
    df = files.read_raw_reviews(spark, [f"{scratch}/train/pos", f"{scratch}/train/neg", f"{scratch}/test"])
    got = {r.id: (r.label, r.raw) for r in df.collect()}
    assert got == {"12_7": ("pos", "<b>Great</b> film!"), "3_1": ("neg", "Bad.\nVery bad."),
                   "9_0": (None, "ok")}


def test_scored_json_strict_and_lenient(spark, scratch):
    good = f"{scratch}/ok"
    _write(f"{good}/1.json", json.dumps({"text": "good movie ", "pos_score": 0, "neg_score": 0.5}))
    _write(f"{good}/2.json", json.dumps({"text": "", "pos_score": 1.0, "neg_score": 0}))
    rows = {r.id: (r.text, r.pos_score, r.neg_score)
            for r in files.read_scored_reviews(spark, good).collect()}
    assert rows == {"1": ("good movie ", 0.0, 0.5), "2": ("", 1.0, 0.0)}

    bad = f"{scratch}/bad"
    _write(f"{bad}/1.json", json.dumps({"text": "fine", "pos_score": 0, "neg_score": 0}))
    _write(f"{bad}/2.json", "{not json")
    _write(f"{bad}/3.json", json.dumps({"pos_score": 0, "neg_score": 0}))
    with pytest.raises(Exception):
        files.read_scored_reviews(spark, bad, strict=True).collect()
    lenient = files.read_scored_reviews(spark, bad, strict=False)
    assert [r.id for r in lenient.collect()] == ["1"]

    missing = f"{scratch}/missing"
    _write(f"{missing}/3.json", json.dumps({"pos_score": 0, "neg_score": 0}))
    with pytest.raises(Exception, match="review without text"):
        files.read_scored_reviews(spark, missing, strict=True).collect()


def test_read_limit_in_path_order(spark, scratch):
    for i in range(5):
        _write(f"{scratch}/d/{i}.json", json.dumps({"text": f"t{i}", "pos_score": 0, "neg_score": 0}))
    got = [r.id for r in files.read_scored_reviews(spark, f"{scratch}/d", limit=3).collect()]
    assert sorted(got) == ["0", "1", "2"]
    assert files.read_scored_reviews(spark, f"{scratch}/d", limit=0).count() == 0


def test_lexicon_file_first_line_wins(spark, scratch):
    _write(f"{scratch}/lex.txt", "# header\na 1 0.5 0 good#1 fine#2 gloss\nv 2 0 0.75 hate#1\n"
                                 "n 3 1 0 joy#1\na 4 0 0.9 good#2\n")
    lines = files.read_lexicon(spark, f"{scratch}/lex.txt")
    got = {r.word: (r.pos, r.neg) for r in lexicon.first_sense(lexicon.parse_lexicon(lines)).collect()}
    assert got == {"good": (0.5, 0.0), "hate": (0.0, 0.75)}


def test_prediction_and_sweep_sinks(spark, scratch):
    pred = spark.createDataFrame([("10", 1), ("9", 0), ("2", 1)], "id string, prediction int")
    writers.write_prediction_lines(pred.repartition(3), f"{scratch}/pred")
    assert _read_lines(f"{scratch}/pred") == ["10 1", "2 1", "9 0"]
    sw = spark.createDataFrame([(2, 0.5, 0.25, 1.0), (1, 0.75, 0.5, 0.5)],
                               "k int, acc_knn double, acc_knn_sentiment double, acc_cos double")
    writers.write_sweep_report(sw, f"{scratch}/sweep")
    assert _read_lines(f"{scratch}/sweep") == ["1 0.75 0.5 0.5", "2 0.5 0.25 1.0"]


def test_preprocess_then_classify_files(spark, scratch):
    data = f"{scratch}/data"
    _write(f"{data}/train/pos/1_9.txt", "<p>A good, good film</p>")
    _write(f"{data}/train/pos/2_8.txt", "<p>Good fun</p>")
    _write(f"{data}/train/neg/3_1.txt", "<p>Not good. A bad film</p>")
    _write(f"{data}/train/neg/4_2.txt", "<p>bad plot</p>")
    _write(f"{data}/test/5_0.txt", "<p>good</p>")
    _write(f"{data}/test/6_0.txt", "<p>bad</p>")
    _write(f"{scratch}/lex.txt", "a 1 0.75 0 good#1\na 2 0 0.5 bad#1\n")
    tags = spark.createDataFrame([("good", "JJ"), ("bad", "JJ"), ("film", "NN"), ("fun", "NN"),
                                  ("plot", "NN"), ("a", "DT"), ("not", "DT"), (",", "."), (".", ".")],
                                 "token string, tag string")
    out = f"{scratch}/processed"
    dis = jobs.preprocess_files(spark, [f"{data}/train/pos", f"{data}/train/neg", f"{data}/test"],
                                f"{scratch}/lex.txt", tags, out).first()
    # the negative review "Not good. A bad film": 'good' negated -> neg 0.75 + 0.5, no disagreement
    assert (dis.pos_but_neg, dis.neg_but_pos) == (0, 0)
    scored = spark.read.json(out)
    assert scored.count() == 6
    neg3 = scored.filter(F.col("id") == "3_1").first()
    assert (neg3.pos_score, neg3.neg_score, neg3.text) == (0.0, 1.25, "good bad film ")

    for method in ("bayes", "centroid", "knn:cos", "knn:majority"):
        res = f"{scratch}/pred_{method.replace(':', '_')}"
        jobs.classify_files(spark, [f"{out}/label=pos", f"{out}/label=neg"], f"{out}/label=test",
                            res, method)
        lines = _read_lines(res)
        assert [l.split()[0] for l in lines] == ["5_0", "6_0"], method
    assert _read_lines(f"{scratch}/pred_bayes") == ["5_0 1", "6_0 0"]


def test_command_line_flow(spark, scratch, capsys):
    from reviewlens.__main__ import main
    data = f"{scratch}/data"
    for i, (cls, text) in enumerate([("pos", "<p>A good, good film</p>"), ("pos", "<p>Good fun</p>"),
                                     ("pos", "<p>good plot, good cast</p>"),
                                     ("neg", "<p>Not good. A bad film</p>"), ("neg", "<p>bad plot</p>"),
                                     ("neg", "<p>bad, bad acting</p>")]):
        _write(f"{data}/train/{cls}/{i}_1.txt", text)
    _write(f"{data}/test/7_0.txt", "<p>good</p>")
    _write(f"{data}/test/8_0.txt", "<p>bad</p>")
    _write(f"{scratch}/lex.txt", "a 1 0.75 0 good#1\na 2 0 0.5 bad#1\n")
    _write(f"{scratch}/tags.csv", "token,tag\ngood,JJ\nbad,JJ\nfilm,NN\nfun,NN\nplot,NN\ncast,NN\n"
                                  "acting,NN\na,DT\nnot,DT\n\",\",.\n.,.\n")
    out = f"{scratch}/processed"
    assert main(["preprocess", "--reviews", f"{data}/train/pos", f"{data}/train/neg", f"{data}/test",
                 "--lexicon", f"{scratch}/lex.txt", "--tags", f"{scratch}/tags.csv", "--out", out],
                spark) == 0
    train = [f"{out}/label=pos", f"{out}/label=neg"]
    # class means: for "good" the negative weight and mean are both 0, so the negative
    # similarity is 0/0 (undefined -> negative); "bad" is unseen in the positive class
    want = {"bayes": ["7_0 1", "8_0 0"], "centroid": ["7_0 0", "8_0 0"],
            "knn": ["7_0 1", "8_0 0"]}
    for cmd in (["bayes"], ["centroid"], ["knn", "--k", "3", "--rule", "majority"]):
        res = f"{scratch}/res_{cmd[0]}"
        assert main(cmd[:1] + ["--train", *train, "--test", f"{out}/label=test", "--out", res]
                    + cmd[1:], spark) == 0
        assert _read_lines(res) == want[cmd[0]], cmd
    assert main(["evaluate", "--train", *train, "--method", "bayes"], spark) == 0
    assert "accuracy" in capsys.readouterr().out
    assert main(["sweep", "--train", *train, "--out", f"{scratch}/sweep", "--k-max", "3",
                 "--seed", "1"], spark) == 0
    lines = _read_lines(f"{scratch}/sweep")
    assert [l.split()[0] for l in lines] == ["1", "2", "3"]
    assert all(len(l.split()) == 4 for l in lines)
