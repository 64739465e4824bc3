"""Streaming scoring equals the batch prediction on the same reviews."""

import json
import os

from reviewlens.operators import bayes
from reviewlens.sources import tables
from reviewlens.streaming import scoring


def test_stream_scoring_matches_batch(spark, sf_dir, scratch):
    lab = tables.labelled(spark, sf_dir)
    unl = tables.unlabelled(spark, sf_dir)
    rows = unl.orderBy("doc_id").collect()
    inp = f"{scratch}/incoming"
    os.makedirs(inp)
    for r in rows:  # one scored-JSON file per review, as the preprocessing job writes
        with open(f"{inp}/{r.doc_id}.json", "w", encoding="utf8") as f:
            f.write(json.dumps({"text": r.text, "pos_score": 0, "neg_score": 0}))
    scoring.fit_bayes_model(lab, f"{scratch}/model")
    q = scoring.start_bayes_scoring(spark, inp, f"{scratch}/model", f"{scratch}/out",
                                    f"{scratch}/ckpt", max_files_per_trigger=40)
    q.awaitTermination(300)
    got = {int(r.id): r.prediction for r in spark.read.parquet(f"{scratch}/out").collect()}
    want = {r.doc_id: r.prediction for r in bayes.bayes_predict(lab, unl).collect()}
    assert got == want
    batches = [d for d in os.listdir(f"{scratch}/out") if d.startswith("batch_id=")]
    assert len(batches) >= 2
