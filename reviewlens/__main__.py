"""Command line: ``spark-submit -m reviewlens <command> ...`` or
``python -m reviewlens <command> ...``.

Commands mirror the original programs:

  preprocess  raw review folders + lexicon file + tag table -> scored-JSON dataset
  bayes       scored-JSON train/test folders -> sorted 'id 0|1' lines
  knn         same, top-K neighbours (--k, --rule cos|majority|sentiment)
  centroid    same, class-mean vectors
  evaluate    hold-out evaluation of labelled folders (--method bayes|centroid)
  sweep       K = k_min..k_max accuracy report for the three vote rules

The session comes from the environment (spark-submit / cluster config); the
checkpoint folder is read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="reviewlens")
    sub = p.add_subparsers(dest="cmd", required=True)

    pre = sub.add_parser("preprocess")
    pre.add_argument("--reviews", nargs="+", required=True, help="folders of raw review files")
    pre.add_argument("--lexicon", required=True, help="sentiment lexicon text file")
    pre.add_argument("--tags", required=True, help="tag table: CSV with columns token,tag")
    pre.add_argument("--out", required=True)

    for name in ("bayes", "knn", "centroid"):
        c = sub.add_parser(name)
        c.add_argument("--train", nargs="+", required=True, help="labelled scored-JSON folders")
        c.add_argument("--test", nargs="+", required=True, help="scored-JSON folders to classify")
        c.add_argument("--out", required=True)
        if name == "knn":
            c.add_argument("--k", type=int, default=61)
            c.add_argument("--rule", default="cos", choices=["cos", "majority", "sentiment"])
        if name == "centroid":
            c.add_argument("--numbered", action="store_true", help="'00000 0|1' lines of all readable files")
            c.add_argument("--n-train", type=int, help="with --numbered: reviews of each class to read")

    pr = sub.add_parser("precision", help="class means of the first files against files not read")
    pr.add_argument("--pos", nargs="+", required=True)
    pr.add_argument("--neg", nargs="+", required=True)
    pr.add_argument("--n-train", type=int)
    pr.add_argument("--n-test", type=int)

    ev = sub.add_parser("evaluate")
    ev.add_argument("--train", nargs="+", required=True)
    ev.add_argument("--method", default="bayes", choices=["bayes", "centroid"])
    ev.add_argument("--seed", type=int, default=42)

    sw = sub.add_parser("sweep")
    sw.add_argument("--train", nargs="+", required=True)
    sw.add_argument("--out", required=True)
    sw.add_argument("--k-min", type=int, default=1)
    sw.add_argument("--k-max", type=int, default=200)
    sw.add_argument("--seed", type=int, default=42)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = build_parser().parse_args(argv)
    from reviewlens.plans import jobs
    from reviewlens.session import checkpoint_dir

    spark = spark or SparkSession.builder.appName(f"reviewlens-{args.cmd}").getOrCreate()
    checkpoint_dir(spark)
    if args.cmd == "preprocess":
        tags = spark.read.option("header", True).csv(args.tags).select("token", "tag")
        counters = jobs.preprocess_files(spark, args.reviews, args.lexicon, tags, args.out).first()
        print(f"Negative reviews with positive score: {counters.pos_but_neg}")
        print(f"Positive reviews with negative score: {counters.neg_but_pos}")
    elif args.cmd == "centroid" and args.numbered:
        jobs.number_files(spark, args.train, args.test, args.out, args.n_train)
    elif args.cmd == "precision":
        for k, v in jobs.precision_files(spark, args.pos, args.neg, args.n_train, args.n_test).first().asDict().items():
            print(f"{k}: {v}")
    elif args.cmd in ("bayes", "centroid"):
        jobs.classify_files(spark, args.train, args.test, args.out, args.cmd)
    elif args.cmd == "knn":
        from reviewlens.operators import neighbors
        from reviewlens.sinks import writers
        train = jobs._scored_corpus(spark, args.train)
        test = jobs._scored_corpus(spark, args.test)
        pred = neighbors.knn_predict(train, test, args.k, args.rule,
                                     test.select("doc_id", "pos_score", "neg_score"))
        writers.write_prediction_lines(pred.join(test.select("doc_id", "id"), "doc_id"), args.out)
    elif args.cmd == "evaluate":
        for k, v in jobs.evaluate_files(spark, args.train, args.method, args.seed).first().asDict().items():
            print(f"{k}: {v}")
    elif args.cmd == "sweep":
        jobs.sweep_files(spark, args.train, args.out, args.k_min, args.k_max, args.seed)
    return 0


if __name__ == "__main__":
    sys.exit(main())
