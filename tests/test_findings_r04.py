"""Findings of the fourth review: the time of the neighbour search."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reviewlens.functions import text as T
from reviewlens.operators import neighbors


def _block(number, ids, lengths, postings, weights=None):
    """A row of the cells from postings {(item, code): count}."""
    n = len(ids)
    item, code, count = (np.array(x) for x in zip(*[(i, c, k) for (i, c), k in postings.items()]))
    by = np.argsort(item, kind="stable")
    rows = (np.array(ids), np.ones(n, bool), np.array(ids) % 2 == 0, np.array(lengths, float))
    size, data = neighbors._pack(rows, (item[by], code[by].astype(np.uint64), count[by]))
    row = {"block": number, "size": size, "data": data, "weights": None}
    if weights is not None:
        codes = sorted({c for _, c in postings})
        terms = pa.table({"code": pa.array(codes, pa.int64()), "weight": [weights[c] for c in codes]})
        row = neighbors._with_weights(pa.table({k: pa.array([v], pa.binary() if k == "data" else None) for k, v in row.items() if k != "weights"}), terms).to_pylist()[0]
    return {**row, "qpart": 0, "dpart": 0, "is_doc": weights is not None}


# F2 to F8: the pairs of a cell ----------------------------------------------------------

def test_pairs_are_added_to_few_rows_of_a_cell_at_a_time(monkeypatch):
    rng = np.random.default_rng(4)
    n_queries, n_docs, n_terms = 96, 80, 400
    weights = {c: 1.0 + c / 7 for c in range(n_terms)}
    draw = lambda n: {(i, int(c)): int(rng.integers(1, 4)) for i in range(n) for c in {*rng.integers(0, n_terms, 30), *rng.integers(0, 5, 4)}}
    queries, docs = draw(n_queries), draw(n_docs)
    lengths = [sum(k for (i, _), k in docs.items() if i == d) for d in range(n_docs)]
    rows = [_block(0, range(n_queries), [1] * n_queries, queries), *[
        _block(b, range(lo, lo + 40), lengths[lo:lo + 40], {(i - lo, c): k for (i, c), k in docs.items() if lo <= i < lo + 40}, weights) for b, lo in ((1, 0), (2, 40))]]
    reach, bincount = [], np.bincount

    def counted(x, weights=None, minlength=0):
        reach.append(minlength)
        return bincount(x, weights=weights, minlength=minlength)

    monkeypatch.setattr(np, "bincount", counted)
    batch = pa.Table.from_pylist(rows, pa.schema([("qpart", pa.int64()), ("dpart", pa.int64()), ("is_doc", pa.bool_()), ("block", pa.int64()), ("size", pa.int64()), ("data", pa.binary()), ("weights", pa.binary())]))
    want = {}
    for (q, c), k in queries.items():
        for d in range(n_docs):
            if (d, c) in docs:
                want[q, d] = want.get((q, d), 0.0) + k * weights[c] * math.sqrt(docs[d, c]) / math.sqrt(lengths[d])
    for dense_share in (1, 6, 1 << 20):
        for size in (1, 50, 1 << 20):
            reach.clear()
            out = pa.Table.from_batches(neighbors._cell_scores(None, size, dense_share, 3)([batch])).to_pylist()
            got = {(r["qid"], r["doc_id"]): r["score"] for r in out}
            assert got.keys() == want.keys() and len(out) == len(got)
            assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
            if size == 50:  # before: each step added to the whole cell
                assert all(x <= 40 * 50 for x in reach) and (dense_share == 1 << 20 or len(reach) > 20)
            best = pa.Table.from_batches(neighbors._cell_scores(7, size, dense_share, 3)([batch])).to_pylist()
            top = {}
            for r in best:
                top.setdefault(r["qid"], []).append((-round(r["score"], 9), r["doc_id"]))
            for q in range(n_queries):
                order = sorted((-round(s, 9), d) for (a, d), s in want.items() if a == q)[:7]
                assert [d for _, d in sorted(top[q])[:7]] == [d for _, d in order]


# The text of a query ------------------------------------------------------------

def test_normalized_text_of_every_character(spark):
    """A lower-cased text has no A-Z: leaving them out of the pattern keeps the same characters, in a tenth of the time."""
    chars = spark.range(1, 0x110000).filter("id not between 55296 and 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    x = chars.select(F.concat(F.lit("aZ "), "c", F.lit("Qİ")).alias("x"))
    got = x.select(T.normalize_query_text("x").alias("got"), F.regexp_replace(F.lower("x"), T.QUERY_DELETE, "").alias("want"))
    assert got.filter("got <> want").count() == 0 and got.filter("got = 'az kqi'").count() == 3
    assert T.QUERY_DELETE not in got.select("got")._jdf.queryExecution().optimizedPlan().toString()


# The votes of every K ---------------------------------------------------------------

def test_the_votes_of_every_k_take_one_search(spark):
    train = spark.createDataFrame([(1, "ant bee", "pos"), (2, "cat dog", "neg"), (3, "eel fox", "pos")], "doc_id long, text string, label string")
    test = spark.createDataFrame([(7, "bee fox"), (8, "gnu"), (8, "gnu"), (None, "cat"), (9, None)], "doc_id long, text string")
    steps = neighbors.vote_steps(neighbors.knn_hits(train, test, 4), test, 4)
    assert "MapInArrow" not in steps._jdf.queryExecution().executedPlan().toString()  # before: two, the search for the hits and again for those without
    rows = sorted((r.qid or 0, r.k_from, r.k_to, r.pos_hits) for r in steps.collect())
    assert rows == [(0, 1, 4, 0), (0, 1, 4, 0), (7, 1, 1, 1), (7, 2, 4, 2), (8, 1, 4, 0), (8, 1, 4, 0), (9, 1, 4, 0)]
