"""Writers for scored reviews, prediction lines and the K-sweep report.

Outputs are written by the executors as partitioned datasets; line files are
globally sorted by a range shuffle (part files in name order form the sorted
file), never funnelled through a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.functions import text as T


def write_scored_reviews(df: DataFrame, out: str, mode: str = "errorifexists") -> None:
    """Scored reviews as JSON objects {text, pos_score, neg_score, id, source}
    (source: the path of the raw review, which tells equal ids apart), partitioned by ``split`` and ``label`` when those columns exist."""
    parts = [c for c in ("split", "label") if c in df.columns]
    cols = [c for c in ("id", "source", "text", "pos_score", "neg_score") if c in df.columns]
    w = df.select(*cols, *parts).write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    w.json(out)


def prediction_lines(pred: DataFrame, id_col: str = "id", pred_col: str = "prediction") -> DataFrame:
    """line = '<id> <0|1>', ordered by id (string order)."""
    ident = F.col(id_col).cast("string")
    return (pred.select(ident.alias("_id"),
                        F.concat_ws(" ", ident, F.col(pred_col).cast("int").cast("string")).alias("line"))
            .orderBy("_id").select("line"))


def write_prediction_lines(pred: DataFrame, out: str, id_col: str = "id",
                           pred_col: str = "prediction", mode: str = "errorifexists") -> None:
    prediction_lines(pred, id_col, pred_col).write.mode(mode).text(out)


def write_numbered_lines(pred: DataFrame, out: str, seq_col: str = "seq", pred_col: str = "prediction",
                         mode: str = "errorifexists") -> None:
    """'<00000> <0|1>' lines in order of their number (0-based, five digits at
    least): the rows are range-partitioned by it, so the part files in name
    order form the sorted file."""
    line = F.concat_ws(" ", T.zero_padded(seq_col), F.col(pred_col).cast("int").cast("string"))
    pred.select(seq_col, line.alias("line")).orderBy(seq_col).select("line").write.mode(mode).text(out)


def sweep_lines(sweep: DataFrame) -> DataFrame:
    """line = 'K acc_knn acc_knn_sentiment acc_cos', ordered by K; an undefined
    accuracy (empty evaluation set) is written as NaN."""
    cols = [F.col("k").cast("string")] + [
        F.coalesce(F.col(c).cast("string"), F.lit("NaN"))
        for c in ("acc_knn", "acc_knn_sentiment", "acc_cos")]
    return sweep.orderBy("k").select(F.concat_ws(" ", *cols).alias("line"))


def write_sweep_report(sweep: DataFrame, out: str, mode: str = "errorifexists") -> None:
    sweep_lines(sweep).write.mode(mode).text(out)
