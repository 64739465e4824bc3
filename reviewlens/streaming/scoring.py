"""Micro-batch scoring of reviews as they arrive.

A directory of scored-JSON reviews is read as a file stream.  The naive-Bayes
model (word, lp_pos, lp_neg) is fitted once by a batch job and written as a
table; every micro-batch is a bounded DataFrame that is joined with that
table and written to ``<output>/batch_id=<n>``.  Re-running a batch after a
failure overwrites the same folder, so the sink stays exactly-once together
with the stream's checkpoint.  No state is kept between batches: each review
is scored on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewlens.functions import text as T
from reviewlens.operators import bayes
from reviewlens.sources.files import REVIEW_FIELDS


def fit_bayes_model(train: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the model table (word, lp_pos, lp_neg, df_pos, df_neg)."""
    bayes.word_log_probs(train).write.mode(mode).parquet(path)


def start_bayes_scoring(spark: SparkSession, input_dir: str, model_path: str, output_dir: str,
                        checkpoint: str, available_now: bool = True,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream ``input_dir`` -> predictions (id, doc_id, prediction) under
    ``output_dir``.  ``checkpoint`` must be a shared folder on a cluster."""
    reader = spark.readStream.schema(", ".join(f"{f} string" for f in REVIEW_FIELDS)).option("mode", "DROPMALFORMED")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.json(input_dir)
    path = F.col("_metadata.file_path")
    reviews = (src.filter(F.col("text").isNotNull())
               .select(F.coalesce("id", T.id_from_path(path)).alias("id"),
                       F.xxhash64(path, "id").alias("doc_id"), "text"))

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        model = batch.sparkSession.read.parquet(model_path)
        pred = bayes.decide(bayes.scores_from_model(model, batch.select("doc_id", "text")))
        (pred.join(batch.select("doc_id", "id"), "doc_id")
         .write.mode("overwrite").parquet(f"{output_dir}/batch_id={batch_id}"))

    w = reviews.writeStream.foreachBatch(score_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
