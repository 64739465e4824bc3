"""File readers: raw reviews, scored-JSON reviews, sentiment lexicon files.

All readers are lazy DataFrame scans; file name, path and place come from the
``_metadata`` column, so no driver-side directory listing loop is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.functions import text as T

# Fields of a scored review; all are read as text, so that a bad score does not
# take its review along.
REVIEW_FIELDS = ("text", "pos_score", "neg_score", "id", "source")


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_raw_reviews(spark: SparkSession, paths) -> DataFrame:
    """path, id, label, raw: one row per review file (UTF-8, whole file).

    ``id`` is the file's base name up to its first '.', ``label`` the parent
    directory when it is 'pos' or 'neg'."""
    df = spark.read.text(_paths(paths), wholetext=True)
    path = F.col("_metadata.file_path")
    return df.select(path.alias("path"), T.id_from_path(path).alias("id"),
                     T.label_from_path(path).alias("label"), F.col("value").alias("raw"))


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """path, place, line of text files; (path, place) is the order of the lines:
    a split's first byte in its file, then the line's place in the split."""
    df = spark.read.text(_paths(paths))
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select(F.col("_metadata.file_path").alias("path"), place.alias("place"), F.col("value").alias("line"))


def _parsed(line: Column | str) -> Column:
    fields = ", ".join(f"{f} string" for f in REVIEW_FIELDS)
    return F.from_json(line, f"{fields}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})


def _objects(spark: SparkSession, paths, strict: bool) -> DataFrame:
    """path, r (the parsed review), bad (no object) of every object of the files
    (where ``kept``).

    The layout is decided file by file.  A file whose first line is an object
    is JSON lines; any other is one object over all its lines, put together in
    their order.  Lenient: where that is no object either, the file's lines
    count for themselves."""
    rows = read_lines(spark, paths).filter(F.col("line").rlike(r"\S"))
    rows = rows.select("path", "place", "line", _parsed("line").alias("r"))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    rows = rows.withColumn("bad", bad)
    # a narrow row for each file that has a line which is no object
    files = rows.groupBy("path").agg(F.min_by("bad", "place").alias("whole"), F.count_if("bad").alias("n_bad")).filter("n_bad > 0")
    spread = files.filter("whole").select("path", "whole")
    # an outer join and ``kept`` in place of an anti join, below which a reader's check could be pushed
    lines = rows.join(spread, "path", "left").select("path", "r", "bad", F.col("whole").isNull().alias("kept"))
    wholes = (rows.join(spread, "path", "left_semi").groupBy("path")
              .agg(F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"))  # the lines of one file
              .select("path", _parsed(F.array_join(F.col("lines.line"), "\n")).alias("r"))
              .withColumn("bad", bad).withColumn("kept", F.lit(True)))
    found = lines.unionByName(wholes)
    if not strict:
        broken = wholes.filter("bad").select("path")
        found = found.unionByName(rows.join(broken, "path", "left_semi").select("path", "r", "bad", F.lit(True).alias("kept")))
    return found


def read_scored_reviews(spark: SparkSession, paths, strict: bool = True,
                        limit: int | None = None) -> DataFrame:
    """path, id, label, text, pos_score, neg_score from scored-JSON reviews:
    one JSON object per file (over any number of lines), or JSON lines as
    written by ``write_scored_reviews``, side by side (an optional ``id`` field
    overrides the file name, an optional ``source`` field the path;
    ``label=pos`` folders count as class folders).

    ``strict=True``: a broken object, a missing ``text`` or a score that is
    missing or no number raises when rows are computed, whichever columns are
    selected.  ``strict=False``: broken objects and those without ``text`` are
    skipped, each alone; a score that is missing or no number is 0.0.
    ``limit``: the first ``limit`` reviews by (path, id) (None = all).

    A file that is one object is put together in one task, so it has to fit
    there; JSON lines may be of any size."""
    df = _objects(spark, paths, strict)
    path, text = F.col("path"), F.col("r.text")
    scores = {c: F.col(f"r.{c}").try_cast("double") for c in ("pos_score", "neg_score")}
    if strict:
        broken = F.raise_error(F.concat(F.lit("no review object in "), path)).cast("boolean")
        missing = text.isNull() | scores["pos_score"].isNull() | scores["neg_score"].isNull()
        incomplete = F.raise_error(F.concat(F.lit("review without text or score: "), path)).cast("boolean")
        df = df.filter(F.when(~F.col("kept"), F.lit(False)).when(F.col("bad"), broken).when(missing, incomplete).otherwise(F.lit(True)))
    else:
        df = df.filter(F.col("kept") & ~F.col("bad") & text.isNotNull())
    out = df.select(F.coalesce("r.source", path).alias("path"), F.coalesce("r.id", T.id_from_path(path)).alias("id"),
                    T.label_from_path(path).alias("label"), text.alias("text"),
                    *[F.coalesce(s, F.lit(0.0)).alias(c) for c, s in scores.items()])
    if limit is not None:
        out = out.orderBy("path", "id").limit(limit)
    return out


def unread(reviews: DataFrame, used: DataFrame, by_name_only: bool = False) -> DataFrame:
    """The reviews (id, label) that ``used`` (id, label) does not have: by class
    and name, or, as one flat list of names would, by the name alone."""
    keys = ["id"] if by_name_only else ["label", "id"]
    return reviews.join(used.select(*keys).distinct(), keys, "left_anti")


def read_heldout(spark: SparkSession, paths, label: str, used: DataFrame,
                 by_name_only: bool = False, limit: int | None = None) -> DataFrame:
    """path, id, text, label of reviews whose files were not read before
    (``used``: id, label of those that were), tagged with ``label``; ``limit``
    counts reviews that are left after the exclusion, in order of (path, id).
    Broken files are skipped and do not count."""
    r = read_scored_reviews(spark, paths, strict=False).withColumn("label", F.lit(label))
    left = unread(r, used, by_name_only).select("path", "id", "text", "label")
    return left if limit is None else left.orderBy("path", "id").limit(limit)


def read_lexicon(spark: SparkSession, path) -> DataFrame:
    """line_no, line of one or more sentiment lexicon text files (or folders).

    ``line_no`` is a comparable place (file, split, line), which is what
    "first line wins" needs."""
    return read_lines(spark, path).select(F.struct("path", "place").alias("line_no"), "line")
