"""Corrections and review progress of transcripts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_fields(rows: DataFrame, required: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])


def edit_summary(edited: DataFrame, original: DataFrame, key: str = "doc_id", mode: str = "id") -> DataFrame:
    """Changes per transcript: speaker, text, either, and rows without an original (split pieces).

    mode 'id' pairs by segment id; 'zip' pairs by position.
    """
    if mode == "zip":
        order = Window.partitionBy(key).orderBy("id")
        edited, original = (d.withColumn("id", F.row_number().over(order)) for d in (edited, original))
    old = original.select(key, "id", F.col("speaker").alias("_speaker"), F.col("text").alias("_text"), F.lit(True).alias("_known"))
    joined = edited.join(old, [key, "id"], "left")
    speaker, text = F.coalesce(F.col("speaker") != F.col("_speaker"), F.lit(False)), F.coalesce(F.col("text") != F.col("_text"), F.lit(False))
    return joined.groupBy(key).agg(
        F.count_if(speaker).alias("speaker_changes"), F.count_if(text).alias("text_changes"), F.count_if(speaker | text).alias("modified"), F.count_if(F.col("_known").isNull()).alias("splits"))


def split_segments(segments: DataFrame, after: list[int], least_words: int, key: str = "doc_id") -> DataFrame:
    """Pieces of the segments with enough words, cut after the given numbers of words. The first piece keeps its id, the
    others follow the transcript's largest id; start and end share the time by words."""
    last = segments.groupBy(key).agg(F.max("id").alias("_last"))
    s = segments.withColumn("_w", F.split("text", " ")).filter(F.size("_w") >= least_words).join(last, key)
    s = s.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy("id")) - 1)
    cuts = F.array(*[F.struct(F.lit(a).alias("a"), (F.size("_w") if b is None else F.lit(b)).alias("b")) for a, b in zip([0, *after], [*after, None], strict=True)])
    p = s.select(key, F.col("id").alias("from_id"), "start", "end", "_w", "_last", "_k", F.posexplode(cuts).alias("piece", "c"))
    n, length = F.size("_w"), F.col("end") - F.col("start")
    return p.select(
        key, "from_id", F.col("piece").cast("long").alias("piece"), F.when(F.col("piece") == 0, F.col("from_id")).otherwise(F.col("_last") + len(after) * F.col("_k") + F.col("piece")).alias("id"),
        F.round(F.col("start") + length * F.col("c.a") / n, 6).alias("start"), F.round(F.col("start") + length * F.col("c.b") / n, 6).alias("end"),
        F.array_join(F.slice("_w", F.col("c.a") + 1, F.col("c.b") - F.col("c.a")), " ").alias("text"))


def progress(log: DataFrame) -> DataFrame:
    """(slug, reviewed, coverage) of log(slug, segment_id, total); a missing or zero total counts as 1."""
    total = F.coalesce(F.nullif(F.max("total"), F.lit(0)), F.lit(1))
    return log.groupBy("slug").agg(F.count_distinct("segment_id").alias("reviewed"), F.round(F.count_distinct("segment_id") / total, 6).alias("coverage"))


def sessions(log: DataFrame, keep: int) -> DataFrame:
    """New and cumulative distinct segments of each review session; the last `keep` sessions of each slug."""
    first = log.groupBy("slug", "segment_id").agg(F.min("session").alias("session")).groupBy("slug", "session").agg(F.count(F.lit(1)).alias("fresh"))
    all_ = log.select("slug", "session").distinct().join(first, ["slug", "session"], "left").withColumn("fresh", F.coalesce("fresh", F.lit(0)))
    order = Window.partitionBy("slug").orderBy("session")
    ranked = all_.withColumns({"reviewed": F.sum("fresh").over(order), "_r": F.row_number().over(Window.partitionBy("slug").orderBy(F.desc("session")))})
    return ranked.filter(F.col("_r") <= keep).drop("_r")
