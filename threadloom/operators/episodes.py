"""Episodes assembled from their parts: metadata, run manifests, reports of runs, chapters, review."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import parse_episode_dir, plain_title, seconds_of


def _first(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key: the least of its rows, for parts that should be unique and are not."""
    return rows.groupBy(*keys).agg(F.min(F.struct(*values)).alias("_v")).select(*keys, "_v.*")


def _or(value: Column, other: Column) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), other)


def assemble_episodes(metadata: DataFrame, manifests: DataFrame, reports: DataFrame, chapters: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per episode that has metadata, with the fields of an index item and of an episode's page.

    metadata: slug, title, pub_date_iso, itunes_season, itunes_episode, itunes_duration, description_html, itunes_image, audio_seconds;
    manifests: slug, canonical, canonical_run_id, runs (an array of run ids); reports: slug, run_id, success, chapters_generated,
    word_count, speakers_detected; chapters: slug, run_id, topics, films (arrays); reviews: slug, coverage, of episodes with corrected
    transcripts. All joins are by slug, or slug and run, from the left.

    The canonical run is `canonical`, else `canonical_run_id`; stats are null unless its report tells success, and hold the sorted union of
    its chapters' topics and films. Season, episode and date come from the slug where metadata has none (0 counts as none). Repeated
    parts: the least row counts. Empty tables give no stats, no transcript and no review.
    """
    season, episode, date, _ = parse_episode_dir(F.col("slug"))
    canonical = manifests.groupBy("slug").agg(F.min(F.struct(_or(F.col("canonical"), F.nullif("canonical_run_id", F.lit(""))).alias("run_id"), F.col("runs").alias("allRunIds"))).alias("_m")).select("slug", "_m.*")
    done = _first(reports.filter("success"), ["slug", "run_id"], ["chapters_generated", "word_count", "speakers_detected"]).withColumn("_done", F.lit(True))
    # Names are made distinct before they meet, so an episode of many chapters ships each name once.
    names = lambda c: chapters.select("slug", "run_id", F.explode(c).alias("n")).distinct().groupBy("slug", "run_id").agg(F.array_sort(F.collect_list("n")).alias(c))
    review = reviews.groupBy("slug").agg(F.max("coverage").alias("_coverage")).withColumn("_goal", F.lit(True))
    joined = _first(metadata, ["slug"], [c for c in metadata.columns if c != "slug"]).join(canonical, "slug", "left")
    for part in (done, names("topics"), names("films")):
        joined = joined.join(part, ["slug", "run_id"], "left")
    joined = joined.join(review, "slug", "left")
    none, zero = F.array().cast("array<string>"), lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0))
    stats = F.when(F.col("_done"), F.struct(
        zero("chapters_generated").alias("chapters"), zero("word_count").alias("words"), zero("speakers_detected").alias("speakers"), F.coalesce("topics", none).alias("topics"), F.coalesce("films", none).alias("films")))
    title = F.coalesce("title", "slug")
    number = lambda c, other: F.coalesce(F.nullif(F.col(c).cast("int"), F.lit(0)), other)
    lasting = seconds_of(F.col("itunes_duration"))
    return joined.select(
        "slug", _or(F.trim(plain_title(title)), title).alias("title"), F.coalesce("pub_date_iso", F.nullif(date, F.lit("")), F.lit("")).alias("pubDate"),
        number("itunes_season", season).alias("season"), number("itunes_episode", episode).alias("episode"), F.coalesce("itunes_duration", F.lit("")).alias("duration"),
        F.col("run_id").isNotNull().alias("hasTranscript"), F.col("run_id").alias("canonicalRunId"), F.coalesce("_goal", F.lit(False)).alias("hasGoal"),
        F.coalesce(F.col("_coverage").cast("double"), F.lit(0.0)).alias("reviewCoverage"), stats.alias("stats"), F.coalesce("description_html", F.lit("")).alias("descriptionHtml"),
        F.when(lasting > 0, lasting).otherwise(F.coalesce(F.floor("audio_seconds").cast("int"), F.lit(0))).alias("durationSeconds"), F.col("itunes_image").alias("imageUrl"), F.coalesce("allRunIds", none).alias("allRunIds"))
