"""A curated store: posts in a folder per author tier, snapshots of counts, a log of queries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from threadloom.operators.quality import coverage_delta
from threadloom.sources.scratch import materialize


def write_tiers(posts: DataFrame, target: str, by: str = "tier", rows_per_file: int = 1_000_000) -> None:
    """Write posts into the folders of their tiers; only folders of tiers in `posts` are replaced. Tasks write what they hold, so a
    tier with most of the rows takes many tasks and files. A null tier gets a folder of its own."""
    live = posts if "_live" in posts.columns else posts.withColumn("_live", F.lit(True))
    live.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file).partitionBy(by).parquet(target)


def read_tiers(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """Posts of the store with the columns of `schema`; empty before the first write. A filter on the tier, or a join with a small
    table of tiers, reads the folders of those tiers only."""
    kept = StructType([*schema.fields, StructField("_live", BooleanType())])
    try:
        return spark.read.schema(kept).parquet(target).filter("_live").drop("_live")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def upsert_posts(changes: DataFrame, target: str, key: str = "post_id", by: str = "tier") -> list:
    """Put changed posts, one row per key, into the store; the result are the tiers whose folders were rewritten.

    Those are the tiers that hold a changed key and those that get one: a post that changes its tier leaves the old folder. Finding
    the keys reads two columns. Each rewritten folder gets a row that is not live, so a tier that lost all posts is replaced too.
    """
    spark, schema = changes.sparkSession, changes.schema
    fresh = materialize(changes)
    old = read_tiers(spark, target, schema)
    held = old.select(key, by).join(fresh.select(key), key, "left_semi").select(by)
    touched = held.union(fresh.select(by)).distinct()
    tiers = [r[0] for r in touched.collect()]  # as many as there are tiers
    if tiers:
        wanted = F.col(by).isin([t for t in tiers if t is not None])
        there = old.filter(wanted | F.col(by).isNull() if None in tiers else wanted)
        merged = there.join(fresh.select(key), key, "left_anti").select(schema.names).unionByName(fresh).withColumn("_live", F.lit(True))
        marks = spark.createDataFrame([(t, False) for t in tiers], StructType([schema[by], StructField("_live", BooleanType())]))
        write_tiers(materialize(merged.unionByName(marks, allowMissingColumns=True)), target, by)
    return tiers


def save_snapshot(counts: DataFrame, target: str, at: int | None = None) -> None:
    """Store counts as the snapshot of time `at` (whole seconds), or several at once by a column `snapshot`. Saving again replaces it."""
    rows = counts if at is None else counts.withColumn("snapshot", F.lit(at).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot").parquet(target)


def previous_snapshot(spark: SparkSession, target: str, now: int, schema: str) -> DataFrame:
    """The latest snapshot before `now`; no rows without one. Its time comes from the folders' names, then one folder is read."""
    try:
        rows = spark.read.schema(f"{schema}, snapshot long").parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, snapshot long")
    last = rows.filter(F.col("snapshot") < now).agg(F.max("snapshot")).first()[0]
    return rows.filter(F.lit(False) if last is None else F.col("snapshot") == last)


def snapshot_change(now: DataFrame, target: str, at: int, schema: str) -> DataFrame:
    """(forum_slug, delta, is_new) of counts(forum_slug, topics_scraped) against the snapshot before `at`."""
    return coverage_delta(now, previous_snapshot(now.sparkSession, target, at, schema).drop("snapshot"))


def append_log(log: DataFrame, target: str, at: str = "ts") -> None:
    """Add queries to the log, a folder a day; entries are never rewritten."""
    log.withColumn("day", F.to_date(at)).write.mode("append").partitionBy("day").parquet(target)


def read_log(spark: SparkSession, target: str, schema: str, since: str | None = None) -> DataFrame:
    """Log entries, of days from `since` on."""
    rows = spark.read.schema(f"{schema}, day date").parquet(target)
    return rows if since is None else rows.filter(F.col("day") >= F.lit(since).cast("date"))
