"""Structured Streaming forms of refresh, access counts, review progress and debounced updates.

Jobs take a streaming DataFrame and a target folder, use the caller's checkpoint folder, and end with availableNow where
the caller wants a bounded run. State is bounded by watermarks, or by keys that the model bounds (topics, review segments).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from threadloom.sources.scratch import materialize
from threadloom.sources.sinks import changed_only, upsert_leaves


def read_stream(spark: SparkSession, schema: str, path: str, kind: str = "parquet", files_per_trigger: int | None = 1) -> DataFrame:
    """A stream of files, so many a batch (None: all that are there). Lines of text formats that don't parse are passed over."""
    reader = spark.readStream.schema(schema).option("mode", "DROPMALFORMED").format(kind)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).load(path)


def read_upserted(spark: SparkSession, target: str, schema) -> DataFrame:
    """The table that upsert_stream keeps; empty before its first batch."""
    kept = StructType([*schema.fields, StructField("_bucket", IntegerType())])
    try:
        return spark.read.schema(kept).parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kept)


def upsert_stream(updates: DataFrame, target: str, checkpoint: str, key: str, version: str, content_hash: str | None = "content_hash", buckets: int = 16):
    """Each batch writes its latest rows of changed keys into the table at target, which is partitioned by a hash of the key.

    Rows whose content_hash is known are passed over (with None, none is). Only the buckets of changed rows are read and written again. A
    batch that runs again after a failure meets its own rows, which win or tie by version, so its result is the same.
    """
    def merge(batch: DataFrame, n: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        fresh = upsert_leaves(None, batch, [key], version).withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets)))
        old = read_upserted(spark, target, schema)
        if content_hash:
            fresh = changed_only(old, fresh, key, content_hash)
        fresh = materialize(fresh)
        touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]  # at most `buckets`
        if touched:
            merged = materialize(upsert_leaves(old.filter(F.col("_bucket").isin(touched)), fresh, [key], version))
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(target)

    return updates.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def canonical_runs(manifests: DataFrame, target: str, checkpoint: str):
    """A stream of run manifests(episode_id, run_id, created_at, ...): the run that came last becomes an episode's canonical one."""
    return upsert_stream(manifests, target, checkpoint, "episode_id", "created_at", content_hash=None)


def access_counts(log: DataFrame, key: str = "topic_id") -> DataFrame:
    """Live counts per topic, for update mode."""
    return log.groupBy(key).agg(F.count(F.lit(1)).alias("accesses"))


def review_counts(log: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Distinct reviewed segments per transcript: repeats of a (slug, segment) drop out by state, counts run on."""
    return log.withWatermark("ts", late).dropDuplicates(["slug", "segment_id"]).groupBy("slug").agg(F.count(F.lit(1)).alias("reviewed"))


def debounced(log: DataFrame, key: str, gap: str = "2 seconds", late: str = "10 minutes") -> DataFrame:
    """One row for each burst of changes of a key, with its last value: session windows closed by the watermark."""
    return log.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count(F.lit(1)).alias("changes"), F.max_by("value", "ts").alias("value"))


def run_to_table(df: DataFrame, spark: SparkSession, path: str, mode: str, checkpoint: str) -> DataFrame:
    """Drain a bounded stream and return its result, written by each batch as a generation under path; with mode 'complete' the
    last one is whole. Nothing passes through the driver."""
    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/gen={n}")

    df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    kept = StructType([*df.schema.fields, StructField("gen", LongType())])
    try:
        rows = spark.read.schema(kept).parquet(path)
    except AnalysisException as e:  # no batch, no result
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], df.schema)
    if mode == "complete":
        rows = rows.filter(F.col("gen") == rows.agg(F.max("gen")).first()[0])
    return rows.drop("gen")


def to_parquet(df: DataFrame, path: str, checkpoint: str):
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
