"""Queries that drain a stream and return its final state, each the same as its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.sources.scratch import scratch
from threadloom.streaming import jobs
from threadloom.streaming.refresh import items, keyed_state, refreshes

QUERIES, ORACLE_SQL = {}, {}
EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _events(spark, sf_dir, files_per_trigger=1):
    return jobs.read_stream(spark, EVENTS, f"{sf_dir}/events.parquet*", files_per_trigger=files_per_trigger)


def _final(df, spark, mode):
    return jobs.run_to_table(df, spark, scratch(spark), mode, scratch(spark))


@query("SELECT topic_id, count(*) AS accesses FROM (SELECT user_id % 40 AS topic_id FROM events) GROUP BY topic_id")
def stream_access_counts(spark, sf_dir):
    log = _events(spark, sf_dir).select((F.col("user_id") % 40).alias("topic_id"))
    return _final(jobs.access_counts(log), spark, "complete")


@query("SELECT user_id AS slug, count(DISTINCT (props::JSON ->> '$.k')::BIGINT) AS reviewed FROM events GROUP BY user_id")
def stream_review(spark, sf_dir):
    log = _events(spark, sf_dir).selectExpr("user_id as slug", "cast(get_json_object(props, '$.k') as bigint) as segment_id", "ts")
    return _final(jobs.review_counts(log), spark, "complete")


@query("SELECT user_id, md5(max_by(event_type, event_id)) AS content_hash, max(event_id) AS event_id FROM events GROUP BY user_id")
def stream_upsert(spark, sf_dir):
    path = scratch(spark)
    updates = _events(spark, sf_dir).select("user_id", F.md5(F.col("event_type").cast("binary")).alias("content_hash"), "event_id")
    q = jobs.upsert_stream(updates, f"{path}/table", f"{path}/checkpoint", "user_id", "event_id")
    q.awaitTermination()
    return jobs.read_upserted(spark, f"{path}/table", updates.schema).drop("_bucket")


@query("SELECT user_id AS episode_id, max_by(event_id, (ts, event_id)) AS run_id FROM events WHERE event_type <> 'error' GROUP BY user_id")
def stream_manifests(spark, sf_dir):
    """Runs as they come in; the last good run of an episode is its canonical one."""
    path = scratch(spark)
    runs = _events(spark, sf_dir).filter("event_type <> 'error'").select(F.col("user_id").alias("episode_id"), F.col("event_id").alias("run_id"), F.struct("ts", "event_id").alias("created_at"))
    jobs.canonical_runs(runs, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return jobs.read_upserted(spark, f"{path}/table", runs.schema).select("episode_id", "run_id")


@query("""
    WITH e AS (SELECT (user_id % 500)::VARCHAR AS key, epoch_ms(ts) AS t, event_id, event_type FROM events),
    f AS (SELECT *, CASE WHEN t - lag(t) OVER w < 3600000 THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY key ORDER BY t, event_id)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY key ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS burst FROM f),
    b AS (SELECT key, burst, count(*) AS changes, max(t) AS t, arg_max(event_type, (t, event_id)) AS value FROM s GROUP BY ALL),
    c AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY t DESC) AS r FROM b WHERE t + 3600000 <= (SELECT max(t) - 600000 FROM e))
    SELECT key, value, changes, t AS "at" FROM c WHERE r = 1 AND value <> 'error'""")
def stream_refresh(spark, sf_dir):
    """Items after debounced changes of one hour's gap; an error takes an item out. Bursts that the watermark has not closed wait.

    Times count in whole milliseconds, rounded as the SQL's epoch_ms rounds. The files of the table are in no order of time, so they make one
    batch: by file, the changes of a later one would fall behind the watermark of the first.
    """
    changes = _events(spark, sf_dir, files_per_trigger=None).selectExpr(
        "cast(user_id % 500 as string) as key", "timestamp_millis(cast(round(unix_micros(ts) / 1000) as bigint)) as ts", "event_id as seq", "event_type = 'error' as gone", "event_type as value")
    with keyed_state(spark):
        return items(_final(refreshes(changes, "1 hour"), spark, "append"))


@query("""
    WITH e AS (SELECT user_id % 5 AS slug, ts, value, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id % 5 ORDER BY ts, event_id) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY slug ORDER BY ts, event_id) AS burst FROM e)
    SELECT slug, count(*) AS bursts, sum(n)::BIGINT AS changes FROM (SELECT slug, burst, count(*) AS n FROM s GROUP BY ALL) GROUP BY slug""")
def stream_debounce(spark, sf_dir):
    """Bursts of changes an hour apart; complete mode shows those that are still open too."""
    log = _events(spark, sf_dir).selectExpr("user_id % 5 as slug", "ts", "value")
    bursts = _final(jobs.debounced(log, "slug", gap="1 hour"), spark, "complete")
    return bursts.groupBy("slug").agg(F.count(F.lit(1)).alias("bursts"), F.sum("changes").alias("changes"))
