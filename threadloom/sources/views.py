"""Views that give the driver's tables the shapes of the corpus model, as DataFrames and as the SQL of the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as threaded posts: turn t replies to turn (t - 1) div 2; time advances by hours."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn",
        "concat(conv_id, '-', turn) as post_id", "cast(conv_id as string) as topic_slug", "concat('f', conv_id % 5) as forum_slug",
        "concat(role, '_', (conv_id * 3 + turn) % 7) as author", "role", "turn as position",
        "case when turn > 0 then concat(conv_id, '-', (turn - 1) div 2) end as parent_post_id",
        "timestamp_seconds(1704067200 + (conv_id * 7 + turn) * 3600) as ts", "text as content_text",
    )


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics with their ordered post ids, by one aggregation over posts."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("turn", "post_id"))), lambda s: s["post_id"])
    return posts(spark, sf_dir).groupBy("topic_slug", "forum_slug").agg(ordered.alias("post_ids"), (F.count(F.lit(1)) - 1).alias("reply_count"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return docs.select("doc_id", F.col("source").alias("forum_slug"), "lang", "text", "n_chars").join(labels, "doc_id", "left")


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as timed transcripts: sentences at 15 characters a second, a pause of 3 s before each fifth."""
    parts = table(spark, sf_dir, "documents").select("doc_id", F.split("text", r"\. ", -1).alias("p"))
    sizes = F.transform("p", lambda s: F.char_length(s))
    return timed(parts.select("doc_id", F.posexplode(F.arrays_zip(F.col("p").alias("text"), sizes.alias("n")))).select("doc_id", F.col("pos").cast("long").alias("id"), F.col("col.text").alias("text"), F.col("col.n").cast("long").alias("n")))


def timed(parts: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    before = F.coalesce(F.sum("n").over(Window.partitionBy("doc_id").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = before / F.lit(15.0) + 3 * F.floor(F.col("id") / 5)
    return parts.select("doc_id", "id", "text", F.concat(F.lit("S"), F.floor(F.col("id") / 3) % 3).alias("speaker"), start.alias("start"), (start + F.col("n") / F.lit(15.0)).alias("end"))


def access(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "user_id % 40 as topic_id", "event_type as query_name", "ts")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("user_id as slug", "cast(get_json_object(props, '$.k') as bigint) as segment_id", "cast(ts as date) as session")


#: The same views for the oracle.
SQL = {
    "v_posts": """SELECT conv_id, turn, conv_id::VARCHAR || '-' || turn::VARCHAR AS post_id, conv_id::VARCHAR AS topic_slug, 'f' || (conv_id % 5)::VARCHAR AS forum_slug,
        role || '_' || ((conv_id * 3 + turn) % 7)::VARCHAR AS author, role, turn AS position,
        CASE WHEN turn > 0 THEN conv_id::VARCHAR || '-' || ((turn - 1) // 2)::VARCHAR END AS parent_post_id,
        TIMESTAMP '2024-01-01' + to_hours((conv_id * 7 + turn)::INTEGER) AS ts, text AS content_text FROM conversations""",
    "v_topics": "SELECT topic_slug, forum_slug, list(post_id ORDER BY turn) AS post_ids, count(*) - 1 AS reply_count FROM v_posts GROUP BY ALL",
    "v_articles": "SELECT d.doc_id, d.source AS forum_slug, d.lang, d.text, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
    "v_parts": "SELECT doc_id, unnest(range(len(p))) AS id, unnest(p) AS text FROM (SELECT doc_id, string_split(text, '. ') AS p FROM documents)",
    "v_segments": """SELECT doc_id, id, text, 'S' || ((id // 3) % 3)::VARCHAR AS speaker, b / 15.0::DOUBLE + 3 * (id // 5) AS start, b / 15.0::DOUBLE + 3 * (id // 5) + length(text) / 15.0::DOUBLE AS "end"
        FROM (SELECT *, coalesce(sum(length(text)) OVER (PARTITION BY doc_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS b FROM v_parts)""",
    "v_access": "SELECT event_id, user_id % 40 AS topic_id, event_type AS query_name, ts FROM events",
    "v_reviews": "SELECT user_id AS slug, (props::JSON ->> '$.k')::BIGINT AS segment_id, ts::DATE AS session FROM events",
}
NEEDS = {"v_topics": ["v_posts"], "v_segments": ["v_parts"]}


def with_views(*names: str, recursive: bool = False) -> str:
    """WITH clause of the named views and what they need."""
    order: list[str] = []
    for name in names:
        for x in [*NEEDS.get(name, []), name]:
            if x not in order:
                order.append(x)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(f"{x} AS ({SQL[x]})" for x in order)
