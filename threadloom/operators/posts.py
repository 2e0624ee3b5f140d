"""Operators on posts, topics and articles: filters, joins, statistics, ordered lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def where_all(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """Filter by those conditions that are given."""
    return reduce(DataFrame.filter, [c for c in conditions if c is not None], df)


def search_posts(posts: DataFrame, forum: str | None = None, author_like: str | None = None, role: str | None = None, flags: dict[str, bool] | None = None) -> DataFrame:
    """Facets composed as given; author_like is a case-insensitive substring."""
    flagged = [F.col(k) == v for k, v in (flags or {}).items()]
    return where_all(
        posts,
        F.col("forum_slug") == forum if forum is not None else None,
        F.lower("author").contains(author_like.lower()) if author_like is not None else None,
        F.col("role") == role if role is not None else None,
        *flagged,
    )


def topic_posts(topics: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts of each topic in the order of its id list; ids without a post fall out."""
    listed = topics.select(F.col("topic_slug").alias("in_topic"), F.posexplode("post_ids").alias("ordinal", "post_id"))
    return listed.join(posts, "post_id")


def starters(topics: DataFrame, posts: DataFrame) -> DataFrame:
    """Each topic with the author of its first post, 'Unknown' if that is missing."""
    first = topics.select("topic_slug", F.try_element_at("post_ids", F.lit(1)).alias("post_id"))
    return first.join(posts.select("post_id", "author"), "post_id", "left").select("topic_slug", F.coalesce("author", F.lit("Unknown")).alias("started_by"))


def corpus_stats(posts: DataFrame) -> DataFrame:
    total = F.sum(F.char_length("content_text"))
    return posts.agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("author").alias("authors"), F.count_distinct("forum_slug").alias("forums"),
        F.count_distinct("topic_slug").alias("topics"), total.alias("characters"), F.floor(total / F.count(F.lit(1))).alias("mean_characters"),
    )


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(k)


def latest_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key: the first by the given order. Extra column names of df stay untouched."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def page_of(df: DataFrame, order: list[Column], page: int, limit: int, most: int = 500) -> DataFrame:
    """One page with the total and whether more follow. limit is clamped to 1..most. The total is one aggregate row."""
    size = max(1, min(most, limit))
    skip = max(0, page - 1) * size
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return df.orderBy(*order).offset(skip).limit(size).join(F.broadcast(total)).withColumn("has_more", F.col("total") > skip + size)


def thread_list(turns: DataFrame, keep: int = 50, title_chars: int = 60) -> DataFrame:
    """Newest threads: title from the first user message, ordered by the last time."""
    title = F.min_by(F.when(F.col("role") == "user", F.substring("content_text", 1, title_chars)), F.when(F.col("role") == "user", F.col("position")))
    threads = turns.groupBy("topic_slug").agg(title.alias("title"), F.max("ts").alias("updated"), F.count(F.lit(1)).alias("n_turns"))
    return top_k(threads, keep, F.desc("updated"), "topic_slug")
