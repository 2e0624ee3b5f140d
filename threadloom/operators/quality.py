"""Validation rules, coverage and provenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import tokens
from threadloom.operators.threads import on_cycles


def coverage(topics: DataFrame, totals: DataFrame) -> DataFrame:
    """Per forum: scraped topics and posts against known totals (the scraped number where no total is known)."""
    found = topics.groupBy("forum_slug").agg(F.count_distinct("topic_slug").alias("topics_scraped"), F.sum(F.size("post_ids")).alias("posts_scraped"))
    joined = found.join(totals, "forum_slug", "left").withColumn("total_topics", F.coalesce("total_topics", "topics_scraped"))
    return joined.withColumn("percent", F.round(F.when(F.col("total_topics") == 0, 0.0).otherwise(F.col("topics_scraped") * 100.0 / F.col("total_topics")), 6))


def coverage_delta(now: DataFrame, before: DataFrame) -> DataFrame:
    old = before.select("forum_slug", F.col("topics_scraped").alias("old"))
    return now.join(old, "forum_slug", "left").select("forum_slug", (F.col("topics_scraped") - F.coalesce("old", F.lit(0))).alias("delta"), F.col("old").isNull().alias("is_new"))


def question_coverage(questions: DataFrame, keyword_hits: DataFrame, most: int = 1000) -> DataFrame:
    """(name, hits, enough) of questions(name, keyword, least), with keyword_hits(keyword, hits) from a search for each keyword: hits of
    a keyword count up to `most`."""
    joined = questions.join(keyword_hits, "keyword", "left").withColumn("n", F.least(F.coalesce("hits", F.lit(0)), F.lit(most)))
    return joined.groupBy("name").agg(F.sum("n").cast("long").alias("hits"), (F.sum("n") >= F.max("least")).alias("enough"))


def multi_access(log: DataFrame, k: int) -> DataFrame:
    """Topics accessed more than once, with the first three queries. Counts are summed map-side and ranks are limited before
    the shuffle, so a hot topic moves a count and three rows from each task."""
    from pyspark.sql import Window

    ranked = log.withColumn("r", F.row_number().over(Window.partitionBy("topic_id").orderBy("ts", "event_id"))).filter("r <= 3")
    first = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "query_name"))), lambda s: s["query_name"]), ",")
    counts = log.groupBy("topic_id").agg(F.count(F.lit(1)).alias("accesses")).filter("accesses > 1")
    return counts.join(ranked.groupBy("topic_id").agg(first.alias("first_three")), "topic_id").orderBy(F.desc("accesses"), "topic_id").limit(k)


def _found(rows: DataFrame, severity: str, rule: str, key: str, message: str) -> DataFrame:
    return rows.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), F.col(key).alias("key"), F.lit(message).alias("message"))


def validate_posts(posts: DataFrame) -> DataFrame:
    """(severity, rule, key, message) of post rules; needs post_id, parent_post_id, position, author, content_text."""
    ids = posts.select("post_id").distinct()
    reply = posts.filter("parent_post_id is not null")
    rules = [
        _found(posts.filter("content_text is null or trim(content_text) = ''"), "warning", "empty_content", "post_id", "no content"),
        _found(posts.filter("author is null"), "warning", "missing_author", "post_id", "no author"),
        _found(posts.filter("position is null"), "warning", "missing_position", "post_id", "no position"),
        _found(reply.join(ids.select(F.col("post_id").alias("parent_post_id")), "parent_post_id", "left_anti"), "error", "dangling_parent", "post_id", "parent does not exist"),
        _found(reply.filter("post_id = parent_post_id"), "error", "self_parent", "post_id", "post replies to itself"),
        _found(posts.groupBy("post_id").count().filter("count > 1"), "error", "duplicate_id", "post_id", "id occurs more than once"),
    ]
    return reduce(DataFrame.unionByName, rules)


def validate_topics(topics: DataFrame, posts: DataFrame) -> DataFrame:
    """Topic rules; needs topics(topic_slug, post_ids, reply_count) and posts(post_id, topic_slug, parent_post_id)."""
    listed = topics.select("topic_slug", F.explode("post_ids").alias("post_id"))
    missing = listed.join(posts.select("post_id").distinct(), "post_id", "left_anti")
    unlisted = posts.select("topic_slug", "post_id").join(listed, ["topic_slug", "post_id"], "left_anti")
    cycle = posts.join(on_cycles(posts).select("post_id"), "post_id", "left_semi")
    no_root = posts.groupBy("topic_slug").agg(F.count_if(F.col("parent_post_id").isNull()).alias("roots")).filter("roots = 0")
    rules = [
        _found(topics.filter(F.size("post_ids") == 0), "warning", "no_posts", "topic_slug", "no post ids"),
        _found(topics.filter(F.col("reply_count") != F.size("post_ids") - 1), "warning", "reply_count", "topic_slug", "reply count differs from ids"),
        _found(topics.filter(F.size(F.array_distinct("post_ids")) < F.size("post_ids")), "error", "repeated_ids", "topic_slug", "an id is listed twice"),
        _found(missing.select("topic_slug").distinct(), "error", "missing_post", "topic_slug", "an id has no post"),
        _found(unlisted.select("topic_slug").distinct(), "warning", "unlisted_post", "topic_slug", "a post is not listed"),
        _found(cycle.select("topic_slug").distinct(), "error", "cycle", "topic_slug", "replies form a cycle"),
        _found(no_root, "error", "no_root", "topic_slug", "no post without a parent"),
        _found(topics.groupBy("topic_slug").count().filter("count > 1"), "error", "duplicate_topic", "topic_slug", "topic occurs more than once"),
    ]
    return reduce(DataFrame.unionByName, rules)
