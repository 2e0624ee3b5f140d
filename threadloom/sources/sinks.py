"""Exports and keyed writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import clock_of, file_safe
from threadloom.operators.posts import latest_per_key

CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "lineSep": "\n"}


def leaf_key(forum: Column, topic: Column, url: Column) -> Column:
    """File key of a topic: forum__topic, else topic, else the start of the url's md5."""
    return F.coalesce(F.when(forum.isNotNull() & topic.isNotNull(), F.concat_ws("__", forum, topic)), topic, F.substring(F.md5(url.cast("binary")), 1, 12))


def upsert_leaves(old: DataFrame | None, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The latest row of each key of both; writing twice is the same as writing once. Equal versions: the new row wins."""
    both = new.withColumn("_new", F.lit(1)) if old is None else old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest_per_key(both, keys, F.desc_nulls_last(version), F.desc("_new")).drop("_new")


def changed_only(old: DataFrame, new: DataFrame, key: str, content_hash: str = "content_hash") -> DataFrame:
    """Rows of new that old lacks or holds with another hash."""
    known = old.select(key, F.col(content_hash).alias("_old"))
    return new.join(known, key, "left").filter(~F.col("_old").eqNullSafe(F.col(content_hash))).drop("_old")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**{k: v for k, v in CSV.items() if k != "multiLine"}).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV).csv(path)


def csv_rows(posts: DataFrame) -> DataFrame:
    """The twelve columns of the posts' CSV: texts as they are, nulls of names and times as empty, lists as their sizes (0 if null).

    posts needs post_id, author, role, forum_slug, topic_slug, parsed_iso, raw_time, content_text, quotes, links, media, source_url.
    """
    blank = lambda c: F.coalesce(c, F.lit(""))
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("long")
    return posts.select(
        "post_id", *[blank(c).alias(c) for c in ("author", "role", "forum_slug", "topic_slug")], blank("parsed_iso").alias("timestamp_iso"), blank("raw_time").alias("timestamp_raw"),
        blank("content_text").alias("content_text"), *[size(c).alias(f"num_{c}") for c in ("quotes", "links", "media")], "source_url")


def write_records(records: DataFrame, path: str, order: list[str], head: str | None = None, after: str = "\n") -> None:
    """Text records in order, each followed by `after` and a line end, under an optional head. Ranges of the order are files, so none grows without bound."""
    rows = records.select(F.lit(1).alias("_part"), *order, F.concat("record", F.lit(after)).alias("value"))
    if head is not None:
        top = records.sparkSession.range(1).select(F.lit(0).alias("_part"), F.lit(f"{head}\n{'=' * 80}\n").alias("value"))
        rows = rows.unionByName(top, allowMissingColumns=True)
    rows.orderBy("_part", *order).select("value").write.text(path)


def write_author_texts(posts: DataFrame, path: str) -> None:
    """Texts by author in one folder each; rows of a folder follow the topic and position."""
    text = F.concat(F.lit("=== "), "post_id", F.lit("\n"), "content_text", F.lit("\n"))
    rows = posts.select(file_safe(F.col("author")).alias("safe_author"), "topic_slug", "position", text.alias("value"))
    rows.repartition("safe_author").sortWithinPartitions("safe_author", "topic_slug", "position").select("safe_author", "value").write.partitionBy("safe_author").text(path)


def link_rows(posts: DataFrame) -> DataFrame:
    return posts.select("post_id", F.explode("links").alias("l")).select("post_id", "l.href", "l.text", "l.kind")


def quote_lines(posts: DataFrame) -> DataFrame:
    return posts.select("post_id", F.explode("quotes").alias("q")).select(F.concat(F.coalesce("q.attributed_to", F.lit("Unknown")), F.lit(": "), "q.text").alias("value"))


def block_lines(posts: DataFrame) -> DataFrame:
    """Structured blocks with their running number within the post."""
    return posts.select("post_id", F.posexplode("blocks").alias("pos", "b")).select("post_id", "pos", F.concat(F.lit("["), F.upper("b.type"), F.lit(" "), F.col("pos") + 1, F.lit("] "), "b.text").alias("value"))


def topic_lines(topics: DataFrame, posts: DataFrame) -> DataFrame:
    listed = topics.select("topic_slug", F.posexplode("post_ids").alias("pos", "post_id"))
    return listed.join(posts.select("post_id", "author", "content_text"), "post_id").select("topic_slug", "pos", F.concat("author", F.lit(": "), "content_text").alias("value"))


def write_topic_texts(topics: DataFrame, posts: DataFrame, path: str) -> None:
    rows = topic_lines(topics, posts).repartition("topic_slug").sortWithinPartitions("topic_slug", "pos")
    rows.select("topic_slug", "value").write.partitionBy("topic_slug").text(path)


def compact_segments(segments: DataFrame) -> DataFrame:
    """Segments with topics and films reduced to names, for NDJSON."""
    return segments.withColumns({"topics": F.transform("topics", lambda t: t["topic"]), "films": F.transform("films", lambda f: f["film"])})


def write_segments(segments: DataFrame, path: str, by: str = "episode_id") -> None:
    compact_segments(segments).write.partitionBy(by).option("ignoreNullFields", True).json(path)


def index_document(episodes: DataFrame, keys: list[str]) -> DataFrame:
    """Index rows of the publishing bundle, newest first; a range sort, so any number of episodes."""
    return episodes.orderBy(F.desc_nulls_last("pub_date"), F.desc_nulls_last("episode")).select(F.to_json(F.struct(*keys)).alias("value"))


def chapter_lines(chapters: DataFrame) -> DataFrame:
    return chapters.select("episode_id", "index", F.concat_ws(" ", clock_of(F.col("start_time")), F.col("title")).alias("value"))


def merge_sources(ledger: DataFrame, new: DataFrame) -> DataFrame:
    """Provenance ledgers(episode_id, sources map, notes array) with a new source and note each."""
    joined = ledger.join(new.select("episode_id", "source_key", "source_value", "note"), "episode_id", "left")
    added = F.map_from_arrays(F.array("source_key"), F.array("source_value"))
    kept = F.map_filter("sources", lambda k, v: ~k.eqNullSafe(F.col("source_key")))
    return joined.select("episode_id", F.when(F.col("source_key").isNull(), F.col("sources")).otherwise(F.map_concat(kept, added)).alias("sources"),
        F.when(F.col("note").isNull(), F.col("notes")).otherwise(F.array_append("notes", F.col("note"))).alias("notes"))


def goal_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """Manifests of corrected transcripts: created_at of the first write stays."""
    first = old.select("episode_id", F.col("created_at").alias("_first"))
    return new.join(first, "episode_id", "left").withColumn("created_at", F.coalesce("_first", "created_at")).drop("_first")


def placements(transcripts: DataFrame, episodes: DataFrame, existing: DataFrame) -> DataFrame:
    """(guid, outcome) of placing transcripts by guid: placed, already_there or not_found."""
    known = transcripts.join(episodes.select("guid", F.lit(True).alias("_e")), "guid", "left").join(existing.select("guid", F.lit(True).alias("_x")), "guid", "left")
    return known.select("guid", F.when(F.col("_e").isNull(), "not_found").when(F.col("_x").isNotNull(), "already_there").otherwise("placed").alias("outcome"))


def delete_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.join(keys.select(key), key, "left_anti")
