"""Queries that write bundles and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions.text import short_clock, word_count
from threadloom.operators import curation, episodes, posts, reports
from threadloom.plans import reports as reported
from threadloom.sources import bundles, views
from threadloom.sources.scratch import scratch
from threadloom.sources.views import table, with_views

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def _parts(spark, sf_dir):
    """Documents as episodes: two runs for three of four, of which the second fails for each sixth; a chapter at each twentieth segment."""
    docs = table(spark, sf_dir, "documents")
    n, slug, nothing = F.col("doc_id"), F.concat(F.lit("d"), "doc_id").alias("slug"), F.lit(None).cast("string")
    metadata = docs.select(
        slug, F.concat(F.lit("SEASON 1 - EPISODE "), n, F.lit(" - Document "), n).alias("title"), F.when(n % 5 != 0, F.format_string("2024-01-%02d", n % 28 + 1)).alias("pub_date_iso"), (n % 3).cast("int").alias("itunes_season"),
        (n % 10).cast("int").alias("itunes_episode"), short_clock(F.col("n_chars") / 15).alias("itunes_duration"), F.col("lang").alias("description_html"), nothing.alias("itunes_image"), F.lit(None).cast("double").alias("audio_seconds"))
    manifests = docs.filter(n % 4 != 0).select(slug, F.when(n % 2 == 1, "r1").alias("canonical"), F.lit("r0").alias("canonical_run_id"), F.array(F.lit("r0"), F.lit("r1")).alias("runs"))
    run = F.explode(F.array(F.struct(F.lit("r0").alias("run_id"), F.lit(True).alias("success"), F.lit(0).cast("long").alias("w")), F.struct(F.lit("r1").alias("run_id"), (n % 6 != 1).alias("success"), word_count(F.col("text")).cast("long").alias("w"))))
    ran = docs.select(slug, run.alias("r")).select("slug", "r.run_id", "r.success", F.lit(1).cast("long").alias("chapters_generated"), F.col("r.w").alias("word_count"), F.lit(3).cast("long").alias("speakers_detected"))
    segments = views.segments(spark, sf_dir).withColumn("slug", slug)
    k = F.floor(F.col("id") / 20)
    heads = segments.filter("id % 20 = 0").select("slug", k.alias("pos"), F.lit("r1").alias("run_id"), F.concat(F.lit("Part "), k + 1).alias("title"), F.array(F.concat(F.lit("t"), k % 7)).alias("topics"), F.array().cast("array<string>").alias("films"))
    reviews = table(spark, sf_dir, "labels").select(slug, F.when(F.col("toxic") == 1, 0.5).otherwise(0.25).alias("coverage"))
    return episodes.assemble_episodes(metadata, manifests, ran, heads, reviews), heads.drop("run_id"), segments.select("slug", F.col("id").alias("pos"), "id", "speaker", "text")


@query(with_views("v_segments") + """
    , s AS (SELECT doc_id, count(*) AS n, sum(length(text))::BIGINT AS chars, count(*) FILTER (WHERE id % 20 = 0) AS chapters, list_sort(list_distinct(list('t' || (id // 20 % 7)) FILTER (WHERE id % 20 = 0))) AS topics FROM v_segments GROUP BY doc_id),
    r AS (SELECT doc_id, max(CASE WHEN toxic = 1 THEN 0.5 ELSE 0.25 END)::DOUBLE AS coverage FROM labels GROUP BY doc_id),
    d AS (SELECT *, CASE WHEN doc_id % 4 <> 0 THEN CASE WHEN doc_id % 2 = 1 THEN 'r1' ELSE 'r0' END END AS run FROM documents)
    SELECT 'd' || d.doc_id AS slug, 'Document ' || d.doc_id AS title, CASE WHEN d.doc_id % 5 <> 0 THEN '2024-01-' || lpad((d.doc_id % 28 + 1)::VARCHAR, 2, '0') ELSE '' END AS "pubDate",
           nullif(d.doc_id % 3, 0)::INTEGER AS season, nullif(d.doc_id % 10, 0)::INTEGER AS episode, run IS NOT NULL AS "hasTranscript", run AS "canonicalRunId", r.doc_id IS NOT NULL AS "hasGoal", coalesce(r.coverage, 0) AS "reviewCoverage",
           CASE WHEN run = 'r0' THEN 0 WHEN run = 'r1' AND d.doc_id % 6 <> 1 THEN coalesce(len(regexp_extract_all(d.text, '\\S+')), 0)::BIGINT END AS words,
           CASE WHEN run = 'r0' THEN '' WHEN run = 'r1' AND d.doc_id % 6 <> 1 THEN coalesce(array_to_string(s.topics, ','), '') END AS topics, coalesce(s.chapters, 0) AS chapter_items, coalesce(s.n, 0) AS segment_lines, coalesce(s.chars, 0) AS segment_chars
    FROM d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id""")
def episode_bundle(spark, sf_dir):
    """The publishing bundle of all episodes; its index, chapters and transcripts are read back."""
    items, heads, segments = _parts(spark, sf_dir)
    path = scratch(spark)
    bundles.publish_episodes(items, heads, segments, path)
    stats = "stats struct<words:long,topics:array<string>>"
    index = bundles.read_array(spark, f"{path}/index.json", f"slug string, title string, pubDate string, season int, episode int, hasTranscript boolean, canonicalRunId string, hasGoal boolean, reviewCoverage double, {stats}")
    names = index.select("slug").distinct().select("slug", F.explode(F.array(F.lit("chapters.json"), F.lit("transcript.jsonl"))).alias("base"))
    lines = bundles.read_named(names.withColumn("file", F.concat(F.url_encode("slug"), F.lit("/"), "base")), path)
    chapter = F.col("base") == "chapters.json"
    read = lines.groupBy("slug").agg(F.count_if(chapter).alias("chapter_items"), F.count_if(~chapter).alias("segment_lines"), F.sum(F.when(~chapter, F.char_length(F.get_json_object("value", "$.text")))).alias("segment_chars"))
    joined = index.join(read, "slug", "left").na.fill(0, ["chapter_items", "segment_lines", "segment_chars"])
    return joined.withColumns({"words": F.col("stats.words"), "topics": F.array_join("stats.topics", ",")}).drop("stats")


@query(reported.LOW_SQL + """
    , m AS (SELECT * FROM low WHERE category IN (SELECT category FROM big)),
    s AS (SELECT category, count(*) AS topics_count, count(DISTINCT started_by) AS authors_count FROM m GROUP BY category)
    SELECT m.topic_slug, 'low-' || m.category AS bucket_id, m.reply_count, 'consolidated_into' AS status, s.topics_count, s.authors_count, s.topics_count AS file_lines FROM m JOIN s ON s.category = m.category""")
def bucket_bundle(spark, sf_dir):
    """Bucket files, marked topics and their summary, read back."""
    low = reported._low(spark, sf_dir)
    bucket = F.concat(F.lit("low-"), "category").alias("bucket_id")
    members = low.join(curation.buckets(low).select("category"), "category").select(bucket, F.initcap("category").alias("bucket_name"), "topic_slug", "forum_slug", "started_by", "reply_count")
    topics = views.topics(spark, sf_dir).select("topic_slug", F.to_json(F.struct("topic_slug", "forum_slug", "reply_count", "post_ids")).alias("document"))
    path = scratch(spark)
    bundles.publish_buckets(members, topics, path, "2024-01-01T00:00:00")
    marked = spark.read.schema("topic_slug string, reply_count long, curation struct<consolidation_status:string,consolidated_bucket:string>").json(f"{path}/topics")
    summary = bundles.read_array(spark, f"{path}/consolidation_summary.json", "bucket_id string, topics_count long, authors_count long")
    files = spark.read.text(f"{path}/consolidated").groupBy(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(-\d{5})?\.jsonl$", 1).alias("bucket_id")).agg(F.count(F.lit(1)).alias("file_lines"))
    found = marked.select("topic_slug", F.col("curation.consolidated_bucket").alias("bucket_id"), "reply_count", F.col("curation.consolidation_status").alias("status"))
    return found.join(summary, "bucket_id").join(files, "bucket_id")


LISTS = {"author": "authors_list", "forum_slug": "forums_list", "topic_slug": "topics_list"}


@query(with_views("v_posts") + """
    , n AS (SELECT DISTINCT 'authors_list' AS l, 3 AS p, author AS name FROM v_posts UNION SELECT 'forums_list', 6, forum_slug FROM v_posts UNION SELECT 'topics_list', 9, topic_slug FROM v_posts),
    top AS (SELECT author, count(*) AS posts FROM v_posts WHERE author IS NOT NULL GROUP BY author ORDER BY posts DESC, author LIMIT 20)
    SELECT '{"corpus_statistics":{"total_posts":' || count(*) || ',"unique_authors":' || count(DISTINCT author) || ',"unique_forums":' || count(DISTINCT forum_slug) || ',"unique_topics":' || count(DISTINCT topic_slug)
        || ',"total_text_length":' || coalesce(sum(length(content_text)), 0)::BIGINT || ',"average_post_length":' || coalesce(sum(length(content_text))::BIGINT // count(*), 0) || '}' AS line FROM v_posts
    UNION ALL SELECT ',"top_authors":[' || string_agg('{"name":"' || author || '","posts":' || posts || '}', ',' ORDER BY posts DESC, author) || ']' FROM top
    UNION ALL SELECT unnest([',"authors_list":[', '],"forums_list":[', '],"topics_list":[', ']}'])
    UNION ALL SELECT CASE WHEN name = min(name) OVER (PARTITION BY l) THEN '' ELSE ',' END || '"' || name || '"' FROM n WHERE name IS NOT NULL""")
def statistics_document(spark, sf_dir):
    """The corpus's statistics document, its totals, best authors and name lists, by its lines."""
    rows = views.posts(spark, sf_dir)
    totals = reports.corpus_totals(rows).select("total_posts", "unique_authors", "unique_forums", "unique_topics", "total_text_length", "average_post_length")
    counted = rows.filter("author is not null").groupBy(F.col("author").alias("name")).agg(F.count(F.lit(1)).alias("posts"))
    best = posts.top_k(counted, 20, F.desc("posts"), "name")
    path = scratch(spark)
    bundles.publish_statistics(totals, best, reports.name_lists(rows, LISTS), list(LISTS.values()), path)
    return spark.read.text(f"{path}/statistics.json").withColumnRenamed("value", "line")
