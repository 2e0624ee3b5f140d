"""Queries of string, date and link functions, page extraction, and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.sources import extract, leaves, sinks, views
from threadloom.sources.scratch import scratch
from threadloom.sources.views import table, with_views

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("""
    WITH d AS (SELECT doc_id, n_chars, text AS title, 'SEASON ' || (doc_id % 9 + 1)::VARCHAR || ' - EPISODE ' || (doc_id % 50)::VARCHAR || ' - ' || upper(lang) || ' Guest - Role' AS full_title FROM documents)
    SELECT doc_id, substr(regexp_replace(regexp_replace(regexp_replace(lower(trim(title, ' ')), '[^a-z0-9\\s-]', '', 'g'), '[\\s-]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80) AS slug,
           regexp_replace(title, '[^\\p{L}\\p{N} _-]', '_', 'g') AS file_name, lower(regexp_replace(trim(title, ' '), '\\s+', ' ', 'g')) AS title_key,
           regexp_replace(full_title, '(?i)^season\\s+\\d+\\s*-\\s*episode\\s+\\d+\\s*-\\s*', '') AS plain_title, (doc_id % 9 + 1)::INTEGER AS season, (doc_id % 50)::INTEGER AS episode,
           printf('%02d:%02d:%02d', n_chars // 3600, (n_chars % 3600) // 60, n_chars % 60) AS clock, n_chars::INTEGER AS seconds FROM d""")
def slug_and_date_functions(spark, sf_dir):
    full = F.concat(F.lit("SEASON "), F.col("doc_id") % 9 + 1, F.lit(" - EPISODE "), F.col("doc_id") % 50, F.lit(" - "), F.upper("lang"), F.lit(" Guest - Role"))
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.col("text").alias("title"), full.alias("full_title"))
    season, episode = tx.season_episode(F.col("full_title"))
    clock = tx.clock_of(F.col("n_chars"))
    return d.select(
        "doc_id", tx.slug(F.col("title")).alias("slug"), tx.file_safe(F.col("title")).alias("file_name"), tx.title_key(F.col("title")).alias("title_key"), tx.plain_title(F.col("full_title")).alias("plain_title"),
        season.alias("season"), episode.alias("episode"), clock.alias("clock"), tx.seconds_of(clock).alias("seconds"))


@query(with_views("v_posts") + """
    SELECT author, min(ts)::DATE::VARCHAR AS first_day, datesub('day', min(ts), max(ts)) AS span_days, strftime(max(ts), '%B %-d, %Y') AS last_text FROM v_posts GROUP BY author""")
def author_days(spark, sf_dir):
    posts = views.posts(spark, sf_dir).groupBy("author").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return posts.select("author", F.date_format("a", "yyyy-MM-dd").alias("first_day"), tx.whole_days(F.col("a"), F.col("b")).alias("span_days"), F.date_format("b", "MMMM d, yyyy").alias("last_text"))


@query("""
    WITH p AS (SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS t FROM (SELECT doc_id, list_filter(list_transform(string_split(replace(text, '. ', chr(10) || chr(10)), chr(10) || chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM documents))
    SELECT doc_id, pos, CASE WHEN starts_with(t, '>') OR contains(t, 'wrote:') THEN 'quote' ELSE 'paragraph' END AS type, length(t) AS n FROM p""")
def paragraph_blocks(spark, sf_dir):
    paragraphs = F.replace(F.col("text"), F.lit(". "), F.lit("\n\n"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(tx.blocks_of(paragraphs)).alias("pos", "b"))
    return rows.select("doc_id", F.col("pos").cast("long").alias("pos"), "b.type", F.char_length("b.text").alias("n"))


@query("""
    WITH t AS (SELECT doc_id, '[src](http://a.example/' || source || ') and http://b.example/' || lang || '/' || (doc_id % 3)::VARCHAR || ' ' || text AS text FROM documents),
    u AS (SELECT doc_id, list_distinct(regexp_extract_all(text, '\\[[^\\]]*\\]\\((https?://[^)\\s]+)\\)', 1) || regexp_extract_all(text, 'https?://[^\\s)\\]<>"]+')) AS l FROM t)
    SELECT doc_id, unnest(l) AS url FROM u""")
def url_extract(spark, sf_dir):
    text = F.concat(F.lit("[src](http://a.example/"), "source", F.lit(") and http://b.example/"), "lang", F.lit("/"), (F.col("doc_id") % 3).cast("string"), F.lit(" "), "text")
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.urls_of(text)).alias("url"))


@query("SELECT page_id, len(regexp_extract_all(html, '<a [^>]*href=')) AS links FROM pages")
def page_link_count(spark, sf_dir):
    return extract.extract_pages(table(spark, sf_dir, "pages")).select("page_id", F.size("links").cast("long").alias("links"))


@query()
def page_links(spark, sf_dir):
    return extract.extract_pages(table(spark, sf_dir, "pages")).select("page_id", F.explode("links").alias("l")).select("page_id", "l.href", "l.text", "l.kind")


@query()
def page_blocks(spark, sf_dir):
    return extract.extract_pages(table(spark, sf_dir, "pages")).select("page_id", F.posexplode("blocks").alias("pos", "b")).select("page_id", "pos", "b.type", "b.text")


@query()
def page_text(spark, sf_dir):
    return extract.extract_pages(table(spark, sf_dir, "pages")).select("page_id", "title", "text")


@query("""
    SELECT CASE WHEN html IS NULL OR html = '' THEN 'empty' WHEN contains(html, 'wpmem_restricted_msg') THEN 'restricted' WHEN NOT contains(html, '<article') THEN 'no_article' ELSE 'parsed' END AS outcome, count(*) AS n FROM pages GROUP BY 1""")
def page_outcomes(spark, sf_dir):
    return table(spark, sf_dir, "pages").groupBy(extract.outcome(F.col("html")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


POST_COLUMNS = "post_id, forum_slug, topic_slug, author, position, length(content_text) AS n_chars"


@query(with_views("v_posts") + f" SELECT {POST_COLUMNS} FROM v_posts")
def csv_round_trip(spark, sf_dir):
    """Posts to CSV and back: quoted texts with line ends, quotes and commas come back as they were."""
    path = scratch(spark)
    sinks.write_csv(views.posts(spark, sf_dir).select("post_id", "forum_slug", "topic_slug", "author", "position", "content_text"), path)
    back = sinks.read_csv(spark, path, "post_id string, forum_slug string, topic_slug string, author string, position long, content_text string")
    return back.select("post_id", "forum_slug", "topic_slug", "author", "position", F.char_length("content_text").alias("n_chars"))


@query(with_views("v_posts") + " SELECT author, count(*) AS posts, sum(len(string_split(content_text, chr(10))) + 2)::BIGINT AS lines FROM v_posts GROUP BY author")
def text_round_trip(spark, sf_dir):
    """One folder of text per author, a head line and an empty line around each post; read back by folder."""
    path = scratch(spark)
    sinks.write_author_texts(views.posts(spark, sf_dir), path)
    lines = spark.read.text(path)
    return lines.groupBy(F.col("safe_author").alias("author")).agg(F.count_if(F.col("value").startswith("=== ")).alias("posts"), F.count(F.lit(1)).alias("lines"))


@query(with_views("v_topics") + " SELECT topic_slug, len(post_ids) AS posts, reply_count, post_ids[1] AS first_id FROM v_topics")
def json_round_trip(spark, sf_dir):
    """Topics to JSON leaves and back through the tolerant, two-generation reader."""
    path = scratch(spark)
    sinks.upsert_leaves(None, views.topics(spark, sf_dir).withColumn("written_at", F.lit("2024-01-01")), ["topic_slug"], "written_at").write.json(path)
    good, _ = leaves.read_topics(spark, path)
    return good.select("topic_slug", F.size("post_ids").cast("long").alias("posts"), F.col("reply_count").cast("long"), F.try_element_at("post_ids", F.lit(1)).alias("first_id"))


@query(with_views("v_posts") + """
    , old AS (SELECT post_id, content_text, 1 AS v FROM v_posts WHERE turn < 4), new AS (SELECT post_id, content_text || '!' AS content_text, 2 AS v FROM v_posts WHERE turn >= 3),
    u AS (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY v DESC) AS r FROM (SELECT * FROM old UNION ALL SELECT * FROM new))
    SELECT post_id, md5(content_text) AS content_hash FROM u WHERE r = 1""")
def upsert_leaves(spark, sf_dir):
    posts = views.posts(spark, sf_dir)
    old = posts.filter("turn < 4").select("post_id", "content_text", F.lit(1).alias("v"))
    new = posts.filter("turn >= 3").select("post_id", F.concat("content_text", F.lit("!")).alias("content_text"), F.lit(2).alias("v"))
    return sinks.upsert_leaves(old, new, ["post_id"], "v").select("post_id", F.md5(F.col("content_text").cast("binary")).alias("content_hash"))
