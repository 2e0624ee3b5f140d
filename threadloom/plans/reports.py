"""Queries on exports, statistics, coverage notes, low-engagement topics and batch reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators import curation, reports
from threadloom.plans import curation as curated
from threadloom.plans import segments as tagged
from threadloom.plans.search import HOLDS_SQL, keyword_hits
from threadloom.sources import views
from threadloom.sources.views import table, with_views

QUERIES, ORACLE_SQL = {}, {}
RULE = reports.RULE


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(with_views("v_posts") + f"""
    SELECT post_id, concat_ws(chr(10), '{RULE}', 'POST ID: ' || post_id, 'AUTHOR: ' || coalesce(author, 'Unknown'), 'ROLE: ' || coalesce(role, 'N/A'), 'FORUM: ' || coalesce(forum_slug, 'N/A'),
           'TOPIC: ' || coalesce(topic_slug, 'N/A'), '{RULE}', coalesce(content_text, '')) AS record FROM v_posts""")
def post_records(spark, sf_dir):
    return reports.post_records(views.posts(spark, sf_dir))


@query(with_views("v_posts") + f"""
    SELECT post_id, concat_ws(chr(10), 'POST ID: ' || post_id, 'TOPIC: ' || coalesce(topic_slug, 'N/A'), 'FORUM: ' || coalesce(forum_slug, 'N/A'), '{RULE}', coalesce(content_text, '')) AS record
    FROM v_posts WHERE contains(role, 'assist')""")
def role_records(spark, sf_dir):
    return reports.role_records(views.posts(spark, sf_dir), "assist")


@query(with_views("v_posts") + r"""
    , s AS (SELECT author, forum_slug, topic_slug, coalesce(content_text, '') AS t FROM v_posts),
    b AS (SELECT *, list_filter(list_transform(string_split(t, chr(10) || chr(10)), lambda x: trim(x)), lambda x: x <> '') AS bs FROM s)
    SELECT count(*) AS total_posts, count(DISTINCT author) AS unique_authors, count(DISTINCT forum_slug) AS unique_forums, count(DISTINCT topic_slug) AS unique_topics,
           coalesce(sum(length(t)), 0)::BIGINT AS total_text_length, CASE WHEN count(*) > 0 THEN sum(length(t)) // count(*) ELSE 0 END::BIGINT AS average_post_length,
           coalesce(sum(len(list_filter(bs, lambda x: starts_with(x, '>') OR contains(x, 'wrote:')))), 0)::BIGINT AS total_quotes,
           coalesce(sum(len(list_distinct(list_concat(regexp_extract_all(t, '\[[^\]]*\]\((https?://[^)\s]+)\)', 1), regexp_extract_all(t, 'https?://[^\s)\]<>"]+'))))), 0)::BIGINT AS total_links,
           coalesce(sum(len(bs)), 0)::BIGINT AS total_content_blocks FROM b""")
def corpus_totals(spark, sf_dir):
    return reports.corpus_totals(views.posts(spark, sf_dir))


@query(with_views("v_posts") + """
    SELECT 'authors' AS list, author AS name, count(*) AS posts FROM v_posts WHERE author IS NOT NULL GROUP BY author
    UNION ALL SELECT 'forums', forum_slug, count(*) FROM v_posts WHERE forum_slug IS NOT NULL GROUP BY forum_slug
    UNION ALL SELECT 'topics', topic_slug, count(*) FROM v_posts WHERE topic_slug IS NOT NULL GROUP BY topic_slug""")
def name_lists(spark, sf_dir):
    return reports.name_lists(views.posts(spark, sf_dir), {"author": "authors", "forum_slug": "forums", "topic_slug": "topics"})


@query(with_views("v_posts") + """
    , t AS (SELECT 'forum-' || forum_slug AS forum_slug, topic_slug, min(ts) AS at FROM v_posts GROUP BY ALL),
    f AS (SELECT forum_slug, 'Known ' || forum_slug AS name, count(*) + 1 AS total_topics FROM t WHERE forum_slug < 'forum-f3' GROUP BY forum_slug)
    SELECT t.forum_slug, coalesce(max(f.name), 'Forum F' || substr(t.forum_slug, 8)) AS name, count(*) AS topics_scraped, coalesce(max(f.total_topics), count(*)) AS total_topics,
           strftime(min(t.at), '%Y-%m-%d %H:%M') AS first_scraped, strftime(max(t.at), '%Y-%m-%d %H:%M') AS last_scraped
    FROM t LEFT JOIN f ON f.forum_slug = t.forum_slug GROUP BY t.forum_slug""")
def coverage_span(spark, sf_dir):
    topics = views.posts(spark, sf_dir).groupBy(F.concat(F.lit("forum-"), "forum_slug").alias("forum_slug"), "topic_slug").agg(F.min("ts").alias("scraped_at"))
    known = topics.filter("forum_slug < 'forum-f3'").groupBy("forum_slug").agg((F.count(F.lit(1)) + 1).alias("total_topics")).withColumn("name", F.concat(F.lit("Known "), "forum_slug"))
    out = reports.coverage_span(topics, known)
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm") for c in ("first_scraped", "last_scraped")})


QUESTIONS = [
    ("light", ["the", "and"], ["src0", "src1"], 5), ("half", ["que"], ["src0", "nowhere"], 1), ("absent", ["der"], ["nowhere", "elsewhere", "src0"], 1),
    ("rare", ["neverfound"], ["src0"], 3), ("free", ["les"], [], 1), ("words", ["Of The", "LICENSED under", "neverfound the"], ["src0"], 7),
]
_QUESTION_ROWS = ", ".join(f"('{n}', {k}::VARCHAR[], {f}::VARCHAR[], {m})" for n, k, f, m in QUESTIONS)


@query(f"""
    WITH q AS (SELECT * FROM (VALUES {_QUESTION_ROWS}) AS t(name, keywords, forums, least)),
    w AS (SELECT name, unnest(keywords) AS keyword FROM q),
    h AS (SELECT w.name, w.keyword, count(d.doc_id) AS n FROM w LEFT JOIN documents d ON {HOLDS_SQL.format("w.keyword")} GROUP BY ALL),
    s AS (SELECT name, sum(least(n, 1000))::BIGINT AS hits FROM h GROUP BY name),
    u AS (SELECT DISTINCT name, unnest(forums) AS forum FROM q),
    m AS (SELECT q.name, coalesce(x.missing, []) AS missing FROM q LEFT JOIN (SELECT name, list(forum ORDER BY forum) AS missing FROM u WHERE forum NOT IN (SELECT source FROM documents WHERE source IS NOT NULL) GROUP BY name) x ON x.name = q.name),
    r AS (SELECT q.name, s.hits, q.least, m.missing, (len(q.forums) - len(m.missing)) * 2 >= len(q.forums) AND s.hits >= q.least AS complete FROM q JOIN s ON s.name = q.name JOIN m ON m.name = q.name)
    SELECT name, hits, complete, CASE WHEN complete THEN '✓ ' || hits || ' relevant posts found' WHEN len(missing) > 0 THEN '⚠ Missing forums: ' || array_to_string(missing, ', ')
           ELSE '⚠ Only ' || hits || '/' || least || ' posts found' END AS note FROM r""")
def question_report(spark, sf_dir):
    questions = spark.createDataFrame(QUESTIONS, "name string, keywords array<string>, forums array<string>, least int")
    hits = keyword_hits(spark, sf_dir, questions.select(F.explode("keywords").alias("keyword")))
    return reports.question_report(questions, table(spark, sf_dir, "documents"), "doc_id", "text", "source", hits=hits)


LOW_SQL = with_views("v_topics") + "," + curated.CATEGORY_SQL + ", low AS (SELECT * FROM cat WHERE reply_count IN (0, 1, 2)), big AS (SELECT category FROM low GROUP BY category HAVING count(*) >= 5)"


def _low(spark, sf_dir):
    """Topics of the engagement classes zero, one and two with their categories."""
    return curated._categories(spark, sf_dir).filter(F.col("reply_count").isin(0, 1, 2))


@query(LOW_SQL + " SELECT category, count(*) AS n FROM low GROUP BY category")
def low_topic_categories(spark, sf_dir):
    return _low(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(LOW_SQL + " SELECT 'low-' || category AS bucket_id, forum_slug, topic_slug, started_by, reply_count FROM low WHERE category IN (SELECT category FROM big)")
def bucket_members(spark, sf_dir):
    """Members of the buckets as rows, so that a bucket has no bound."""
    low = _low(spark, sf_dir)
    return low.join(curation.buckets(low).select("category"), "category").select(F.concat(F.lit("low-"), "category").alias("bucket_id"), "forum_slug", "topic_slug", "started_by", "reply_count")


@query(LOW_SQL + " SELECT count(DISTINCT category) AS buckets, count(*) AS topics, coalesce(sum(reply_count), 0)::BIGINT AS replies FROM low WHERE category IN (SELECT category FROM big)")
def bucket_summary(spark, sf_dir):
    found = curation.buckets(_low(spark, sf_dir))
    return found.agg(F.count(F.lit(1)).alias("buckets"), F.coalesce(F.sum("topics"), F.lit(0)).alias("topics"), F.coalesce(F.sum("replies"), F.lit(0)).alias("replies"))


@query(with_views("v_topics") + "," + curated.ENGAGEMENT_SQL + " SELECT p.post_id, k.topic_slug, k.reply_count FROM v_posts p JOIN k ON k.topic_slug = p.topic_slug WHERE k.engagement = 'high'")
def high_class_posts(spark, sf_dir):
    """Posts of the topics whose engagement class is high, more than ten replies. The driver's conversations have eight turns at
    most, so the result is empty there; test_reports has longer ones."""
    top = curated._engagement(spark, sf_dir).filter("engagement = 'high'").select("topic_slug", "reply_count")
    return views.posts(spark, sf_dir).join(top, "topic_slug").select("post_id", "topic_slug", "reply_count")


@query(tagged.TAGS_SQL + " SELECT doc_id, id, string_agg(class, ',' ORDER BY confidence DESC, class) AS classes FROM tag WHERE confidence >= 0.3 GROUP BY doc_id, id")
def tags_by_confidence(spark, sf_dir):
    return reports.by_confidence(tagged.topic_tags(spark, sf_dir), ["doc_id", "id"])


@query("SELECT d.doc_id, d.source, l.quality, d.n_chars FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE d.text IS NOT NULL AND l.quality IS NOT NULL ORDER BY d.n_chars DESC, d.doc_id")
def catalog_scan(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter("quality is not null").select("doc_id", "quality")
    return docs.filter("text is not null").select("doc_id", "source", "n_chars").join(labels, "doc_id").select("doc_id", "source", "quality", "n_chars").orderBy(F.desc("n_chars"), "doc_id")


@query("SELECT d.doc_id, d.n_chars, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1) AS found FROM documents d")
def transcript_manifest(spark, sf_dir):
    """Each document with whether it is among the cached ones, here those of one label."""
    cached = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id").distinct().withColumn("found", F.lit(True))
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(cached, "doc_id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


@query("SELECT event_id, user_id FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def ledger_with_key(spark, sf_dir):
    """Ledger rows that hold a given source key."""
    return table(spark, sf_dir, "events").filter(F.get_json_object("props", "$.k").isNotNull()).select("event_id", "user_id")


@query("""
    WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS done, count(*) FILTER (WHERE event_type = 'error') AS failed FROM events GROUP BY user_id)
    SELECT 'result' AS kind, user_id::VARCHAR AS key, done AS runs FROM c WHERE done > 0
    UNION ALL SELECT 'failure', user_id::VARCHAR, failed FROM c WHERE failed > 0
    UNION ALL SELECT 'gap', c_custkey::VARCHAR, 0 FROM (SELECT DISTINCT c_custkey FROM customer) WHERE c_custkey NOT IN (SELECT user_id FROM c WHERE done > 0)""")
def batch_report(spark, sf_dir):
    """Events as runs of customers: a purchase is a done run, an error a failed one."""
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return reports.batch_report(table(spark, sf_dir, "events"), expected, "user_id", F.col("event_type") == "error", F.col("event_type") == "purchase")
