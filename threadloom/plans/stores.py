"""Queries on the curated store, its snapshots and summaries, the run ledger and menus of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions.text import blocks_of, urls_of, word_count
from threadloom.operators import curation, reports
from threadloom.plans import curation as curated
from threadloom.sources import curated as store
from threadloom.sources import articles, ledger, menus, sinks, views
from threadloom.sources.scratch import scratch
from threadloom.sources.views import table, with_views

QUERIES, ORACLE_SQL = {}, {}
PERSONAS = with_views("v_topics") + "," + curated.PROFILE_SQL + "," + curated.PERSONA_SQL


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(PERSONAS + """
    SELECT p.post_id, p.author, CASE WHEN p.turn = 0 THEN 'S' ELSE coalesce(q.tier, 'D') END AS tier FROM v_posts p LEFT JOIN persona q ON q.author = p.author
    WHERE p.turn = 0 OR coalesce(q.tier, 'D') IN ('S', 'C')""")
def tier_store(spark, sf_dir):
    """Posts are stored by tier, then all first posts move to tier S; tiers S and C are read back."""
    posts = curation.with_tier(views.posts(spark, sf_dir), curated._personas(spark, sf_dir)).select("post_id", "author", "turn", "tier")
    target = scratch(spark)
    store.write_tiers(posts, target)
    moved = store.read_tiers(spark, target, posts.schema).filter("turn = 0").withColumn("tier", F.lit("S"))
    store.upsert_posts(moved, target)
    return store.read_tiers(spark, target, posts.schema).filter(F.col("tier").isin("S", "C")).select("post_id", "author", "tier")


@query(PERSONAS + " SELECT tier, author, score, post_count, expert_topics, count(*) OVER (PARTITION BY tier) AS authors FROM persona")
def tier_authors(spark, sf_dir):
    return curation.tier_authors(curated._personas(spark, sf_dir))


@query(PERSONAS + """
    SELECT 'tier' AS kind, tier AS name, tier, NULL::DOUBLE AS score, count(*) AS post_count, NULL::BIGINT AS expert_topics FROM persona GROUP BY tier
    UNION ALL (SELECT 'author', author, tier, score, post_count, expert_topics FROM persona ORDER BY score DESC, author LIMIT 20)""")
def persona_summary(spark, sf_dir):
    return curation.persona_summary(curated._personas(spark, sf_dir))


SUMMARY_SQL = PERSONAS + "," + curated.ENGAGEMENT_SQL + """,
    cp AS (SELECT coalesce(q.tier, 'D') AS tier, k.engagement, p.forum_slug, length(p.content_text) AS n FROM v_posts p LEFT JOIN persona q ON q.author = p.author JOIN k ON k.topic_slug = p.topic_slug),
    gs AS (SELECT CASE WHEN grouping(tier) = 0 THEN 'tier' WHEN grouping(engagement) = 0 THEN 'engagement' WHEN grouping(forum_slug) = 0 THEN 'forum_slug' ELSE 'total' END AS dimension,
           coalesce(tier, engagement, forum_slug, 'all') AS name, count(*) AS posts, coalesce(sum(n), 0)::BIGINT AS chars FROM cp GROUP BY GROUPING SETS ((tier), (engagement), (forum_slug), ()))"""


def _summary(spark, sf_dir):
    posts = curation.with_tier(views.posts(spark, sf_dir), curated._personas(spark, sf_dir))
    classes = curated._engagement(spark, sf_dir).select("topic_slug", "engagement")
    return curation.curation_summary(posts.join(classes, "topic_slug"), ["tier", "engagement", "forum_slug"])


@query(SUMMARY_SQL + " SELECT * FROM gs")
def curation_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query(SUMMARY_SQL + """
    SELECT '{"curation_version":"v1","total_posts":' || (SELECT posts FROM gs WHERE dimension = 'total')
        || ',"tier":{' || (SELECT string_agg('"' || name || '":' || posts, ',' ORDER BY name) FROM gs WHERE dimension = 'tier')
        || '},"engagement":{' || (SELECT string_agg('"' || name || '":' || posts, ',' ORDER BY name) FROM gs WHERE dimension = 'engagement') || '}}' AS document""")
def curation_document(spark, sf_dir):
    """The summary as one JSON document; forums, which may be many, stay rows."""
    return curation.summary_document(_summary(spark, sf_dir), ["tier", "engagement"], "v1")


@query(with_views("v_access") + """
    , d AS (SELECT min(ts)::DATE AS first, max(ts)::DATE - min(ts)::DATE AS days FROM v_access),
    marks AS (SELECT epoch(first + (days * k // 4)::INTEGER)::BIGINT AS snapshot, k FROM d, (SELECT unnest([1, 2, 3, 4]) AS k)),
    c AS (SELECT m.k, a.query_name AS forum_slug, count(*) AS topics_scraped FROM v_access a JOIN marks m ON epoch(a.ts::DATE) <= m.snapshot GROUP BY ALL)
    SELECT n.forum_slug, n.topics_scraped - coalesce(b.topics_scraped, 0) AS delta, b.forum_slug IS NULL AS is_new FROM c n LEFT JOIN c b ON b.forum_slug = n.forum_slug AND b.k = 3 WHERE n.k = 4""")
def coverage_history(spark, sf_dir):
    """Counts up to each quarter of the log's days are saved as snapshots; the last is compared with the latest before it."""
    log = views.access(spark, sf_dir)
    first, last = log.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    if first is None:
        return spark.createDataFrame([], "forum_slug string, delta long, is_new boolean")
    day, days = F.unix_timestamp(F.lit(first).cast("timestamp")), (last - first).days
    marks = [day + 86_400 * (days * k // 4) for k in (1, 2, 3, 4)]
    per_day = log.groupBy(F.unix_timestamp(F.to_date("ts").cast("timestamp")).alias("day"), F.col("query_name").alias("forum_slug")).agg(F.count(F.lit(1)).alias("n"))
    counts = per_day.select("forum_slug", "n", F.explode(F.filter(F.array(*marks), lambda m: m >= F.col("day"))).alias("snapshot")).groupBy("snapshot", "forum_slug").agg(F.sum("n").alias("topics_scraped"))
    target, schema = scratch(spark), "forum_slug string, topics_scraped long"
    store.save_snapshot(counts, target)
    end = spark.range(1).select(marks[-1]).first()[0]
    now = store.previous_snapshot(spark, target, end + 1, schema).drop("snapshot")
    return store.snapshot_change(now, target, end, schema)


@query("""
    WITH l AS (SELECT page_id, unnest(range(1, len(regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>')) + 1)) AS n, html FROM pages)
    SELECT page_id, n - 1 AS pos, regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1)[n] AS url, trim(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1)[n]) AS title FROM l""")
def page_menus(spark, sf_dir):
    """Items of the lists of pages."""
    return menus.list_items(table(spark, sf_dir, "pages")).select("page_id", F.col("pos").cast("long").alias("pos"), "url", "title")


@query("""
    SELECT 'documents' AS job, true AS success, unnest(['rows', 'words', 'without_text']) AS name,
           unnest([count(*), coalesce(sum(len(regexp_extract_all(text, '\\S+'))), 0)::BIGINT, count(*) FILTER (WHERE text IS NULL)]) AS value FROM documents""")
def run_ledger(spark, sf_dir):
    """Documents are written under a ledger that counts them on the way; its row is read back."""
    home = scratch(spark)
    counts = {"rows": F.count(F.lit(1)), "words": F.sum(word_count(F.col("text"))), "without_text": F.count_if(F.col("text").isNull())}
    ledger.logged(table(spark, sf_dir, "documents"), "documents", lambda df: df.write.parquet(f"{home}/documents"), f"{home}/runs", counts)
    return ledger.canonical(ledger.read_ledger(spark, f"{home}/runs")).select("job", "success", F.explode("counts").alias("name", "value"))


def _full_posts(spark, sf_dir):
    """Posts with times, lists and addresses; each fifth has only a raw time, each seventh none."""
    text = F.coalesce("content_text", F.lit(""))
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    n = F.col("conv_id") + F.col("turn")
    return views.posts(spark, sf_dir).withColumns({
        "parsed_iso": F.when((n % 5 != 0) & (n % 7 != 0), at), "raw_time": F.when(n % 7 != 0, F.concat(F.lit("at "), at)), "quotes": F.filter(blocks_of(text), lambda b: b["type"] == "quote"),
        "links": urls_of(text), "media": F.filter(urls_of(text), lambda u: u.rlike(r"\\.(png|jpg)$")), "source_url": F.concat(F.lit("https://forum.example.org/topic/"), "topic_slug", F.lit("#post-"), "post_id")})


FULL_SQL = with_views("v_posts") + """
    , u AS (SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS stamp, 'https://forum.example.org/topic/' || topic_slug || '#post-' || post_id AS source_url, coalesce(content_text, '') AS t, conv_id + turn AS n FROM v_posts),
    w AS (SELECT *, CASE WHEN n % 5 <> 0 AND n % 7 <> 0 THEN stamp END AS iso, CASE WHEN n % 7 <> 0 THEN 'at ' || stamp END AS raw,
          list_distinct(list_concat(regexp_extract_all(t, '\\[[^\\]]*\\]\\((https?://[^)\\s]+)\\)', 1), regexp_extract_all(t, 'https?://[^\\s)\\]<>"]+'))) AS links FROM u)"""


@query(FULL_SQL + f"""
    SELECT post_id, concat_ws(chr(10), '{reports.RULE}', 'POST ID: ' || post_id, 'AUTHOR: ' || coalesce(author, 'Unknown'), 'ROLE: ' || coalesce(role, 'N/A'), 'FORUM: ' || coalesce(forum_slug, 'N/A'),
           'TOPIC: ' || coalesce(topic_slug, 'N/A'), 'TIMESTAMP: ' || coalesce(iso, raw, 'N/A'), '{reports.RULE}', t) AS record FROM w""")
def post_export(spark, sf_dir):
    return reports.post_records(_full_posts(spark, sf_dir))


@query(FULL_SQL + f"""
    SELECT post_id, concat_ws(chr(10), 'POST ID: ' || post_id, 'TOPIC: ' || coalesce(topic_slug, 'N/A'), 'FORUM: ' || coalesce(forum_slug, 'N/A'), 'TIMESTAMP: ' || coalesce(iso, raw, 'N/A'), 'URL: ' || source_url,
           '{reports.RULE}', t) AS record FROM w WHERE contains(role, 'assist')""")
def role_export(spark, sf_dir):
    return reports.role_records(_full_posts(spark, sf_dir), "assist")


@query(FULL_SQL + """
    SELECT post_id, author, role, forum_slug, topic_slug, iso AS timestamp_iso, raw AS timestamp_raw, md5(t) AS text_md5, len(list_filter(list_filter(list_transform(string_split(t, chr(10) || chr(10)), lambda x: trim(x)), lambda x: x <> ''),
           lambda x: starts_with(x, '>') OR contains(x, 'wrote:')))::BIGINT AS num_quotes, len(links)::BIGINT AS num_links, len(list_filter(links, lambda x: regexp_matches(x, '\\.(png|jpg)$')))::BIGINT AS num_media, source_url FROM w""")
def csv_export(spark, sf_dir):
    """The twelve columns to CSV and back; what was empty comes back as null."""
    path, rows = scratch(spark), sinks.csv_rows(_full_posts(spark, sf_dir))
    sinks.write_csv(rows, path)
    back = sinks.read_csv(spark, path, rows.schema)
    return back.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in ("timestamp_iso", "timestamp_raw")}).withColumn("text_md5", F.md5(F.coalesce("content_text", F.lit("")).cast("binary"))).drop("content_text")


@query("""
    WITH p AS (SELECT page_id, page_id % 4 AS k, replace(replace(replace(replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&') AS title,
               regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/*$', 1) AS slug FROM pages)
    SELECT page_id, slug AS article_slug, CASE WHEN k = 3 THEN slug ELSE page_id::VARCHAR END AS article_id, trim(regexp_replace(title, '\\s+', ' ', 'g')) AS title, CASE WHEN k IN (1, 2) THEN 'Writer ' || page_id % 7 END AS author,
           CASE WHEN k IN (1, 2) THEN '2024-01-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') WHEN k = 0 THEN '2023-05-01' END AS date_published, CASE WHEN k = 1 THEN 'https://img.example.org/' || page_id || '.jpg' END AS image,
           CASE WHEN k = 0 THEN 'light,lens' ELSE '' END AS tags FROM p""")
def page_articles(spark, sf_dir):
    """Facts of pages, to which structured data is added by page: a graph, an object after a broken block, tags and a time, or none."""
    pages = table(spark, sf_dir, "pages")
    n, k = F.col("page_id"), F.col("page_id") % 4
    day, who = F.concat(F.lit("2024-01-"), F.lpad((n % 28 + 1).cast("string"), 2, "0")), F.concat(F.lit("Writer "), n % 7)
    image = F.concat(F.lit("https://img.example.org/"), n, F.lit(".jpg"))
    script = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    graph = F.concat(F.lit('{"@graph":[{"@type":"Person","name":"x"},{"@type":"Article","datePublished":"'), day, F.lit('","author":[{"name":"'), who, F.lit('"}],"image":{"url":"'), image, F.lit('"}}]}'))
    alone = F.concat(F.lit('{"datePublished":"'), day, F.lit('","author":{"name":"'), who, F.lit('"}}'))
    extra = F.when(k == 1, script(graph)).when(k == 2, F.concat(script(F.lit("{broken")), script(alone))).when(k == 0, F.lit('<a rel="tag" href="#">light</a><a href="#" rel="x tag"><b>lens</b></a><time class="entry-date updated" datetime="2023-05-01">May</time>')).otherwise("")
    body = F.when(k == 3, F.col("html")).otherwise(F.replace("html", F.lit("<body>"), F.concat(F.lit('<body class="single postid-'), n, F.lit('">'))))
    found = articles.article_facts(pages.withColumn("html", F.concat(body, extra)))
    return found.select("page_id", "article_slug", "article_id", "title", "author", "date_published", "image", F.array_join("tags", ",").alias("tags"))
