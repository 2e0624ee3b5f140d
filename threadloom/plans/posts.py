"""Queries on posts, topics, articles and events: filters, joins, statistics, ordered lists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadloom.operators import posts as ops
from threadloom.sources import views
from threadloom.sources.views import table, with_views

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(with_views("v_posts") + """
    SELECT post_id, topic_slug, coalesce(author, 'Unknown') AS author, length(content_text) AS n_chars, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at
    FROM v_posts WHERE forum_slug = 'f1' AND role = 'user' AND position >= 2""")
def posts_projection_filter(spark, sf_dir):
    found = ops.search_posts(views.posts(spark, sf_dir), forum="f1", role="user").filter("position >= 2")
    return found.select("post_id", "topic_slug", F.coalesce("author", F.lit("Unknown")).alias("author"), F.char_length("content_text").alias("n_chars"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(with_views("v_posts") + " SELECT post_id, author FROM v_posts WHERE lower(author) LIKE '%assist%' AND length(content_text) > 300 AND NOT content_text LIKE '%&&&%'")
def author_like_flags(spark, sf_dir):
    flagged = views.posts(spark, sf_dir).withColumns({"is_long": F.char_length("content_text") > 300, "is_noise": F.col("content_text").contains("&&&")})
    return ops.search_posts(flagged, author_like="ASSIST", flags={"is_long": True, "is_noise": False}).select("post_id", "author")


@query("SELECT doc_id, source, n_chars FROM documents WHERE lower(text) LIKE '%licen%' OR lower(source) LIKE '%src13%'")
def article_substring_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.filter(F.lower("text").contains("licen") | F.lower("source").contains("src13")).select("doc_id", "source", "n_chars")


@query(with_views("v_posts") + """
    , w AS (SELECT post_id, string_split(content_text, ' ') AS words FROM v_posts)
    SELECT post_id, len(list_filter(words, lambda x: contains(lower(x), 'tion'))) > 0 AS any_tion, list_contains(words, 'the') AS has_the
    FROM w WHERE len(list_filter(words, lambda x: contains(lower(x), 'tion'))) > 0 OR list_contains(words, 'the')""")
def array_any_match_filter(spark, sf_dir):
    w = views.posts(spark, sf_dir).select("post_id", F.split("content_text", " ").alias("words"))
    any_, has = F.exists("words", lambda x: F.lower(x).contains("tion")), F.array_contains("words", "the")
    return w.filter(any_ | has).select("post_id", any_.alias("any_tion"), has.alias("has_the"))


@query(with_views("v_articles") + """
    SELECT doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'closed' WHEN quality IS NOT NULL THEN 'live' ELSE 'created' END AS status,
           CASE WHEN toxic = 1 THEN 'pipeline' WHEN n_chars > 100 AND text NOT LIKE '%Licensed%' THEN 'external' WHEN n_chars > 100 THEN 'placeholder' ELSE 'none' END AS transcript
    FROM v_articles WHERE quality IS NULL OR quality = 1""")
def status_case(spark, sf_dir):
    a = views.articles(spark, sf_dir).filter("quality is null or quality = 1")
    status = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "closed").when(F.col("quality").isNotNull(), "live").otherwise("created")
    long = F.col("n_chars") > 100
    transcript = F.when(F.col("toxic") == 1, "pipeline").when(long & ~F.col("text").contains("Licensed"), "external").when(long, "placeholder").otherwise("none")
    return a.select("doc_id", status.alias("status"), transcript.alias("transcript"))


@query("""
    WITH last AS (SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1)
    SELECT user_id, event_type = 'error' OR value < 10 AS force FROM last WHERE event_type IN ('error', 'click') OR value < 10 ORDER BY user_id LIMIT 50""")
def requeue_rule(spark, sf_dir):
    """The latest run of each episode decides whether it is queued again, and whether by force; a queue of 50 by name."""
    last = ops.latest_per_key(table(spark, sf_dir, "events"), ["user_id"], F.desc("ts"), F.desc("event_id"))
    force = (F.col("event_type") == "error") | (F.col("value") < 10)
    return last.filter(force | (F.col("event_type") == "click")).select("user_id", force.alias("force")).orderBy("user_id").limit(50)


HREF = 'href="([^"]*)"'


@query(f"""
    WITH l AS (SELECT DISTINCT unnest(regexp_extract_all(html, '{HREF}', 1)) AS href FROM pages)
    SELECT href FROM l WHERE starts_with(href, '/') AND length(href) > 3 AND NOT regexp_matches(href, '[,.]') AND href NOT IN ('/and', '/with')""")
def url_frontier(spark, sf_dir):
    """Links in scope, without skipped patterns, not yet visited (anti join)."""
    links = table(spark, sf_dir, "pages").select(F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href")).distinct()
    visited = spark.createDataFrame([("/and",), ("/with",)], "href string")
    return links.filter(F.col("href").startswith("/") & (F.char_length("href") > 3) & ~F.col("href").rlike("[,.]")).join(visited, "href", "left_anti")


@query("SELECT doc_id, CASE WHEN n_chars < 500 THEN 'short' ELSE 'unlabelled' END AS reason FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphan_anti_join(spark, sf_dir):
    rest = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")
    return rest.select("doc_id", F.when(F.col("n_chars") < 500, "short").otherwise("unlabelled").alias("reason"))


@query(with_views("v_topics") + """
    , l AS (SELECT topic_slug, unnest(post_ids) AS post_id, unnest(range(len(post_ids))) AS ordinal, post_ids[1] AS first FROM v_topics)
    SELECT l.topic_slug, l.ordinal, p.post_id, p.author, coalesce(s.author, 'Unknown') AS started_by, bool_or(p.author = 'assistant_0') OVER (PARTITION BY l.topic_slug) AS expert_topic
    FROM l JOIN v_posts p ON p.post_id = l.post_id LEFT JOIN v_posts s ON s.post_id = l.first""")
def topic_posts_join(spark, sf_dir):
    posts, topics = views.posts(spark, sf_dir), views.topics(spark, sf_dir)
    listed = ops.topic_posts(topics, posts)
    expert = listed.groupBy("topic_slug").agg(F.bool_or(F.col("author") == "assistant_0").alias("expert_topic"))
    return listed.join(ops.starters(topics, posts), "topic_slug").join(expert, "topic_slug").select("topic_slug", F.col("ordinal").cast("long"), "post_id", "author", "started_by", "expert_topic")


@query("""
    SELECT d.doc_id, d.lang, l.quality, l.toxic, coalesce(s.n, 0) AS siblings, s.langs
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    LEFT JOIN (SELECT source, count(*) AS n, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs FROM documents GROUP BY source) s ON s.source = d.source""")
def episode_assembly(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    by_source = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"))
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").join(by_source, "source", "left")
    return joined.select("doc_id", "lang", "quality", "toxic", F.coalesce("n", F.lit(0)).alias("siblings"), "langs")


@query("""
    WITH b AS (SELECT item_id, lower(regexp_replace(trim(split_part(text, '.', 1)), '\\s+', ' ', 'g')) AS k FROM benchmark),
    d AS (SELECT doc_id, lower(regexp_replace(trim(split_part(text, '.', 1)), '\\s+', ' ', 'g')) AS k FROM documents)
    SELECT d.k IS NOT NULL AND b.item_id IS NOT NULL AS matched, count(*) AS n, min(d.doc_id) AS first_doc FROM d LEFT JOIN b ON b.k = d.k GROUP BY 1""")
def normalised_title_match(spark, sf_dir):
    from threadloom.functions.text import title_key

    key = title_key(F.substring_index("text", ".", 1)).alias("k")
    titles = table(spark, sf_dir, "benchmark").select("item_id", key)
    found = table(spark, sf_dir, "documents").select("doc_id", key).join(titles, "k", "left")
    return found.groupBy(F.col("item_id").isNotNull().alias("matched")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))


@query(with_views("v_posts") + """
    SELECT count(*) AS posts, count(DISTINCT author) AS authors, count(DISTINCT forum_slug) AS forums, count(DISTINCT topic_slug) AS topics,
           sum(length(content_text))::BIGINT AS characters, (sum(length(content_text)) // count(*))::BIGINT AS mean_characters FROM v_posts""")
def corpus_stats(spark, sf_dir):
    return ops.corpus_stats(views.posts(spark, sf_dir))


@query(with_views("v_posts") + """
    SELECT forum_slug, count(*) AS posts, count(DISTINCT author) AS authors, count(*) FILTER (WHERE role = 'assistant') AS answers,
           count(*) FILTER (WHERE length(content_text) < 200) AS short FROM v_posts GROUP BY forum_slug""")
def index_stats(spark, sf_dir):
    return views.posts(spark, sf_dir).groupBy("forum_slug").agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("author").alias("authors"), F.count_if(F.col("role") == "assistant").alias("answers"),
        F.count_if(F.char_length("content_text") < 200).alias("short"))


@query(with_views("v_posts") + " SELECT author, count(*) AS n FROM v_posts GROUP BY author ORDER BY n DESC, author LIMIT 20")
def top_authors(spark, sf_dir):
    return ops.top_k(views.posts(spark, sf_dir).groupBy("author").agg(F.count(F.lit(1)).alias("n")), 20, F.desc("n"), "author")


@query(with_views("v_posts") + """
    SELECT post_id, author, (SELECT count(*) FROM v_posts) AS total, 75 + 25 < (SELECT count(*) FROM v_posts) AS has_more
    FROM v_posts ORDER BY ts DESC, post_id LIMIT 25 OFFSET 75""")
def paginate(spark, sf_dir):
    return ops.page_of(views.posts(spark, sf_dir).select("post_id", "author", "ts"), [F.desc("ts"), F.col("post_id")], page=4, limit=25).select("post_id", "author", "total", "has_more")


@query(with_views("v_posts") + " SELECT post_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM v_posts WHERE forum_slug = 'f2' AND content_text NOT LIKE '%&&&%' ORDER BY ts DESC, post_id LIMIT 30")
def recent_posts(spark, sf_dir):
    clean = views.posts(spark, sf_dir).filter((F.col("forum_slug") == "f2") & ~F.col("content_text").contains("&&&"))
    return ops.top_k(clean, 30, F.desc_nulls_last("ts"), "post_id").select("post_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events) WHERE r <= 5")
def topk_per_type(spark, sf_dir):
    top = Window.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return table(spark, sf_dir, "events").withColumn("r", F.row_number().over(top)).filter("r <= 5").select("event_type", "event_id", "value")


@query(with_views("v_topics") + " SELECT topic_slug, reply_count FROM v_topics ORDER BY reply_count DESC, topic_slug LIMIT 40")
def ordered_lists(spark, sf_dir):
    return ops.top_k(views.topics(spark, sf_dir).select("topic_slug", "reply_count"), 40, F.desc("reply_count"), "topic_slug")


@query(with_views("v_posts") + """
    , u AS (SELECT post_id AS id, 'post' AS kind, content_text AS body FROM v_posts UNION ALL
            SELECT 'a' || doc_id::VARCHAR, 'article', source || chr(10) || text FROM documents)
    SELECT kind, count(*) AS n, sum(length(body))::BIGINT AS characters, min(id) AS first_id FROM u GROUP BY kind""")
def unified_index_union(spark, sf_dir):
    posts = views.posts(spark, sf_dir).select(F.col("post_id").alias("id"), F.lit("post").alias("kind"), F.col("content_text").alias("body"))
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("a"), "doc_id").alias("id"), F.lit("article").alias("kind"), F.concat_ws("\n", "source", "text").alias("body"))
    both = posts.unionByName(docs, allowMissingColumns=True)
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.char_length("body")).alias("characters"), F.min("id").alias("first_id"))


@query(with_views("v_posts") + """
    , t AS (SELECT topic_slug, min_by(substr(content_text, 1, 60), position) FILTER (WHERE role = 'user') AS title, max(ts) AS updated, count(*) AS n_turns FROM v_posts GROUP BY topic_slug)
    SELECT topic_slug, title, strftime(updated, '%Y-%m-%d %H:%M:%S') AS updated, n_turns FROM t ORDER BY t.updated DESC, topic_slug LIMIT 50""")
def thread_list(spark, sf_dir):
    return ops.thread_list(views.posts(spark, sf_dir)).withColumn("updated", F.date_format("updated", "yyyy-MM-dd HH:mm:ss"))


@query("""
    WITH f AS (SELECT source, count(*) AS article_count, sum(n_chars)::BIGINT AS characters FROM documents GROUP BY source)
    SELECT f.source AS film_slug, upper(f.source) AS title, article_count, characters, d.doc_id AS ref FROM documents d JOIN f ON f.source = d.source""")
def films_from_articles(spark, sf_dir):
    """Films with their totals, a row for each article that refers to them: a film of any number of articles is no long list."""
    docs = table(spark, sf_dir, "documents").select(F.col("source").alias("film_slug"), F.col("doc_id").alias("ref"), "n_chars")
    films = docs.groupBy("film_slug").agg(F.upper(F.first("film_slug")).alias("title"), F.count(F.lit(1)).alias("article_count"), F.sum("n_chars").alias("characters"))
    return docs.drop("n_chars").join(films, "film_slug")


@query("""
    SELECT count(DISTINCT source) AS films, count(*) AS articles, sha256(string_agg(DISTINCT source, ',' ORDER BY source)) AS content_hash FROM documents""")
def articles_index(spark, sf_dir):
    """The hash is of the sorted distinct slugs: the order of rows has no say."""
    return table(spark, sf_dir, "documents").agg(
        F.count_distinct("source").alias("films"), F.count(F.lit(1)).alias("articles"), F.sha2(F.array_join(F.array_sort(F.collect_set("source")), ",").cast("binary"), 256).alias("content_hash"))


@query("SELECT doc_id, sha256(text) AS content_hash, md5(text) AS text_md5, substr(md5(source || '__' || doc_id::VARCHAR), 1, 12) AS file_key, source || '__' || doc_id::VARCHAR AS full_id FROM documents")
def content_hashes(spark, sf_dir):
    full = F.concat_ws("__", "source", "doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"), F.md5(F.col("text").cast("binary")).alias("text_md5"), F.substring(F.md5(full.cast("binary")), 1, 12).alias("file_key"), full.alias("full_id"))


@query(with_views("v_posts") + """
    SELECT topic_slug, string_agg(author, '>' ORDER BY turn) AS chain, max(len(string_split(content_text, ' '))) AS most_words,
           count(*) FILTER (WHERE len(string_split(content_text, ' ')) > 50) AS long_posts FROM v_posts GROUP BY topic_slug""")
def array_struct_shapes(spark, sf_dir):
    rows = F.array_sort(F.collect_list(F.struct("turn", "author", F.size(F.split("content_text", " ")).alias("words"))))
    shaped = views.posts(spark, sf_dir).groupBy("topic_slug").agg(rows.alias("rows"))
    return shaped.select("topic_slug", F.array_join(F.transform("rows", lambda r: r["author"]), ">").alias("chain"), F.array_max(F.transform("rows", lambda r: r["words"])).cast("long").alias("most_words"),
        F.size(F.filter("rows", lambda r: r["words"] > 50)).cast("long").alias("long_posts"))


@query("""
    SELECT event_type AS outcome, count(*) AS n, sum(value) IS NOT NULL AS timed, count(DISTINCT user_id) AS episodes,
           count(*) FILTER (WHERE value >= 50) AS slow FROM events GROUP BY event_type""")
def batch_totals(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("outcome")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").isNotNull().alias("timed"), F.count_distinct("user_id").alias("episodes"), F.count_if(F.col("value") >= 50).alias("slow"))


RUN_STATE = "CASE WHEN last(event_type ORDER BY ts, event_id) = 'purchase' THEN 'diarized' WHEN count(*) > 60 THEN 'transcribed_no_speakers' ELSE 'pending' END"


@query(f"SELECT user_id, {RUN_STATE} AS state, count(*) AS runs FROM events GROUP BY user_id")
def run_states(spark, sf_dir):
    last = F.max_by("event_type", F.struct("ts", "event_id"))
    state = F.when(last == "purchase", "diarized").when(F.count(F.lit(1)) > 60, "transcribed_no_speakers").otherwise("pending")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(state.alias("state"), F.count(F.lit(1)).alias("runs"))


@query(f"""
    WITH s AS (SELECT user_id, {RUN_STATE} AS state FROM events GROUP BY user_id)
    SELECT state, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM s), 6)::DOUBLE AS percent FROM s GROUP BY state""")
def run_report(spark, sf_dir):
    from threadloom.operators.curation import share_of_total

    return share_of_total(run_states(spark, sf_dir).groupBy("state").agg(F.count(F.lit(1)).alias("n")), "state").withColumn("percent", F.col("percent").cast("double"))


@query("""
    SELECT user_id AS episode_id, event_id AS run_id, r = 1 AS is_canonical FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE event_type <> 'error')""")
def latest_run_manifest(spark, sf_dir):
    order = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    runs = table(spark, sf_dir, "events").filter("event_type <> 'error'").dropDuplicates(["user_id", "event_id"])
    return runs.select(F.col("user_id").alias("episode_id"), F.col("event_id").alias("run_id"), (F.row_number().over(order) == 1).alias("is_canonical"))


@query("SELECT label AS speaker, count(*) AS segment_count, round(sum(embedding[1]), 4) AS first_sum FROM embeddings GROUP BY label")
def cluster_totals(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("speaker")).agg(F.count(F.lit(1)).alias("segment_count"), F.round(F.sum(F.col("embedding")[0].cast("double")), 4).alias("first_sum"))


@query("""
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings),
    e AS (SELECT label, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM s WHERE r <= 30)
    SELECT label AS speaker, i AS dimension, round(avg(v), 6) AS mean FROM e GROUP BY label, i""")
def cluster_centroids(spark, sf_dir):
    """Mean vectors of the first 30 turns of each speaker."""
    first = table(spark, sf_dir, "embeddings").withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))).filter("r <= 30")
    long = first.select(F.col("label").alias("speaker"), F.posexplode("embedding").alias("dimension", "v"))
    return long.groupBy("speaker", F.col("dimension").cast("long").alias("dimension")).agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("mean"))
