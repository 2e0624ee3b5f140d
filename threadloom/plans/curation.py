"""Queries on author, post and topic scores, curated views, coverage and provenance."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadloom.operators import curation as ops
from threadloom.operators import quality
from threadloom.plans.search import HOLDS_SQL, keyword_hits
from threadloom.sources import views
from threadloom.sources.views import table, with_views

QUERIES, ORACLE_SQL = {}, {}
EXPERTS = ["assistant_0"]
#: Dictionaries use words of the data; users pass their own.
TERMS = ["than", "this", "der", "und", "les", "que", "for the", "en la"]
PHRASES = ["of the", "die der", "de la"]
CATEGORIES = [("german", ["sch", "keit"]), ("french", ["eau", "é"]), ("spanish", ["ción", "ñ"]), ("short", ["ing"])]
CLASSES = {"license": ["licensed under", "all rights"], "mail": ["@", "mailto"], "web": ["http", "www"], "noise": ["&&&", "%%%"], "digits": ["123", "555"], "german": ["keit", "ung "]}
WEAK = ["the ", "und ", "les ", "que "]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _any(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


ENGAGEMENT_SQL = """
    e AS (SELECT t.topic_slug, t.forum_slug, t.reply_count, count(p.author) AS post_count, coalesce(sum(length(p.content_text)), 0) / count(*)::DOUBLE AS mean_chars,
                 coalesce(bool_or(p.author = 'assistant_0'), FALSE) AS expert_replied
          FROM (SELECT topic_slug, forum_slug, reply_count, unnest(post_ids) AS post_id FROM v_topics) t LEFT JOIN v_posts p ON p.post_id = t.post_id GROUP BY 1, 2, 3),
    k AS (SELECT *, CASE WHEN reply_count = 0 THEN 'zero' WHEN reply_count = 1 THEN 'one' WHEN reply_count = 2 THEN 'two'
                 WHEN reply_count <= 5 THEN CASE WHEN mean_chars < 100 AND NOT expert_replied THEN 'low' ELSE 'medium' END
                 WHEN reply_count <= 10 THEN 'medium' ELSE 'high' END AS engagement FROM e)"""


def _engagement(spark, sf_dir):
    return ops.engagement(views.topics(spark, sf_dir), views.posts(spark, sf_dir), EXPERTS)


@query(with_views("v_topics") + "," + ENGAGEMENT_SQL + " SELECT engagement, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM k), 6)::DOUBLE AS percent FROM k GROUP BY engagement")
def engagement_class(spark, sf_dir):
    counts = _engagement(spark, sf_dir).groupBy("engagement").agg(F.count(F.lit(1)).alias("n"))
    return ops.share_of_total(counts, "engagement").withColumn("percent", F.col("percent").cast("double"))


@query(with_views("v_topics") + "," + ENGAGEMENT_SQL + " SELECT topic_slug, forum_slug, reply_count, post_count, round(mean_chars, 6) AS mean_chars, expert_replied, engagement FROM k")
def engagement_metrics(spark, sf_dir):
    return _engagement(spark, sf_dir).withColumn("mean_chars", F.round("mean_chars", 6))


def _count_words(text: str, terms) -> str:
    words = "regexp_extract_all(lower(" + text + "), '[a-z][a-z0-9''-]*[a-z0-9]|[a-z]')"
    one = [t for t in terms if " " not in t]
    two = [t for t in terms if " " in t]
    grams = f"list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])"
    return f"len(list_filter({words}, lambda x: list_contains({_list(one)}, x))) + len(list_filter({grams}, lambda x: list_contains({_list(two)}, x)))"


PROFILE_SQL = f"""
    own AS (SELECT author, count(*) AS post_count, count(*) FILTER (WHERE parent_post_id IS NULL) AS started_topics, sum(length(content_text))::BIGINT AS total_chars,
                   sum({_count_words("content_text", TERMS)})::BIGINT AS term_count,
                   {", ".join(f"bool_or(contains(lower(content_text), '{p}')) AS p{i}" for i, p in enumerate(PHRASES))},
                   datesub('day', min(ts), max(ts)) AS span_days FROM v_posts GROUP BY author),
    r AS (SELECT author, role FROM (SELECT author, role, row_number() OVER (PARTITION BY author ORDER BY count(*) DESC, role) AS n FROM v_posts GROUP BY author, role) WHERE n = 1),
    x AS (SELECT topic_slug, bool_or(author = 'assistant_0') AS expert FROM v_posts GROUP BY topic_slug),
    s AS (SELECT p.author, count(*) FILTER (WHERE x.expert) AS expert_topics, avg(t.reply_count) AS mean_replies
          FROM (SELECT DISTINCT author, topic_slug FROM v_posts) p JOIN x ON x.topic_slug = p.topic_slug LEFT JOIN v_topics t ON t.topic_slug = p.topic_slug GROUP BY p.author),
    prof AS (SELECT own.author, r.role, post_count, started_topics, total_chars, total_chars / post_count::DOUBLE AS mean_chars, term_count, term_count / post_count::DOUBLE AS terms_per_post,
          concat_ws(',', {", ".join(f"CASE WHEN p{i} THEN '{p}' END" for i, p in enumerate(PHRASES))}) AS indicators, expert_topics, mean_replies, span_days
          FROM own JOIN r ON r.author = own.author JOIN s ON s.author = own.author)"""


def _profiles(spark, sf_dir):
    terms = spark.createDataFrame([("technical", t) for t in TERMS], "kind string, keyword string")
    return ops.author_profiles(views.posts(spark, sf_dir), views.topics(spark, sf_dir), terms, PHRASES, EXPERTS)


@query(with_views("v_topics") + "," + PROFILE_SQL + """
    SELECT author, role, post_count, started_topics, total_chars, round(mean_chars, 6) AS mean_chars, term_count, round(terms_per_post, 6) AS terms_per_post, indicators,
           expert_topics, round(mean_replies, 6) AS mean_replies, span_days FROM prof""")
def author_profile(spark, sf_dir):
    p = _profiles(spark, sf_dir)
    return p.withColumns({c: F.round(c, 6) for c in ("mean_chars", "terms_per_post", "mean_replies")})


def _steps(value: str, steps, op: str = ">=") -> str:
    return "CASE " + " ".join(f"WHEN {value} {op} {b} THEN {n}" for b, n in steps) + " ELSE 0 END"


PERSONA_SQL = f"""
    pts AS (SELECT *, {_steps("post_count", [(50, 20), (20, 15), (10, 10), (5, 5)])} + {_steps("round(mean_replies, 2)", [(5, 15), (3, 10), (1, 5)], ">")}
                + {_steps("expert_topics", [(5, 20), (2, 15), (1, 10)])} + least(round(terms_per_post, 2) * 5, 20.0) + CASE WHEN indicators <> '' THEN 15 ELSE 0 END AS base FROM prof),
    sc AS (SELECT *, round(least(CASE WHEN role = 'system' THEN 100.0 WHEN role = 'user' THEN base + 15 ELSE base END + {_steps("started_topics", [(10, 10), (5, 5)])}, 100.0), 6)::DOUBLE AS score FROM pts),
    persona AS (SELECT *, CASE WHEN score >= 90 THEN 'S' WHEN score >= 70 THEN 'A' WHEN score >= 50 THEN 'B' WHEN score >= 30 THEN 'C' ELSE 'D' END AS tier FROM sc)"""


def _personas(spark, sf_dir):
    return ops.persona_scores(_profiles(spark, sf_dir), owner_role="system", moderator_role="user")


@query(with_views("v_topics") + "," + PROFILE_SQL + "," + PERSONA_SQL + " SELECT author, score, tier FROM persona")
def persona_score(spark, sf_dir):
    return _personas(spark, sf_dir).select("author", F.col("score").cast("double").alias("score"), "tier")


@query(with_views("v_topics") + "," + PROFILE_SQL + "," + PERSONA_SQL + " SELECT tier, count(*) AS authors, round(max(score), 6) AS best FROM persona GROUP BY tier")
def persona_distribution(spark, sf_dir):
    return _personas(spark, sf_dir).groupBy("tier").agg(F.count(F.lit(1)).alias("authors"), F.round(F.max("score"), 6).cast("double").alias("best"))


DATE, ADDRESS = r"\d{4}-\d{2}-\d{2}", r"\d+ (street|road|avenue)"
HOUSE_SQL = f"""
    hp AS (SELECT doc_id::VARCHAR AS post_id, source AS forum_slug, lang AS author, lower(coalesce(text, '')) AS low, lower(source) AS slug FROM documents),
    h1 AS (SELECT *, {" + ".join(f"CASE WHEN {_any('low', w)} OR {_any('slug', w)} THEN 25 ELSE 0 END" for w in CLASSES.values())}
            + CASE WHEN {" + ".join(f"contains(low, '{w}')::INT" for w in WEAK)} >= 2 THEN 15 ELSE 0 END + CASE WHEN forum_slug IN ('src3') THEN 20 ELSE 0 END
            + CASE WHEN author IN ('es') THEN 15 ELSE 0 END + CASE WHEN regexp_matches(low, '{DATE}') AND regexp_matches(low, '{ADDRESS}') THEN 20 ELSE 0 END AS first FROM hp),
    h2 AS (SELECT *, least(first + CASE WHEN first > 0 AND length(low) < 200 THEN 10 ELSE 0 END
            + CASE WHEN first > 0 AND len(list_filter(regexp_extract_all(low, 'https?://([a-z0-9.-]+)', 1), lambda h: h <> 'example.com')) > 0 THEN 10 ELSE 0 END, 100) AS score FROM h1),
    house AS (SELECT post_id, forum_slug, score, CASE WHEN score >= 50 THEN 'housekeeping' WHEN score >= 30 THEN 'uncertain' ELSE 'clean' END AS class FROM h2)"""


def _doc_posts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), F.col("source").alias("forum_slug"), F.col("source").alias("topic_slug"), F.col("lang").alias("author"), F.col("text").alias("content_text"))


def _house(spark, sf_dir):
    return ops.housekeeping(_doc_posts(spark, sf_dir), CLASSES, WEAK, ["src3"], ["es"], DATE, ADDRESS, ["example.com"])


@query("WITH" + HOUSE_SQL + " SELECT post_id, score, class FROM house")
def housekeeping_score(spark, sf_dir):
    return _house(spark, sf_dir).select("post_id", "score", "class")


@query("WITH" + HOUSE_SQL + " SELECT class, count(*) AS n, count(DISTINCT forum_slug) AS forums FROM house GROUP BY class")
def housekeeping_split(spark, sf_dir):
    return _house(spark, sf_dir).groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("forum_slug").alias("forums"))


@query("WITH" + HOUSE_SQL + " SELECT forum_slug, count(*) AS n FROM house WHERE class = 'housekeeping' GROUP BY forum_slug ORDER BY n DESC, forum_slug LIMIT 10")
def housekeeping_forums(spark, sf_dir):
    return _house(spark, sf_dir).filter("class = 'housekeeping'").groupBy("forum_slug").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "forum_slug").limit(10)


@query("WITH" + HOUSE_SQL + " SELECT d.doc_id::VARCHAR AS post_id, h.class FROM documents d JOIN house h ON h.post_id = d.doc_id::VARCHAR WHERE h.class <> 'housekeeping'")
def curated_posts(spark, sf_dir):
    return ops.curated_posts(_doc_posts(spark, sf_dir), _house(spark, sf_dir), ["housekeeping"]).select("post_id", "class")


@query(with_views("v_topics") + "," + PROFILE_SQL + "," + PERSONA_SQL + """
    SELECT coalesce(q.tier, 'D') AS tier, count(*) AS posts, count(DISTINCT p.author) AS authors, round(max(coalesce(q.score, 0)), 6) AS best
    FROM v_posts p LEFT JOIN (SELECT * FROM persona WHERE tier <> 'C') q ON q.author = p.author GROUP BY 1""")
def tier_view(spark, sf_dir):
    """Posts by author tier; authors without a persona (here those of tier C) count as D."""
    tiers = ops.with_tier(views.posts(spark, sf_dir), _personas(spark, sf_dir).filter("tier <> 'C'"))
    return tiers.groupBy("tier").agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("author").alias("authors"), F.round(F.max("score"), 6).cast("double").alias("best"))


CATEGORY_SQL = f"""
    c AS (SELECT t.topic_slug, t.forum_slug, t.reply_count, p.author AS started_by, lower(p.topic_slug || ' ' || substr(p.content_text, 1, 200)) AS head
          FROM v_topics t JOIN v_posts p ON p.post_id = t.post_ids[1]),
    cat AS (SELECT *, CASE {" ".join(f"WHEN {_any('head', w)} THEN '{k}'" for k, w in CATEGORIES)} ELSE 'other' END AS category FROM c)"""


def _categories(spark, sf_dir):
    posts, topics = views.posts(spark, sf_dir), views.topics(spark, sf_dir)
    first = topics.select("topic_slug", "forum_slug", "reply_count", F.try_element_at("post_ids", F.lit(1)).alias("post_id"))
    head = F.lower(F.concat_ws(" ", F.col("topic_slug"), F.substring("content_text", 1, 200)))
    joined = first.join(posts.select("post_id", F.col("author").alias("started_by"), "content_text"), "post_id")
    return joined.select("topic_slug", "forum_slug", "reply_count", "started_by", ops.first_category(head, CATEGORIES).alias("category"))


@query(with_views("v_topics") + "," + CATEGORY_SQL + " SELECT category, count(*) AS n FROM cat GROUP BY category")
def topic_category(spark, sf_dir):
    return _categories(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query(with_views("v_topics") + "," + CATEGORY_SQL + """
    SELECT category, count(*) AS topics, sum(reply_count)::BIGINT AS replies, count(DISTINCT started_by) AS authors, string_agg(DISTINCT forum_slug, ',' ORDER BY forum_slug) AS forums
    FROM cat GROUP BY category HAVING count(*) >= 5""")
def topic_buckets(spark, sf_dir):
    return ops.buckets(_categories(spark, sf_dir))


@query(with_views("v_topics") + "," + CATEGORY_SQL + """
    , b AS (SELECT category FROM cat GROUP BY category HAVING count(*) >= 5)
    SELECT cat.topic_slug, 'low-' || cat.category AS bucket_id FROM cat JOIN b ON b.category = cat.category""")
def bucket_back_references(spark, sf_dir):
    topics = _categories(spark, sf_dir)
    return topics.join(ops.buckets(topics).select("category"), "category").select("topic_slug", F.concat(F.lit("low-"), "category").alias("bucket_id"))


@query(with_views("v_topics") + "," + ENGAGEMENT_SQL + " SELECT p.post_id, k.reply_count FROM v_posts p JOIN k ON k.topic_slug = p.topic_slug WHERE k.reply_count >= 6")
def high_engagement(spark, sf_dir):
    top = _engagement(spark, sf_dir).filter("reply_count >= 6").select("topic_slug", "reply_count")
    return views.posts(spark, sf_dir).join(top, "topic_slug").select("post_id", "reply_count")


COVERAGE_SQL = """
    cov AS (SELECT forum_slug, count(DISTINCT topic_slug) AS topics_scraped, sum(len(post_ids))::BIGINT AS posts_scraped FROM v_topics WHERE topic_slug::BIGINT % 3 <> 0 GROUP BY forum_slug),
    meta AS (SELECT forum_slug, count(*) AS total_topics FROM v_topics WHERE forum_slug <> 'f4' GROUP BY forum_slug),
    report AS (SELECT cov.forum_slug, 'Forum ' || upper(cov.forum_slug) AS name, topics_scraped, posts_scraped, coalesce(meta.total_topics, topics_scraped) AS total_topics,
               round(CASE WHEN coalesce(meta.total_topics, topics_scraped) = 0 THEN 0 ELSE topics_scraped * 100.0 / coalesce(meta.total_topics, topics_scraped) END, 6)::DOUBLE AS percent
               FROM cov LEFT JOIN meta ON meta.forum_slug = cov.forum_slug)"""


def _coverage(spark, sf_dir):
    topics = views.topics(spark, sf_dir)
    totals = topics.filter("forum_slug <> 'f4'").groupBy("forum_slug").agg(F.count(F.lit(1)).alias("total_topics"))
    return quality.coverage(topics.filter("cast(topic_slug as bigint) % 3 <> 0"), totals)


@query(with_views("v_topics") + "," + COVERAGE_SQL + " SELECT forum_slug, topics_scraped, posts_scraped, total_topics, percent, percent >= 100 AS complete FROM report")
def coverage_report(spark, sf_dir):
    return _coverage(spark, sf_dir).select("forum_slug", "topics_scraped", "posts_scraped", "total_topics", F.col("percent").cast("double").alias("percent"), (F.col("percent") >= 100).alias("complete"))


@query(with_views("v_topics") + "," + COVERAGE_SQL + " SELECT count(*) AS forums, sum(topics_scraped)::BIGINT AS topics_scraped, sum(total_topics)::BIGINT AS total_topics, round(sum(topics_scraped) * 100.0 / sum(total_topics), 6)::DOUBLE AS percent FROM report")
def coverage_total(spark, sf_dir):
    return _coverage(spark, sf_dir).agg(F.count(F.lit(1)).alias("forums"), F.sum("topics_scraped").alias("topics_scraped"), F.sum("total_topics").alias("total_topics"),
        F.round(F.sum("topics_scraped") * 100.0 / F.sum("total_topics"), 6).cast("double").alias("percent"))


@query(with_views("v_topics") + """
    , now AS (SELECT forum_slug, count(*) AS topics_scraped FROM v_topics GROUP BY forum_slug),
    before AS (SELECT forum_slug, count(*) AS topics_scraped FROM v_topics WHERE topic_slug::BIGINT % 3 <> 0 AND forum_slug <> 'f2' GROUP BY forum_slug)
    SELECT now.forum_slug, now.topics_scraped - coalesce(before.topics_scraped, 0) AS delta, before.forum_slug IS NULL AS is_new FROM now LEFT JOIN before ON before.forum_slug = now.forum_slug""")
def coverage_delta(spark, sf_dir):
    topics = views.topics(spark, sf_dir)
    now = topics.groupBy("forum_slug").agg(F.count(F.lit(1)).alias("topics_scraped"))
    before = topics.filter("cast(topic_slug as bigint) % 3 <> 0 and forum_slug <> 'f2'").groupBy("forum_slug").agg(F.count(F.lit(1)).alias("topics_scraped"))
    return quality.coverage_delta(now, before)


@query(with_views("v_topics") + "," + COVERAGE_SQL + " SELECT forum_slug, total_topics - topics_scraped AS remaining FROM report ORDER BY percent, forum_slug LIMIT 5")
def coverage_ranking(spark, sf_dir):
    return _coverage(spark, sf_dir).orderBy("percent", "forum_slug").limit(5).select("forum_slug", (F.col("total_topics") - F.col("topics_scraped")).alias("remaining"))


@query("""
    WITH q AS (SELECT * FROM (VALUES ('q1', 'licensed', 3), ('q1', 'token', 3), ('q2', 'idiot', 2), ('q3', 'neverfound', 1), ('q4', 'Of The', 2), ('q4', 'IDIOT', 2)) AS t(name, keyword, least)),
    h AS (SELECT q.name, q.least, q.keyword, count(d.doc_id) AS hits FROM q LEFT JOIN documents d ON """ + HOLDS_SQL.format("q.keyword") + """ GROUP BY 1, 2, 3)
    SELECT name, sum(least(hits, 1000))::BIGINT AS hits, sum(least(hits, 1000)) >= max(least) AS enough FROM h GROUP BY name""")
def question_coverage(spark, sf_dir):
    """All keywords of all questions meet the words of the texts in one join; a keyword counts for 1,000 hits at most."""
    questions = spark.createDataFrame([("q1", "licensed", 3), ("q1", "token", 3), ("q2", "idiot", 2), ("q3", "neverfound", 1), ("q4", "Of The", 2), ("q4", "IDIOT", 2)], "name string, keyword string, least int")
    return quality.question_coverage(questions, keyword_hits(spark, sf_dir, questions))


@query(with_views("v_access") + """
    , o AS (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY ts, event_id) AS r FROM v_access)
    SELECT topic_id, count(*) AS accesses, string_agg(query_name, ',' ORDER BY r) FILTER (WHERE r <= 3) AS first_three FROM o GROUP BY topic_id HAVING count(*) > 1 ORDER BY accesses DESC, topic_id LIMIT 20""")
def provenance_multi_access(spark, sf_dir):
    return quality.multi_access(views.access(spark, sf_dir), 20)


@query(with_views("v_access") + """
    , m AS (SELECT min(ts)::DATE + ((max(ts)::DATE - min(ts)::DATE) // 100)::INTEGER AS day FROM v_access),
    b AS (SELECT DISTINCT topic_id, query_name FROM v_access, m WHERE ts::DATE <= m.day), a AS (SELECT DISTINCT topic_id, query_name FROM v_access, m WHERE ts::DATE > m.day)
    SELECT a.topic_id, a.query_name, b.topic_id IS NULL AS is_new FROM a LEFT JOIN b ON a.topic_id = b.topic_id AND a.query_name = b.query_name""")
def newly_scraped(spark, sf_dir):
    """Pairs of the log after a time boundary, a hundredth into its span, that did not occur up to it; each event is on one side."""
    log = views.access(spark, sf_dir)
    first, last = F.to_date(F.min("ts")), F.to_date(F.max("ts"))
    sides = log.join(F.broadcast(log.agg(F.date_add(first, F.floor(F.datediff(last, first) / 100).cast("int")).alias("day"))))
    late = F.to_date("ts") > F.col("day")
    before = sides.filter(~late).select("topic_id", "query_name").distinct().withColumn("known", F.lit(True))
    after = sides.filter(late).select("topic_id", "query_name").distinct()
    return after.join(before, ["topic_id", "query_name"], "left").select("topic_id", "query_name", F.col("known").isNull().alias("is_new"))


@query(with_views("v_access") + """
    , d AS (SELECT ts::DATE AS day, query_name, count(*) AS n FROM v_access GROUP BY ALL)
    SELECT strftime(day, '%Y-%m-%d') AS day, query_name, n, n - coalesce(lag(n) OVER (PARTITION BY query_name ORDER BY day), 0) AS delta FROM d""")
def snapshot_deltas(spark, sf_dir):
    """Change of each forum's count against its previous snapshot."""
    days = views.access(spark, sf_dir).groupBy(F.to_date("ts").alias("day"), "query_name").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.lag("n").over(Window.partitionBy("query_name").orderBy("day")), F.lit(0))
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "query_name", "n", (F.col("n") - before).alias("delta"))
