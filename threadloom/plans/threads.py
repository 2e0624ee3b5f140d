"""Queries on reply trees and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators import intervals, quality
from threadloom.operators import threads as ops
from threadloom.sources import views
from threadloom.sources.views import with_views

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


TREE_SQL = """,
    nodes AS (SELECT topic_slug, post_id, parent_post_id, row_number() OVER (PARTITION BY topic_slug, parent_post_id ORDER BY position, ts, post_id) AS r FROM v_posts),
    tree AS (SELECT topic_slug, post_id, 0 AS depth, '' AS path FROM nodes WHERE parent_post_id IS NULL
             UNION ALL SELECT n.topic_slug, n.post_id, t.depth + 1, t.path || lpad(n.r::VARCHAR, 6, '0') || '.' FROM tree t JOIN nodes n ON n.topic_slug = t.topic_slug AND n.parent_post_id = t.post_id)"""


@query(with_views("v_posts", recursive=True) + TREE_SQL + " SELECT topic_slug, post_id, depth, path FROM tree")
def reply_tree(spark, sf_dir):
    return ops.reply_tree(views.posts(spark, sf_dir))


@query(with_views("v_posts", recursive=True) + TREE_SQL + " SELECT topic_slug, post_id, depth FROM tree")
def reply_tree_recursive(spark, sf_dir):
    return ops.reply_tree_sql(views.posts(spark, sf_dir))


@query(with_views("v_posts", recursive=True) + TREE_SQL + " SELECT topic_slug, count(*) AS total, count(*) - 1 AS replies, max(depth) AS max_depth FROM tree GROUP BY topic_slug")
def thread_stats(spark, sf_dir):
    return ops.thread_stats(intervals.tree_intervals(views.posts(spark, sf_dir)))


@query(with_views("v_posts", recursive=True) + TREE_SQL + """,
    placed AS (SELECT *, row_number() OVER (PARTITION BY topic_slug ORDER BY path) - 1 AS first FROM tree)
    SELECT p.topic_slug, p.post_id, p.depth, p.first, (SELECT max(b.first) FROM placed b WHERE b.topic_slug = p.topic_slug AND starts_with(b.path, p.path)) AS last FROM placed p""")
def tree_intervals(spark, sf_dir):
    return intervals.tree_intervals(views.posts(spark, sf_dir))


@query(with_views("v_posts", recursive=True) + TREE_SQL + """
    SELECT topic_slug, post_id, row_number() OVER (PARTITION BY topic_slug ORDER BY path) AS ordinal FROM tree""")
def rebuild_trees(spark, sf_dir):
    """Depth-first order of the topics that have no tree yet, which here are all."""
    return intervals.tree_intervals(views.posts(spark, sf_dir)).select("topic_slug", "post_id", (F.col("first") + 1).alias("ordinal"))


@query(with_views("v_posts") + """
    SELECT parent_post_id, post_id, row_number() OVER (PARTITION BY parent_post_id ORDER BY position, ts, post_id) AS ordinal FROM v_posts
    WHERE parent_post_id IN (SELECT post_id FROM v_posts WHERE author = 'user_0')""")
def direct_replies(spark, sf_dir):
    posts = views.posts(spark, sf_dir)
    return ops.direct_replies(posts, posts.filter("author = 'user_0'").select("post_id"))


@query(with_views("v_posts", recursive=True) + TREE_SQL + """
    SELECT r.post_id AS root_id, t.post_id FROM tree r JOIN v_posts p ON p.post_id = r.post_id JOIN tree t ON t.topic_slug = r.topic_slug AND starts_with(t.path, r.path) WHERE contains(p.author, 'assistant_1')""")
def author_subtrees(spark, sf_dir):
    posts = views.posts(spark, sf_dir)
    return intervals.author_subtrees(intervals.tree_intervals(posts), posts, "assistant_1")


FAULTY = """,
    bad AS (SELECT topic_slug, post_id, position, CASE WHEN conv_id % 10 = 3 AND turn = 1 THEN NULL ELSE author END AS author, CASE WHEN conv_id % 10 = 4 AND turn = 2 THEN ' ' ELSE content_text END AS content_text,
            CASE WHEN conv_id % 10 = 1 AND turn = 1 THEN conv_id::VARCHAR || '-3' WHEN conv_id % 10 = 2 AND turn = 1 THEN 'gone-' || conv_id::VARCHAR WHEN conv_id % 10 = 5 AND turn = 1 THEN post_id ELSE parent_post_id END AS parent_post_id FROM v_posts)"""


def _faulty(spark, sf_dir):
    """Posts with planted faults: cycles 1-3-1 in every tenth topic, dangling and self parents, blank texts, no author."""
    return views.posts(spark, sf_dir).selectExpr(
        "topic_slug", "post_id", "position", "case when conv_id % 10 = 3 and turn = 1 then null else author end as author", "case when conv_id % 10 = 4 and turn = 2 then ' ' else content_text end as content_text",
        "case when conv_id % 10 = 1 and turn = 1 then concat(conv_id, '-3') when conv_id % 10 = 2 and turn = 1 then concat('gone-', conv_id) when conv_id % 10 = 5 and turn = 1 then post_id else parent_post_id end as parent_post_id")


@query(with_views("v_posts", recursive=True) + FAULTY + """,
    walk AS (SELECT post_id AS start, parent_post_id AS up, 1 AS n FROM bad WHERE parent_post_id IS NOT NULL
             UNION ALL SELECT w.start, b.parent_post_id, w.n + 1 FROM walk w JOIN bad b ON b.post_id = w.up WHERE b.parent_post_id IS NOT NULL AND w.start <> w.up AND w.n < 20)
    SELECT start AS post_id, min(n) AS cycle_length FROM walk WHERE start = up GROUP BY start""")
def cycle_check(spark, sf_dir):
    return ops.on_cycles(_faulty(spark, sf_dir))


RINGS = """,
    ring AS (SELECT post_id, CASE WHEN turn > 0 THEN conv_id::VARCHAR || '-' || CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) THEN 1 ELSE turn + 1 END END AS parent_post_id FROM v_posts)"""


@query(with_views("v_posts", recursive=True) + RINGS + """,
    walk AS (SELECT post_id AS start, parent_post_id AS up, [post_id, parent_post_id] AS cycle FROM ring WHERE parent_post_id IS NOT NULL
             UNION ALL SELECT w.start, r.parent_post_id, list_append(w.cycle, r.parent_post_id) FROM walk w JOIN ring r ON r.post_id = w.up WHERE r.parent_post_id IS NOT NULL AND w.up > w.start)
    SELECT len(cycle)::INTEGER - 1 AS cycle_length, cycle FROM walk WHERE up = start""")
def cycle_lists(spark, sf_dir):
    """All replies of each topic in one ring: each names the next as its parent, the last the first."""
    posts = views.posts(spark, sf_dir)
    last = posts.groupBy("conv_id").agg(F.max("turn").alias("last"))
    after = F.when(F.col("turn") == F.col("last"), 1).otherwise(F.col("turn") + 1)
    ring = posts.join(last, "conv_id").withColumn("parent_post_id", F.when(F.col("turn") > 0, F.concat_ws("-", "conv_id", after)))
    return intervals.cycle_lists(ring)


@query(with_views("v_posts") + FAULTY + """
    SELECT 'warning' AS severity, 'empty_content' AS rule, post_id AS key FROM bad WHERE content_text IS NULL OR trim(content_text) = ''
    UNION ALL SELECT 'warning', 'missing_author', post_id FROM bad WHERE author IS NULL
    UNION ALL SELECT 'error', 'dangling_parent', post_id FROM bad b WHERE parent_post_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM bad x WHERE x.post_id = b.parent_post_id)
    UNION ALL SELECT 'error', 'self_parent', post_id FROM bad WHERE parent_post_id = post_id""")
def validate_posts(spark, sf_dir):
    return quality.validate_posts(_faulty(spark, sf_dir)).select("severity", "rule", "key")


def _faulty_topics(spark, sf_dir):
    return views.topics(spark, sf_dir).selectExpr(
        "topic_slug", "case when cast(topic_slug as bigint) % 7 = 1 then concat(post_ids, array('gone-9')) when cast(topic_slug as bigint) % 7 = 2 then slice(post_ids, 2, 100000) else post_ids end as post_ids",
        "case when cast(topic_slug as bigint) % 7 = 3 then reply_count + 5 else reply_count end as reply_count")


@query(with_views("v_topics", recursive=True) + FAULTY + """,
    t AS (SELECT topic_slug, CASE WHEN topic_slug::BIGINT % 7 = 1 THEN list_append(post_ids, 'gone-9') WHEN topic_slug::BIGINT % 7 = 2 THEN post_ids[2:] ELSE post_ids END AS post_ids,
                 CASE WHEN topic_slug::BIGINT % 7 = 3 THEN reply_count + 5 ELSE reply_count END AS reply_count FROM v_topics),
    l AS (SELECT topic_slug, unnest(post_ids) AS post_id FROM t),
    walk AS (SELECT topic_slug, post_id AS start, parent_post_id AS up, 1 AS n FROM bad WHERE parent_post_id IS NOT NULL
             UNION ALL SELECT w.topic_slug, w.start, b.parent_post_id, w.n + 1 FROM walk w JOIN bad b ON b.post_id = w.up WHERE b.parent_post_id IS NOT NULL AND w.start <> w.up AND w.n < 20),
    f AS (SELECT 'warning' AS severity, 'reply_count' AS rule, topic_slug AS key FROM t WHERE reply_count <> len(post_ids) - 1
          UNION ALL SELECT 'error', 'missing_post', topic_slug FROM (SELECT DISTINCT topic_slug FROM l WHERE post_id NOT IN (SELECT post_id FROM bad))
          UNION ALL SELECT 'warning', 'unlisted_post', topic_slug FROM (SELECT DISTINCT b.topic_slug FROM bad b WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.topic_slug = b.topic_slug AND l.post_id = b.post_id))
          UNION ALL SELECT 'error', 'cycle', topic_slug FROM (SELECT DISTINCT topic_slug FROM walk WHERE start = up))
    SELECT severity, rule, count(*) AS n, min(key) AS first_key FROM f GROUP BY severity, rule""")
def validate_topics(spark, sf_dir):
    found = quality.validate_topics(_faulty_topics(spark, sf_dir), _faulty(spark, sf_dir))
    return found.groupBy("severity", "rule").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"))
