"""Reply trees as closure rows: (topic, node, depth, path), built by joins that double their reach, of any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.sources.scratch import materialize


#: Rounds of doubling: more than any table needs.
ROUNDS = 62


def reply_tree(posts: DataFrame) -> DataFrame:
    """(topic_slug, post_id, depth, path) of all posts that hang below their topic's root.

    posts needs topic_slug, post_id, parent_post_id, position, ts. The root is the first post by position without a
    parent, else the first post. path holds zero-padded sibling ranks, so its order is depth-first order. A child hangs
    only below a parent in its topic; orphans and cycles never join. Each round joins the posts whose jump ends in the tree
    and doubles the jumps of the others, so a tree of depth n takes log2(n) rounds; it ends when a round adds no post.
    """
    sibling = Window.partitionBy("topic_slug", "parent_post_id").orderBy(F.coalesce("position", F.lit(999_999)), F.coalesce(F.col("ts").cast("string"), F.lit("")), "post_id")
    nodes = posts.select("topic_slug", "post_id", "parent_post_id", "position", F.row_number().over(sibling).alias("rank"))
    first = Window.partitionBy("topic_slug").orderBy(F.col("parent_post_id").isNotNull(), F.coalesce("position", F.lit(999_999)), "post_id")
    marked = nodes.withColumn("n", F.row_number().over(first))
    marked = materialize(marked)
    tree = marked.filter("n = 1").select("topic_slug", "post_id", F.lit(0).alias("depth"), F.lit("").alias("path"))
    rank = F.col("rank").cast("string")
    step = F.concat(F.when(F.col("rank") < 1_000_000, F.lpad(rank, 6, "0")).otherwise(F.concat(F.lit("~"), F.lpad(rank, 12, "0"))), F.lit("."))
    jumps = marked.filter("n > 1 and parent_post_id is not null").select("topic_slug", "post_id", F.col("parent_post_id").alias("at"), F.lit(1).alias("far"), step.alias("steps"))
    for _ in range(ROUNDS):
        ends = tree.select("topic_slug", F.col("post_id").alias("at"), F.col("depth").alias("end_depth"), F.col("path").alias("end_path"))
        new = materialize(jumps.join(ends, ["topic_slug", "at"]).select("topic_slug", "post_id", (F.col("end_depth") + F.col("far")).alias("depth"), F.concat("end_path", "steps").alias("path")))
        if new.isEmpty():
            return tree
        tree = tree.unionByName(new)
        then = jumps.select("topic_slug", F.col("post_id").alias("at"), F.col("at").alias("at2"), F.col("far").alias("far2"), F.col("steps").alias("steps2"))
        rest = jumps.join(new.select("topic_slug", "post_id"), ["topic_slug", "post_id"], "left_anti").join(then, ["topic_slug", "at"])
        jumps = materialize(rest.select("topic_slug", "post_id", F.col("at2").alias("at"), (F.col("far") + F.col("far2")).alias("far"), F.concat("steps2", "steps").alias("steps")))
    raise RuntimeError(f"reply trees did not end in {ROUNDS} rounds")


def reply_tree_sql(posts: DataFrame) -> DataFrame:
    """The same rows by one recursive query; for threads within Spark's recursion limits."""
    spark = posts.sparkSession
    posts.select("topic_slug", "post_id", "parent_post_id", "position").createOrReplaceTempView("tree_nodes")
    return spark.sql("""
        WITH RECURSIVE tree(topic_slug, post_id, depth) AS (
            SELECT topic_slug, post_id, 0 FROM tree_nodes WHERE parent_post_id IS NULL
            UNION ALL
            SELECT n.topic_slug, n.post_id, t.depth + 1 FROM tree t JOIN tree_nodes n ON n.topic_slug = t.topic_slug AND n.parent_post_id = t.post_id)
        SELECT * FROM tree""")


def thread_stats(tree: DataFrame) -> DataFrame:
    return tree.groupBy("topic_slug").agg(F.count(F.lit(1)).alias("total"), (F.count(F.lit(1)) - 1).alias("replies"), F.max("depth").alias("max_depth"))


def direct_replies(posts: DataFrame, parents: DataFrame) -> DataFrame:
    """(parent_post_id, post_id, ordinal) of the replies to parents(post_id), in sibling order."""
    order = Window.partitionBy("parent_post_id").orderBy(F.coalesce("position", F.lit(999_999)), "ts", "post_id")
    found = posts.join(parents.select(F.col("post_id").alias("parent_post_id")), "parent_post_id", "left_semi")
    return found.select("parent_post_id", "post_id", F.row_number().over(order).alias("ordinal"))


def on_cycles(posts: DataFrame) -> DataFrame:
    """(post_id, cycle_length) of the posts whose parent chain comes back to themselves; cycles of any length.

    Posts that some post names as parent and that have a parent jump up by 1, 2, 4, ... parents; a post whose chain ends
    drops out. An id of several posts goes by the least of their parents. After as many steps as there can be such posts only cycles lead anywhere and each jump ends on one.
    """
    links = posts.filter("parent_post_id is not null").groupBy("post_id").agg(F.min("parent_post_id").alias("parent_post_id"))
    links = materialize(links)
    inner = links.join(links.select(F.col("parent_post_id").alias("post_id")).distinct(), "post_id", "left_semi")
    walk = materialize(inner.select(F.col("post_id").alias("start"), F.col("parent_post_id").alias("at"), F.col("post_id").alias("least")))
    reach, enough = 1, None
    for _ in range(ROUNDS):
        alive = walk.count()
        enough = min(enough or reach + alive, reach + alive)
        if not alive or reach >= enough:
            break
        then = walk.select(F.col("start").alias("at"), F.col("at").alias("at2"), F.col("least").alias("least2"))
        walk = materialize(walk.join(then, "at").select("start", F.col("at2").alias("at"), F.least("least", "least2").alias("least")))
        reach *= 2
    else:
        raise RuntimeError(f"parent chains did not end in {ROUNDS} rounds")
    # least is the smallest id on the way, which on a cycle names the cycle.
    cycle = walk.join(walk.select(F.col("at").alias("start")).distinct(), "start", "left_semi")
    sizes = cycle.groupBy("least").agg(F.count(F.lit(1)).cast("int").alias("cycle_length"))
    return cycle.join(sizes, "least").select(F.col("start").alias("post_id"), "cycle_length")
