"""Reply trees as intervals: each post gets its place in depth-first order and the place of the last post below it.

The tour of a tree enters each post, visits its replies in order and leaves it. As a linked list of two entries a post it is ranked by
pointer jumping: each entry jumps to where its next one jumps and adds up what lies between, so a list of n entries takes log2(n) joins
of rows of fixed size, whatever the depth. Subtrees are then ranges of places, and "below" is a join by ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.threads import ROUNDS, on_cycles
from threadloom.sources.scratch import materialize


def rank_lists(links: DataFrame, *weights: str) -> DataFrame:
    """(at, end, weights...) of the entries of linked lists links(at, to, weights...): end is the last entry of the list (to is null
    there), a weight the sum from the entry to the end. `at` is unique; entries of circular lists are left out."""
    sums = list(weights)
    live = materialize(links.select("at", "to", F.when(F.col("to").isNull(), F.col("at")).alias("end"), *sums))
    done = live.filter("to is null")
    live = live.filter("to is not null")
    for _ in range(ROUNDS):
        then = done.unionByName(live).select(F.col("at").alias("to"), F.col("to").alias("to2"), F.col("end").alias("end2"), *[F.col(w).alias(f"{w}2") for w in sums])
        moved = materialize(live.join(then, "to").select("at", F.col("to2").alias("to"), F.col("end2").alias("end"), *[(F.col(w) + F.col(f"{w}2")).alias(w) for w in sums]))
        new = moved.filter("to is null")
        if new.isEmpty():  # each finite list ends a few more of its entries in every round
            return done.select("at", "end", *sums)
        done, live = done.unionByName(new), moved.filter("to is not null")
    raise RuntimeError(f"lists did not end in {ROUNDS} rounds")


def tree_intervals(posts: DataFrame) -> DataFrame:
    """(topic_slug, post_id, depth, first, last) of all posts that hang below their topic's root: `first` is the place in depth-first order
    from 0, `last` that of the last post below.

    posts needs topic_slug, post_id, parent_post_id, position, ts. The root is the first post by position without a parent, else the first
    post. Siblings go by position, ts and id, those without a position last. Of several rows of an id in a topic the one with the least
    position and parent counts. Orphans, cycles and rows without topic or id are no part of a tree.
    """
    place = F.coalesce("position", F.lit(999_999))
    rows = posts.filter("topic_slug is not null and post_id is not null").groupBy("topic_slug", "post_id").agg(
        F.min(F.struct(place.alias("place"), F.coalesce(F.col("ts").cast("string"), F.lit("")).alias("at"), "parent_post_id")).alias("x"))
    nodes = materialize(rows.select("topic_slug", "post_id", F.col("x.parent_post_id").alias("parent_post_id"), F.col("x.place").alias("place"), F.col("x.at").alias("ts"), F.monotonically_increasing_id().alias("node")))
    roots = nodes.groupBy("topic_slug").agg(F.min(F.struct(F.col("parent_post_id").isNotNull(), "place", "post_id", "node")).alias("r")).select("topic_slug", F.col("r.node").alias("root"))
    up = nodes.select("topic_slug", F.col("post_id").alias("parent_post_id"), F.col("node").alias("parent"))
    below = nodes.join(up, ["topic_slug", "parent_post_id"]).join(roots, "topic_slug").filter("node <> root")
    order = Window.partitionBy("parent").orderBy("place", "ts", "post_id")
    below = materialize(below.select("node", "parent", F.lead("node").over(order).alias("sibling"), F.row_number().over(order).alias("nth")))
    heads = below.filter("nth = 1").select(F.col("parent").alias("node"), F.col("node").alias("child"))
    enter = nodes.select("node").join(heads, "node", "left").select((F.col("node") * 2).alias("at"), F.coalesce(F.col("child") * 2, F.col("node") * 2 + 1).alias("to"), F.lit(1).cast("long").alias("posts"), F.lit(1).cast("long").alias("depth"))
    leave = nodes.select("node").join(below, "node", "left").select((F.col("node") * 2 + 1).alias("at"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("to"), F.lit(0).cast("long").alias("posts"), F.lit(-1).cast("long").alias("depth"))
    ranked = rank_lists(enter.unionByName(leave), "posts", "depth")
    half = ranked.select(F.floor(F.col("at") / 2).alias("node"), F.when(F.col("at") % 2 == 0, F.struct("posts", "depth")).alias("enter"), F.when(F.col("at") % 2 == 1, F.col("posts")).alias("after"), "end")
    both = half.groupBy("node").agg(F.max("enter").alias("enter"), F.max("after").alias("after"), F.min("end").alias("end"))
    kept = nodes.select("topic_slug", "post_id", "node").join(both, "node").join(roots, "topic_slug").filter(F.col("end") == F.col("root") * 2 + 1)
    kept = materialize(kept.select("topic_slug", "post_id", "node", "root", (-F.col("enter.depth")).cast("int").alias("depth"), F.col("enter.posts").alias("from_here"), "after"))
    total = kept.filter("node = root").select("topic_slug", F.col("from_here").alias("total"))
    return kept.join(total, "topic_slug").select("topic_slug", "post_id", "depth", (F.col("total") - F.col("from_here")).alias("first"), (F.col("total") - 1 - F.col("after")).alias("last"))


def within(ranges: DataFrame, points: DataFrame, key: str, at: str) -> DataFrame:
    """Join of ranges(key, first, last, ...) with points(key, at, ...) that lie in them, ends included, by equality only.

    A range is cut into aligned blocks of 2^k places, at most two of a size; a point meets the blocks that hold it, for the sizes that
    occur. A pair meets in exactly one block, so nothing but results is ever a row, however many ranges and points a key has.
    """
    levels = F.sequence(F.lit(0), F.floor(F.log2((F.col("last") - F.col("first") + 1).cast("double"))).cast("int"))

    def blocks(k):
        size = F.pow(F.lit(2.0), k)
        low, high = F.ceil(F.col("first") / size).cast("long"), F.floor((F.col("last") + 1) / size).cast("long")
        left, right = (low < high) & (low % 2 == 1), (low < high) & (high % 2 == 1)
        return F.array_compact(F.array(F.when(left, F.struct(k.alias("k"), low.alias("b"))), F.when(right, F.struct(k.alias("k"), (high - 1).alias("b")))))

    cut = materialize(ranges.filter("first <= last").withColumn("_block", F.explode(F.flatten(F.transform(levels, blocks)))))
    used = [r.k for r in cut.select("_block.k").distinct().collect()]  # at most 63 sizes
    sizes = F.array(*[F.lit(k) for k in sorted(used)]) if used else F.array().cast("array<int>")
    spread = points.withColumn("_block", F.explode(F.transform(sizes, lambda k: F.struct(k.alias("k"), F.floor(F.col(at) / F.pow(F.lit(2.0), k)).cast("long").alias("b")))))
    return cut.drop("first", "last").join(spread, [key, "_block"]).drop("_block")


def author_subtrees(tree: DataFrame, posts: DataFrame, name: str) -> DataFrame:
    """(root_id, post_id): posts whose author contains name, with everything below them; tree from tree_intervals."""
    named = tree.join(posts.filter(F.col("author").contains(name)).select("topic_slug", "post_id").distinct(), ["topic_slug", "post_id"])
    ranges = named.select("topic_slug", F.col("post_id").alias("root_id"), "first", "last")
    return within(ranges, tree.select("topic_slug", "post_id", F.col("first").alias("place")), "topic_slug", "place").select("root_id", "post_id")


def cycle_lists(posts: DataFrame) -> DataFrame:
    """(cycle_length, cycle): each cycle of parents once, as ids from its least one along the parents and back to it."""
    members = on_cycles(posts).select("post_id")
    links = posts.filter("parent_post_id is not null").groupBy("post_id").agg(F.min("parent_post_id").alias("parent")).join(members, "post_id", "left_semi")
    links = materialize(links)
    # The name of a cycle is its least id: a minimum over reaches that double until no name changes.
    walk = links.select("post_id", F.col("parent").alias("at"), F.col("post_id").alias("least"))
    for _ in range(ROUNDS):
        then = walk.select(F.col("post_id").alias("at"), F.col("at").alias("at2"), F.col("least").alias("least2"))
        new = materialize(walk.join(then, "at").select("post_id", F.col("at2").alias("at"), F.least("least", "least2").alias("least"), (F.col("least2") < F.col("least")).alias("lower")))
        walk = new.drop("lower")
        if new.filter("lower").isEmpty():
            break
    # Cut before the least id, the cycle is a list.
    cut = links.join(walk.select("post_id", "least"), "post_id").select(F.col("post_id").alias("at"), F.when(F.col("parent") != F.col("least"), F.col("parent")).alias("to"), F.lit(1).cast("long").alias("left"), "least")
    ranked = rank_lists(cut.select("at", "to", "left"), "left").join(cut.select("at", "least"), "at")
    ids = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("left")).alias("n"), "at"))), lambda x: x["at"])
    return ranked.groupBy("least").agg(F.count(F.lit(1)).cast("int").alias("cycle_length"), F.concat(ids, F.array(F.first("least"))).alias("cycle")).drop("least")
