"""Trees as intervals and cycles as lists, against walks in plain Python; a chain of 100,000 posts; ids with two parents."""

import random

from threadloom.operators import intervals, threads

SCHEMA = "topic_slug string, post_id string, parent_post_id string, position int, ts string, author string"


def walk(rows):
    """{(topic, id): (depth, first, last)} by depth-first visits."""
    out = {}
    for topic in {r[0] for r in rows if r[0] is not None}:
        own = {}
        for r in sorted((r for r in rows if r[0] == topic and r[1] is not None), key=lambda r: (999_999 if r[3] is None else r[3], r[4] or "", r[2] is not None, r[2] or "")):
            own.setdefault(r[1], r)
        order = sorted(own.values(), key=lambda r: (999_999 if r[3] is None else r[3], r[4] or "", r[1]))
        root = min(own.values(), key=lambda r: (r[2] is not None, 999_999 if r[3] is None else r[3], r[1]))
        children = {}
        for r in order:
            if r is not root:
                children.setdefault(r[2], []).append(r[1])
        stack, place = [(root[1], 0, False)], 0
        while stack:
            node, depth, left = stack.pop()
            if left:
                out[topic, node] = (*out[topic, node], place - 1)
                continue
            out[topic, node] = (depth, place)
            place += 1
            stack.append((node, depth, True))
            stack += [(c, depth + 1, False) for c in reversed(children.get(node, []))]
    return out


def random_rows(rng):
    rows = []
    for t in range(12):
        n = rng.randrange(1, 40)
        for i in range(n):
            parent = None if i == 0 and t % 3 else rng.choice([None, "gone", f"p{rng.randrange(n)}", f"p{rng.randrange(max(1, i))}", f"p{rng.randrange(max(1, i))}"])
            rows.append((f"t{t}", f"p{i}", parent, rng.choice([None, i, 3]), rng.choice([None, "2024"]), rng.choice("ab")))
    return rows + [("t1", "p0", None, 0, None, "a"), (None, "x", None, 0, None, "a"), ("t2", None, None, 0, None, "a")]


def test_intervals_against_visits(spark):
    for seed in range(2):
        rows = random_rows(random.Random(seed))
        posts = spark.createDataFrame(rows, SCHEMA)
        tree = intervals.tree_intervals(posts)
        want = walk(rows)
        assert {(r.topic_slug, r.post_id): (r.depth, r.first, r.last) for r in tree.collect()} == want
        named = {(r[0], r[1]) for r in rows if r[5] == "b"} & set(want)
        below = sorted((n, m[1]) for t, n in named for m in want if m[0] == t and want[t, n][1] <= want[m][1] <= want[t, n][2])
        assert sorted(map(tuple, intervals.author_subtrees(tree, posts, "b").collect())) == below
    assert intervals.tree_intervals(posts.limit(0)).count() == 0


def test_a_chain_of_100_000_posts(spark):
    chain = spark.range(100_000).selectExpr("'t' as topic_slug", "cast(id as string) as post_id", "case when id > 0 then cast(id - 1 as string) end as parent_post_id", "cast(id as int) as position", "cast(null as string) as ts", "case when id % 30000 = 29999 then 'x' else 'y' end as author")
    tree = intervals.tree_intervals(chain)
    assert tree.filter("first = depth and last = 99999 and post_id = cast(first as string)").count() == 100_000
    assert intervals.author_subtrees(tree, chain, "x").count() == 70_001 + 40_001 + 10_001


def test_ranges_and_points(spark):
    rng = random.Random(3)
    ranges = [(k % 3, a, a + rng.randrange(0, 200), k) for k in range(80) for a in [rng.randrange(300)]] + [(0, 5, 4, -1)]
    points = [(rng.randrange(3), rng.randrange(500)) for _ in range(200)]
    got = intervals.within(spark.createDataFrame(ranges, "key int, first long, last long, name int"), spark.createDataFrame(points, "key int, place long"), "key", "place")
    assert sorted((r["name"], r.place) for r in got.collect()) == sorted((n, p) for k, a, b, n in ranges for j, p in points if j == k and a <= p <= b)


def test_cycles_as_lists(spark):
    rows = [(f"c{i}", f"c{(i + 1) % 77}") for i in range(77)] + [("b", "a"), ("a", "b"), ("s", "s"), ("in", "a"), ("in2", "in"), ("free", None), ("orphan", "none")]
    got = {tuple(r.cycle): r.cycle_length for r in intervals.cycle_lists(spark.createDataFrame(rows, "post_id string, parent_post_id string")).collect()}
    assert got == {("a", "b", "a"): 2, ("s", "s"): 1, tuple(f"c{i}" for i in [*range(77), 0]): 77}


def test_an_id_with_two_parents_does_not_multiply_walkers(spark):
    rows = [("a", "b"), ("b", "a"), ("a", "c"), ("c", "a"), ("x0", "a")] + [(f"x{i}", f"x{i - 1}") for i in range(1, 200)]
    posts = spark.createDataFrame(rows, "post_id string, parent_post_id string")
    assert {(r.post_id, r.cycle_length) for r in threads.on_cycles(posts).collect()} == {("a", 2), ("b", 2)}
    assert [r.cycle for r in intervals.cycle_lists(posts).collect()] == [["a", "b", "a"]]
