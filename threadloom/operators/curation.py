"""Scores of authors, posts and topics, and the curated views built from them. Word lists are parameters (DataFrames or lists)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.text import contains_any, dictionary_hits, whole_days
from threadloom.sources.scratch import materialize


def points(value: Column, steps: list[tuple[float, int]], strict: bool = False) -> Column:
    """Points of the first bound reached (or passed, if strict); 0 below all."""
    out = F.lit(0)
    for bound, n in reversed(steps):
        out = F.when(value > bound if strict else value >= bound, n).otherwise(out)
    return out


def engagement(topics: DataFrame, posts: DataFrame, experts: list[str], low_chars: int = 100) -> DataFrame:
    """(topic_slug, forum_slug, reply_count, post_count, mean_chars, expert_replied, engagement) of each topic.

    One pass over the posts: mean_chars divides by the listed posts, so a missing post counts as empty.
    """
    listed = topics.select("topic_slug", "forum_slug", "reply_count", F.size("post_ids").alias("listed"), F.explode_outer("post_ids").alias("post_id"))
    joined = listed.join(posts.select("post_id", "author", F.char_length("content_text").alias("n")), "post_id", "left")
    found = joined.groupBy("topic_slug", "forum_slug", "reply_count", "listed").agg(
        F.count("author").alias("post_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("chars"), F.coalesce(F.bool_or(F.col("author").isin(experts)), F.lit(False)).alias("expert_replied"))
    mean = F.when(F.col("listed") > 0, F.col("chars") / F.col("listed")).otherwise(0.0)
    n = F.col("reply_count")
    kind = (
        F.when(n == 0, "zero").when(n == 1, "one").when(n == 2, "two")
        .when(n <= 5, F.when((mean < low_chars) & ~F.col("expert_replied"), "low").otherwise("medium"))
        .when(n <= 10, "medium").otherwise("high")
    )
    return found.select("topic_slug", "forum_slug", "reply_count", "post_count", mean.alias("mean_chars"), "expert_replied", kind.alias("engagement"))


def share_of_total(counts: DataFrame, by: str, n: str = "n") -> DataFrame:
    """counts with the share of the total; the total is one broadcast row, not a window over one partition."""
    total = counts.agg(F.sum(n).alias("_total"))
    return counts.join(F.broadcast(total)).select(by, n, F.round(F.col(n) * 100.0 / F.col("_total"), 6).alias("percent"))


def author_profiles(posts: DataFrame, topics: DataFrame, terms: DataFrame, phrases: list[str], experts: list[str]) -> DataFrame:
    """One row per author: volume, role, dictionary terms, phrases, topics with an expert reply, replies seen, day span.

    Two aggregations meet on the author: one over posts, one over distinct (author, topic). Hot authors are summed map-side.
    """
    hits = dictionary_hits(posts.filter("content_text is not null"), terms, ["post_id"], "content_text").groupBy("post_id").agg(F.sum("n").alias("terms"))
    low = F.lower("content_text")
    own = posts.join(hits, "post_id", "left").groupBy("author").agg(
        F.count(F.lit(1)).alias("post_count"), F.count_if(F.col("parent_post_id").isNull()).alias("started_topics"),
        F.sum(F.char_length("content_text")).alias("total_chars"), F.coalesce(F.sum("terms"), F.lit(0)).alias("term_count"),
        *[F.coalesce(F.bool_or(low.contains(p)), F.lit(False)).alias(f"_p{i}") for i, p in enumerate(phrases)],
        F.floor((F.unix_micros(F.max("ts")) - F.unix_micros(F.min("ts"))) / F.lit(86_400_000_000)).alias("span_days"),
    )
    roles = posts.groupBy("author", "role").count()
    role = roles.groupBy("author").agg(F.min(F.struct((-F.col("count")).alias("c"), "role")).alias("m")).select("author", F.col("m.role").alias("role"))
    pairs = posts.groupBy("author", "topic_slug").agg(F.lit(1).alias("one"))
    by_topic = posts.groupBy("topic_slug").agg(F.bool_or(F.col("author").isin(experts)).alias("expert"))
    seen = pairs.join(by_topic, "topic_slug").join(topics.select("topic_slug", "reply_count"), "topic_slug", "left").groupBy("author").agg(
        F.count_if("expert").alias("expert_topics"), F.avg("reply_count").alias("mean_replies"))
    named = F.array_join(F.array_compact(F.array(*[F.when(F.col(f"_p{i}"), F.lit(p)) for i, p in enumerate(phrases)])), ",") if phrases else F.lit("")
    return own.join(role, "author").join(seen, "author").select(
        "author", "role", "post_count", "started_topics", "total_chars", (F.col("total_chars") / F.col("post_count")).alias("mean_chars"), "term_count",
        (F.col("term_count") / F.col("post_count")).alias("terms_per_post"), named.alias("indicators"), "expert_topics", "mean_replies", "span_days")


def persona_scores(profiles: DataFrame, owner_role: str = "Keymaster", moderator_role: str = "Moderator") -> DataFrame:
    """Score 0 to 100 and tier of each author profile."""
    replies, rate = F.round("mean_replies", 2), F.round("terms_per_post", 2)
    base = (
        points(F.col("post_count"), [(50, 20), (20, 15), (10, 10), (5, 5)]) + points(replies, [(5, 15), (3, 10), (1, 5)], strict=True)
        + points(F.col("expert_topics"), [(5, 20), (2, 15), (1, 10)]) + F.least(rate * 5, F.lit(20.0)) + F.when(F.col("indicators") != "", 15).otherwise(0)
    )
    role = F.when(F.col("role") == owner_role, 100.0).when(F.col("role") == moderator_role, base + 15).otherwise(base)
    score = F.round(F.least(role + points(F.col("started_topics"), [(10, 10), (5, 5)]), F.lit(100.0)), 6)
    tier = F.when(score >= 90, "S").when(score >= 70, "A").when(score >= 50, "B").when(score >= 30, "C").otherwise("D")
    return profiles.withColumn("score", score).withColumn("tier", tier)


def housekeeping(posts: DataFrame, classes: dict[str, list[str]], weak: list[str], forums: list[str], authors: list[str], date_pattern: str, address_pattern: str, own_hosts: list[str]) -> DataFrame:
    """(post_id, forum_slug, score in hundredths, class, reasons): points for keyword classes, weak words, places, patterns.

    The input needs post_id, forum_slug, topic_slug, author, content_text. Scores are integers, so bounds are exact.
    """
    low, slug = F.lower(F.coalesce("content_text", F.lit(""))), F.lower(F.coalesce("topic_slug", F.lit("")))
    hit = {k: contains_any(low, ws) | contains_any(slug, ws) for k, ws in classes.items()}
    weak_n = sum((F.when(low.contains(w), 1).otherwise(0) for w in weak), F.lit(0))
    host = F.regexp_extract_all(low, F.lit(r"https?://([a-z0-9.-]+)"), F.lit(1))
    flags = {f"keyword:{k}": (c, 25) for k, c in hit.items()} | {
        "weak words": (weak_n >= 2, 15), "forum": (F.col("forum_slug").isin(forums), 20), "author": (F.col("author").isin(authors), 15),
        "date and address": (low.rlike(date_pattern) & low.rlike(address_pattern), 20),
    }
    on = lambda c: F.coalesce(c, F.lit(False))
    first = sum((F.when(on(c), n).otherwise(0) for c, n in flags.values()), F.lit(0))
    late = {"short": ((first > 0) & (F.char_length(low) < 200), 10), "external link": ((first > 0) & F.exists(host, lambda h: ~h.isin(own_hosts)), 10)}
    score = F.least(first + sum((F.when(on(c), n).otherwise(0) for c, n in late.values()), F.lit(0)), F.lit(100))
    reasons = F.array_join(F.array_compact(F.array(*[F.when(on(c), F.lit(k)) for k, (c, _) in (flags | late).items()])), ",")
    scored = posts.select("post_id", "forum_slug", score.alias("score"), reasons.alias("reasons"))
    kind = F.when(F.col("score") >= 50, "housekeeping").when(F.col("score") >= 30, "uncertain").otherwise("clean")
    return scored.withColumn("class", kind)


def first_category(text: Column, classes: list[tuple[str, list[str]]]) -> Column:
    """The first class with a keyword in the text; 'other' without one."""
    out = F.lit("other")
    for name, words in reversed(classes):
        out = F.when(contains_any(text, words), name).otherwise(out)
    return out


def buckets(topics: DataFrame, least: int = 5) -> DataFrame:
    """Categories of at least so many topics with their totals: (category, topics, replies, authors, forums).

    topics needs topic_slug, category, forum_slug, started_by, reply_count.
    """
    return topics.groupBy("category").agg(
        F.count(F.lit(1)).alias("topics"), F.sum("reply_count").alias("replies"), F.count_distinct("started_by").alias("authors"),
        F.array_join(F.array_sort(F.collect_set("forum_slug")), ",").alias("forums")).filter(F.col("topics") >= least)


def curated_posts(posts: DataFrame, flags: DataFrame, drop: list[str]) -> DataFrame:
    """Posts whose class (flags: post_id, class) is not one to drop; unflagged posts are clean."""
    return posts.join(flags.select("post_id", "class"), "post_id", "left").withColumn("class", F.coalesce("class", F.lit("clean"))).filter(~F.col("class").isin(drop))


def with_tier(posts: DataFrame, personas: DataFrame, default: str = "D") -> DataFrame:
    """Posts with the tier of their author; Spark broadcasts personas where their size allows."""
    return posts.join(personas.select("author", "tier", "score"), "author", "left").withColumn("tier", F.coalesce("tier", F.lit(default))).withColumn("score", F.coalesce("score", F.lit(0.0)))


def running_days(posts: DataFrame) -> DataFrame:
    """Whole days since the author's first post."""
    first = F.min("ts").over(Window.partitionBy("author"))
    return posts.select("post_id", "author", whole_days(first, F.col("ts")).alias("days"))


def curation_summary(posts: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, name, posts, chars) of each value of each dimension and of all posts ('total'), by one pass of grouping sets.

    A null value is named 'none'; without posts there is only the total with zeros.
    """
    rows = posts.select(*[F.coalesce(F.col(d).cast("string"), F.lit("none")).alias(d) for d in dimensions], F.char_length("content_text").alias("_n"))
    keys = [F.col(d) for d in dimensions]
    # The total comes from the least set: grouping sets give no row for an empty input.
    sets = rows.groupingSets([[k] for k in keys], *keys).agg(F.count(F.lit(1)).alias("posts"), F.coalesce(F.sum("_n"), F.lit(0)).alias("chars"), *[F.grouping(d).alias(f"_{d}") for d in dimensions])
    which = F.coalesce(*[F.when(F.col(f"_{d}") == 0, F.lit(d)) for d in dimensions])
    parts = materialize(sets.select(which.alias("dimension"), F.coalesce(*keys).alias("name"), "posts", "chars"))
    total = parts.filter(F.col("dimension") == dimensions[0]).agg(F.coalesce(F.sum("posts"), F.lit(0)).alias("posts"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"))
    return parts.unionByName(total.select(F.lit("total").alias("dimension"), F.lit("all").alias("name"), "posts", "chars"))


def summary_document(summary: DataFrame, dimensions: list[str], version: str) -> DataFrame:
    """One JSON document of a summary: the total and, for each of `dimensions` (of few values), the posts by name in order."""
    part = lambda d: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("dimension") == d, F.struct("name", "posts")))))
    total = F.coalesce(F.sum(F.when(F.col("dimension") == "total", F.col("posts"))), F.lit(0))
    found = summary.filter(F.col("dimension").isin("total", *dimensions)).agg(total.alias("total_posts"), *[part(d).alias(d) for d in dimensions])
    return found.select(F.to_json(F.struct(F.lit(version).alias("curation_version"), "total_posts", *dimensions)).alias("document"))


def persona_summary(personas: DataFrame, most: int = 20) -> DataFrame:
    """(kind, name, tier, score, post_count, expert_topics): a 'tier' row with the number of authors in post_count per tier, an 'author'
    row for each of the `most` best authors, by score, then name."""
    personas = materialize(personas.select("author", "tier", "score", "post_count", "expert_topics"))  # read twice
    tiers = personas.groupBy("tier").agg(F.count(F.lit(1)).alias("post_count"))
    best = personas.orderBy(F.desc("score"), "author").limit(most)
    nothing = lambda kind: F.lit(None).cast(kind)
    of_tiers = tiers.select(F.lit("tier").alias("kind"), F.col("tier").alias("name"), "tier", nothing("double").alias("score"), "post_count", nothing("long").alias("expert_topics"))
    of_authors = best.select(F.lit("author").alias("kind"), F.col("author").alias("name"), "tier", F.col("score").cast("double").alias("score"), F.col("post_count").cast("long").alias("post_count"), F.col("expert_topics").cast("long").alias("expert_topics"))
    return of_tiers.unionByName(of_authors)


def tier_authors(personas: DataFrame) -> DataFrame:
    """(tier, author, score, post_count, expert_topics, authors): the authors of each tier with the size of the tier. Written sorted by
    `write_tier_authors`; rows, so that a tier has no bound."""
    personas = materialize(personas.select("author", "tier", "score", "post_count", "expert_topics"))  # read twice
    sizes = personas.groupBy("tier").agg(F.count(F.lit(1)).alias("authors"))
    return personas.select("tier", "author", F.col("score").cast("double").alias("score"), "post_count", "expert_topics").join(sizes, "tier")


def write_tier_authors(authors: DataFrame, path: str) -> None:
    """JSON lines in a folder per tier, the best author first; a large tier is cut into files in order."""
    order = ["tier", F.desc("score"), "author"]
    authors.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("tier").json(path)
