"""Text records, corpus statistics and reports of exports, curation, coverage and batches. Lists that grow with the corpus are rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import blocks_of, tokens, urls_of
from threadloom.sources.scratch import joinable

RULE = "=" * 80


def record(fields: list[tuple[str, Column]], text: Column, missing: str = "N/A", framed: bool = True) -> Column:
    """One text record: a line per field between rules, then the text. A null field shows as `missing`, a null text as empty."""
    heads = [F.concat(F.lit(f"{name}: "), F.coalesce(value.cast("string"), F.lit(missing))) for name, value in fields]
    return F.concat_ws("\n", *([F.lit(RULE)] if framed else []), *heads, F.lit(RULE), F.coalesce(text, F.lit("")))


def _time_field(posts: DataFrame) -> list[tuple[str, Column]]:
    known = [F.nullif(F.col(c), F.lit("")) for c in ("parsed_iso", "raw_time") if c in posts.columns]
    return [("TIMESTAMP", F.coalesce(*known))] if known else []


def post_records(posts: DataFrame) -> DataFrame:
    """(post_id, record) of all posts; with a TIMESTAMP line, the parsed time or the raw one, where posts have parsed_iso and raw_time."""
    fields = [("POST ID", F.col("post_id")), ("AUTHOR", F.coalesce("author", F.lit("Unknown"))), ("ROLE", F.col("role")), ("FORUM", F.col("forum_slug")), ("TOPIC", F.col("topic_slug"))]
    return posts.select("post_id", record(fields + _time_field(posts), F.col("content_text")).alias("record"))


def role_records(posts: DataFrame, name: str) -> DataFrame:
    """(post_id, record) of the posts whose role contains a name; a null role contains none. TIMESTAMP and URL lines
    where posts have parsed_iso or raw_time, and source_url."""
    fields = [("POST ID", F.col("post_id")), ("TOPIC", F.col("topic_slug")), ("FORUM", F.col("forum_slug")), *_time_field(posts), *([("URL", F.col("source_url"))] if "source_url" in posts.columns else [])]
    return posts.filter(F.col("role").contains(name)).select("post_id", record(fields, F.col("content_text"), framed=False).alias("record"))


def corpus_totals(posts: DataFrame) -> DataFrame:
    """One row: counts, distinct names, text length with its whole mean (0 without posts), sums of blocks, quotes and links."""
    text = F.coalesce("content_text", F.lit(""))
    blocks = blocks_of(text)
    sized = posts.select("author", "forum_slug", "topic_slug", F.char_length(text).alias("n"), F.size(blocks).alias("blocks"), F.size(F.filter(blocks, lambda b: b["type"] == "quote")).alias("quotes"), F.size(urls_of(text)).alias("links"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    rows = F.count(F.lit(1))
    return sized.agg(
        rows.alias("total_posts"), F.count_distinct("author").alias("unique_authors"), F.count_distinct("forum_slug").alias("unique_forums"), F.count_distinct("topic_slug").alias("unique_topics"),
        total("n").alias("total_text_length"), F.when(rows > 0, F.floor(F.sum("n") / rows)).otherwise(0).alias("average_post_length"),
        total("quotes").alias("total_quotes"), total("links").alias("total_links"), total("blocks").alias("total_content_blocks"))


def name_lists(posts: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(list, name, posts): each distinct name of the columns with its number of posts, by one map-side aggregation."""
    pairs = F.explode(F.array(*[F.struct(F.lit(label).alias("list"), F.col(c).alias("name")) for c, label in columns.items()]))
    return posts.select(pairs.alias("p")).select("p.*").filter("name is not null").groupBy("list", "name").agg(F.count(F.lit(1)).alias("posts"))


def coverage_span(topics: DataFrame, forums: DataFrame) -> DataFrame:
    """Per forum: name, scraped and known topics, first and last scrape.

    topics needs forum_slug, topic_slug, scraped_at; forums: forum_slug, name, total_topics. A forum that is not in `forums`
    is named by its slug in title case and has as many topics as were scraped; one without scraped topics has no row.
    """
    found = topics.groupBy("forum_slug").agg(F.count_distinct("topic_slug").alias("topics_scraped"), F.min("scraped_at").alias("first_scraped"), F.max("scraped_at").alias("last_scraped"))
    joined = found.join(forums, "forum_slug", "left")
    name = F.coalesce("name", F.initcap(F.replace("forum_slug", F.lit("-"), F.lit(" "))))
    return joined.select("forum_slug", name.alias("name"), "topics_scraped", F.coalesce("total_topics", "topics_scraped").alias("total_topics"), "first_scraped", "last_scraped")


def keyword_hits(keywords: DataFrame, texts: DataFrame, text: str) -> DataFrame:
    """(keyword, hits): texts that hold all words of a keyword, whatever its capitals. One join by word; without an index."""
    words = tokens(F.col("keyword"))
    asked = keywords.select("keyword", F.size(F.array_distinct(words)).alias("n"), F.explode(F.array_distinct(words)).alias("word")).distinct()
    numbered = texts.select(F.monotonically_increasing_id().alias("_row"), F.array_distinct(tokens(F.col(text))).alias("words"))
    there = numbered.select("_row", F.explode("words").alias("word"))
    met = there.join(joinable(asked), "word").groupBy("keyword", "n", "_row").agg(F.count(F.lit(1)).alias("met")).filter("met = n")
    return met.groupBy("keyword").agg(F.count(F.lit(1)).alias("hits"))


def question_report(questions: DataFrame, texts: DataFrame, key: str, text: str, forum: str, most: int = 1000, hits: DataFrame | None = None) -> DataFrame:
    """(name, hits, complete, note) of questions(name, keywords array, forums array, least).

    Keywords may have several words and capitals; a text with all words of a keyword is a hit. hits(keyword, hits) may come from a stored
    index (SearchIndex.hit_counts). Hits of a keyword count up to `most`. Complete: at least half of the required forums occur and hits
    reach `least`; the note names the missing forums first, in order, else the shortfall.
    """
    wanted = questions.select("name", F.explode("keywords").alias("keyword"))
    found = keyword_hits(wanted, texts, text) if hits is None else hits
    hits = wanted.join(found, "keyword", "left").groupBy("name").agg(F.sum(F.least(F.coalesce("hits", F.lit(0)), F.lit(most))).alias("hits"))
    there = texts.select(F.col(forum).alias("forum")).distinct().withColumn("there", F.lit(True))
    required = questions.select("name", F.explode("forums").alias("forum")).distinct().join(there, "forum", "left")
    forums = required.groupBy("name").agg(F.count(F.lit(1)).alias("required"), F.count("there").alias("available"), F.array_sort(F.collect_set(F.when(F.col("there").isNull(), F.col("forum")))).alias("missing"))
    joined = questions.select("name", "least").join(hits, "name", "left").join(forums, "name", "left").na.fill(0, ["hits", "required", "available"])
    complete = (F.col("available") * 2 >= F.col("required")) & (F.col("hits") >= F.col("least"))
    note = (
        F.when(complete, F.concat(F.lit("✓ "), F.col("hits"), F.lit(" relevant posts found")))
        .when(F.size("missing") > 0, F.concat(F.lit("⚠ Missing forums: "), F.array_join("missing", ", ")))
        .otherwise(F.concat(F.lit("⚠ Only "), F.col("hits"), F.lit("/"), F.col("least"), F.lit(" posts found")))
    )
    return joined.select("name", "hits", complete.alias("complete"), note.alias("note"))


def by_confidence(tags: DataFrame, key: list[str]) -> DataFrame:
    """(key..., classes) of each segment's classes from the highest confidence down, then by name; few by the dictionary."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "class")))
    return tags.groupBy(*key).agg(F.array_join(F.transform(ranked, lambda t: t["class"]), ",").alias("classes"))


def names_of(df: DataFrame, column: str, field: str) -> DataFrame:
    """An array of names, whether the column holds strings or structs with such a field. A null array is empty."""
    kind = df.schema[column].dataType.elementType.typeName()
    names = F.transform(column, lambda x: x[field]) if kind == "struct" else F.col(column)
    return df.withColumn(column, F.coalesce(names, F.array().cast("array<string>")))


def batch_report(runs: DataFrame, expected: DataFrame, key: str, failed: Column, done: Column) -> DataFrame:
    """(kind, key, runs) of a batch: 'result' per key with done runs, 'failure' per key with failed ones, 'gap' per expected key
    without a done run."""
    counts = runs.groupBy(key).agg(F.count_if(done).alias("done"), F.count_if(failed).alias("failed"))
    part = lambda rows, kind, n: rows.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.col(n).alias("runs"))
    gaps = expected.select(key).distinct().join(counts.filter("done > 0"), key, "left_anti").withColumn("n", F.lit(0).cast("long"))
    return reduce(DataFrame.unionByName, [part(counts.filter("done > 0"), "result", "done"), part(counts.filter("failed > 0"), "failure", "failed"), part(gaps, "gap", "n")])
