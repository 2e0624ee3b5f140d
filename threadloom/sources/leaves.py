"""Scans of leaf files: posts, topics, episodes, segments, feeds, timed text, run history. Schemas are explicit, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators.posts import latest_per_key

POST = """ids struct<post_id:string,forum_slug:string,topic_slug:string,parent_post_id:string,position:int>, post_id string, forum_slug string, topic_slug string, parent_post_id string, position int,
 post_type string, author struct<display_name:string,role:string>, timestamps struct<raw:string,parsed_iso:string,parse_confidence:string>, content_text string,
 blocks array<struct<type:string,text:string>>, quotes array<struct<text:string,attributed_to:string>>, links array<struct<href:string,text:string,kind:string>>,
 title string, description string, integrity struct<content_hash:string,parser_version:string>, _corrupt_record string"""
TOPIC = "ids struct<forum_slug:string,topic_slug:string>, topic_url string, forum_slug string, topic_slug string, title string, post_ids array<string>, reply_count int, max_depth int, _corrupt_record string"
SEGMENT = """episode_id string, id int, start double, end double, text string, speaker string, segment_type string, chapter_id int, confidence double,
 topics array<struct<topic:string,confidence:double>>, films array<struct<film:string,confidence:double>>"""
RUN = "run_id string, transcribed_at string, whisper_model string, diarization boolean, speakers_detected int, success boolean"
FEED = """guid string, title string, pubDate string, description string, enclosure struct<_url:string,_length:long,_type:string>, `itunes:season` int, `itunes:episode` int, `itunes:duration` string,
 `podcast:transcript` array<struct<_url:string,_type:string>>"""


def tolerant(spark: SparkSession, path: str, schema: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their text): a broken file costs its own row only. The schema names _corrupt_record."""
    rows = spark.read.schema(schema).option("multiLine", not lines).option("mode", "PERMISSIVE").json(path).withColumn("_path", F.input_file_name())
    bad = F.col("_corrupt_record").isNotNull()
    # Spark refuses a scan of nothing but the corrupt record; the test on a hash of a field, always true, is one more column.
    field = next(c for c in rows.columns if not c.startswith("_"))
    return rows.filter(~bad).drop("_corrupt_record"), rows.filter(bad & (F.hash(field) >= -(2**31))).select("_path", "_corrupt_record")


def merged(df: DataFrame, *names: str) -> DataFrame:
    """Both generations of a leaf in one: a flat field, else the field of the nested ids."""
    return df.withColumns({n: F.coalesce(F.col(n), F.col(f"ids.{n}")) for n in names}).drop("ids")


def read_posts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    good, bad = tolerant(spark, path, POST)
    return merged(good, "post_id", "forum_slug", "topic_slug", "parent_post_id", "position"), bad


def read_topics(spark: SparkSession, path: str, lines: bool = True) -> tuple[DataFrame, DataFrame]:
    good, bad = tolerant(spark, path, TOPIC, lines)
    return merged(good, "forum_slug", "topic_slug"), bad


def by_key(df: DataFrame, **keys) -> DataFrame:
    """Point lookup; equality predicates reach Parquet's statistics."""
    for name, value in keys.items():
        df = df.filter(F.col(name) == value)
    return df


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON; malformed lines are skipped."""
    return spark.read.schema(SEGMENT).option("mode", "DROPMALFORMED").json(path)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of an RSS file as episodes; an item without an enclosure is skipped."""
    items = spark.read.format("xml").option("rowTag", "item").schema(FEED).load(path)
    named = F.regexp_extract("title", r"(?i)season\s+(\d+)", 1).try_cast("int")
    return items.filter("enclosure._url is not null").select(
        "guid", "title", F.col("pubDate").alias("pub_date_raw"), F.col("enclosure._url").alias("enclosure_url"), F.element_at(F.split("enclosure._url", "/"), -1).alias("enclosure_filename"),
        F.col("enclosure._length").alias("enclosure_length"), F.coalesce("itunes:season", named).alias("season"), F.col("itunes:episode").alias("episode"), F.col("itunes:duration").alias("duration"),
        F.transform(F.coalesce("podcast:transcript", F.array().cast("array<struct<_url:string,_type:string>>")), lambda t: F.create_map(F.lit("url"), t["_url"], F.lit("type"), t["_type"])).alias("podcast_transcripts"))


def timed_text(xml: Column, per_paragraph: bool = True) -> Column:
    """Text of a TTML document: paragraphs of joined words on lines, or all words joined."""
    plain = F.regexp_replace(xml, r'\sxmlns(:\w+)?="[^"]*"|(?<=<|</|\s)\w+:(?=\w)', "")
    if not per_paragraph:
        return F.array_join(F.xpath(plain, F.lit("//span/text()")), " ")
    n = F.xpath_int(plain, F.lit("count(//p)"))
    bodies = F.regexp_extract_all(plain, F.lit(r"(?s)<p[ >].*?</p>"), F.lit(0))
    lines = F.transform(bodies, lambda p: F.trim(F.regexp_replace(F.regexp_replace(p, "<[^>]*>", " "), r"\s+", " ")))
    return F.when(n > 0, F.array_join(lines, "\n"))


def timed_text_facts(xml: Column) -> Column:
    plain = F.regexp_replace(xml, r'\sxmlns(:\w+)?="[^"]*"|(?<=<|</|\s)\w+:(?=\w)', "")
    return F.struct(F.xpath_string(plain, F.lit("//body/@dur")).alias("duration"), F.xpath_string(plain, F.lit("/tt/@lang")).alias("language"), F.array_sort(F.array_distinct(F.xpath(plain, F.lit("//p/@agent")))).alias("agents"))


def read_runs(versioned: DataFrame, legacy: DataFrame) -> DataFrame:
    """Run history: versioned runs, and legacy rows of those episodes that have none."""
    old = legacy.join(versioned.select("episode_id").distinct(), "episode_id", "left_anti").withColumn("run_id", F.lit("legacy"))
    return versioned.unionByName(old, allowMissingColumns=True)


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Paths, sizes and times without reading contents."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")


def latest_reports(reports: DataFrame) -> DataFrame:
    return latest_per_key(reports, ["episode_id"], F.desc("path"))


def batch_failures(report: DataFrame) -> DataFrame:
    return report.select(F.explode("failures").alias("episode_id")).union(report.select(F.explode(F.filter("gaps", lambda g: g["has_audio"])).alias("g")).select("g.episode_id")).distinct()


def read_manifest(spark: SparkSession, path: str, field: str, item: str) -> DataFrame:
    """Rows of a manifest, a JSON document with an array of items under `field`; item is the DDL of a struct. A missing or broken array has none."""
    found = spark.read.schema(f"{field} array<struct<{item}>>").option("multiLine", True).json(path)
    return found.select(F.explode(field).alias("i")).select("i.*")


def named_leaves(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Leaves of a folder of JSON files with their `leaf_id`, the file name without .json; a broken file has null fields."""
    found = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
    return found.withColumn("leaf_id", F.url_decode(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)))


def leaf_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(leaf_id) of a folder, from the file list alone; join with it to ask which leaves exist."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select("path")
    return files.select(F.regexp_extract("path", r"([^/]+)\.json$", 1).alias("leaf_id"))
