"""Bundles: folders of documents for publishing, written by the tasks of a Spark job and completed by one commit.

Rows are lines of files: (file, pos, line). Tasks take ranges of (file, pos), so a file of any size is cut between tasks and none of them
holds more than a line. The commit gets a few names from each task: it joins the pieces of the files at the top (an index, a statistics
document) by copying blocks, renames files that one task wrote whole, numbers the pieces of the others and writes `manifest.json` last.
A bundle without a manifest is incomplete. Tasks write to names of their attempt and move them, so what a lost or failed
task leaves is removed with the folder of attempts.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

MANIFEST, ATTEMPTS = "manifest.json", "_attempts"
BLOCK = 1 << 20


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if "://" in path or path.startswith("file:"):
        if path.startswith("file:") and not path.startswith("file://"):
            path = "file://" + path[len("file:"):]
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _move(fs: pafs.FileSystem, old: str, new: str) -> None:
    if _exists(fs, new):
        fs.delete_file(new)
    fs.move(old, new)


def _safe(name: str | None) -> str:
    parts = (name or "").split("/")
    if any(p in ("", ".", "..") for p in parts) or parts[0] in (ATTEMPTS, MANIFEST):
        raise ValueError(f"not the name of a file in a bundle: {name!r}")
    return name


def _numbered(name: str, n: int) -> str:
    head, dot, tail = name.rpartition(".")
    return f"{head}-{n:05d}.{tail}" if dot and "/" not in tail else f"{name}-{n:05d}"


@dataclass
class TaskFiles(WriterCommitMessage):
    """What a task wrote: counts, and (file, piece) for those files that other tasks may hold lines of."""

    part: int
    files: int = 0
    lines: int = 0
    pieces: list[tuple[str, str]] = field(default_factory=list)


class BundleWriter(DataSourceArrowWriter):
    def __init__(self, path: str, arrays: list[str]):
        self.path, self.arrays = path, set(arrays)

    def _array(self, name: str) -> bool:
        return name.rpartition("/")[2] in self.arrays

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskFiles:
        task = TaskContext.get()
        fs, root = _open(self.path)
        own = f"{root}/{ATTEMPTS}/{task.partitionId()}-{task.taskAttemptId()}"
        fs.create_dir(own)
        found, out, name, first = TaskFiles(task.partitionId()), None, None, True

        def close(last: bool) -> None:
            nonlocal out, first
            if out is None:
                return
            if self._array(name):
                out.write(b"]")
            out.close()
            shared = first or last or "/" not in name
            target = f"{name}.piece-{found.part:06d}" if shared else name
            if "/" in target:
                fs.create_dir(f"{root}/{target.rpartition('/')[0]}")
            _move(fs, f"{own}/file", f"{root}/{target}")
            if shared:
                found.pieces.append((name, target))
            else:
                found.files += 1
            out, first = None, False

        for batch in iterator:
            for file, line in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()):
                fresh = out is None or file != name
                if fresh:
                    close(False)
                    name = _safe(file)
                    out = fs.open_output_stream(f"{own}/file")
                text = ("[" if fresh else ",\n") + ("null" if line is None else line) if self._array(name) else (line or "") + "\n"
                out.write(text.encode())
                found.lines += 1
        close(True)
        return found

    def _join(self, fs: pafs.FileSystem, root: str, name: str, pieces: list[str]) -> None:
        """Pieces of a file at the top as one file, by blocks."""
        array = self._array(name)
        with fs.open_output_stream(f"{root}/{ATTEMPTS}/joined") as out:
            out.write(b"[" if array else b"")
            for n, piece in enumerate(pieces):
                left = fs.get_file_info(f"{root}/{piece}").size
                with fs.open_input_stream(f"{root}/{piece}") as source:
                    if array:  # without its brackets
                        source.read(1)
                        left -= 2
                        out.write(b",\n" if n else b"")
                    while left > 0:
                        block = source.read(min(BLOCK, left))
                        if not block:
                            raise OSError(f"{piece} is shorter than its size")
                        out.write(block)
                        left -= len(block)
            out.write(b"]" if array else b"")
        _move(fs, f"{root}/{ATTEMPTS}/joined", f"{root}/{name}")
        for piece in pieces:
            fs.delete_file(f"{root}/{piece}")

    def commit(self, messages: list[TaskFiles | None]) -> None:
        fs, root = _open(self.path)
        fs.create_dir(f"{root}/{ATTEMPTS}")
        done = sorted((m for m in messages if m is not None), key=lambda m: m.part)
        pieces: dict[str, list[str]] = {}
        for m in done:
            for name, piece in m.pieces:
                pieces.setdefault(name, []).append(piece)
        split = {}
        for name, parts in pieces.items():
            if "/" not in name:
                self._join(fs, root, name, parts)
            elif len(parts) == 1:
                _move(fs, f"{root}/{parts[0]}", f"{root}/{name}")
            else:
                split[name] = [_numbered(name, n) for n in range(len(parts))]
                for piece, target in zip(parts, split[name]):
                    _move(fs, f"{root}/{piece}", f"{root}/{target}")
        for name in sorted(self.arrays):
            if name == "index.json" and name not in pieces:  # an index of nothing
                with fs.open_output_stream(f"{root}/{name}") as out:
                    out.write(b"[]")
        fs.delete_dir(f"{root}/{ATTEMPTS}")
        about = {"files": sum(m.files for m in done) + len(pieces), "lines": sum(m.lines for m in done), "split": split}
        with fs.open_output_stream(f"{root}/{MANIFEST}.new") as out:
            out.write(json.dumps(about, ensure_ascii=False).encode())
        _move(fs, f"{root}/{MANIFEST}.new", f"{root}/{MANIFEST}")

    def abort(self, messages: list[TaskFiles | None]) -> None:
        """The path was new, so all of it belongs to the failed job."""
        fs, root = _open(self.path)
        if _exists(fs, root):
            fs.delete_dir(root)


class BundleSource(DataSource):
    """Sink `bundle`: the option arrays lists base names of files, with commas; the path must be new."""

    @classmethod
    def name(cls) -> str:
        return "bundle"

    def writer(self, schema, overwrite: bool) -> BundleWriter:
        path = self.options["path"].rstrip("/")
        fs, root = _open(path)
        if _exists(fs, root):
            raise FileExistsError(f"a bundle needs a new path: {path}")
        return BundleWriter(path, [n for n in self.options.get("arrays", "").split(",") if n])


def write_bundle(rows: DataFrame, path: str, arrays: list[str] = ()) -> None:
    """Write rows(file, pos, line, and a string key if they have one) as a bundle at a new path.

    A file's lines follow pos, then key, then the line itself. Files whose base name is in `arrays` are JSON arrays with a line per item (a
    null line is null). A file at the top is always one file; any other that several tasks wrote stays in numbered pieces, named in
    the manifest. An index.json among `arrays` is written even without items. A null or unsafe file name fails the job, and a failed
    job leaves nothing.
    """
    rows.sparkSession.dataSource.register(BundleSource)
    order = ["file", "pos", *(["key"] if "key" in rows.columns else []), "line"]
    ordered = rows.orderBy(*order).select("file", "line")
    ordered.write.format("bundle").option("arrays", ",".join(arrays)).mode("append").save(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(files, lines, split) of a complete bundle; split maps a file to its pieces."""
    return spark.read.schema("files long, lines long, split map<string,array<string>>").json(f"{path}/{MANIFEST}")


def read_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of an array file. They stand on lines of their own, so a file of any size is read by ranges."""
    item = F.regexp_replace(F.regexp_replace("value", r"^\[", ""), r"[,\]]$", "")
    return spark.read.text(path).select(F.from_json(item, schema).alias("i")).filter("i is not null").select("i.*")


def read_lines(spark: SparkSession, path: str, base: str) -> DataFrame:
    """(file, value): lines of the files of a base name, whole or in pieces, one folder down; a piece goes by its file's name."""
    stem, _, kind = base.rpartition(".")
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"{stem}*.{kind}").text(path).select("value", F.url_decode("_metadata.file_path").alias("_path"))
    own = F.regexp_extract("_path", rf"([^/]+/{stem})(?:-\d{{5}})?\.{kind}$", 1)
    return found.select(F.concat(F.nullif(own, F.lit("")), F.lit("." + kind)).alias("file"), "value").filter("file is not null")


def read_named(files: DataFrame, path: str) -> DataFrame:
    """files(file, ...), a row per line (value) of these files of a complete bundle, without `file`; one that is not there has none.

    Files are opened by their names, pieces by the manifest's, so nothing is listed and a task reads many files, each as a stream.
    """
    spark = files.sparkSession
    split = read_manifest(spark, path).select(F.explode("split").alias("file", "_pieces"))
    named = files.join(F.broadcast(split), "file", "left").withColumn("_piece", F.explode(F.coalesce("_pieces", F.array("file")))).drop("file", "_pieces")
    others = [c for c in named.columns if c != "_piece"]
    schema = named.select(*others, F.lit("").alias("value")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(path)
        for b in batches:
            for n, piece in enumerate(b.column("_piece").to_pylist()):
                try:
                    source = io.BufferedReader(fs.open_input_stream(f"{root}/{piece}", compression=None), BLOCK)
                except FileNotFoundError:
                    continue
                with source:
                    while lines := source.readlines(BLOCK):
                        at = pa.array([n] * len(lines), pa.int64())
                        value = pa.array([x.removesuffix(b"\n").decode() for x in lines], pa.string())
                        yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in others], value], [*others, "value"])

    # A fixed number of partitions, as names are so small that all of them would be put into one task.
    return named.repartition(4 * spark.sparkContext.defaultParallelism, "_piece").select("_piece", *others).mapInArrow(run, schema)


def _json(*fields: str) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _line(rows: DataFrame, file: Column, pos: Column, line: Column) -> DataFrame:
    return rows.select(file.alias("file"), pos.cast("long").alias("pos"), line.alias("line"))


#: The fields of an index item.
INDEX_KEYS = ["slug", "title", "pubDate", "season", "episode", "duration", "hasTranscript", "canonicalRunId", "hasGoal", "reviewCoverage", "stats"]


def publish_episodes(episodes: DataFrame, chapters: DataFrame, segments: DataFrame, path: str) -> None:
    """index.json, newest first, and for each episode <slug>/meta.json, chapters.json and transcript.jsonl.

    episodes has a row per slug with the index's fields; other columns go to meta.json only. chapters and segments have slug and pos,
    and their other columns are the items; those of unknown episodes are left out. Slugs are escaped as in addresses. An item's place
    in the index is its place in a range sort, so no task sorts all episodes.
    """
    folder = F.url_encode("slug")
    placed = episodes.orderBy(F.desc_nulls_last("pubDate"), F.desc_nulls_last("episode"), "slug").withColumn("_place", F.monotonically_increasing_id())
    here = episodes.select("slug")

    def part(rows: DataFrame, base: str) -> DataFrame:
        return _line(rows.join(here, "slug", "left_semi"), F.concat(folder, F.lit("/" + base)), F.col("pos"), _json(*[c for c in rows.columns if c not in ("slug", "pos")]))

    index = _line(placed, F.lit("index.json"), F.col("_place"), _json(*INDEX_KEYS))
    meta = _line(episodes, F.concat(folder, F.lit("/meta.json")), F.lit(0), _json(*episodes.columns))
    write_bundle(reduce(DataFrame.unionByName, [index, meta, part(chapters, "chapters.json"), part(segments, "transcript.jsonl")]), path, ["index.json", "chapters.json"])


def publish_buckets(members: DataFrame, topics: DataFrame, path: str, stamp: str, curator: str = "automated-v1") -> None:
    """consolidated/<bucket>.jsonl, a topic per line; topics/<slug>.json with a `curation` member for each topic in a bucket;
    consolidation_summary.json, an item per bucket.

    members: bucket_id, bucket_name, topic_slug, forum_slug, started_by, reply_count; a topic in several buckets stays in the least.
    topics: topic_slug, document (a JSON object), a row per slug. A null started_by is no author.
    """
    members = members.groupBy("topic_slug").agg(F.min(F.struct("bucket_id", "bucket_name", "forum_slug", "started_by", "reply_count")).alias("m")).select("topic_slug", "m.*")
    files = _line(members, F.concat(F.lit("consolidated/"), F.url_encode("bucket_id"), F.lit(".jsonl")), F.lit(0), _json("topic_slug", "forum_slug", "started_by", "reply_count"))
    totals = members.groupBy("bucket_id", "bucket_name").agg(F.count(F.lit(1)).alias("topics_count"), F.count_distinct("started_by").alias("authors_count"), F.coalesce(F.sum("reply_count"), F.lit(0)).alias("replies"))
    summary = _line(totals, F.lit("consolidation_summary.json"), F.lit(0), _json("bucket_id", "bucket_name", "topics_count", "authors_count", "replies"))
    mark = F.to_json(F.struct(F.lit("consolidated_into").alias("consolidation_status"), F.col("bucket_id").alias("consolidated_bucket"), F.lit(stamp).alias("consolidated_at"), F.lit(curator).alias("curator")))
    head = F.regexp_replace("document", r"\s*\}\s*$", "")
    marked = F.concat(head, F.when(head.rlike(r"^\s*\{\s*$"), "").otherwise(","), F.lit('"curation":'), mark, F.lit("}"))
    back = _line(topics.join(members.select("topic_slug", "bucket_id"), "topic_slug"), F.concat(F.lit("topics/"), F.url_encode("topic_slug"), F.lit(".json")), F.lit(0), marked)
    write_bundle(reduce(DataFrame.unionByName, [files, summary, back]), path, ["consolidation_summary.json"])


def publish_statistics(totals: DataFrame, best: DataFrame, names: DataFrame, lists: list[str], path: str) -> None:
    """statistics.json: the row of totals, the best names (a ranked report of a few rows) and each list of names in order.

    totals: one row; best: name, posts; names: list, name, distinct within a list, null ones left out. A list is written as rows
    of the file, a name per line, so it has no bound; one without names is empty.
    """
    spark, n = totals.sparkSession, len(lists)
    named = names.filter("name is not null").filter(F.col("list").isin(lists)).select("list", "name")
    first = named.groupBy("list").agg(F.min("name").alias("name")).withColumn("first", F.lit(True))
    # Places: 0 the totals, 1 the best; for list i a head at 2 + 3i, its first name after it and its other names after that.
    head_of = F.create_map(*[F.lit(x) for i, name in enumerate(lists) for x in (name, 2 + 3 * i)]) if lists else F.lit(None)
    comma = F.when(F.col("first"), "").otherwise(",")
    items = named.join(first, ["list", "name"], "left").withColumn("first", F.coalesce("first", F.lit(False)))
    quoted = F.regexp_extract(F.to_json(F.array("name")), r"(?s)^\[(.*)\]$", 1)
    at = (head_of[F.col("list")] if lists else F.lit(0)) + F.when(F.col("first"), 1).otherwise(2)
    members = items.select(at.cast("long").alias("pos"), F.col("name").alias("key"), F.concat(comma, quoted).alias("line"))
    heads = [(2 + 3 * i, f'{"]" if i else ""},{json.dumps(name)}:[') for i, name in enumerate(lists)] + [(2 + 3 * n, "]}" if n else "}")]
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("posts")).alias("less"), "name", "posts")))
    top = best.agg(F.to_json(F.transform(ranked, lambda b: F.struct(b["name"].alias("name"), b["posts"].alias("posts")))).alias("line"))
    fixed = reduce(DataFrame.unionByName, [
        totals.select(F.lit(0).cast("long").alias("pos"), F.concat(F.lit('{"corpus_statistics":'), F.to_json(F.struct(*totals.columns))).alias("line")),
        top.select(F.lit(1).cast("long").alias("pos"), F.concat(F.lit(',"top_authors":'), "line").alias("line")),
        spark.createDataFrame(heads, "pos long, line string")])
    rows = fixed.withColumn("key", F.lit("")).unionByName(members)
    write_bundle(rows.withColumn("file", F.lit("statistics.json")), path)
