"""Helpers shared by the training-data operators: tables, the shared folder, small Column builders, files."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_FOLDER: dict[str, str] = {}
#: Spark removes the shuffle files of an execution when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of an Arrow batch that tasks hand to Python.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where that is unset (tests)."""
    sc = spark.sparkContext
    set_to = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if set_to:
        return set_to.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.applicationId not in _OWN_FOLDER:
        _OWN_FOLDER[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        sc.setCheckpointDir(_OWN_FOLDER[sc.applicationId])
    return _OWN_FOLDER[sc.applicationId]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str, batch: int | None = None) -> DataFrame:
    """Write df as a table in the shared folder and read it back: one computation, short lineage, survives lost executors. Its shuffles
    are not read again and leave the disk. Tables of long texts can name the rows of an Arrow batch, which a task holds several times."""
    spark, path = df.sparkSession, new_path(df.sparkSession, tag)
    held = {FREED: "true"} | ({BATCH: str(batch)} if batch else {})
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes Spark's fast path; other texts keep their non-ASCII letters."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def crc_remainder(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null ids count as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def small(df: DataFrame, rows: int) -> bool:
    """Has df at most so many rows? Reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def joinable(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """Broadcast df where it has been counted to be small; else leave the join to shuffle (and AQE to split skew)."""
    return F.broadcast(df) if small(df, rows) else df


def once(docs: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """docs with one row for each id and digest; null is an id like others. Only rows of ids that stand several times move, and equal
    ones meet map-side first; the ids are counted by a scan of their column alone."""
    again = docs.groupBy(F.col(id_col).alias("_again_id")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_again_id")
    again = materialize(again, "repeated-ids")
    if again.isEmpty():
        return docs
    known = joinable(again)
    alone = docs.join(known, docs[id_col].eqNullSafe(known["_again_id"]), "left_anti")
    marked = docs.withColumn("_once_digest", digest)
    several = marked.join(known, marked[id_col].eqNullSafe(known["_again_id"]), "left_semi").dropDuplicates([id_col, "_once_digest"])
    return alone.unionByName(several.drop("_once_digest"))


def bounded_sample(rows: DataFrame, most: int, label: str | None = None, by: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """At most `most` rows (of each label, if one is named), distinct in the columns `by`, chosen by a hash of these.

    A group of fewer distinct rows comes in whole, so no label is lost to copies. Rows are thinned where they are read, by approximate
    counts, and then ranked by their hash, which makes the bound a hard one. Adds the hash as `_h`.
    """
    from pyspark.sql import Window

    marked = rows.withColumns({"_h": F.xxhash64(F.lit("sample"), *by), "_k": F.col(label) if label else F.lit(0)})
    sizes = materialize(marked.groupBy("_k").agg(F.approx_count_distinct("_h", 0.02).alias("_size")), "sample-sizes")
    # A fifth more than wanted, for the error of the counts and of the thinning; the rank takes it off again.
    wanted = most * 1.2 + 50
    thin = marked.join(joinable(sizes), "_k").filter(F.pmod("_h", F.lit(1 << 40)).cast("double") * F.col("_size") < float(1 << 40) * wanted)
    one = thin.dropDuplicates(["_k", "_h"])
    return one.withColumn("_r", F.row_number().over(Window.partitionBy("_k").orderBy("_h"))).filter(F.col("_r") <= most).drop("_r", "_k", "_size")


def slices(batches, rows: int = 2000, text: str = "text", most: int = 16_000_000):
    """Arrow batches in slices of up to so many rows and bytes of text (one row at least), so that Python objects of whole
    texts exist for a few at a time."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        sizes = pc.binary_length(b.column(b.schema.get_field_index(text))).fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            n = max(1, min(rows, int(np.searchsorted(ends, before + most, side="right")) - at))
            yield b.slice(at, n)
            at += n


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI, for tasks that write files into the shared folder."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


@contextmanager
def new_file(uri: str):
    """A stream to write a file under a temporary name, moved into place at the end, so that a retried task leaves one good file."""
    system, path = filesystem(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part, compression=None) as out:
        yield out
    system.move(part, path)


def write_file(uri: str, content: bytes) -> None:
    with new_file(uri) as out:
        out.write(content)


def read_file(uri: str) -> bytes:
    system, path = filesystem(uri)
    with system.open_input_stream(path, compression=None) as source:
        return source.read()
