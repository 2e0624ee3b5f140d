"""Exact dedup by progressive refinement: length, then a prefix hash, then the full digest. DataFrame functions only.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest id
stays. Only rows that share their length with another row enter the prefix level, and only rows that share length and
prefix hash enter the digest level. Rows that share an id as well as a text are one document: exact_dedup, with a row for each,
marks all of them as kept, drop_exact_copies leaves one. A null id loses against any other; a group of null ids alone keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, joinable, materialize, once

KEYS = ["n_bytes", "prefix_hash"]


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text, lower-case hex."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = 256, digest_all: bool = True) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row, dropped ones too.

    digest_all=False computes digests of surviving groups only; other rows then have a null text_sha256. Their keys are
    broadcast if counted to be few, so that texts of other rows are dropped where they are read; else the join shuffles.
    With digest_all=True the digest of each row is part of the one scan. Hot groups: counts are aggregated map-side; the
    joins back are against counted small tables, or shuffle joins that AQE can split. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    keyed = base.select(
        "doc_id", "text",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.xxhash64(ascii_lower(F.substring("text", 1, prefix_chars))).alias("prefix_hash"),
    )
    digest = F.unhex(text_digest(F.col("text"))).alias("digest")
    rows = materialize(keyed.select("doc_id", *KEYS, *([digest] if digest_all else [])), "dedup-rows")

    lengths = rows.groupBy("n_bytes").count().filter("count > 1").select("n_bytes")
    level1 = rows.join(joinable(materialize(lengths, "dedup-lengths")), "n_bytes", "left_semi")
    candidates = materialize(level1.groupBy(*KEYS).count().filter("count > 1").select(*KEYS), "dedup-candidates")
    few = joinable(candidates)
    if digest_all:
        level2 = rows.join(few, KEYS, "left_semi")
    else:
        level2 = materialize(keyed.join(few, KEYS, "left_semi").select("doc_id", *KEYS, digest), "dedup-digests")
        rows = level2.unionByName(rows.join(few, KEYS, "left_anti").withColumn("digest", F.lit(None).cast("binary")))
    groups = level2.groupBy(*KEYS, "digest").agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id")).filter("group_size > 1")
    found = rows.join(joinable(materialize(groups, "dedup-groups")), [*KEYS, "digest"], "left")
    return found.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), True).otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the same columns; of equal texts the row with the largest id stays.

    Rows go by id and digest, so an id that stands for two texts loses the copied one only. Of rows that share id and text (a null
    id is one id here) one stays, any of them.
    """
    docs = once(docs, id_col, text_digest(F.col(text_col)))
    gone = exact_dedup(docs, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("_gone_id"), F.col("text_sha256").alias("_gone_digest"))
    gone = joinable(materialize(gone.distinct(), "dedup-gone"))
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]) & (text_digest(docs[text_col]) == gone["_gone_digest"]), "left_anti")
