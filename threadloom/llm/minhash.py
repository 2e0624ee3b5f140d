"""Near copies by word shingles: an exact join by prefixes of shingle sets, each pair checked by the Jaccard similarity of whole sets.

The helper of simhash.near_duplicates for similarities that 3 bits of a SimHash can't reach. All sets are ordered alike: by how
common a shingle is in a sample of the documents, then by its hash, of which the smallest are the set's minima. Two sets of n
and m members with a similarity of t share at least t / (1 + t) (n + m) members, so their first common one, in that order, stands
in each set's first n - ceil(t n) + 1: these are filed. Any order finds all pairs; that of the sample keeps lists short.

Only components are asked for, so a bucket (the documents filed under one shingle) is linked without all of its pairs: its members
outside of a centre's component are checked against the centre, which then has met all others and leaves. The centre goes by a
hash of the document, so that a large group has few. When rounds add no link, or few pairs are left, all pairs of a bucket
that are still in different components are checked, so that no link is missed, however loose a group hangs together.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filesystem, joinable, materialize, new_path, slices, small
from .components import connected_components

#: One document in so many is sampled for the order of shingles; those that stand in COMMON of these come last, MOST of them at most.
SAMPLED, COMMON, MOST = 16, 4, 1_000_000
#: Rounds of centres after which all pairs left are checked, and the pairs left a member for which no round is run.
ROUNDS, FEW = 3, 16
#: Documents of a group that a task holds, and others that it checks against them.
HELD, SHARE = 256, 1000
#: Least bits of the marks of a set: the parity of its members by their last bits, so that sets differ in as many members as in bits, or more.
MARKS = 512
#: Similarities and counts are compared with this slack, as products of floats may lie above the whole number they stand for.
SLACK = 1e-9


def shingle_set(digests: np.ndarray) -> np.ndarray:
    """Sorted distinct 64-bit hashes of shingle digests; no words: one empty shingle."""
    return np.unique(digests.reshape(-1).view(">u8").astype(np.uint64)) if len(digests) else np.zeros(1, np.uint64)


def common_shingles(rows: DataFrame, width: int) -> str:
    """Writes (gram, n), the shingles that stand in several of a sample of rows(doc_id, text_hash, text), as files in the shared folder; their path."""
    from .simhash import shingle_digests

    def run(batches):
        for b in slices(batches, 500, most=2_000_000):
            grams = [shingle_set(shingle_digests(t or b"", width)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams).view(np.int64))], ["gram"])

    path = new_path(rows.sparkSession, "common-shingles")
    sampled = rows.filter(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SAMPLED)) == 0).select("text").mapInArrow(run, "gram long")
    several = sampled.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON)
    several.orderBy(F.desc("n"), "gram").limit(MOST).write.parquet(path)
    return path


@lru_cache(2)
def read_common(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(grams in ascending order, how often each stands in the sample)."""
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSelector

    system, folder = filesystem(path)
    files = sorted(f.path for f in system.get_file_info(FileSelector(folder)) if f.path.endswith(".parquet"))
    found = pa.concat_tables([pq.read_table(f, filesystem=system) for f in files])
    grams, n = found["gram"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(grams)
    return grams[order], n[order]


def prefix_keys(grams: np.ndarray, common: tuple[np.ndarray, np.ndarray], least: float) -> list[int]:
    """The first n - ceil(least n) + 1 of n shingles in ascending order, as signed longs: by their number in the sample, then by hash."""
    most, (known, n) = len(grams) - ceil(least * len(grams) - SLACK) + 1, common
    if len(known):
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        often = np.where(known[at] == grams, n[at], 0)
        grams = grams[np.argsort(often, kind="stable")]
    return grams[:most].view(np.int64).tolist()


def marks(grams: np.ndarray) -> list[int]:
    """The parity of a set's members by their last bits, as longs: MARKS bits, or as many as members up to the next power of two."""
    bits = max(MARKS, 1 << max(len(grams) - 1, 0).bit_length())
    return np.packbits(np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).view(np.int64).tolist()


def _possible(pairs: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """The pairs whose sizes allow the similarity and whose marks don't differ in more bits than such sets can differ in members. Marks of
    twice the length are folded; lengths further apart are left to the sets."""
    side = lambda c: signed.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("marks").alias(f"{c}_marks"))
    xor = lambda x, y: x.bitwiseXOR(y)
    size, half = F.size, lambda m: (F.size(m) / 2).cast("int")
    fit = lambda m, o: F.when(size(m) > size(o), F.zip_with(F.slice(m, 1, half(m)), F.slice(m, half(m) + 1, half(m)), xor)).otherwise(F.col(m))
    a, b = fit("a_marks", "b_marks"), fit("b_marks", "a_marks")
    apart = F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(xor(x, y))), F.lit(0), lambda acc, x: acc + x)
    most = (F.col("a_n") + F.col("b_n")) * F.lit((1 - least) / (1 + least)) + F.lit(SLACK)
    sized = F.least("a_n", "b_n") >= F.greatest("a_n", "b_n") * F.lit(least) - F.lit(SLACK)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(sized & ((size(a) != size(b)) | (apart <= most))).select("a", "b", "cell").distinct()


def similar(pairs: DataFrame, signed: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs(a, b) of nodes, of pairs(a, b, cell), whose shingle sets have a Jaccard similarity of `least` or more; signed(node, n, marks),
    texts(node, text).

    Each pair has one cell. Up to HELD nodes a of a cell stand before the nodes b that are checked against them, SHARE of these at
    once, and neither is copied to the pairs: a text, packed, moves once for each part of its cells and becomes a set there, as packed texts
    take about a third of their sets.
    """
    from .simhash import shingle_digests

    def pack(batches):
        for b in slices(batches, 500, most=4_000_000):
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([zlib.compress(t or b"") for t in b.column("text").to_pylist()], pa.binary())], ["node", "packed"])

    def run(batches):
        part, own, before = None, {}, None
        for b in slices(batches, 500, "packed", 1_000_000):
            left, right = [], []
            for *at, node, others, packed in zip(*(b.column(c).to_pylist() for c in ("cell", "row", "share", "node", "others", "packed")), strict=True):
                if (at, node, others) == before:  # equal rows are one document
                    continue
                before = (at, node, others)
                grams = shingle_set(shingle_digests(zlib.decompress(packed), width))
                if at != part:
                    part, own = at, {}
                if others is None:
                    own[node] = grams
                    continue
                for a in others:
                    n = len(own[a]) + len(grams)
                    both = len(np.intersect1d(own[a], grams, assume_unique=True)) if min(len(own[a]), len(grams)) * (1 + least) >= least * n - SLACK else 0
                    if both >= least * (n - both) - SLACK:
                        left.append(a), right.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    pairs = materialize(_possible(pairs, signed, least), "possible-pairs")
    few = small(pairs, 200_000)
    hinted = F.broadcast if few else lambda df: df
    parts = pairs.groupBy("cell").agg(*[F.ceil(F.approx_count_distinct(c) / most).cast("int").alias(name) for c, most, name in (("a", HELD, "rows"), ("b", SHARE, "shares"))])
    dealt = pairs.join(hinted(parts), "cell").withColumns({"row": F.pmod(F.xxhash64("a"), F.col("rows")).cast("int"), "share": F.pmod(F.xxhash64("b"), F.col("shares")).cast("int")})
    part = ["cell", "row", "share"]
    # Dealt by the node too, so that a large cell is no one task's.
    dealt = materialize(dealt.repartition(*part, "b").groupBy(*part, "b").agg(F.collect_list("a").alias("others")), "dealt-pairs")
    heads = dealt.select(*part, F.explode("others").alias("node")).distinct().withColumn("others", F.lit(None).cast("array<long>"))
    rows = materialize(heads.unionByName(dealt.withColumnRenamed("b", "node")), "dealt-rows")
    packed = texts.join(hinted(rows.select("node").distinct()), "node", "left_semi").mapInArrow(pack, "node long, packed binary")
    rows = packed.join(hinted(rows), "node").repartition(*part).sortWithinPartitions(*part, F.col("others").isNotNull(), "node")
    return materialize(rows.select(*part, "node", "others", "packed").mapInArrow(run, "a long, b long"), "similar-pairs", 1000)


def _can_be(x: tuple[str, str], y: tuple[str, str], least: float) -> Column:
    """Sets of such sizes and a first common shingle at such places can have the similarity."""
    both = F.ceil((F.col(x[0]) + F.col(y[0])) * F.lit(least / (1 + least)) - F.lit(SLACK))
    return (F.col(x[0]) - F.col(x[1]) >= both) & (F.col(y[0]) - F.col(y[1]) >= both)


def _stars(members: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(members without their buckets' centres, pairs(a, b, cell) of the centres and the members of other parts) of members(bucket, node, n,
    at, part); buckets of one part are left out."""
    order = F.xxhash64("node")
    centre = members.groupBy("bucket").agg(F.min_by(F.struct("node", "n", "at", "part"), order).alias("c"), F.min("part").alias("_low"), F.max("part").alias("_high"))
    centre = centre.filter("_low < _high").select("bucket", *[F.col(f"c.{c}").alias(f"centre_{c}") for c in ("node", "n", "at", "part")])
    centred = materialize(members.join(centre, "bucket").filter("node <> centre_node"), "band-members")
    pairs = centred.filter((F.col("part") != F.col("centre_part")) & _can_be(("n", "at"), ("centre_n", "centre_at"), least))
    return centred.select("bucket", "node", "n", "at", "part"), pairs.select(F.col("centre_node").alias("a"), F.col("node").alias("b"), F.col("centre_node").alias("cell")).distinct()


def _crossing(members: DataFrame, least: float) -> DataFrame:
    """All pairs(a, b, cell) of members of one bucket in different parts; the cell is the least bucket that brings the pair."""
    other = members.select("bucket", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "at", "part")])
    pairs = members.join(other, "bucket").filter((F.col("node") < F.col("node2")) & (F.col("part") != F.col("part2")) & _can_be(("n", "at"), ("n2", "at2"), least))
    return pairs.groupBy(F.col("node").alias("a"), F.col("node2").alias("b")).agg(F.min("bucket").alias("cell"))


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """parts with the links' components joined: only names of components are linked anew."""
    name = parts.select("node", F.col("component").alias("part"))
    named = links.join(name.withColumnsRenamed({"node": "a", "part": "pa"}), "a", "left").join(name.withColumnsRenamed({"node": "b", "part": "pb"}), "b", "left")
    joined = materialize(connected_components(named.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))), "band-joined").withColumnRenamed("node", "part")
    fresh = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct().join(parts, "node", "left_anti")
    ends = name.unionByName(fresh.withColumn("part", F.col("node")))
    return materialize(ends.join(joinable(joined), "part", "left").select("node", F.coalesce("component", "part").alias("component")), "band-parts")


def prefix_links(signed: DataFrame, texts: DataFrame, width: int, least: float, first: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have a near copy, among signed(node, n, keys, marks): the sizes of the shingle sets, the
    prefixes and marks of texts(node, text). first(a, b): candidates of other origin, checked with the first of the prefixes."""
    every = signed.select("node", "n", F.posexplode("keys").alias("at", "bucket"))
    # Most buckets hold one document; only the names of the others go on, so that the rows of the many never move with their columns.
    several = materialize(every.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("bucket"), "band-buckets")
    members = materialize(every.join(joinable(several), "bucket", "left_semi"), "band-members")
    rest, stars = _stars(members.withColumn("part", F.col("node")), least)
    stars = stars.unionByName(first.select("a", "b", F.col("a").alias("cell"))).distinct()
    parts = materialize(connected_components(similar(stars, signed, texts, width, least)), "band-parts")
    for i in range(ROUNDS + 1):
        rest = rest.drop("part").join(parts.select("node", F.col("component").alias("part")), "node", "left").withColumn("part", F.coalesce("part", "node"))
        by_part = rest.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("k")).groupBy("bucket").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("same")).filter("k * k > same")
        open_ = materialize(by_part, "open-buckets")
        held, left = open_.agg(F.coalesce(F.sum("k"), F.lit(0)), F.coalesce(F.sum((F.col("k") * F.col("k") - F.col("same")).cast("double")), F.lit(0.0)) / 2).first()
        if not held:
            break
        rest = materialize(rest.join(joinable(open_.select("bucket")), "bucket", "left_semi"), "band-members")
        if i < ROUNDS and left > FEW * held:
            rest, stars = _stars(rest, least)
            links = similar(stars, signed, texts, width, least)
            if not links.isEmpty():
                parts = _joined(parts, links)
                continue
        links = similar(_crossing(rest, least), signed, texts, width, least)
        if not links.isEmpty():
            parts = _joined(parts, links)
        break
    return parts
