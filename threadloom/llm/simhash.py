"""SimHash near-dedup: 64-bit fingerprints, a byte-position inverted index with count filtering, then exact verification.

Two fingerprints at most 3 bits apart differ in at most 3 of their 8 bytes, so they share at least 5 positional bytes. The
index files each distinct fingerprint under its positional bytes, some at a time: a posting list holds the fingerprints
with the same bytes at `depth` given positions, for each choice of positions. (Lists of one positional byte hold a 256th of
all fingerprints, and their pairs grow with the square of the input; depth grows with the number of fingerprints, so that
chance lists stay short.) The lists that a pair shares are counted: k equal bytes give C(k, depth) of them. Pairs that
reach the minimum, C(5, depth), are verified by their bits.

Posting lists over `hot` members are refined: their members, as a table of their own, are filed under five positions at
once, where one shared list is the minimum; members of lists over 4 * `hot` of those differ in 24 bits only and are filed again,
under five of these bits' eight groups of three. Such a list holds at most 2^9 fingerprints, so pairs grow with the members
of long lists and not with their square. No pair is lost and none is capped.

near_duplicates is the general form for word shingles of any width and a Jaccard similarity: fingerprints give the closest
candidates, a join by prefixes of shingle sets (minhash.py) all that the distance of 3 bits can't reach, and each pair is checked.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import joinable, materialize, once, slices
from .components import connected_components

BITS, BYTES = 3, 8
LEAST_EQUAL = BYTES - BITS
TRIPLES = list(combinations(range(BYTES), 3))


def index_depth(n: int) -> int:
    """Positional bytes of a posting for n distinct fingerprints: chance lists stay under a quarter of a member on average."""
    return 3 if n <= 1 << 22 else 4 if n <= 1 << 30 else 5


def shingle_digests(data: bytes, width: int) -> np.ndarray:
    """XXH64 digests (rows of 8 bytes) of the word shingles, repeats included: words are split at ASCII white space, A-Z
    lower-cased; a text of fewer words is one shingle, one without words has none."""
    import xxhash

    words = data.lower().split()
    if not words:
        return np.zeros((0, 8), np.uint8)
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - width + 1)
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(flat[s:e], 42) for s, e in zip(starts[:n].tolist(), (ends[len(words) - n :] - 1).tolist(), strict=True)])
    return np.frombuffer(hashes, np.uint8).reshape(-1, 8)


def majority(rows: np.ndarray) -> int:
    """The fingerprint, as a signed long, of shingle digests: bits set in over half of them; none: zero."""
    ones = sum((np.unpackbits(rows[i : i + 65536], axis=1).sum(0, dtype=np.int64) for i in range(0, len(rows), 65536)), np.zeros(64, np.int64))
    return int.from_bytes(np.packbits(ones * 2 > len(rows)).tobytes(), "big", signed=True)


def fingerprint(data: bytes, width: int) -> int:
    return majority(shingle_digests(data, width))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp as a signed long) of each row; a null text has no words."""
    def run(batches):
        for b in slices(batches):
            fps = [fingerprint(t or b"", width) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _masks(groups: int, bits: int, depth: int) -> list[int]:
    """A mask, as a signed long, for each choice of `depth` of the groups of so many bits."""
    one = (1 << bits) - 1
    masks = [sum(one << bits * i for i in at) for at in combinations(range(groups), depth)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _filed(rows: DataFrame, value: str, masks: list[int], mask: str, key: str) -> DataFrame:
    """rows with a row for each mask: the posting list is named by the mask and the value's bits under it."""
    every = rows.withColumn(mask, F.explode(F.expr(f"array({', '.join(f'{m}L' for m in masks)})")))
    return every.withColumn(key, F.col(value).bitwiseAND(F.col(mask)))


def _lists(postings: DataFrame, hot: int, *keys: str) -> tuple[DataFrame, DataFrame | None]:
    """(postings of lists of 2 to hot members, those of longer lists or None)."""
    sizes = materialize(postings.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "posting-sizes")
    usual = postings.join(joinable(sizes.filter(F.col("_n") <= hot).select(*keys)), [*keys], "left_semi")
    long = sizes.filter(F.col("_n") > hot).select(*keys)
    return usual, None if long.isEmpty() else postings.join(joinable(long), [*keys], "left_semi")


def _pairs(postings: DataFrame, least: int, *keys: str) -> DataFrame:
    """Pairs that share at least so many lists, verified by their bits."""
    other = postings.select(*keys, F.col("fp").alias("fp2"))
    tally = postings.join(other, [*keys]).filter("fp < fp2").groupBy("fp", "fp2").agg(F.count(F.lit(1)).alias("shared"))
    close = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= BITS
    return tally.filter((F.col("shared") >= least) & close).select(F.col("fp").alias("a"), F.col("fp2").alias("b"))


def fingerprint_links(fps: DataFrame, hot: int = 16, depth: int | None = None) -> DataFrame:
    """(a, b) of all pairs of distinct fingerprints fps(fp) within 3 bits; a < b, some pairs more than once.

    A pair of which both sit in long lists is found by the refined index, any other one shares usual lists only, so that
    its count is whole.
    """
    depth = depth or index_depth(fps.count())
    name = ["mask", "key"]
    usual, long = _lists(_filed(fps.select("fp"), "fp", _masks(BYTES, 8, depth), *name), hot, *name)
    links = _pairs(usual, comb(LEAST_EQUAL, depth), *name)
    if long is None:
        return links
    # Most members of a list of five equal bytes are links, so these lists may be longer.
    again = materialize(long.select("fp").distinct(), "hot-fingerprints")
    fine, longest = _lists(_filed(again, "fp", _masks(BYTES, 8, LEAST_EQUAL), *name), 4 * hot, *name)
    links = links.unionByName(_pairs(fine, 1, *name))
    if longest is None:
        return links
    # The 24 bits of the three bytes outside of the mask, as eight groups of three bits.
    byte = lambda of, i: F.call_function("shiftright", F.col(of), (i * 8).cast("int")).bitwiseAND(F.lit(255))
    outside = F.filter(F.sequence(F.lit(0), F.lit(BYTES - 1)), lambda i: byte("mask", i) == 0)
    free = F.aggregate(outside, F.lit(0).cast("long"), lambda acc, i: F.shiftleft(acc, 8).bitwiseOR(byte("fp", i)))
    finest = _filed(longest.withColumn("free", free), "free", _masks(8, 3, LEAST_EQUAL), "mask3", "key3")
    return links.unionByName(_pairs(finest, 1, *name, "mask3", "key3"))


def near_links(nodes: DataFrame, hot: int = 16) -> DataFrame:
    """The links of fingerprint_links between the nodes of nodes(node, fp); fp must be distinct."""
    links, name = fingerprint_links(nodes.select("fp"), hot), lambda side: nodes.select(F.col("fp").alias(side), F.col("node").alias(side + "_node"))
    return links.join(name("a"), "a").join(name("b"), "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, hot: int = 16) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row; component_id is the smallest doc_id reachable over links.

    The nodes are distinct fingerprints: exact copies of any number cost one row, and an id that stands for several texts
    joins no components. Rows with a null id get a result of their own fingerprint's component (null if it has no id); an
    empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp-nodes")
    links = fingerprint_links(nodes.select("fp"), hot)
    parts = connected_components(links).select(F.col("node").alias("fp"), "component")
    least = parts.join(nodes, "fp").groupBy("component").agg(F.min("first").alias("least"))
    named = nodes.join(parts.join(joinable(materialize(least, "fp-components")), "component"), "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    found = rows.join(named, "fp", "left")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), F.col("component_id"))


def _signatures(rows: DataFrame, width: int, least: float) -> DataFrame:
    from .minhash import common_shingles, marks, prefix_keys, read_common, shingle_set

    path = common_shingles(rows, width)

    def run(batches):
        for b in slices(batches, 500, most=2_000_000):
            digests = [shingle_digests(t or b"", width) for t in b.column("text").to_pylist()]
            sets = [shingle_set(d) for d in digests]
            columns = [pa.array([majority(d) for d in digests], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([prefix_keys(s, read_common(path), least) for s in sets], pa.list_(pa.int64())), pa.array([marks(s) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), *columns], ["doc_id", "text_hash", "fp", "n", "keys", "marks"])

    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long, n long, keys array<long>, marks array<long>")


def _nodes(rows: DataFrame, several: DataFrame | None) -> DataFrame:
    """rows(doc_id, text_hash) with a node: the id, or a negative hash of id and text where an id stands for several texts."""
    if several is None:
        return rows.withColumn("node", F.col("doc_id"))
    own = -F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(1 << 61)) - F.lit(1 << 61)
    return rows.join(joinable(several.withColumn("_several", F.lit(True))), "doc_id", "left").withColumn("node", F.when(F.col("_several"), own).otherwise(F.col("doc_id"))).drop("_several")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, least: float = 0.8, hot: int = 16) -> DataFrame:
    """(doc_id, text_hash, component_id, kept) of the rows that have a near copy: a Jaccard similarity of `least` or more over
    word shingles. component_id is the smallest id reachable over near copies; the row of that id (of its texts the one with
    the smallest hash) is kept. text_hash is xxhash64 of the text in UTF-8 (null: empty), as a column of docs can give it.

    Candidates are fingerprints within 3 bits (fingerprint_links) and documents whose prefixes of shingle sets meet (minhash.py), which are
    all that can have the similarity; each is checked on whole texts. Rows with a null id have no part in it; equal rows are one document.
    """
    from .minhash import prefix_links

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).filter("doc_id is not null")
    texts = texts.withColumn("text_hash", F.xxhash64("text"))
    signed = materialize(_signatures(texts, width, least), "signatures", 1000)
    several = materialize(signed.groupBy("doc_id").agg(F.min("text_hash").alias("a"), F.max("text_hash").alias("b")).filter("a < b").select("doc_id"), "several-texts")
    several = None if several.isEmpty() else several
    signed, texts = _nodes(signed, several), _nodes(texts, several).select("node", "text")
    heads = materialize(signed.groupBy("fp").agg(F.min("node").alias("head")), "fp-heads")
    equal = signed.join(heads, "fp").filter("node > head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    close = near_links(heads.select(F.col("head").alias("node"), "fp"), hot)
    # The prefixes bring every pair, so one of the closest fingerprints is enough for each node.
    close = close.groupBy(F.greatest("a", "b").alias("b")).agg(F.min(F.least("a", "b")).alias("a"))
    parts = prefix_links(signed.select("node", "n", "keys", "marks"), texts, width, least, equal.unionByName(close))
    found = materialize(signed.join(parts, "node").select("doc_id", "text_hash", "component").distinct(), "near-rows")
    keep = found.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("keep"))
    named = found.join(keep, "component")
    return named.select("doc_id", "text_hash", F.col("keep.doc_id").alias("component_id"), ((F.col("doc_id") == F.col("keep.doc_id")) & (F.col("text_hash") == F.col("keep.text_hash"))).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with the same columns; of each component of near_duplicates one document stays. Rows go by id and text; of rows that share
    both (a null id is one id here) one stays, any of them."""
    docs = once(docs, id_col, F.xxhash64(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    gone = near_duplicates(docs, id_col, text_col, **options).filter("not kept").select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash"))
    gone = joinable(materialize(gone.distinct(), "near-gone"))
    own = F.xxhash64(F.coalesce(docs[text_col], F.lit("")).cast("binary"))
    return docs.join(gone, (docs[id_col].cast("long") == gone["_gone_id"]) & (own == gone["_gone_hash"]), "left_anti")
