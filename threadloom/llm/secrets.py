r"""Secret scan with multipart credential linking. DataFrame functions only.

Strong kinds, leftmost and non-overlapping per kind: assign (a named value of 6+ characters), access (a key id of 20+
characters), hex (24+ lower-case hex digits). Weak kinds: secret (a lone base64-like run of exactly 40 characters) and
endpoint (an http/https URL). A weak candidate alone says nothing, so it is reported only when a complementary part lies
within `reach` code points: for a secret an access id, for an endpoint an access id or a named value. A secret and an endpoint
don't complement each other: 40 characters beside a URL are most often a commit or a content hash, and neither is strong.
A secret may follow '=' directly (KEY=value in .env files).

The regex matches of a document and the texts between them (split) give all code-point offsets without Python. Parts of
documents that hold both a weak and a complementary part become rows, and an interval join over bins of `reach` code
points finds the neighbours; strong spans of one kind never overlap and have at least 20 (6) characters, so that a bin
holds a bounded number of them. A null text is empty. Rows equal in id and text are scanned as one and each gets the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ that have 24 characters or more
SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"""https?://[^\s"'<>]+"""
KINDS = ["assign", "access", "hex", "secret", "endpoint"]
BLOCK = 128


def prefix_sums(a: Column) -> Column:
    """Inclusive prefix sums of an array of ints, in blocks, so that long arrays don't cost the square of their length."""
    def running(x: Column, first: Column) -> Column:
        return F.slice(F.aggregate(x, F.array(first), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v))), 2, 1 << 30)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")), lambda b: F.slice(a, b * BLOCK + 1, BLOCK))
    ends = running(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, v: s + v)), F.lit(0))
    return F.flatten(F.zip_with(blocks, F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1)), lambda b, first: running(b, first)))


def match_spans(text: Column, pattern: str, keep: Column | None = None, group: int = 0, least: int = 1) -> Column:
    """array<struct<start,end>> of the matches whose given group has `least` characters or more."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, lambda m: F.char_length(m))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p))
    ends = prefix_sums(F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda g, m: g + m))
    spans = F.zip_with(sizes, ends, lambda m, e: F.struct((e - m).alias("start"), e.alias("end")))
    checked = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    spans = F.filter(spans, lambda s, i: F.char_length(F.get(checked, i)) >= least)
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _rows(scan: DataFrame, kinds: list[str]) -> DataFrame:
    def named(kind: str) -> Column:
        return F.transform(F.col(kind), lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    parts = F.concat(*[named(k) for k in kinds])
    return scan.select("row_key", "doc_id", F.explode(parts).alias("p")).select("row_key", "doc_id", "p.kind", "p.start", "p.end").distinct()


def link_parts(scan: DataFrame, reach: int) -> DataFrame:
    """(row_key, doc_id, kind, start, end) of the weak parts that have a complementary part within reach."""
    weak = _rows(scan, ["secret", "endpoint"]).withColumn("bin", F.explode(F.sequence(F.floor((F.col("start") - reach) / reach), F.floor((F.col("end") + reach) / reach))))
    strong = _rows(scan, ["assign", "access"]).select("row_key", F.col("doc_id").alias("of"), F.col("kind").alias("with_kind"), F.col("start").alias("from"), F.col("end").alias("to"), F.floor(F.col("start") / reach).alias("bin"))
    near = (F.col("from") <= F.col("end") + reach) & (F.col("to") >= F.col("start") - reach) & ((F.col("to") <= F.col("start")) | (F.col("from") >= F.col("end")))
    # A strong part is filed under the bin of its start; a long one that starts further left reaches in by its end.
    far = strong.filter(F.floor(F.col("to") / reach) != F.col("bin")).withColumn("bin", F.floor(F.col("to") / reach))
    fits = (F.col("kind") == "endpoint") | (F.col("with_kind") == "access")
    return weak.join(strong.unionByName(far), ["row_key", "bin"]).filter(near & fits & F.col("doc_id").eqNullSafe(F.col("of"))).select("row_key", "doc_id", "kind", "start", "end").distinct()


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 200) -> DataFrame:
    """(doc_id, assign, access, hex, linked): arrays of spans; linked has (start, rank, end, kind) of reported weak parts."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    text = F.col("text")
    scan = materialize(
        base.select(
            "doc_id", F.xxhash64("doc_id", "text").alias("row_key"),
            match_spans(text, ASSIGN, group=2, least=6).alias("assign"),
            match_spans(text, ACCESS, least=20).alias("access"),
            match_spans(text, HEX, least=24).alias("hex"),
            match_spans(text, SECRET, least=40).alias("secret"),
            match_spans(text, ENDPOINT).alias("endpoint"),
        ), "secret-parts",
    )
    n = lambda k: F.size(F.col(k))
    open_ = ((n("secret") > 0) & (n("access") > 0)) | ((n("endpoint") > 0) & (n("access") + n("assign") > 0))
    rank = F.when(F.col("kind") == "secret", 3).otherwise(4)
    linked = link_parts(scan.filter(open_), reach).groupBy("row_key", F.col("doc_id").alias("of")).agg(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind")).alias("linked"))
    none = F.array().cast(linked.schema["linked"].dataType)
    kept = ["doc_id", "assign", "access", "hex"]
    asked = scan.filter(open_)
    joined = asked.join(linked, (asked["row_key"] == linked["row_key"]) & asked["doc_id"].eqNullSafe(linked["of"]), "left").select(*kept, F.coalesce("linked", none).alias("linked"))
    return scan.filter(~open_).select(*kept, none.alias("linked")).unionByName(joined)


def _ranked(name: str, rank: int) -> Column:
    return F.transform(F.col(name), lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(name).alias("kind")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(found: DataFrame) -> DataFrame:
    strong = F.concat(_ranked("assign", 0), _ranked("access", 1), _ranked("hex", 2))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(_joined(strong).cast("binary"), 256).alias("base_sha256"), _joined(F.concat(strong, F.col("linked"))).alias("spans"),
    )
