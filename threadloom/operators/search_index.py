"""A stored search index: postings bucketed by term, in generations.

Layout below the index's root: `postings-<g>` (term, field, key, tf, length, positions), bucketed and sorted by term, so that a query reads
the buckets of its terms and in them the row groups of its terms; `terms-<g>`, the sorted vocabulary, from which prefixes take their terms;
`docs-<g>` (key, length); `changed-<g>`, the keys that generation g replaces or deletes; `meta`, one row per generation with the number of
live documents and their total length, appended last, so that a generation without its row does not exist. An update writes a generation
of its own and no old file; a posting is live if no later generation changed its document. `compact` merges all into a new base.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.text import tokens
from threadloom.operators.search import B, K1, match_all, match_any, match_phrase, porter_stem, stemmed
from threadloom.sources.scratch import joinable, scratch

#: Terms that a prefix may bring into a query as a list; a prefix with more is matched inside the scan.
PREFIX_TERMS = 2000
#: Tokens of a file of a bucket: a task sorts one file, in memory.
FILE_TOKENS = 2_000_000
#: Tokens that a Python task groups at once.
GROUP_TOKENS = 200_000
#: Characters of a token, with what stands between; texts have more.
CHARS = 4


@lru_cache
def accents() -> tuple[str, str]:
    """(letters with accents, their plain letters): all letters of the basic plane that Unicode takes apart into one letter and marks."""
    pairs = []
    for code in (*range(0xC0, 0x2000), *range(0xFB1D, 0xFB50)):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if marks and all(unicodedata.category(m).startswith("M") for m in marks) and unicodedata.category(base).startswith("L"):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def folded(text: Column) -> Column:
    """Lower case, without accents and combining marks; pure ASCII takes the fast path."""
    low = F.lower(text)
    return F.when(F.octet_length(text) == F.char_length(text), low).otherwise(F.regexp_replace(F.translate(low, *accents()), r"\p{M}+", ""))


def unicode_tokens(text: Column) -> Column:
    """Runs of letters and digits of any script, folded."""
    return F.regexp_extract_all(folded(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


TOKENS = {"words": tokens, "unicode": unicode_tokens}


class SearchIndex:
    """Search over a stored index. `tokens` is "words" (ASCII words with inner apostrophes and hyphens) or "unicode" (letters and digits of
    any script without accents); with `stem`, terms are Porter stems. Query words are given as they are written in texts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        meta = spark.read.parquet(f"{self.root}/meta").orderBy("generation").collect()  # one row per generation
        last = meta[-1]
        self.key, self.key_type, self.tokens, self.stem, self.buckets = last.key, last.key_type, last.tokens, last.stem, last.buckets
        self.fields = dict(zip(last.fields, last.columns, strict=True))
        self.docs, self.total = last.docs, last.total
        self.generations = [m.generation for m in meta if m.generation >= last.base]
        self._tables: dict[int, str] = {}

    @classmethod
    def build(cls, docs: DataFrame, key: str, fields: dict[str, str], root: str | None = None, buckets: int = 64, tokens: str = "words", stem: bool = False) -> SearchIndex:
        """A new index over docs, with index field -> column of `fields`. Keys are unique and not null; null texts are empty."""
        spark, root = docs.sparkSession, root or scratch(docs.sparkSession)
        about = {"key": key, "key_type": docs.schema[key].dataType.simpleString(), "fields": list(fields), "columns": list(fields.values()), "tokens": tokens, "stem": stem, "buckets": buckets}
        _write(spark, root, about, 0, docs)
        size = spark.read.parquet(f"{root}/docs-0").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total")).first()
        _append_meta(spark, root, about, 0, 0, size.n, size.total)
        return cls(spark, root)

    def _about(self) -> dict:
        return {"key": self.key, "key_type": self.key_type, "fields": list(self.fields), "columns": list(self.fields.values()), "tokens": self.tokens, "stem": self.stem, "buckets": self.buckets}

    def update(self, docs: DataFrame | None = None, deleted: DataFrame | None = None) -> SearchIndex:
        """The index with docs put in place of those of the same keys, and the keys of deleted(key) removed. Old files stay as they are."""
        latest = SearchIndex(self.spark, self.root)
        if latest.generations[-1] != self.generations[-1]:
            return latest.update(docs, deleted)
        new = self.generations[-1] + 1
        keys = [d.select(self.key) for d in (docs, deleted) if d is not None]
        if not keys:
            return self
        changed = reduce(DataFrame.unionByName, keys).filter(F.col(self.key).isNotNull()).distinct()
        changed.write.mode("overwrite").parquet(f"{self.root}/changed-{new}")
        changed = joinable(self.spark.read.parquet(f"{self.root}/changed-{new}"))
        gone = self._live_docs().join(changed, self.key, "left_semi").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total")).first()
        _write(self.spark, self.root, self._about(), new, docs)
        size = self.spark.read.parquet(f"{self.root}/docs-{new}").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("total")).first()
        _append_meta(self.spark, self.root, self._about(), new, self.generations[0], self.docs - gone.n + size.n, self.total - gone.total + size.total)
        return SearchIndex(self.spark, self.root)

    def compact(self) -> SearchIndex:
        """All generations merged into a new base."""
        latest = SearchIndex(self.spark, self.root)
        if latest.generations[-1] != self.generations[-1]:
            return latest.compact()
        new = self.generations[-1] + 1
        _store(self.spark, self.root, self._about(), new, self.live(), self.total, self._live_docs())
        _append_meta(self.spark, self.root, self._about(), new, new, self.docs, self.total)
        return SearchIndex(self.spark, self.root)

    def _postings(self, generation: int) -> DataFrame:
        """The bucketed table of a generation, known to this session under a name of its own; one session may follow another."""
        if generation not in self._tables:
            name = f"search_{abs(hash(self.root)):x}_{generation}"
            columns = f"term string, field string, `{self.key}` {self.key_type}, tf bigint, length bigint, positions array<int>"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (term) SORTED BY (term) INTO {self.buckets} BUCKETS LOCATION '{self.root}/postings-{generation}'")
            self._tables[generation] = name
        return self.spark.table(self._tables[generation])

    def _unchanged(self, rows: DataFrame, generation: int) -> DataFrame:
        """rows of a generation without the documents that later generations changed."""
        for later in self.generations:
            if later > generation:
                rows = rows.join(joinable(self.spark.read.parquet(f"{self.root}/changed-{later}")), self.key, "left_anti")
        return rows

    def _live_docs(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._unchanged(self.spark.read.parquet(f"{self.root}/docs-{g}"), g) for g in self.generations])

    def live(self, test: Column | None = None) -> DataFrame:
        """The live postings that meet the test on term and field, which reaches the scan."""
        parts = [self._postings(g) if test is None else self._postings(g).filter(test) for g in self.generations]
        return reduce(DataFrame.unionByName, [self._unchanged(p, g) for p, g in zip(parts, self.generations, strict=True)])

    def _terms(self, words: Iterable[str]) -> list[str]:
        """Query words as terms of the index. Texts and query words take the same way: the same tokens, the same stems."""
        words = list(words)
        if not words:
            return []
        cut = TOKENS[self.tokens]
        found = self.spark.range(1).select(*[cut(F.lit(w)).alias(f"w{i}") for i, w in enumerate(words)]).first()
        out = [t for terms in found for t in terms]
        return [porter_stem(t) for t in out] if self.stem else out

    def _with_prefix(self, prefix: str) -> list[str] | None:
        """The terms that start with the prefix, from the sorted vocabulary; None if they are too many for a list."""
        terms = reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.root}/terms-{g}").filter(F.col("term").startswith(prefix)) for g in self.generations])
        found = [r.term for r in terms.select("term").distinct().limit(PREFIX_TERMS + 1).collect()]
        return found if len(found) <= PREFIX_TERMS else None

    def matching(self, words: Iterable[str] = (), prefix: Iterable[str] = (), columns: Iterable[str] = ()) -> tuple[DataFrame, list[str], list[str]]:
        """(live postings of the words' and prefixes' terms, all these terms as far as listed, prefixes that are matched in the scan)."""
        terms, wide = list(words), []
        for p in prefix:
            p = self.spark.range(1).select(folded(F.lit(p)) if self.tokens == "unicode" else F.lower(F.lit(p))).first()[0]
            found = self._with_prefix(p)
            if found is None:
                wide.append(p)
            else:
                terms += found
        test = F.col("term").isin(sorted(set(terms)))
        for p in wide:
            test = test | F.col("term").startswith(p)
        return self.live(test & F.col("field").isin(list(columns)) if columns else test), terms, wide

    def search(self, all_of=(), any_of=(), none_of=(), phrase=(), prefix=(), columns=(), facets: DataFrame | None = None, limit: int = 20) -> DataFrame:
        """(key, score): documents that meet all given conditions, by BM25 of the positive terms, best first, ties by key.

        Only the buckets of the query's terms are read. facets(key) restricts the documents before ranking. Words without a token of the
        index match nothing in all_of and phrase.
        """
        all_of, any_of, none_of, phrase = (self._terms(w) for w in (all_of, any_of, none_of, phrase))
        hits, listed, wide = self.matching([*all_of, *any_of, *phrase], prefix, columns)
        given = {*all_of, *any_of, *phrase}
        started = [t for t in listed if t not in given]
        found = None
        conditions = []
        if all_of:
            conditions.append(match_all(hits, self.key, all_of))
        if any_of or started or wide:
            conditions.append(match_any(hits, self.key, [*any_of, *(t for t in listed if t in given and any(t.startswith(p) for p in prefix)), *started], wide))
        if phrase:
            conditions.append(match_phrase(hits, self.key, phrase))
        if not conditions:
            return hits.filter("false").select(self.key, F.lit(0.0).alias("score"))
        for c in conditions:
            found = c if found is None else found.join(c, self.key, "left_semi")
        if none_of:
            within = F.col("field").isin(list(columns)) if columns else F.lit(True)
            found = found.join(self.live(F.col("term").isin(none_of) & within).select(self.key).distinct(), self.key, "left_anti")
        if facets is not None:
            found = found.join(facets.select(self.key), self.key, "left_semi")
        per_doc = hits.groupBy(self.key, "term").agg(F.sum("tf").alias("tf"), F.first("length").alias("length"))
        df = per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        scored = per_doc.join(found, self.key, "left_semi").join(df if wide else F.broadcast(df), "term")  # df has one row for each listed term
        idf = F.log(1 + (F.lit(self.docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(self.total / max(self.docs, 1))))
        return scored.groupBy(self.key).agg(F.round(F.sum(part), 6).alias("score")).orderBy(F.desc("score"), self.key).limit(limit)

    def hit_counts(self, queries: DataFrame, columns: Iterable[str] = (), phrase: bool = False) -> DataFrame:
        """(name, hits) for queries(name, keyword), of any number: documents that hold all words of one of the name's keywords, or with
        `phrase` these words in a row in one field.

        Keywords are cut as texts are, so capitals and several words are found. The keywords meet the postings in one join by term, which
        reads the buckets of their terms if these are few; words of a phrase meet by position.
        """
        words = TOKENS[self.tokens](F.col("keyword"))
        asked = queries.select("name", F.xxhash64("name", "keyword").alias("q"), F.size(words).alias("n"), F.posexplode(words).alias("i", "term"))
        if self.stem:
            asked = asked.withColumn("term", stemmed("term"))
        some = [r.term for r in asked.select("term").distinct().limit(PREFIX_TERMS + 1).collect()]
        test = F.col("term").isin(some) if len(some) <= PREFIX_TERMS else F.lit(True)
        if columns:
            test = test & F.col("field").isin(list(columns))
        at = self.live(test).join(joinable(asked), "term")
        if phrase:
            at = at.select("name", "q", "n", "i", "field", self.key, F.explode("positions").alias("p"))
            met = at.groupBy("name", "q", "n", "field", self.key, (F.col("p") - F.col("i")).alias("first")).agg(F.count(F.lit(1)).alias("met"))
        else:
            met = at.groupBy("name", "q", "n", self.key).agg(F.count_distinct("i").alias("met"))
        hits = met.filter("met = n").select("name", self.key).distinct().groupBy("name").agg(F.count(F.lit(1)).alias("hits"))
        return queries.select("name").distinct().join(hits, "name", "left").select("name", F.coalesce("hits", F.lit(0)).alias("hits"))

    def statistics(self) -> DataFrame:
        """(field, tokens, terms, docs) of the live postings. A document has one first token in a field, so documents are counted by these,
        along with the terms, and keys are never shuffled."""
        first = F.get("positions", F.lit(0)) == 0
        per_term = self.live().groupBy("field", "term").agg(F.sum("tf").alias("tf"), F.count_if(first).alias("n"))
        return per_term.groupBy("field").agg(F.sum("tf").alias("tokens"), F.count(F.lit(1)).alias("terms"), F.sum("n").alias("docs"))


def _portions(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Batches in slices of up to GROUP_TOKENS words, one row at least."""
    for b in batches:
        ends, at = np.cumsum(np.diff(b.column("words").offsets.to_numpy()), dtype=np.int64), 0
        while at < b.num_rows:
            before = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, before + GROUP_TOKENS, side="right")) - at)
            yield b.slice(at, n)
            at += n


#: A word's stem; a worker remembers the words that come again.
_stem = lru_cache(1 << 17)(porter_stem)


def group_terms(batches: Iterable[pa.RecordBatch], stem: bool = False) -> Iterable[pa.RecordBatch]:
    """(key, length, field, term, tf, positions) from rows (key, length, field, words): the tokens of a field meet where they are read, by
    their stems if these are asked for, so that postings need no shuffle of tokens."""
    for b in _portions(batches):
        words = b.column("words")
        terms = words.flatten().dictionary_encode()
        if not len(terms):
            continue
        if stem:
            stems = pa.array([_stem(t) for t in terms.dictionary.to_pylist()], pa.string()).dictionary_encode()
            terms = pa.DictionaryArray.from_arrays(stems.indices.take(terms.indices), stems.dictionary)
        sizes = np.diff(words.offsets.to_numpy())
        row = np.repeat(np.arange(len(sizes)), sizes)
        named = row * len(terms.dictionary) + terms.indices.to_numpy()
        order = np.argsort(named, kind="stable")
        pos = (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[order].astype(np.int32)
        first = np.flatnonzero(np.concatenate(([True], np.diff(named[order]) != 0)))
        positions = pa.ListArray.from_arrays(pa.array(np.append(first, len(row)), pa.int32()), pa.array(pos))
        at, tf = pa.array(row[order[first]]), pa.array(np.diff(np.append(first, len(row))), pa.int64())
        columns = [b.column(c).take(at) for c in ("key", "length", "field")] + [terms.dictionary.take(terms.indices.take(pa.array(order[first]))), tf, positions]
        yield pa.RecordBatch.from_arrays(columns, ["key", "length", "field", "term", "tf", "positions"])


def _terms_of(docs: DataFrame, about: dict) -> DataFrame:
    """The postings of docs; texts are cut once. A document's length, the sum of its tokens in all fields, stands with each posting, so that
    ranking reads postings only."""
    key, cut, stem = about["key"], TOKENS[about["tokens"]], about["stem"]
    words = docs.select(key, *[cut(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(f"_w{i}") for i, c in enumerate(about["columns"])])
    length = reduce(Column.__add__, [F.size(f"_w{i}") for i in range(len(about["columns"]))]).cast("long").alias("length")
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_w{i}").alias("words")) for i, f in enumerate(about["fields"])])
    rows = words.select(F.col(key).alias("key"), length, F.explode(parts).alias("f")).select("key", "length", "f.field", "f.words")
    rows = rows.mapInArrow(lambda batches: group_terms(batches, stem), f"key {about['key_type']}, length long, field string, term string, tf long, positions array<int>")
    return rows.withColumnRenamed("key", key)


def _write(spark: SparkSession, root: str, about: dict, generation: int, docs: DataFrame | None) -> None:
    """Store the postings of docs as a generation; none, if there are only deletes."""
    if docs is None:
        docs = spark.createDataFrame([], f"`{about['key']}` {about['key_type']}, " + ", ".join(f"`{c}` string" for c in dict.fromkeys(about["columns"])))
    # Tokens are estimated by characters, rather too many, so that texts are cut once only.
    chars = reduce(Column.__add__, [F.coalesce(F.char_length(F.col(c).cast("string")), F.lit(0)).cast("long") for c in about["columns"]])
    _store(spark, root, about, generation, _terms_of(docs, about), (docs.agg(F.sum(chars)).first()[0] or 0) // CHARS)


def _store(spark: SparkSession, root: str, about: dict, generation: int, rows: DataFrame, total: int, sizes: DataFrame | None = None) -> None:
    """Store postings of about `total` tokens, and the lengths of their documents: `sizes`, or as the postings have them."""
    n, key = about["buckets"], about["key"]
    rows = rows.select("term", "field", key, F.col("tf").cast("long").alias("tf"), "length", "positions")
    # A task writes one bucket, or one of several files of it, so that a bucket with a hot term is no single task.
    files = int(total // (n * FILE_TOKENS) + 1)
    dealt = rows.repartition(n * files, F.pmod(F.hash("term"), F.lit(n)), F.pmod(F.xxhash64(key), F.lit(files)))
    name = f"search_new_{abs(hash(root)):x}_{generation}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    dealt.write.bucketBy(n, "term").sortBy("term").mode("overwrite").option("path", f"{root}/postings-{generation}").saveAsTable(name)
    stored = spark.table(name)
    stored.select("term").distinct().orderBy("term").write.mode("overwrite").parquet(f"{root}/terms-{generation}")
    if sizes is None:  # a document has one first token in a field
        sizes = stored.filter(F.get("positions", F.lit(0)) == 0).groupBy(key).agg(F.max("length").alias("length"))
    sizes.write.mode("overwrite").parquet(f"{root}/docs-{generation}")
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external


def _append_meta(spark: SparkSession, root: str, about: dict, generation: int, base: int, docs: int, total: int) -> None:
    row = about | {"generation": generation, "base": base, "docs": int(docs), "total": int(total)}
    kinds = "generation int, base int, key string, key_type string, fields array<string>, columns array<string>, tokens string, stem boolean, buckets int, docs long, total long"
    spark.createDataFrame([tuple(row[k.split()[0]] for k in kinds.split(", "))], kinds).coalesce(1).write.mode("append").parquet(f"{root}/meta")
