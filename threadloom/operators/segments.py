"""Timed transcripts: filters, turns, overlap joins, tags, chapter breaks, chapters and their texts."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from threadloom.functions.text import class_hits, clock_of, jaccard_distance, tokens, word_count
from threadloom.sources.scratch import joinable, materialize

WEIGHTS = {"coherence": 0.35, "pause": 0.2, "topic": 0.2, "speaker": 0.1, "film": 0.15}


def drop_hallucinations(segments: DataFrame, phrases: list[str], key: str = "doc_id") -> DataFrame:
    """Rows that pass the local rules and don't repeat the row before; ids are numbered anew.

    Local rules: empty; up to 4 words and a known phrase; over 10 words of which under a fifth are distinct. A repeat is
    the text of the row before in lower case, if under 50 characters.
    """
    low = F.lower(F.trim("text"))
    words = F.filter(F.split(low, r"\s+"), lambda w: w != "")
    n = F.size(words)
    bad = (low == "") | ((n <= 4) & low.isin(phrases)) | ((n > 10) & (F.size(F.array_distinct(words)) < n * 0.2))
    order = Window.partitionBy(key).orderBy("id")
    kept = segments.filter(~bad).withColumn("_before", F.lag(low).over(order))
    kept = kept.filter(F.col("_before").isNull() | (F.col("_before") != low) | (F.char_length(low) >= 50)).drop("_before")
    return kept.withColumn("new_id", F.row_number().over(order) - 1)


def segment_types(segments: DataFrame, intro: float = 90, outro: float = 120, key: str = "doc_id") -> DataFrame:
    total = segments.groupBy(key).agg(F.max("end").alias("_total"))
    kind = F.when(F.col("end") <= intro, "intro").when((F.col("_total") > 0) & (F.col("start") >= F.col("_total") - outro), "outro").otherwise("content")
    return segments.join(total, key).withColumn("segment_type", kind).drop("_total")


def turns(segments: DataFrame, key: str = "doc_id") -> DataFrame:
    """Conversation turns: islands of one speaker."""
    order = Window.partitionBy(key).orderBy("id")
    new = F.coalesce(F.lag("speaker").over(order) != F.col("speaker"), F.lit(True)).cast("int")
    marked = segments.withColumn("_new", new).withColumn("turn", F.sum("_new").over(order))
    return marked.groupBy(key, "turn", "speaker").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("segments"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda s: s["text"]), " ").alias("text"))


def speaker_order(segments: DataFrame, key: str = "doc_id") -> DataFrame:
    first = segments.groupBy(key, "speaker").agg(F.min("id").alias("first_id"))
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("first_id")))


def best_overlap(segments: DataFrame, speaker_turns: DataFrame, bin_s: float = 60.0, key: str = "doc_id") -> DataFrame:
    """The turn with the longest overlap for each segment; the earlier turn wins ties, touching is no overlap, null if none.

    Both sides are filed under each bin of bin_s seconds they touch, so the join is by equality. A pair may meet in
    several bins; the best one is the same whichever bin brings it.
    """
    def bins(df: DataFrame, s: str, e: str) -> DataFrame:
        return df.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(s) / bin_s), F.floor(F.greatest(F.col(s), F.col(e)) / bin_s))))

    t = bins(speaker_turns.select(key, F.col("start").alias("t_start"), F.col("end").alias("t_end"), F.col("speaker").alias("t_speaker")), "t_start", "t_end")
    s = bins(segments.select(key, "id", "start", "end"), "start", "end")
    pairs = s.join(t, [key, "_bin"]).filter((F.col("start") < F.col("t_end")) & (F.col("t_start") < F.col("end")))
    overlap = F.least("end", "t_end") - F.greatest("start", "t_start")
    best = pairs.groupBy(key, "id").agg(F.max_by("t_speaker", F.struct(overlap.alias("o"), (-F.col("t_start")).alias("s"))).alias("matched"))
    return segments.select(key, "id").join(best, [key, "id"], "left")


def corpus_terms(posts: DataFrame, text: str, topic: str) -> tuple[DataFrame, DataFrame]:
    """(term, tfidf) of a corpus, tf * ln(documents / df), and its index (term, topic, n) of the documents of a topic that hold a term.

    Per document first, so that a hot term crosses the shuffle once per document and task."""
    numbered = posts.select(F.monotonically_increasing_id().alias("_doc"), F.col(topic).alias("topic"), F.col(text).alias("text"))
    words = numbered.select("_doc", "topic", F.explode(tokens(F.col("text"))).alias("term"))
    per_doc = words.groupBy("_doc", "topic", "term").agg(F.count(F.lit(1)).alias("n"))
    stats = per_doc.groupBy("term").agg(F.sum("n").alias("tf"), F.count(F.lit(1)).alias("df"))
    total = posts.filter(F.col(text) != "").agg(F.count(F.lit(1)).alias("docs"))
    scored = stats.join(F.broadcast(total)).select("term", (F.col("tf") * F.log(F.col("docs") / F.col("df"))).alias("tfidf"))
    return scored, per_doc.filter("topic is not null").groupBy("term", "topic").agg(F.count(F.lit(1)).alias("n"))


def topic_tags(segments: DataFrame, dictionary: DataFrame, key: list[str], least: float = 0.3, corpus: DataFrame | None = None, index: DataFrame | None = None, related: int = 3) -> DataFrame:
    """(key..., class, confidence, keywords): .4 * min(k / 3, 1) + .6 * min(10 k / words, 1) for k matching keywords.

    corpus(term, tfidf) adds min(mean tfidf of the matching keywords / 100, .3), up to 1; a keyword that is no term of the corpus adds
    nothing. index(term, topic, n), from corpus_terms, adds `related`: the topics with most documents that hold the keywords, ties by
    name. Related topics are ranked once per set of keywords, however many segments share it.
    """
    # The number of words stands with the key, so that segments and hits need not meet again.
    long = segments.filter(F.char_length(F.trim("text")) >= 10).withColumn("_w", word_count(F.col("text")))
    hits = class_hits(long, dictionary, [*key, "_w"], "text")
    if corpus is None:
        hits = hits.withColumn("boost", F.lit(0.0))
    else:
        named = corpus.select(F.col("term").alias("keyword"), "tfidf").join(joinable(dictionary.select("keyword").distinct()), "keyword", "left_semi")
        each = hits.select(*key, "_w", "class", "found", F.explode("found").alias("keyword")).join(joinable(materialize(named)), "keyword", "left")
        boost = F.least(F.sum(F.coalesce("tfidf", F.lit(0.0))) / F.count(F.lit(1)) / 100.0, F.lit(0.3))
        hits = each.groupBy(*key, "_w", "class", "found").agg(boost.alias("boost"))
    hits = hits.withColumns({"k": F.size("found"), "keywords": F.array_join("found", ",")})
    score = 0.4 * F.least(F.col("k") / 3.0, F.lit(1.0)) + 0.6 * F.least(10.0 * F.col("k") / F.greatest("_w", F.lit(1)), F.lit(1.0))
    raw = score if corpus is None else F.least(score + F.col("boost"), F.lit(1.0))
    tags = hits.withColumn("confidence", raw)
    tags = tags.filter((F.round("confidence", 3) if corpus is None else F.col("confidence")) >= least).select(*key, "class", F.round("confidence", 3).alias("confidence"), "keywords")
    if index is None:
        return tags
    sets = tags.select("keywords").distinct().select("keywords", F.explode(F.split("keywords", ",")).alias("term"))
    scores = sets.join(index, "term").groupBy("keywords", "topic").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("keywords").orderBy(F.desc("n"), "topic")
    first = scores.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= related)
    named = first.groupBy("keywords").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "topic"))), lambda x: x["topic"]), ",").alias("related"))
    return tags.join(named, "keywords", "left").select(*key, "class", "confidence", "keywords", F.coalesce("related", F.lit("")).alias("related"))


def mentions(segments: DataFrame, dictionary: DataFrame, key: list[str]) -> DataFrame:
    """(key..., class, confidence min(k / 2, 1))."""
    return class_hits(segments, dictionary, key, "text").select(*key, "class", F.least(F.size("found") / 2.0, F.lit(1.0)).alias("confidence"))


def _whole(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """batches, sorted by key, as tables that cut no transcript; each holds many."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).dictionary_encode(null_encoding="encode")
        new = np.flatnonzero(keys.indices.to_numpy() == len(keys.dictionary) - 1)[0]  # the last transcript may go on
        if held and (new or held[-1].column(key)[held[-1].num_rows - 1].as_py() != keys[0].as_py()):
            yield pa.Table.from_batches([*held, batch.slice(0, new)])
            held = []
        elif new:
            yield pa.Table.from_batches([batch.slice(0, new)])
        held.append(batch.slice(new))
    if held:
        yield pa.Table.from_batches(held)


def _shared(batches: Iterator[pa.RecordBatch], span: int, key: str) -> Iterator[pa.RecordBatch]:
    """batches, sorted by key and id, with d, a, b in place of `words`: the dot product and the squares of the terms of the ids from id - span
    and those from id on. Transcripts are gathered whole, many at a time; the products of segments up to 2 * span - 1 ids apart suffice."""
    def scored(rows: pa.Table) -> pa.RecordBatch:
        keys, ids = rows[key].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(), rows["id"].to_numpy()
        unit = np.cumsum(np.concatenate(([True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])))) - 1  # rows of one id count as one
        first = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
        keys, ids, units = keys[first], ids[first], len(first)
        words = rows["words"].combine_chunks()
        terms, per_row = words.flatten().dictionary_encode(), np.diff(words.offsets.to_numpy())
        codes, each = np.unique((keys[np.repeat(unit, per_row)].astype(np.int64) * max(len(terms.dictionary), 1) + terms.indices.to_numpy()) * units + np.repeat(unit, per_row), return_counts=True)
        code, at, each = codes // units, codes % units, each.astype(np.float64)
        band = np.bincount(at * (2 * span), each * each, units * 2 * span)
        for k in range(1, 2 * span):
            near = np.flatnonzero((code[k:] == code[:-k]) & (at[k:] - at[:-k] < 2 * span))
            band += np.bincount(at[near] * (2 * span) + at[near + k] - at[near], each[near] * each[near + k], units * 2 * span)
        band = np.vstack([band.reshape(units, -1), np.zeros((1, 2 * span))])

        def there(shift: int, most: int) -> np.ndarray:
            """The unit so many places on, if it is one of the transcript's and its id is near enough; else the row of zeros."""
            to = np.arange(units) + shift
            ok = (to >= 0) & (to < units)
            ok[ok] = (keys[to[ok]] == keys[ok]) & (np.abs(ids[to[ok]] - ids[ok]) <= most)
            return np.where(ok, to, units)

        left, right = [there(-i, span) for i in range(1, span + 1)], [there(i, span - 1) for i in range(span)]
        d, a, b = np.zeros(units), np.zeros(units), np.zeros(units)
        for i in range(span):
            for j in range(span):
                d += np.where(right[j] < units, band[left[i], i + 1 + j], 0)
            for j in range(i, span):
                twice = 1 if i == j else 2
                a += twice * np.where(left[i] < units, band[left[j], j - i], 0)
                b += twice * np.where(right[j] < units, band[right[i], j - i], 0)
        out = rows.drop_columns(["words"])
        for name, values in (("d", d), ("a", a), ("b", b)):
            out = out.append_column(name, pa.array(values[unit].astype(np.int64)))
        return out.combine_chunks().to_batches()[0]

    yield from map(scored, _whole(batches, key))


def _coherence(rows: DataFrame, stopwords: list[str], span: int, key: str) -> DataFrame:
    """rows(key, id, text, ...), dealt by key, with `coherence` in place of text: the cosine distance of the terms of `span` segments before
    and from each boundary. Terms are counted where the transcripts lie, so none of them is shuffled."""
    words = F.filter(tokens(F.coalesce("text", F.lit(""))), lambda w: (F.char_length(w) > 2) & ~w.isin(stopwords))
    cut = rows.sortWithinPartitions(key, "id").withColumn("words", words).drop("text")
    kept = StructType([f for f in cut.schema if f.name != "words"])
    found = cut.mapInArrow(lambda batches: _shared(batches, span, key), StructType([*kept, *[StructField(c, LongType()) for c in ("d", "a", "b")]]))
    far = 1 - F.col("d") / F.sqrt((F.col("a") * F.col("b")).cast("double"))
    return found.withColumn("coherence", F.when((F.col("a") == 0) | (F.col("b") == 0), 1.0).otherwise(far)).drop("d", "a", "b")


def break_scores(segments: DataFrame, stopwords: list[str], span: int = 6, key: str = "doc_id") -> DataFrame:
    """(key, id, start, end, coherence, pause, topic, speaker_turn, film, score) of each boundary before a segment.

    segments needs text, speaker, topics array<string>, films array<string>; frames hold these short arrays only.
    """
    order = Window.partitionBy(key).orderBy("id")
    left, right = order.rowsBetween(-span, -1), order.rowsBetween(0, span - 1)
    item = F.struct("topics", "films", "speaker")
    # The windows deal the rows by transcript, unless they lie so already: then texts don't move again.
    s = segments.select(key, "id", "start", "end", "text", "speaker", "topics", "films")
    s = s.withColumns({"_l": F.collect_list(item).over(left), "_r": F.collect_list(item).over(right), "_gap": F.greatest(F.col("start") - F.lag("end").over(order), F.lit(0.0)), "_n": F.count(F.lit(1)).over(Window.partitionBy(key))})
    side = lambda c, f: F.transform(F.col(c), lambda x: x[f])
    union = lambda c, f: F.array_distinct(F.flatten(side(c, f)))

    def dominant(c: str) -> Column:
        names = F.filter(side(c, "speaker"), lambda x: x.isNotNull())
        ranked = F.transform(F.array_distinct(names), lambda d: F.struct((F.size(F.array_remove(names, d)) - F.size(names)).alias("n"), d.alias("s")))
        return F.array_min(ranked)["s"]

    a, b = dominant("_l"), dominant("_r")
    fl, fr = union("_l", "films"), union("_r", "films")
    parts = {
        "pause": F.when(F.col("_gap") < 2, 0.0).otherwise(F.least(F.col("_gap") / 8.0, F.lit(1.0))),
        "topic": jaccard_distance(union("_l", "topics"), union("_r", "topics")),
        "speaker_turn": F.when(a.isNotNull() & b.isNotNull() & (a != b), 1.0).otherwise(0.0),
        "film": F.size(F.array_except(fr, fl)) / F.greatest(F.size(fr), F.lit(1)),
    }
    edge = (F.size("_l") >= 2) & (F.size("_r") >= 2) & (F.col("_n") >= 4)
    near = s.select(key, "id", "start", "end", "text", edge.alias("_edge"), *[c.alias(k) for k, c in parts.items()])
    scored = _coherence(near, stopwords, span, key).filter("_edge").select(key, "id", "start", "end", "coherence", *parts)
    names = dict(zip(["coherence", *parts], WEIGHTS.values(), strict=True))
    return scored.withColumn("score", sum((F.col(k) * w for k, w in names.items()), F.lit(0.0)))


def _picked(ids: np.ndarray, start: np.ndarray, end: np.ndarray, score: np.ndarray, least: float, apart: float, longest: float) -> list[int]:
    """The accepted breaks of one transcript, sorted by id."""
    starts, ends = start[~np.isnan(start)], end[~np.isnan(end)]
    if not len(starts) or not len(ends):
        return []
    bounds, chosen = sorted({float(starts.min()), float(ends.max())}), set()
    good = np.flatnonzero(score >= least)
    for i in good[np.lexsort((ids[good], -score[good]))].tolist():
        x = float(start[i])
        at = bisect_left(bounds, x)  # the edges next to it are the nearest ones
        if all(abs(x - e) >= apart and x != e for e in bounds[max(at - 1, 0) : at + 1]):
            bounds.insert(at, x)
            chosen.add(int(ids[i]))
    for a, b in zip(bounds, bounds[1:], strict=False):
        if b - a > longest:
            before = np.flatnonzero((start <= (a + b) / 2) & (start > a))
            if len(before):
                chosen.add(int(ids[before[-1]]))
    return sorted(chosen)


def choose_breaks(scored: DataFrame, least: float = 0.3, apart: float = 120.0, longest: float = 1200.0, key: str = "doc_id") -> DataFrame:
    """(key, id) of accepted chapter breaks. Greedy by score within a transcript, of which four narrow columns lie in one task, among many
    others: a candidate is taken if its start lies `apart` from all edges; then a chapter over `longest` gets one break at the last
    segment that starts before its middle."""
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole(batches, key):
            codes = rows[key].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            first = np.append(np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))), len(codes))
            columns = [rows[c].to_numpy() for c in ("id", "start", "end", "score")]
            found = [_picked(*(c[a:b] for c in columns), least, apart, longest) for a, b in zip(first, first[1:], strict=False)]
            of = rows[key].combine_chunks().take(pa.array(np.repeat(first[:-1], [len(f) for f in found])))
            yield pa.RecordBatch.from_arrays([of, pa.array([i for f in found for i in f], pa.int64())], [key, "id"])

    narrow = scored.select(F.col(key).cast("long").alias(key), F.col("id").cast("long").alias("id"), *[F.col(c).cast("double").alias(c) for c in ("start", "end", "score")])
    return narrow.repartition(key).sortWithinPartitions(key, "id").mapInArrow(pick, f"{key} long, id long")


def chapters(segments: DataFrame, breaks: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per chapter: times, segment range, words, speakers, text, the first three texts (opening), topic and film sets.

    Chapters are numbered by the running count of breaks; topics and films (arrays of names) are empty sets where segments lack them.
    """
    at = breaks.groupBy(key).agg(F.collect_set("id").alias("_at"))
    marked = segments.join(at, key, "left").withColumn("_b", F.coalesce(F.array_contains("_at", F.col("id")).cast("long"), F.lit(0))).drop("_at")
    numbered = marked.withColumn("chapter_id", F.sum("_b").over(Window.partitionBy(key).orderBy("id")))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda s: s["text"])
    names = lambda c: F.array_sort(F.filter(F.array_distinct(F.flatten(F.collect_set(c))), lambda x: x != "")) if c in segments.columns else F.array().cast("array<string>")
    found = numbered.groupBy(key, "chapter_id").agg(
        F.min("start").alias("start_time"), F.max("end").alias("end_time"), (F.max("end") - F.min("start")).alias("duration"), F.min("id").alias("segment_lo"), F.max("id").alias("segment_hi"),
        F.sum(word_count(F.col("text"))).alias("word_count"), F.array_join(F.array_sort(F.collect_set("speaker")), ",").alias("speakers"), texts.alias("_texts"), names("topics").alias("topics"), names("films").alias("films"))
    return found.withColumns({"text": F.array_join("_texts", ". "), "opening": F.slice("_texts", 1, 3)}).drop("_texts")


def key_phrases(chapter_rows: DataFrame, stopwords: list[str], k: int = 10, key: str = "doc_id") -> DataFrame:
    """Top k terms of each chapter by tf * ln((T + 1) / (g + 1)), T tokens and g occurrences of the transcript."""
    # Texts are dealt by transcript once; all that follows groups by the transcript too, so terms are never shuffled.
    words = chapter_rows.select(key, "chapter_id", "text").repartition(key).select(key, "chapter_id", F.explode(F.filter(tokens(F.col("text")), lambda w: (F.char_length(w) > 2) & ~w.isin(stopwords))).alias("term"))
    tf = words.groupBy(key, "chapter_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    sums = {"g": F.sum("tf").over(Window.partitionBy(key, "term")), "t": F.sum("tf").over(Window.partitionBy(key))}
    scored = tf.withColumns(sums).withColumn("score", F.col("tf") * F.log((F.col("t") + 1) / (F.col("g") + 1))).drop("g", "t")
    rank = F.row_number().over(Window.partitionBy(key, "chapter_id").orderBy(F.desc("score"), "term"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


def _top_terms(batches: Iterator[pa.RecordBatch], key: str, k: int) -> Iterator[pa.RecordBatch]:
    """batches, sorted by key, with `top`, the best terms of each row by the score of key_phrases, in place of `words`."""
    for rows in _whole(batches, key):
        transcript = rows[key].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
        words = rows["words"].combine_chunks()
        terms, row = words.flatten().dictionary_encode(), np.repeat(np.arange(rows.num_rows), np.diff(words.offsets.to_numpy()))
        n = max(len(terms.dictionary), 1)
        code, tf = np.unique(row * n + terms.indices.to_numpy(), return_counts=True)
        row, term = code // n, code % n
        _, at = np.unique(transcript[row] * n + term, return_inverse=True)
        g, t = np.bincount(at, tf)[at], np.bincount(transcript[row], tf)[transcript[row]]
        # Few distinct ratios: the logarithm of the C library for each.
        ratio, which = np.unique((t + 1) / (g + 1), return_inverse=True)
        score = tf * np.array([log(x) for x in ratio.tolist()])[which]
        place = np.empty(n, np.int64)
        place[pc.sort_indices(terms.dictionary).to_numpy()] = np.arange(len(terms.dictionary))
        order = np.lexsort((place[term], -score, row))
        starts = np.searchsorted(row[order], np.arange(rows.num_rows + 1))
        best = order[np.arange(len(order)) - starts[row[order]] < k]
        ends = np.concatenate(([0], np.cumsum(np.minimum(np.diff(starts), k)))).astype(np.int32)
        none = pa.array(np.append(ends[1:] == ends[:-1], False))
        top = pa.ListArray.from_arrays(pc.if_else(none, pa.scalar(None, pa.int32()), pa.array(ends)), terms.dictionary.take(pa.array(term[best])))
        yield from rows.drop_columns(["words"]).append_column("top", top).combine_chunks().to_batches()


def with_top_terms(chapter_rows: DataFrame, stopwords: list[str], k: int = 10, key: str = "doc_id") -> DataFrame:
    """chapter_rows with `top`, the terms of key_phrases by rank (null for a chapter without any), in place of text. Rows that lie by
    transcript are not dealt again, and terms are counted where they lie."""
    words = F.filter(tokens(F.coalesce("text", F.lit(""))), lambda w: (F.char_length(w) > 2) & ~w.isin(stopwords))
    # The window deals the rows by transcript, unless they lie so already.
    here = chapter_rows.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(key))).filter("_n > 0").drop("_n")
    cut = here.sortWithinPartitions(key, "chapter_id").withColumn("words", words).drop("text")
    kept = StructType([*[f for f in cut.schema if f.name != "words"], StructField("top", ArrayType(StringType()))])
    return cut.mapInArrow(lambda batches: _top_terms(batches, key, k), kept)


# The words that titles go by.
STARTERS = ["what ", "how ", "can you", "could you", "tell us", "when ", "where ", "why ", "do you", "did you", "have you"]
LEADS = ["So ", "And ", "Now ", "But ", "Well "]
TRAILS = ["the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "from", "about", "into", "your", "you", "our", "his", "her", "its"]


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _first_words(text: Column, most: int) -> Column:
    return F.array_join(F.slice(F.filter(F.split(text, r"\s+"), lambda w: w != ""), 1, most), " ")


def clean_title(title: Column, most: int = 8) -> Column:
    """At most so many words, without marks at the end, the first letter a capital; 'Untitled' if nothing is left."""
    bare = F.regexp_replace(_stripped(title), r"[.,;:\-—–]+$", "")
    cut = F.when(word_count(bare) > most, _first_words(bare, most)).otherwise(bare)
    return F.when(bare == "", "Untitled").otherwise(F.concat(F.upper(F.substring(cut, 1, 1)), F.substr(cut, F.lit(2))))


def question_title(text: Column, most: int = 8) -> Column:
    """The question of a segment that ends with one or starts like one, cut to so many words and without a trailing article, pronoun or
    preposition; null for other segments and for questions of fewer than three words."""
    t = _stripped(text)
    asks = t.endswith("?") | F.lower(t).rlike("^(" + "|".join(STARTERS) + ")")
    trailing = r"(?i)(?:(?:^|\s+)(?:" + "|".join(TRAILS) + "))+$"
    bare = F.regexp_replace(_stripped(F.regexp_replace(t, r"\?+$", "")), "^" + "".join(f"({w})?" for w in LEADS), "")
    words = F.regexp_replace(_first_words(bare, 2**31 - 1), trailing, "")
    cut = F.regexp_replace(_first_words(words, most), trailing, "")
    return F.when(asks & (word_count(words) >= 3), F.when(word_count(words) > most, cut).otherwise(words))


def guest_of(title: Column) -> Column:
    """The name before a dash in an episode's title, in title case if it was all capitals; null without a dash."""
    name = F.nullif(F.regexp_extract(_stripped(title), r"^(.+?)\s*[-—–]\s*(.+)$", 1), F.lit(""))
    proper = F.array_join(F.transform(F.split(F.lower(name), "'"), lambda x: F.initcap(x)), "'")
    return F.when((name == F.upper(name)) & (name != F.lower(name)), proper).otherwise(name)


def chapter_titles(chapter_rows: DataFrame, phrases: DataFrame | None = None, key: str = "doc_id", episodes: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, chapter_id, keep..., title). phrases come from key_phrases, 50 a chapter for the whole rule; without them, chapter_rows has
    them as `top` (with_top_terms), so that nothing is joined.

    By turns: 'Introduction' (with the guest, if the episode's title names one) for a first chapter that starts before 30 s; the first
    film with the best phrase that is no film; the first question among the first three segments; the two best terms of over three
    letters; 'Chapter n', also for a chapter without any term. episodes(key, title) may be None; an episode without a title has no
    introduction.
    """
    if phrases is None:
        joined = chapter_rows.withColumnRenamed("top", "_top")
    else:
        ranked = F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"])
        joined = chapter_rows.join(phrases.groupBy(key, "chapter_id").agg(ranked.alias("_top")), [key, "chapter_id"], "left")
    joined = joined.withColumn("_episode", F.lit(" ")) if episodes is None else joined.join(episodes.select(key, F.col("title").alias("_episode")), key, "left")
    films = F.transform("films", lambda f: F.lower(f))
    other = F.get(F.filter(F.slice("_top", 1, 5), lambda t: ~F.array_contains(films, t)), F.lit(0))
    film = F.get("films", F.lit(0))
    by_film = F.when(other.isNull(), F.concat(F.lit("On "), film)).otherwise(F.concat(film, F.lit(": "), F.initcap(other)))
    asked = F.get(F.filter(F.transform("opening", lambda t: question_title(t)), lambda q: q.isNotNull()), F.lit(0))
    long = F.transform(F.slice(F.filter("_top", lambda t: F.char_length(t) > 3), 1, 2), lambda t: F.initcap(t))
    terms = F.nullif(F.array_join(long, " and "), F.lit(""))
    numbered = F.concat(F.lit("Chapter "), F.col("chapter_id") + 1)
    intro = (F.col("chapter_id") == 0) & (F.col("start_time") < 30) & (F.col("_episode") != "")
    guest = guest_of(F.col("_episode"))
    title = (
        F.when(intro, F.concat(F.lit("Introduction"), F.when(guest.isNull(), "").otherwise(F.concat(F.lit(": "), guest))))
        .when(F.col("_top").isNull(), numbered).when(film.isNotNull(), clean_title(by_film)).when(asked.isNotNull(), clean_title(asked)).otherwise(F.coalesce(clean_title(terms), numbered))
    )
    return joined.select(key, "chapter_id", *keep, title.alias("title"))


def chapter_summaries(chapter_rows: DataFrame, stopwords: list[str], sentences: int = 2, words: int = 40, key: str = "doc_id", keep: tuple[str, ...] | None = None) -> DataFrame:
    """Extractive summary: sentences of 5 to 35 words that don't end with a question mark, by share of words of over three letters that
    are no stopwords (x .8 over 20 words), up to `sentences` and `words`, stopping at the first that doesn't fit; the best first, ties
    in text order. Chapters without a summary are left out; with further columns to `keep` they stay, with a null."""
    # A chapter is one row, so its sentences are ranked inside of it and none is shuffled.
    stripped = F.transform(F.split("text", r"(?<=[.!?])\s+"), lambda x, i: F.struct(i.alias("pos"), _stripped(x).alias("sentence")))
    counted = F.transform(stripped, lambda x: F.struct(x["pos"].alias("pos"), x["sentence"].alias("sentence"), word_count(x["sentence"]).cast("long").alias("n")))
    good = F.filter(counted, lambda x: (x["n"] >= 5) & (x["n"] <= 35) & ~x["sentence"].endswith("?"))
    content = lambda x: F.size(F.filter(F.split(F.lower(x["sentence"]), r"\s+"), lambda w: ~w.isin(stopwords) & (F.char_length(w) > 3)))
    score = lambda x: content(x) / x["n"] * F.when(x["n"] > 20, 0.8).otherwise(1.0)
    scored = F.transform(good, lambda x: F.struct((-score(x)).alias("score"), x["pos"].alias("pos"), x["n"].alias("n"), x["sentence"].alias("sentence")))
    best = chapter_rows.select(key, "chapter_id", *(keep or ()), F.slice(F.array_sort(scored), 1, sentences).alias("_best"))
    used = lambda i: F.aggregate(F.slice("_best", F.lit(1), i + 1), F.lit(0).cast("long"), lambda n, x: n + x["n"])
    fit = F.filter("_best", lambda x, i: used(i) <= words)
    fitted = best.withColumn("_best", fit) if keep else best.withColumn("_best", fit).filter(F.size("_best") > 0)
    return fitted.select(key, "chapter_id", *(keep or ()), F.when(F.size("_best") > 0, F.array_join(F.transform("_best", lambda x: x["sentence"]), " ")).alias("summary"))


def transcript_texts(segments: DataFrame, facts: DataFrame, chapter_rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, segments, chapters, text): a readable transcript per row of facts(key, title, date, duration, language, model, transcribed).

    A head with the facts and the list of chapters, then each segment with its time, after the head of the chapter(title, summary,
    start_time, segment_lo) that starts with it and the name of a speaker who differs from the last one known; then totals. Missing
    facts are 'unknown', a null or empty speaker changes nothing, a null text is empty.
    """
    order = Window.partitionBy(key).orderBy("id")
    named = F.nullif(F.col("speaker"), F.lit(""))
    before = F.last(named, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = chapter_rows.select(key, F.col("segment_lo").alias("id"), F.col("title").alias("_title"), F.col("summary").alias("_summary"))
    headed = segments.withColumn("_fresh", named.isNotNull() & ~named.eqNullSafe(before)).join(starts, [key, "id"], "left")
    head = F.concat(F.lit("\n--- "), "_title", F.lit(" ---\n"), F.when(F.coalesce("_summary", F.lit("")) != "", F.concat(F.lit("    "), "_summary", F.lit("\n"))).otherwise(""), F.lit("\n"))
    whole = F.floor("start").cast("long")
    time = F.format_string("[%02d:%02d:%06.3f]  ", F.floor(whole / 3600), F.floor(whole % 3600 / 60), F.col("start") % 60)
    text = F.coalesce("text", F.lit(""))
    line = F.concat(F.coalesce(head, F.lit("")), F.when(F.col("_fresh"), F.concat(F.lit("\n["), "speaker", F.lit("]\n"))).otherwise(""), time, text)
    joined = lambda: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda s: s["line"]), "\n")
    body = headed.select(key, F.col("id").alias("at"), line.alias("line"), word_count(text).alias("w")).groupBy(key).agg(joined().alias("_body"), F.count(F.lit(1)).alias("_n"), F.sum("w").alias("_words"))
    listed = chapter_rows.select(key, F.col("chapter_id").alias("at"), F.concat(F.lit("  "), clock_of(F.col("start_time")), F.lit("  "), "title").alias("line")).groupBy(key).agg(joined().alias("_list"), F.count(F.lit(1)).alias("_chapters"))
    total = lambda c: F.coalesce(c, F.lit(0))
    fact = lambda label, c: F.concat(F.lit(label + ": "), F.coalesce(F.col(c).cast("string"), F.lit("unknown")))
    seconds = F.floor(F.coalesce("duration", F.lit(0.0))).cast("long")
    lasting = F.when(seconds >= 3600, F.format_string("%d:%02d:%02d", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60)).otherwise(F.format_string("%d:%02d", F.floor(seconds / 60), seconds % 60))
    rule = F.lit("=" * 72)
    page = F.concat_ws(
        "\n", fact("TRANSCRIPT", "title"), fact("Date", "date"), F.concat(F.lit("Duration: "), lasting), fact("Language", "language"), fact("Model", "model"), fact("Transcribed", "transcribed"), F.lit(""),
        F.when(F.col("_chapters") > 0, F.concat(F.lit("CHAPTERS:\n"), "_list", F.lit("\n"))), rule, F.lit(""), "_body", F.lit(""), rule,
        F.concat(F.lit("Total segments: "), total("_n")), F.concat(F.lit("Total words: "), total("_words")), F.concat(F.lit("Total chapters: "), total("_chapters")))
    return facts.join(body, key, "left").join(listed, key, "left").select(key, total("_n").alias("segments"), total("_chapters").alias("chapters"), page.alias("text"))
