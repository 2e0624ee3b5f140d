"""Full-text search on a postings table: boolean, phrase, prefix and field queries, BM25, facets, snippets, stemming."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import tokens

K1, B = 1.2, 0.75


def postings(docs: DataFrame, key: str, fields: dict[str, str], cut: Callable[[Column], Column] = tokens) -> DataFrame:
    """(key, field, term, tf, positions) of docs; fields maps index field to column, cut gives the tokens of a text. Terms of a document
    meet in its own row group: the aggregation keys hold the document, so a term of every document is no hot key."""
    parts = [docs.select(key, F.lit(f).alias("field"), F.posexplode(cut(F.coalesce(F.col(c).cast("string"), F.lit("")))).alias("pos", "term")) for f, c in fields.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy(key, "field", "term").agg(F.count(F.lit(1)).alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))


def lengths(index: DataFrame, key: str) -> DataFrame:
    return index.groupBy(key).agg(F.sum("tf").alias("length"))


def match_all(index: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """Documents that hold every term."""
    return index.filter(F.col("term").isin(terms)).groupBy(key).agg(F.count_distinct("term").alias("_n")).filter(F.col("_n") == len(set(terms))).select(key)


def match_any(index: DataFrame, key: str, terms: list[str], prefixes: list[str] = ()) -> DataFrame:
    test = F.col("term").isin(terms)
    for p in prefixes:
        test = test | F.col("term").startswith(p)
    return index.filter(test).select(key).distinct()


def match_phrase(index: DataFrame, key: str, words: list[str]) -> DataFrame:
    """Documents with the words in a row in one field: positions shifted by the word's place must meet."""
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    rows = None
    for w, at in places.items():
        found = index.filter(F.col("term") == w).select(key, "field", F.explode("positions").alias("p"))
        part = found.withColumn("i", F.explode(F.array(*[F.lit(a) for a in at])))
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy(key, "field", (F.col("p") - F.col("i")).alias("first")).agg(F.count_distinct("i").alias("n")).filter(F.col("n") == len(words)).select(key).distinct()


def search(index: DataFrame, key: str, all_of=(), any_of=(), none_of=(), phrase=(), prefix=(), columns=(), facets: DataFrame | None = None, limit: int = 20) -> DataFrame:
    """(key, score): documents that meet all given conditions, by BM25 of the positive terms, best first, ties by key.

    facets(key) restricts the documents before ranking. Only postings of the query's terms move; statistics of all
    documents are two small aggregates.
    """
    within = index.filter(F.col("field").isin(list(columns))) if columns else index
    found = None

    def narrow(rows: DataFrame) -> None:
        nonlocal found
        found = rows if found is None else found.join(rows, key, "left_semi")

    if all_of:
        narrow(match_all(within, key, list(all_of)))
    if any_of or prefix:
        narrow(match_any(within, key, list(any_of), list(prefix)))
    if phrase:
        narrow(match_phrase(within, key, list(phrase)))
    if found is None:
        raise ValueError("a search needs a positive condition")
    if none_of:
        found = found.join(match_any(within, key, list(none_of)), key, "left_anti")
    if facets is not None:
        found = found.join(facets.select(key), key, "left_semi")
    size = lengths(index, key)
    stats = size.agg(F.count(F.lit(1)).alias("_docs"), F.avg("length").alias("_mean"))
    terms = sorted({*all_of, *any_of, *phrase})
    test = F.col("term").isin(terms)
    for p in prefix:
        test = test | F.col("term").startswith(p)
    per_doc = within.filter(test).groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    df = per_doc.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    hits = per_doc.join(found, key, "left_semi").join(F.broadcast(df) if not prefix else df, "term").join(size, key).join(F.broadcast(stats))
    idf = F.log(1 + (F.col("_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("_mean")))
    ranked = hits.groupBy(key).agg(F.round(F.sum(part), 6).alias("score"))
    return ranked.orderBy(F.desc("score"), key).limit(limit)


def hit_counts(index: DataFrame, key: str, queries: DataFrame) -> DataFrame:
    """(name, hits) for queries(name, keyword): all queries meet the postings in one join."""
    hits = index.join(queries.withColumnRenamed("keyword", "term"), "term").select("name", key).distinct().groupBy("name").agg(F.count(F.lit(1)).alias("hits"))
    return queries.select("name").distinct().join(hits, "name", "left").select("name", F.coalesce("hits", F.lit(0)).alias("hits"))


def snippets(hits: DataFrame, text: str, words: list[str], window: int = 32) -> DataFrame:
    """hits with a snippet: the window of words with most matches (the first of those), matches marked. For the few rows of a
    result page."""
    w = F.split(F.col(text), r"\s+")
    plain = F.transform(w, lambda x: F.regexp_replace(F.lower(x), "[^a-z0-9]", "").isin(words))
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - window + 1, F.lit(1)))
    counts = F.transform(starts, lambda i: F.struct((-F.size(F.filter(F.slice(plain, i, window), lambda b: b))).alias("n"), i.alias("i")))
    rows = hits.withColumns({"_w": w, "_m": plain, "_at": F.array_min(counts)["i"]})
    shown = F.zip_with(F.slice("_w", F.col("_at"), window), F.slice("_m", F.col("_at"), window), lambda x, b: F.when(b, F.concat(F.lit("<mark>"), x, F.lit("</mark>"))).otherwise(x))
    head, tail = F.when(F.col("_at") > 1, "...").otherwise(""), F.when(F.size("_w") > F.col("_at") + window - 1, "...").otherwise("")
    return rows.withColumn("snippet", F.concat(head, F.array_join(shown, " "), tail)).drop("_w", "_m", "_at")


def porter_stem(word: str) -> str:
    """Suffix stripping in the manner of Porter (1980): steps 1a to 1c, 2 and 3 by table, 4 and 5 by measure."""
    def consonant(s: str, i: int) -> bool:
        return s[i] not in "aeiou" and not (s[i] == "y" and i > 0 and consonant(s, i - 1))

    def measure(s: str) -> int:
        kinds = "".join("c" if consonant(s, i) else "v" for i in range(len(s)))
        return sum(kinds[i] == "v" and kinds[i + 1] == "c" for i in range(len(kinds) - 1))

    def vowel(s: str) -> bool:
        return any(not consonant(s, i) for i in range(len(s)))

    def double(s: str) -> bool:
        return len(s) > 1 and s[-1] == s[-2] and consonant(s, len(s) - 1)

    def cvc(s: str) -> bool:
        return len(s) > 2 and consonant(s, len(s) - 3) and not consonant(s, len(s) - 2) and consonant(s, len(s) - 1) and s[-1] not in "wxy"

    if len(word) < 3 or not word.isascii():
        return word
    for old, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(old):
            word = word[: len(word) - len(old)] + new
            break
    if word.endswith("eed"):
        word = word[:-1] if measure(word[:-3]) > 0 else word
    else:
        for end in ("ed", "ing"):
            if word.endswith(end) and vowel(word[: -len(end)]):
                word = word[: -len(end)]
                if word.endswith(("at", "bl", "iz")):
                    word += "e"
                elif double(word) and word[-1] not in "lsz":
                    word = word[:-1]
                elif measure(word) == 1 and cvc(word):
                    word += "e"
                break
    if word.endswith("y") and vowel(word[:-1]):
        word = word[:-1] + "i"
    # The suffix tables of the published algorithm.
    step2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
    step3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
    for table in (step2, step3):
        for end in sorted((e for e in table if word.endswith(e)), key=len, reverse=True)[:1]:
            if measure(word[: -len(end)]) > 0:
                word = word[: -len(end)] + table[end]
    step4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")
    for end in sorted((e for e in step4 if word.endswith(e)), key=len, reverse=True)[:1]:
        stem = word[: -len(end)]
        if measure(stem) > 1 and (end != "ion" or stem.endswith(("s", "t"))):
            word = stem
    if word.endswith("e") and (measure(word[:-1]) > 1 or measure(word[:-1]) == 1 and not cvc(word[:-1])):
        word = word[:-1]
    return word[:-1] if measure(word) > 1 and double(word) and word.endswith("l") else word


def stemmed(term: str) -> Column:
    @F.pandas_udf("string")
    def stem(terms: pd.Series) -> pd.Series:
        return terms.map(porter_stem)

    return stem(term)


def stem_index(index: DataFrame, key: str, *keep: str) -> DataFrame:
    """The index with stems for terms; keep names further columns that depend on the key. Only distinct terms go through Python; the stems
    join back by term."""
    vocabulary = index.select("term").distinct().select("term", stemmed("term").alias("stem"))
    joined = index.join(vocabulary, "term")
    return joined.groupBy(key, *keep, "field", F.col("stem").alias("term")).agg(F.sum("tf").alias("tf"), F.array_sort(F.flatten(F.collect_list("positions"))).alias("positions"))
