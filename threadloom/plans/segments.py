"""Queries on timed transcripts and their terms, tags, chapters and corrections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import review
from threadloom.operators import segments as ops
from threadloom.sources import views
from threadloom.sources.scratch import joinable, materialize
from threadloom.sources.views import table, with_views

QUERIES, ORACLE_SQL = {}, {}
STOP = ["the", "and", "for", "with", "that", "this", "der", "die", "das", "und", "les", "des", "que", "los", "las"]
TOKENS = "regexp_extract_all(lower({}), '[a-z][a-z0-9''-]*[a-z0-9]|[a-z]')"
#: Dictionaries of words of the data; users pass their own.
TOPICS = [("articles", "the"), ("articles", "der"), ("articles", "les"), ("joining", "and"), ("joining", "und"), ("joining", "of the"), ("spanish", "los"), ("spanish", "de la")]
FILMS = [("one", "than"), ("one", "this"), ("two", "was"), ("two", "from the"), ("three", "est")]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _dictionary(spark, pairs):
    return spark.createDataFrame(pairs, "class string, keyword string")


def _values(pairs) -> str:
    return "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in pairs) + ") AS dict(class, keyword)"


def _stop_sql() -> str:
    return "[" + ", ".join(f"'{w}'" for w in STOP) + "]"


TURNS_SQL = """,
    tn AS (SELECT *, CASE WHEN lag(speaker) OVER w IS DISTINCT FROM speaker THEN 1 ELSE 0 END AS fresh FROM v_segments WINDOW w AS (PARTITION BY doc_id ORDER BY id)),
    tt AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY id) AS turn FROM tn)"""


@query(with_views("v_segments") + TURNS_SQL + """
    SELECT doc_id, turn::BIGINT AS turn, speaker, round(min(start), 6) AS start, count(*) AS segments, md5(string_agg(text, ' ' ORDER BY id)) AS text_md5 FROM tt GROUP BY doc_id, turn, speaker""")
def conversation_turns(spark, sf_dir):
    return ops.turns(views.segments(spark, sf_dir)).select("doc_id", "turn", "speaker", F.round("start", 6).alias("start"), "segments", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(with_views("v_segments") + " SELECT doc_id, speaker, first_id, row_number() OVER (PARTITION BY doc_id ORDER BY first_id) AS rank FROM (SELECT doc_id, speaker, min(id) AS first_id FROM v_segments GROUP BY ALL)")
def speaker_order(spark, sf_dir):
    return ops.speaker_order(views.segments(spark, sf_dir))


@query("""
    WITH p AS (SELECT doc_id, unnest(range(len(l))) AS id, unnest(l) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
    n AS (SELECT *, lower(trim(text, ' ')) AS low, list_filter(string_split(lower(trim(text, ' ')), ' '), lambda w: w <> '') AS words FROM p),
    k AS (SELECT *, lag(low) OVER (PARTITION BY doc_id ORDER BY id) AS before FROM n
          WHERE NOT (low = '' OR (len(words) <= 4 AND low IN ('the', 'the the', 'der', 'la')) OR (len(words) > 10 AND len(list_distinct(words)) < len(words) * 0.2)))
    SELECT doc_id, id, row_number() OVER (PARTITION BY doc_id ORDER BY id) - 1 AS new_id FROM k WHERE before IS NULL OR before <> low OR length(low) >= 50""")
def hallucination_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("id", "text")).withColumn("id", F.col("id").cast("long"))
    return ops.drop_hallucinations(lines, ["the", "the the", "der", "la"]).select("doc_id", "id", F.col("new_id").cast("long").alias("new_id"))


@query(with_views("v_segments") + """
    , t AS (SELECT *, max("end") OVER (PARTITION BY doc_id) AS total FROM v_segments)
    SELECT doc_id, id, CASE WHEN "end" <= 90 THEN 'intro' WHEN total > 0 AND start >= total - 120 THEN 'outro' ELSE 'content' END AS segment_type FROM t""")
def segment_types(spark, sf_dir):
    return ops.segment_types(views.segments(spark, sf_dir)).select("doc_id", "id", "segment_type")


@query(with_views("v_segments") + """
    , tr AS (SELECT doc_id, unnest(range(0, (max("end") // 20)::BIGINT + 1)) AS k FROM v_segments GROUP BY doc_id),
    t AS (SELECT doc_id, k * 20.0::DOUBLE AS s, k * 20.0::DOUBLE + 17 AS e, 'T' || (k % 3)::VARCHAR AS speaker FROM tr),
    o AS (SELECT v.doc_id, v.id, t.speaker, row_number() OVER (PARTITION BY v.doc_id, v.id ORDER BY least(v."end", t.e) - greatest(v.start, t.s) DESC, t.s) AS r
          FROM v_segments v JOIN t ON t.doc_id = v.doc_id AND v.start < t.e AND t.s < v."end")
    SELECT v.doc_id, v.id, o.speaker AS matched FROM v_segments v LEFT JOIN o ON o.doc_id = v.doc_id AND o.id = v.id AND o.r = 1""")
def overlap_best_speaker(spark, sf_dir):
    segs = views.segments(spark, sf_dir)
    ks = segs.groupBy("doc_id").agg(F.max("end").alias("last")).select("doc_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / 20).cast("int"))).alias("k"))
    speaker_turns = ks.select("doc_id", (F.col("k") * 20.0).alias("start"), (F.col("k") * 20.0 + 17).alias("end"), F.concat(F.lit("T"), F.col("k") % 3).alias("speaker"))
    return ops.best_overlap(segs, speaker_turns)


@query(f"""
    WITH t AS (SELECT doc_id, unnest({TOKENS.format("text")}) AS term FROM documents)
    SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df, count(*) FILTER (WHERE doc_id % 7 = 0) AS expert_tf FROM t GROUP BY term""")
def term_stats(spark, sf_dir):
    """Counted inside the row, so that a task gives one row for each of its terms; only texts that share an id meet by term and id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    expert = F.when(F.col("doc_id") % 7 == 0, F.col("n")).otherwise(0)
    known = F.col("doc_id").isNotNull().cast("int")
    again = materialize(docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id"))
    if again.isEmpty():
        alone, several = docs, None
    else:
        again = joinable(again)
        alone, several = docs.join(again, "doc_id", "left_anti"), docs.join(again, "doc_id", "left_semi")
    words = tx.marked_tokens(alone, "text", "doc_id").withColumns({"n": F.lit(1).cast("long"), "df": F.col("first") * known})
    if several is not None:
        per_doc = several.select("doc_id", F.explode(tx.tokens(F.col("text"))).alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))
        words = words.select("doc_id", "term", "n", "df").unionByName(per_doc.withColumn("df", F.lit(1)))
    return words.groupBy("term").agg(F.sum("n").alias("tf"), F.sum("df").alias("df"), F.coalesce(F.sum(expert), F.lit(0)).alias("expert_tf"))


@query(f"""
    WITH t AS (SELECT doc_id, unnest({TOKENS.format("text")}) AS term FROM documents), n AS (SELECT count(*) AS n FROM documents),
    s AS (SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM t GROUP BY term)
    SELECT term, round(tf * ln(n / df::DOUBLE), 6) AS tfidf FROM s, n ORDER BY tf * ln(n / df::DOUBLE) DESC, term LIMIT 200""")
def tfidf(spark, sf_dir):
    total = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("n"))
    score = F.col("tf") * F.when(F.col("df") > 0, F.log(F.col("n") / F.col("df"))).otherwise(float("inf"))
    return term_stats(spark, sf_dir).join(F.broadcast(total)).withColumn("score", score).orderBy(F.desc("score"), "term").limit(200).select("term", F.round("score", 6).alias("tfidf"))


def _hits_sql(pairs) -> str:
    one = [(a, b) for a, b in pairs if " " not in b]
    two = [(a, b) for a, b in pairs if " " in b]
    return f""",
    lw AS (SELECT doc_id, id, text, {TOKENS.format("text")} AS ws FROM v_segments),
    hit AS (SELECT DISTINCT l.doc_id, l.id, l.text, d.class, d.keyword FROM lw l, {_values(one).replace("dict(", "d(")} WHERE list_contains(l.ws, d.keyword)
            UNION SELECT l.doc_id, l.id, l.text, d.class, d.keyword FROM lw l, {_values(two).replace("dict(", "d(")} WHERE contains(' ' || array_to_string(l.ws, ' ') || ' ', ' ' || d.keyword || ' '))"""


TAGS_SQL = with_views("v_segments") + _hits_sql(TOPICS) + """,
    k AS (SELECT doc_id, id, text, class, count(*) AS k, string_agg(keyword, ',' ORDER BY keyword) AS keywords FROM hit WHERE length(trim(text)) >= 10 GROUP BY ALL),
    tag AS (SELECT doc_id, id, class, round(0.4::DOUBLE * least(k / 3.0::DOUBLE, 1.0) + 0.6::DOUBLE * least(10.0::DOUBLE * k / greatest(len(regexp_extract_all(text, '\\S+')), 1), 1.0), 3) AS confidence, keywords FROM k)"""


@query(TAGS_SQL + " SELECT doc_id, id, class, confidence, keywords FROM tag WHERE confidence >= 0.3")
def topic_tags(spark, sf_dir):
    return ops.topic_tags(views.segments(spark, sf_dir), _dictionary(spark, TOPICS), ["doc_id", "id"])


@query(TAGS_SQL + f""",
    post AS (SELECT doc_id, source, {TOKENS.format("text")} AS ws FROM documents), docs AS (SELECT count(*) AS docs FROM documents WHERE text <> ''),
    pt AS (SELECT doc_id, source, unnest(ws) AS term FROM post),
    vocab AS (SELECT term, count(*) * ln(docs / count(DISTINCT doc_id)::DOUBLE) AS tfidf FROM pt, docs GROUP BY term, docs),
    bk AS (SELECT h.doc_id, h.id, h.class, least(sum(coalesce(tfidf, 0)) / count(*) / 100, 0.3::DOUBLE) AS boost FROM hit h LEFT JOIN vocab ON vocab.term = h.keyword GROUP BY ALL),
    bt AS (SELECT k.doc_id, k.id, k.class, k.keywords, least(0.4::DOUBLE * least(k / 3.0::DOUBLE, 1.0) + 0.6::DOUBLE * least(10.0::DOUBLE * k / greatest(len(regexp_extract_all(text, '\\S+')), 1), 1.0) + boost, 1.0::DOUBLE) AS confidence
           FROM k JOIN bk ON bk.doc_id = k.doc_id AND bk.id = k.id AND bk.class = k.class),
    ix AS (SELECT term, source, count(DISTINCT doc_id) AS n FROM pt WHERE source IS NOT NULL GROUP BY ALL),
    sets AS (SELECT DISTINCT keywords FROM bt),
    rel AS (SELECT keywords, source, row_number() OVER (PARTITION BY keywords ORDER BY sum(n) DESC, source) AS r FROM (SELECT keywords, unnest(string_split(keywords, ',')) AS term FROM sets) s JOIN ix USING (term) GROUP BY keywords, source),
    named AS (SELECT keywords, string_agg(source, ',' ORDER BY r) AS related FROM rel WHERE r <= 3 GROUP BY keywords)
    SELECT doc_id, id, class, round(confidence, 3) AS confidence, keywords, coalesce(related, '') AS related FROM bt LEFT JOIN named USING (keywords) WHERE confidence >= 0.3""")
def topic_tags_by_corpus(spark, sf_dir):
    """Tags raised by the weight of their keywords in the corpus, with the sources that hold these keywords most."""
    docs = table(spark, sf_dir, "documents")
    corpus, index = ops.corpus_terms(docs, "text", "source")
    return ops.topic_tags(views.segments(spark, sf_dir), _dictionary(spark, TOPICS), ["doc_id", "id"], corpus=corpus, index=index)


@query(with_views("v_segments") + _hits_sql(FILMS) + " SELECT doc_id, id, class, least(count(*) / 2.0::DOUBLE, 1.0)::DOUBLE AS confidence FROM hit GROUP BY ALL")
def film_mentions(spark, sf_dir):
    return ops.mentions(views.segments(spark, sf_dir), _dictionary(spark, FILMS), ["doc_id", "id"]).withColumn("confidence", F.col("confidence").cast("double"))


@query(TAGS_SQL + " SELECT doc_id, class, count(*) AS segments, string_agg(DISTINCT k, ',' ORDER BY k) AS keywords FROM (SELECT doc_id, class, unnest(string_split(keywords, ',')) AS k, id FROM tag WHERE confidence >= 0.3) GROUP BY doc_id, class".replace("count(*) AS segments", "count(DISTINCT id) AS segments"))
def episode_topic_summary(spark, sf_dir):
    tags = ops.topic_tags(views.segments(spark, sf_dir), _dictionary(spark, TOPICS), ["doc_id", "id"])
    words = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("keywords", ","))))), ",")
    return tags.groupBy("doc_id", "class").agg(F.count(F.lit(1)).alias("segments"), words.alias("keywords"))


@query(f"""
    WITH t AS (SELECT DISTINCT doc_id, source, unnest({TOKENS.format("text")}) AS term FROM documents),
    post AS (SELECT term, source, count(*) AS n FROM t WHERE term IN ('idiot', 'moron', 'token', 'licensed', 'than') GROUP BY ALL),
    r AS (SELECT t.doc_id, p.source, sum(p.n)::BIGINT AS score, row_number() OVER (PARTITION BY t.doc_id ORDER BY sum(p.n) DESC, p.source) AS r FROM t JOIN post p ON p.term = t.term WHERE t.source = 'src1' GROUP BY 1, 2)
    SELECT doc_id, source AS related, score FROM r WHERE r <= 3""")
def related_topics(spark, sf_dir):
    """Top three sources by shared dictionary terms, from an inverted index term -> (source, documents)."""
    wanted = spark.createDataFrame([(w,) for w in ("idiot", "moron", "token", "licensed", "than")], "term string")
    terms = table(spark, sf_dir, "documents").select("doc_id", "source", F.explode(F.array_distinct(tx.tokens(F.col("text")))).alias("term")).join(wanted, "term", "left_semi")
    postings = terms.groupBy("term", F.col("source").alias("related")).agg(F.count(F.lit(1)).alias("n"))
    scored = terms.filter("source = 'src1'").join(postings, "term").groupBy("doc_id", "related").agg(F.sum("n").alias("score"))
    return scored.withColumn("r", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("score"), "related"))).filter("r <= 3").drop("r")


def _tagged(spark, sf_dir):
    """Segments with topics (first letters of long words) and films (two marked words), as arrays."""
    ws = tx.tokens(F.col("text"))
    longest = F.array_sort(F.array_distinct(F.transform(F.filter(ws, lambda w: F.char_length(w) > 8), lambda w: F.substring(w, 1, 1))))
    return views.segments(spark, sf_dir).withColumns({"topics": longest, "films": F.array_intersect(F.array_distinct(ws), F.array(F.lit("than"), F.lit("was"), F.lit("est")))})


def _vector_sql(lo: str, hi: str) -> str:
    return f"SELECT b.doc_id, b.id, t.term, sum(t.n)::DOUBLE AS n FROM seg b JOIN st t ON t.doc_id = b.doc_id AND t.id BETWEEN b.id + {lo} AND b.id + {hi} GROUP BY ALL"


BREAK_SQL = with_views("v_segments") + f""",
    seg AS (SELECT *, {TOKENS.format("text")} AS ws, count(*) OVER (PARTITION BY doc_id) AS n_all, start - lag("end") OVER (PARTITION BY doc_id ORDER BY id) AS gap FROM v_segments),
    st AS (SELECT doc_id, id, term, count(*) AS n FROM (SELECT doc_id, id, unnest(ws) AS term FROM seg) WHERE length(term) > 2 AND NOT list_contains({_stop_sql()}, term) GROUP BY ALL),
    lv AS ({_vector_sql("-6", "-1")}), rv AS ({_vector_sql("0", "5")}),
    ln AS (SELECT doc_id, id, sum(n * n) AS m FROM lv GROUP BY ALL), rn AS (SELECT doc_id, id, sum(n * n) AS m FROM rv GROUP BY ALL),
    dt AS (SELECT l.doc_id, l.id, sum(l.n * r.n) AS d FROM lv l JOIN rv r ON r.doc_id = l.doc_id AND r.id = l.id AND r.term = l.term GROUP BY ALL),
    side AS (SELECT doc_id, id, gap, count(*) OVER lw AS n_l, count(*) OVER rw AS n_r, n_all,
             list(list_distinct(list_transform(list_filter(ws, lambda w: length(w) > 8), lambda w: w[1:1]))) OVER lw AS tl, list(list_distinct(list_transform(list_filter(ws, lambda w: length(w) > 8), lambda w: w[1:1]))) OVER rw AS tr,
             list(list_filter(ws, lambda w: w IN ('than', 'was', 'est'))) OVER lw AS fl, list(list_filter(ws, lambda w: w IN ('than', 'was', 'est'))) OVER rw AS fr
             FROM seg WINDOW lw AS (PARTITION BY doc_id ORDER BY id ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), rw AS (PARTITION BY doc_id ORDER BY id ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)),
    sp AS (SELECT b.doc_id, b.id, (SELECT speaker FROM v_segments x WHERE x.doc_id = b.doc_id AND x.id BETWEEN b.id - 6 AND b.id - 1 GROUP BY speaker ORDER BY count(*) DESC, speaker LIMIT 1) AS a,
             (SELECT speaker FROM v_segments x WHERE x.doc_id = b.doc_id AND x.id BETWEEN b.id AND b.id + 5 GROUP BY speaker ORDER BY count(*) DESC, speaker LIMIT 1) AS b FROM seg b),
    sc AS (SELECT s.doc_id, s.id, CASE WHEN ln.m IS NULL OR rn.m IS NULL THEN 1.0 ELSE 1 - coalesce(dt.d, 0) / sqrt(ln.m * rn.m) END AS coherence,
             CASE WHEN greatest(gap, 0) < 2 THEN 0 ELSE least(greatest(gap, 0) / 8, 1) END AS pause,
             CASE WHEN len(list_distinct(flatten(tl) || flatten(tr))) = 0 THEN 0 ELSE 1 - len(list_intersect(list_distinct(flatten(tl)), list_distinct(flatten(tr)))) / len(list_distinct(flatten(tl) || flatten(tr)))::DOUBLE END AS topic,
             CASE WHEN sp.a <> sp.b THEN 1 ELSE 0 END AS speaker_turn,
             len(list_filter(list_distinct(flatten(fr)), lambda f: NOT list_contains(flatten(fl), f))) / greatest(len(list_distinct(flatten(fr))), 1)::DOUBLE AS film
             FROM side s JOIN sp ON sp.doc_id = s.doc_id AND sp.id = s.id LEFT JOIN ln ON ln.doc_id = s.doc_id AND ln.id = s.id LEFT JOIN rn ON rn.doc_id = s.doc_id AND rn.id = s.id
             LEFT JOIN dt ON dt.doc_id = s.doc_id AND dt.id = s.id WHERE n_l >= 2 AND n_r >= 2 AND n_all >= 4)
    SELECT doc_id, id, round(coherence, 4)::DOUBLE AS coherence, round(pause, 4)::DOUBLE AS pause, round(topic, 4)::DOUBLE AS topic, speaker_turn::DOUBLE AS speaker_turn, round(film, 4)::DOUBLE AS film,
           round(0.35 * coherence + 0.2 * pause + 0.2 * topic + 0.1 * speaker_turn + 0.15 * film, 4)::DOUBLE AS score FROM sc"""


@query(BREAK_SQL)
def break_scores(spark, sf_dir):
    found = ops.break_scores(_tagged(spark, sf_dir), STOP)
    return found.select("doc_id", "id", *[F.round(c, 4).alias(c) for c in ("coherence", "pause", "topic", "speaker_turn", "film", "score")])


def _chapters(spark, sf_dir):
    # Not written in between: the scores and the chapters read one exchange of the segments by transcript, and what is made of a chapter's
    # text is made where it lies.
    segs = _tagged(spark, sf_dir)
    return ops.chapters(segs, ops.choose_breaks(ops.break_scores(segs, STOP)))


def _titled(rows, *keep):
    return ops.chapter_titles(ops.with_top_terms(rows, STOP, 50), keep=keep)


@query()
def chapters(spark, sf_dir):
    return _chapters(spark, sf_dir).drop("text", "opening")


@query()
def chapter_titles(spark, sf_dir):
    return _titled(_chapters(spark, sf_dir))


@query()
def chapter_summaries(spark, sf_dir):
    # The test holds for all chapters; it keeps the columns of segments, so that scores and chapters read the same exchange here too.
    return ops.chapter_summaries(_chapters(spark, sf_dir).filter("end_time >= start_time and speakers >= ''"), STOP)


@query()
def chapter_exports(spark, sf_dir):
    """The podcast JSON and the plain-text line of each chapter."""
    titled = _titled(_chapters(spark, sf_dir), "start_time", "end_time")
    end = F.when(F.col("end_time") > F.col("start_time"), F.bround("end_time").cast("int"))
    doc = F.to_json(F.struct(F.bround("start_time").cast("int").alias("startTime"), end.alias("endTime"), "title", F.lit(True).alias("toc")))
    return titled.select("doc_id", "chapter_id", doc.alias("json"), F.concat_ws(" ", tx.clock_of(F.col("start_time")), F.col("title")).alias("line"))


@query(with_views("v_segments") + """
    SELECT doc_id, count(*) AS segments, sum(len(regexp_extract_all(text, '\\S+')))::BIGINT AS words, round(max("end") - min(start), 6) AS span, count(DISTINCT speaker) AS speakers,
           count(*) FILTER (WHERE length(text) > 60) AS tagged FROM v_segments GROUP BY doc_id""")
def transcript_stats(spark, sf_dir):
    return views.segments(spark, sf_dir).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("segments"), F.sum(tx.word_count(F.col("text"))).alias("words"), F.round(F.max("end") - F.min("start"), 6).alias("span"), F.count_distinct("speaker").alias("speakers"),
        F.count_if(F.char_length("text") > 60).alias("tagged"))


@query(with_views("v_segments") + TURNS_SQL + """
    SELECT doc_id, count(*) AS lines, md5(string_agg(CASE WHEN fresh = 1 THEN '[' || speaker || '] ' ELSE '' END || text, chr(10) ORDER BY id)) AS text_md5 FROM tt GROUP BY doc_id""")
def transcript_text(spark, sf_dir):
    """Readable transcripts with a mark at each change of speaker."""
    segs = views.segments(spark, sf_dir)
    before = F.lag("speaker").over(Window.partitionBy("doc_id").orderBy("id"))
    line = F.concat(F.when(before.isNull() | (before != F.col("speaker")), F.concat(F.lit("["), "speaker", F.lit("] "))).otherwise(""), "text")
    lines = segs.select("doc_id", "id", line.alias("line")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("id", "line"))).alias("l"))
    return lines.select("doc_id", F.size("l").cast("long").alias("lines"), F.md5(F.array_join(F.transform("l", lambda s: s["line"]), "\n").cast("binary")).alias("text_md5"))


@query()
def transcript_doc(spark, sf_dir):
    """One JSON document per transcript with its statistics and segments."""
    item = F.struct("id", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), "speaker", "text")
    docs = views.segments(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(item)).alias("segments"))
    return docs.select("doc_id", F.to_json(F.struct(F.col("doc_id").alias("episodeId"), F.size("segments").alias("segmentCount"), "segments")).alias("document"))


def _edited(spark, sf_dir):
    """Corrected segments: every seventh has a new speaker, every eleventh upper-case text, every 13th is a split piece."""
    return views.segments(spark, sf_dir).selectExpr("doc_id", "case when id % 13 = 12 then id + 1000000 else id end as id", "case when id % 7 = 3 then 'S9' else speaker end as speaker", "case when id % 11 = 5 then upper(text) else text end as text")


@query(with_views("v_segments") + """
    , g AS (SELECT doc_id, CASE WHEN id % 13 = 12 THEN id + 1000000 ELSE id END AS id, CASE WHEN id % 7 = 3 THEN 'S9' ELSE speaker END AS speaker, CASE WHEN id % 11 = 5 THEN upper(text) ELSE text END AS text FROM v_segments)
    SELECT g.doc_id, count(*) FILTER (WHERE g.speaker <> o.speaker) AS speaker_changes, count(*) FILTER (WHERE g.text <> o.text) AS text_changes,
           count(*) FILTER (WHERE g.text <> o.text OR g.speaker <> o.speaker) AS modified, count(*) FILTER (WHERE o.id IS NULL) AS splits
    FROM g LEFT JOIN v_segments o ON o.doc_id = g.doc_id AND o.id = g.id GROUP BY g.doc_id""")
def edit_diff(spark, sf_dir):
    return review.edit_summary(_edited(spark, sf_dir), views.segments(spark, sf_dir))


@query(with_views("v_segments") + """
    , c AS (SELECT doc_id, id, start, "end", string_split(text, ' ') AS w, max(id) OVER (PARTITION BY doc_id) AS last FROM v_segments),
    s AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY id) AS k FROM c WHERE len(w) >= 9)
    SELECT doc_id, id AS from_id, p AS piece, CASE WHEN p = 0 THEN id ELSE last + 2 * (k - 1) + p END AS id, round(start + ("end" - start) * (p * 3) / len(w), 6) AS start,
           round(start + ("end" - start) * CASE WHEN p = 2 THEN len(w) ELSE p * 3 + 3 END / len(w), 6) AS "end", array_to_string(CASE WHEN p = 2 THEN w[7:] ELSE w[p * 3 + 1 : p * 3 + 3] END, ' ') AS text
    FROM s, (SELECT unnest([0, 1, 2]) AS p)""")
def segment_split(spark, sf_dir):
    """Long segments split after their third and sixth word; pieces share the time by words, new ids go on after the largest."""
    return review.split_segments(views.segments(spark, sf_dir), [3, 6], least_words=9)


@query("""
    WITH r AS (SELECT doc_id, unnest(range(len(l))) AS id, unnest(l) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
    SELECT doc_id, count(*) AS rows_, count(*) FILTER (WHERE trim(text, ' ') = '' OR id % 17 = 16) AS rejected FROM r GROUP BY doc_id""")
def corrected_segment_validation(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("id", "text"))
    rows = lines.withColumn("speaker", F.when(F.col("id") % 17 != 16, F.lit("S0")))
    bad = review.missing_fields(rows, ["doc_id", "id", "text", "speaker"]) | (F.trim("text") == "")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows_"), F.count_if(bad).alias("rejected"))


@query(with_views("v_reviews") + """
    SELECT slug, count(DISTINCT segment_id) AS reviewed, round(count(DISTINCT segment_id) / (SELECT max(segment_id) + 1 FROM v_reviews)::DOUBLE, 6) AS coverage FROM v_reviews GROUP BY slug""")
def review_progress(spark, sf_dir):
    log = views.reviews(spark, sf_dir)
    total = log.agg((F.max("segment_id") + 1).alias("total"))
    return review.progress(log.join(F.broadcast(total)))


@query(with_views("v_reviews") + """
    , f AS (SELECT slug, segment_id, min(session) AS first FROM v_reviews GROUP BY ALL),
    s AS (SELECT DISTINCT slug, session FROM v_reviews),
    n AS (SELECT s.slug, s.session, count(f.segment_id) AS fresh FROM s LEFT JOIN f ON f.slug = s.slug AND f.first = s.session GROUP BY ALL),
    c AS (SELECT *, sum(fresh) OVER (PARTITION BY slug ORDER BY session)::BIGINT AS reviewed, row_number() OVER (PARTITION BY slug ORDER BY session DESC) AS r FROM n)
    SELECT slug, strftime(session, '%Y-%m-%d') AS session, fresh, reviewed FROM c WHERE r <= 20""")
def review_sessions(spark, sf_dir):
    return review.sessions(views.reviews(spark, sf_dir), keep=20).withColumn("session", F.date_format("session", "yyyy-MM-dd"))


@query(with_views("v_segments") + """
    , seg AS (SELECT doc_id, id, text, start, "end", CASE WHEN id % 7 = 3 THEN NULL ELSE speaker END AS speaker FROM v_segments),
    b AS (SELECT *, last_value(speaker IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM seg),
    body AS (SELECT doc_id, count(*) AS n, sum(len(regexp_extract_all(text, '\\S+')))::BIGINT AS words, max("end") AS duration, count(*) FILTER (WHERE id % 20 = 0) AS chapters,
             string_agg(CASE WHEN id % 20 = 0 THEN chr(10) || '--- Part ' || (id // 20 + 1) || ' ---' || chr(10) || CASE WHEN id // 20 % 2 = 0 THEN '    Said by ' || coalesce(speaker, 'nobody') || chr(10) ELSE '' END || chr(10) ELSE '' END
                 || CASE WHEN speaker IS NOT NULL AND speaker IS DISTINCT FROM before THEN chr(10) || '[' || speaker || ']' || chr(10) ELSE '' END
                 || printf('[%02d:%02d:%06.3f]  ', floor(start)::BIGINT // 3600, floor(start)::BIGINT % 3600 // 60, start % 60) || text, chr(10) ORDER BY id) AS body,
             string_agg(printf('  %02d:%02d:%02d  Part %d', floor(start)::BIGINT // 3600, floor(start)::BIGINT % 3600 // 60, floor(start)::BIGINT % 60, id // 20 + 1), chr(10) ORDER BY id) FILTER (WHERE id % 20 = 0) AS listed FROM b GROUP BY doc_id),
    f AS (SELECT d.doc_id, d.lang, coalesce(body.n, 0) AS n, coalesce(words, 0) AS words, floor(coalesce(duration, 0))::BIGINT AS s, coalesce(chapters, 0) AS chapters, body, listed FROM documents d LEFT JOIN body ON body.doc_id = d.doc_id)
    SELECT doc_id, n AS segments, chapters, md5(concat_ws(chr(10), 'TRANSCRIPT: Document ' || doc_id, 'Date: unknown',
        'Duration: ' || CASE WHEN s >= 3600 THEN printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%d:%02d', s // 60, s % 60) END, 'Language: ' || coalesce(lang, 'unknown'), 'Model: none', 'Transcribed: unknown', '',
        'CHAPTERS:' || chr(10) || listed || chr(10), repeat('=', 72), '', body, '', repeat('=', 72), 'Total segments: ' || n, 'Total words: ' || words, 'Total chapters: ' || chapters)) AS text_md5 FROM f""")
def transcript_headed(spark, sf_dir):
    """Transcripts with chapter heads, here a part at each twentieth segment; each seventh segment has no speaker."""
    segs = views.segments(spark, sf_dir).withColumn("speaker", F.when(F.col("id") % 7 != 3, F.col("speaker")))
    part = F.floor(F.col("id") / 20).cast("long")
    said = F.when(part % 2 == 0, F.concat(F.lit("Said by "), F.coalesce("speaker", F.lit("nobody"))))
    parts = segs.filter("id % 20 = 0").select("doc_id", part.alias("chapter_id"), F.col("start").alias("start_time"), F.col("id").alias("segment_lo"), F.concat(F.lit("Part "), part + 1).alias("title"), said.alias("summary"))
    lasting = segs.groupBy("doc_id").agg(F.max("end").alias("duration"))
    facts = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("Document "), "doc_id").alias("title"), F.lit(None).cast("string").alias("date"), F.col("lang").alias("language"), F.lit("none").alias("model"), F.lit(None).cast("string").alias("transcribed"))
    found = ops.transcript_texts(segs, facts.join(lasting, "doc_id", "left"), parts)
    return found.select("doc_id", "segments", "chapters", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query()
def chapter_transcripts(spark, sf_dir):
    """Readable transcripts under the titles and summaries of their own chapters."""
    summed = ops.chapter_summaries(_chapters(spark, sf_dir), STOP, keep=("text", "films", "opening", "start_time", "end_time", "segment_lo"))
    rows = titled = materialize(_titled(summed, "start_time", "end_time", "segment_lo", "summary"))
    nothing = F.lit(None).cast("string")
    facts = rows.groupBy("doc_id").agg(F.max("end_time").alias("duration")).select("doc_id", F.concat(F.lit("Document "), "doc_id").alias("title"), nothing.alias("date"), "duration", nothing.alias("language"), nothing.alias("model"), nothing.alias("transcribed"))
    return ops.transcript_texts(views.segments(spark, sf_dir), facts, titled)
