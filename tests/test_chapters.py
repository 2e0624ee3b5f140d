"""Titles, summaries, sets and headed transcripts on hand-made rows."""

from pyspark.sql import functions as F

from threadloom.operators import segments as ops

SEG = "doc_id long, id long, start double, end double, text string, speaker string, topics array<string>, films array<string>"
CHAPTER = "doc_id long, chapter_id long, start_time double, films array<string>, opening array<string>"


def test_chapters_have_sets_and_openings(spark):
    rows = [(1, i, 10.0 * i, 10.0 * i + 9, t, s, tp, f) for i, (t, s, tp, f) in enumerate([
        ("x" * 3000, "A", ["light", ""], []), ("How do you light a night scene?", None, None, ["Skyfall"]), ("c", "B", ["lens", "light"], ["Skyfall", "1917"]), ("d", "B", [], [])])]
    breaks = spark.createDataFrame([(1, 3)], "doc_id long, id long")
    first, second = ops.chapters(spark.createDataFrame(rows, SEG), breaks).orderBy("chapter_id").collect()
    assert (first.topics, first.films, first.speakers) == (["lens", "light"], ["1917", "Skyfall"], "A,B")
    assert first.opening[1] == "How do you light a night scene?" and (first.segment_lo, first.segment_hi) == (0, 2)
    assert (second.opening, second.topics) == (["d"], [])


def test_titles_by_film_question_terms_and_number(spark):
    rows = spark.createDataFrame([
        (1, 0, 0.0, [], ["hello"]), (1, 1, 60.0, ["Skyfall"], ["What is a lens?"]), (1, 2, 90.0, ["Skyfall"], []), (1, 3, 120.0, [], ["x" * 3000, "And so on", "How do you choose a lens for the"]),
        (1, 4, 150.0, [], ["Why not?"]), (1, 5, 180.0, [], []), (2, 0, 31.0, [], ["nothing"]), (3, 0, 0.0, [], ["What now is there to see?"]), (4, 0, 1.0, [], ["a b c?"])], CHAPTER)
    phrases = spark.createDataFrame([
        (1, 0, 1, "greeting"), (1, 1, 1, "skyfall"), (1, 1, 2, "shanghai"), (1, 2, 1, "skyfall"), (1, 3, 1, "lens"), (1, 4, 1, "not"), (1, 4, 2, "anamorphic"), (1, 4, 3, "key-light"), (2, 0, 1, "dolly"), (3, 0, 1, "see"), (4, 0, 1, "b")],
        "doc_id long, chapter_id long, rank int, term string")
    episodes = spark.createDataFrame([(1, "EDGAR O'WRIGHT - Director"), (2, "No dash"), (3, ""), (4, "No dash")], "doc_id long, title string")
    found = {(r.doc_id, r.chapter_id): r.title for r in ops.chapter_titles(rows, phrases, episodes=episodes).collect()}
    assert found == {
        (1, 0): "Introduction: Edgar O'Wright", (1, 1): "Skyfall: Shanghai", (1, 2): "On Skyfall", (1, 3): "How do you choose a lens", (1, 4): "Anamorphic and Key-light",
        (1, 5): "Chapter 6", (2, 0): "Dolly", (3, 0): "What now is there to see", (4, 0): "Introduction"}


def test_question_titles(spark):
    said = {
        "So how do you choose a lens for the?": "how do you choose a lens", "And Now what is it?": "what is it", "Why not?": None, "We went on.": None, "Tell us about the film you shot with the big camera in the desert": "Tell us about the film you shot",
        "of the in?": None, None: None, "  ": None, "one  two\tbathe??": "one two bathe",
    }
    rows = spark.createDataFrame([(k,) for k in said], "t string").select("t", ops.question_title(F.col("t")).alias("q")).collect()
    assert {r.t: r.q for r in rows} == said
    cleaned = spark.createDataFrame([("a, b.;",), ("—",), ("one two three four five six seven eight nine",)], "t string").select(ops.clean_title(F.col("t")).alias("c"))
    assert [r.c for r in cleaned.collect()] == ["A, b", "Untitled", "One two three four five six seven eight"]


def test_summaries_take_the_best_first(spark):
    text = "We had a go at it. Lighting interiors requires careful diffusion planning. Is that right or is it not? Moonlight exteriors demand enormous helium balloons overhead. ? in front is fine here somehow."
    rows = spark.createDataFrame([(1, 0, text), (2, 0, None), (3, 0, "")], "doc_id long, chapter_id long, text string")
    found = {r.doc_id: r.summary for r in ops.chapter_summaries(rows, ["with"]).collect()}
    assert found == {1: "Lighting interiors requires careful diffusion planning. Moonlight exteriors demand enormous helium balloons overhead."}


def test_transcript_with_heads_and_the_last_known_speaker(spark):
    segs = spark.createDataFrame([(1, 0, 0.0, "hi there", "A"), (1, 1, 61.5, "and", None), (1, 2, 3700.25, None, "A"), (1, 3, 3701.0, "bye", "B"), (1, 4, 3702.0, "ok", "")], "doc_id long, id long, start double, text string, speaker string")
    chapters = spark.createDataFrame([(1, 0, 0.0, 0, "Start", "All of it."), (1, 1, 3701.0, 3, "End", None)], "doc_id long, chapter_id long, start_time double, segment_lo long, title string, summary string")
    facts = spark.createDataFrame([(1, "Ep", "2024-01-01", 3703.9, "en", "m", None), (2, None, None, None, None, None, None)], "doc_id long, title string, date string, duration double, language string, model string, transcribed string")
    found = {r.doc_id: r for r in ops.transcript_texts(segs, facts, chapters).collect()}
    rule = "=" * 72
    assert found[1].text == (
        "TRANSCRIPT: Ep\nDate: 2024-01-01\nDuration: 1:01:43\nLanguage: en\nModel: m\nTranscribed: unknown\n\nCHAPTERS:\n  00:00:00  Start\n  01:01:41  End\n\n" + rule + "\n\n"
        "\n--- Start ---\n    All of it.\n\n\n[A]\n[00:00:00.000]  hi there\n[00:01:01.500]  and\n[01:01:40.250]  \n\n--- End ---\n\n\n[B]\n[01:01:41.000]  bye\n[01:01:42.000]  ok\n"
        "\n" + rule + "\nTotal segments: 5\nTotal words: 5\nTotal chapters: 2")  # fmt: skip
    assert found[2].text.startswith("TRANSCRIPT: unknown\nDate: unknown\nDuration: 0:00\n") and found[2].text.endswith("Total segments: 0\nTotal words: 0\nTotal chapters: 0")


def test_coherence_by_hand_on_gaps_and_many_batches_without_a_shuffle_of_terms(spark):
    """Boundaries see ids, not places; transcripts end within and at Arrow batches; of a scored transcript only its rows are dealt."""
    import random
    from collections import Counter

    from threadloom.operators import segments as ops

    rng, rows = random.Random(5), []
    for doc in range(40):
        ids = sorted(rng.sample(range(60), rng.randrange(1, 45)))
        rows += [(doc, i, float(i), i + 1.0, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "the", "an"]) for _ in range(rng.randrange(0, 6))), "S1", [], []) for i in ids]
    segs = spark.createDataFrame(rows, "doc_id long, id long, start double, end double, text string, speaker string, topics array<string>, films array<string>")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for most in ("7", before):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            scored = ops.break_scores(segs, ["the"])
            got = {(r.doc_id, r.id): r.coherence for r in scored.collect()}
            assert got
            for (doc, at), value in got.items():
                side = lambda lo, hi: Counter(w for d, i, *_, t, _s, _t, _f in rows if d == doc and at + lo <= i <= at + hi for w in t.split() if w not in ("the", "an"))  # noqa: B023, E731
                left, right = side(-6, -1), side(0, 5)
                size = sum(n * n for n in left.values()) * sum(n * n for n in right.values())
                assert abs(value - (1 - sum(left[w] * right[w] for w in left) / size**0.5 if size else 1.0)) < 1e-12
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hash")
    assert exchanges(scored) == 1
    chapter_rows = spark.createDataFrame([(1, 0, "alpha beta alpha"), (1, 1, "beta gamma"), (2, 0, "alpha")], "doc_id long, chapter_id long, text string")
    assert exchanges(ops.key_phrases(chapter_rows, ["the"])) == 1


def test_texts_move_once(spark):
    """Segments that lie by transcript are not dealt again, and sentences are ranked inside of their chapter."""
    from threadloom.plans import segments as plans

    scored = ops.break_scores(plans._tagged(spark, "/root/testdata/sf0.001"), plans.STOP)
    assert scored._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    rows = spark.createDataFrame([(1, 0, "One two three four five. Short one. Is this a question of words? " + "word " * 34 + "end. Holding several longer words matters greatly.")], "doc_id long, chapter_id long, text string")
    found = ops.chapter_summaries(rows, [])
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.first().summary == "Holding several longer words matters greatly."  # the second best doesn't fit


def test_texts_of_chapters_are_not_written(spark):
    """Titles and summaries read one exchange of the texts, write none and give what the phrases give (F3, F4)."""
    from threadloom.plans import segments as plans

    for made in (plans.chapter_titles(spark, "/root/testdata/sf0.001"), plans.chapter_summaries(spark, "/root/testdata/sf0.001")):
        assert made.collect()
        plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "ReusedExchange" in plan and all("documents.parquet" in line for line in plan.split("\n") if "FileScan" in line) and "PandasUDF" not in plan and "FlatMapGroupsInPandas" not in plan
    rows = spark.createDataFrame([(1, 0, "alpha beta alpha the of"), (1, 1, "beta gamma"), (1, 2, "an"), (2, 0, "alpha"), (2, 1, None), (None, 0, "beta beta")], "doc_id long, chapter_id long, text string")
    want = {}
    for r in ops.key_phrases(rows, ["the"], 2).orderBy("rank").collect():
        want.setdefault((r.doc_id, r.chapter_id), []).append(r.term)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for most in ("1", before):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            got = {(r.doc_id, r.chapter_id): r.top for r in ops.with_top_terms(rows, ["the"], 2).collect()}
            assert got == {(r.doc_id, r.chapter_id): want.get((r.doc_id, r.chapter_id)) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_breaks_of_many_transcripts(spark):
    """Breaks as the greedy rule gives them, null times and batches of one row included."""
    import random

    rng = random.Random(3)
    rows = [(d, i, None if d == 3 and i == 2 else 50.0 * i, 50.0 * i + 45, round(rng.random(), 1)) for d in range(12) for i in range(rng.randrange(1, 60))]
    want = set()
    for d in range(12):
        own = [r[1:] for r in rows if r[0] == d]
        edges, chosen = {min(r[1] for r in own if r[1] is not None), max(r[2] for r in own)}, {}
        for i, start, _, _ in sorted((r for r in own if r[3] >= 0.3), key=lambda r: (-r[3], r[0])):
            if start is not None and all(abs(start - e) >= 120 for e in edges):
                edges.add(start)
                chosen[i] = start
        bounds = sorted(edges)
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b - a > 300 and (before := [r for r in own if r[1] is not None and a < r[1] <= (a + b) / 2]):
                chosen[before[-1][0]] = before[-1][1]
        want |= {(d, i) for i in chosen}
    scored = spark.createDataFrame(rows, "doc_id long, id long, start double, end double, score double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for most in ("1", before):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            assert {(r.doc_id, r.id) for r in ops.choose_breaks(scored, longest=300.0).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
