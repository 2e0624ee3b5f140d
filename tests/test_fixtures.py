"""Hand fixtures for shapes that the driver tables don't have."""

import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import curation, posts, review, search, segments, threads
from threadloom.sources import extract, leaves, sinks


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(expr.alias("x")).first().x


def test_segment_types_sweep(spark):
    cases = [(0, 89.9, "intro"), (0, 90.0, "intro"), (90.1, 200, "content"), (1700, 1900, "content"), (3480, 3590, "outro"), (3600, 3600, "outro"), (80, 90, "intro")]
    rows = [(1, i, float(a), float(b), "t", "S") for i, (a, b, _) in enumerate(cases)]
    got = segments.segment_types(spark.createDataFrame(rows, "doc_id long, id long, start double, end double, text string, speaker string"))
    assert {r.id: r.segment_type for r in got.collect()} == {i: c[2] for i, c in enumerate(cases)}


def test_hallucinations(spark):
    long = "this very long repeated text has more than fifty characters in it"
    texts = ["", "yes", "yes", "yes", long, long, "thanks", "a", "thanks for watching", "a", "no no no no no no no no no no no yes"]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)], "doc_id long, id long, text string")
    kept = segments.drop_hallucinations(df, ["thanks for watching"]).orderBy("id").collect()
    assert [r.id for r in kept] == [1, 4, 5, 6, 7] and [r.new_id for r in kept] == [0, 1, 2, 3, 4]


def test_best_overlap(spark):
    segs = spark.createDataFrame([(1, 0, 0.0, 10.0), (1, 1, 10.0, 20.0), (1, 2, 25.0, 30.0), (1, 3, 100.0, 300.0), (1, 4, 40.0, 50.0)], "doc_id long, id long, start double, end double")
    turns = spark.createDataFrame([(1, 0.0, 15.0, "A"), (1, 15.0, 25.0, "B"), (1, 90.0, 150.0, "A"), (1, 150.0, 290.0, "C")], "doc_id long, start double, end double, speaker string")
    assert {r.id: r.matched for r in segments.best_overlap(segs, turns).collect()} == {0: "A", 1: "A", 2: None, 3: "C", 4: None}


def test_breaks_are_apart_and_long_chapters_are_cut(spark):
    rows = [(1, i, 100.0 * i, 100.0 * i + 95, 0.9 if i in (4, 5) else 0.1) for i in range(1, 40)]
    got = segments.choose_breaks(spark.createDataFrame(rows, "doc_id long, id long, start double, end double, score double"), apart=150.0).collect()
    ids = sorted(r.id for r in got)
    assert 4 in ids and 5 not in ids and len(ids) == 2


@pytest.mark.parametrize("n,chars,expert,kind", [(0, 10, False, "zero"), (1, 10, False, "one"), (2, 10, False, "two"), (3, 10, False, "low"), (3, 400, False, "medium"), (5, 10, True, "medium"), (6, 10, False, "medium"), (10, 10, False, "medium"), (11, 10, False, "high")])
def test_engagement(spark, n, chars, expert, kind):
    rows = [(f"p{i}", "pro" if expert and i == 0 else "x", "c" * chars) for i in range(n + 1)]
    topics = spark.createDataFrame([("t", "f", [r[0] for r in rows], n)], "topic_slug string, forum_slug string, post_ids array<string>, reply_count int")
    got = curation.engagement(topics, spark.createDataFrame(rows, "post_id string, author string, content_text string"), ["pro"]).first()
    assert got.engagement == kind and got.post_count == n + 1


def test_engagement_of_an_empty_topic(spark):
    topics = spark.createDataFrame([("t", "f", [], -1)], "topic_slug string, forum_slug string, post_ids array<string>, reply_count int")
    got = curation.engagement(topics, spark.createDataFrame([], "post_id string, author string, content_text string"), ["pro"]).first()
    assert got.engagement == "low" and got.mean_chars == 0


def test_tree_with_orphans_and_cycles(spark):
    rows = [("t", "1", None, 0), ("t", "2", "1", 1), ("t", "3", "2", 2), ("t", "4", "1", None), ("t", "5", "gone", 4), ("t", "6", "7", 5), ("t", "7", "6", 6), ("u", "9", "8", 0)]
    df = spark.createDataFrame([(*r, None) for r in rows], "topic_slug string, post_id string, parent_post_id string, position int, ts timestamp")
    got = {r.post_id: (r.depth, r.path) for r in threads.reply_tree(df).collect()}
    assert got == {"1": (0, ""), "2": (1, "000001."), "3": (2, "000001.000001."), "4": (1, "000002."), "9": (0, "")}
    assert {(r.post_id, r.cycle_length) for r in threads.on_cycles(df).collect()} == {("6", 2), ("7", 2)}


def test_long_threads_and_long_cycles(spark):
    rows = [("t", f"c{i}", f"c{i - 1}" if i else None, i) for i in range(700)] + [("t", f"r{i}", f"r{(i + 1) % 130}", None) for i in range(130)] + [("t", "below", "r7", None)]
    df = spark.createDataFrame([(*r, None) for r in rows], "topic_slug string, post_id string, parent_post_id string, position int, ts timestamp")
    tree = threads.reply_tree(df).select("post_id", "depth", "path").collect()
    assert {(r.post_id, r.depth, r.path) for r in tree} == {(f"c{i}", i, "000001." * i) for i in range(700)} and len(tree) == 700
    assert {(r.post_id, r.cycle_length) for r in threads.on_cycles(df).collect()} == {(f"r{i}", 130) for i in range(130)}


def test_text_functions(spark):
    assert one(spark, tx.seconds_of(F.lit("01:28:37"))) == 5317 and one(spark, tx.seconds_of(F.lit("47:10"))) == 2830
    assert [one(spark, tx.seconds_of(F.lit(x))) for x in ("", "abc", "90")] == [0, 0, 90]
    assert one(spark, tx.slug(F.lit("  Héllo, World -- 2 "))) == "hllo-world-2" and one(spark, tx.clock_of(F.lit(3725.9))) == "01:02:05"
    ts, sure = tx.forum_timestamp(F.lit("January 18, 2023 at 3:32 pm#12"))
    assert str(one(spark, ts)) == "2023-01-18 15:32:00" and one(spark, sure) == "medium"
    assert one(spark, tx.forum_timestamp(F.lit("nonsense"))[1]) == "low" and one(spark, tx.forum_timestamp(F.lit(None).cast("string"))[1]) == "none"
    assert str(one(spark, tx.mail_date(F.lit("Wed, 18 Jan 2023 23:30:00 -0500")))) == "2023-01-19"
    assert one(spark, tx.any_date(F.lit("18 January 2023"))) == "2023-01-18" and one(spark, tx.any_date(F.lit("soon"))) == "soon"
    assert one(spark, tx.guest_name(F.lit("SEASON 2 - EPISODE 3 - JANE DOE - Editor"))) == "Jane Doe"
    assert one(spark, tx.film_slug(F.lit("film-night-train-2049-opening"), ["film"], ["opening"])) == "night-train"
    assert one(spark, tx.has_word(F.lit("the éled light"), "led")) is False and one(spark, tx.has_word(F.lit("an LED."), "led")) is True
    name = tx.episode_dir(F.lit(2), F.lit(176), F.lit("2023-01-18"), F.lit("A Title"), F.lit("x1"))
    assert one(spark, F.array(*[c.cast("string") for c in tx.parse_episode_dir(name)])) == ["2", "176", "2023-01-18", "a-title"]


def test_dictionary_counts_overlaps(spark):
    df = spark.createDataFrame([(1, "key light and key light key"), (2, "nothing")], "id long, text string")
    words = spark.createDataFrame([("t", "key light"), ("t", "key"), ("u", "key")], "class string, keyword string")
    got = {(r.id, r["class"], r.keyword): r.n for r in tx.dictionary_hits(df, words, ["id"], "text").collect()}
    assert got == {(1, "t", "key light"): 2, (1, "t", "key"): 3, (1, "u", "key"): 3}


@pytest.mark.parametrize("word,stem", [("caresses", "caress"), ("ponies", "poni"), ("hopping", "hop"), ("relational", "relat"), ("happy", "happi"), ("lighting", "light"), ("sky", "sky"), ("adjustment", "adjust"), ("probate", "probat"), ("roll", "roll")])
def test_stems(word, stem):
    assert search.porter_stem(word) == stem


def test_tolerant_scan_of_two_generations(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"ids": {"post_id": "1", "topic_slug": "t"}, "content_text": "x"}')
    (tmp_path / "b.json").write_text('{"post_id": "2", "topic_slug": "t", "position": 3}')
    (tmp_path / "c.json").write_text('{"post_id": ')
    good, bad = leaves.read_posts(spark, str(tmp_path))
    assert {(r.post_id, r.topic_slug, r.position) for r in good.collect()} == {("1", "t", None), ("2", "t", 3)} and bad.count() == 1


def test_feed(spark, tmp_path):
    item = '<item><guid>{0}</guid><title>{1}</title><pubDate>Wed, 18 Jan 2023 10:00:00 +0000</pubDate>{2}</item>'
    items = [item.format(1, "One", '<itunes:season>4</itunes:season><enclosure url="http://x/a.mp3" length="9" type="audio/mpeg"/>'), item.format(2, "Season 7 - two", '<enclosure url="http://x/b.mp3" length="9" type="a"/>'), item.format(3, "No file", "")]
    (tmp_path / "feed.xml").write_text('<rss xmlns:itunes="http://i/" xmlns:podcast="http://p/"><channel>' + "".join(items) + "</channel></rss>")
    got = {r.guid: r for r in leaves.read_feed(spark, str(tmp_path / "feed.xml")).collect()}
    assert set(got) == {"1", "2"} and got["1"].enclosure_filename == "a.mp3" and got["2"].season == 7


def test_timed_text(spark):
    xml = '<tt xmlns="http://www.w3.org/ns/ttml" xmlns:ttm="http://m" xml:lang="en"><body dur="00:10"><div><p begin="0" ttm:agent="a"><span>Hello</span> <span>you</span></p><p ttm:agent="b"><span>Bye</span></p></div></body></tt>'
    assert one(spark, leaves.timed_text(F.col("x")), x=xml) == "Hello you\nBye"
    facts = one(spark, leaves.timed_text_facts(F.col("x")), x=xml)
    assert (facts.duration, facts.agents) == ("00:10", ["a", "b"])


def test_thread_page(spark):
    post = '<div class="bbp-reply {0}" id="post-{1}"><span class="bbp-author-name">{2}</span><div class="bbp-reply-content"><p>{3}</p></div>'
    html = post.format("type-topic position-0", 1, "Ann", "First <b>post</b>") + post.format("type-reply position-1 parent-1", 2, "Bob", "Reply")
    got = {r.post_id: r for r in extract.extract_posts(spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")).collect()}
    assert (got["1"].post_type, got["1"].author, got["1"].content_text) == ("topic", "Ann", "First post")
    assert (got["2"].parent_post_id, got["2"].position, got["2"].post_type) == ("1", 1, "reply")


def test_page_parts(spark):
    html = '<html><head><title>T</title><meta property="og:title" content="Og"></head><body><nav><a href="/n">n</a></nav><h1>Head</h1><p>Jo wrote:</p><blockquote>said</blockquote><p>See <a href="http://o.example/x">o</a> Viewing 15 topics - 1 through 15 (of 40 total)</p><figure><img src="i.png" alt="a"><figcaption>cap</figcaption></figure></body></html>'
    r = extract.extract_pages(spark.createDataFrame([(1, "http://h.example/d/", html), (2, None, None)], "page_id long, url string, html string")).orderBy("page_id").collect()
    assert r[0].title == "Og" and {(x.href, x.kind) for x in r[0].links} == {("http://h.example/n", "internal"), ("http://o.example/x", "external")}
    assert [(q.text, q.attributed_to) for q in r[0].quotes] == [("said", "Jo")] and r[0].images[0].caption == "cap" and r[0].has_next
    assert [b.type for b in r[0].blocks] == ["heading", "paragraph", "quote", "paragraph"] and r[1].links == []


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], "k string, v string, n int")
    new = spark.createDataFrame([("b", "z", 2), ("c", "w", 1)], "k string, v string, n int")
    first = sinks.upsert_leaves(old, new, ["k"], "n")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, sinks.upsert_leaves(first, new, ["k"], "n").collect())) == [("a", "x", 1), ("b", "z", 2), ("c", "w", 1)]


def test_ledger_and_placements(spark):
    ledger = spark.createDataFrame([("e", {"a": "1"}, ["n"]), ("f", {}, [])], "episode_id string, sources map<string,string>, notes array<string>")
    new = spark.createDataFrame([("e", "b", "2", "m")], "episode_id string, source_key string, source_value string, note string")
    got = {r.episode_id: r for r in sinks.merge_sources(ledger, new).collect()}
    assert got["e"].sources == {"a": "1", "b": "2"} and got["e"].notes == ["n", "m"] and got["f"].sources == {}
    guid = lambda *x: spark.createDataFrame([(i,) for i in x], "guid string")
    assert dict(map(tuple, sinks.placements(guid("1", "2", "3"), guid("1", "2"), guid("2")).collect())) == {"1": "placed", "2": "already_there", "3": "not_found"}


def test_progress_and_paging(spark):
    log = spark.createDataFrame([("s", 1, 0), ("s", 1, 0), ("s", 2, 0), ("t", 1, 4)], "slug string, segment_id int, total int")
    assert {r.slug: (r.reviewed, r.coverage) for r in review.progress(log).collect()} == {"s": (2, 2.0), "t": (1, 0.25)}
    page = posts.page_of(spark.range(10), [F.col("id")], page=2, limit=4).collect()
    assert [r.id for r in page] == [4, 5, 6, 7] and page[0].total == 10 and page[0].has_more


def test_personas(spark):
    row = ("a", "user", 50, 10, 0, 0.0, 0, 4.0, "x", 5, 5.5, 3)
    schema = "author string, role string, post_count int, started_topics int, total_chars long, mean_chars double, term_count long, terms_per_post double, indicators string, expert_topics int, mean_replies double, span_days long"
    rows = [row, ("b", "Keymaster", 1, 0, 0, 0.0, 0, 0.0, "", 0, 0.0, 0), ("c", "user", 5, 0, 0, 0.0, 0, 1.0, "x", 1, 1.5, 0), ("d", "Moderator", 1, 0, 0, 0.0, 0, 0.0, "", 0, 0.0, 0)]
    got = {r.author: (r.score, r.tier) for r in curation.persona_scores(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": (100.0, "S"), "b": (100.0, "S"), "c": (40.0, "C"), "d": (15.0, "D")}
