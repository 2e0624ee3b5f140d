"""Hierarchies of pages, the run ledger and full exports on hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from threadloom.operators import reports
from threadloom.sources import ledger, menus, sinks

PAGE = "page_id long, url string, html string"
MENU = """<ul class="menu"><li class="menu-item menu-item-has-children"><a href="#">1917</a><ul class="sub-menu">
<li class="menu-item"><a href="/articles/trench-run/">The <b>Trench</b></a></li><li class="menu-item"><a href="https://x.org/b?p=1">B &amp; C</a><li class="menu-item"><a href="#">none</a></li></ul></li>
<li class="menu-item menu-item-has-children"><a href="https://site.org/direct">Direct</a><ul class="sub-menu"><li class="menu-item"><a href="/no">No</a></li></ul></li>
<li class="menu-item menu-item-has-children"><span><a href="#">Hidden</a></span><ul class="sub-menu"><li class="menu-item"><a href="/no">No</a></li></ul></li>
<li class="menu-item menu-item-has-children"><a href="#">Empty</a></li></ul><ol><li>plain</ol><li>stray"""


def test_menu_of_films(spark):
    pages = spark.createDataFrame([(1, "https://site.org/menu", MENU), (2, None, None), (3, "u", "<p>no list</li></ul>")], PAGE)
    found = menus.film_menu(pages, "site.org").orderBy("pos").collect()
    assert [tuple(r)[1:6] for r in found] == [
        ("1917", "1917", "TheTrench", "https://site.org/articles/trench-run/", "trench-run"), ("1917", "1917", "B & C", "https://x.org/b?p=1", "b")]
    items = menus.list_items(pages).collect()
    assert {r.page_id for r in items} == {1} and [(r.title, r.depth) for r in items if r.title is None] == [(None, 0), (None, 0)]
    assert [r.parent for r in items[:4]] == [None, 0, 0, 0]


def test_deep_lists_keep_their_parents(spark):
    deep = "<ul><li><a href='0'>0</a>" * 200 + "</li></ul>" * 200
    items = menus.list_items(spark.createDataFrame([(1, "", deep)], PAGE)).collect()
    assert [(r.pos, r.depth, r.parent) for r in items] == [(i, i, i - 1 if i else None) for i in range(200)]


def test_forum_pages(spark):
    html = """<a href="/forums/forum/out/">Out</a><div id="bbpress-forums"><a href="/forums/forum/own/">Own</a><a href="/forums/forum/sub">Sub</a><ul><li><a href="/forums/topic/t1/">T <i>one</i></a> Started by: <a href="/u">ann</a> 3 days</li>
    <li><a href="/forums/topic/t2/">T2</a></li><li><a href="/forums/topic/t2/"></a></li></ul></div><a href="/forums/topic/out/">x</a>"""
    pages = spark.createDataFrame([(1, "https://e.org/forums/forum/own/", html), (2, "https://e.org/", '<a href="/forums/topic/t9">nine</a>'), (3, None, None)], PAGE)
    found = [tuple(r)[2:] for r in menus.forum_page_refs(pages).orderBy("page_id", "pos").collect()]
    assert found == [
        ("forum", "https://e.org/forums/forum/sub", "sub", "Sub", None), ("topic", "https://e.org/forums/topic/t1/", "t1", "T one", "ann 3 days"), ("topic", "https://e.org/forums/topic/t2/", "t2", "T2", None),
        ("topic", "https://e.org/forums/topic/t9", "t9", "nine", None)]


def test_ledger_of_good_empty_and_failed_runs(spark, tmp_path):
    runs, counts = str(tmp_path / "runs"), {"rows": F.count(F.lit(1)), "sum": F.sum("id")}
    ledger.logged(spark.range(10), "a", lambda df: df.write.parquet(str(tmp_path / "a")), runs, counts)
    last = ledger.logged(spark.range(4).repartition(3), "a", lambda df: df.write.parquet(str(tmp_path / "b")), runs, counts)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        ledger.logged(spark.range(3), "a", lambda df: df.write.parquet(str(tmp_path / "b")), runs, counts)
    ledger.logged(spark.range(3).filter("id > 5"), "none", lambda df: df.write.parquet(str(tmp_path / "c")), runs, counts)
    rows = ledger.read_ledger(spark, runs)
    assert sorted((r.job, r.success, r.error is None) for r in rows.collect()) == [("a", False, False), ("a", True, True), ("a", True, True), ("none", True, True)]
    best = {r.job: r for r in ledger.canonical(rows).collect()}
    assert best["a"].run_id == last and best["a"].counts == {"rows": 4, "sum": 6} and best["none"].counts.get("rows", 0) == 0


def test_history_of_both_layouts(spark, tmp_path):
    def report(path, **row):
        (tmp_path / path).mkdir(parents=True)
        (tmp_path / path / "extraction_report.json").write_text(json.dumps(row) if row else "{broken")

    report("ep 1/transcript/runs/r1", success=True, speakers_detected=2)
    report("ep 1/transcript/runs/r2", success=False)
    report("ep 2/transcript/runs/r1", success=False)
    report("ep 3/transcript/runs/r1")
    for n in (1, 2, 4):
        report(f"ep {n}/transcript/old" if n == 9 else f"legacy{n}/ep {n}/transcript", success=n != 4)
    found = {(r.episode_id, r.run_id) for r in ledger.read_run_history(spark, str(tmp_path)).collect()}
    assert found == {("ep 1", "r1"), ("ep 2", "legacy")}


def test_the_latest_batch(spark, tmp_path):
    for name, failed in (("batch_20240101", "old"), ("batch_20240202", "new"), ("other", "x")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"failures": [{"episode_dir": failed}], "gaps": [{"episode_dir": "g1", "has_audio": True}, {"episode_dir": "g2", "has_audio": False}, {"episode_dir": "g3"}]}))
    assert sorted(map(tuple, ledger.latest_batch(spark, str(tmp_path)).collect())) == [("failure", "new"), ("gap", "g1")]


def test_full_records_and_csv_rows(spark, tmp_path):
    posts = spark.createDataFrame(
        [("1", None, "Master of Light", None, "t", None, "May 1", "hi", None, ["l"], [], "u1"), ("2", "ann", "Master of Light", "f", "t", "2024-01-01", "x", None, ["q"], None, ["m"], None)],
        "post_id string, author string, role string, forum_slug string, topic_slug string, parsed_iso string, raw_time string, content_text string, quotes array<string>, links array<string>, media array<string>, source_url string")
    rule = "=" * 80
    assert reports.post_records(posts).filter("post_id = '1'").first().record == f"{rule}\nPOST ID: 1\nAUTHOR: Unknown\nROLE: Master of Light\nFORUM: N/A\nTOPIC: t\nTIMESTAMP: May 1\n{rule}\nhi"
    records = reports.role_records(posts, "Light")
    assert [r.record for r in records.orderBy("post_id").collect()] == [f"POST ID: 1\nTOPIC: t\nFORUM: N/A\nTIMESTAMP: May 1\nURL: u1\n{rule}\nhi", f"POST ID: 2\nTOPIC: t\nFORUM: f\nTIMESTAMP: 2024-01-01\nURL: N/A\n{rule}\n"]
    sinks.write_records(records, str(tmp_path / "r"), ["post_id"], head="POSTS")
    text = "".join(p.read_text() for p in sorted((tmp_path / "r").glob("*.txt")))
    assert text.startswith(f"POSTS\n{rule}\n\nPOST ID: 1\n") and text.endswith(f"URL: N/A\n{rule}\n\n\n")
    rows = {r.post_id: r for r in sinks.csv_rows(posts).collect()}
    assert (rows["1"].author, rows["1"].timestamp_iso, rows["1"].num_quotes, rows["1"].num_links, rows["1"].num_media) == ("", "", 0, 1, 0)
    assert (rows["2"].content_text, rows["2"].num_quotes, rows["2"].num_links, rows["2"].num_media) == ("", 1, 0, 1)
