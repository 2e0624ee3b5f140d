"""Streams with state: debounced refreshes with deletes, stops between batches and restarts, bad lines, upserts of touched partitions."""

import random
import shutil
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from threadloom.streaming import jobs, refresh

T0 = datetime(2024, 1, 1)
CHANGES = "key string, ts timestamp, seq long, gone boolean, value string"


def changes_of(rng, n=400):
    """Changes of 12 keys over some minutes, somewhat out of order, a fifth of them deletes."""
    rows = []
    for i in range(n):
        at = T0 + timedelta(milliseconds=i * 900 + rng.randrange(0, 4000))
        gone = rng.random() < 0.2
        rows.append((f"S{rng.randrange(12)}", at, i, gone, None if gone else f"v{i}"))
    return rows


def store(spark, rows, folder, name):
    """One file of a streaming source."""
    spark.createDataFrame(rows, CHANGES).coalesce(1).write.parquet(f"{folder}/_{name}")
    Path(f"{folder}/in").mkdir(exist_ok=True)
    shutil.copy(next(Path(f"{folder}/_{name}").glob("part-*.parquet")), f"{folder}/in/{name}.parquet")


def drain(spark, folder):
    stream = jobs.read_stream(spark, CHANGES, f"{folder}/in", files_per_trigger=1)
    with refresh.keyed_state(spark):
        return jobs.run_to_table(refresh.refreshes(stream, "2 seconds", "10 seconds"), spark, f"{folder}/out", "append", f"{folder}/checkpoint")


def sequence(rows):
    """The bursts by key, without deletes of what is not there."""
    out = {}
    for r in sorted(rows, key=lambda r: r.at):
        have = out.setdefault(r.key, [])
        if r.op == "put" or have and have[-1][0] == "put":
            have.append((r.op, r.value, r.changes, r.at))
    return {k: v for k, v in out.items() if v}


def test_refreshes_stopped_between_batches_equal_the_batch_form(spark, tmp_path):
    rows = changes_of(random.Random(1))
    parts = [rows[:90], rows[90:180], rows[180:300], rows[300:]]
    for i in (0, 1):
        store(spark, parts[i], tmp_path, f"f{i}")
    first = drain(spark, tmp_path).count()
    for i in (2, 3):  # after a stop: a new query from the same checkpoint
        store(spark, parts[i], tmp_path, f"f{i}")
    got = drain(spark, tmp_path).collect()
    assert 0 < first < len(got)
    newest = max(r[1] for r in rows)
    until = int((newest - timedelta(seconds=10) - datetime(1970, 1, 1)).total_seconds() * 1000)
    want = refresh.bursts(spark.createDataFrame(rows, CHANGES), "2 seconds", until).collect()
    assert sequence(got) == sequence(want) and any(r.op == "delete" for r in got)
    now = {r.key: (r.value, r.changes) for r in refresh.items(spark.createDataFrame(got)).collect()}
    assert now == {k: v[-1][1:3] for k, v in sequence(want).items() if v[-1][0] == "put"}
    assert drain(spark, tmp_path).count() == len(got)  # nothing new, nothing twice


def test_upserts_touch_only_the_partitions_of_changed_keys(spark, tmp_path):
    schema = "k string, content_hash string, v long"

    def put(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/_{name}")
        Path(f"{tmp_path}/in").mkdir(exist_ok=True)
        shutil.copy(next(Path(f"{tmp_path}/_{name}").glob("part-*.parquet")), f"{tmp_path}/in/{name}.parquet")
        updates = jobs.read_stream(spark, schema, f"{tmp_path}/in")
        jobs.upsert_stream(updates, f"{tmp_path}/table", f"{tmp_path}/checkpoint", "k", "v").awaitTermination()
        return {p: p.stat().st_mtime_ns for p in Path(f"{tmp_path}/table").rglob("*.parquet")}

    Path(f"{tmp_path}/in").mkdir()
    updates = jobs.read_stream(spark, schema, f"{tmp_path}/in")
    jobs.upsert_stream(updates, f"{tmp_path}/table", f"{tmp_path}/checkpoint", "k", "v").awaitTermination()
    assert jobs.read_upserted(spark, f"{tmp_path}/table", updates.schema).count() == 0  # an empty source
    before = put([(f"k{i}", f"h{i}", i) for i in range(60)], "a")
    same = put([(f"k{i}", f"h{i}", i + 100) for i in range(60)], "b")
    assert same == before  # known hashes
    after = put([("k3", "new", 500), ("k3", "newer", 501), ("k4", "old", -1)], "c")
    assert 0 < len(set(before) - set(after)) <= 2 < len(set(before) & set(after))
    rows = {r.k: r.content_hash for r in jobs.read_upserted(spark, f"{tmp_path}/table", updates.schema).collect()}
    assert rows == {f"k{i}": f"h{i}" for i in range(60)} | {"k3": "newer"}


def test_bad_lines_are_passed_over(spark, tmp_path):
    Path(f"{tmp_path}/in").mkdir()
    Path(f"{tmp_path}/in/a.json").write_text('{"id": 1, "text": "one"}\nnot json\n\n{"id": 2, "text": "two"}\n{"id": 3, "te')
    stream = jobs.read_stream(spark, "id long, text string", f"{tmp_path}/in", "json")
    got = jobs.run_to_table(stream, spark, f"{tmp_path}/out", "append", f"{tmp_path}/checkpoint")
    assert {(r.id, r.text) for r in got.collect()} == {(1, "one"), (2, "two")}


def test_the_last_run_becomes_canonical(spark, tmp_path):
    schema = "episode_id string, run_id string, created_at long"
    for name, rows in (("a", [("e1", "r1", 1), ("e2", "r2", 2)]), ("b", [("e1", "r3", 3), ("e2", "r0", 0)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/_{name}")
        Path(f"{tmp_path}/in").mkdir(exist_ok=True)
        shutil.copy(next(Path(f"{tmp_path}/_{name}").glob("part-*.parquet")), f"{tmp_path}/in/{name}.parquet")
        stream = jobs.read_stream(spark, schema, f"{tmp_path}/in")
        jobs.canonical_runs(stream, f"{tmp_path}/table", f"{tmp_path}/checkpoint").awaitTermination()
    assert {(r.episode_id, r.run_id) for r in jobs.read_upserted(spark, f"{tmp_path}/table", stream.schema).collect()} == {("e1", "r3"), ("e2", "r2")}


def test_refresh_of_files_in_no_order_of_time_equals_its_sql(spark, tmp_path):
    """Parts of a table overlap in time, and times have microseconds, which the SQL rounds to milliseconds."""
    import duckdb

    from threadloom.plans import streams

    rng, rows = random.Random(4), []
    for i in range(600):
        at = T0 + timedelta(seconds=rng.randrange(0, 3 * 86400), microseconds=rng.randrange(0, 1_000_000))
        rows.append((i, at, rng.randrange(0, 6), rng.choice(["error", "click", "view"]), 0.0, "{}"))
    rows.append((600, T0 + timedelta(days=3, seconds=1), 7, "click", 0.0, "{}"))  # and the newest stands in the first part
    parts = [rows[400:], rows[:200], rows[200:400]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, streams.EVENTS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
        assert len(list(Path(f"{tmp_path}/events.parquet").glob("*.parquet"))) == i + 1
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    con.execute("SET TimeZone = 'UTC'")
    want = con.execute(streams.ORACLE_SQL["stream_refresh"]).fetchall()
    assert want and sorted(tuple(r) for r in streams.stream_refresh(spark, str(tmp_path)).collect()) == sorted(want)
