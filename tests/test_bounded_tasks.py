"""Python tasks work on slices of their batches, and statistics of an index don't shuffle its keys."""

import pandas as pd
import pyarrow as pa

from threadloom.operators import search_index
from threadloom.sources.extract import portions


def test_portions_of_pages_are_whole_and_bounded():
    pdf = pd.DataFrame({"page_id": range(9), "html": ["x" * 10, None, "y" * 100, "", "z" * 40, "a" * 10, "b" * 10, "c" * 10, None]})
    parts = list(portions(pdf, rows=3, most=50))
    assert [i for p in parts for i in p["page_id"]] == list(range(9))
    assert all(len(p) <= 3 and (len(p) == 1 or p["html"].str.len().sum() <= 50) for p in parts) and len(parts) > 3
    assert list(portions(pdf.iloc[:0])) == []


def test_grouping_of_terms_takes_slices(monkeypatch):
    monkeypatch.setattr(search_index, "GROUP_TOKENS", 4)
    words = [["a", "b", "a"], [], ["c"] * 9, ["a"], ["b", "a"]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([len(w) for w in words]), pa.array(["t"] * 5), pa.array(words, pa.list_(pa.string()))], ["key", "length", "field", "words"])
    parts = list(search_index.group_terms([batch]))
    got = {(r["key"], r["term"]): r["positions"] for p in parts for r in p.to_pylist()}
    assert len(parts) == 3
    assert got == {(k, t): [i for i, w in enumerate(ws) if w == t] for k, ws in enumerate(words) for t in ws}


def test_statistics_count_documents_by_their_first_tokens(spark, tmp_path):
    rows = [(1, "alpha beta alpha", "x"), (2, "", "x y"), (3, None, None), (4, "beta", None)]
    docs = spark.createDataFrame(rows, "id long, text string, source string")
    index = search_index.SearchIndex.build(docs, "id", {"body": "text", "source": "source"}, f"file://{tmp_path}/index")
    index = index.update(docs.filter("id = 4").selectExpr("id", "'gamma alpha' as text", "source"), docs.filter("id = 1").select("id"))
    stats = index.statistics()
    assert {tuple(r) for r in stats.collect()} == {("body", 2, 2, 1), ("source", 2, 2, 1)}
    assert "Expand" not in stats._jdf.queryExecution().executedPlan().toString()
