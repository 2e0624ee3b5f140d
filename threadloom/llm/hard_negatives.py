"""Hard negatives by threshold joins over an inverted index, in the manner of L2AP.

Vectors become integers; a score is an inner product. Anchors are the stated query set: they are written as files in the shared folder, and
each task searches its own rows for all anchors, block by block, so no row is shuffled and nothing is broadcast. A block of rows is an
inverted index: its dimensions, strongest first, in small groups, each with a posting list of the rows by falling norm of what is left of
them from that group on. For a threshold t a list is read only as far as that norm times the anchor's can reach t: what lies
behind is not indexed for t. Partial scores add up group by group; pairs go once score and remaining norms cannot reach t; the rest is
verified on whole vectors. Thresholds start high and are lowered until each window (the best k within score bounds) is full. A first pass
over a hashed eighth of the rows gives each window a floor, its k-th best there, so that the pass over all rows emits a bounded number of
matches per window at any number of tasks. Results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filesystem, materialize, new_path

GROUP, ROWS, QUERIES, CHUNK = 8, 4096, 128, 32_768
#: Shares of what a window can reach, from which its threshold is lowered in turn; after the last it falls to the window's floor.
STEPS = (0.8, 0.6, 0.4, 0.2)
#: The k-th best of one row in so many is a window's floor.
SAMPLE = 8
LEAST, MOST = -(1 << 62), 1 << 62
WINDOWS = "array<struct<name:long,low:long,high:long,floor:long,floor_id:long>>"


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part: label and vector not null, all components finite. vector holds
    floor(scale * x) as integers; row tells repeated ids apart. Written once to the shared folder."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ready = df.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
        F.transform(vector_col, lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("vector"),
    )
    return materialize(ready, "vectors")


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), max(1, sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _wide(m: np.ndarray, d: int) -> np.ndarray:
    return m if m.shape[1] == d else np.pad(m, ((0, 0), (0, d - m.shape[1])))


class Index:
    """Inverted index of a block of rows."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.labels, self.vectors = rows, ids, labels, vectors
        self.safe = float(np.abs(vectors).max(initial=0)) ** 2 * vectors.shape[1] < 2**53
        if not self.safe:
            return
        y = vectors.astype(np.float64)
        self.order = np.argsort(-(y * y).sum(0), kind="stable")
        self.y = y = np.ascontiguousarray(y[:, self.order])
        self.groups = range(0, y.shape[1], GROUP)
        squares = np.add.reduceat(y * y, list(self.groups), axis=1)
        self.left = np.sqrt(np.concatenate((squares[:, ::-1].cumsum(1)[:, ::-1], np.zeros((len(y), 1))), axis=1)).T  # norms from each group on
        self.lists = [np.argsort(-n, kind="stable") for n in self.left[:-1]]
        self.norms = [-n[r] for n, r in zip(self.left[:-1], self.lists, strict=True)]
        self.values = [np.ascontiguousarray(y[r, g : g + GROUP].T) for g, r in zip(self.groups, self.lists, strict=True)]

    def above(self, queries: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, position, score) of all pairs with a score of at least the query's t."""
        d = max(queries.shape[1], self.vectors.shape[1])
        if not self.safe or float(np.abs(queries).max(initial=0)) ** 2 * d >= 2**53:
            scores = _wide(queries, d).astype(object) @ _wide(self.vectors, d).astype(object).T
            q, r = np.nonzero((scores >= t.astype(object)[:, None]).astype(bool))
            return q, r, scores[q, r].astype(np.int64)
        a = _wide(queries, d)[:, : self.y.shape[1]].astype(np.float64)[:, self.order]
        squares = np.add.reduceat(a * a, list(self.groups), axis=1)
        left = np.sqrt(np.concatenate((squares[:, ::-1].cumsum(1)[:, ::-1], np.zeros((len(a), 1))), axis=1)).T
        want = t - (1e-6 + 1e-9 * np.abs(t))  # bounds are rounded, scores are not
        reach = float(np.min(np.where(want > 0, want / np.maximum(left[0], 1e-9), 0), initial=np.inf))
        part, read = np.zeros((len(a), len(self.y))), np.zeros(len(self.y), np.int64)
        q = r = None
        for k, g in enumerate(self.groups):
            n = int(np.searchsorted(self.norms[k], -reach, side="right"))
            if not n:
                break
            take = self.lists[k][:n]
            part[:, take] += a[:, g : g + GROUP] @ self.values[k][:, :n]
            read[take] = min(g + GROUP, self.y.shape[1])
            if k + 1 < len(self.groups):
                may = part + left[k + 1][:, None] * self.left[k + 1] >= want[:, None]
                out = self.lists[k][n:]  # left out from here or before: all of their remaining norm is open
                may[:, out] = part[:, out] + left[0][:, None] * self.left[-(-read[out] // GROUP), out] >= want[:, None]
                if np.count_nonzero(may) * 8 < may.size:
                    q, r = np.nonzero(may)
                    break
        if q is None:
            # Rows that lists left out have at most their remaining norm to add.
            rest = self.left[-(-read // GROUP), np.arange(len(read))]
            q, r = np.nonzero(part + left[0][:, None] * rest >= want[:, None])
        score = part[q, r]
        for g in self.groups:
            more = np.flatnonzero(read[r] <= g)
            for i in range(0, len(more), 100_000):
                m = more[i : i + 100_000]
                score[m] += np.einsum("ij,ij->i", a[q[m], g : g + GROUP], self.y[r[m], g : g + GROUP])
            if len(more):
                k = g // GROUP + 1
                alive = score + left[k][q] * self.left[k][r] >= want[q]
                q, r, score = q[alive], r[alive], score[alive]
        score = np.rint(score).astype(np.int64)
        good = score >= t[q]
        return q[good], r[good], score[good]


class Windows:
    """The best k matches of each window of a block of queries, so far."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        lists = batch.column("windows")
        flat = lists.flatten()
        self.k, self.query = k, np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        self.name, self.low, self.high, self.floor, self.floor_id = (np.array(flat.field(n).fill_null(0)) for n in ("name", "low", "high", "floor", "floor_id"))
        self.best = np.zeros((0, 4), np.int64)  # window, score, id, row
        self.full = np.zeros(len(self.query), bool)

    def least(self) -> np.ndarray:
        """The lowest score that each window still takes."""
        return np.maximum(self.low, self.floor)

    def put(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(query, kind="stable")
        query, score, ids, rows = query[order], score[order], ids[order], rows[order]
        first, end = np.searchsorted(query, self.query), np.searchsorted(query, self.query, side="right")
        w = np.repeat(np.arange(len(self.query)), end - first)
        at = np.arange(len(w)) - np.repeat(np.cumsum(end - first) - (end - first), end - first) + first[w]
        good = (score[at] >= self.low[w]) & (score[at] <= self.high[w]) & ((score[at] > self.floor[w]) | (score[at] == self.floor[w]) & (ids[at] <= self.floor_id[w]))
        w, at = w[good], at[good]
        rows4 = np.concatenate((self.best, np.stack((w, score[at], ids[at], rows[at]), 1)))
        rows4 = rows4[np.lexsort((rows4[:, 3], rows4[:, 2], -rows4[:, 1], rows4[:, 0]))]
        nth = np.arange(len(rows4)) - np.searchsorted(rows4[:, 0], rows4[:, 0])
        self.best = rows4[nth < self.k]
        last = rows4[nth == self.k - 1]
        self.full[last[:, 0]] = True
        self.floor[last[:, 0]], self.floor_id[last[:, 0]] = last[:, 1], last[:, 2]


def _fill(index: Index, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray, windows: Windows, same: bool) -> None:
    """Search one block of rows for one block of queries, with thresholds falling until the windows are full."""
    if same:
        live = np.flatnonzero((labels >= index.labels.min()) & (labels <= index.labels.max()))
    else:
        live = np.flatnonzero(labels != index.labels.min()) if index.labels.min() == index.labels.max() else np.arange(len(labels))
    live = live[np.isin(live, windows.query)]
    norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
    most = float(np.sqrt((index.vectors.astype(np.float64) ** 2).sum(1)).max())
    before = np.full(len(labels), MOST)
    top = np.full(len(labels), LEAST)
    np.maximum.at(top, windows.query, windows.high)
    top = np.minimum(top.astype(np.float64), norm * most)
    for share in (*STEPS, None):
        if not len(live):
            return
        floor = np.full(len(labels), MOST)
        np.minimum.at(floor, windows.query, windows.least())
        filled = np.ones(len(labels), bool)
        np.logical_and.at(filled, windows.query, windows.full)
        t = floor if share is None else np.where(filled, floor, np.maximum(floor, np.ceil(top * share).astype(np.int64)))
        q, r, score = index.above(vectors[live], t[live])
        q = live[q]
        good = (score < before[q]) & ((labels[q] == index.labels[r]) == same) & (rows[q] != index.rows[r])
        windows.put(q[good], score[good], index.ids[r[good]], index.rows[r[good]])
        before[live] = t[live]
        floor = np.full(len(labels), MOST)
        np.minimum.at(floor, windows.query, windows.least())
        live = live[t[live] > floor[live]]


def _query_batches(folder: str) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSelector

    system, path = filesystem(folder)
    for found in sorted(f.path for f in system.get_file_info(FileSelector(path)) if f.path.endswith(".parquet")):
        with system.open_input_file(found) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=QUERIES):
                if batch.num_rows:
                    yield batch


def search(rows: DataFrame, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """(query, window, row, vec_id, score): of each task's rows the best k matches of each window of queries(row, label, vector, windows),
    with the same label or with another, never the query's own row."""
    folder = new_path(rows.sparkSession, "queries")
    queries.select("row", "label", "vector", F.col("windows").cast(WINDOWS)).write.option("maxRecordsPerFile", 16_384).parquet(folder)

    def found(parts: list[pa.RecordBatch]):
        t = pa.Table.from_batches(parts).combine_chunks()
        labels = t["label"].to_numpy()
        order = np.argsort(labels, kind="stable")
        t, labels = t.take(order), labels[order]
        ids, own = t["vec_id"].fill_null((1 << 63) - 1).to_numpy(), t["row"].to_numpy()
        vectors = _matrix(t["vector"].combine_chunks())
        blocks = [Index(own[i : i + ROWS], ids[i : i + ROWS], labels[i : i + ROWS], vectors[i : i + ROWS]) for i in range(0, len(t), ROWS)]
        for batch in _query_batches(folder):
            windows = Windows(batch, k)
            asked, names, asked_vectors = batch.column("row").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("vector"))
            for index in blocks:
                _fill(index, asked, names, asked_vectors, windows, same)
            w, score, vec_id, row = windows.best.T
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked[windows.query[w]]), pa.array(windows.name[w]), pa.array(row), pa.array(vec_id, mask=vec_id == (1 << 63) - 1), pa.array(score)], ["query", "window", "row", "vec_id", "score"])

    def run(batches):
        parts, n = [], 0
        for b in batches:
            parts.append(b)
            n += b.num_rows
            if n >= CHUNK:
                yield from found(parts)
                parts, n = [], 0
        if n:
            yield from found(parts)

    return rows.select("row", "vec_id", "label", "vector").mapInArrow(run, "query long, window long, row long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _filled(rows: DataFrame, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """The best k matches of each window, over all rows: floors from a sample first, then one pass over everything."""
    rows = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, "row") if rows.rdd.getNumPartitions() < rows.sparkSession.sparkContext.defaultParallelism else rows
    some = rows.filter(F.pmod(F.xxhash64("row"), F.lit(SAMPLE)) == 0)
    floors = _best(search(some, queries, k, same), k).filter(F.col("rank") == k)
    last = F.coalesce("vec_id", F.lit((1 << 63) - 1))
    floors = floors.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", F.struct("score", last.alias("id"))))).alias("floors"))
    asked = queries.join(floors.withColumnRenamed("query", "row"), "row", "left")
    at = lambda w: F.col("floors")[w["name"]]
    windows = F.transform("windows", lambda w: F.struct(w["name"].alias("name"), w["low"].alias("low"), w["high"].alias("high"), F.coalesce(at(w)["score"], w["floor"]).alias("floor"), F.coalesce(at(w)["id"], w["floor_id"]).alias("floor_id")))
    return materialize(_best(search(rows, asked.withColumn("windows", windows), k, same), k), "best")


def mine_hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from whole_vectors(...).

    Anchors are rows whose id is divisible by `every`; an anchor's positives are its best other rows of the same label, its negatives for
    each the best rows of other labels with low % to high % of the positive's score. Higher scores come first, then smaller ids, rows
    without an id last; those can be matches, never anchors. Repeated rows and ids are rows of their own. Vectors of different lengths are
    compared as if padded with zeros. A negative positive_score leaves no window. Empty tables give an empty result.
    """
    open_window = F.array(F.struct(F.lit(0).alias("name"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high"), F.lit(LEAST).alias("floor"), F.lit(MOST).alias("floor_id")))
    anchors = materialize(vectors.filter(F.col("vec_id") % every == 0).withColumn("windows", open_window), "anchors")
    good = _filled(vectors, anchors, positives, True)
    bounds = F.struct(F.col("row").alias("name"), F.expr(f"({low} * cast(score as decimal(20, 0)) + 99) div 100").alias("low"), F.expr(f"({high} * cast(score as decimal(20, 0))) div 100").alias("high"), F.lit(LEAST).alias("floor"), F.lit(MOST).alias("floor_id"))
    asked = good.filter("score >= 0").groupBy("query").agg(F.collect_list(bounds).alias("windows")).withColumnRenamed("query", "row")
    asked = materialize(anchors.drop("windows").join(asked, "row"), "anchors-windows")
    bad = _filled(vectors, asked, negatives, False)
    pairs = good.select(F.col("query").alias("row"), F.col("row").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = pairs.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row").withColumnRenamed("row", "query")
    found = pairs.join(bad.select("query", "window", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), ["query", "window"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
