"""Periodic runs of words by recompression.

A run is a stretch of words with smallest period q, of at least `least` words and `times` periods, that no neighbour extends.
Each task takes its documents in slices. Words become numbers; every period q has a grid of step q (8 for shorter periods), so that a run
holds two neighbouring grid points: q times fewer points than words, a harmonic sum over all periods. Points where a few words agree with
those q further on are candidates. For documents with candidates a run-length grammar is built by recompression: in turn, blocks of one
symbol and pairs of a left and a right symbol (by a hash of the symbol) become one symbol, until little is left. How far two positions
agree, forwards and backwards, comes from the grammar: climb while both start a phrase, skip equal phrases, descend where they differ,
which takes a few steps a level. No suffix arrays; the ends of a run are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import mix
from .common import slices

SHORT = 8
#: Candidates that are extended at once.
AT_ONCE = 500_000
SPACE = r"[\x20\x09-\x0D]+"


@dataclass
class Level:
    """Symbols of one level; first and parent lead to the level below (first has one more entry, its length) and from there up."""

    symbols: np.ndarray
    first: np.ndarray | None = None
    parent: np.ndarray | None = None
    blocks: bool = False


class Grammar:
    """The levels of a recompressed sequence, in which the first and the last symbol occur once."""

    def __init__(self, sequence: np.ndarray, stop: int):
        symbols = np.unique(sequence, return_inverse=True)[1]
        self.levels = [Level(symbols)]
        for turn in range(200):
            if len(symbols) <= stop:
                break
            symbols = self._add(symbols, np.concatenate(([True], symbols[1:] != symbols[:-1])), True)
            right = (mix(symbols.astype(np.uint64) + np.uint64(turn << 40)) >> np.uint64(17)) & np.uint64(1) == 1
            symbols = self._add(symbols, np.concatenate(([True], right[:-1] | ~right[1:])), False)

    def _add(self, symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> np.ndarray:
        first = np.flatnonzero(starts)
        if len(first) == len(symbols):
            return symbols
        bounds = np.append(first, len(symbols))
        size = np.diff(bounds)
        second = size if blocks else np.where(size == 2, symbols[np.minimum(first + 1, len(symbols) - 1)] + 1, 0)
        higher = np.unique(symbols[first] * (len(symbols) + 2) + second, return_inverse=True)[1]
        self.levels.append(Level(higher, bounds, np.cumsum(starts) - 1, blocks))
        return higher

    def _advance(self, h: int, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many equal symbols of level h to pass: one, or what both still have of their blocks."""
        if h + 1 == len(self.levels) or not self.levels[h + 1].blocks:
            return np.ones(len(a), np.int64)
        up = self.levels[h + 1]
        if step > 0:
            return np.minimum(up.first[up.parent[a] + 1] - a, up.first[up.parent[b] + 1] - b)
        return np.minimum(a - up.first[up.parent[a]], b - up.first[up.parent[b]]) + 1

    def _aligned(self, h: int, a: np.ndarray, step: int) -> np.ndarray:
        up = self.levels[h + 1]
        return up.first[up.parent[a]] == a if step > 0 else up.first[up.parent[a] + 1] - 1 == a

    def agree(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """How many words from i and j on (step 1) or back (step -1), themselves included, are equal; i differs from j."""
        a, b = i.astype(np.int64), j.astype(np.int64)
        stopped = np.zeros(len(a), np.int64)  # the level from which to descend
        live, top = np.arange(len(a)), len(self.levels) - 1
        for h in range(top + 1):
            rising, at = [], live
            while len(at):
                if h < top:
                    up = self._aligned(h, a[at], step) & self._aligned(h, b[at], step)
                    rising.append(at[up])
                    at = at[~up]
                same = self.levels[h].symbols[a[at]] == self.levels[h].symbols[b[at]]
                stopped[at[~same]] = h
                at = at[same]
                far = step * self._advance(h, a[at], b[at], step)
                a[at] += far
                b[at] += far
            if h == top or not (live := np.concatenate(rising)).size:
                break
            up = self.levels[h + 1]
            a[live], b[live] = up.parent[a[live]], up.parent[b[live]]
        for h in range(top, -1, -1):
            at = np.flatnonzero(stopped >= h)
            while len(at):
                at = at[self.levels[h].symbols[a[at]] == self.levels[h].symbols[b[at]]]
                far = step * self._advance(h, a[at], b[at], step)
                a[at] += far
                b[at] += far
            if h:
                at, first = np.flatnonzero(stopped >= h), self.levels[h].first
                a[at], b[at] = (first[a[at]], first[b[at]]) if step > 0 else (first[a[at] + 1] - 1, first[b[at] + 1] - 1)
        return np.abs(a - i)


def grid_candidates(x: np.ndarray, doc: np.ndarray, sizes: np.ndarray, ends: np.ndarray, least: int, times: int):
    """(positions, periods) of grid points that may lie in a run, in arrays of bounded size. Documents stand from long to short in
    x; doc has the document of each position; the words of a run agree with those a period on over max(2 periods, least - period)."""
    found, n, q = [], 0, 0
    while q < sizes[0] // times:
        q += 1
        end = int(ends[np.searchsorted(-sizes, -max(least, times * q), side="right") - 1])
        grid = q if q >= SHORT else SHORT
        if end <= grid + q:
            continue
        a, b = x[: end - q : grid], x[q:end:grid]
        same = a == b
        at = np.flatnonzero(same[:-1] & same[1:]) * grid
        half = at + grid // 2
        at = at[(x[half] == x[half + q]) & (doc[at] == doc[at + q])]
        if len(at):
            found.append((at, np.full(len(at), q)))
            n += len(at)
        if n >= AT_ONCE:
            yield [np.concatenate(c) for c in zip(*found, strict=True)]
            found, n = [], 0
    if found:
        yield [np.concatenate(c) for c in zip(*found, strict=True)]


def find_runs(docs: list[list[bytes]], least: int = 24, times: int = 3) -> list[np.ndarray]:
    """For each document its runs as rows (start, length, period), by start, then period. `times` is 3 or more, `least` 24 or more."""
    if times < 3 or least < 3 * SHORT:
        raise ValueError("runs are found from 3 periods and 24 words on")
    none = np.zeros((0, 3), np.int64)
    out = [none] * len(docs)
    sizes = np.array([len(d) for d in docs], np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= least]
    if not len(order):
        return out
    words = pa.array([w for d in order for w in docs[d]], pa.binary()).dictionary_encode().indices.to_numpy()
    x, doc, bounds = _laid_out(words, sizes[order])
    grammar = None
    kept = []
    chunks = list(grid_candidates(x, doc, sizes[order], bounds[1:], least, times))
    if chunks:
        named = np.unique(np.concatenate([doc[at] for at, _ in chunks]))
        # The grammar covers documents with candidates only; they keep their order.
        small, small_doc, small_bounds = _laid_out(np.concatenate([x[bounds[d] + 1 : bounds[d + 1]] for d in named]), sizes[order[named]])
        grammar = Grammar(small, 2 * len(named) + 2)
        shift = np.zeros(len(order), np.int64)
        shift[named] = small_bounds[:-1] - bounds[named]
    for at, q in chunks:
        at = at + shift[doc[at]]
        back, on = grammar.agree(at - 1, at + q - 1, -1), grammar.agree(at, at + q, 1)
        length = back + on + q
        long = length >= np.maximum(least, times * q)
        kept.append(np.unique(np.stack([(at - back)[long], length[long], q[long]], 1), axis=0))
    if not kept:
        return out
    runs = np.unique(np.concatenate(kept), axis=0)  # by start, length, period
    runs = runs[np.concatenate(([True], (runs[1:, :2] != runs[:-1, :2]).any(1)))] if len(runs) else runs  # the smallest period of equal bounds
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = small_doc[runs[:, 0]] if len(runs) else none[:, 0]
    runs[:, 0] -= small_bounds[owner] + 1
    for k in np.unique(owner):
        out[order[named[k]]] = runs[owner == k] if len(named) < 50 else runs[np.searchsorted(owner, k) : np.searchsorted(owner, k, side="right")]
    return out


def _laid_out(words: np.ndarray, sizes: np.ndarray):
    """(sequence, document of each position, bounds): a separator of its own (a negative number) stands before each document and at the
    end, at the positions in bounds."""
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
    x = np.empty(bounds[-1] + 1, np.int64)
    doc = np.repeat(np.arange(len(sizes) + 1), np.append(sizes + 1, 1))
    inside = np.ones(len(x), bool)
    inside[bounds] = False
    x[inside] = words
    x[bounds] = -1 - np.arange(len(bounds))
    return x, doc, bounds


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, times: int = 3) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row: runs as an array of (start, length, period), and the text without repeats.

    Words are stretches without ASCII white space. A null or empty text has no words, no runs and an empty collapsed text. Rows stand on
    their own, so repeated rows, repeated and null ids come out one by one, and other columns don't matter. No shuffle; a task holds one
    slice of up to 4 MB of text, or one longer document.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for b in slices(batches, 20_000, "text", 4_000_000):
            words = [(t or b"").split() for t in b.column("text").to_pylist()]
            found = find_runs(words, least, times)
            flat = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(r) for r in found]))), pa.int32())
            rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(run_type))
            short = [collapsed(w, r).decode() for w, r in zip(words, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), pa.ListArray.from_arrays(offsets, rows), pa.array(short, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def plant_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): a tenth of the documents, by the crc32 of the id (a null id: of the empty text), becomes periodic from some word on."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), SPACE), lambda w: w != "")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words").cast("long"), F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    rows = rows.select("doc_id", "text", "words", n.alias("n"), F.when(n > 0, a).alias("a"), F.when(n > 0, (1 + F.floor((n - a) / (3 + g % 8))).cast("int")).alias("p"))

    def times(n: Column, p: Column) -> Column:
        return F.ceil(n / p).cast("int")

    rest = F.col("n").cast("int") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times(rest, F.col("p")))), F.lit(1), rest)
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def run_report(found: DataFrame) -> DataFrame:
    """The digest columns: number of runs, the run with the greatest length / period, digests of all runs and of the collapsed text."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")

    def better(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.aggregate("runs", none, better).alias("best"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
