"""Benchmark decontamination: an FM-index per training shard, searched backwards for test phrases.

Words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A window is 10 consecutive words of a
test item, or the whole item if it is shorter. A shard (a few thousand rows as they are read) becomes one sequence of symbols: a
number for each word that occurs in the test items, a separator for any stretch of other words, at the ends of texts, and
for stretches of test words too short for a window, which no window can touch. Over that sequence the shard gets a suffix
array, its Burrows-Wheeler transform as a wavelet matrix, and suffix positions sampled at starts of stretches and every
8th symbol. All windows are searched at once by ranks; occurrences are located by walking to a sampled position, checked
word by word against the text, and merged into removal spans.

Test items are prepared by tasks in blocks of bounded size, written to the shared folder; a worker keeps as many blocks as
fit its bound and reads the others again for each shard. Items without an id are searched for and cut like others, they have
no name to report; repeated items are one. Shards are bounded by rows and by bytes of text.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import Hasher, blocks, word_bounds, word_bytes
from .common import new_path, read_file, slices, write_file
from .wavelet import WaveletMatrix

WINDOW, SAMPLE, SHARD_ROWS = 10, 8, 4000
TABLE = word_bytes()


def words_of(text: bytes) -> list[bytes]:
    data = np.frombuffer(text.lower(), np.uint8)
    low = data.tobytes()
    return [low[s:e] for s, e in zip(*(x.tolist() for x in word_bounds(data, TABLE)), strict=True)]


class Phrases:
    """The windows of some test items: symbols by word, padded symbol rows, and the items of each window."""

    def __init__(self, items: list[tuple[int | None, bytes]], window: int = WINDOW):
        texts = [words_of(t) for _, t in items]
        self.words = sorted({x for w in texts for x in w})
        at = {w: i + 1 for i, w in enumerate(self.words)}
        rows, owners = [np.zeros((0, window), np.int32)], []
        for (item, _), words in zip(items, texts, strict=True):
            if words:
                own = np.zeros(max(window, len(words)), np.int32)
                own[: len(words)] = [at[w] for w in words]
                rows.append(np.lib.stride_tricks.sliding_window_view(own, window))
                owners += [item] * len(rows[-1])
        #: Windows as rows of word numbers from 1, padded at the right.
        self.rows, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        named = np.array([o is not None for o in owners], bool)
        pairs = np.unique(np.stack([which.reshape(-1)[named], np.array([o for o in owners if o is not None], np.int64)]), axis=1)
        self.items, self.item_bounds = pairs[1], np.searchsorted(pairs[0], np.arange(len(self.rows) + 1))
        self.lengths = (self.rows > 0).sum(1)
        flat = np.frombuffer(b"\n".join(self.words) + b"\n", np.uint8)
        ends = np.cumsum([len(w) + 1 for w in self.words], dtype=np.int64) - 1
        starts = np.concatenate(([0], ends[:-1] + 1)) if self.words else ends
        hashes = Hasher(flat).hash(starts, ends) if self.words else np.zeros(0, np.uint64)
        self.hashes = np.unique(hashes)
        self.symbols = np.concatenate(([0], np.searchsorted(self.hashes, hashes) + 1))[self.rows]
        self.present = np.zeros(1 << 20, bool)
        self.present[self.hashes >> np.uint64(44)] = True

    def window(self, w: int) -> list[bytes]:
        return [self.words[i - 1] for i in self.rows[w, : self.lengths[w]]]

    def owners(self, w: int) -> list[int]:
        return self.items[self.item_bounds[w] : self.item_bounds[w + 1]].tolist()

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The symbol of each word hash; 0 for words that no item has."""
        out = np.zeros(len(hashes), np.int64)
        may = np.flatnonzero(self.present[hashes >> np.uint64(44)])
        at = np.searchsorted(self.hashes, hashes[may])
        at[at == len(self.hashes)] = 0
        same = self.hashes[at] == hashes[may]
        out[may[same]] = at[same] + 1
        return out


class FMIndex:
    """Over symbols 1..; 0 separates. Separators sort first, each below the next, so equal stretches end at once."""

    def __init__(self, seq: np.ndarray, bits: int):
        n = len(seq)
        rank = np.where(seq == 0, np.cumsum(seq == 0) - 1, seq + (seq == 0).sum())
        _, rank = np.unique(rank, return_inverse=True)
        step = 1
        while rank.max(initial=0) + 1 < n:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1
            _, rank = np.unique(rank * (n + 1) + after, return_inverse=True)
            step *= 2
        order = np.empty(n, np.int64)
        order[rank] = np.arange(n)
        self.bwt = WaveletMatrix.build(seq[order - 1].astype(np.uint32), bits)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=1 << bits))))
        starts = (seq != 0) & (np.concatenate(([0], seq[:-1])) == 0)
        sampled = (starts | (np.arange(n) % SAMPLE == 0))[order]
        self.position = np.where(sampled, order, -1)

    def _rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        low, at = np.zeros(len(at), np.int64), at.astype(np.int64)
        for level in range(self.bwt.bits):
            bit = symbols >> (self.bwt.bits - 1 - level) & 1 == 1
            a, b = self.bwt.rank1(level, low), self.bwt.rank1(level, at)
            low, at = np.where(bit, self.bwt.zeros[level] + a, low - a), np.where(bit, self.bwt.zeros[level] + b, at - b)
        return at - low

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) rows of the suffixes that start with each pattern (rows of symbols, padded at the right)."""
        first, end = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.bwt.n, np.int64)
        live = np.arange(len(patterns))
        for back in range(1, patterns.shape[1] + 1):
            live = live[(lengths[live] >= back) & (first[live] < end[live])]
            if not len(live):
                break
            symbols = patterns[live, lengths[live] - back]
            first[live] = self.before[symbols] + self._rank(symbols, first[live])
            end[live] = self.before[symbols] + self._rank(symbols, end[live])
        return first, np.maximum(first, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        live = np.arange(len(rows))
        while len(live):
            known = self.position[rows[live]] >= 0
            done = live[known]
            out[done] = self.position[rows[done]] + steps[done]
            live = live[~known]
            symbols = self.bwt.access(rows[live])
            rows[live] = self.before[symbols] + self._rank(symbols, rows[live])
            steps[live] += 1
        return out


def find_phrases(texts: list[bytes], phrases: Phrases) -> tuple[np.ndarray, list[set], list[np.ndarray]]:
    """For each text: its number of words, the items found, and the byte bounds (rows of start, end) of its hit words."""
    n_words, items, bounds = np.zeros(len(texts), np.int64), [set() for _ in texts], [np.zeros((0, 2), np.int64) for _ in texts]
    least = int(phrases.lengths.min()) if len(phrases.lengths) else 1 << 30
    seqs, docs, begins, finishes, spelled = [], [], [], [], []
    for i, _, data, starts in blocks(texts):
        s, e = word_bounds(data, TABLE)
        doc = np.searchsorted(starts, s, side="right") - 1
        n_words += np.bincount(doc + i, minlength=len(texts))
        symbols = phrases.number(Hasher(data).hash(s, e))
        usable = symbols > 0
        new = np.ones(len(s), bool)
        new[1:] = (doc[1:] != doc[:-1]) | ~usable[:-1]
        stretch = np.cumsum(new | ~usable)
        size = np.bincount(stretch, weights=usable, minlength=1)
        keep = np.flatnonzero(usable & (size[stretch] >= least))
        if not len(keep):
            continue
        # One separator before each stretch that stays.
        first = np.concatenate(([True], stretch[keep][1:] != stretch[keep][:-1]))
        where = np.arange(len(keep)) + np.cumsum(first)
        seq = np.zeros(where[-1] + 1, np.int64)
        seq[where] = symbols[keep]
        at = np.full(len(seq), -1, np.int64)
        at[where] = keep
        held = at >= 0
        low = data.tobytes()
        seqs.append(seq)
        docs.append(np.where(held, doc[at] + i, -1))
        begins.append(np.where(held, s[at] - starts[doc[at]], 0))
        finishes.append(np.where(held, e[at] - starts[doc[at]], 0))
        spelled += [low[a:b] if h else b"" for a, b, h in zip(s[at].tolist(), e[at].tolist(), held.tolist(), strict=True)]
    if not seqs:
        return n_words, items, bounds
    seq, doc, begin, finish = (np.concatenate([*x, [0]]) for x in (seqs, docs, begins, finishes))
    index = FMIndex(seq, max(1, int(len(phrases.hashes)).bit_length()))
    first, end = index.search(phrases.symbols, phrases.lengths)
    counts = end - first
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + first[which]
    hit = np.zeros(len(seq) + 1, np.int64)
    for at, w in zip(index.locate(rows).tolist(), which.tolist(), strict=True):
        size = int(phrases.lengths[w])
        if spelled[at : at + size] == phrases.window(w):
            hit[at] += 1
            hit[at + size] -= 1
            items[doc[at]].update(phrases.owners(w))
    hits = np.flatnonzero(np.cumsum(hit[:-1]) > 0)
    for d in np.unique(doc[hits]).tolist():
        own = hits[doc[hits] == d] if len(hits) < 1000 else hits[slice(*np.searchsorted(doc[hits], [d, d + 1]))]
        bounds[d] = np.stack([begin[own], finish[own]], 1)
    return n_words, items, bounds


def removal_spans(bounds: np.ndarray, text: bytes) -> list[tuple[int, int]]:
    """Byte spans to remove: hit words, joined where no other word stands between them."""
    spans: list[tuple[int, int]] = []
    for s, e in bounds.tolist():
        if spans and not TABLE[np.frombuffer(text[spans[-1][1] : s].lower(), np.uint8)].any():
            spans[-1] = (spans[-1][0], e)
        else:
            spans.append((s, e))
    return spans


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for s, e in spans:
        parts.append(text[at:s])
        at = e
    return b"".join([*parts, text[at:]])


def prepare_phrases(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_bytes: int = 4_000_000) -> list[str]:
    """Files of Phrases in the shared folder, one for each block of items, built by a task each; only paths reach the driver."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    out = new_path(benchmark.sparkSession, "phrases")

    def build(batches):
        rows = [r for b in batches for r in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True)]
        if rows:
            path = f"{out}/{TaskContext.get().partitionId():06d}"
            write_file(path, pickle.dumps(Phrases(rows)))
            yield pa.RecordBatch.from_pydict({"path": [path]})

    paths = [r.path for r in items.repartition(total // block_bytes + 1).mapInArrow(build, "path string").collect()]
    if not paths:
        paths = [f"{out}/none"]
        write_file(paths[0], pickle.dumps(Phrases([])))
    return sorted(paths)


_LOADED: dict[str, tuple[int, Phrases]] = {}
#: Bytes of phrase files that a worker keeps.
KEEP_BYTES = 64_000_000


def _phrases(path: str) -> Phrases:
    if path not in _LOADED:
        if _LOADED and next(iter(_LOADED)).rpartition("/")[0] != path.rpartition("/")[0]:
            _LOADED.clear()  # another job's
        raw = read_file(path)
        if sum(n for n, _ in _LOADED.values()) + len(raw) > KEEP_BYTES:
            return pickle.loads(raw)
        _LOADED[path] = len(raw), pickle.loads(raw)
    return _LOADED[path][1]


def search_shard(texts: list[bytes], files: list[str]) -> list[tuple[int, int, list[int], list[tuple[int, int]]]]:
    """(words, hit words, items, removal spans) of each text, over all blocks of test items."""
    merged = None
    for path in files:
        n_words, items, bounds = find_phrases(texts, _phrases(path))
        if merged is None:
            merged = items, bounds
        else:
            for d in range(len(texts)):
                merged[0][d].update(items[d])
                if len(bounds[d]):
                    merged[1][d] = np.unique(np.concatenate((merged[1][d], bounds[d])), axis=0)
    return [(int(n_words[d]), len(merged[1][d]), sorted(merged[0][d]), removal_spans(merged[1][d], texts[d])) for d in range(len(texts))]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans) of each row; spans are byte bounds in the UTF-8 text. A null text has no words.

    No shuffle: shards are rows as they are read. Repeated rows and ids are reported one by one.
    """
    files = prepare_phrases(benchmark)

    def run(batches):
        for b in slices(batches, SHARD_ROWS):
            found = search_shard([t or b"" for t in b.column("text").to_pylist()], files)
            spans = [[{"start": s, "end": e} for s, e in x[3]] for x in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.list_(pa.int64())),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "n_words", "n_hit", "items", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_hit long, items array<long>, spans array<struct<start:long,end:long>>")


def contamination_report(found: DataFrame) -> DataFrame:
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def remove_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the same columns; removal spans are cut from contaminated texts until no window occurs in what is left.

    A document of which no word is left goes; one without contamination keeps its text as it is, null and empty too.
    """
    files, schema = prepare_phrases(benchmark), docs.schema

    def run(batches):
        for b in slices(batches, SHARD_ROWS, text_col):
            at = b.schema.get_field_index(text_col)
            texts = [None if t is None else t.encode() for t in b.column(at).to_pylist()]
            keep = np.ones(len(texts), bool)
            todo = list(range(len(texts)))
            while todo:
                found = search_shard([texts[i] or b"" for i in todo], files)
                for i, x in zip(todo, found, strict=True):
                    if x[1]:
                        texts[i] = cut_spans(texts[i], x[3])
                        keep[i] = x[0] > x[1]
                todo = [i for i, x in zip(todo, found, strict=True) if x[1] and keep[i]]
            texts = [None if t is None else t.decode() for t in texts]
            kind = b.schema.field(at).type
            yield b.set_column(at, b.schema.field(at), pa.array(texts, kind)).filter(pa.array(keep))

    return docs.mapInArrow(run, schema)
