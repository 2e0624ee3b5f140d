"""Token-id output: a wavelet matrix per shard, with rank and select on bit planes, in one compressed file.

File format (little endian): magic WMX1; a length; a JSON header {n, bits, zeros, docs, sections}; then sections, each a
zstd frame: doc ids (int64, with a null flag per document), token counts per document (uint32), and for each plane its
bits (packed, most significant first) and its rank directory (ones before each 512 bits, uint32). Documents stand in
ascending id order, rows without an id first; a shard takes whole documents until it holds `shard_tokens` or more.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, new_path, write_file
from .tokens import encoder, text_blocks

MAGIC, BLOCK = b"WMX1", 512
END_ID = 1


class WaveletMatrix:
    """Bit planes from the highest bit down; each plane stably moves the zeros of the one before to the front."""

    def __init__(self, n: int, bits: int, zeros: list[int], planes: list[bytes], ranks: list[np.ndarray] | None = None):
        self.n, self.bits, self.zeros = n, bits, zeros
        self.planes = [np.frombuffer(p + bytes(-len(p) % 64 + 64), ">u8") for p in planes]
        self.packed = planes
        self.ranks = ranks if ranks is not None else [self._directory(w) for w in self.planes]

    @staticmethod
    def _directory(words: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(words).astype(np.uint32).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint32)
        return np.concatenate(([0], np.cumsum(ones[:-1], dtype=np.uint32))).astype(np.uint32)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int = 16) -> WaveletMatrix:
        row, zeros, planes = ids, [], []
        for level in range(bits - 1, -1, -1):
            ones = (row >> level) & 1 == 1
            planes.append(np.packbits(ones).tobytes())
            low = row[~ones]
            zeros.append(len(low))
            row = np.concatenate((low, row[ones]))
        return cls(len(ids), bits, zeros, planes)

    def rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones among the first `at` bits of a plane."""
        words, block, word, rest = self.planes[level], at >> 9, at >> 6, (at & 63).astype(np.uint64)
        count = self.ranks[level][block].astype(np.int64)
        for k in range(BLOCK // 64 - 1):
            inside = (block << 3) + k
            count += np.where(inside < word, np.bitwise_count(words[np.minimum(inside, word)]), 0)
        masks = np.where(rest > 0, ~np.uint64(0) << (np.uint64(64) - np.maximum(rest, np.uint64(1))), np.uint64(0))
        return count + np.bitwise_count(words[word].astype(np.uint64) & masks)

    def access(self, at: np.ndarray) -> np.ndarray:
        at, value = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for level in range(self.bits):
            before = self.rank1(level, at)
            bit = self.rank1(level, at + 1) - before
            value = value << 1 | bit
            at = np.where(bit == 1, self.zeros[level] + before, at - before)
        return value

    def _range(self, symbol: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start of the symbol's run in the last order, position there of `at`)."""
        low, at = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for level in range(self.bits):
            if symbol >> (self.bits - 1 - level) & 1:
                low, at = self.zeros[level] + self.rank1(level, low), self.zeros[level] + self.rank1(level, at)
            else:
                low, at = low - self.rank1(level, low), at - self.rank1(level, at)
        return low, at

    def rank(self, symbol: int, at) -> np.ndarray:
        """Occurrences of a symbol among the first `at` ids."""
        low, high = self._range(symbol, np.atleast_1d(at))
        return high - low

    def count(self, symbol: int) -> int:
        return int(self.rank(symbol, self.n)[0])

    def select(self, symbol: int, which) -> np.ndarray:
        """Positions of the occurrences numbered `which`, from 0."""
        at = self._range(symbol, np.zeros(1, np.int64))[0] + np.atleast_1d(np.asarray(which, np.int64))
        for level in range(self.bits - 1, -1, -1):
            bit = symbol >> (self.bits - 1 - level) & 1
            k = at - self.zeros[level] if bit else at
            lo, hi = np.zeros_like(k), np.full_like(k, self.n)
            while np.any(lo < hi):  # the first position with k + 1 such bits up to it
                mid = (lo + hi) >> 1
                ones = self.rank1(level, mid + 1)
                enough = (ones if bit else mid + 1 - ones) > k
                lo, hi = np.where(enough | (lo >= hi), lo, mid + 1), np.where(enough & (lo < hi), mid, hi)
            at = lo
        return at

    def to_array(self) -> np.ndarray:
        """All ids at once: each plane, from the lowest up, says where the sorted halves below it go."""
        row = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(np.frombuffer(self.packed[level], np.uint8), count=self.n).astype(bool)
            up = np.empty_like(row)
            up[~ones] = row[: self.zeros[level]]
            up[ones] = row[self.zeros[level] :] | row.dtype.type(1 << (self.bits - 1 - level))
            row = up
        return row


def encode_shard(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, bits: int = 16) -> bytes:
    import zstandard

    wm = WaveletMatrix.build(ids, bits)
    raw = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids), np.array(counts, "<u4").tobytes()]
    raw += [*wm.packed, *[r.astype("<u4").tobytes() for r in wm.ranks]]
    pack = zstandard.ZstdCompressor(level=1)
    sections = [pack.compress(x) for x in raw]
    head = json.dumps({"n": wm.n, "bits": bits, "zeros": wm.zeros, "docs": len(doc_ids), "sections": [len(s) for s in sections]}).encode()
    return MAGIC + len(head).to_bytes(4, "little") + head + b"".join(sections)


def decode_shard(blob: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """(doc ids, token counts, wavelet matrix) of a shard file."""
    import zstandard

    if blob[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    size = int.from_bytes(blob[4:8], "little")
    head, at, raw = json.loads(blob[8 : 8 + size]), 8 + size, []
    unpack = zstandard.ZstdDecompressor()
    for length in head["sections"]:
        raw.append(unpack.decompress(blob[at : at + length]))
        at += length
    ids = [None if null else i for i, null in zip(np.frombuffer(raw[0], "<i8").tolist(), raw[1], strict=True)]
    bits = head["bits"]
    ranks = [np.frombuffer(r, "<u4") for r in raw[3 + bits :]]
    return ids, np.frombuffer(raw[2], "<u4"), WaveletMatrix(head["n"], bits, head["zeros"], raw[3 : 3 + bits], ranks)


SHARDS = "path string, part int, shard int, n_docs long, n_tokens long"


def write_wavelet_shards(docs: DataFrame, out: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 4_000_000) -> DataFrame:
    """Encode whole texts (null: empty), append END_ID to each, and write shards in ascending id order. Returns the manifest.

    Memory is bounded by a shard, or by the longest single document. A retried task writes the same files again. Null ids come
    first; rows of one id, or of none, go by a hash of their text, so that any number of them is dealt over tasks.
    """
    def run(batches):
        enc, part, shard = encoder(tokenizer, True), TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def flush():
            nonlocal ids, texts, held, shard
            path = f"{out}/part-{part:06d}-{shard:05d}.wmx"
            tokens = np.frombuffer(b"".join(texts), "<u2")
            write_file(path, encode_shard(ids, [len(t) // 2 for t in texts], tokens))
            row = pa.RecordBatch.from_pydict({"path": [path], "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "n_docs": [len(ids)], "n_tokens": [len(tokens)]})
            ids, texts, held, shard = [], [], 0, shard + 1
            return row

        end = END_ID.to_bytes(2, "little")
        for some, block in text_blocks(batches):
            for i, t in zip(some, enc.ids(block), strict=True):
                ids.append(i)
                texts.append(t + end)
                held += len(t) // 2 + 1
                if held >= shard_tokens:
                    yield flush()
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("text")]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    return materialize(ordered.mapInArrow(run, SHARDS), "wavelet-manifest")


def read_wavelet_shards(manifest: DataFrame, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, path) of each document, from the files; start counts all ids before it."""
    def run(batches):
        for b in batches:
            for path, blob in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                ids, counts, wm = decode_shard(blob)
                tokens = wm.to_array()
                ends = np.cumsum(counts, dtype=np.int64)
                crcs = [zlib.crc32(tokens[e - c : e].astype("<u4").tobytes()) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                columns = [pa.array(ids, pa.int64()), pa.array(ends - counts), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64()), pa.array([path.rpartition("/")[2]] * len(ids))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "local", "n_tokens", "ids_crc32", "file"])

    spark = manifest.sparkSession
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, path string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wmx").load(out).select("path", "content")
    docs = files.mapInArrow(run, "doc_id long, local long, n_tokens long, ids_crc32 long, file string")
    # One row per shard, so the running total is a small window.
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = manifest.select(F.element_at(F.split("path", "/"), -1).alias("file"), before.alias("before"), "path")
    return docs.join(starts, "file").select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "path")


def token_output(docs: DataFrame, tokenizer: str, out: str | None = None, **options) -> DataFrame:
    out = out or new_path(docs.sparkSession, "wavelet")
    return read_wavelet_shards(write_wavelet_shards(docs, out, tokenizer, **options), out)
