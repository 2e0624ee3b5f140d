"""Byte-level BPE by recursive SQL: each task runs DuckDB over the distinct pieces of its own rows.

The merge table holds (a, b, rank) for each way to cut a vocabulary entry into two entries. A piece becomes token-position rows;
a recursive query joins neighbours with the merge table and contracts, in each piece, the leftmost pair of least rank until no
pair is in the table. Pieces of over LONG bytes contract all non-overlapping pairs of the least rank in one step, wherever no pair
that could arise beside them has a lower rank (else the leftmost only), and keep one row per position, so that memory stays linear.
Decoding joins ids with the vocabulary and aggregates their bytes in order of position.
"""

from __future__ import annotations

import base64
from itertools import chain as flat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Pieces that a worker remembers; bytes of one recursive query; length from which pieces take the keyed recursion.
KEEP, BATCH_BYTES, LONG = 200_000, 400_000, 48
#: Tokens of one decoding query; a longer document is decoded in parts.
DECODE_TOKENS = 1_000_000

CONTRACT = """
WITH RECURSIVE chain(step, word, pos, tok) AS (
    SELECT 0, word, pos, tok FROM pieces
    UNION ALL (
    WITH pairs AS (
        SELECT word, pos, tok, lead(tok) OVER piece AS after, lead(pos) OVER piece AS after_pos
        FROM chain WINDOW piece AS (PARTITION BY word ORDER BY pos)),
    least AS (
        SELECT word, min(rank::BIGINT << 32 | pos) AS low, arg_min(after_pos, rank::BIGINT << 32 | pos) AS gone
        FROM pairs JOIN merges ON merges.a = tok AND merges.b = after GROUP BY word)
    SELECT step + 1, chain.word, pos, CASE WHEN pos = low & 4294967295 THEN (low >> 32)::INTEGER ELSE tok END
    FROM chain JOIN least ON least.word = chain.word WHERE pos <> gone))
SELECT word, tok FROM chain JOIN (SELECT word, max(step) AS step FROM chain GROUP BY word) USING (word, step) ORDER BY word, pos
"""

CONTRACT_LONG = """
WITH RECURSIVE chain(word, pos, tok) USING KEY (word, pos) AS (
    SELECT word, pos, tok FROM pieces
    UNION (
    WITH live AS (SELECT word, pos, tok FROM recurring.chain WHERE tok >= 0 AND word IN (SELECT word FROM chain)),
    pairs AS (
        SELECT word, pos, tok, lead(tok) OVER piece AS after, lead(pos) OVER piece AS after_pos,
               lag(tok) OVER piece AS before, lead(tok, 2) OVER piece AS third, row_number() OVER piece AS nth
        FROM live WINDOW piece AS (PARTITION BY word ORDER BY pos)),
    ranked AS (SELECT pairs.*, rank, min(rank) OVER (PARTITION BY word) AS low FROM pairs JOIN merges ON merges.a = tok AND merges.b = after),
    least AS (
        SELECT *, nth - row_number() OVER (PARTITION BY word ORDER BY nth) AS island, min(nth) OVER (PARTITION BY word) AS first
        FROM ranked WHERE rank = low),
    dealt AS (SELECT *, (row_number() OVER (PARTITION BY word, island ORDER BY nth)) % 2 = 1 AS free FROM least),
    beside AS (
        SELECT word, low, before AS a, low AS b FROM dealt UNION SELECT word, low, low, third FROM dealt UNION SELECT word, low, low, low FROM dealt),
    lower AS (SELECT DISTINCT word FROM beside JOIN merges USING (a, b) WHERE rank < low),
    chosen AS (SELECT word, pos, after_pos, low FROM dealt WHERE free AND (nth = first OR word NOT IN (SELECT word FROM lower)))
    SELECT word, pos, low FROM chosen UNION ALL SELECT word, after_pos, -1 FROM chosen))
SELECT word, tok FROM chain WHERE tok >= 0 ORDER BY word, pos
"""

DECODE = "SELECT doc, unhex(string_agg(spelled, '' ORDER BY pos)) AS text FROM ids JOIN vocabulary USING (id) GROUP BY doc ORDER BY doc"


class SqlBpe:
    """Encoder and decoder of one vocabulary file of ranks (base64 token, rank). One single-threaded in-memory DuckDB."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        cuts = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        columns = zip(*cuts, strict=True) if cuts else ((), (), ())
        self._query("CREATE TABLE merges AS FROM given", given=pa.table([pa.array(c, pa.int32()) for c in columns], ["a", "b", "rank"]))
        spelled = pa.table({"id": pa.array(ranks.values(), pa.int32()), "spelled": pa.array([t.hex() for t in ranks], pa.string())})
        self._query("CREATE TABLE vocabulary AS FROM given", given=spelled)

    def _query(self, sql: str, **tables: pa.Table):
        for name, rows in tables.items():
            self.con.register(name, rows)
        found = self.con.execute(sql)
        out = found.fetchnumpy() if sql.lstrip().startswith(("WITH", "SELECT")) else None
        for name in tables:
            self.con.unregister(name)
        return out

    def _contract(self, words: list[bytes], sql: str) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        pos = (np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
        found = self._query(sql, pieces=pa.table({"word": word, "pos": pos, "tok": self.byte_ids[data]}))
        tokens, cuts = np.asarray(found["tok"], "<u4"), np.searchsorted(found["word"], np.arange(len(words) + 1)).tolist()
        return [tokens[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of new pieces, as little-endian unsigned 32-bit bytes."""
        out: dict[str, bytes] = {}
        for sql, kind in ((CONTRACT, [p for p in pieces if len(p) * 4 <= LONG or len(p.encode()) <= LONG]), (CONTRACT_LONG, [p for p in pieces if len(p) * 4 > LONG and len(p.encode()) > LONG])):
            at = 0
            while at < len(kind):
                end, n, words = at, 0, []
                while end < len(kind) and (end == at or n < BATCH_BYTES):
                    words.append(kind[end].encode())
                    n += len(words[-1])
                    end += 1
                out |= zip(kind[at:end], self._contract(words, sql), strict=True)
                at = end
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit bytes."""
        cut = [self.pieces(t) for t in texts]
        known = self.known
        new = self._learn([p for p in dict.fromkeys(flat.from_iterable(cut)) if p not in known])
        found = known | new if len(new) < len(known) // 8 else {**known, **new}
        for piece in new:
            if len(known) >= KEEP:
                break
            known[piece] = new[piece]
        return [b"".join(map(found.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that the ids of each document spell."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        tokens = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        doc, parts = np.repeat(np.arange(len(ids), dtype=np.int32), sizes), [[] for _ in ids]
        for at in range(0, len(tokens), DECODE_TOKENS):
            some = slice(at, at + DECODE_TOKENS)
            rows = pa.table({"doc": doc[some], "pos": np.arange(len(tokens[some]), dtype=np.int32), "id": tokens[some]})
            found = self._query(DECODE, ids=rows)
            for d, text in zip(found["doc"].tolist(), found["text"].tolist(), strict=True):
                parts[d].append(bytes(text))
        return [b"".join(p) for p in parts]


_KEPT: dict[tuple[str, str], SqlBpe] = {}


def _codec(path: str, pattern: str) -> SqlBpe:
    """One for each worker process: later tasks find the tables and known pieces."""
    if (path, pattern) not in _KEPT:
        _KEPT[path, pattern] = SqlBpe(path, pattern)
    return _KEPT[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of each row, ids as little-endian unsigned 32-bit bytes; no special tokens.

    A null text is empty and has no ids. Rows stand on their own: repeated rows, repeated and null ids come out one by one, other
    columns don't matter. No shuffle; a task holds one slice of up to 4 MB of text (or one longer text) and its distinct pieces.
    """

    def run(batches):
        codec = _codec(path, pattern)
        for b in slices(batches, 20_000, "text", 4_000_000):
            ids = codec.encode([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """encoded (with column ids) plus `decoded`, the bytes its ids spell. Null ids decode to null, no ids to no bytes."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    def run(batches):
        codec = _codec(path, pattern)
        for b in slices(batches, 20_000, "ids", 4_000_000):
            ids = b.column("ids").to_pylist()
            found = codec.decode([x or b"" for x in ids])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([None if x is None else t for x, t in zip(ids, found, strict=True)], pa.binary())], [*b.schema.names, "decoded"])

    rest = encoded.drop("decoded")
    return rest.mapInArrow(run, StructType([*rest.schema.fields, StructField("decoded", BinaryType())]))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): documents encoded, then decoded from their ids."""
    found = decode_documents(encode_documents(docs, path, pattern), path, pattern)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
