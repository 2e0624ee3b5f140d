"""Packing by minimum bin slack: a bitset subset-sum picks the remaining lengths that fill each window closest.

A document's ids (with the end id) are cut at multiples of the window. Full pieces are sequences of their own. The
remainders of a task wait in a buffer; when it is full, or at the end of the task's rows, windows are filled one by one:
the longest remainder left, then the multiset of remaining lengths whose sum comes closest to the room left. The sums
reachable are the bits of one integer; each step (a length, a power-of-two share of its count) shifts it, and walking the
steps backwards gives the counts. Nothing is shuffled; each task leaves at most its buffer's last windows part-filled.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import encoder, text_blocks

END_ID = 1


def fullest_multiset(counts: dict[int, int], room: int) -> dict[int, int]:
    """{length: how many} with the largest sum up to room, from a multiset of lengths."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, share = min(counts[length], room // length), 1
        while left:
            take = min(share, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, share = left - take, share * 2
        if reach >> room:
            break
    best, used = reach.bit_length() - 1, defaultdict(int)
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            used[length] += take
            best -= length * take
    return dict(used)


def fill_windows(lengths: list[int], window: int) -> list[list[int]]:
    """Windows as lists of indices into lengths, each 1 to window."""
    waiting = defaultdict(list)
    for i in range(len(lengths) - 1, -1, -1):
        waiting[lengths[i]].append(i)
    counts, order, out = {k: len(v) for k, v in waiting.items()}, sorted(waiting), []
    while order:
        longest = order[-1]
        picked = [waiting[longest].pop()]
        counts[longest] -= 1
        if not counts[longest]:
            del counts[longest]
            order.pop()
        for length, n in fullest_multiset(counts, window - longest).items():
            picked += [waiting[length].pop() for _ in range(n)]
            counts[length] -= n
            if not counts[length]:
                del counts[length]
                order.remove(length)
        out.append(picked)
    return out


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, buffer: int = 20_000) -> DataFrame:
    """Pieces (doc_id, start, length, ids as little-endian uint32, doc_tokens, sequence_id, offset). A null text is empty.

    Each id lies in one piece. sequence_id is the task's number times 2^40 plus a running number. Memory is bounded by
    `buffer` remainders of under `window` ids, and by one document. An empty table gives no piece.
    """
    def run(batches):
        enc, at = encoder(tokenizer, False), TaskContext.get().partitionId() << 40
        rest: list[tuple] = []
        out: list[tuple] = []

        def emit(force: bool):
            if out and (force or len(out) >= 2000):
                c = [list(x) for x in zip(*out, strict=True)]
                out.clear()
                ids = [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in c[3]]
                kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
                columns = [pa.array(x, k) for x, k in zip([*c[:3], ids, *c[4:]], kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        def settle():
            nonlocal at
            for picked in fill_windows([r[2] for r in rest], window):
                offset = 0
                for i in picked:
                    out.append((*rest[i], at, offset))
                    offset += rest[i][2]
                at += 1
                yield from emit(False)
            rest.clear()

        end = END_ID.to_bytes(2, "little")
        for some, block in text_blocks(batches):
            for doc, ids in zip(some, enc.ids(block), strict=True):
                ids += end
                n = len(ids) // 2
                for k in range(0, n - n % window, window):
                    out.append((doc, k, window, ids[2 * k : 2 * (k + window)], n, at, 0))
                    at += 1
                if n % window:
                    rest.append((doc, n - n % window, n % window, ids[2 * (n - n % window) :], n))
                yield from emit(False)
            if len(rest) >= buffer:
                yield from settle()
        yield from settle()
        yield from emit(True)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PIECES)


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
