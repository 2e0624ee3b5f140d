"""Whole-text encoding with the tokenizers library, which merges each new piece once.

Both tokenizers cut a text into pieces by a pattern before merging, and merge each piece on its own; no piece goes on
after a space that follows a word. A task therefore remembers the ids of space-separated words and of pieces, and has the
library merge new pieces only. Texts with characters beyond Latin (U+0250 on), where normalisation could join across
pieces, byte-level texts with double spaces and texts that hold an added token (such as an end mark, which the library
gives its own id) are encoded by the library whole.
"""

from __future__ import annotations

import os
from array import array
from operator import attrgetter

import numpy as np

from .bytewords import Hasher
from .common import slices

# The pre-tokenizer patterns of the two public tokenizer files, and the texts between pieces.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
KEEP = 100_000

# Byte-level vocabularies spell printable bytes as themselves and the others as U+0100 onwards, in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + n) for n, b in enumerate(_OTHERS)}


class PieceEncoder:
    """ids(texts): for each text its token ids as little-endian unsigned 16-bit bytes; both vocabularies fit in 16 bits."""

    def __init__(self, path: str, words: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        assert self.tokenizer.get_vocab_size() <= 1 << 16
        self.words = words
        self.merge = self.tokenizer.model.tokenize
        self.id_of = attrgetter("id")
        self.known: dict[str, bytes] = {}
        self.seen: dict[bytes, bytes] = {}
        self.pieces = regex.compile(WORD_PATTERN if words else BYTE_PATTERN).findall
        self.beyond = regex.compile(r"[^\x00-ɏ]").search

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u2").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def spelled(self, piece: str) -> str:
        """A piece in the characters that stand for its bytes; for ASCII only a space differs."""
        if piece.isascii() and piece.isprintable():
            return piece.replace(" ", "Ġ")
        return piece.encode().decode("latin-1").translate(BYTE_CHARS)

    def _merge(self, piece: str) -> bytes:
        """The ids of a piece, from the library's merging model; it takes a byte as one character of BYTE_CHARS."""
        return array("H", map(self.id_of, self.merge(self.spelled(piece)))).tobytes()

    def _piece(self, piece: str) -> bytes:
        known = self.known.get(piece)
        if known is None:
            known = self._merge(piece)
            if len(self.known) < KEEP:
                self.known[piece] = known
        return known

    def _segment(self, segment: bytes) -> bytes:
        """The ids of a word with the space before it. One of letters only is one piece, others are cut by the pattern."""
        text = segment.decode()
        word = text[1:] if text[0] == " " else text
        if word.isalpha():
            piece = word if self.words else text
            return self.known.get(piece) or self._merge(piece)
        return b"".join(map(self._piece, self.pieces(text)))

    def _block(self, texts: list[bytes]) -> list[bytes]:
        """Each text is cut before its spaces; equal segments of the block are found by hash, and looked up once."""
        raw = b"".join(texts)
        if not raw:
            return [b""] * len(texts)
        data = np.frombuffer(raw, np.uint8)
        bounds = np.cumsum([0, *map(len, texts)])
        first = data == 32
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        hashes = Hasher(data).hash(starts, ends)
        long = np.flatnonzero(ends - starts > 64)  # looked up one by one
        hashes[long] = np.arange(len(long), dtype=np.uint64)
        _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        segments = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
        seen = self.seen
        ids = list(map(seen.get, segments))
        new = [k for k, found in enumerate(ids) if found is None]
        for k in new:
            ids[k] = self._segment(segments[k])
        for k in new[: max(0, KEEP - len(seen))]:
            seen[segments[k]] = ids[k]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
        firsts = (np.cumsum(sizes) - sizes)[which]
        counts = sizes[which]
        total = np.concatenate(([0], np.cumsum(counts)))
        take = np.repeat((firsts - total[:-1]).astype(np.int32), counts)
        take += np.arange(total[-1], dtype=np.int32)
        flat = np.frombuffer(b"".join(ids), "<u2")[take]
        cuts = total[np.searchsorted(starts, bounds)]
        return [flat[i:j].tobytes() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def ids(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if self.beyond(t) or not self.words and "  " in t or any(x in t for x in self.added)]
        out = dict(zip(whole, self._whole([texts[i] for i in whole]), strict=True))
        usual = [i for i in range(len(texts)) if i not in out]
        plain = [(texts[i].lower().replace("\n", " ") if self.words else texts[i]).encode() for i in usual]
        k = 0
        while k < len(plain):
            j, n = k, 0
            while j < len(plain) and (j == k or n < 1_000_000):
                n += len(plain[j])
                j += 1
            out |= zip(usual[k:j], self._block(plain[k:j]), strict=True)
            k = j
        return [out[i] for i in range(len(texts))]


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, words: bool) -> PieceEncoder:
    """One encoder for each worker process, so that what it remembers serves the worker's later tasks."""
    if (path, words) not in _ENCODERS:
        _ENCODERS[path, words] = PieceEncoder(path, words)
    return _ENCODERS[path, words]


def text_blocks(batches, id_name: str = "doc_id", chars: int = 4_000_000):
    """(ids, texts) from Arrow batches, in blocks of bounded text; a null text is empty."""
    for b in slices(batches):
        ids, texts = b.column(id_name).to_pylist(), [t or "" for t in b.column("text").to_pylist()]
        i = 0
        while i < len(texts):
            j, n = i, 0
            while j < len(texts) and (j == i or n + len(texts[j]) <= chars):
                n += len(texts[j])
                j += 1
            yield ids[i:j], texts[i:j]
            i = j
