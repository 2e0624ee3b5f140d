r"""Chat formatting by incremental black-box rendering.

A template is a function from a list of (role, text) messages to one string. The formatter renders successive prefixes of
a conversation and compares consecutive outputs: where the shorter output is a prefix of the longer one, the rest is the
span of the new turn; where it is not, the template rewrites history and the conversation is flagged. The place of the
text inside a span is found by rendering the same prefix with a probe character for the text. Only assistant texts are
under the loss mask.

Prefixes are whole, so that templates may number turns, demand an order of roles or rewrite any earlier turn; their time
grows with the square of the turns. A template whose text for a turn depends on no more than the last k turns and never
changes may say so by an attribute `look_back` = k (or the caller by `history`); its prefixes hold k turns, and a
conversation of any length takes bounded memory and time per turn. The word is not taken for it: each block of turns (`block_turns`),
the first from the conversation's start, is rendered once more as a whole and must equal its joined spans. Else a conversation of one
block takes whole prefixes; a longer one does so if its first block fails, and has its pieces flagged if a later one does.
Long conversations are written in pieces of `piece` turns. A conversation whose template rewrote history, or shows a text not
exactly once, is flagged and written as the template's last output, in one piece; its turns' texts are located in that output by a
probe character that it doesn't hold, and a turn that it no longer shows, or shows twice, has an empty text.

Rows without a conversation id are one conversation.

The default template marks a turn as `### Role: text </turn>` and escapes backslashes and its own control strings inside
roles and texts (`\` as `\\`, `</turn>` as `<\/turn>`, `##` as `#\#`), which `unescape` reverses exactly.
"""

from __future__ import annotations

import hashlib
import re
from itertools import accumulate, groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Characters of a block of a streamed conversation, which is rendered once more as a whole.
BLOCK_CHARS = 4_000_000


def escape(text: str) -> str:
    return re.sub("#(?=#)", r"#\\", text.replace("\\", "\\\\").replace("</turn>", "<\\/turn>"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turn_template(messages: list[tuple[str, str]]) -> str:
    return "".join(f"### {escape(role.capitalize() if role.capitalize().lower() == role else '=' + role)}: {escape(text)} </turn>\n" for role, text in messages)


turn_template.look_back = 1


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def free_probe(texts) -> str:
    """A character that occurs in none of the texts: the last free one of the private planes."""
    used = set().union(*map(set, texts)) if texts else set()
    return next(c for c in map(chr, range(0x10FFFD, 0xEFFFF, -1)) if c not in used)


def _text_bounds(shown: str, probed: str, probe: str, at: int = 0) -> tuple[int, int, bool]:
    """(start, end, found) of a turn's text in an output, from the same output with the probe for that text. Not found: the text
    isn't shown exactly once, or the template shows other things with another text; the bounds are then the end twice."""
    start = probed.find(probe, at)
    end = len(shown) - (len(probed) - start - 1)
    if start < at or end < start or probed.count(probe) != 1 or probe in shown or shown[:start] != probed[:start] or shown[end:] != probed[start + 1 :]:
        return len(shown), len(shown), False
    return start, end, True


def render_turns(turns, template, history: int | None = None, before=()):
    """(role, span text, start and end of the text in it, rewritten) of each turn after the turns `before`; rewritten: this turn changed
    what stood before, or its text isn't shown exactly once."""
    history = getattr(template, "look_back", None) if history is None else history
    turns, before = list(turns), list(before)
    probe, old = free_probe([x for turn in (*before, *turns) for x in turn]), template(before)
    for role, text in turns:
        new = template([*before, (role, text)])
        at = len(old) if new.startswith(old) else _common(old, new)
        start, end, found = _text_bounds(new, template([*before, (role, probe)]), probe, at)
        yield role, new[at:], start - at, end - at, at < len(old) or not found
        before.append((role, text))
        if history is not None and len(before) > history:
            before = before[-history:] if history else []
            new = template(before)
        old = new


def render_rewritten(turns: list[tuple[str, str]], template) -> tuple[str, list[int], list[tuple[int, int]]]:
    """(last output, where each turn begins in it, bounds of its text) for a template that rewrites history.

    A turn begins where the last output parts from the output of the turns before it, but not before an earlier turn. A text that
    the output doesn't show exactly once has the output's end as its bounds.
    """
    final, begins, bounds = template(turns), [], []
    probe = free_probe([x for turn in turns for x in turn])
    for i in range(len(turns)):
        begins.append(max(_common(template(turns[:i]), final), begins[-1] if begins else 0))
        bounds.append(_text_bounds(final, template([*turns[:i], (turns[i][0], probe), *turns[i + 1 :]]), probe)[:2])
    return final, begins, bounds


COLUMNS = ["conv_id", "piece", "formatted", "roles", "turn_start", "text_start", "text_end", "loss", "rewritten"]
FORMATTED = "conv_id long, piece long, formatted string, roles array<string>, turn_start array<long>, text_start array<long>, text_end array<long>, loss array<boolean>, rewritten boolean"


def _conversations(batches, names):
    """Rows of sorted batches, grouped by the first column; groups go on over batches."""
    rows = (row for b in batches for row in zip(*(b.column(n).to_pylist() for n in names), strict=True))
    return groupby(rows, key=lambda r: r[0])


def _blocks(turns, most: int):
    """Turns in lists of bounded length and text."""
    block, chars = [], 0
    for role, text in turns:
        block.append((role, text))
        chars += len(text)
        if len(block) == most or chars >= BLOCK_CHARS:
            yield block
            block, chars = [], 0
    if block:
        yield block


def format_chats(chats: DataFrame, template=turn_template, loss_roles=("assistant",), conv_col: str = "conv_id", history: int | None = None, piece: int = 256, block_turns: int = 4096) -> DataFrame:
    """One row per conversation and piece: the formatted text and, for each turn, its start, its text's bounds and the mask.

    Rows go by conversation, turn, role, text; a null text or role is empty, null turns come first, equal rows are turns
    of their own. With a bounded look-back a conversation streams through its task in blocks, whatever its length.
    """
    look_back = getattr(template, "look_back", None) if history is None else history

    def run(batches):
        out: list[tuple] = []

        def flush():
            columns = list(zip(*out, strict=True))
            out.clear()
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), *[pa.list_(pa.int64())] * 3, pa.list_(pa.bool_()), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], COLUMNS)

        for conv, rows in _conversations(batches, ["conv_id", "role", "text"]):
            number, before, turns = 0, [], ((r[1], r[2]) for r in rows)
            for block in [list(turns)] if look_back is None else _blocks(turns, block_turns):
                rendered = list(render_turns(block, template, look_back if look_back is not None else len(block), before))
                again = any(t[-1] for t in rendered) or look_back is not None and template([*before, *block]) != template(before) + "".join(t[1] for t in rendered)
                if again and not before and number == 0:
                    block += turns  # the rest of the conversation
                    if look_back is not None:
                        rendered = list(render_turns(block, template, len(block)))
                    if any(t[-1] for t in rendered):
                        final, begins, bounds = render_rewritten(block, template)
                        out.append((conv, 0, final, [t[0] for t in block], begins, [x[0] for x in bounds], [x[1] for x in bounds], [t[0] in loss_roles for t in block], True))
                        rendered = []
                    again = False
                for i in range(0, len(rendered), piece):
                    held = rendered[i : i + piece]
                    starts = [0, *accumulate(len(h[1]) for h in held)][:-1]
                    out.append((conv, number, "".join(h[1] for h in held), [h[0] for h in held], starts, [at + h[2] for at, h in zip(starts, held, strict=True)], [at + h[3] for at, h in zip(starts, held, strict=True)], [h[0] in loss_roles for h in held], again))
                    number += 1
                before = [*before, *block][-look_back:] if look_back else []
                if len(out) >= 500:
                    yield flush()
        if out:
            yield flush()

    rows = chats.select(F.col(conv_col).cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, FORMATTED)


REPORT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewritten boolean"


def read_formatted(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation from its formatted pieces, in one streaming pass."""
    def run(batches):
        rows = []
        for conv, pieces in _conversations(batches, COLUMNS):
            turns, loss, n, chars, total, rewritten = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, False
            for _, _, formatted, roles, _, starts, ends, mask, again in pieces:
                for role, s, e, under in zip(roles, starts, ends, mask, strict=True):
                    text = unescape(formatted[s:e])
                    turns.update(f"{role}\n{text}\n".encode())
                    n += 1
                    if under:
                        loss.update(text.encode())
                        chars += len(text)
                total += len(formatted)
                rewritten |= again
            rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total, rewritten))
            if len(rows) >= 5000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=schema)

    names = [x.split()[0] for x in REPORT.split(", ")]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()], strict=True)))
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return ordered.mapInArrow(run, REPORT)


def chat_report(chats: DataFrame, **options) -> DataFrame:
    """Format, write, and read back."""
    return read_formatted(materialize(format_chats(chats, **options), "formatted-chats"))
