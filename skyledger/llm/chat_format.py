"""Chat formatting of typed content parts.

A turn is a list of parts: text, image, audio, document. A visitor flattens them,
in order, into one string: texts with control characters escaped, other parts as
numbered placeholders. Every attachment's reference is recorded, and every part's
token count, placeholders expanded. The template marks turns; a loss mask gives the
places of what the assistant says.

Escaping is reversible and leaves no character that could begin a control string,
so a text that contains control strings is read back as it was.

Rows are dealt by conversation and sorted, and both formatting and reading back
stream over them with the state of one conversation, however long it is.

Null roles, texts and part lists are empty. Null conversation ids are one
conversation; null turns come first; turns with equal numbers are ordered by role,
then by content, and all kept. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import row_pass

PART = (
    "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
BEGIN, END = "<s>", "<|end|>\n"
LOSS_ROLE = "assistant"

#: Tokens of a placeholder: per image tile, tile side, per second, per page.
IMAGE_TILE_TOKENS, IMAGE_TILE, AUDIO_TOKENS, PAGE_TOKENS = 85, 512, 25, 400

# Control strings begin with one of these; "&" goes first and comes back last.
_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("|", "&bar;"), ("[", "&sq;")]
_TURN = re.compile(r"(?:<s>)?<\|([^|]*)\|>\n(.*)<\|end\|>\n", re.DOTALL)


def escape(text: str) -> str:
    for plain, coded in _ESCAPES:
        text = text.replace(plain, coded)
    return text


def unescape(text: str) -> str:
    for plain, coded in reversed(_ESCAPES):
        text = text.replace(coded, plain)
    return text


def text_part(text: Column) -> Column:
    """A turn's content when it is nothing but a text."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("int").alias("width"),
            F.lit(None).cast("int").alias("height"),
            F.lit(None).cast("double").alias("seconds"),
            F.lit(None).cast("int").alias("pages"),
        )
    )


class PartVisitor:
    """Flattens the parts of a conversation; attachments are numbered through."""

    def __init__(self, count_text: Callable[[str], int]):
        self.count_text = count_text
        self.attached = 0
        self.new_turn()

    def new_turn(self) -> None:
        self.out: list[str] = []
        self.attachments: list[dict] = []
        self.tokens = 0

    def visit(self, part: dict) -> None:
        kind = part["kind"] or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        text = part["text"] or ""
        self.out.append(escape(text))
        self.tokens += self.count_text(text)

    def visit_image(self, part: dict) -> None:
        sides = (math.ceil((part[s] or 1) / IMAGE_TILE) for s in ("width", "height"))
        self._attach(part, math.prod(max(1, s) for s in sides) * IMAGE_TILE_TOKENS)

    def visit_audio(self, part: dict) -> None:
        self._attach(part, math.ceil(max(0.0, part["seconds"] or 0.0) * AUDIO_TOKENS))

    def visit_document(self, part: dict) -> None:
        self._attach(part, max(0, part["pages"] or 0) * PAGE_TOKENS)

    def visit_other(self, part: dict) -> None:
        """An unknown kind keeps its reference and counts no tokens."""
        self._attach(part, 0)

    def _attach(self, part: dict, tokens: int) -> None:
        self.attached += 1
        kind = part["kind"]
        self.out.append(f"<{escape(kind)}:{self.attached}>")
        self.attachments.append(
            {"number": self.attached, "kind": kind, "ref": part["ref"], "tokens": tokens}
        )
        self.tokens += tokens


def _n_words(text: str) -> int:
    return len(text.split())


class _Formatter:
    def __init__(self, count_text: Callable[[str], int]):
        self.count_text = count_text
        self.conv, self.seq, self.at = object(), 0, 0

    def __call__(self, batch: pa.RecordBatch) -> dict:
        out = {n: [] for n in FORMATTED}
        for conv, turn, role, parts in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if conv != self.conv:
                self.conv, self.seq, self.at = conv, 0, 0
                self.visitor = PartVisitor(self.count_text)
            self.visitor.new_turn()
            for part in parts or ():
                if part is not None:
                    self.visitor.visit(part)
            head = f"{BEGIN if self.seq == 0 else ''}<|{escape(role or '')}|>\n"
            content = "".join(self.visitor.out)
            piece = head + content + END
            loss = role == LOSS_ROLE
            row = (
                conv, self.seq, turn, piece, self.at,
                self.at + len(head) if loss else None,
                self.at + len(head) + len(content) if loss else None,
                self.visitor.attachments, self.visitor.tokens,
            )
            for values, value in zip(out.values(), row):
                values.append(value)
            self.seq += 1
            self.at += len(piece)
        return out


FORMATTED = {
    "conv_id": "long", "seq": "long", "turn": "long", "piece": "string", "start": "long",
    "loss_start": "long", "loss_end": "long",
    "attachments": "array<struct<number:long,kind:string,ref:string,tokens:long>>", "tokens": "long",
}


def format_turns(turns: DataFrame, count_text: Callable[[str], int] = _n_words) -> DataFrame:
    """The formatted conversations, a row per turn, in order within each partition.

    ``turns``: ``conv_id, turn, role, parts`` (an array of ``PART``). The pieces of a
    conversation in order of ``seq`` are its formatted text; ``start`` and the loss
    mask, ``loss_start`` to ``loss_end``, are places in it, in code points.
    """
    columns = [
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role"),
        F.col("parts").cast(f"array<{PART}>"),
    ]
    dealt = turns.select(*columns).repartition("conv_id")
    ordered = dealt.sortWithinPartitions(
        "conv_id", "turn", "role", F.to_json("parts")
    )
    schema = ", ".join(f"{n} {t}" for n, t in FORMATTED.items())
    return row_pass(ordered, schema, lambda: _Formatter(count_text))


class _Reader:
    """Digests of conversations, from their formatted pieces and the loss mask."""

    def __init__(self):
        self.conv, self.rows = object(), 0

    def _begin(self, conv) -> None:
        self.conv, self.n_turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def _end(self, out: list) -> None:
        if self.rows:
            out.append(
                (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)
            )

    def _columns(self, out: list) -> dict | None:
        return {n: [r[i] for r in out] for i, n in enumerate(READ_BACK)} if out else None

    def __call__(self, batch: pa.RecordBatch) -> dict | None:
        out: list = []
        for conv, piece, start, low, high in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if conv != self.conv:
                self._end(out)
                self._begin(conv)
            self.rows += 1
            role, content = _TURN.fullmatch(piece).groups()
            self.turns.update(f"{unescape(role)}\n{unescape(content)}\n".encode())
            if low is not None:
                said = unescape(piece[low - start : high - start])
                self.loss.update(said.encode())
                self.loss_chars += len(said)
            self.n_turns += 1
            self.chars += len(piece)
        return self._columns(out)

    def last(self) -> dict | None:
        out: list = []
        self._end(out)
        return self._columns(out)


READ_BACK = {
    "conv_id": "long", "n_turns": "long", "turns_sha256": "string", "loss_chars": "long",
    "loss_sha256": "string", "formatted_chars": "long",
}


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read from the output of ``format_turns`` (its rows
    must still be in its order)."""
    rows = formatted.select("conv_id", "piece", "start", "loss_start", "loss_end")
    schema = ", ".join(f"{n} {t}" for n, t in READ_BACK.items())
    return row_pass(rows, schema, _Reader, _Reader.last)
