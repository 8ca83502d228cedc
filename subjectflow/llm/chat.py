"""Chat formatting with typed content parts, a loss mask, and the way back.

A turn's content is a list of parts: text, image, audio or document. A visitor flattens them
in order: text is escaped, every other part becomes its placeholder, an attachment reference
(kind, ref, which placeholder of the conversation, at which code point) and the number of
tokens that the placeholder stands for once expanded. A turn is written as

    <|turn|>role<|text|>content<|end|>

and the loss mask has the code point range of each assistant content.

**Escaping.** Backslashes are doubled, then one is put behind the first character of every
control string in a text. So no text holds a control string, and undoing is exact: a doubled
backslash is one, a single one goes.

Conversations are formatted by one ordered pass over each partition and handed out in pieces
of bounded size, so a conversation may be longer than memory. Rows are ordered by turn (null
first), then role and text. Null role or text: empty. A null ``conv_id`` is a conversation
of its own. Parts of another kind are refused.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}

# Strings that templates in use give a meaning to; texts must not hold them unescaped.
CONTROL = (
    TURN, TEXT, END, *PLACEHOLDERS.values(), "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>",
)

_CONTROL_AT = re.compile(rf"(?=(?:{'|'.join(map(re.escape, CONTROL))}))(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\(\\?)")
_MARK = re.compile("|".join(map(re.escape, (TURN, TEXT, END))))
_ANY_PLACEHOLDER = re.compile("(" + "|".join(map(re.escape, PLACEHOLDERS.values())) + ")")

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<kind:string,ref:string,number:long,at:long,tokens:long>"
OUTPUT = f"piece int, turns long, formatted string, loss array<struct<begin:long,end:long>>, attachments array<{ATTACHMENT}>, expanded_tokens long"
#: Code points of a piece of output, about.
PIECE = 4_000_000


def escape(text: str) -> str:
    """A text without control strings, from which ``unescape`` gives the text again."""
    return _CONTROL_AT.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Sizes:
    """What placeholders expand to: an image one token per square patch, audio so many a second, documents so many a page."""

    patch: int = 28
    audio_rate: float = 25.0
    page: int = 256


@dataclass
class Flattener:
    """The visitor: one method per kind of part; collects text and attachments in order."""

    sizes: Sizes = field(default_factory=Sizes)
    number: int = 0

    def visit(self, parts, at: int) -> tuple[str, list[dict]]:
        """Content of a turn that begins at code point ``at``, and its attachments."""
        out, found = [], []
        for part in parts:
            kind = (part["type"] or "text").lower()
            method = getattr(self, f"on_{kind}", None)
            if method is None:
                raise ValueError(f"unknown kind of part: {kind}")
            text, attached = method(part)
            if attached:
                found.append(attached | {"number": self.number, "at": at})
                self.number += 1
            out.append(text)
            at += len(text)
        return "".join(out), found

    def on_text(self, part) -> tuple[str, None]:
        return escape(part["text"] or ""), None

    def on_image(self, part) -> tuple[str, dict]:
        patch = self.sizes.patch
        return self._attached("image", part, math.ceil((part["width"] or 0) / patch) * math.ceil((part["height"] or 0) / patch))

    def on_audio(self, part) -> tuple[str, dict]:
        return self._attached("audio", part, math.ceil((part["seconds"] or 0) * self.sizes.audio_rate))

    def on_document(self, part) -> tuple[str, dict]:
        return self._attached("document", part, (part["pages"] or 0) * self.sizes.page)

    def _attached(self, kind: str, part, tokens: int) -> tuple[str, dict]:
        return PLACEHOLDERS[kind], {"kind": kind, "ref": part["ref"], "tokens": max(1, tokens)}


def format_conversations(turns: DataFrame, sizes: Sizes = Sizes(), piece: int = PIECE) -> DataFrame:  # noqa: B008
    """Formatted conversations: ``conv_id`` and the columns of ``OUTPUT``, one row per piece.

    ``turns``: conv_id, turn, role, and ``parts`` (an array of ``PART``) or ``text``.
    Positions in ``loss`` and ``attachments`` count from the start of the conversation.
    """
    if "parts" in turns.columns:
        parts = F.coalesce(F.col("parts").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
        order = F.to_json(parts)
    else:
        order = F.coalesce(F.col("text").cast("string"), F.lit(""))
        parts = order
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.col("turn").alias("_turn"), role.alias("_role"), order.alias("_order"), parts.alias("_parts"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "_turn", "_role", "_order").drop("_order")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conversation, begun = None, False
        for batch in batches:
            out = []
            for conv, role, content in zip(batch["conv_id"], batch["_role"], batch["_parts"], strict=True):
                conv = None if pd.isna(conv) else conv
                if not begun or conv != conversation.conv_id:
                    if begun:
                        out.append(conversation.piece())
                    conversation, begun = _Conversation(conv, sizes), True
                conversation.add(role, content)
                if conversation.held > piece:
                    out.append(conversation.piece())
            if out:
                yield pd.DataFrame(out, columns=_NAMES)
        if begun and conversation.held:
            yield pd.DataFrame([conversation.piece()], columns=_NAMES)

    fields = turns.select("conv_id").schema
    for f in T._parse_datatype_string(OUTPUT).fields:
        fields = fields.add(f)
    return rows.mapInPandas(run, fields)


_NAMES = ["conv_id", "piece", "turns", "formatted", "loss", "attachments", "expanded_tokens"]


class _Conversation:
    """A conversation being written."""

    def __init__(self, conv_id, sizes: Sizes):
        self.conv_id, self.flattener, self.at, self.number = conv_id, Flattener(sizes), 0, 0
        self._clear()

    def _clear(self) -> None:
        self.text, self.loss, self.attachments, self.turns, self.held = [], [], [], 0, 0

    def add(self, role: str, content) -> None:
        head = TURN + escape(role) + TEXT
        parts = [{"type": "text", "text": content}] if isinstance(content, str) else content
        begin = self.at + len(head)
        body, attached = self.flattener.visit(parts, begin)
        if role == "assistant":
            self.loss.append({"begin": begin, "end": begin + len(body)})
        self.text += [head, body, END]
        self.attachments += attached
        size = len(head) + len(body) + len(END)
        self.turns, self.held, self.at = self.turns + 1, self.held + size, self.at + size

    def piece(self) -> tuple:
        tokens = sum(a["tokens"] for a in self.attachments)
        row = (self.conv_id, self.number, self.turns, "".join(self.text), self.loss, self.attachments, tokens)
        self.number += 1
        self._clear()
        return row


def turns_of(formatted: str) -> Iterator[tuple[str, str, int]]:
    """(role, content still escaped, where the content begins) of each turn of a formatted text."""
    at = 0
    while at < len(formatted):
        text = formatted.index(TEXT, at)
        end = _MARK.search(formatted, text + len(TEXT))
        if not formatted.startswith(TURN, at) or end is None or end[0] != END:
            raise ValueError("not a formatted conversation")
        yield unescape(formatted[at + len(TURN) : text]), formatted[text + len(TEXT) : end.start()], text + len(TEXT)
        at = end.end()


def parts_of(content: str) -> list[tuple[str, str]]:
    """(kind, text) of the parts of an escaped content; attachments have no text."""
    kinds = {v: k for k, v in PLACEHOLDERS.items()}
    return [(kinds[x], "") if x in kinds else ("text", unescape(x)) for x in _ANY_PLACEHOLDER.split(content) if x]


def digests(formatted: DataFrame) -> DataFrame:
    """What formatted conversations hold, read from their text and loss mask, one row per conversation."""
    rows = formatted.select("conv_id", "piece", "formatted", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = None
        for batch in batches:
            out = []
            for conv, text, loss in zip(batch["conv_id"], batch["formatted"], batch["loss"], strict=True):
                conv = None if pd.isna(conv) else conv
                if reader is None or reader.conv_id != conv:
                    if reader is not None:
                        out.append(reader.row())
                    reader = _Reader(conv)
                reader.read(text, loss)
            if out:
                yield pd.DataFrame(out, columns=names)
        if reader is not None:
            yield pd.DataFrame([reader.row()], columns=names)

    schema = formatted.select("conv_id").schema.add("n_turns", "long").add("turns_sha256", "string").add("loss_chars", "long")
    return rows.mapInPandas(run, schema.add("loss_sha256", "string").add("formatted_chars", "long"))


class _Reader:
    """Digests of one conversation, piece by piece."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.at = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, loss) -> None:
        for role, content, _ in turns_of(text):
            self.all.update(f"{role}\n{unescape(content)}\n".encode())
            self.turns += 1
        for span in loss:
            under = unescape(text[span["begin"] - self.at : span["end"] - self.at])
            self.loss.update(under.encode())
            self.loss_chars += len(under)
        self.at += len(text)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.at


def _sql_escaped(column: str) -> str:
    """The escaping as nested SQL replacements (control strings don't overlap one another)."""
    out = f"replace({column}, '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


#: The same digests in DuckDB's SQL, for the given conversations and the one that holds control strings.
ORACLE_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length({_sql_escaped('role')}) + length({_sql_escaped('text')}) + {len(TURN + TEXT + END)} AS size FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
