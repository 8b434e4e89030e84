"""Chat formatting from typed content parts.

Method: a turn is a list of typed parts. A visitor flattens text, image, audio and
document parts into one text with ordered placeholders, and records for each
attachment its reference and the tokens that it expands to. The template sets control
strings around turns; control strings inside texts are escaped, reversibly, so no text
can end a turn or open another. The loss mask covers exactly the assistant's texts.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The strings that mark turns and placeholders, here and in common chat templates.
CONTROL = r"\|[A-Za-z_]+(?::[0-9]+)?\|>|/?s>|/?INST\]|/?SYS>>"
BEGIN, END = "<|turn|>", "<|end|>"

_ESCAPE = re.compile(rf"([<\[])(\\*)(?={CONTROL})")
_TOKEN = re.compile(r"\w+|[^\w\s]")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)(?={CONTROL})")
PARTS = "array<struct<kind:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>>"
SEGMENT = "conv_id {id}, seq long, role string, segment string, loss_start int, loss_end int, attachments array<struct<ordinal:int,kind:string,uri:string,tokens:long>>, n_tokens long"

_SEGMENT = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.struct([("ordinal", pa.int32()), ("kind", pa.string()), ("uri", pa.string()), ("tokens", pa.int64())])), pa.int64())


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Flattener:
    """Visits the parts of a turn in order."""

    def __init__(self, patch: int = 14, per_second: int = 25, per_page: int = 512):
        self.patch, self.per_second, self.per_page = patch, per_second, per_page
        self.pieces: list[tuple[bool, str]] = []
        self.attachments: list[tuple[int, str, str | None, int]] = []
        self.tokens = 0

    @property
    def body(self) -> str:
        """The content. Texts that follow one another are escaped as one, so that no control string arises where they meet."""
        return "".join(escape("".join(x for _, x in run)) if text else "".join(x for _, x in run) for text, run in groupby(self.pieces, key=lambda p: p[0]))

    def visit(self, part: dict) -> None:
        getattr(self, f"visit_{part.get('kind') or 'text'}", self.visit_unknown)(part)

    def visit_text(self, part: dict) -> None:
        text = part.get("text") or ""
        self.pieces.append((True, text))
        self.tokens += len(_TOKEN.findall(text))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, math.ceil((part.get("width") or 0) / self.patch) * math.ceil((part.get("height") or 0) / self.patch))

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, math.ceil((part.get("seconds") or 0.0) * self.per_second))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 0) * self.per_page)

    def visit_unknown(self, part: dict) -> None:
        self._attach("unknown", part, 0)

    def _attach(self, kind: str, part: dict, tokens: int) -> None:
        ordinal = len(self.attachments) + 1
        self.pieces.append((False, f"<|{kind}:{ordinal}|>"))
        self.attachments.append((ordinal, kind, part.get("uri"), tokens))
        self.tokens += tokens


def format_turns(turns: DataFrame, **sizes: int) -> DataFrame:
    """turns(conv_id, turn, role, parts) -> a formatted segment for each turn, a conversation's segments together and in order.

    Rows go by turn (nulls first), then role, then their content; ties and repeated
    rows are turns of their own. Null parts, texts and roles are empty; a part of a
    kind not known becomes an attachment without tokens. loss_start and loss_end (code
    points in the segment, end exclusive) cover the content of an assistant's turn and
    are null for others. Rows stream through a task one by one, so a conversation may
    be of any length. A conversation's text is its segments joined.
    """
    parts = max(1, int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = turns.select("conv_id", "turn", "role", "parts").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "parts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seq = object(), 0
        for b in batches:
            out = []
            for conv, _, role, content in zip(*(c.to_pylist() for c in b.columns)):
                if conv != now:
                    now, seq = conv, 0
                role = role or ""
                visitor = Flattener(**sizes)
                for part in content if content is not None else ():
                    visitor.visit(part)
                head = f"{BEGIN}{escape_role(role)}\n"
                body = visitor.body
                mask = (len(head), len(head) + len(body)) if role == "assistant" else (None, None)
                out.append((seq, role, f"{head}{body}{END}\n", *mask, [dict(zip(("ordinal", "kind", "uri", "tokens"), a)) for a in visitor.attachments], visitor.tokens))
                seq += 1
            if out:
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(zip(*out), _SEGMENT))], ["conv_id", "seq", "role", "segment", "loss_start", "loss_end", "attachments", "n_tokens"])

    return rows.mapInArrow(run, SEGMENT.format(id=turns.schema["conv_id"].dataType.simpleString()))


def parse_segment(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn, unescaped."""
    if not segment.startswith(BEGIN) or not segment.endswith(END + "\n"):
        raise ValueError("not a formatted turn")
    role, _, body = segment[len(BEGIN) : -len(END) - 1].partition("\n")
    if BEGIN in body or END in body:
        raise ValueError("a control string inside a turn")
    return unescape_role(role), unescape(body)


def read_back(segments: DataFrame) -> DataFrame:
    """The result of format_turns, as it comes -> conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the segments and their masks alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, row, kind = object(), None, None
        for b in batches:
            done, kind = [], b.column(0).type
            for conv, segment, low, high in zip(*(c.to_pylist() for c in b.columns)):
                if row is None or conv != now:
                    if row is not None:
                        done.append(finish(now, row))
                    now, row = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_segment(segment)
                row[0] += 1
                row[1].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                if low is not None:
                    learned = unescape(segment[low:high])
                    row[2] += len(learned)
                    row[3].update(learned.encode("utf-8", "replace"))
                row[4] += len(segment)
            if done:
                yield batch(done, kind)
        if row is not None:
            yield batch([finish(now, row)], kind)

    def finish(conv, row):
        return conv, row[0], row[1].hexdigest(), row[2], row[3].hexdigest(), row[4]

    def batch(rows, kind):
        kinds = (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return segments.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(run, f"conv_id {segments.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def text_turns(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text, ...) -> turns with one text part each; other columns are not read."""
    part = F.struct(F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("string").alias("uri"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))
    return conversations.select("conv_id", "turn", "role", F.array(part).cast(PARTS).alias("parts"))
