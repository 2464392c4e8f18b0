"""Formatting conversations of typed content parts as training text with a loss mask.

A visitor flattens the parts of a turn in order: text is escaped, an image,
audio or document part leaves a numbered placeholder and an attachment with the
number of tokens it expands to. A turn becomes one segment; the segments of a
conversation in turn order are its text, so that no conversation has to fit one
row. Control strings never stand in a segment but where the template puts them.
"""

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlive.llm.common import text_of

# What stands before and after the text of a turn.
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
    "user": ("<s>[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
}
OTHER = ("<|role:", "|> ", " <|end|>")
LOSS_ROLE = "assistant"
#: Tokens per tile, second and page.
IMAGE_TOKENS, AUDIO_TOKENS, DOCUMENT_TOKENS = 256, 25, 512

#: The escape mark itself, or the first character of a control string.
CONTROL = re.compile(r"\\|<(?=/?s>|<SYS>>|</SYS>>|\|)|\[(?=/?INST\])|\|(?=>)")
ESCAPED = {"\\": "\\\\", "<": "\\l", "[": "\\b", "|": "\\p"}
PLAIN = {escaped[1]: character for character, escaped in ESCAPED.items()}

PARTS = "array<struct<kind:string,text:string,ref:string,units:double>>"
SEGMENT = (
    "conv_id long, turn long, segment string, loss_start int, loss_end int, "
    "attachments array<struct<kind:string,ref:string,tokens:long>>, placeholder_tokens long"
)


def escape(text: str) -> str:
    return CONTROL.sub(lambda found: ESCAPED[found[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda found: PLAIN[found[1]], text)


class Flattener:
    """Visits the parts of one turn."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        """A part of unknown kind is taken as a document; a missing part leaves nothing."""
        if part is not None:
            getattr(self, f"visit_{part['kind']}", self.visit_document)(part)

    def visit_text(self, part: dict) -> None:
        self.text.append(escape(part["text"] or ""))

    def visit_image(self, part: dict) -> None:
        self._attach("image", part, IMAGE_TOKENS)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, AUDIO_TOKENS)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, DOCUMENT_TOKENS)

    def _attach(self, kind: str, part: dict, each: int) -> None:
        """One unit at least: a tile, a second, a page."""
        units = part["units"]
        count = max(1, math.ceil(units)) if units is not None and math.isfinite(units) else 1
        self.text.append(f"<|{kind}:{len(self.attachments)}|>")
        self.attachments.append({"kind": kind, "ref": part["ref"], "tokens": count * each})


def segment(role: str, parts: list[dict] | None) -> tuple[str, int, int, list[dict]]:
    """The text of a turn, the characters the loss covers, and its attachments."""
    visitor = Flattener()
    for part in parts or ():
        visitor.visit(part)
    before, after = TEMPLATE.get(role) or (f"{OTHER[0]}{escape(role)}{OTHER[1]}", OTHER[2])
    body = "".join(visitor.text)
    end = len(before) + len(body) if role == LOSS_ROLE else len(before)
    return before + body + after, len(before), end, visitor.attachments


def read_segment(text: str) -> tuple[str, str]:
    """Role and text of a turn, from its segment."""
    for role, (before, after) in TEMPLATE.items():
        if text.startswith(before) and text.endswith(after):
            return role, unescape(text[len(before) : len(text) - len(after)])
    role, _, body = text.removeprefix(OTHER[0]).partition(OTHER[1])
    return unescape(role), unescape(body.removesuffix(OTHER[2]))


def format_turns(turns: DataFrame) -> DataFrame:
    """A segment per row of (conv_id, turn, role, text or parts): see SEGMENT.

    ``parts`` wins over ``text`` where both are columns. Null text is empty, a
    null role the empty role. Repeated rows are turns of their own. Extra
    columns are left out.
    """
    parts = F.col("parts").cast(PARTS) if "parts" in turns.columns else F.array(_text_part()).cast(PARTS)
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), parts.alias("parts"),
    )

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [segment(*row) for row in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))
            tokens = [sum(one["tokens"] for one in row[3]) for row in found]
            yield pa.RecordBatch.from_pydict(
                {
                    "conv_id": batch.column(0),
                    "turn": batch.column(1),
                    "segment": pa.array([row[0] for row in found], pa.string()),
                    "loss_start": pa.array([row[1] for row in found], pa.int32()),
                    "loss_end": pa.array([row[2] for row in found], pa.int32()),
                    "attachments": pa.array([row[3] for row in found], kind),
                    "placeholder_tokens": pa.array(tokens, pa.int64()),
                }
            )

    return rows.mapInArrow(render, SEGMENT)


def _text_part():
    none = F.lit(None)
    return F.struct(
        F.lit("text").alias("kind"), text_of("text").alias("text"), none.cast("string").alias("ref"),
        none.cast("double").alias("units"),
    )


def conversation_digests(segments: DataFrame) -> DataFrame:
    """What reads back from the segments of each conversation, in turn order.

    Turns with one number are ordered by their segment, a missing number comes
    first, and a null conv_id is one conversation. A conversation streams through its
    task turn by turn, however long it is.
    """
    ordered = segments.select("conv_id", "turn", "segment", "loss_start", "loss_end").repartition("conv_id")
    return ordered.sortWithinPartitions("conv_id", "turn", "segment").mapInArrow(
        _digest_runs(_Conversation),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


class _Conversation:
    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, begin: int, end: int) -> None:
        role, said = read_segment(text)
        self.all.update(f"{role}\n{said}\n".encode())
        learned = unescape(text[begin:end])
        self.loss.update(learned.encode())
        self.turns, self.loss_chars, self.chars = (
            self.turns + 1, self.loss_chars + len(learned), self.chars + len(text),
        )

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars,
        }


def _digest_runs(start: type[_Conversation]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, schema = None, pa.schema(
            [
                ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
            ]
        )
        for batch in batches:
            over = []
            for conv_id, _, text, begin, end in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if now is None or now.conv_id != conv_id:
                    over += [now.row()] if now else []
                    now = start(conv_id)
                now.add(text, begin, end)
            if over:
                yield pa.RecordBatch.from_pylist(over, schema)
        if now:
            yield pa.RecordBatch.from_pylist([now.row()], schema)

    return digest
