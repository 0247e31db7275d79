"""Chat formatting: conversations rendered by a compiled template, and read back.

The rows of a conversation are ordered by turn (nulls first; then by role and text), and the template is
rendered as the rows go by: neither a conversation nor its output is ever held whole, only one turn. Control
strings that occur in a role or text get a backslash after their first character, and one more if they
have some already; taking one away undoes it exactly.

Nulls: a null role or text is empty; rows with a null conv_id are one conversation without an id. Rows that
repeat wholly are turns of their own. An empty table gives an empty result. Columns other than conv_id,
turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import map_arrow, text_of
from tillwatch.llm.template import Piece, compile_template

START, MIDDLE, STOP = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: What must not come out of a text as it went in: this template's marks, and those of common others.
CONTROLS = (START, MIDDLE, STOP, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TEMPLATE = (
    "{% for m in messages %}"
    "{{ '<|im_start|>' + (m.role | escape) + '<|im_sep|>' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}"
    "{{ '<|im_end|>' }}"
    "{% endfor %}"
)

_TAILS = "|".join(re.escape(c) for c in sorted({c[1:] for c in CONTROLS}, key=len, reverse=True))
_RAW = re.compile(rf"([<\[])(\\*)({_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_TAILS})")


def escape(text: str) -> str:
    return _RAW.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def renderer(template: str = TEMPLATE):
    return compile_template(template, {"escape": escape, "trim": str.strip})


class Reader:
    """Reads output, in pieces cut anywhere, back into turns (role, text, text under the loss mask)."""

    def __init__(self):
        self.parts: list[Piece] = []
        self.tail = ""

    def turns(self, pieces: Iterable[Piece]) -> Iterator[tuple[str, str, str]]:
        for piece in pieces:
            self.parts.append(piece)
            joint = self.tail + piece[0]
            self.tail = joint[1 - len(STOP) :]
            while STOP in joint:  # marks are escaped everywhere else
                yield self._turn()
                joint = "".join(text for text, _ in self.parts)
                self.tail = joint[1 - len(STOP) :]
        if self.parts:
            raise ValueError("the output ends within a turn")

    def _turn(self) -> tuple[str, str, str]:
        whole = "".join(text for text, _ in self.parts)
        end = whole.index(STOP) + len(STOP)
        loss, rest, at = [], [], 0
        for text, generated in self.parts:
            cut = max(0, min(len(text), end - at))
            loss += [text[:cut]] * generated
            rest += [(text[cut:], generated)] * (cut < len(text))
            at += len(text)
        self.parts = rest
        role, mark, text = whole[: end - len(STOP)].removeprefix(START).partition(MIDDLE)
        if not whole.startswith(START) or not mark or START in role + text or MIDDLE in text:
            raise ValueError("the output holds a mark out of place")
        return unescape(role), unescape(text), unescape("".join(loss))


class _Summary:
    """What is read back of one conversation."""

    def __init__(self):
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def counted(self, pieces: Iterable[Piece]) -> Iterator[Piece]:
        for piece in pieces:
            self.formatted_chars += len(piece[0])
            yield piece

    def add(self, role: str, text: str, loss: str) -> None:
        self.n_turns += 1
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())
        self.loss_chars += len(loss)

    def row(self, conv_id: int | None) -> tuple:
        return (conv_id, self.n_turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars)


def _in_order(conversations: DataFrame) -> DataFrame:
    partitions = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            text_of("role").alias("role"),
            text_of("text").alias("text"),
        )
        .repartition(partitions, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Each conversation of sorted rows with its messages, which must be read before the next one."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            ids, _, roles, texts = batch.columns
            for i in range(batch.num_rows):
                yield ids[i].as_py(), {"role": roles[i].as_py(), "text": texts[i].as_py()}

    for conv_id, group in groupby(rows(), key=lambda r: r[0]):
        yield conv_id, (message for _, message in group)


def formatted(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """(conv_id, part, text, generated): the output in pieces, `part` counting from 0."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("generated", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = renderer(template)
        for conv_id, messages in _conversations(batches):
            for part, (text, generated) in enumerate(render({"messages": messages})):
                yield pa.RecordBatch.from_pylist(
                    [{"conv_id": conv_id, "part": part, "text": text, "generated": generated}], schema
                )

    return map_arrow(_in_order(conversations), run, "conv_id long, part long, text string, generated boolean")


def read_back(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Format every conversation, read the output back, and sum it up."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )

    def emit(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, done = renderer(template), []
        for conv_id, messages in _conversations(batches):
            summary = _Summary()
            for turn in Reader().turns(summary.counted(render({"messages": messages}))):
                summary.add(*turn)
            done.append(summary.row(conv_id))
            if len(done) >= 1_000:
                yield emit(done)
                done = []
        if done:
            yield emit(done)

    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(_in_order(conversations), run, kinds)


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations, and conversation -1, whose texts hold control strings."""
    text = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string"
    )
    own = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    return own.union(probe)
