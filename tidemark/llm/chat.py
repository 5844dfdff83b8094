"""Chat formatting by prefix-target expansion.

Every assistant turn of a conversation becomes an example of its own: all turns
before it are the context, and only its text is trainable. An example is the
formatted text with the place of its trainable part in code points
(``loss_start``, ``loss_end``; the loss mask is this one interval). A
conversation that doesn't end with an assistant turn has one more example
without a trainable part, so that no turn is lost.

The template writes a turn as ``<|im_start|>role\\ntext<|im_end|>\\n``. Control
strings (of this template and of other common ones) inside a role or text are
broken by a backslash after their first character, backslashes are doubled, and
newlines in roles are written ``\\n``; so a text can't open or close a turn, and
``unescape`` gives it back exactly.

Turns are dealt by conversation and sorted on the executors; a task streams
them and holds one conversation's text at a time, not its examples. (The
expansion itself has as many characters as the method asks for: the sum of all
prefixes. A stored file compresses them, since each repeats the one before.)

Defined results: null roles and texts are empty, null turns come first, turns
that share a number follow in the order of role and text, repeated rows are
repeated turns; rows with a null conv_id are one conversation. Other columns
are ignored. An empty table has no examples.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textcols import groups, limit_batches

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: The strings that chat templates give a meaning.
CONTROLS = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>",
    "<|begin_of_text|>", "<|end_of_text|>", "<|start_header_id|>", "<|end_header_id|>", "<|eot_id|>",
    "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>",
)
FLUSH_CHARS = 2_000_000
EXAMPLES = "conv_id long, example long, last boolean, text string, loss_start long, loss_end long"

_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(\\?)")
_ROLE_ESCAPED = re.compile(r"\\([\\n]?)")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.S)


def escape(text: str) -> str:
    # A broken string may leave another one that overlapped it, as in <<SYS>>.
    text = text.replace("\\", "\\\\")
    while (new := _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)) != text:
        text = new
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: {"n": "\n", "\\": "\\", "": ""}[m[1]], role)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and where its text begins and ends."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of all turns of a formatted text."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(formatted)]


def _deal(df: DataFrame, *order: str) -> DataFrame:
    """All rows of a conversation in one partition, in order."""
    return df.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", *order)


def expand(turns: DataFrame) -> DataFrame:
    """The examples of conversations given by (conv_id, turn, role, text)."""
    limit_batches(turns.sparkSession)
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                         F.coalesce("text", F.lit("")).alias("text"))
    schema = turns.sparkSession.createDataFrame([], EXAMPLES).schema
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], schema.names)

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        none = object()
        conv, done, text, waiting = none, 0, "", None
        for batch in batches:
            for c, role, said in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if c != conv:
                    if waiting is not None:
                        yield waiting
                    conv, done, text, waiting = c, 0, "", None
                elif waiting is not None and waiting[4] is not None:
                    yield (*waiting[:2], False, *waiting[3:])
                turn, a, b = format_turn(role, said)
                at = len(text)
                text += turn
                mine = role == ASSISTANT
                waiting = (c, done, True, text, at + a if mine else None, at + b if mine else None)
                done += mine
        if waiting is not None:
            yield waiting

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in examples(batches):
            held.append(row)
            size += len(row[3])
            if size >= FLUSH_CHARS:
                yield batch_of(held)
                held, size = [], 0
        if held:
            yield batch_of(held)

    return _deal(turns, "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(run, schema)


def digests(examples: DataFrame) -> DataFrame:
    """For each conversation, read back from its examples: n_turns and
    turns_sha256 (from the last example, which has all turns), loss_chars and
    loss_sha256 (all trainable text, in order), n_examples, formatted_chars."""
    limit_batches(examples.sparkSession, 64)
    kinds = {"conv_id": pa.int64(), "example": pa.int64(), "chars": pa.int64(), "loss": pa.string(),
             "n_turns": pa.int64(), "turns_sha256": pa.string()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                text = r["text"]
                loss = unescape(text[r["loss_start"]:r["loss_end"]]) if r["loss_start"] is not None else None
                n, digest = None, None
                if r["last"]:
                    turns = parse(text)
                    n, h = len(turns), hashlib.sha256()
                    for role, said in turns:
                        h.update(f"{role}\n{said}\n".encode())
                    digest = h.hexdigest()
                rows.append((r["conv_id"], r["example"], len(text), loss, n, digest))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], list(kinds))

    small = examples.mapInArrow(
        read, "conv_id long, example long, chars long, loss string, n_turns long, turns_sha256 string")
    out = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
           "loss_sha256": pa.string(), "formatted_chars": pa.int64(), "n_examples": pa.int64()}

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), out.values())], list(out))
            rows.clear()
            return made

        for group in groups(batches, ["conv_id"]):
            h, chars, total, count = hashlib.sha256(), 0, 0, 0
            n, digest = 0, None
            for r in group.to_pylist():
                if r["loss"] is not None:
                    h.update(r["loss"].encode())
                    chars += len(r["loss"])
                    count += 1
                total += r["chars"]
                if r["turns_sha256"] is not None:
                    n, digest = r["n_turns"], r["turns_sha256"]
            rows.append((r["conv_id"], n, digest, chars, h.hexdigest(), total, count))
            if len(rows) >= 512:
                yield flush()
        if rows:
            yield flush()

    return _deal(small, "example").mapInArrow(
        join, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
              "formatted_chars long, n_examples long")
