"""Fill-in-middle transformation on a piece table.

A document is a list of descriptors (start and end in an immutable buffer). Its
text lies in the batch's text buffer, the sentinels in a buffer of their own;
neither is ever changed or copied to form an example. Cutting splits a
document's one descriptor at two places into prefix, middle and suffix; an
arrangement permutes these and the three sentinel descriptors; the inverse
permutation puts them back. Hashes stream the descriptors in order, and an
output text is written from them once, at the end.

``restore`` starts from the written output and the form alone: the sentinels
found in the output give its descriptors, the inverse permutation of the form
and leaving out the sentinels give the text. That is exact because no
transformed text contains a sentinel (such texts stay plain) and because a
sentinel's first character is found nowhere else in a sentinel, so none can
appear across a joint.

The cuts and the form depend on the key and the seed only, so a retried task
and a second run give the same output. Texts are cut between code points.

Defined results: a null text is empty, an empty text is plain; a null key counts
as an empty one in the seeded hash; rows that share a key get the cuts that
their own lengths give; repeated rows are repeated. Other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textcols import flat, gather, limit_batches, slices

#: What marks prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
FIM_PERCENT = 90
SPM_PERCENT = 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Pieces of a document in reading order, then the sentinels.
PREFIX, MIDDLE, SUFFIX, MARK_P, MARK_S, MARK_M = range(6)
ARRANGEMENTS = {
    PSM: np.array([MARK_P, PREFIX, MARK_S, SUFFIX, MARK_M, MIDDLE]),
    SPM: np.array([MARK_S, SUFFIX, MARK_P, PREFIX, MARK_M, MIDDLE]),
}


def check_sentinels(sentinels: tuple[str, str, str]) -> list[bytes]:
    """The sentinels as bytes; raises if one could be read where none was written."""
    heads = {s[:1] for s in sentinels}
    if len(sentinels) != 3 or len(set(sentinels)) != 3 or not all(sentinels) or any(c in heads for s in sentinels for c in s[1:]):
        raise ValueError("three different sentinels are needed whose first characters occur nowhere else in them")
    if any(a.startswith(b) for a in sentinels for b in sentinels if a != b):
        raise ValueError("no sentinel may begin another")
    return [s.encode() for s in sentinels]


@dataclass
class PieceTable:
    """Descriptors of several documents: document i has ``first[i]:first[i + 1]``."""

    buffer: np.ndarray  # the immutable bytes: texts, then sentinels
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def of_texts(cls, raw: np.ndarray, off: np.ndarray, sentinels: list[bytes] = ()) -> PieceTable:
        tail = np.frombuffer(b"".join(sentinels), np.uint8)
        return cls(np.concatenate([raw, tail]) if len(tail) else raw, np.arange(len(off)), off[:-1].copy(), off[1:].copy())

    def cut(self, docs: np.ndarray, places: np.ndarray) -> PieceTable:
        """Split the one descriptor of each of ``docs`` (ascending) at its ``places``
        (a row of ascending byte positions each)."""
        extra = np.zeros(len(self.first) - 1, np.int64)
        extra[docs] = places.shape[1]
        first = self.first + np.r_[0, np.cumsum(extra)]
        start, end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        start[first[:-1]], end[first[1:] - 1] = self.start, self.end
        rows = first[docs][:, None] + np.arange(places.shape[1])
        end[rows], start[rows + 1] = places, places
        return PieceTable(self.buffer, first, start, end)

    def add(self, docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> PieceTable:
        """The same descriptors ``start:end`` appended to each of ``docs``."""
        extra = np.zeros(len(self.first) - 1, np.int64)
        extra[docs] = len(start)
        first = self.first + np.r_[0, np.cumsum(extra)]
        old = np.arange(self.first[-1]) + np.repeat(first[:-1] - self.first[:-1], np.diff(self.first))
        new_start, new_end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        new_start[old], new_end[old] = self.start, self.end
        rows = first[docs + 1][:, None] - len(start) + np.arange(len(start))
        new_start[rows], new_end[rows] = start, end
        return PieceTable(self.buffer, first, new_start, new_end)

    def permute(self, docs: np.ndarray, order: np.ndarray) -> PieceTable:
        """The descriptors of each of ``docs`` in the given order."""
        rows = self.first[docs][:, None]
        start, end = self.start.copy(), self.end.copy()
        to = rows + np.arange(len(order))
        start[to], end[to] = self.start[rows + order], self.end[rows + order]
        return PieceTable(self.buffer, self.first, start, end)

    def keep(self, docs: np.ndarray, pieces: int) -> PieceTable:
        """Only the first ``pieces`` descriptors of each of ``docs``."""
        size = np.diff(self.first)
        size[docs] = pieces
        rows = gather(np.arange(self.first[-1]), self.first[:-1], size)
        return PieceTable(self.buffer, np.r_[0, np.cumsum(size)], self.start[rows], self.end[rows])

    def hashes(self) -> list[str]:
        """The sha256 of each document, streamed from its descriptors."""
        view, start, end, first = memoryview(self.buffer), self.start.tolist(), self.end.tolist(), self.first.tolist()
        out = []
        for a, b in zip(first[:-1], first[1:]):
            h = hashlib.sha256()
            for k in range(a, b):
                h.update(view[start[k]:end[k]])
            out.append(h.hexdigest())
        return out

    def written(self) -> pa.Array:
        """The documents as texts."""
        size = self.end - self.start
        total = np.r_[0, np.cumsum(size)]
        return pa.LargeStringArray.from_buffers(
            len(self.first) - 1, pa.py_buffer(total[self.first].astype(np.int64)),
            pa.py_buffer(np.ascontiguousarray(gather(self.buffer, self.start, size))))


def find(raw: np.ndarray, off: np.ndarray, pattern: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(position, document) of every occurrence of ``pattern`` inside a document."""
    n = len(raw) - len(pattern) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(raw[:n] == pattern[0])
    for i, b in enumerate(pattern[1:], 1):
        at = at[raw[at + i] == b]
    doc = np.searchsorted(off, at, side="right") - 1
    inside = at + len(pattern) <= off[doc + 1]
    return at[inside], doc[inside]


def draws(keys: list, seed: str) -> np.ndarray:
    """Four 32-bit numbers for each key: the head of the sha256 of ``seed:key``."""
    heads = b"".join(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).digest()[:16] for k in keys)
    return np.frombuffer(heads, ">u4").reshape(-1, 4).astype(np.int64)


def form_batch(keys: list, raw: np.ndarray, off: np.ndarray, sentinels: list[bytes], seed: str,
               fim_percent: int, spm_percent: int):
    """(table of the output, code points, forms, prefix and middle in code points)."""
    begins = np.flatnonzero((raw & 0xC0) != 0x80)
    first = np.searchsorted(begins, off)
    n = np.diff(first)
    h = draws(keys, seed)
    cut = np.sort(h[:, :2] % (n[:, None] + 1), axis=1)
    plain = (n == 0) | (h[:, 2] % 100 >= fim_percent)
    for s in sentinels:
        plain[find(raw, off, s)[1]] = True
    spm = ~plain & (h[:, 3] % 100 < spm_percent)
    made = np.flatnonzero(~plain)
    places = np.append(begins, len(raw))[first[made][:, None] + cut[made]]
    size = np.array([len(s) for s in sentinels])
    ends = len(raw) + np.cumsum(size)
    table = PieceTable.of_texts(raw, off, sentinels).cut(made, places).add(made, ends - size, ends)
    table = table.permute(np.flatnonzero(~plain & ~spm), ARRANGEMENTS[PSM]).permute(np.flatnonzero(spm), ARRANGEMENTS[SPM])
    return table, n, np.where(plain, PLAIN, np.where(spm, SPM, PSM)), cut[:, 0], cut[:, 1] - cut[:, 0], plain


def restore_batch(raw: np.ndarray, off: np.ndarray, forms: np.ndarray, sentinels: list[bytes]) -> PieceTable:
    """The table of the texts from which outputs of the given forms were made."""
    table = PieceTable.of_texts(raw, off)
    found = [find(raw, off, s) for s in sentinels]
    made = np.flatnonzero(forms != PLAIN)
    places = np.zeros((len(forms), 6), np.int64)
    for (at, doc), s, mark in zip(found, sentinels, (MARK_P, MARK_S, MARK_M)):
        at, doc = at[forms[doc] != PLAIN], doc[forms[doc] != PLAIN]
        if not np.array_equal(doc, made):
            raise ValueError(f"an output doesn't hold {s!r} exactly once")
        for form, order in ARRANGEMENTS.items():
            mine = forms[doc] == form
            where = int(np.flatnonzero(order == mark)[0])
            places[doc[mine], where], places[doc[mine], where + 1] = at[mine], at[mine] + len(s)
    # Each output starts with a sentinel, so its first place is its own start: five cuts make six pieces.
    if (places[made, 0] != off[made]).any() or (np.diff(places[made]) < 0).any():
        raise ValueError("an output's sentinels don't have the order of its form")
    table = table.cut(made, places[made, 1:])
    for form, order in ARRANGEMENTS.items():
        table = table.permute(np.flatnonzero(forms == form), np.argsort(order))
    return table.keep(made, 3)


FORMED = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string")


def transform(docs: DataFrame, seed: str = "1", fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
              sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Each text of ``docs`` (doc_id, text) in its form, with the form, the number
    of code points (n), those of prefix and middle (null if plain) and the
    output's sha256."""
    marks = check_sentinels(sentinels)
    limit_batches(docs.sparkSession)
    schema = docs.sparkSession.createDataFrame([], FORMED).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, off = flat(part.column("text"))
                table, n, forms, prefix, middle, plain = form_batch(
                    part.column("doc_id").to_pylist(), raw, off, marks, seed, fim_percent, spm_percent)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms.tolist(), pa.string()),
                    pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain),
                    table.written().cast(pa.string()), pa.array(table.hashes(), pa.string())], schema.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def restore(formed: DataFrame, with_text: bool = True, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """The columns of ``formed`` except its output, with the text that the output
    and the form give back (``text``, unless left out) and its sha256."""
    marks = check_sentinels(sentinels)
    limit_batches(formed.sparkSession)
    rest = [c for c in formed.columns if c not in ("output", "text", "restored_sha256")]
    schema = formed.select(*rest, F.lit("").alias("text"), F.lit("").alias("restored_sha256")).schema
    names = [n for n in schema.names if with_text or n != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "output"):
                raw, off = flat(part.column("output"))
                table = restore_batch(raw, off, np.array(part.column("form").to_pylist(), object), marks)
                made = {"text": lambda: table.written().cast(pa.string()), "restored_sha256": lambda: pa.array(table.hashes(), pa.string())}
                yield pa.RecordBatch.from_arrays([made[c]() if c in made else part.column(c) for c in names], names)

    return formed.select(*rest, "output").mapInArrow(run, type(schema)([schema[n] for n in names]))
