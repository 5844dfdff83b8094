"""Byte-level BPE encoding and decoding by a file of ranks.

The tokenizers library works on strings, the ranks on bytes: each byte stands
for one printable character (the byte-to-character table), the ranks become a
vocabulary of such strings, and every way to put a token together from two
others is a merge with the token's rank. A match that is itself a token is
taken whole. The library then gives, over Arrow batches, the ids that the rank
file defines, and the place of each id in the text.

Decoding reverses the table: an id is its bytes again. A character may be split
over several ids, so bytes are joined for the whole document before they are
read as UTF-8; what still isn't UTF-8 (ids that were cut from their document)
becomes U+FFFD in ``text`` and stays as it is in ``bytes``.

Defined results: a null or empty text has no ids and decodes to nothing. Extra
columns stay; a column of the input that is named like an output is replaced.
Null ids decode to nothing; ids outside the vocabulary are an error.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from .pieces import PieceEncoder
from .textcols import flat, gather, limit_batches, slices

RANKS = "byte_bpe_multi_50k.tiktoken"


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is printable in
    Latin-1, else the next free one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in printable}
    for b in range(256):
        if b not in out:
            out[b] = chr(0x100 + len(out) - len(printable))
    return [out[b] for b in range(256)]


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}


def build_tokenizer(ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
    """A ``tokenizers.Tokenizer`` with the ids of the ranks."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    chars = byte_characters()
    name = {token: "".join([chars[b] for b in token]) for token in ranks}
    merges = []
    for token, _ in sorted(ranks.items(), key=lambda x: x[1]):
        for i in range(1, len(token)):
            if token[:i] in name and token[i:] in name:
                merges.append((name[token[:i]], name[token[i:]]))
    model = models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer


def byte_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, and where each id's begin and how many there are."""
    n = max(ranks.values(), default=-1) + 1
    size = np.zeros(n, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    start = np.cumsum(size) - size
    data = np.zeros(int(size.sum()), np.uint8)
    for token, rank in ranks.items():
        data[start[rank]:start[rank] + len(token)] = np.frombuffer(token, np.uint8)
    return data, start, size


_READY: dict = {}


def _once(key, make):
    """One tokenizer or table for each Python worker, not one for each batch."""
    if key not in _READY:
        _READY.clear() if len(_READY) > 8 else None
        _READY[key] = make()
    return _READY[key]


def _extended(df: DataFrame, added: list[T.StructField]) -> tuple[list[str], T.StructType]:
    taken = {f.name.lower() for f in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    return [f.name for f in kept], T.StructType(kept + added)


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of ``values`` as one binary each."""
    values = np.ascontiguousarray(values)
    ends = np.r_[0, np.cumsum(counts)] * values.itemsize
    if ends[-1] >= 2**31 - 1:
        raise ValueError("one batch of ids passes 2 GB")
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)),
                                                                  pa.py_buffer(values)])


def encode(df: DataFrame, text: str = "text", ranks_path: str | None = None, offsets: bool = False) -> DataFrame:
    """``df`` with n_tokens (long) and ids (binary: little-endian unsigned
    32-bit integers); with ``offsets`` also token_starts and token_ends
    (characters of the text, an array of one entry for each id)."""
    spark = df.sparkSession
    limit_batches(spark)
    path = ranks_path or public_tokenizers.path(RANKS)
    with open(path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    if offsets:
        added += [T.StructField(x, T.ArrayType(T.IntegerType())) for x in ("token_starts", "token_ends")]
    names, schema = _extended(df, added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _once(("encode", path, offsets), lambda: PieceEncoder(
            build_tokenizer(read_ranks(content.value)), offsets))
        for batch in batches:
            for part in slices(batch, text):
                found = encoder.encode(*flat(part.column(text)))
                ids, counts = found[:2]
                new = [pa.array(counts, pa.int64()), _binary(ids.astype("<u4"), counts)]
                if offsets:
                    ends = pa.array(np.r_[0, np.cumsum(counts)], pa.int32())
                    new += [pa.ListArray.from_arrays(ends, pa.array(found[2][:, i], pa.int32())) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + new, names + [f.name for f in added])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", ranks_path: str | None = None, with_text: bool = True) -> DataFrame:
    """``df`` with bytes (binary, what the ids stand for), and with
    ``with_text`` also decoded_text (string)."""
    spark = df.sparkSession
    limit_batches(spark)
    path = ranks_path or public_tokenizers.path(RANKS)
    with open(path, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())
    added = [T.StructField("bytes", T.BinaryType())]
    if with_text:
        added.append(T.StructField("decoded_text", T.StringType()))
    names, schema = _extended(df, added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, start, size = _once(("decode", path), lambda: byte_table(read_ranks(content.value)))
        for batch in batches:
            for part in slices(batch, ids):
                raw, off = flat(part.column(ids))
                token = raw.view("<u4").astype(np.int64) if len(raw) else np.zeros(0, np.int64)
                if len(token) and (token.max() >= len(size) or not size[token].all()):
                    raise ValueError("ids outside the vocabulary")
                total = np.r_[0, np.cumsum(size[token])]
                new = [_binary(gather(data, start[token], size[token]), np.diff(total[off // 4]))]
                if with_text:
                    new.append(pa.array([b.as_py().decode("utf-8", "replace") for b in new[0]], pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(n) for n in names] + new, names + [f.name for f in added])

    return df.mapInArrow(run, schema)
