"""Token-id files: zstandard frames for each document behind one shared dictionary.

A store is a folder with three Parquet tables, so that any file system Spark
can write holds it and a lost executor costs no more than its tasks:

``shards``      one row for each run of about ``SHARD_BYTES`` of frames, in
                ascending doc_id order: part and seq (place in that order),
                first_doc, last_doc, n_docs, n_tokens, before (tokens of the
                part before this shard), id_bytes (2 or 4: width of a stored
                id), dictionary (hash), frames (binary: one zstandard frame
                for each document), and the offset index: doc_ids, frame_ends
                (bytes) and token_counts, one entry for each document.
``parts``       part, start (tokens of all parts before it), n_tokens.
``dictionary``  hash and content of the shared zstandard dictionary.

A document is read by its shard's index: one frame is decompressed, not the
shard. The dictionary is trained on the serialized id arrays of a bounded
sample (``SAMPLE_DOCS`` texts by smallest hash, their whole arrays cut into pieces of
``SAMPLE_PIECE`` bytes, of these the ``SAMPLE_PIECES`` with the smallest hashes,
``SAMPLE_BYTES`` at most), so two runs train the same one; it only affects size.

Defined results: a null text is empty and has the end id only; a null doc_id
comes first; rows with equal doc_id stand side by side in an order that depends
on their texts; repeated rows are stored as often as they occur. An empty table
gives an empty store. Other columns are ignored.
"""
from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import join_path
from .pieces import PieceEncoder
from .textcols import flat, limit_batches, slices

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
LEVEL = 3
SHARD_BYTES = 1 << 20
SHARD_DOCS = 4096
SAMPLE_DOCS = 1000
SAMPLE_PIECE = 8 << 10
SAMPLE_PIECES = 2048
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
#: Pieces that a worker's encoder holds (some 180 MB) and bytes of text in one step.
CACHE_PIECES = 800_000
STEP_BYTES = 2 << 20

SHARDS = ("part int, seq int, first_doc long, last_doc long, n_docs long, n_tokens long, before long, id_bytes int, "
          "dictionary string, frames binary, doc_ids array<long>, frame_ends array<long>, token_counts array<long>")

_READY: dict = {}


def load_tokenizer(content: bytes):
    """The tokenizer of a JSON file; strings of special tokens in a text are ordinary text."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: How a vocabulary of lower-cased words reads text. Runs of white
#: space part words and have no ids, so text may be encoded piece by piece.
WORD_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class TextEncoder:
    """ids of whole texts, for vocabularies that read text in any other way."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = raw.tobytes()
        found = [self.tokenizer.encode(data[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids
                 for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        counts = np.array([len(f) for f in found], np.int64)
        return (np.concatenate([np.asarray(f, np.int32) for f in found]) if len(found) else np.zeros(0, np.int32)), counts


def reads_words(content: bytes) -> bool:
    """Whether a tokenizer file reads text as the pieces need it, by its own settings."""
    settings = json.loads(content)
    return (settings.get("normalizer"), settings.get("pre_tokenizer")) == (WORD_NORMALIZER, WORD_PRE_TOKENIZER)


def _encoder(key: str, content: bytes, cache_pieces: int = CACHE_PIECES) -> PieceEncoder | TextEncoder:
    if key not in _READY:
        tokenizer = load_tokenizer(content)
        _READY[key] = (PieceEncoder(tokenizer, blank_free=True, folds_case=True, cache_pieces=cache_pieces)
                       if reads_words(content) else TextEncoder(tokenizer))
    return _READY[key]


def train_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; with too few samples to train one, their bytes
    serve as a plain prefix, and without any it is empty."""
    import zstandard
    joined = b"".join(samples)
    if len(samples) >= 64 and len(joined) >= 16 * 1024:
        try:
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, len(joined) // 8), samples).as_bytes()
        except zstandard.ZstdError:
            pass
    return joined[-DICTIONARY_BYTES:]


def _dictionary(content: bytes):
    import zstandard
    return zstandard.ZstdCompressionDict(content) if content else None


def _hash(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def _sample(docs: DataFrame, key: str, vocabulary, dtype: str) -> list[bytes]:
    """Serialized ids of the sample: whole id arrays cut into pieces, of which those
    with the smallest hashes come to the driver, SAMPLE_BYTES at most."""
    keys = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("text_key"))
    chosen = keys.distinct().orderBy(F.xxhash64("doc_id", "text_key"), "doc_id", "text_key").limit(SAMPLE_DOCS)
    texts = (docs.withColumn("text_key", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "text_key"])
             .dropDuplicates(["doc_id", "text_key"]).select("doc_id", "text_key", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(key, vocabulary.value)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts = encoder.encode(*flat(part.column("text")))
                ends = np.cumsum(counts)
                rows = []
                for doc, text, n, end in zip(part.column("doc_id").to_pylist(), part.column("text_key").to_pylist(), counts, ends):
                    data = ids[end - n:end].astype(dtype).tobytes()
                    rows += [(doc, text, i, data[i:i + SAMPLE_PIECE]) for i in range(0, len(data), SAMPLE_PIECE)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "text_key", "place", "ids"])

    pieces = texts.mapInArrow(run, "doc_id long, text_key long, place long, ids binary")
    order = [F.xxhash64("doc_id", "text_key", "place"), "doc_id", "text_key", "place"]
    found, size = [], 0
    for r in pieces.orderBy(*order).limit(SAMPLE_PIECES).collect():
        size += len(r.ids)
        if size > SAMPLE_BYTES:
            break
        found.append(bytes(r.ids))
    return found


def write(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID,
          cache_pieces: int = CACHE_PIECES) -> None:
    """Encode every text of ``docs`` (doc_id, text) and write the store at ``path``;
    each worker holds at most about ``cache_pieces`` encoded pieces.

    Texts are dealt by ranges of doc_id before they are encoded (so encoding
    runs once, in the order of the files); shards, not documents, are rows.
    """
    spark = docs.sparkSession
    limit_batches(spark)
    key = tokenizer_path or public_tokenizers.path(VOCABULARY)
    with open(key, "rb") as f:
        content = f.read()
    size = load_tokenizer(content).get_vocab_size()
    id_bytes = 2 if max(size, end_id + 1) <= 1 << 16 else 4
    dtype = f"<u{id_bytes}"
    vocabulary = spark.sparkContext.broadcast(content)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    trained = train_dictionary(_sample(docs, key, vocabulary, dtype))
    name = _hash(trained)
    spark.createDataFrame([(name, bytearray(trained))], "hash string, content binary").coalesce(1) \
        .write.parquet(join_path(path, "dictionary"))
    shared = spark.sparkContext.broadcast(trained)
    schema = spark.createDataFrame([], SHARDS).schema
    arrow = {"doc_ids": pa.list_(pa.int64()), "frame_ends": pa.list_(pa.int64()), "token_counts": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        encoder = _encoder(key, vocabulary.value, cache_pieces)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value), write_content_size=True)
        part = TaskContext.get().partitionId()
        held: list[tuple] = []
        state = {"bytes": 0, "seq": 0, "before": 0}

        def shard() -> pa.RecordBatch:
            ids, frames, counts = ([h[i] for h in held] for i in range(3))
            tokens = sum(counts)
            row = [part, state["seq"], ids[0], ids[-1], len(ids), tokens, state["before"], id_bytes, name,
                   b"".join(frames), ids, np.cumsum([len(x) for x in frames]).tolist(), counts]
            state.update(bytes=0, seq=state["seq"] + 1, before=state["before"] + tokens)
            held.clear()
            kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.string(), pa.binary(), *arrow.values()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], schema.names)

        for batch in batches:
            for piece in slices(batch, "text", STEP_BYTES):
                ids, counts = encoder.encode(*flat(piece.column("text")))
                ends = np.cumsum(counts)
                narrow = ids.astype(dtype)
                for doc, n, end in zip(piece.column("doc_id").to_pylist(), counts.tolist(), ends.tolist()):
                    stored = np.append(narrow[end - n:end], narrow.dtype.type(end_id)).tobytes()
                    held.append((doc, press.compress(stored), n + 1))
                    state["bytes"] += len(held[-1][1])
                    if state["bytes"] >= SHARD_BYTES or len(held) >= SHARD_DOCS:
                        yield shard()
        if held:
            yield shard()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The hash beside doc_id splits a doc_id that many rows share.
    dealt = (docs.withColumn("tie", F.xxhash64("text")).repartitionByRange(n, F.col("doc_id"), F.col("tie"))
             .sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    dealt.mapInArrow(run, schema).write.option("compression", "none").parquet(join_path(path, "shards"))
    totals = spark.read.parquet(join_path(path, "shards")).groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each written file
    (totals.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"), "n_tokens")
     .write.parquet(join_path(path, "parts")))


def _unpack(row: dict, shared: bytes, wanted=None) -> Iterator[tuple]:
    """(doc_id, tokens of the shard before it, id array) of a shard's documents."""
    import zstandard
    if _hash(shared) != row["dictionary"]:
        raise ValueError("the shard was written with another dictionary")
    press = zstandard.ZstdDecompressor(dict_data=_dictionary(shared))
    frames, at, before = memoryview(row["frames"]), 0, 0
    for doc, end, n in zip(row["doc_ids"], row["frame_ends"], row["token_counts"]):
        if wanted is None or doc in wanted:
            ids = np.frombuffer(press.decompress(frames[at:end]), f"<u{row['id_bytes']}")
            if len(ids) != n:
                raise ValueError(f"document {doc}: {len(ids)} ids where the index has {n}")
            yield doc, before, ids
        at, before = end, before + n


def _content(spark: SparkSession, path: str):
    row = spark.read.parquet(join_path(path, "dictionary")).first()
    return spark.sparkContext.broadcast(bytes(row.content))


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids
    (binary, little-endian unsigned 32-bit) of the stored documents; with
    ``doc_ids`` only of these, by the shards' offset indexes."""
    shared = _content(spark, path)
    shards = spark.read.parquet(join_path(path, "shards"))
    wanted = None
    if doc_ids is not None:
        wanted = set(doc_ids)
        hit = F.lit(False)
        for d in sorted(wanted):
            hit = hit | ((F.col("first_doc") <= d) & (F.col("last_doc") >= d))
        shards = shards.where(hit)
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["part", "doc_id", "before", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                out = [(row["part"], doc, row["before"] + before, len(ids), ids.astype("<u4").tobytes())
                       for doc, before, ids in _unpack(row, shared.value, wanted)]
                for at in range(0, len(out), 256):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out[at:at + 256]), kinds)], names)

    limit_batches(spark, 16)  # rows are shards of a megabyte
    found = shards.mapInArrow(run, "part int, doc_id long, before long, n_tokens long, ids binary")
    parts = spark.read.parquet(join_path(path, "parts")).select("part", F.col("start").alias("part_start"))
    return found.join(parts, "part").select("doc_id", (F.col("part_start") + F.col("before")).alias("start"),
                                            "n_tokens", "ids")


def checksums(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of what ``read`` gives."""
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32(ids) -> int:
    """The checksum of one document's ids, as ``checksums`` has it."""
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
