"""Removal of long repeated byte strings, by interval expansion on a
Burrows-Wheeler transform.

Every byte that lies in a string of ``LENGTH`` (400) bytes that also starts
anywhere else, in any document, is removed. Strings are judged on the input.

1. Anchors. In each window of 400 bytes the first position whose 128 bytes have
   the smallest hash is its anchor; equal windows have it at the same place. An
   anchor's segment is all that the windows hold whose anchor it is: up to 272
   bytes before and 400 after its position. Only anchors whose 128 bytes occur twice
   in the corpus go on (a count with map-side combine), and equal segments count
   as one with a number of occurrences, so copies don't pile up anywhere.
2. What follows an anchor is sorted, dealt by ranges of the bytes themselves, and
   so is what precedes it, read backward: the longest prefix that a string shares
   with any other is the one it shares with a neighbour. A segment is trimmed to
   these extents; no repeated window reaches beyond them. Segments too short for
   a window go, and those that have become equal count as one: a passage that
   many documents hold in different surroundings is one segment now.
3. Segments of an anchor value meet in one task, many values in each. A segment
   is read as 42 blocks of 16 bytes; being aligned at the anchor, equal windows
   have equal blocks at equal places, 24 whole ones at least. The blocks of all
   segments form one string, with a mark of its own after each segment. Its
   suffixes, sorted, give the Burrows-Wheeler transform; then common prefixes of
   neighbours are derived by increasing value: where a value is ``n`` between two
   occurrences of a symbol, one step of backward extension gives ``n + 1`` where
   the symbol leads. The expansion stops at 24 blocks: what has no value by then
   shares 24 blocks or more with its neighbour.
4. The windows around these runs, up to 15 bytes beyond a whole block, are
   checked byte by byte by a rolling hash, so the result is exact.
5. An anchor value that still has more than ``GROUP`` different segments is not
   gathered: its windows are counted by their hash, with map-side combine, over
   all tasks.
6. Found intervals go back to all places of their segments and are united for
   each document.

Hashes have 64 bits, and segments 128; different strings are taken for equal
with a probability of about 2**-64 for each pair that is compared.

Defined results: a null text is empty; documents shorter than 400 bytes lose
nothing. Rows that repeat a document repeat its strings, so both lose them.
A null doc_id is a value like any other. Extra columns are ignored, input
columns named like outputs too. An empty table has no result.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_path
from .textcols import _BASE, _BYTE, U64, flat, groups, limit_batches, mix, powers, slices

LENGTH = 400
GRAM = 128
WINDOWS = LENGTH - GRAM + 1
BLOCK = 16
BEFORE = LENGTH - GRAM  # bytes of a segment before its anchor
COLUMNS = (BEFORE + LENGTH) // BLOCK
CORE = LENGTH // BLOCK - 1  # whole blocks in any window
GROUP = 4096
#: Bytes of a long document that are hashed at once.
CHUNK = 1 << 20
#: Segments in one transform.
BATCH = 4096

#: Low bits of a hash that give way to its place in a chunk.
_PLACE = U64((1 << 21) - 1)

_POW = powers(CHUNK + 4 * LENGTH)
_INV = powers(CHUNK + 4 * LENGTH, pow(_BASE, -1, 2**64))


def _sums(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + 1, U64)
    np.cumsum(_BYTE[raw] * _POW[:len(raw)], out=out[1:])
    return out


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` (minimum or maximum) of each ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    if have < width:
        values = best(values[:len(values) - (width - have)], values[width - have:])
    return values


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash of its 128 bytes, hash of its segment, bytes before and
    after the position in the segment) of all anchors of one text.

    Windows that begin one after the other mostly share their anchor; those
    that do are one row. (A long text is hashed in chunks, whose border may cut
    such a row in two.)"""
    found: list[tuple] = []
    last = len(raw) - LENGTH
    for begin in range(0, max(last + 1, 0), CHUNK):
        windows = min(CHUNK, last + 1 - begin)
        sums = _sums(raw[begin:begin + windows + LENGTH - 1])
        grams = windows + WINDOWS - 1
        g = mix((sums[GRAM:GRAM + grams] - sums[:grams]) * _INV[:grams])
        # The place in the low bits: the smallest number has the leftmost place of the smallest hash.
        owner = (_sliding((g & ~_PLACE) | np.arange(grams, dtype=U64), WINDOWS, np.minimum) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        beyond = np.r_[first[1:], windows] - 1 + LENGTH
        at = owner[first]
        whole = mix((sums[beyond] - sums[first]) * _INV[first] + U64(7))
        before, after = at - first, beyond - at
        segment = mix(whole + before.astype(U64) * U64(1024) + after.astype(U64))
        found.append((at + begin, g[at].astype(np.int64), segment.astype(np.int64), before, after))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    return tuple(np.concatenate(c) for c in zip(*found))


def transform(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, Burrows-Wheeler transform) of a string of numbers; suffixes
    are sorted by their first ``depth`` symbols at least, which fixes all common
    prefixes below that."""
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    n, have = len(rank), 1
    while have < depth:
        key = rank * (n + 1)
        key[:n - have] += rank[have:] + 1
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        have *= 2
    order = np.argsort(rank, kind="stable")
    return order, symbols[order - 1]


def common_prefixes(bwt: np.ndarray, least: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it, in
    suffix order, derived by increasing value; ``least`` where it is that or more."""
    n = len(bwt)
    leads_from = np.argsort(bwt, kind="stable")  # the row whose symbol leads to each row
    same = np.zeros(n, bool)
    same[1:] = bwt[leads_from[1:]] == bwt[leads_from[:-1]]
    value = np.full(n, least, np.int64)
    value[~same] = 0
    open_ = np.flatnonzero(same)
    here, before = leads_from[open_], leads_from[open_ - 1]
    new = np.flatnonzero(~same)
    for length in range(1, least):
        edges = np.zeros(n, np.int64)
        edges[new] = 1
        edges = np.cumsum(edges)
        # A boundary found in the last step lies between two rows with one symbol:
        # its interval, extended backward by that symbol, ends where the symbol leads.
        hit = edges[here] > edges[before]
        new = open_[hit]
        if not len(new):
            break
        value[new] = length
        open_, here, before = open_[~hit], here[~hit], before[~hit]
    return value


def repeated_windows(key: np.ndarray, left: np.ndarray, right: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, start) of every window that occurs in two segments of a key.

    ``data`` has a row of COLUMNS * BLOCK bytes for each segment, with its anchor
    at BEFORE; bytes beyond ``left`` and ``right`` of the anchor don't exist."""
    n = len(key)
    words = data.reshape(n * COLUMNS, BLOCK).view(np.uint64).reshape(n, COLUMNS, BLOCK // 8)
    column = np.arange(COLUMNS)
    symbol = mix(mix(words[:, :, 0] + U64(1)) * U64(3) + words[:, :, 1])
    symbol = mix(symbol + mix(key.astype(U64))[:, None] + (column.astype(U64) * U64(_BASE))[None, :])
    missing = (column * BLOCK < (BEFORE - left)[:, None]) | ((column + 1) * BLOCK > (BEFORE + right)[:, None])
    # Blocks that aren't whole, and the marks after segments, equal nothing.
    text = np.empty((n, COLUMNS + 1), U64)
    text[:, :COLUMNS] = symbol
    text[:, COLUMNS] = 0
    text = np.unique(text.ravel(), return_inverse=True)[1].astype(np.int64)
    single = np.c_[missing, np.ones(n, bool)].ravel()
    text[single] = text.max() + 1 + np.arange(int(single.sum()))
    order, bwt = transform(text, CORE)
    shared = common_prefixes(bwt, CORE) >= CORE
    run = np.cumsum(~shared)
    size = np.bincount(run)
    some = size[run] > 1
    row, block = np.divmod(order[some], COLUMNS + 1)
    run = run[some]
    sums = np.zeros((n, COLUMNS * BLOCK + 1), U64)
    np.cumsum(_BYTE[data] * _POW[:data.shape[1]], axis=1, out=sums[:, 1:])
    rows, starts = [], []
    for beyond in range(BLOCK):
        start = block * BLOCK - beyond
        ok = (start >= BEFORE - left[row]) & (start + LENGTH <= BEFORE + right[row])
        r, s, c = row[ok], start[ok], run[ok]
        if not len(r):
            continue
        window = mix(sums[r, s + LENGTH] - sums[r, s] + mix(c.astype(U64)))
        ordered = np.sort(window)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            hit = twice[np.minimum(np.searchsorted(twice, window), len(twice) - 1)] == window
            rows.append(r[hit])
            starts.append(s[hit])
    if not rows:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate(rows), np.concatenate(starts)


def united(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as ascending maximal intervals."""
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    new = np.r_[True, starts[1:] > ends[:-1]]
    return starts[new], ends[np.r_[np.flatnonzero(new)[1:] - 1, len(ends) - 1]]


CUT = "gram long, segment long, number long, left binary, right binary"
COVER = "gram long, trimmed long, first int, beyond int"


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _anchor_table(docs: DataFrame) -> DataFrame:
    names = ["doc_id", "text_key", "at", "gram", "segment", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, off = flat(part.column("text"))
                found = [anchors(raw[a:b]) for a, b in zip(off[:-1], off[1:])]
                sizes = np.array([len(f[0]) for f in found])
                owner = pa.array(np.repeat(np.arange(len(found)), sizes))
                at, gram, segment, before, after = (np.concatenate([f[i] for f in found]) for i in range(5))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(owner), part.column("text_key").take(owner), pa.array(at, pa.int64()),
                    pa.array(gram, pa.int64()), pa.array(segment, pa.int64()),
                    pa.array(before, pa.int32()), pa.array(after, pa.int32())], names)

    return docs.mapInArrow(run, "doc_id long, text_key long, at long, gram long, segment long, before int, after int")


def _cut_segments(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """One occurrence of each wanted segment (gram, segment, number, place), as
    the bytes from its anchor on and, backward, the bytes before it. Rows that
    repeat a document may give a segment twice; it then has a number above one."""
    lists = wanted.groupBy("place.doc_id", "place.text_key").agg(
        F.collect_list(F.struct("place.at", "gram", "segment", "number", "before", "after")).alias("cuts"))
    lists = lists.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "cuts")
    joined = docs.join(lists, docs["doc_id"].eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))) \
        .select("text", "cuts")
    names = ["gram", "segment", "number", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, off = flat(part.column("text"))
                cuts = part.column("cuts")
                each = cuts.flatten()
                if not len(each):
                    continue
                of = np.repeat(np.arange(len(cuts)), np.diff(cuts.offsets.to_numpy()))
                at = each.field("at").to_numpy() + off[of]
                before, after = each.field("before").to_numpy(), each.field("after").to_numpy()
                for lo in range(0, len(at), BATCH):
                    hi = min(lo + BATCH, len(at))
                    left = [raw[a - b:a][::-1].tobytes() for a, b in zip(at[lo:hi], before[lo:hi])]
                    right = [raw[a:a + c].tobytes() for a, c in zip(at[lo:hi], after[lo:hi])]
                    yield pa.RecordBatch.from_arrays(
                        [each.field(n).slice(lo, hi - lo) for n in names[:3]]
                        + [pa.array(left, pa.binary()), pa.array(right, pa.binary())], names)

    return joined.mapInArrow(run, CUT)


def _table(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(a row of ``width`` bytes for each string, zeros at its end; sizes)."""
    raw, off = flat(column)
    size = np.diff(off)
    out = np.zeros((len(size), width), np.uint8)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(raw)) - np.repeat(off[:-1], size)] = raw
    return out, size


def _shared(a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each two rows, ``most`` at most."""
    differ = a != b
    return np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1]), most)


def _neighbours(cut: DataFrame, side: str) -> DataFrame:
    """(gram, segment, side, common): the most bytes that a string shares with
    another one of its anchor value, from a sort over all of them.

    The sort is dealt by ranges of (gram, string, segment), so that no value is
    too frequent for a task. A range's first and last string come to the driver
    (two for each task), which compares them with those of the next range."""
    spark = cut.sparkSession
    order = ["gram", "string", "segment"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = cut.select("gram", F.col(side).alias("string"), "segment").repartitionByRange(n, *order).sortWithinPartitions(*order)
    names = ["gram", "segment", "common", "part", "edge", "string"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None  # the last row so far, and what it shares with the one before
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, segment = batch.column("gram").to_numpy(), batch.column("segment").to_numpy()
            text, size = _table(batch.column("string"), LENGTH)
            first = held is None
            if held is not None:
                gram, segment = np.r_[held[0], gram], np.r_[held[1], segment]
                text, size = np.concatenate([held[2], text]), np.r_[held[3], size]
            common = np.where(gram[1:] == gram[:-1], _shared(text[1:], text[:-1], np.minimum(size[1:], size[:-1])), 0)
            up = np.r_[0 if first else held[4], common]
            best = np.maximum(up[:-1], common)
            held = gram[-1:], segment[-1:], text[-1:], size[-1:], int(up[-1])
            if not len(best) and not first:
                continue
            edge = np.zeros(len(best), np.int32)
            string: list = [None] * len(best)
            if first:
                # The range's first row is also given by itself, with its string.
                best, edge = np.r_[up[0], best], np.r_[1, edge]
                gram, segment = np.r_[gram[0], gram], np.r_[segment[0], segment]
                string = [text[0, :size[0]].tobytes()] + string
            columns = gram[:len(best)], segment[:len(best)], best, np.full(len(best), part), edge, string
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
        if held is not None:
            last = held[0], held[1], [held[4]], [part], [2], [held[2][0, :held[3][0]].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(last, kinds)], names)

    found = _stored(rows.mapInArrow(run, "gram long, segment long, common int, part int, edge int, string binary"), side)
    edges = sorted(found.where("edge > 0").collect(), key=lambda r: (r.part, r.edge))
    borders = []
    for a, b in zip(edges[1::2], edges[2::2]):  # the last of a range, the first of the next
        if a.gram == b.gram:
            most = min(len(a.string), len(b.string))
            n = next((i for i in range(most) if a.string[i] != b.string[i]), most)
            borders += [(a.gram, a.segment, n), (b.gram, b.segment, n)]
    more = spark.createDataFrame(borders, "gram long, segment long, common int")
    return found.select("gram", "segment", "common").unionByName(more).withColumn("side", F.lit(side))


def _trim(cut: DataFrame) -> DataFrame:
    """(gram, segment, number, trimmed, left, right): segments that may hold a
    repeated window, cut to what they share; ``trimmed`` names equal ones."""
    shared = _neighbours(cut, "left").unionByName(_neighbours(cut, "right")).groupBy("gram", "segment").agg(
        F.max(F.when(F.col("side") == "left", F.col("common"))).alias("before"),
        F.max(F.when(F.col("side") == "right", F.col("common"))).alias("after"))
    # A segment that occurs twice shares all of itself.
    many = F.col("number") > 1
    rows = cut.join(shared, ["gram", "segment"]).select(
        "gram", "segment", "number", "left", "right",
        F.when(many, F.octet_length("left")).otherwise(F.col("before")).alias("before"),
        F.when(many, F.octet_length("right")).otherwise(F.col("after")).alias("after"))
    rows = rows.where(F.col("before") + F.col("after") >= LENGTH)
    left = F.substring("left", F.lit(1), F.col("before"))
    right = F.substring("right", F.lit(1), F.col("after"))
    return rows.select("gram", "segment", "number", F.xxhash64("before", left, right).alias("trimmed"),
                       left.alias("left"), right.alias("right"))


def _matrix(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row of bytes for each segment with its anchor at BEFORE, bytes before, bytes after)."""
    a, before = _table(left, BEFORE)
    b, after = _table(right, LENGTH)
    return np.concatenate([a[:, ::-1], b], axis=1), before, after


def _covers(segments: DataFrame) -> DataFrame:
    """Covered intervals (relative to the anchor) of segments, by the transform."""
    names = ["gram", "trimmed", "first", "beyond"]

    def found(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables(held).combine_chunks()
        gram, trimmed, left, right = (rows.column(c).combine_chunks() for c in ("gram", "trimmed", "left", "right"))
        data, before, after = _matrix(left, right)
        r, s = repeated_windows(gram.to_numpy(), before, after, data)
        if not len(r):
            return
        # Rows one after the other: intervals of different rows never touch.
        step = 4 * COLUMNS * BLOCK
        first, beyond = united(r * step + s, r * step + s + LENGTH)
        row = first // step
        yield pa.RecordBatch.from_arrays([
            gram.take(pa.array(row)), trimmed.take(pa.array(row)),
            pa.array(first - row * step - BEFORE, pa.int32()), pa.array(beyond - row * step - BEFORE, pa.int32())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for group in groups(batches, ["gram"]):
            if group.num_rows < 2:
                continue
            if held and n + group.num_rows > BATCH:
                yield from found(held)
                held, n = [], 0
            held.append(group)
            n += group.num_rows
        if held:
            yield from found(held)

    return segments.select("gram", "trimmed", "left", "right").repartition("gram").sortWithinPartitions("gram") \
        .mapInArrow(run, COVER)


def _covers_of_large(segments: DataFrame) -> DataFrame:
    """The same for anchor values with too many segments for one task: windows
    are counted by their hash."""
    names = ["gram", "trimmed", "first", "window"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, before, after = _matrix(batch.column("left"), batch.column("right"))
            sums = np.zeros((len(data), COLUMNS * BLOCK + 1), U64)
            np.cumsum(_BYTE[data] * _POW[:data.shape[1]], axis=1, out=sums[:, 1:])
            start = np.arange(BEFORE + 1)
            row, start = np.nonzero((start >= (BEFORE - before)[:, None]) & (start + LENGTH <= (BEFORE + after)[:, None]))
            for lo in range(0, len(row), 1 << 16):
                r, s = row[lo:lo + (1 << 16)], start[lo:lo + (1 << 16)]
                window = mix(sums[r, s + LENGTH] - sums[r, s]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column("gram").take(pa.array(r)), batch.column("trimmed").take(pa.array(r)),
                    pa.array(s - BEFORE, pa.int32()), pa.array(window, pa.int64())], names)

    windows = segments.select("gram", "trimmed", "left", "right") \
        .mapInArrow(run, "gram long, trimmed long, first int, window long")
    twice = windows.groupBy("gram", "first", "window").count().where("count > 1").drop("count")
    return windows.join(twice, ["gram", "first", "window"], "left_semi") \
        .select("gram", "trimmed", "first", (F.col("first") + LENGTH).alias("beyond"))


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans) of the documents that lose bytes: spans are
    (first, beyond) byte places, as found, which may overlap."""
    found = _stored(_anchor_table(docs.where(F.octet_length("text") >= LENGTH)), "anchors")
    # Stored, the counts are a plain side of a join, of which Spark can split a frequent value.
    often = _stored(found.groupBy("gram").count().where("count > 1").select("gram"), "repeated-grams")
    some = _stored(found.join(often, "gram", "left_semi"), "repeated-anchors")
    distinct = _stored(some.groupBy("gram", "segment").agg(
        F.count("*").alias("number"), F.min(F.struct("doc_id", "text_key", "at")).alias("place"),
        F.min("before").alias("before"), F.min("after").alias("after")), "segments")
    kinds = _stored(distinct.groupBy("gram").agg(F.count("*").alias("kinds")), "kinds")
    # The only segment of its anchor value occurs twice: it is covered as a whole.
    whole = distinct.join(kinds.where("kinds = 1"), "gram", "left_semi").where(f"before + after >= {LENGTH}") \
        .select("gram", "segment", (-F.col("before")).alias("first"), F.col("after").alias("beyond"))
    cut = _stored(_cut_segments(distinct.join(kinds.where("kinds > 1"), "gram", "left_semi"), docs), "segment-bytes")
    trimmed = _stored(_trim(cut), "trimmed-segments")
    merged = _stored(trimmed.groupBy("gram", "trimmed").agg(
        F.sum("number").alias("number"), F.first("left").alias("left"), F.first("right").alias("right")), "merged-segments")
    twice = merged.where("number > 1").select("gram", "trimmed", (-F.octet_length("left")).alias("first"),
                                              F.octet_length("right").alias("beyond"))
    left = _stored(merged.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds-left")
    small = merged.join(left.where(f"kinds <= {GROUP}"), "gram", "left_semi")
    large = merged.join(left.where(f"kinds > {GROUP}"), "gram", "left_semi")
    covers = twice.unionByName(_covers(small)).unionByName(_covers_of_large(large))
    # A row that repeats m times gives each of its segments m times: once is enough here.
    covers = trimmed.select("gram", "segment", "trimmed").distinct().join(covers, ["gram", "trimmed"]) \
        .select("gram", "segment", "first", "beyond").distinct()
    covers = _stored(whole.unionByName(covers), "covers")
    placed = some.join(covers, ["gram", "segment"]).select(
        "doc_id", "text_key", F.struct((F.col("at") + F.col("first")).alias("first"),
                                       (F.col("at") + F.col("beyond")).alias("beyond")).alias("span"))
    return placed.groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans"))


def remove(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept: binary) for each
    row of ``docs`` (doc_id, text)."""
    limit_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    spans = repeated(docs).select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "spans")
    long = F.octet_length("text") >= LENGTH
    none = F.lit(None).cast("array<struct<first:long,beyond:long>>")
    # Short documents meet no spans, so they aren't shuffled.
    judged = docs.where(long).join(
        spans, docs["doc_id"].eqNullSafe(F.col("d")) & (docs["text_key"] == F.col("t")), "left").select("doc_id", "text", "spans") \
        .unionByName(docs.where(~long).select("doc_id", "text", none.alias("spans")))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, off = flat(part.column("text"))
                spans_ = part.column("spans")
                rows = []
                for i, (a, b) in enumerate(zip(off[:-1], off[1:])):
                    text, removed, runs = raw[a:b], 0, 0
                    if spans_[i].is_valid and len(spans_[i].values):
                        v = spans_[i].values
                        first, beyond = united(v.field("first").to_numpy(), v.field("beyond").to_numpy())
                        removed, runs = int((beyond - first).sum()), len(first)
                        edges = np.r_[0, np.c_[first, beyond].ravel(), len(text)]
                        text = np.concatenate([text[p:q] for p, q in zip(edges[0::2], edges[1::2])])
                    kept = text.tobytes()
                    rows.append((int(b - a), removed, runs, hashlib.sha256(kept).hexdigest(), kept)[:len(names) - 1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]], names)

    return judged.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                             + ", kept binary" * with_text)
