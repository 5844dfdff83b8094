"""Encoding Arrow batches with the tokenizers library, each distinct piece once.

A text is cut only where the tokenizer's own pre-tokenization always cuts:

* before a blank or newline that follows a visible ASCII character or a
  letter of the range U+00C0-U+00FF, and
* before a punctuation mark that follows such a letter.

No pattern of the supported vocabularies matches across these places, no
lookahead reaches over them to the left, and Unicode composition never joins a
blank or a mark of this kind to what stands before. So the ids of a text are
the ids of its pieces, one after the other. Other places are not cut; a longer
piece is always right. Pieces repeat as words do, so the library encodes each
distinct piece once while it stays in a cache of bounded size.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

from .textcols import gather, lower_ascii

#: Pieces that an encoder holds unless told otherwise (about 220 bytes each), and ids for each.
CACHE_PIECES = 150_000
IDS_A_PIECE = 16
_AT_ONCE = 4096

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,!?;:*%&$#|"]] = True


def cuts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Ascending byte positions at which pieces begin, and the end."""
    n = len(raw)
    flags = np.zeros(n + 1, bool)
    if n > 1:
        before, here = raw[:-1], raw[1:]
        latin = np.zeros(n - 1, bool)  # the second byte of U+00C0-U+00FF
        latin[1:] = raw[:-2] == 0xC3
        latin &= before >= 0x80
        letter = latin & (before != 0x97) & (before != 0xB7)  # not the signs for times and divided by
        flags[1:n] = (_BLANK[here] & (_VISIBLE[before] | latin)) | (_MARK[here] & (_LETTER[before] | letter))
    flags[off] = True
    return np.flatnonzero(flags)


class PieceEncoder:
    """ids (and offsets) of batches of texts, by a ``tokenizers.Tokenizer``.

    ``blank_free``: the tokenizer drops white space, so new pieces can be encoded
    as the lines of one text, which takes the library half the time.
    ``folds_case``: it composes characters and then lowers their case, so A-Z may
    be lowered first, unless a combining mark (U+0300-U+036F) may follow them.
    ``cache_pieces``: bound of the cache; a larger one encodes rare pieces less often.
    """

    def __init__(self, tokenizer, offsets: bool = False, blank_free: bool = False, folds_case: bool = False,
                 cache_pieces: int = CACHE_PIECES):
        self.cache_pieces, self.cache_ids = cache_pieces, cache_pieces * IDS_A_PIECE
        self.tokenizer = tokenizer
        self.with_offsets = offsets
        self.blank_free = blank_free
        self.folds_case = folds_case
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.seen = np.zeros(1024, np.int32)  # batches that had the piece
        self.ids = np.zeros(8192, np.int32)
        self.spans = np.zeros((8192, 2), np.int32) if self.with_offsets else None
        self.used = 0

    def _shrink(self) -> None:
        """Keep the pieces that came back, if they fit in half of the cache."""
        kept = [(p, i) for p, i in self.index.items() if self.seen[i] > 1]
        rows = np.array([i for _, i in kept], np.int64)
        size, start, ids, spans = self.size, self.start, self.ids, self.spans
        self._clear()
        if not len(rows) or len(rows) > self.cache_pieces // 2 or size[rows].sum() > self.cache_ids // 2:
            return
        places = gather(np.arange(len(ids)), start[rows], size[rows])
        self._room(len(rows), len(places))
        self.ids[:len(places)] = ids[places]
        if spans is not None:
            self.spans[:len(places)] = spans[places]
        self.size[:len(rows)] = size[rows]
        self.start[:len(rows)] = np.cumsum(size[rows]) - size[rows]
        self.index = dict(zip((p for p, _ in kept), range(len(rows))))
        self.used = len(places)

    def _room(self, pieces: int, ids: int) -> None:
        if pieces > len(self.start):
            grown = max(pieces, 2 * len(self.start))
            self.start = np.resize(self.start, grown)
            self.size = np.resize(self.size, grown)
            self.seen = np.resize(self.seen, grown)
        if ids > len(self.ids):
            grown = max(ids, 2 * len(self.ids))
            self.ids = np.resize(self.ids, grown)
            if self.spans is not None:
                self.spans = np.resize(self.spans, (grown, 2))

    def _encoded(self, part: list[str]) -> tuple[np.ndarray, np.ndarray, list]:
        """(ids, the piece of each id, offsets in the piece)."""
        if not self.blank_free or any("\n" in p[1:] for p in part):
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            return np.asarray(found.ids, np.int32), np.asarray(found.word_ids, np.int64), found.offsets
        found = self.tokenizer.encode("\n".join(part), add_special_tokens=False)
        begins = np.cumsum([0] + [len(p) + 1 for p in part[:-1]])
        places = np.asarray(found.offsets, np.int64).reshape(-1, 2)
        piece = np.searchsorted(begins, places[:, 0], side="right") - 1
        return np.asarray(found.ids, np.int32), piece, places - begins[piece][:, None]

    def _add(self, pieces: list[bytes]) -> None:
        for at in range(0, len(pieces), _AT_ONCE):
            part = pieces[at:at + _AT_ONCE]
            ids, piece, places = self._encoded([p.decode("utf-8", "replace") for p in part])
            size = np.bincount(piece, minlength=len(part)) if len(ids) else np.zeros(len(part), np.int64)
            have = len(self.index)
            self._room(have + len(part), self.used + len(ids))
            self.ids[self.used:self.used + len(ids)] = ids
            if self.spans is not None and len(ids):
                self.spans[self.used:self.used + len(ids)] = places
            self.size[have:have + len(part)] = size
            self.seen[have:have + len(part)] = 0
            self.start[have:have + len(part)] = self.used + np.cumsum(size) - size
            self.index.update(zip(part, range(have, have + len(part))))
            self.used += len(ids)

    def encode(self, raw: np.ndarray, off: np.ndarray):
        """(ids, ids per text), and with offsets also the (start, end) of each
        id in characters of its text; an id that holds a part of a character
        has the place of the whole character."""
        if self.folds_case and not ((raw == 0xCC) | (raw == 0xCD)).any():
            raw = lower_ascii(raw)
        at = cuts(raw, off)
        if len(at) < 2:
            none = np.zeros(0, np.int32)
            counts = np.zeros(len(off) - 1, np.int64)
            return (none, counts, np.zeros((0, 2), np.int64)) if self.with_offsets else (none, counts)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
        ).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        if len(self.index) + len(distinct) > self.cache_pieces or self.used > self.cache_ids:
            self._shrink()
        index = self.index
        self._add([p for p in distinct if p not in index])
        known = np.fromiter(map(index.__getitem__, distinct), np.int64, len(distinct))
        self.seen[known] += 1
        code = known[pieces.indices.to_numpy(zero_copy_only=False)]
        size = self.size[code]
        ids = gather(self.ids, self.start[code], size)
        total = np.r_[0, np.cumsum(size)]
        piece_of_text = np.searchsorted(at, off)
        counts = np.diff(total[piece_of_text])
        if not self.with_offsets:
            return ids, counts
        # Characters before each piece, counted from the start of its text.
        chars = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
        first = np.repeat(chars[off[:-1]], np.diff(piece_of_text))
        shift = np.repeat(chars[at[:-1]] - first, size)
        rows = gather(np.arange(self.used), self.start[code], size)
        return ids, counts, self.spans[rows].astype(np.int64) + shift[:, None]
