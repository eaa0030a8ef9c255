"""Word splitting and hashing over whole Arrow batches.

A word is a run of bytes outside 0x09-0x0D and 0x20 (``[^\\x20\\x09-\\x0D]+``
of the UTF-8 text). Nulls are read as empty texts. Texts are handled in chunks
of a few MB, never cut; one text longer than that is a chunk of its own.
Hashes are 64-bit and the same in every process.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 21
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE, _LENGTH = 0x9E3779B97F4A7C15, U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=U) * U(_BASE))
_FACTORS = mix(np.arange(1, 65, dtype=U) * U(0xA24BAED4963EE407)) | U(1)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _tables:
        if size > CHUNK_BYTES:  # a giant word: not kept
            return _make(size)
        _tables[size] = _make(size)
    return _tables[size]


def _make(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(size, base, dtype=U)
        p[0] = 1
        out.append(np.cumprod(p, dtype=U))
    return out[0], out[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans are sorted and don't overlap."""
    n, i = len(starts), 0
    out = np.empty(n, dtype=U)
    while i < n:
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")))
        s, e = starts[i:j] - base, ends[i:j] - base
        size = int(e[-1])
        power, inverse = _powers(size)
        total = np.empty(size + 1, dtype=U)
        total[0] = 0
        np.cumsum(_BYTES[data[base:base + size]] * power[:size], out=total[1:])
        h = total[e]
        h -= total[s]
        h *= inverse[s]
        h += (e - s).astype(U) * _LENGTH
        out[i:j] = mix(h)
        i = j
    return out


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data, offsets


def chunks(batches, column: str = "text", size: int = CHUNK_BYTES
           ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) for runs of whole texts of about ``size`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = texts(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
            hi = min(hi, batch.num_rows)
            yield (batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]],
                   offsets[lo:hi + 1] - offsets[lo])
            lo = hi


def find_words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each text's first word
    (one more entry at the end). ``space`` marks the bytes between words."""
    word = ~space[data]
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = word[cuts]
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    stops[last] = word[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets, side="left")


def find_units(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each unit: a word with the white space before it;
    what follows a text's last word is a unit as well."""
    _, ends, first = find_words(data, offsets, space)
    count = np.diff(first)
    tail = np.where(count > 0, ends[np.maximum(first[1:] - 1, 0)] if len(ends) else 0, offsets[:-1])
    more = tail < offsets[1:]
    text = np.concatenate([np.repeat(np.arange(len(count)), count), np.flatnonzero(more)])
    finish = np.concatenate([ends, offsets[1:][more]])
    order = np.argsort(finish, kind="stable")
    text, finish = text[order], finish[order]
    begin = np.zeros_like(finish)
    begin[1:] = finish[:-1]
    new = np.ones(len(text), dtype=bool)
    new[1:] = text[1:] != text[:-1]
    begin[new] = offsets[text[new]]
    return begin, finish, text


def ngrams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` hashes (runs that cross texts included)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    total = np.zeros(n, dtype=U)
    for k in range(width):
        total += hashes[k:k + n] * _FACTORS[k % 64] + U(k // 64)
    return mix(total)


def word_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; a text with fewer words than
    ``width`` has its whole word sequence as its one shingle, one without words
    has none."""
    starts, ends, first = find_words(data, offsets)
    h = hash_spans(data, starts, ends)
    grams = ngrams(h, width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(grams[a:b - width + 1])
        elif b > a:
            yield ngrams(h[a:b], b - a) + U(b - a)
        else:
            yield grams[:0]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``start .. start + length``."""
    total = int(lengths.sum())
    out = np.ones(total, dtype=np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    if not total:
        return out
    out[0] = starts[0]
    at = np.cumsum(lengths)[:-1]
    out[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(out)


class SpanTable:
    """Values of byte spans seen before, by hash: each new span is worked out
    once per process. Starts anew when it holds ``limit`` spans (an open bound
    on memory, not on results)."""

    def __init__(self, make, limit: int = 400_000):
        self.make, self.limit = make, limit
        self._reset()

    def _reset(self) -> None:
        self.keys, self.rows = np.zeros(0, dtype=U), np.zeros(0, dtype=np.int64)
        self.count, self.values = 0, None

    def look_up(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray,
                ends: np.ndarray) -> np.ndarray:
        """Row of each span in ``values``; ``make(list of bytes)`` gives new ones."""
        unique, at, back = np.unique(hashes, return_index=True, return_inverse=True)
        if self.count > self.limit:
            self._reset()
        place = np.minimum(np.searchsorted(self.keys, unique), max(0, len(self.keys) - 1))
        known = self.keys[place] == unique if len(self.keys) else np.zeros(len(unique), bool)
        new = at[~known]
        if len(new):
            raw = data.tobytes()
            made = self.make([raw[s:e] for s, e in zip(starts[new].tolist(), ends[new].tolist())])
            self.values = made if self.values is None else self.join(self.values, made)
            keys = np.concatenate([self.keys, unique[~known]])
            rows = np.concatenate([self.rows, np.arange(self.count, self.count + len(new))])
            order = np.argsort(keys, kind="stable")
            self.keys, self.rows = keys[order], rows[order]
            self.count += len(new)
            place = np.searchsorted(self.keys, unique)
        return self.rows[place][back] if len(unique) else np.zeros(0, dtype=np.int64)

    def join(self, old, new):
        return np.concatenate([old, new])


class IdTable(SpanTable):
    """A table of id lists, kept as one flat array."""

    def join(self, old, new):
        return Ragged(np.concatenate([old.flat, new.flat]),
                      np.concatenate([old.starts, new.starts + len(old.flat)]),
                      np.concatenate([old.lengths, new.lengths]))


class Ragged:
    """Lists of numbers in one flat array."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.flat, self.starts, self.lengths = flat, starts, lengths

    @classmethod
    def of(cls, lists: list) -> "Ragged":
        lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
        flat = np.fromiter((x for one in lists for x in one), dtype=np.uint32, count=int(lengths.sum()))
        return cls(flat, np.cumsum(lengths) - lengths, lengths)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' lists, concatenated, and their lengths."""
        lengths = self.lengths[rows]
        return self.flat[spread(self.starts[rows], lengths)], lengths


def crc32(values: np.ndarray) -> int:
    return zlib.crc32(values.astype("<u4").tobytes())
