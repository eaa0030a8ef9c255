"""Substring dedup: compressed FM-indexes over content shards.

A window is ``size`` consecutive words of one document. A word is removed when
a window over it has a word sequence that also starts in a document with a
smaller doc_id. Every window has an anchor, the smallest hash of its
``ANCHOR``-word runs; equal windows have equal anchors, so segments (runs of
windows with one anchor) are dealt to shards by anchor and each segment is
streamed against one shard only, whatever the corpus size:

1. slim rows (anchor, doc_id, place) of all segments; anchors of one document
   only are dropped before any text is moved;
2. the words of the remaining segments, from the whole texts; equal segments
   are reduced to one with their smallest doc_id before they meet in a shard;
3. per shard a compressed FM-index (BWT sorted to ``size`` words and more; a
   wavelet matrix whose bitmaps do not store words of equal bits; owners' ranks in
   place of a suffix array). Segments are streamed through backward search once:
   the match that starts at a place is carried on to the place before it, extended
   by its word or shortened to its parent interval. Places whose matching
   statistic reaches ``size`` are reported with the interval's smallest doc_id;
4. the reported windows go back to all occurrences of their segment, and each
   document's covered words are removed in one pass over its text.

An anchor with more than ``HOT_ANCHOR`` segments is dealt by single windows
instead, so no anchor or group of copies lands in one shard; the shard count
follows the number of segments.

Defined results: null or empty text, or fewer words than a window: nothing
removed. A null doc_id takes no part (nothing removed, no source). Rows that
repeat a doc_id are judged one by one; rows of the same doc_id are no smaller
documents. Other columns are kept by ``drop_repeats`` (names that begin with __ are
taken). An empty table gives an empty result. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ringcast.llm import words as W
from ringcast.llm.ship import let_go
from ringcast.session import materialize

ANCHOR = 5
RUN = 32            # windows in a segment at most
HOT_ANCHOR = 20_000
SHARD_SEGMENTS = 30_000


def _smallest(grams: np.ndarray, width: int) -> np.ndarray:
    """Sliding minimum over ``width`` entries."""
    have, out = 1, grams
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        k = width - have
        out = np.minimum(out[:len(out) - k], out[k:])
    return out


def _segments(h: np.ndarray, first: np.ndarray, size: int):
    """(anchor, text, place, windows) of each segment of a chunk's texts."""
    n = len(h) - size + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return none.astype(np.uint64), none, none, none
    anchor = min(ANCHOR, size)
    low = _smallest(W.ngrams(h, anchor), size - anchor + 1)[:n]
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    ok = np.flatnonzero(text[:n] == text[size - 1:])
    low, text = low[ok], text[ok]
    if not len(ok):
        return none.astype(np.uint64), none, none, none
    new = np.ones(len(ok), dtype=bool)
    new[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(ok)))
    if lengths.max() > RUN:
        pieces = -(-lengths // RUN)
        part = W.spread(np.zeros(len(pieces), dtype=np.int64), pieces)
        starts = np.repeat(starts, pieces) + part * RUN
        lengths = np.minimum(RUN, np.repeat(lengths, pieces) - part * RUN)
    at = ok[starts]
    return low[starts], text[starts], at - first[text[starts]], lengths


def _slim_rows(docs: DataFrame, size: int) -> DataFrame:
    def rows_of(batches):
        for rows, data, offsets in W.chunks(batches):
            starts, ends, first = W.find_words(data, offsets)
            low, text, place, windows = _segments(W.hash_spans(data, starts, ends), first, size)
            yield pa.record_batch({
                "anchor": pa.array(low.view(np.int64)), "doc_id": rows.column(0).take(pa.array(text)),
                "place": pa.array(place, pa.int32()), "windows": pa.array(windows, pa.int16())})

    return docs.mapInArrow(rows_of, "anchor long, doc_id long, place int, windows short")


def _spots(docs: DataFrame, size: int) -> DataFrame:
    """Segments whose anchor is in two documents or more. Both sides of the join
    read all columns, so that one exchange on the anchor serves them."""
    slim = _slim_rows(docs, size).repartition("anchor")
    stats = slim.groupBy("anchor").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("rows"),
        F.min("place").alias("p"), F.min("windows").alias("w")) \
        .filter("lo < hi and p >= 0 and w > 0") \
        .select("anchor", (F.col("rows") > HOT_ANCHOR).alias("hot"))
    return slim.join(stats, "anchor")


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` as zstd blocks (``__packed``), for a shuffle of a
    third of the bytes."""
    others = [f for f in docs.schema if f.name != "text"]
    schema = T.StructType([*others, T.StructField("__packed", T.BinaryType())])

    def pack(batches):
        codec = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            blobs = [None if t is None else codec.compress(t.encode())
                     for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield pa.record_batch([*(batch.column(f.name) for f in others), pa.array(blobs, pa.binary())],
                                  names=schema.names)

    return docs.mapInArrow(pack, schema)


def _hash_runs(h: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """The runs' hashes concatenated, and a hash of each run."""
    index = W.spread(starts, lengths)
    flat = h[index]
    turn = W.spread(np.zeros(len(lengths), dtype=np.int64), lengths)
    begin = np.cumsum(lengths) - lengths
    total = np.add.reduceat(flat * W._FACTORS[turn % 64], begin) if len(flat) else flat
    return flat, W.mix(total + lengths.astype(np.uint64))


def _unpack(batch):
    codec = zstandard.ZstdDecompressor()
    for i, blob in enumerate(batch.column(batch.schema.get_field_index("__packed")).to_pylist()):
        raw = codec.decompress(blob) if blob is not None else b""
        data = np.frombuffer(raw, dtype=np.uint8)
        starts, ends, _ = W.find_words(data, np.array([0, len(data)]))
        yield i, raw, starts, ends, W.hash_spans(data, starts, ends)


def _with_words(spots: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(part, content, doc_id, place, windows, words) of the spots' segments."""
    lists = spots.groupBy("doc_id").agg(
        F.collect_list(F.struct("anchor", "place", "windows", "hot")).alias("spots"))

    def cut(batches):
        for batch in batches:
            spots = batch.column(2)
            flat, offsets = spots.flatten(), np.asarray(spots.offsets)
            offsets = offsets - offsets[0]
            anchor, place, windows, hot = (flat.field(k).to_numpy(zero_copy_only=False)
                                           for k in range(4))
            doc_id = batch.column(0).to_numpy(zero_copy_only=False)
            out, words = [], []
            for i, _, _, _, h in _unpack(batch):
                own = slice(offsets[i], offsets[i + 1])
                p, n, a, many = place[own].astype(np.int64), windows[own].astype(np.int64), anchor[own], hot[own]
                if many.any():  # single windows
                    times = np.where(many, n, 1)
                    step = W.spread(np.zeros(len(n), dtype=np.int64), times)
                    p, a = np.repeat(p, times) + step, np.repeat(a, times)
                    n, many = np.where(np.repeat(many, times), 1, np.repeat(n, times)), np.repeat(many, times)
                fits = p + n + size - 1 <= len(h)  # else a spot of another row with this doc_id
                p, n, a, many = p[fits], n[fits], a[fits], many[fits]
                if len(p):
                    run, content = _hash_runs(h, p, n + size - 1)
                    content = content.view(np.int64)
                    words.append(run.view(np.int64))
                    out.append((np.where(many, content, a), content, np.full(len(p), doc_id[i]), p, n))
            if out:
                cols = [np.concatenate(x) for x in zip(*out)]
                ends = np.concatenate([[0], np.cumsum(cols[4] + size - 1)])
                yield pa.record_batch({
                    "part": pa.array(cols[0]), "content": pa.array(cols[1]), "doc_id": pa.array(cols[2]),
                    "place": pa.array(cols[3], pa.int32()), "windows": pa.array(cols[4], pa.int16()),
                    "words": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(words)))})

    return lists.join(_packed(docs), "doc_id").select("doc_id", "__packed", "spots").mapInArrow(
        cut, "part long, content long, doc_id long, place int, windows short, words array<long>")


def _top_bit(word: np.ndarray) -> np.ndarray:
    """Place of the highest bit that is set (the bit below it is cleared, so that
    no double rounds up)."""
    return np.frexp((word & ~(word >> np.uint64(1))).astype(np.float64))[1].astype(np.int64) - 1


def _pack_bits(bits: np.ndarray) -> np.ndarray:
    padded = np.zeros(((len(bits) >> 6) + 1) * 64, dtype=np.uint8)
    padded[:len(bits)] = bits
    return np.packbits(padded, bitorder="little").view(np.uint64)


_BIT = np.uint64(1) << np.arange(64, dtype=np.uint64)
_LOW = _BIT - np.uint64(1)  # the bits below each of 64


class Bits:
    """A bitmap with rank. A directory holds the ones before each word. Where half
    the words are of 64 equal bits or more, those are stored once and the directory
    also has the stored words' numbers."""

    FULL = np.uint64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, bits: np.ndarray):
        words = _pack_bits(bits)
        self.before = np.zeros(len(words), dtype=np.int32)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])
        mixed = (words != 0) & (words != self.FULL)
        self.stored, self.number = words, None
        if 2 * int(mixed.sum()) > len(words):
            return
        self.stored = np.concatenate([np.array([0, self.FULL], dtype=np.uint64), words[mixed]])
        self.number = (words == self.FULL).astype(np.int32)
        self.number[mixed] = np.arange(2, len(self.stored), dtype=np.int32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many bits are set before each place."""
        block = at >> 6
        word = self.stored[block if self.number is None else self.number[block]]
        return self.before[block] + np.bitwise_count(word & _LOW[at & 63])


class Borders:
    """For each number of first symbols, the places where sorted suffixes differ in
    them: for a place, the interval of suffixes that share them. ``add`` takes the
    bitmaps in order of that number; their first bit is set."""

    def __init__(self, n: int, depth: int):
        self.n, self.width = n, (n >> 6) + 1
        self.words = np.zeros((depth + 1, self.width), dtype=np.uint64)
        self.last = np.zeros((depth + 1, self.width), dtype=np.int32)
        self.next = np.zeros((depth + 1, self.width + 1), dtype=np.int32)

    def add(self, length: int, bits: np.ndarray) -> None:
        words = self.words[length] = _pack_bits(bits)
        held = np.flatnonzero(words)
        self.last[length] = held[np.searchsorted(held, np.arange(self.width), side="right") - 1]
        self.next[length] = np.append(held, self.width)[np.searchsorted(held, np.arange(self.width + 1))]

    def around(self, length: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last border up to each place, first one after it), each by its number of symbols."""
        block, bit = at >> 6, at & 63
        own = self.words[length, block]
        upto = _LOW[bit] | _BIT[bit]
        word = own & upto
        # the word before: only read where this one has no border up to the place
        before = np.where(word != 0, block, self.last[length, np.maximum(block - 1, 0)])
        word = np.where(word != 0, word, self.words[length, before])
        lo = before.astype(np.int64) * 64 + _top_bit(word)
        word = own & ~upto
        after = np.where(word != 0, block, self.next[length, block + 1]).astype(np.int64)
        there = after < self.width
        word = np.where(word != 0, word, self.words[length, np.where(there, after, 0)])
        lowest = np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        return lo, np.where(there, after * 64 + lowest, self.n)


class FMIndex:
    """Compressed FM-index of a sequence of symbols 1.. (0 is added as its end),
    sorted to ``depth`` symbols: backward search is right for patterns of up to
    that length. The wavelet matrix's bitmaps are compressed (:class:`Bits`); no
    suffix array is kept, ``of_place`` gives each place's owner and the index keeps
    the owners' ranks in the order of the suffixes, in the fewest bytes that hold
    them. ``borders`` are the intervals of equal first symbols, so a match
    can be shortened to its first l symbols (the parent in the suffix tree)."""

    def __init__(self, text: np.ndarray, depth: int, of_place: np.ndarray | None = None):
        text = np.append(text, 0).astype(np.int64)
        n = len(text)
        rank, span = text, 1
        while span < depth:
            after = np.zeros(n, dtype=np.int64)
            after[:-span] = rank[span:]
            rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1]
            span *= 2
        places = np.argsort(rank, kind="stable").astype(np.int32 if n < 1 << 31 else np.int64)
        del rank
        last = text[places - 1]
        self.sigma = int(text.max()) + 1
        self.first = np.zeros(self.sigma + 1, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=self.sigma), out=self.first[1:])
        self.levels = []
        for bit in range(max(1, (self.sigma - 1).bit_length()) - 1, -1, -1):
            ones = (last >> bit) & 1 == 1
            self.levels.append((bit, Bits(ones), n - int(ones.sum())))
            last = np.concatenate([last[~ones], last[ones]])
        # where each symbol's places begin below the last level
        self.begin = self._down(np.arange(self.sigma), np.zeros(self.sigma, dtype=np.int64))
        self.n = n
        if of_place is not None:
            self.owners, own = np.unique(of_place, return_inverse=True)
            self.own = own[places].astype(np.min_scalar_type(len(self.owners)))
            differ = np.zeros(n, dtype=bool)
            differ[0] = True
            self.common = np.zeros(n + 1, dtype=np.uint8)  # symbols shared with the suffix before, up to depth
            self.borders = Borders(n, depth)
            for step in range(depth):
                self.borders.add(step, differ)
                symbol = text[np.minimum(places.astype(np.int64) + step, n - 1)]
                differ = differ | np.append(True, symbol[1:] != symbol[:-1])
                self.common[:n] += ~differ
            self.borders.add(depth, differ)

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places of the top level followed to the last one along each symbol's bits."""
        for bit, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> bit) & 1 == 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """One step of backward search for many intervals."""
        base = self.first[symbol] - self.begin[symbol]
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([lo, hi]))
        return base + both[:len(lo)], base + both[len(lo):]

    def parents(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How many of their first symbols the intervals share with a neighbour."""
        return np.maximum(self.common[lo], self.common[hi]).astype(np.int64)

    def shorten(self, length: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the matches' first ``length`` symbols."""
        return self.borders.around(length, lo)

    def least_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The smallest owner in each interval (equal or disjoint ones, none empty)."""
        unique, back = np.unique(lo, return_inverse=True)
        ends = np.zeros(len(unique), dtype=np.int64)
        ends[back] = hi
        own = np.append(self.own, self.own[-1:])
        low = np.minimum.reduceat(own, np.stack([unique, ends], axis=1).ravel())[::2]
        return self.owners[low[back]]


def matching_statistics(index: FMIndex, text: np.ndarray, begin: np.ndarray, lengths: np.ndarray, size: int):
    """(place, lo, hi) of every place of the streamed runs from which ``size``
    symbols are in the indexed text more than once. One pass from the end of each
    run, all runs in step: the match that starts one place later is extended by
    its symbol; where it then occurs once only it is shortened at its far end
    until it can be extended. A match carried so is extended or shortened about
    twice a symbol, whatever ``size``."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    order = np.argsort(-lengths, kind="stable")  # runs that still have symbols come first
    begin, lengths = begin[order], lengths[order]
    lo, hi = np.zeros(len(begin), dtype=np.int64), np.full(len(begin), index.n, dtype=np.int64)
    matched = np.zeros(len(begin), dtype=np.int64)
    for step in range(int(lengths.max(initial=0))):
        live = np.arange(int(np.searchsorted(-lengths, -step, side="left")))  # lengths > step
        place = begin[live] + lengths[live] - 1 - step
        full = np.flatnonzero(matched[live] == size)
        if len(full):  # the first size - 1 symbols can be extended to size
            matched[full] = size - 1
            lo[full], hi[full] = index.shorten(matched[full], lo[full])
        symbol = text[place]
        alone = index.first[symbol + 1] - index.first[symbol] <= 1
        none = live[alone]  # the symbol is nowhere else: an empty match
        matched[none], lo[none], hi[none] = 0, 0, index.n
        todo = live[~alone]
        while len(todo):
            a, b = index.extend(symbol[todo], lo[todo], hi[todo])
            more = b - a > 1
            done = todo[more]
            lo[done], hi[done] = a[more], b[more]
            matched[done] += 1
            todo = todo[~more]
            # the longest start of the match that is in a larger interval
            matched[todo] = np.minimum(matched[todo] - 1, index.parents(lo[todo], hi[todo]))
            lo[todo], hi[todo] = index.shorten(matched[todo], lo[todo])
        whole = live[matched[live] == size]
        if len(whole):
            found.append((place[whole], lo[whole], hi[whole]))
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def shard_matches(flat: np.ndarray, lengths: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Smallest owner over all windows equal to each window of the segments.

    flat: the segments' word hashes; lengths: their words; owner: the smallest
    doc_id with each segment. One value per window, in order."""
    symbols = np.unique(flat, return_inverse=True)[1] + 2
    text = np.ones(len(flat) + len(lengths), dtype=np.int64)  # 1 ends a segment
    begin = np.cumsum(lengths + 1) - lengths - 1
    text[W.spread(begin, lengths)] = symbols
    index = FMIndex(text, size, np.append(np.repeat(owner, lengths + 1), np.iinfo(np.int64).max))
    place, lo, hi = matching_statistics(index, text, begin, lengths, size)
    windows = lengths - size + 1
    result = np.repeat(owner, windows)
    if len(place):
        # a place's window: its segment's first window, and the place in the segment
        segment = np.searchsorted(begin, place, side="right") - 1
        result[np.cumsum(windows)[segment] - windows[segment] + place - begin[segment]] = index.least_owner(lo, hi)
    return result


def _distinct(cut: DataFrame, shards: int) -> DataFrame:
    """(shard, content, owner, words) of each distinct segment."""
    distinct = cut.groupBy("content").agg(F.min("doc_id").alias("owner"), F.first("part").alias("part"),
                                          F.first("words").alias("words"))
    return distinct.select(F.pmod(F.xxhash64("part"), F.lit(shards)).alias("shard"), "content", "owner", "words")


def _shards(distinct: DataFrame, size: int) -> DataFrame:
    """(content, lows): per distinct segment, the smallest doc_id with each window."""
    def match(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        words = rows.column("words").combine_chunks()
        lengths = np.diff(np.asarray(words.offsets))
        lows = shard_matches(words.flatten().to_numpy(), lengths, rows.column("owner").to_numpy(), size)
        ends = np.concatenate([[0], np.cumsum(lengths - size + 1)])
        return pa.table({"content": rows.column("content"), "lows": pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(lows, pa.int64()))})

    return distinct.groupBy("shard").applyInArrow(
        match, "content long, lows array<long>")


def repeated_windows(docs: DataFrame, size: int = 13) -> DataFrame:
    """(doc_id, place, content, windows, hits): segments of which at least one
    window is also in a smaller document; hits are those windows' offsets."""
    docs = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
    spots = materialize(_spots(docs, size), "substring-spots")
    let_go(docs.sparkSession)  # the slim rows' shuffle
    shards = max(1, -(-spots.count() // SHARD_SEGMENTS))
    cut = materialize(_with_words(spots, docs, size), "substring-cut")
    let_go(docs.sparkSession, spots)
    distinct = materialize(_distinct(cut, shards), "substring-distinct")
    let_go(docs.sparkSession)  # the shuffle of all segments' words
    lows = _shards(distinct, size)
    hits = cut.select("content", "doc_id", "place", "windows").join(lows, "content").select(
        "doc_id", "place", "content", "windows",
        F.expr("filter(sequence(0, windows - 1), i -> lows[i] < doc_id)").alias("hits"))
    hits = materialize(hits.filter("size(hits) > 0"), "substring-hits")
    let_go(docs.sparkSession, cut, distinct)
    return hits


def _covered(h: np.ndarray, place, windows, content, hits, counts, size: int) -> np.ndarray:
    """The words that the reported windows cover; a segment whose words differ
    belongs to another row with this doc_id. ``hits`` are the segments' reported
    windows, concatenated, ``counts`` how many each has."""
    ok = place + windows + size - 1 <= len(h)
    rows = np.flatnonzero(ok)
    if len(rows):
        found = _hash_runs(h, place[rows], windows[rows] + size - 1)[1].view(np.int64)
        ok[rows] = found == content[rows]
    at = (np.repeat(place, counts) + hits)[np.repeat(ok, counts)]
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    return np.cumsum(cover)[:-1] > 0


def _apply(docs: DataFrame, size: int, finish, added: T.StructType) -> DataFrame:
    """``docs`` without ``text``, and with the columns that ``finish(raw, starts,
    ends, keep)`` gives for each row's text after the removal."""
    lists = repeated_windows(docs, size).groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list(F.struct("place", "windows", "content", "hits")).alias("__hits"))
    others = [f for f in docs.schema if f.name != "text"]

    def remove(batches):
        for batch in batches:
            out = []
            lists = batch.column(batch.schema.get_field_index("__hits"))
            count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            upto = np.concatenate([[0], np.cumsum(count)])
            flat = lists.flatten()
            place, windows, content = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
            counts = flat.field(3).value_lengths().to_numpy(zero_copy_only=False)
            hits, hits_upto = flat.field(3).flatten().to_numpy(), np.concatenate([[0], np.cumsum(counts)])
            for i, raw, starts, ends, h in _unpack(batch):
                keep = np.ones(len(h), dtype=bool)
                if count[i]:
                    own = slice(upto[i], upto[i + 1])
                    keep = ~_covered(h, place[own], windows[own], content[own],
                                     hits[hits_upto[own.start]:hits_upto[own.stop]], counts[own], size)
                out.append(finish(raw, starts, ends, keep))
            if out:
                yield pa.record_batch(
                    [*(batch.column(f.name) for f in others),
                     *(pa.array(x, to_arrow_type(f.dataType)) for x, f in zip(zip(*out), added))],
                    names=[f.name for f in [*others, *added]])

    packed = _packed(docs)
    return packed.join(lists, packed.doc_id.cast("long") == lists["__id"], "left") \
        .select(*packed.columns, "__hits").mapInArrow(remove, T.StructType([*others, *added]))


def _kept_words(raw: bytes, starts, ends, keep) -> bytes:
    return b" ".join(raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist()))


def _kept_text(raw: bytes, starts, ends, keep) -> str:
    """The text without the removed words and the white space after each."""
    if keep.all():
        return raw.decode()
    follows = np.append(starts[1:], len(raw))
    return (raw[:starts[0]] + b"".join(
        raw[s:e] for s, e in zip(starts[keep].tolist(), follows[keep].tolist()))).decode()


def substring_digest(docs: DataFrame, size: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""
    def digest(raw, starts, ends, keep):
        kept = _kept_words(raw, starts, ends, keep)
        return len(keep), int(len(keep) - keep.sum()), hashlib.sha256(kept).hexdigest()

    return _apply(docs.select("doc_id", "text"), size, digest, T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType())]))


def drop_repeats(docs: DataFrame, size: int = 13) -> DataFrame:
    """``docs`` with the repeated words taken out of ``text``. A document that
    lost all its words goes; one without words, or with null text or doc_id,
    stays (a null text as an empty one)."""
    def text(raw, starts, ends, keep):
        gone = len(keep) > 0 and not keep.any()
        return "" if gone else _kept_text(raw, starts, ends, keep), gone

    done = _apply(docs, size, text, T.StructType([
        T.StructField("text", T.StringType()), T.StructField("__gone", T.BooleanType())]))
    return done.filter("not __gone").select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS lo FROM win) WHERE lo < doc_id),
c AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM r) GROUP BY 1),
s AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d JOIN c USING (doc_id)),
g AS (SELECT doc_id, unnest(gone) AS p FROM c),
k AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS kept FROM s ANTI JOIN g USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS kept_sha256
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id"""
