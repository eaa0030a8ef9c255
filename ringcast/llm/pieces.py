"""Unigram encoding and decoding over a double-array trie of pieces.

A model is pieces with log scores, read from a public SentencePiece file (its
path is a parameter) and never trained here. A text is normalised as the file
says (a marker for each space, one in front), and cut into the pieces of the
highest total score by Viterbi; characters that no piece covers become byte
pieces. No piece holds a marker after another character, so the best cut of a
text is the best cuts of its units (a run of markers and the characters up to
the next), each worked out once per process. Units are cut together: the trie is
walked from all positions at once, and the best scores grow by end position.

Ties go to the earlier start (the longer last piece). Scores are summed in
double precision. Decoding joins the pieces, turns byte pieces into their bytes
and markers into spaces, and takes the front marker off; encoded texts come back
exactly.

Defined results: null and empty texts have no ids and decode to the empty text.
Rows that repeat a doc_id are encoded one by one. Other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringcast.llm import words as W

MARKER = "▁".encode()
UNKNOWN_PENALTY = 10.0
_BLANK = np.zeros(256, dtype=bool)
_BLANK[0x20] = True


class Trie:
    """Double-array trie: child of ``node`` for a byte is ``t = base[node] + byte``
    if ``check[t] == node``; ``value[t]`` is the piece that ends there, or -1."""

    def __init__(self, base: np.ndarray, check: np.ndarray, value: np.ndarray):
        self.base, self.check, self.value = base, check, value

    @classmethod
    def build(cls, keys: list[bytes]) -> "Trie":
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for i, key in enumerate(keys):
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][byte]
            ends[node] = i
        size = 4 * len(children) + 1024
        base, check, value = (np.full(size, x, dtype=np.int32) for x in (0, -1, -1))
        taken = np.zeros(size, dtype=bool)
        taken[0] = True
        place, queue = {0: 0}, [0]
        low, wide = 257, 257  # where nodes of one child, and of more, look for room
        for node in queue:
            if not children[node]:
                continue
            symbols = np.array(sorted(children[node]), dtype=np.int64)
            if max(low, wide) + 4096 > size:
                grow = lambda a, fill: np.concatenate([a, np.full(size, fill, dtype=a.dtype)])
                base, check, value = grow(base, 0), grow(check, -1), grow(value, -1)
                taken, size = grow(taken, False), size * 2
            if len(symbols) == 1:
                while taken[low]:
                    low += 1
                at = low - int(symbols[0])
            else:
                while True:
                    free = np.flatnonzero(~taken[wide:wide + 1024]) + wide - symbols[0]
                    fits = np.flatnonzero(~taken[free[:, None] + symbols].any(axis=1))
                    if len(fits):
                        break
                    wide += 1024
                at = int(free[fits[0]])
            base[place[node]] = at
            for s in symbols.tolist():
                child, t = children[node][s], at + s
                taken[t], check[t], value[t], place[child] = True, place[node], ends[child], t
                queue.append(child)
        used = int(np.flatnonzero(taken)[-1]) + 257
        return cls(base[:used].copy(), check[:used].copy(), value[:used].copy())

    def matches(self, data: np.ndarray, starts: np.ndarray, limits: np.ndarray):
        """(start, end, key) of all keys that begin at the starts and end by the limits."""
        out = []
        node, at, begin = np.zeros(len(starts), dtype=np.int64), starts, starts
        while len(at):
            inside = at < limits
            node, at, begin, limits = node[inside], at[inside], begin[inside], limits[inside]
            t = self.base[node].astype(np.int64) + data[at]
            ok = (t < len(self.check))
            t = np.where(ok, t, 0)
            ok &= self.check[t] == node
            ok &= t > 0
            node, at, begin, limits = t[ok], at[ok] + 1, begin[ok], limits[ok]
            key = self.value[node]
            hit = key >= 0
            out.append((begin[hit], at[hit], key[hit].astype(np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (starts[:0],) * 3


class Model:
    """Pieces, scores and byte pieces of a SentencePiece file."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int], normal: list[int],
                 unknown: int, prefix: bool):
        self.pieces, self.byte_ids, self.unknown, self.prefix = pieces, np.array(byte_ids), unknown, prefix
        self.normal = np.array(normal)
        self.scores = np.array([scores[i] for i in normal])
        self.least = float(self.scores.min()) - UNKNOWN_PENALTY
        raw = [bytes([byte_ids.index(i)]) if i in set(byte_ids) else p.encode().replace(MARKER, b" ")
               for i, p in enumerate(pieces)]
        self.bytes = W.Ragged(np.frombuffer(b"".join(raw), dtype=np.uint8),
                              np.cumsum([0, *map(len, raw[:-1])]), np.array([len(x) for x in raw]))
        self.known = None
        self.trie = Trie.build([pieces[i].encode().replace(MARKER, b" ") for i in normal])

    @classmethod
    def load(cls, path: str) -> "Model":
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        return cls.of(proto)

    @classmethod
    def of(cls, proto) -> "Model":
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only identity normalisation with marked spaces is supported")
        kinds = [p.type for p in proto.pieces]
        byte = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 6}
        normal = [i for i, k in enumerate(kinds) if k in (1, 4)]
        for i in normal:
            if "▁" in proto.pieces[i].piece.lstrip("▁"):
                raise ValueError(f"piece {proto.pieces[i].piece!r} holds a marker within")
        return cls([p.piece for p in proto.pieces], [p.score for p in proto.pieces],
                   [byte[f"<0x{b:02X}>"] for b in range(256)], normal, kinds.index(2), spec.add_dummy_prefix)

    def cut(self, units: list[bytes]) -> W.Ragged:
        """The best cut of each unit (spaces stand for markers)."""
        lengths = np.array([len(u) for u in units], dtype=np.int64)
        data = np.frombuffer(b"".join(units), dtype=np.uint8)
        ends = np.cumsum(lengths)
        begins = ends - lengths
        unit = np.repeat(np.arange(len(units)), lengths)
        chars = np.flatnonzero((data & 0xC0) != 0x80)
        after = np.append(chars[1:], len(data))
        start, stop, key = self.trie.matches(data, chars, ends[unit[chars]])
        single = np.zeros(len(data) + 1, dtype=bool)
        char_end = np.zeros(len(data) + 1, dtype=np.int64)
        char_end[chars] = after
        single[start[char_end[start] == stop]] = True
        bare = ~single[chars]
        start = np.concatenate([start, chars[bare]])
        stop = np.concatenate([stop, after[bare]])
        worth = np.concatenate([self.scores[key], np.full(int(bare.sum()), self.least)])
        piece = np.concatenate([self.normal[key], np.full(int(bare.sum()), -1)])
        # positions are kept apart by unit: a unit's end is not the next one's begin
        shift = unit
        best = np.full(len(data) + len(units) + 1, -np.inf)
        back, chosen = (np.full(len(best), -1, dtype=np.int64) for _ in range(2))
        own = shift[start]
        best[begins + np.arange(len(units))] = 0.0
        reach = stop - begins[own]
        order = np.lexsort((start, stop, reach))
        start, stop, worth, piece, own, reach = (x[order] for x in (start, stop, worth, piece, own, reach))
        edge = np.concatenate([[0], np.flatnonzero(np.diff(reach)) + 1, [len(reach)]])
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            total = best[start[a:b] + own[a:b]] + worth[a:b]
            to = stop[a:b] + own[a:b]
            new = np.concatenate([[0], np.flatnonzero(np.diff(to)) + 1])
            top = np.maximum.reduceat(total, new)
            group = np.repeat(np.arange(len(new)), np.diff(np.append(new, b - a)))
            first = np.flatnonzero(total == top[group])
            pick = first[np.unique(group[first], return_index=True)[1]]  # the earliest start
            best[to[pick]], back[to[pick]], chosen[to[pick]] = total[pick], start[a:b][pick], piece[a:b][pick]
        out = []
        live = np.flatnonzero(lengths > 0)
        at = ends[live]
        while len(live):
            spot = at + live
            out.append((live, back[spot], at, chosen[spot]))
            at = back[spot]
            more = at > begins[live]
            live, at = live[more], at[more]
        if not out:
            return W.Ragged(np.zeros(0, np.uint32), np.zeros(len(units), np.int64), lengths * 0)
        own, start, stop, piece = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(start, kind="stable")
        own, start, stop, piece = own[order], start[order], stop[order], piece[order]
        times = np.where(piece < 0, stop - start, 1)
        ids = np.repeat(piece, times)
        from_bytes = ids < 0
        spots = W.spread(start, times)
        ids[from_bytes] = self.byte_ids[data[spots[from_bytes]]]
        count = np.bincount(np.repeat(own, times), minlength=len(units))
        return W.Ragged(ids.astype(np.uint32), np.cumsum(count) - count, count)

    @property
    def table(self) -> W.IdTable:
        """The units cut so far in this process."""
        if self.known is None:
            self.known = W.IdTable(self.cut, limit=1_000_000)
        return self.known

    def marked(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with the space in front of each that is not empty."""
        if not self.prefix:
            return data, offsets
        some = np.diff(offsets) > 0
        return (np.insert(data, offsets[:-1][some], 0x20),
                offsets + np.concatenate([[0], np.cumsum(some)]))

    def encode(self, table: W.IdTable, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids, concatenated, and each text's number of ids."""
        data, offsets = self.marked(data, offsets)
        begin, finish, text = W.find_units(data, offsets, _BLANK)
        if not len(begin):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets) - 1, dtype=np.int64)
        rows = table.look_up(W.hash_spans(data, begin, finish), data, begin, finish)
        flat, lengths = table.values.take(rows)
        return flat, np.bincount(text, weights=lengths, minlength=len(offsets) - 1).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a list of ids, as UTF-8 (bytes that are no UTF-8 stay as they are)."""
        raw = self.bytes.take(ids.astype(np.int64))[0].tobytes()
        return raw[1:] if self.prefix and raw[:1] == b" " else raw


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: Model, digest: bool = False) -> DataFrame:
    """doc_id and ids of every document; with ``digest`` n_ids, n_byte_ids,
    ids_crc32 and whether decoding gives the text back, instead of the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        table = m.table
        is_byte = np.zeros(len(m.pieces), dtype=bool)
        is_byte[m.byte_ids] = True
        for rows, data, offsets in W.chunks(batches):
            flat, count = m.encode(table, data, offsets)
            at = np.concatenate([[0], np.cumsum(count)])
            if not digest:
                yield pa.record_batch([rows.column(0), pa.ListArray.from_arrays(
                    pa.array(at, pa.int32()), pa.array(flat, pa.int32()))], names=["doc_id", "ids"])
                continue
            raw = data.tobytes()
            crc, same = [], []
            for i in range(len(count)):
                ids = flat[at[i]:at[i + 1]]
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                same.append(m.decode(ids) == raw[offsets[i]:offsets[i + 1]])
            bytes_before = np.concatenate([[0], np.cumsum(is_byte[flat])])
            yield pa.record_batch([rows.column(0), pa.array(count), pa.array(np.diff(bytes_before[at])),
                                   pa.array(crc, pa.int64()), pa.array(same)],
                                  names=["doc_id", "n_ids", "n_byte_ids", "ids_crc32", "round_trip"])

    schema = ("doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, round_trip boolean" if digest
              else "doc_id long, ids array<int>")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """doc_id and text of ``encode``'s rows; bytes that are no UTF-8 are replaced."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = [None if x is None else shared.value.decode(np.array(x, dtype=np.int64)).decode(errors="replace")
                     for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
