"""Bulk-synchronous best-fit packing of tokenized documents into sequences.

A document is its token ids and an end id. Only documents longer than a
sequence are cut, into full pieces; the first may be shorter. Pieces and gaps
(the free ends of sequences) are sorted by size. In each round every gap, from
the largest, calls for the largest waiting piece that fits (its successor in
the sorted order), pieces of one size that are called more than once are given
out by rank, the gaps shrink, and the next round begins; pieces that no gap can
take open sequences, the largest first.

Sizes are whole numbers of at most ``capacity``, so sorted pieces and gaps are
runs of equal sizes: a round's sweep handles runs, and its plan is a list of
(size, ranks, sequences, offset). What the sweeps hold is bounded by the
capacity, not by the corpus; the counts come from one aggregation, and ranking
the pieces and joining them to the plan is done by all tasks, whatever size a
third of the pieces may have (ranks are taken within size and hash bucket).

Defined results: null text is an empty one: its end id alone is packed. Rows
that repeat a doc_id are packed one by one. Ties are ordered by doc_id, piece
and the piece's ids. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.llm import words as W
from ringcast.session import materialize

CAPACITY = 2048
END_ID = 0
BUCKETS = 64        # at least so many tasks rank the pieces of one size
BUCKET_ROWS = 1_000_000
#: white space beyond ASCII: a text with one of these is tokenized in one go
WIDE_SPACE = [chr(c).encode() for c in range(0x80, 0x3001) if chr(c).isspace()]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: fixed value: the pre-tokenization pattern of the byte-level vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BREAK = "\n"


def fast_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary file's tokens as bytes with their ids, if its merges are in
    id order and its rules are plain byte-level ones; else None. Only then
    merging by rank gives the ids that its own library gives."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if (model.get("type") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("dropout")
            or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix")):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    vocabulary, special = model["vocab"], {x["content"] for x in spec.get("added_tokens", [])}
    merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    return {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in special}


class Encoder:
    """Token ids of whole texts. Byte-level BPE never joins across the start of a
    run of white space, so each run with the word after it is tokenized by
    itself, once per process, and texts are put together from those ids. Where the
    vocabulary allows (``fast_ranks``) tiktoken merges the units, with the ids of
    the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content.encode() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.table = W.IdTable(self._units, limit=1_000_000)
        self.fast = None
        ranks = fast_ranks(path)
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.line = ranks[BREAK.encode()]

    def _units(self, units: list[bytes]) -> W.Ragged:
        """Ids of each unit. Units of a word and at most one space go in one call,
        a line break after each; the rest go one by one."""
        simple = [self.fast is not None and (u[:1] > b" " or (u[:1] == b" " and u[1:2] > b" ")) for u in units]
        some = [u for u, ok in zip(units, simple) if ok]
        if len(some) == len(units):
            found = self._together(some)
            return found if found else self._each(units)
        rest = self._each([u for u, ok in zip(units, simple) if not ok])
        found = self._together(some) if some else None
        if some and not found:
            return self._each(units)
        if not found:
            return rest
        both = W.IdTable(None).join(found, rest)
        order = np.argsort(np.argsort(~np.array(simple), kind="stable"), kind="stable")
        return W.Ragged(both.flat, both.starts[order], both.lengths[order])

    def _together(self, units: list[bytes]) -> W.Ragged | None:
        text = BREAK.encode().join(units) + BREAK.encode()
        ids = self.fast.encode_to_numpy(text.decode(), disallowed_special=()).astype(np.uint32)
        cuts = np.flatnonzero(ids == self.line)
        if len(cuts) != len(units):  # white space beyond ASCII joined a break
            return None
        starts = np.concatenate([[0], cuts[:-1] + 1])
        return W.Ragged(ids, starts, cuts - starts)

    def _each(self, units: list[bytes]) -> W.Ragged:
        found = self.tokenizer.encode_batch([u.decode() for u in units], add_special_tokens=False)
        return W.Ragged.of([x.ids for x in found])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids, concatenated, and each text's number of ids."""
        begin, finish, text = W.find_units(data, offsets)
        rows = self.table.look_up(W.hash_spans(data, begin, finish), data, begin, finish)
        if not len(rows):
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets) - 1, dtype=np.int64)
        flat, lengths = self.table.values.take(rows)
        return flat, np.bincount(text, weights=lengths, minlength=len(offsets) - 1).astype(np.int64)

    def whole(self, raw: bytes) -> bool:
        """Whether a text has to be tokenized in one go."""
        return any(x in raw for x in self.special) or (not raw.isascii() and any(
            c in raw for c in WIDE_SPACE))


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder, with its table of known units, per worker process."""
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of all documents' pieces."""
    path = tokenizer or default_tokenizer()

    def cut(batches):
        encoder = encoder_of(path)
        for rows, data, offsets in W.chunks(batches):
            flat, counts = encoder.encode(data, offsets)
            at = np.concatenate([[0], np.cumsum(counts)])
            raw = data.tobytes()
            plain = raw.isascii() and not any(x in raw for x in encoder.special)
            doc_id = rows.column(0).to_pylist()
            out, all_ids = [], []
            for i in range(len(counts)):
                ids = flat[at[i]:at[i + 1]]
                if not plain and encoder.whole(raw[offsets[i]:offsets[i + 1]]):
                    one = raw[offsets[i]:offsets[i + 1]].decode()
                    ids = np.array(encoder.tokenizer.encode(one, add_special_tokens=False).ids, dtype=np.uint32)
                ids = np.append(ids, np.uint32(END_ID)).astype(np.uint32)
                begin, stop, k = 0, (len(ids) - 1) % capacity + 1, 0
                while begin < len(ids):
                    part = ids[begin:stop]
                    out.append((doc_id[i], k, begin, len(part), W.crc32(part)))
                    if with_ids:
                        all_ids.append(part)
                    begin, stop, k = stop, stop + capacity, k + 1
            cols = [pa.array(x, t) for x, t in zip(zip(*out), (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.record_batch(cols, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def plan_rounds(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank + 1, first sequence, offset) for runs of
    equal pieces that lie in runs of sequences, one piece in each.

    waiting: how many pieces of each size are left and the next rank; gaps: runs
    of sequences by free room. A round sweeps the gaps from the smallest to the
    largest: each run of gaps takes its successor, the largest waiting size that
    fits; ranks settle who gets a piece when gaps outnumber pieces, and the rest
    of the run calls for the next size. The gaps' new sizes count from the next
    round on. When no gap can take a piece, the largest waiting size opens as few
    sequences as hold its pieces."""
    waiting = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        waiting[length] = n
    given = np.zeros(capacity + 1, dtype=np.int64)
    plan: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    used = 0

    def largest(most: int) -> int:
        found = np.flatnonzero(waiting[1:most + 1])
        return int(found[-1]) + 1 if len(found) else 0

    def open_with(size: int, n: int, each: int) -> None:
        """``n`` new sequences, each begun with ``each`` pieces of this size."""
        nonlocal used
        if not n:
            return
        for k in range(each):
            plan.append((size, int(given[size]), int(given[size]) + n, used, k * size))
            given[size] += n
        if each * size < capacity:
            gaps.setdefault(capacity - each * size, []).append((used, n))
        used += n

    while True:
        size = largest(capacity)
        if not size:
            return plan
        n, each = int(waiting[size]), capacity // size
        waiting[size] = 0
        open_with(size, n // each, each)
        if n % each:
            open_with(size, 1, n % each)
        # rounds: until no gap can take a piece that must not open a sequence
        while True:
            smallest = np.flatnonzero(waiting[1:])
            least = int(smallest[0]) + 1 if len(smallest) else 0
            calls = sorted(g for g in gaps if least and g >= least)
            if not calls:
                break
            fresh: dict[int, list[tuple[int, int]]] = {}
            for gap in calls:
                for first, n in gaps.pop(gap):
                    while n:
                        fit = largest(gap)
                        if not fit:
                            fresh.setdefault(gap, []).append((first, n))
                            break
                        k = min(n, int(waiting[fit]))
                        plan.append((fit, int(given[fit]), int(given[fit]) + k, first, capacity - gap))
                        given[fit] += k
                        waiting[fit] -= k
                        if gap > fit:
                            fresh.setdefault(gap - fit, []).append((first, k))
                        first, n = first + k, n - k
            for gap, runs in fresh.items():
                gaps.setdefault(gap, []).extend(runs)


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """``rank`` from 0 within each length. Rows are ranked within (length, bucket)
    and shifted by the rows of earlier buckets, so a common length is no single
    task; the buckets follow ``most``, the pieces of the commonest length."""
    buckets = max(BUCKETS, -(-most // BUCKET_ROWS))
    found = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = found.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    return found.withColumn("own", F.row_number().over(own) - 1).join(sizes, ["length", "bucket"]) \
        .withColumn("rank", F.col("own") + F.col("shift")).drop("own", "shift", "bucket")


def assign(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (a stored table of pieces) with sequence_id and offset."""
    spark = found.sparkSession
    counts = {r.length: r["count"] for r in found.groupBy("length").count().collect()}
    plan = plan_rounds(counts, capacity)
    if not plan:
        return found.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    # a length's runs follow each other by rank: one sorted list, searched per piece
    by_length: dict = {}
    for length, low, _, sequence, offset in plan:
        by_length.setdefault(length, []).append((low, sequence, offset))
    plans = spark.sparkContext.broadcast({k: tuple(np.array(x, dtype=np.int64) for x in zip(*sorted(v)))
                                          for k, v in by_length.items()})
    fields = list(found.schema)

    def place(batches):
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            ranks = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            sequence, offset = np.zeros(len(ranks), dtype=np.int64), np.zeros(len(ranks), dtype=np.int64)
            for length in np.unique(lengths).tolist():
                low, seq, off = plans.value[length]
                own = lengths == length
                at = np.searchsorted(low, ranks[own], side="right") - 1
                sequence[own], offset[own] = seq[at] + ranks[own] - low[at], off[at]
            keep = [batch.column(f.name) for f in fields]
            yield pa.record_batch([*keep, pa.array(sequence), pa.array(offset)],
                                  names=[*(f.name for f in fields), "sequence_id", "offset"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return _ranked(found, max(counts.values())).mapInArrow(place, ddl + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and the ids if asked for."""
    return assign(materialize(pieces(docs, tokenizer, capacity, with_ids), "packing-pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The training sequences of ``pack(..., with_ids=True)``: sequence_id, ids."""
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
