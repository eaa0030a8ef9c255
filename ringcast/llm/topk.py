"""Exact top-k inner-product search on a bit-sliced index.

Every component is a whole number, floor(scale * x). Rows are dealt to blocks
of about ``BLOCK`` rows; a block's index holds one bitmap per attribute and bit
(two's complement), so an attribute is a stack of slices. For a query the
slices of the quantised attributes (their upper bits) are added with bitmap
arithmetic only: each weight's signed binary digits say which stacks enter at
which power of two, and carry-save adders reduce each power's slices to one.
The sum's slices are read from the most significant down to pick the rows that
are surely among the k highest; rows whose sum lies within the quantisation's
bound of the k-th are the boundary, rebuilt from all their slices and scored
exactly. The k best of all blocks are then the k best of all rows.

Rows per block and queries per group are bounded, so a task holds one block and
one group of queries at a time, whatever the input.

A row whose scores could leave 64-bit arithmetic (length times the square of its
largest component from 2^63 on) is wide: it is kept outside the slices, and its
scores, as candidate or query, are exact whole numbers of any size.

Defined results: vectors that are null or hold null or non-finite components
(before or after scaling) take no part, nor do rows with a null vec_id. A score
among the k highest that does not fit a long is an error. A shorter vector counts
as zero beyond its end, so an empty one scores 0 with all. Rows that repeat a
vec_id, equal ones too, are candidates each, never for their own id; as queries
they share one list, in which each of them names its own candidates. Ties go to
the smaller vec_id.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.llm.vectors import FINITE, matrix
from ringcast.session import materialize

BLOCK = 1 << 14
QUERY_GROUP = 2048
DROPPED_BITS = 3
LONG = 1 << 63


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, row key, the whole numbers (as doubles) of each row that takes part,
    and whether it is wide: its scores need not fit the slices' 64-bit arithmetic."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(
        F.col("embedding").cast("array<double>"), lambda x: F.lit(float(scale)) * x).alias("e"))
    v = v.filter(f"vec_id is not null and {FINITE.format('e')}")
    most = F.coalesce(F.array_max(F.transform("e", F.abs)), F.lit(0.0)) + 1
    # beyond 2^53 a double is whole already
    whole = F.transform("e", lambda x: F.when(F.abs(x) < F.lit(2.0 ** 53), F.floor(x).cast("double")).otherwise(x))
    return v.select("vec_id", F.monotonically_increasing_id().alias("row"), whole.alias("v"),
                    (F.size("e") * most * most >= F.lit(float(LONG))).alias("wide"))


def slice_rows(v: np.ndarray) -> np.ndarray:
    """[attribute, bit, words]: the bitmaps of a block's rows, lowest bit first;
    the last is the sign."""
    n, d = v.shape
    bits = int(max(v.max(initial=0), -v.min(initial=0) - 1)).bit_length() + 1
    out = np.zeros((d, bits, -(-n // 64)), dtype=np.uint64)
    padded = np.zeros((d, out.shape[2] * 64), dtype=np.uint8)
    for b in range(bits):
        padded[:, :n] = ((v >> b) & 1).T
        out[:, b] = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    return out


def signed_digits(x: int) -> list[tuple[int, int]]:
    """(power, sign) of the non-adjacent form of a whole number."""
    sign, x, out, power = (1, x, [], 0) if x >= 0 else (-1, -x, [], 0)
    while x:
        if x & 1:
            digit = 2 - (x & 3)
            out.append((power, digit * sign))
            x -= digit
        x >>= 1
        power += 1
    return out


def weighted_sum(slices: np.ndarray, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
    """Slices, lowest first, of the sum of weight * attribute + constant >= 0,
    and that constant. A negative digit adds the complement of its slices, a sign
    slice enters as its complement too; the constant is what both leave over."""
    levels: dict[int, list[np.ndarray]] = {}
    bits, constant = slices.shape[1], 0
    for attribute, weight in zip(slices, weights.tolist()):
        for power, sign in signed_digits(weight):
            for b in range(bits):
                worth = sign * (-1 if b == bits - 1 else 1)
                levels.setdefault(power + b, []).append(attribute[b] if worth > 0 else ~attribute[b])
                if worth < 0:  # -x = ~x - 1
                    constant += 1 << (power + b)
    out, power = [], 0
    while levels and (power <= max(levels)):
        stack = levels.pop(power, [])
        while len(stack) > 2:
            k = len(stack) // 3 * 3
            x = np.stack(stack[:k]).reshape(3, k // 3, -1)
            half = x[0] ^ x[1]
            carry = (x[0] & x[1]) | (half & x[2])
            half ^= x[2]
            levels.setdefault(power + 1, []).extend(carry)
            stack = [*half, *stack[k:]]
        if len(stack) == 2:
            levels.setdefault(power + 1, []).append(stack[0] & stack[1])
            stack = [stack[0] ^ stack[1]]
        out.append(stack[0] if stack else np.zeros(slices.shape[2], dtype=np.uint64))
        power += 1
    return out, constant


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_highest(total: list[np.ndarray], some: np.ndarray, k: int) -> int:
    """The k-th highest value among the rows of ``some``, from the top slice down;
    the lowest value if there are fewer."""
    value, surely, open_ = 0, 0, some
    for power in range(len(total) - 1, -1, -1):
        ones = open_ & total[power]
        n = _count(ones)
        if surely + n >= k:
            value |= 1 << power
            open_ = ones
        else:
            surely += n
            open_ = open_ & ~total[power]
    return value


def at_least(total: list[np.ndarray], some: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the rows of ``some`` whose value reaches ``value``."""
    if value <= 0:
        return some
    if value >> len(total):
        return np.zeros_like(some)
    above, equal = np.zeros_like(some), some
    for power in range(len(total) - 1, -1, -1):
        if value >> power & 1:
            equal = equal & total[power]
        else:
            above |= equal & total[power]
            equal = equal & ~total[power]
    return above | equal


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def rebuild(slices: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The rows' whole vectors, from all their slices."""
    got = (slices[:, :, rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
    worth = np.int64(1) << np.arange(slices.shape[1], dtype=np.int64)
    worth[-1] = -worth[-1]
    return np.einsum("dbr,b->rd", got.astype(np.int64), worth)


def search_block(slices: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int,
                 dropped: int = DROPPED_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of a block's k best rows for one query."""
    if len(query) < slices.shape[0]:
        query = np.append(query, np.zeros(slices.shape[0] - len(query), dtype=np.int64))
    query = query[:slices.shape[0]]
    dropped = min(dropped, slices.shape[1] - 1)
    total, _ = weighted_sum(slices[:, dropped:], query)
    some = np.full(slices.shape[2], np.iinfo(np.uint64).max, dtype=np.uint64)
    some[-1] = np.uint64((1 << ((len(ids) - 1) % 64 + 1)) - 1)
    mine = np.flatnonzero(ids == own)
    np.bitwise_and.at(some, mine >> 6, ~(np.uint64(1) << (mine & 63).astype(np.uint64)))
    have = _count(some)
    if not have:
        return ids[:0], ids[:0]
    # a score is 2^dropped * sum + rest, with rest in [low, high]
    most = (1 << dropped) - 1
    low, high = int(query[query < 0].sum()) * most, int(query[query > 0].sum()) * most
    kth = kth_highest(total, some, min(k, have)) if total else 0
    reach = -(-(high - low) >> dropped) if high > low else 0
    rows = rows_of(at_least(total, some, kth - reach - 1)) if total else rows_of(some)
    score = rebuild(slices, rows) @ query
    best = np.lexsort((ids[rows], -score))[:k]
    return ids[rows][best], score[best]


def search_wide(v: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, list]:
    """(ids, scores) of the k best rows for one query (whole numbers held as
    doubles), by whole numbers of any size; floating-point sums and their error bound only say which rows can be
    among them. A score below all longs is None, one above them an error."""
    wide = max(v.shape[1], len(query))
    v, query = np.pad(v, ((0, 0), (0, wide - v.shape[1]))), np.pad(query, (0, wide - len(query)))
    rows = np.flatnonzero(ids != own)
    if len(rows) > k:
        with np.errstate(over="ignore", invalid="ignore"):
            about, off = v[rows] @ query, (np.abs(v[rows]) @ np.abs(query)) * ((2 * wide + 8) * 2.0 ** -52)
            least, most = about - off, about + off
        if np.isfinite(least).all() and np.isfinite(most).all():
            rows = rows[most >= np.partition(least, -k)[-k]]
    q = [int(b) for b in query.tolist()]
    best = sorted((-sum(int(a) * b for a, b in zip(x, q)), i) for x, i in zip(v[rows].tolist(), ids[rows].tolist()))[:k]
    if best and -best[0][0] >= LONG:
        raise OverflowError(f"the score of vectors {own} and {best[0][1]} does not fit a long")
    return np.array([i for _, i in best], dtype=np.int64), [-s if -s >= -LONG else None for s, _ in best]


def build_index(vectors: DataFrame) -> DataFrame:
    """(block, ids, slices, width): the bit-sliced index of a stored table of
    whole vectors, blocks of about BLOCK rows. Wide rows have blocks of their own,
    which hold the vectors as they are."""
    count = {r.wide: r["count"] for r in vectors.groupBy("wide").count().collect()}
    blocks, more = (-(-count.get(wide, 0) // BLOCK) for wide in (False, True))

    def build(rows: pa.Table) -> pa.Table:
        v = matrix(rows.column("v"), 1)
        wide = rows.column("wide")[0].as_py()
        s = v if wide else slice_rows(v.astype(np.int64))
        return pa.table({"block": rows.column("block")[:1], "ids": [rows.column("vec_id").to_numpy().tobytes()],
                         "slices": [s.tobytes()], "width": pa.array([v.shape[1]], pa.int32()), "wide": [wide]})

    key = F.xxhash64("row")
    dealt = vectors.withColumn("block", F.when(F.col("wide"), F.pmod(key, F.lit(max(1, more))) + blocks)
                               .otherwise(F.pmod(key, F.lit(max(1, blocks)))).cast("int"))
    return dealt.groupBy("block").applyInArrow(build, "block int, ids binary, slices binary, width int, wide boolean")


def top_k(vectors: DataFrame, queries: str, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of
    each vector that the SQL condition ``queries`` names with all others."""
    whole = materialize(whole_vectors(vectors, scale), "topk-vectors")
    index = materialize(build_index(whole), "topk-index")
    asked = whole.filter(queries)
    groups = max(1, -(-asked.count() // QUERY_GROUP))
    # every group of queries meets every block: the index's blocks are numbered 0 ..
    blocks = index.agg(F.max("block")).first()[0]
    left = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = asked.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks or 0))))

    def search(block: pa.Table, some: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if block.num_rows and some.num_rows:
            ids = np.frombuffer(block.column("ids")[0].as_py(), dtype=np.int64)
            width = block.column("width")[0].as_py()
            raw = block.column("slices")[0].as_py()
            wide, v = block.column("wide")[0].as_py(), None
            if wide:
                v = np.frombuffer(raw).reshape(len(ids), width)
            else:
                slices = np.frombuffer(raw, dtype=np.uint64).reshape(width, -1, -(-len(ids) // 64))
            asked = matrix(some.column("v"))
            for own, q, wide_query in zip(some.column("vec_id").to_numpy().tolist(), asked, some.column("wide").to_pylist()):
                if wide or wide_query:
                    v = rebuild(slices, np.arange(len(ids))).astype(np.float64) if v is None else v
                    found, score = search_wide(v, ids, q, own, k)
                else:
                    found, score = search_block(slices, ids, q.astype(np.int64), own, k)
                out[0].extend([own] * len(found))
                out[1].extend(found.tolist())
                out[2].extend(score if isinstance(score, list) else score.tolist())
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), out)})

    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(
        search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc_nulls_last("score"), "vec_id")
    score = F.coalesce("score", F.raise_error(F.lit("a score among the highest does not fit a long")).cast("long"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", score.alias("score"))


ORACLE_SQL = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 10"""
