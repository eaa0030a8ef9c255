"""Token-ring expressions: the hash of the partition key and its split.

The ring is the signed 64-bit range [-2^63, 2^63-1]. ``splits`` ranges of
width ``step = (2^64-1) div splits`` start at ``-2^63 + k*step``; every range
is half open except the last, which is closed at 2^63-1 so the cover is exact.

Everything here is a Column expression: one pass over the data assigns each
row its split, instead of one filtered scan per range.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the ring (signed 64-bit token space).
MIN_TOKEN = -(2 ** 63)
MAX_TOKEN = 2 ** 63 - 1
RING_SIZE = 2 ** 64 - 1  # MAX_TOKEN - MIN_TOKEN
# Multiplier of the multiplicative (Knuth) token; a bijection on 64-bit keys.
MULTIPLICATIVE_TOKEN_FACTOR = 6364136223846793005


def quoted(name: str) -> str:
    """A column name as a backquoted identifier (backquotes inside doubled)."""
    return "`" + name.replace("`", "``") + "`"


def _col(c) -> Column:
    return F.col(quoted(c)) if isinstance(c, str) else c


MAX_SPLITS = 2 ** 31 - 1  # split ids are int columns


def check_splits(splits: int) -> int:
    if not isinstance(splits, int) or isinstance(splits, bool) or not 1 <= splits <= MAX_SPLITS:
        raise ValueError(f"splits must be an integer in 1..{MAX_SPLITS}, got {splits!r}")
    return splits


def ring_step(splits: int) -> int:
    return RING_SIZE // check_splits(splits)


def range_bound(splits: int, k: int) -> tuple[int, int, int, bool]:
    """``(split_id, token_start, token_end, end_inclusive)`` of range ``k``."""
    step = ring_step(splits)
    if not 0 <= k < splits:
        raise ValueError(f"split index {k} outside 0..{splits - 1}")
    start = MIN_TOKEN + k * step
    last = k == splits - 1
    return k, start, MAX_TOKEN if last else start + step, last


def range_bounds(splits: int) -> list[tuple[int, int, int, bool]]:
    """``range_bound`` of every range (driver-side list; ``split_bounds`` in
    the ring operators builds the same as a DataFrame)."""
    return [range_bound(splits, k) for k in range(check_splits(splits))]


def ring_token(*cols) -> Column:
    """Signed 64-bit ring hash of the partition key columns, in key order.

    ``xxhash64`` skips null inputs, so ``(1, null)`` hashes like ``(1)``.
    """
    if not cols:
        raise ValueError("at least one partition key column is required")
    return F.xxhash64(*[_col(c) for c in cols])


def _big(n: int, precision: int = 38) -> Column:
    """Decimal literal for integers outside the 64-bit range."""
    return F.lit(str(n)).cast(f"decimal({precision},0)")


def multiplicative_token(col) -> Column:
    """``((key * 6364136223846793005) mod 2^64) - 2^63`` for one integral key.

    A token that other engines reproduce exactly (DuckDB: HUGEINT arithmetic),
    used where split assignments must be compared across engines.
    """
    key = _col(col).cast("decimal(38,0)")
    wrapped = F.pmod(key * _big(MULTIPLICATIVE_TOKEN_FACTOR), _big(2 ** 64))
    return (wrapped - _big(2 ** 63)).cast("bigint")


def make_token(pk, method: str = "xxhash64") -> Column:
    cols = [pk] if isinstance(pk, (str, Column)) else list(pk)
    if method == "xxhash64":
        return ring_token(*cols)
    if method == "multiplicative":
        if len(cols) != 1:
            raise ValueError("the multiplicative token takes exactly one integral key column")
        return multiplicative_token(cols[0])
    if method == "column":
        if len(cols) != 1:
            raise ValueError("a precomputed token is exactly one bigint column")
        return _col(cols[0]).cast("bigint")
    raise ValueError(f"unknown token method {method!r}")


def _div(c: Column, d: int) -> Column:
    """Integral division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", c, F.lit(d))


def split_id(token, splits: int) -> Column:
    """Index of the ring range holding ``token`` (an integer Column).

    Exact ``(token + 2^63) div step`` in 64-bit integer arithmetic (no decimal,
    so it stays in generated code): with ``2^63 = A*step + B`` and
    ``token = q*step + r`` (floor division), the offset is
    ``(A+q)*step + (B+r)``, one step more when ``r >= step - B``.
    The top remainder of the ring is folded into the last range.
    """
    splits = check_splits(splits)
    tok = _col(token).cast("bigint")
    if splits == 1:
        return F.when(tok.isNotNull(), F.lit(0)).cast("int")
    step = ring_step(splits)
    a, b = divmod(2 ** 63, step)
    floor_q = _div(tok, step) - F.when(tok % F.lit(step) < 0, F.lit(1)).otherwise(F.lit(0))
    carry = F.when(F.pmod(tok, F.lit(step)) >= F.lit(step - b), F.lit(1)).otherwise(F.lit(0))
    # a null token (a null key under the multiplicative or column token) has no split
    return F.when(tok.isNotNull(),
                  F.least(F.lit(a) + floor_q + carry, F.lit(splits - 1))).cast("int")


def split_id_decimal(token, splits: int) -> Column:
    """Same as :func:`split_id` in decimal arithmetic; a slow cross-check."""
    splits = check_splits(splits)
    step = ring_step(splits)
    offset = _col(token).cast("decimal(20,0)") + _big(2 ** 63, 20)
    quotient = F.call_function("div", offset, _big(step, 20))
    return F.when(offset.isNotNull(), F.least(quotient, F.lit(splits - 1))).cast("int")


def in_range(token, start: int, end: int, end_inclusive: bool = False) -> Column:
    """Range predicate: low bound closed, high bound open (closed for the last range)."""
    tok = _col(token)
    upper = tok <= F.lit(end) if end_inclusive else tok < F.lit(end)
    return (tok >= F.lit(start)) & upper
