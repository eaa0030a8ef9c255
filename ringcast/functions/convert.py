"""Type conversion as column expressions (C1-C21, §1.4).

The reference converts each database value into an Arrow array element; a
value of the wrong runtime type becomes null. Here every conversion is a
Spark SQL expression (``try_cast`` by default, plain ``cast`` under ANSI when
``strict``), so it runs inside generated code with no Python per row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ringcast.functions.nested import convert_nested, target_type, type_tree

# The source type names and the Spark type each maps to.
SOURCE_TYPES = {
    "tinyint": "tinyint",
    "smallint": "smallint",
    "int": "int",
    "bigint": "bigint",
    "counter": "bigint",
    "float": "float",
    "double": "double",
    "boolean": "boolean",
    "text": "string",
    "ascii": "string",
    "blob": "binary",
    "timestamp": "timestamp",
    "date": "date",
    "time": "bigint",
    "uuid": "string",
    "timeuuid": "string",
    "inet": "string",
    "varint": "string",
    "decimal": "string",
    "duration": "string",
}
# Source types whose values have a text form in text columns; all others give null.
STRINGIFIABLE = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean",
                 "text", "ascii", "uuid", "timeuuid", "inet", "varint", "decimal", "duration")
DATE_EPOCH_OFFSET = 2 ** 31  # raw date value of 1970-01-01
NANOS_PER_DAY = 86_400_000_000_000
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cast_to(col, spark_type: str, strict: bool = False) -> Column:
    """``try_cast`` (mismatch → null, the reference's rule) or strict ``cast``."""
    c = _c(col)
    return c.cast(spark_type) if strict else c.try_cast(spark_type)


def to_tinyint(col, strict=False):
    return cast_to(col, "tinyint", strict)


def to_smallint(col, strict=False):
    return cast_to(col, "smallint", strict)


def to_int(col, strict=False):
    return cast_to(col, "int", strict)


def to_bigint(col, strict=False):
    return cast_to(col, "bigint", strict)


def to_float(col, strict=False):
    return cast_to(col, "float", strict)


def to_double(col, strict=False):
    return cast_to(col, "double", strict)


def to_boolean(col, strict=False):
    return cast_to(col, "boolean", strict)


def blob_to_hex(col) -> Column:
    """Text form of a blob (C9): upper-case hex."""
    return F.hex(_c(col))


def hex_to_blob(col) -> Column:
    """Blob from hex text; null for text that is not even-length hex."""
    c = _c(col)
    ok = c.rlike("^([0-9a-fA-F]{2})*$")
    return F.when(ok, F.unhex(c))


# Largest |epoch ms| whose microseconds fit a Spark timestamp.
MAX_TIMESTAMP_MS = (2 ** 63 - 1) // 1000


def _ms_in_range(ms: Column) -> Column:
    """The value itself when a timestamp can hold it, else null (guarding the
    argument, not the result, also holds when Catalyst folds constants)."""
    return F.when((ms >= F.lit(-MAX_TIMESTAMP_MS)) & (ms <= F.lit(MAX_TIMESTAMP_MS)), ms)


def checked(result: Column, col, what: str, strict: bool) -> Column:
    """``result``; with ``strict`` a value that has no result raises."""
    if not strict:
        return result
    c = _c(col)
    return F.when(result.isNotNull() | c.isNull(), result).otherwise(
        F.raise_error(F.concat(F.lit(f"not a {what}: "), c.cast("string"))))


def timestamp_from_millis(col, strict: bool = False) -> Column:
    """Timestamp (UTC instant) from epoch milliseconds (C10); null when the value
    is outside what a Spark timestamp holds (an error when ``strict``)."""
    c = _c(col)
    return checked(F.timestamp_millis(_ms_in_range(c.try_cast("bigint"))), c, "timestamp in milliseconds", strict)


def timestamp_ntz_from_millis(col) -> Column:
    """Wall-clock UTC timestamp without zone from epoch milliseconds; independent
    of the session time zone; null when out of range."""
    ms = _ms_in_range(_c(col).try_cast("bigint"))
    return F.timestamp_add("MICROSECOND", ms * F.lit(1000),
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def epoch_micros_ntz(col) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` (zone independent)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(col))


def floor_millis_ntz(col) -> Column:
    """A ``timestamp_ntz`` cut to millisecond precision, flooring."""
    micros = epoch_micros_ntz(col)
    ms = F.call_function("div", micros, F.lit(1000)) - F.when(micros % 1000 < 0, 1).otherwise(0)
    return timestamp_ntz_from_millis(ms)


def date_from_raw(col, strict: bool = False) -> Column:
    """Date from the raw unsigned day number with 1970-01-01 at 2^31 (C11).

    Values before 1970 (raw < 2^31) work too; raw values outside the unsigned
    32-bit range, or values that are not integers, give null (an error when
    ``strict``).
    """
    raw = cast_to(col, "bigint", strict)
    ok = (raw >= 0) & (raw < F.lit(2 ** 32))
    days = F.when(ok, raw - F.lit(DATE_EPOCH_OFFSET)).cast("int")
    return checked(F.date_add(F.lit("1970-01-01").cast("date"), days), col, "raw date", strict)


def raw_from_date(col) -> Column:
    return (F.datediff(_c(col), F.lit("1970-01-01").cast("date")).cast("bigint")
            + F.lit(DATE_EPOCH_OFFSET))


def time_ns_of_day(col) -> Column:
    """Nanoseconds since midnight of a timestamp_ntz (C12, ``time`` values)."""
    c = _c(col)
    midnight = F.to_date(c).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", midnight, c) * F.lit(1000)


def format_time_ns(col) -> Column:
    """``HH:mm:ss.nnnnnnnnn`` text of nanoseconds since midnight; null outside a day."""
    ns = _c(col).cast("bigint")
    secs = F.call_function("div", ns, F.lit(1_000_000_000))
    frac = ns % F.lit(1_000_000_000)
    text = F.format_string("%02d:%02d:%02d.%09d",
                           F.call_function("div", secs, F.lit(3600)),
                           F.call_function("div", secs % 3600, F.lit(60)),
                           secs % 60, frac)
    return F.when((ns >= 0) & (ns < F.lit(NANOS_PER_DAY)), text)


UUID_TEXT = (r"^[0-9a-fA-F]{8}(-?)[0-9a-fA-F]{4}\1[0-9a-fA-F]{4}\1[0-9a-fA-F]{4}\1"
             r"[0-9a-fA-F]{12}$")


def uuid_text(col) -> Column:
    """Lower-case 8-4-4-4-12 text from UUID text or 32 hex digits (C13); null for
    anything else. For 16-byte binary values use :func:`uuid_from_binary`."""
    text = _c(col).cast("string")
    hexed = F.lower(F.regexp_replace(text, "-", ""))
    return F.when(text.rlike(UUID_TEXT),
                  F.regexp_replace(hexed, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def uuid_from_binary(col) -> Column:
    return uuid_text(F.hex(_c(col)))


def is_uuid(col) -> Column:
    return _c(col).rlike(UUID_PATTERN)


def varint_text(col) -> Column:
    """Numeric text of an arbitrary-precision integer (C15), any number of
    digits: integer text, integral decimals (``5.00``) and integral doubles
    (``1.0E20``); null for anything else."""
    text = F.regexp_replace(_c(col).cast("string"), r"^\s+|\s+$", "")
    plain = F.regexp_extract(text, r"^([+-]?[0-9]+)(?:\.0*)?\z", 1)  # '' when no match
    digits = F.regexp_replace(F.regexp_replace(plain, r"^\+", ""), r"^(-?)0+(?=[0-9])", "$1")
    # exponent form: move the point over the digits, any number of them
    form = r"^([+-]?)([0-9]*)\.?([0-9]*)[eE]([+-]?[0-9]{1,6})\z"
    part = lambda k: F.regexp_extract(text, form, k)
    mantissa = F.concat(part(2), part(3))
    cut = F.length(part(2)) + part(4).try_cast("int")  # digits before the point
    zeros = F.repeat(F.lit("0"), F.greatest(cut - F.length(mantissa), F.lit(0)))
    whole = F.concat(F.when(cut > 0, F.substring(mantissa, F.lit(1), F.greatest(cut, F.lit(0)))).otherwise(F.lit("0")), zeros)
    rest = F.when(cut > 0, F.substring(mantissa, F.greatest(cut, F.lit(0)) + 1, F.length(mantissa))).otherwise(mantissa)
    exponent = F.when((mantissa != "") & rest.rlike(r"^0*\z"), F.concat(
        F.when(part(1) == "-", F.lit("-")).otherwise(F.lit("")), F.regexp_replace(whole, r"^0+(?=[0-9])", "")))
    out = F.when(plain != "", digits).otherwise(exponent)
    return F.when(out == "-0", F.lit("0")).otherwise(out)


def decimal_text(col) -> Column:
    """Plain numeric text of a decimal."""
    return _c(col).cast("string")


def duration_text(months, days, nanos) -> Column:
    """``{months}mo{days}d{nanos}ns`` (C17)."""
    return F.concat(_c(months).cast("string"), F.lit("mo"), _c(days).cast("string"), F.lit("d"),
                    _c(nanos).cast("string"), F.lit("ns"))


def list_of(col, element_type: str, strict: bool = False) -> Column:
    """List conversion (C18): wrong-typed elements become null, the list stays."""
    if strict:
        return F.transform(_c(col), lambda x: x.cast(element_type))
    return F.transform(_c(col), lambda x: x.try_cast(element_type))


def set_of(col, element_type: str | None = None) -> Column:
    """Set conversion: distinct elements in sorted order (stable output)."""
    c = _c(col) if element_type is None else list_of(col, element_type)
    return F.array_sort(F.array_distinct(c))


def map_text_text(col) -> Column:
    """``map<text,text>`` (C19): keys and values as text."""
    return F.transform_values(F.transform_keys(_c(col), lambda k, v: k.cast("string")),
                              lambda k, v: v.cast("string"))


def map_to_text(col, sep: str = ",") -> Column:
    """Sorted ``key=value`` text of a map (stable form for checks and text sinks)."""
    entries = F.array_sort(F.map_entries(_c(col)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"].cast("string"), F.lit("="),
                                                                e["value"].cast("string"))), sep)


def list_to_text(col, sep: str = ",") -> Column:
    return F.array_join(F.transform(_c(col), lambda x: x.cast("string")), sep)


def stringify(col, source_type: str) -> Column:
    """Text form of a scalar inside a text column.

    Types with a text form in the reference are cast; all others (timestamp,
    date, time, blob, counter, nested) give null. Doubles keep Spark's form
    (``95.0``, ``1.0E20``).
    """
    if source_type not in STRINGIFIABLE:
        return F.lit(None).cast("string")
    return _c(col).cast("string")


def stringify_list(col, element_type: str) -> Column:
    """A list inside a text list column: elements with a text form become text,
    others become null elements; a null list stays null."""
    if element_type not in STRINGIFIABLE:
        return F.transform(_c(col), lambda x: F.lit(None).cast("string"))
    return F.transform(_c(col), lambda x: x.cast("string"))


def stringify_map_values(col, value_type: str) -> Column:
    """Map values inside a text map: as :func:`stringify_list`, keys as text."""
    keyed = F.transform_keys(_c(col), lambda k, v: k.cast("string"))
    if value_type not in STRINGIFIABLE:
        return F.transform_values(keyed, lambda k, v: F.lit(None).cast("string"))
    return F.transform_values(keyed, lambda k, v: v.cast("string"))


def convert_column(col, source_type: str, strict: bool = False,
                   data_type: T.DataType | None = None) -> Column:
    """Convert one column to the Spark type of ``source_type``; ``data_type`` is
    the column's current type when known: binary UUIDs are hex-encoded,
    numeric timestamps read as epoch milliseconds, digit-only text dates as
    raw day numbers (:func:`convert_columns` passes it)."""
    if "<" in source_type:  # list, set, map and frozen, to any depth
        return convert_nested(_c(col), type_tree(source_type), data_type,
                              lambda c, name, kind: convert_column(c, name, strict, kind), spark_type, strict)
    if source_type not in SOURCE_TYPES:
        raise ValueError(f"unsupported source type {source_type!r}")
    target = SOURCE_TYPES[source_type]
    if source_type == "date":
        if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return cast_to(col, "date", strict)
        if isinstance(data_type, T.StringType):  # raw day number as text, or an ISO date
            c = _c(col)
            return F.when(c.rlike(r"^\s*[0-9]+\s*$"), date_from_raw(c, strict)).otherwise(
                cast_to(c, "date", strict))
        return date_from_raw(col, strict)
    if source_type == "timestamp":
        if isinstance(data_type, T.NumericType):  # raw values are epoch milliseconds
            return timestamp_from_millis(cast_to(col, "bigint", strict), strict)
        return cast_to(col, "timestamp", strict)
    if source_type in ("uuid", "timeuuid"):
        if isinstance(data_type, T.BinaryType):
            return checked(uuid_from_binary(col), F.hex(_c(col)), "UUID", strict)
        return checked(uuid_text(col), col, "UUID", strict)
    if source_type == "varint":
        return checked(varint_text(col), col, "whole number", strict)
    return cast_to(col, target, strict)


def convert_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Apply :func:`convert_column` to the named columns, keep the others."""
    unknown = [c for c in types if c not in df.columns]
    if unknown:
        raise ValueError(f"columns not in the data: {unknown}")
    fields = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[convert_column(F.col(f"`{c}`"), types[c], strict, fields[c]).alias(c)
                       if c in types else F.col(f"`{c}`") for c in df.columns])


def spark_type(source_type: str) -> T.DataType:
    """The Spark type that :func:`convert_column` gives a source type."""
    if "<" in source_type:
        return target_type(type_tree(source_type), spark_type)
    if source_type not in SOURCE_TYPES:
        raise ValueError(f"unsupported source type {source_type!r}")
    return T.DataType.fromDDL(SOURCE_TYPES[source_type])
