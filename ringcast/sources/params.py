"""Parameter files (S5, P1-P13): NDJSON, one object per line, typed checks.

A parameter file holds one JSON object per line; blank lines are skipped.
Each object binds named markers; ``markers`` declares each marker's type (the
reference takes them from the prepared statement). Every line is checked in
Spark, and problems are returned as an error table
``file, line, param_set, name, reason, text`` instead of stopping at the first.

The text is read once. Each line is parsed once, into a VARIANT wrapped with a
seal of its own (so text after the object cannot pass unseen); keys and value
types come from that value. The checked lines are stored with their place in
their input split, and line numbers (blank lines counted) are added from the
stored table: a small per-split table (one row per split) adds the rows of the
earlier splits of the same file, so no file goes through one task.

Deliberate differences from the reference: integers that do not fit the
marker's type are rejected instead of wrapped; a duplicate key is an error
instead of "last one wins"; an empty file gives no sets (the reference then
runs the query once without parameters).
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ringcast.functions.convert import date_from_raw
from ringcast.session import dealt, materialize

# Marker types accepted in parameter files, grouped by JSON form.
INTEGER_TYPES = {"tinyint": (-128, 127), "smallint": (-32768, 32767),
                 "int": (-2147483648, 2147483647),
                 "bigint": (-(2 ** 63), 2 ** 63 - 1), "counter": (-(2 ** 63), 2 ** 63 - 1)}
FLOAT_TYPES = {"float": "float", "double": "double"}
TEXT_TYPES = ("text", "ascii")
OTHER_TYPES = ("boolean", "uuid", "timeuuid", "inet", "timestamp", "date", "time", "blob")
SUPPORTED_TYPES = tuple(INTEGER_TYPES) + tuple(FLOAT_TYPES) + TEXT_TYPES + OTHER_TYPES
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
UUID_FORMS = (r"^(urn:uuid:)?\{?[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?"
              r"[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}\}?$")
IPV4 = r"^((25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$"
IPV6_CHARS = r"^[0-9a-fA-F:.]{2,45}$"
MARKER_NAME = r"^[A-Za-z_][A-Za-z0-9_]*$"  # bind markers are identifiers
FLOAT_LIMIT = 3.4028235677973366e38  # values from here on do not round to a finite float
NANOS_PER_DAY = 86_400_000_000_000


class ParamError(ValueError):
    pass


def _decoded_path(uri: Column) -> Column:
    """File path from the URI Spark reports ('%20' back to ' ', '+' kept)."""
    return F.url_decode(F.regexp_replace(uri, r"\+", "%2B"))


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines with their file, input split and place in the split's order."""
    return (spark.read.text(path)
            .select(_decoded_path(F.col("_metadata.file_path")).alias("__file"),
                    F.spark_partition_id().alias("__pid"), F.monotonically_increasing_id().alias("__mid"),
                    F.col("value").alias("__text")))


def _numbered(lines: DataFrame) -> DataFrame:
    """``__line`` and ``param_set`` for a stored table of placed lines, blank ones
    included: from one small row per (file, input split), a list no longer than
    the scan's own list of splits, which the driver holds anyway."""
    segments = (lines.groupBy("__file", "__pid")
                .agg(F.min("__mid").alias("start"), F.count(F.lit(1)).alias("rows"))).collect()
    in_file, overall, out = {}, 0, []
    for r in sorted(segments, key=lambda r: (r["__file"], r["start"])):
        out.append((r["__file"], r["__pid"], 1 + in_file.get(r["__file"], 0) - r["start"], 1 + overall - r["start"]))
        in_file[r["__file"]] = in_file.get(r["__file"], 0) + r["rows"]
        overall += r["rows"]
    offsets = lines.sparkSession.createDataFrame(out, "__file string, __pid int, to_line long, to_set long")
    return (lines.join(F.broadcast(offsets), ["__file", "__pid"])
            .withColumn("__line", F.col("__mid") + F.col("to_line"))
            .withColumn("param_set", F.col("__mid") + F.col("to_set"))
            .drop("__pid", "__mid", "to_line", "to_set"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of text files with ``file``, 1-based ``line`` and ``param_set``."""
    lines = _numbered(materialize(_placed_lines(spark, path), "lines"))
    return lines.filter(~_is_blank(F.col("__text"))).select(
        F.col("__file").alias("file"), F.col("__line").alias("line"), "param_set", F.col("__text").alias("text"))


def _is_blank(text: Column) -> Column:
    return text.rlike(r"^\s*$")


def _is_ipv6(s: Column) -> Column:
    """IPv6 text: at most one ``::``, groups of 1-4 hex digits, eight groups in
    all (fewer with ``::``), an IPv4 tail counting as two."""
    halves = F.split(s, "::", -1)
    compressed = F.size(halves) == 2
    groups = F.filter(F.split(F.regexp_replace(s, "::", ":"), ":", -1), lambda g: g != "")
    last = F.try_element_at(groups, F.lit(-1))
    # an IPv4 group counts as the tail only when it ends the text
    v4_tail = F.coalesce(last.rlike(IPV4) & ~s.endswith(":"), F.lit(False))
    hex_groups = F.when(v4_tail, F.slice(groups, 1, F.size(groups) - 1)).otherwise(groups)
    all_hex = F.forall(hex_groups, lambda g: g.rlike("^[0-9a-fA-F]{1,4}$"))
    width = F.size(hex_groups) + F.when(v4_tail, F.lit(2)).otherwise(F.lit(0))
    # ':' may only open or close the text as part of '::'
    edges_ok = ~(s.rlike("^:[^:]") | s.rlike("[^:]:$"))
    count_ok = F.when(compressed, width <= 7).otherwise(width == 8)
    return (s.rlike(IPV6_CHARS) & s.contains(":") & ~s.contains(":::")
            & (F.size(halves) <= 2) & edges_ok & F.coalesce(all_hex, F.lit(False)) & count_ok)


def _canonical_ipv6(s: Column) -> Column:
    """Canonical text of a valid lower-case IPv6 address: no leading zeros, the
    first longest run of two or more zero groups as ``::``, an IPv4-mapped
    address with its IPv4 tail."""
    octets = [F.regexp_extract(s, r"(\d+)\.(\d+)\.(\d+)\.(\d+)$", k).try_cast("int") for k in range(1, 5)]
    tail = F.concat(F.hex(octets[0] * 256 + octets[1]), F.lit(":"), F.hex(octets[2] * 256 + octets[3]))
    plain = F.when(s.contains("."), F.concat(F.regexp_extract(s, r"^(.*:)[^:]*$", 1), F.lower(tail))).otherwise(s)
    return _let(_let(plain, _ipv6_groups), _ipv6_text)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _ipv6_groups(plain: Column) -> Column:
    """The eight groups without leading zeros, joined by colons."""
    def groups_of(part: int) -> Column:
        return F.filter(F.split(F.split_part(plain, F.lit("::"), F.lit(part)), ":", -1), lambda g: g != "")

    left, right = groups_of(1), groups_of(2)
    fill = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.transform(F.concat(left, fill, right), lambda g: F.regexp_replace(g, "^0+(?=.)", "")), ":")


def _ipv6_text(text: Column) -> Column:
    padded = F.concat(F.lit(":"), text, F.lit(":"))
    run = F.lit(None).cast("string")  # the longest run of zero groups
    for length in range(2, 9):
        zeros = ":" + "0:" * length
        run = F.when(padded.contains(zeros), F.lit(zeros)).otherwise(run)

    def shortened(zeros: Column) -> Column:
        at = F.instr(padded, zeros)
        rest = F.substring(padded, at + F.length(zeros), F.length(padded))
        return F.concat(F.substring(padded, F.lit(2), F.greatest(at - 2, F.lit(0))), F.lit("::"),
                        F.regexp_replace(rest, ":$", ""))

    numbers = [F.conv(F.split_part(text, F.lit(":"), F.lit(k)), 16, 10).try_cast("int") for k in (7, 8)]
    mapped = F.concat(F.lit("::ffff:"), F.concat_ws(".", *[
        part.cast("string") for n in numbers for part in (F.shiftright(n, 8), n.bitwiseAND(255))]))
    return F.when(text.startswith("0:0:0:0:0:ffff:"), mapped).otherwise(F.coalesce(_let(run, shortened), text))


def _check_markers(markers: Mapping[str, str]) -> None:
    if not markers:
        raise ParamError("no markers declared")
    seen = set()
    for name in markers:
        if not isinstance(name, str) or not re.match(MARKER_NAME, name):
            raise ParamError(f"marker name must be an identifier, got {name!r}")
        if name.lower() == "param_set" or name.startswith("__"):
            raise ParamError(f"marker name {name!r} is reserved")
        if name.lower() in seen:  # column names are case-insensitive
            raise ParamError(f"marker {name!r} is declared twice (names ignore case)")
        seen.add(name.lower())


# Marker type of each Spark type a marker is compared with.
MARKER_TYPES = {"tinyint": "tinyint", "smallint": "smallint", "int": "int", "bigint": "bigint", "float": "float",
                "double": "double", "string": "text", "boolean": "boolean", "timestamp": "timestamp",
                "timestamp_ntz": "timestamp", "date": "date", "binary": "blob"}


def marker_type(spark_type: str) -> str:
    """Marker type for a Spark type; one without is named as it is (and refused as
    unsupported when a file binds it)."""
    return MARKER_TYPES.get(spark_type, spark_type)


def _integer(vtype: Column, as_dec: Column) -> Column:
    """True when the JSON value is an integer literal. Integers beyond 64 bits are
    decimals without a scale; within them such a decimal was written ``1.0``."""
    beyond = (as_dec < F.lit(-(2 ** 63))) | (as_dec > F.lit(2 ** 63 - 1))
    return (vtype == "BIGINT") | (vtype.rlike(r"^DECIMAL\(\d+,0\)$") & F.coalesce(beyond, F.lit(False)))


def _marker(mtype: str, item: Column, vtype: Column) -> tuple[Column, Column]:
    """``(typed value, error reason or null)`` for one marker's value of one line."""
    is_null = vtype == "VOID"

    def get(t: str) -> Column:
        return F.call_function("try_variant_get", item, F.lit("$"), F.lit(t))

    if mtype in INTEGER_TYPES:
        lo, hi = INTEGER_TYPES[mtype]
        as_dec = get("decimal(38,0)")
        err = (F.when(~_integer(vtype, as_dec), F.lit("expected integer"))
               .when((as_dec < F.lit(lo)) | (as_dec > F.lit(hi)), F.lit(f"out of range for {mtype}")))
        spark_t = {"counter": "bigint"}.get(mtype, mtype)
        value = get(spark_t)
    elif mtype in FLOAT_TYPES:
        ok = (vtype == "BIGINT") | (vtype == "DOUBLE") | vtype.startswith("DECIMAL")
        as_double = get("double")
        limit = FLOAT_LIMIT if mtype == "float" else float("inf")
        too_big = F.isnan(as_double) | (F.abs(as_double) >= F.lit(limit)) | (
            F.abs(as_double) == F.lit(float("inf")))
        err = (F.when(~ok, F.lit("expected number"))
               .when(too_big, F.lit(f"out of range for {mtype}")))
        value = get(FLOAT_TYPES[mtype])
    elif mtype in TEXT_TYPES:
        err = F.when(vtype != "STRING", F.lit("expected string"))
        if mtype == "ascii":
            err = F.coalesce(err, F.when(~get("string").rlike(r"^[\x00-\x7F]*$"),
                                         F.lit("expected ASCII string")))
        value = get("string")
    elif mtype == "boolean":
        err = F.when(vtype != "BOOLEAN", F.lit("expected boolean"))
        value = get("boolean")
    elif mtype in ("uuid", "timeuuid"):
        s = get("string")
        err = (F.when(vtype != "STRING", F.lit("expected string"))
               .when(~s.rlike(UUID_FORMS), F.lit("expected UUID")))
        hexed = F.lower(F.regexp_replace(s, r"^(urn:uuid:)|[{}\-]", ""))
        value = F.regexp_replace(hexed, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    elif mtype == "inet":
        s = get("string")
        err = (F.when(vtype != "STRING", F.lit("expected string"))
               .when(~(s.rlike(IPV4) | _is_ipv6(s)), F.lit("expected IP address")))
        value = F.when(s.contains(":"), _canonical_ipv6(F.lower(s))).otherwise(s)
    elif mtype == "timestamp":
        s = get("string")
        parsed = F.try_to_timestamp(F.upper(s))
        err = (F.when(vtype != "STRING", F.lit("expected string"))
               .when(~s.rlike(RFC3339) | parsed.isNull(), F.lit("expected RFC 3339 timestamp")))
        value = F.timestamp_millis(F.unix_millis(parsed))
    elif mtype == "date":
        as_dec = get("decimal(38,0)")
        s = get("string")
        iso = F.try_to_date(s, "yyyy-MM-dd")
        is_int = _integer(vtype, as_dec)
        err = (F.when(is_int & ((as_dec < 0) | (as_dec >= F.lit(2 ** 32))), F.lit("out of range for date"))
               .when(~is_int & ~((vtype == "STRING") & s.rlike(r"^\d{4}-\d{2}-\d{2}$") & iso.isNotNull()),
                     F.lit("expected integer day number or ISO date")))
        value = F.when(is_int, date_from_raw(get("bigint"))).otherwise(iso)
    elif mtype == "time":
        as_dec = get("decimal(38,0)")
        err = (F.when(~_integer(vtype, as_dec), F.lit("expected integer"))
               .when((as_dec < 0) | (as_dec >= F.lit(NANOS_PER_DAY)), F.lit("out of range for time")))
        value = get("bigint")
    elif mtype == "blob":
        s = get("string")
        err = (F.when(vtype != "STRING", F.lit("expected string"))
               .when(~s.rlike("^([0-9a-fA-F]{2})*$"), F.lit("expected hex")))
        value = F.unhex(s)
    else:
        return F.lit(None), F.lit(f"unsupported type {mtype}")
    err = F.when(is_null, F.lit("null value")).otherwise(err)
    return F.when(err.isNull(), value), err


def _opened(text: Column) -> tuple[Column, Column]:
    """``(members, line error)`` of a line: its keys with their values as VARIANTs,
    null with the reason why it is no single JSON object. The line is parsed
    inside an object that ends with a seal made of the line itself, so anything
    after the line's own value breaks the seal."""
    seal = F.xxhash64(text).cast("string")
    whole = F.try_parse_json(F.concat(F.lit('{"line":'), text, F.lit(',"seal":"'), seal, F.lit('"}')))
    sealed = F.call_function("try_variant_get", whole, F.lit("$.seal"), F.lit("string")) == seal
    members = F.call_function("try_variant_get", whole, F.lit("$.line"), F.lit("map<string,variant>"))
    members = F.when(sealed, members)
    # only for lines without members: what is wrong with them
    alone = F.try_parse_json(text)
    keys = F.json_object_keys(text)
    reason = (F.when(alone.isNull() & F.coalesce(F.size(keys) > F.size(F.array_distinct(keys)), F.lit(False)),
                     F.lit("duplicate key"))
              .when(alone.isNull(), F.lit("invalid JSON"))
              .when(~F.schema_of_variant(alone).startswith("OBJECT"), F.lit("not a JSON object"))
              .otherwise(F.lit("trailing content after the object")))
    return members, reason


def _checked(lines: DataFrame, markers: Mapping[str, str]) -> DataFrame:
    """The placed lines with the markers' typed values and ``__errors`` (null for
    blank lines; the text is kept for lines with errors only)."""
    names = list(markers)
    members, reason = _opened(F.col("__text"))
    blank = _is_blank(F.col("__text"))
    items = [F.col("__members")[F.lit(name)] for name in names]
    lines = lines.select("*", members.alias("__members"))
    lines = lines.select("*", *[F.schema_of_variant(item).alias(f"__type{i}") for i, item in enumerate(items)])
    values, wrong = [], []
    for i, (name, item) in enumerate(zip(names, items)):
        value, err = _marker(markers[name], item, F.col(f"__type{i}"))
        values.append(value.alias(name))
        wrong.append(F.when(item.isNotNull(), err).alias(f"__wrong{i}"))
    lines = lines.select("__file", "__pid", "__mid", "__text", "__members", *values, *wrong)
    # a good line has the declared keys and nothing wrong; only others are looked at closer
    good = F.size("__members") == len(names)
    for i, name in enumerate(names):
        good = good & F.col(f"__wrong{i}").isNull() & F.col("__members")[F.lit(name)].isNotNull()
    declared, keys = F.array(*[F.lit(n) for n in names]), F.map_keys("__members")
    entry = "struct<name:string,reason:string>"

    def named(some: Column, why: str) -> Column:
        return F.transform(some, lambda k: F.struct(k.alias("name"), F.lit(why).alias("reason")))

    marker_errors = [F.when(F.col(f"__wrong{i}").isNotNull(), F.struct(F.lit(name).alias("name"), F.col(f"__wrong{i}").alias("reason")))
                     for i, name in enumerate(names)]
    of_line = F.array(F.struct(F.lit(None).cast("string").alias("name"), reason.alias("reason")))
    of_members = F.filter(F.concat(F.array(*marker_errors), named(F.array_except(keys, declared), "unknown key"),
                                   named(F.array_except(declared, keys), "missing key")), lambda e: e.isNotNull())
    errors = (F.when(F.coalesce(good, F.lit(False)), F.array().cast(f"array<{entry}>")).when(blank, F.lit(None))
              .when(F.col("__members").isNull(), of_line).otherwise(of_members))
    lines = lines.select("__file", "__pid", "__mid", "__text", *names, errors.alias("__errors"))
    return lines.withColumn("__text", F.when(F.size("__errors") > 0, F.col("__text")))


def parse_params(spark: SparkSession, path: str, markers: Mapping[str, str]) -> tuple[DataFrame, DataFrame, int]:
    """Typed parameter sets, the error table and the number of lines with errors.

    The checked lines are written once to the shared checkpoint folder and read
    back, which parses each line exactly once: the sets, the error table, the size
    check before a broadcast and the join all read the stored table. Lines with
    errors are counted while it is written.
    """
    _check_markers(markers)
    bad = Observation("ringcast_params")
    checked = _checked(dealt(_placed_lines(spark, path), "__mid"), markers)
    checked = materialize(checked.observe(bad, F.count_if(F.size("__errors") > 0).alias("lines")), "params")
    lines = _numbered(checked)
    params = lines.filter(F.size("__errors") == 0).select("param_set", *markers)
    errors = (lines.filter(F.size("__errors") > 0)
              .select("__file", "__line", "param_set", "__text", F.explode("__errors").alias("e"))
              .select(F.col("__file").alias("file"), F.col("__line").alias("line"), "param_set",
                      "e.name", "e.reason", F.col("__text").alias("text")))
    return params, errors, int(bad.get.get("lines") or 0)


def read_params(spark: SparkSession, path: str, markers: Mapping[str, str],
                on_error: str = "raise") -> DataFrame | tuple[DataFrame, DataFrame]:
    """Parameter sets of an NDJSON file (or folder of files).

    ``on_error="raise"`` fails with the first errors listed (the reference
    stops at the first bad line); ``"collect"`` returns ``(params, errors)``.
    """
    params, errors, bad = parse_params(spark, path, markers)
    if on_error == "collect":
        return params, errors
    if on_error != "raise":
        raise ValueError("on_error must be 'raise' or 'collect'")
    if bad:
        first = errors.orderBy("file", "line").limit(5).collect()
        detail = "; ".join(f"{r['file']} line {r['line']}: {r['name'] or '-'}: {r['reason']}"
                           for r in first)
        raise ParamError(f"invalid parameter file, {errors.count()} errors: {detail}")
    return params
