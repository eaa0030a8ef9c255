import os

import pytest

from ringcast.sources.params import ParamError, read_lines, read_params

MARKERS = {"region": "text", "min_age": "int"}


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)
    return folder


def _errors(spark, folder, markers=MARKERS):
    _, errors = read_params(spark, folder, markers, on_error="collect")
    return sorted((r.line, r.name, r.reason) for r in errors.collect())


def test_good_and_repeated_lines(spark, tmp_out):
    folder = _write(tmp_out, "p.ndjson", '{"region":"us-east","min_age":25}\n\n'
                                        '{"region":"us-east","min_age":25}\n')
    params = read_params(spark, folder, MARKERS)
    rows = sorted((r.param_set, r.region, r.min_age) for r in params.collect())
    assert rows == [(1, "us-east", 25), (3, "us-east", 25)]


@pytest.mark.parametrize("line,expected", [
    ("[1]", (1, None, "not a JSON object")),
    ('{"zone":"x","region":"a","min_age":1}', (1, "zone", "unknown key")),
    ('{"region":"b","min_age":null}', (1, "min_age", "null value")),
    ('{"region":"c","min_age":"25"}', (1, "min_age", "expected integer")),
    ('{"region":"c","min_age":25.5}', (1, "min_age", "expected integer")),
    ('{"region":"c","min_age":1.0}', (1, "min_age", "expected integer")),
    ('{"region":"c","min_age":3000000000}', (1, "min_age", "out of range for int")),
    ('{"region":"d"}', (1, "min_age", "missing key")),
    ("not json", (1, None, "invalid JSON")),
    ('{"region":"a","region":"b","min_age":1}', (1, None, "duplicate key")),
    ('{"region":5,"min_age":1}', (1, "region", "expected string")),
])
def test_bad_lines(spark, tmp_out, line, expected):
    folder = _write(tmp_out, "p.ndjson", line + "\n")
    assert _errors(spark, folder) == [expected]
    with pytest.raises(ParamError):
        read_params(spark, folder, MARKERS)


@pytest.mark.parametrize("mtype,good,bad", [
    ("timestamp", '"2024-01-15T10:30:00Z"', '"2024-01-15"'),
    ("timestamp", '"2024-01-15T10:30:00.123+02:00"', '"2024-01-15 10:30:00"'),
    ("blob", '"0aff"', '"zz"'),
    ("blob", '""', '"abc"'),
    ("uuid", '"00000000-0000-0000-0000-00000000000A"', '"x"'),
    ("inet", '"10.0.0.1"', '"300.1.1.1"'),
    ("inet", '"::1"', '"hello"'),
    ("date", "2147483648", "-1"),
    ("date", '"2024-02-29"', '"2023-02-29"'),
    ("time", "0", "86400000000000"),
    ("boolean", "true", '"true"'),
    ("tinyint", "-128", "128"),
    ("double", "1e3", '"1"'),
    ("ascii", '"abc"', '"\u00e9"'),
])
def test_typed_values(spark, tmp_out, mtype, good, bad):
    folder = _write(tmp_out, "p.ndjson", f'{{"x":{good}}}\n{{"x":{bad}}}\n')
    params, errors = read_params(spark, folder, {"x": mtype}, on_error="collect")
    assert params.count() == 1
    assert [(r.line, r.name) for r in errors.collect()] == [(2, "x")]


def test_typed_values_are_normalised(spark, tmp_out):
    folder = _write(tmp_out, "p.ndjson",
                    '{"t":"2024-01-15T10:30:00.1239Z","u":"{0000000000000000000000000000000A}",'
                    '"d":2147483648,"b":"0aff"}\n')
    row = read_params(spark, folder, {"t": "timestamp", "u": "uuid", "d": "date", "b": "blob"}).first()
    assert str(row.d) == "1970-01-01"
    assert row.u == "00000000-0000-0000-0000-00000000000a"
    assert bytes(row.b) == b"\x0a\xff"
    assert row.t.microsecond == 123000


def test_unsupported_type(spark, tmp_out):
    folder = _write(tmp_out, "p.ndjson", '{"x":1}\n')
    assert _errors(spark, folder, {"x": "varint"}) == [(1, "x", "unsupported type varint")]


def test_empty_file_gives_no_sets(spark, tmp_out):
    folder = _write(tmp_out, "p.ndjson", "")
    assert read_params(spark, folder, MARKERS).count() == 0


def test_line_numbers_per_file_count_blank_lines(spark, tmp_out):
    _write(tmp_out, "a.ndjson", "\n".join(["", "x1", "", "x2", "x3"]) + "\n")
    _write(tmp_out, "b.ndjson", "y1\n\ny2\n")
    lines = sorted((os.path.basename(r.file), r.line, r.text) for r in read_lines(spark, tmp_out).collect())
    assert lines == [("a.ndjson", 2, "x1"), ("a.ndjson", 4, "x2"), ("a.ndjson", 5, "x3"),
                     ("b.ndjson", 1, "y1"), ("b.ndjson", 3, "y2")]


def test_line_numbers_across_splits(spark, tmp_out):
    # A file cut into many input splits keeps its line numbers.
    n = 20000
    _write(tmp_out, "big.ndjson", "".join(f'{{"i":{i}}}\n' for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_lines(spark, tmp_out)
        got = df.selectExpr("line", "cast(get_json_object(text, '$.i') as int) AS i").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == n and all(r.line == r.i + 1 for r in got)


@pytest.mark.parametrize("text,ok", [
    ("::1", True), ("::", True), ("fe80::1", True), ("2001:db8:0:0:0:0:2:1", True),
    ("2001:DB8::8:800:200C:417A", True), ("::ffff:192.0.2.128", True), ("1::", True),
    (":::", False), ("1:2:3:4:5:6:7:8:9", False), ("1::2::3", False), ("12345::", False),
    ("1:2:3:4:5:6:7", False), ("g::1", False), (":1:2:3:4:5:6:7", False), ("1.2.3.4", True),
    ("01.2.3.4", False),
])
def test_inet_values(spark, tmp_out, text, ok):
    folder = _write(tmp_out, "p.ndjson", f'{{"ip":"{text}"}}\n')
    params, errors = read_params(spark, folder, {"ip": "inet"}, on_error="collect")
    assert (params.count() == 1) == ok


@pytest.mark.parametrize("text,canonical", [
    ("0:0:0:0:0:0:0:1", "::1"), ("::", "::"), ("2001:DB8:0:0:8:800:200C:417A", "2001:db8::8:800:200c:417a"),
    ("1:0:0:2:0:0:0:3", "1:0:0:2::3"), ("1:0:0:2:3:0:0:4", "1::2:3:0:0:4"), ("1:2:3:4:5:6:0:8", "1:2:3:4:5:6:0:8"),
    ("1::", "1::"), ("::FFFF:1.2.3.4", "::ffff:1.2.3.4"), ("::ffff:102:304", "::ffff:1.2.3.4"),
    ("64:ff9b::1.2.3.4", "64:ff9b::102:304"), ("1.2.3.4", "1.2.3.4"),
])
def test_inet_is_canonical(spark, tmp_out, text, canonical):
    folder = _write(tmp_out, "p.ndjson", f'{{"ip":"{text}"}}\n')
    assert read_params(spark, folder, {"ip": "inet"}).first().ip == canonical
