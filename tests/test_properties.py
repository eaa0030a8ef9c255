"""Property tests (Hypothesis) for the driver-side helpers."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ringcast.functions.tokens import MAX_TOKEN, MIN_TOKEN, MAX_SPLITS, range_bound, ring_step
from ringcast.operators.fanout import bind_markers
from ringcast.sinks.writer import EXTENSION_FORMATS, SinkError, output_format

names = st.from_regex(r"[A-Za-z_][A-Za-z0-9_]{0,8}", fullmatch=True)


@given(st.integers(1, MAX_SPLITS), st.data())
@settings(max_examples=300)
def test_ranges_are_contiguous_and_cover(splits, data):
    k = data.draw(st.integers(0, splits - 1))
    _, start, end, inclusive = range_bound(splits, k)
    assert start == MIN_TOKEN + k * ring_step(splits)
    if k == 0:
        assert start == MIN_TOKEN
    if k == splits - 1:
        assert end == MAX_TOKEN and inclusive
    else:
        assert not inclusive and end == range_bound(splits, k + 1)[1]
    assert start < end


@given(st.lists(st.one_of(names.map(lambda n: ("marker", n)),
                          st.text(alphabet="ab :?x", max_size=6).map(lambda t: ("quoted", t)),
                          names.map(lambda n: ("word", n))), max_size=8))
def test_bind_markers_only_touches_markers(parts):
    pieces, expected_used = [], []
    for kind, value in parts:
        if kind == "marker":
            pieces.append(f":{value}")
            if value not in expected_used:
                expected_used.append(value)
        elif kind == "quoted":
            pieces.append("'" + value.replace("'", "''") + "'")
        else:
            pieces.append(value)
    text = " ".join(pieces)
    out, used = bind_markers(text)
    # quoted literals survive unchanged, named markers are all bound
    for kind, value in parts:
        if kind == "quoted":
            assert "'" + value + "'" in out
    assert used == expected_used
    assert not re.search(r"(?<![:\w']):[A-Za-z_]", re.sub(r"'[^']*'", "", out))


@given(names, st.sampled_from(sorted(EXTENSION_FORMATS)), st.sampled_from([None, "parquet", "csv"]),
       st.booleans())
def test_known_extension_wins(stem, ext, fmt, slash):
    path = f"/out/{stem}.{ext}" + ("/" if slash else "")
    assert output_format(path, fmt) == EXTENSION_FORMATS[ext]


@given(names, st.from_regex(r"[a-z]{1,4}", fullmatch=True))
def test_unknown_extension_needs_format(stem, ext):
    path = f"/out/{stem}.{ext}"
    if ext in EXTENSION_FORMATS:
        return
    try:
        output_format(path)
        raised = False
    except SinkError:
        raised = True
    assert raised and output_format(path, "csv") == "csv"
