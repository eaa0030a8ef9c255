"""Operators on small tables: brute force, edge cases, round trips."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ringcast.llm import (classifier, jaccard, langid, line_dedup, packing, pieces, quality_rules, substring, topk,
                          warc, words)
from ringcast.llm.ship import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, words string, hits string"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def texts(seed=1, n=60):
    """Texts with exact and near copies, shared passages, repeated lines, odd spaces."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "the", "été", "a b", "#$", "it's"]
    base = " ".join(rng.choice(vocabulary) for _ in range(80))
    passage = "\n".join(" ".join(rng.choice(vocabulary) for _ in range(20)) for _ in range(4))
    out = []
    for i in range(n):
        own = "\n".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(1, 9)))
        kind = i % 6
        if kind == 0:
            w = base.split(" ")
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            own = " ".join(w)
        elif kind == 1:
            own = own + "\n" + passage + "\n" + own
        elif kind == 2 and i > 6:
            own = out[rng.randrange(len(out))]
        out.append(own)
    return out + ["", " \n\t", "one", "two words", "same " * 300, "x" * 5000, "tail  \n\n", " wide　space "]


def table(spark, some=None):
    rows = [(i, t, "en", "s", len(t), 1, "w", "h") for i, t in enumerate(texts() if some is None else some)]
    rows += [(len(rows), None, None, None, None, None, None, None), (None, "one two three four", "en", "s", 1, 1, "w", "h")]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def split(text):
    return (text or "").encode().split()


def test_word_splitting_and_hashes():
    import pyarrow as pa

    some = texts(3)
    found = []
    for _, data, offsets in words.chunks([pa.record_batch({"text": pa.array(some + [None])})], size=300):
        starts, ends, first = words.find_words(data, offsets)
        raw = data.tobytes()
        h = words.hash_spans(data, starts, ends)
        for a, b in zip(first[:-1], first[1:]):
            found.append([(raw[s:e], x) for s, e, x in zip(starts[a:b], ends[a:b], h[a:b])])
    assert [[w for w, _ in one] for one in found] == [split(t) for t in some + [None]]
    pairs = {x for one in found for x in one}
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})


def shingle_set(text, width):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return frozenset(tuple(w[j:j + width]) for j in range(max(len(w) - width + 1, 1))) if w else frozenset()


@pytest.mark.parametrize("width,num,light", [(3, 90, 24), (5, 80, 24), (2, 60, 2)])
def test_jaccard_components(spark, width, num, light):
    docs = table(spark)
    got = {(r.doc_id, r.n_shingles): r.component_id
           for r in jaccard.jaccard_components(docs, width, num, 100, light).collect()}
    rows = [(r.doc_id, shingle_set(r.text, width)) for r in docs.collect()]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if a and b and 100 * len(a & b) >= num * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    want = {(d, len(s)): min((x for x in groups[find(i)] if x is not None), default=None)
            for i, (d, s) in enumerate(rows)}
    assert got == want
    kept = jaccard.one_per_component(docs, width, num, 100)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {v for v in want.values() if v is not None}
    assert jaccard.jaccard_components(empty(spark)).count() == 0


def test_jaccard_links_through_rows_without_doc_id(spark):
    w = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(w)), (None, " ".join(w + ["x"] * 3)), (2, " ".join(["y"] * 3 + w + ["x"] * 3)), (3, "other words here"),
            (None, "one more text"), (None, "one more text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    n = [len(shingle_set(t, 2)) for _, t in rows]
    a, b, c = (shingle_set(t, 2) for _, t in rows[:3])
    num = 92
    assert 100 * len(a & b) >= num * len(a | b) and 100 * len(b & c) >= num * len(b | c) and 100 * len(a & c) < num * len(a | c)
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 2, num, 100).collect()
                 if r.component_id is not None)
    assert got == [(0, n[1], 1), (1, n[0], 1), (2, n[2], 1), (3, n[3], 3)]


def test_choose_level_lengthens_when_it_costs_little():
    assert jaccard.choose_level(np.array([1000, 1000, 1, 1, 1, 1]), 6, 5) > 1
    assert jaccard.choose_level(np.array([1, 1, 10_000, 10_000, 10_000, 10_000]), 6, 5) == 1


def without_windows(rows, size):
    seen, out = {}, {}
    for doc_id, text in sorted(rows):
        w = split(text)
        keep = [True] * len(w)
        for j in range(len(w) - size + 1):
            if seen.setdefault(tuple(w[j:j + size]), doc_id) < doc_id:
                keep[j:j + size] = [False] * size
        out[doc_id] = (w, keep)
    return out


@pytest.mark.parametrize("size,hot", [(13, 20_000), (6, 20_000), (6, 2)])
def test_substring_digest(spark, monkeypatch, size, hot):
    monkeypatch.setattr(substring, "HOT_ANCHOR", hot)
    docs = table(spark)
    got = {r.doc_id: r for r in substring.substring_digest(docs, size).collect()}
    want = without_windows([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None], size)
    for doc_id, (w, keep) in want.items():
        kept = b" ".join(x for x, k in zip(w, keep) if k)
        r = got[doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), keep.count(False), hashlib.sha256(kept).hexdigest())
    assert got[None].n_removed == 0
    dropped = substring.drop_repeats(docs, size)
    assert dropped.columns == docs.columns
    left = {r.doc_id: split(r.text) for r in dropped.collect()}
    for doc_id, (w, keep) in want.items():
        if w and not any(keep):
            assert doc_id not in left
        else:
            assert left[doc_id] == [x for x, k in zip(w, keep) if k]
    assert substring.substring_digest(empty(spark)).count() == 0


def test_fm_index_counts_patterns():
    rng = np.random.default_rng(5)
    text = rng.integers(1, 6, 500)
    index = substring.FMIndex(text, 8)
    for _ in range(50):
        at, n = int(rng.integers(0, 480)), int(rng.integers(1, 9))
        pattern = text[at:at + n]
        lo, hi = index.first[pattern[-1:]], index.first[pattern[-1:] + 1]
        for c in pattern[-2::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        want = sum((text[i:i + n] == pattern).all() for i in range(len(text) - n + 1))
        assert int(hi[0] - lo[0]) == want


@pytest.mark.parametrize("size,kinds", [(3, 4), (4, 2), (13, 30), (16, 3)])
def test_matching_statistics(size, kinds):
    """Every place whose next ``size`` symbols occur twice, with the smallest owner of the interval."""
    rng = np.random.default_rng(size)
    runs = [rng.integers(0, kinds, int(rng.integers(size, size + 40))) for _ in range(60)]
    runs += [np.concatenate([runs[i][-size:], rng.integers(0, kinds, 5), runs[i + 1][:size + 2]]) for i in range(20)]
    runs += [np.zeros(3 * size, dtype=np.int64)]
    flat, lengths = np.concatenate(runs).astype(np.uint64), np.array([len(r) for r in runs])
    owner = rng.permutation(len(runs)).astype(np.int64)
    seen = {}
    for r, o in zip(runs, owner.tolist()):
        for i in range(len(r) - size + 1):
            key = tuple(r[i:i + size].tolist())
            seen[key] = min(seen.get(key, o), o)
    want = [seen[tuple(r[i:i + size].tolist())] for r in runs for i in range(len(r) - size + 1)]
    assert substring.shard_matches(flat, lengths, owner, size).tolist() == want


def test_compressed_bitmaps():
    rng = np.random.default_rng(2)
    for bits in (rng.random(1000) < 0.5, np.zeros(640, bool), np.ones(700, bool), np.repeat(rng.random(12) < 0.5, 100)):
        at = np.arange(len(bits) + 1)
        assert (substring.Bits(bits).ones(at) == np.concatenate([[0], np.cumsum(bits)])).all()
        marks = bits.copy()
        marks[0] = True
        borders = substring.Borders(len(bits), 1)
        borders.add(0, np.arange(len(bits)) == 0)
        borders.add(1, marks)
        lo, hi = borders.around(np.ones(len(bits), dtype=np.int64), np.arange(len(bits)))
        where = np.flatnonzero(marks)
        place = np.searchsorted(where, np.arange(len(bits)), side="right")
        assert (lo == where[place - 1]).all() and (hi == np.append(where, len(bits))[place]).all()
    assert len(substring.Bits(np.repeat([True, False], 6400)).stored) == 2  # runs take no words


def test_line_dedup(spark):
    docs = table(spark)
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.text is not None)
    seen, want = set(), {}
    for doc_id, text in rows:
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if x.encode().split()]
        gone = set()
        for j in range(len(at) - 2):
            key = tuple(lines[i] for i in at[j:j + 3])
            if key in seen:
                gone |= set(at[j:j + 3])
            seen.add(key)
        want[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    out = line_dedup.line_dedup(docs, words=None)
    got = {r.doc_id: r.text for r in out.collect()}
    assert {k: v for k, v in got.items() if k in want} == want
    assert out.count() == docs.count() and any(want[i] != t for i, t in rows)
    assert line_dedup.without_repeats(docs).columns == docs.columns
    assert line_dedup.without_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("words", [20, 50])
def test_line_dedup_of_short_runs(spark, words):
    passage = " ".join(f"p{i}" for i in range(words))
    half = " ".join(f"q{i}" for i in range(words // 2))
    planted = [passage, "a\n" + passage + "\nb", passage, passage + "\n \nshort", half + "\n" + half + "x", "c\n\n" + half + "\n" + half + "x",
               half, half, passage[:-3] + "\nd", passage[:-3] + "\ne", passage + "\n" + passage + "\n" + passage]
    docs = table(spark, texts() + planted)
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.text is not None)
    seen, want = set(), {}
    for doc_id, text in rows:
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if x.encode().split()]
        gone = set()
        for n in (1, 2, 3):
            for j in range(len(at) - n + 1):
                key = tuple(lines[i] for i in at[j:j + n])
                if n < 3 and sum(len(x.encode().split()) for x in key) < words:
                    continue
                if key in seen:
                    gone |= set(at[j:j + n])
                seen.add(key)
        want[doc_id] = (len(at), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    out = {r.doc_id: (r["__n_lines"], r["__n_removed"], r.text) for r in line_dedup.line_dedup(docs, words=words).collect()}
    assert {k: v for k, v in out.items() if k in want} == want
    start = len(texts())
    assert [want[start + i][1] for i in range(11)] == [0, 1, 1, 1, 0, 2, 0, 0, 0, 0, 3]
    left = {r.doc_id for r in line_dedup.without_repeats(docs, words=words).collect()}
    assert start in left and start + 2 not in left


def test_line_dedup_as_registered(spark):
    """The four documents that three-line windows alone miss; a third of all documents share one line and one run."""
    long = " ".join(f"w{i}" for i in range(60))
    two = " ".join(f"u{i}" for i in range(30)) + "\n" + " ".join(f"v{i}" for i in range(30))
    docs = [long, long, two, two] + [f"own {i}\nhot\nhot 2\nhot 3\nhot 4\nlast {i}" if i % 3 == 0 else f"a {i}\nb {i}\nc {i}" for i in range(300)]
    out = {r.doc_id: r for r in line_dedup.line_dedup(table(spark, docs)).collect()}
    assert [out[i]["__n_removed"] for i in range(4)] == [0, 1, 0, 2]
    hot = [out[4 + i]["__n_removed"] for i in range(300) if i % 3 == 0]
    assert hot == [0] + [4] * 99
    assert all(out[4 + i]["__n_removed"] == 0 for i in range(300) if i % 3)
    assert sorted(r.doc_id for r in line_dedup.without_repeats(table(spark, docs[:4])).collect() if r.doc_id is not None) == [0, 2, 4]
    with pytest.raises(ValueError, match="taken"):
        line_dedup.line_dedup(table(spark).withColumn("__hits", F.lit(1)))


def test_line_dedup_fingerprints_cover_every_window(spark):
    docs = table(spark)
    rows = {r.doc_id: [x for x in r.text.split("\n") if x.encode().split()] for r in docs.collect() if r.doc_id is not None and r.text}
    marks = {}
    for r in line_dedup.fingerprints(docs, words=None).collect():
        marks.setdefault(r.doc_id, set()).add(r.place)
    for doc_id, lines in rows.items():
        for i in range(len(lines) - 2):
            assert marks[doc_id] & {i, i + 1, i + 2}
    assert sum(map(len, marks.values())) < 0.8 * sum(map(len, rows.values()))


def test_null_and_empty_language_are_two_strata(spark):
    """Null and '' have cutoffs of their own: what one's labels prove is not used in the other."""
    good, bad = " ".join(["word"] * 3 + [f"plain{i}" for i in range(30)]), " ".join(["# # #"] * 40)
    rows, marks = [], []
    for i in range(8000):
        rows.append((i, good if i % 2 else bad, None if i < 4000 else ""))
        # with an empty language the rule would reject good documents
        marks.append((i, i % 2 if i < 4000 else 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    found = quality_rules.features(docs)
    cut = {r.stratum: r.cut_symbols for r in quality_rules.cutoffs(found, labels).collect()}
    assert set(cut) <= {"-", "="} and cut["-"] is not None and cut.get("=") is None
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality_rules.quality_rules(docs, labels).collect()}
    assert not any(kept[i][0] for i in range(0, 4000, 2))


def test_quality_rules_edges_and_bound(spark):
    docs = table(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(3, 0, 0), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in quality_rules.quality_rules(docs, labels).collect()}
    assert len(out) == docs.count()
    for r in docs.collect():
        w = (r.text or "").encode().split()
        runs = [tuple(w[j:j + 5]) for j in range(len(w) - 4)]
        cover = {k for j, x in enumerate(runs) if runs.count(x) > 1 for k in range(j, j + 5)}
        lines = [x for x in (r.text or "").split("\n") if x.encode().split()]
        assert (out[r.doc_id].n_words, out[r.doc_id].n_repeat_words, out[r.doc_id].n_dup_lines,
                out[r.doc_id].word_chars) == (len(w), len(cover), len(lines) - len(set(lines)),
                                              sum(len(x.decode()) for x in w))
        assert out[r.doc_id].base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w))
    # forty labels prove nothing at 0.4 %: only the base rules reject
    assert all(r.kept != r.base_failed for r in out.values())
    assert quality_rules.keep_good(docs, labels.limit(0)).columns == docs.columns
    assert quality_rules.quality_rules(empty(spark), labels).count() == 0


def test_binomial_bound_is_exact(spark):
    from math import comb, log

    cases = [(2000.0, 0.0), (2000.0, 1.0), (2000.0, 5.0), (500.0, 1.0), (60.0, 0.0), (9000.0, 30.0)]
    df = spark.createDataFrame(cases, "n double, k double").select("n", "k", quality_rules.log_binomial_cdf("n", "k", "0.004D").alias("v"))
    for r in df.collect():
        n, k = int(r.n), int(r.k)
        want = log(sum(comb(n, i) * 0.004 ** i * 0.996 ** (n - i) for i in range(k + 1))) if k < n * 0.004 else 0.0
        assert r.v == pytest.approx(want, abs=1e-8)


def test_warc_round_trip(spark):
    rows = [(1, "u1", "<p>a</p>"), (2, "u2", "<p>a</p>"), (3, None, None), (4, "u4", ""), (5, "u\r\n5", "é" * 2000),
            (6, "u6", "<p>a</p>"), (6, "u6", "<p>a</p>"), (None, "u7", "é" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    got = warc.round_trip(pages).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert (by[1].record_type, by[1].refers_to, by[2].refers_to) == ("revisit", 6, 6)
    assert [r.record_type for r in got if r.page_id == 6] == ["response"] * 2
    assert (by[3].record_type, by[3].refers_to, by[4].record_type) == ("revisit", 4, "response")
    assert (by[None].record_type, by[None].refers_to, by[None].payload_bytes) == ("revisit", 5, 4000)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_frames_and_dictionary():
    import io
    import struct

    records = [warc.record(i, f"http://x/{i}", f"<html>{'same words ' * 20}{i}</html>".encode(), None, False) for i in range(200)]
    raw = b"".join(warc.archive_bytes_of(records))
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and size > 0
    assert list(warc.read_archive(io.BytesIO(raw))) == records
    assert warc.parse(records[7])["page_id"] == 7
    with pytest.raises(ValueError):
        warc.parse(records[7].replace(b"same words", b"other word", 1))


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 12)]) for i in range(300)]
    vectors += [(i, vectors[7][1]) for i in range(300, 360)]  # one very common vector
    part = [(401, []), (404, [0.0] * 12 + [1e30]), (500, [0.5, -0.5]), (101, vectors[101][1]), (100, vectors[100][1]), (450, [])]
    odd = part + [(400, None), (402, [1.0, None]), (403, [float("nan")] * 12), (None, [0.1] * 12)]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    got = [tuple(r) for r in topk.top_k(df, "vec_id % 50 = 0", k=7).orderBy("query_id", "rank").collect()]
    whole = [(i, [math.floor(1024 * x) for x in np.array(v, dtype=np.float32).astype(float).tolist()]) for i, v in vectors + part]
    want = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        best = sorted((-sum(a * b for a, b in zip(x, v)), i) for j, x in whole if j == q for i, v in whole if i != q)[:7]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == want
    assert (450, 1, 0, 0) in got  # an empty vector scores 0 with all
    large = df.filter("vec_id < 3").union(spark.createDataFrame([(4, [1e30] * 12, 1), (5, [-1e30] * 12, 1)], df.schema))
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(large, "vec_id < 3").collect()
    assert topk.top_k(df.limit(0), "vec_id % 50 = 0").count() == 0


def test_top_k_of_unscaled_vectors_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 64)
    rng = np.random.default_rng(8)
    vectors = [(i, rng.normal(0, 0.2, 6).tolist()) for i in range(150)]
    vectors += [(i, rng.normal(0, 3e4, 6).tolist()) for i in range(150, 160)]  # within the slices, beyond 2^31 / 1024 below
    vectors += [(200, [2.5e6, 0, 0, 0, 0, 0.25]), (201, [-4e6, 0.5, 0, 0, 0, 0]), (202, [0, 6e7, 0, 0, 0, 0]), (203, [1e12, 0, 0, 0, 0, 0])]
    vectors += [(i % 30, rng.normal(0, 0.4, 6).tolist()) for i in range(60)] + [(30, rng.normal(0, 0.2, 6).tolist()) for _ in range(130)]
    vectors = [(i, [float(x) for x in v]) for i, v in vectors]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    whole = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in vectors]
    score = lambda x, y: sum(a * b for a, b in zip(x, y))
    few = [(i, v) for i, v in whole if i % 10 == 0 and i < 200 or i in (201, 202)]
    some = df.filter("vec_id <> 203")
    want = []
    for q in sorted({i for i, _ in few}):
        best = sorted((-score(x, v), i) for j, x in few if j == q for i, v in whole if i not in (q, 203))[:9]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    asked = "vec_id % 10 = 0 and vec_id < 200 or vec_id in (201, 202)"
    got = [tuple(r) for r in topk.top_k(some, asked, k=9).orderBy("query_id", "rank").collect()]
    assert got == want
    assert {200, 201, 202} <= {r[2] for r in got} and {201, 202} <= {r[0] for r in got}
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(df, "vec_id = 200").collect()


def test_classifier(spark):
    good = ["the cat sat on the mat and the dog ran to the house", "a long walk in the park with the old friend"]
    bad = ["BUY!! NOW!! CHEAP!!", "win$$$ money### fast*** now&&&"]
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(300):
        y = rng.random() < 0.6
        w = rng.choice(good if y else bad).split()
        rng.shuffle(w)
        rows.append((i, " ".join(w * 3)))
        marks.append((i, int(y), 0))
    rows += [(1000, None), (1001, ""), (None, "the cat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(3))
    labels = spark.createDataFrame(marks + [(5, None, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in classifier.classify(docs, labels).collect()}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out.values())
    held = [(out[i].predicted, y) for i, y, _ in marks if out[i].held_out]
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in marks)
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert out[1000].score == out[1001].score
    none = classifier.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}


def test_ftrl_against_a_plain_loop():
    """Weights after every example equal those of the update written out per coordinate."""
    rng = np.random.default_rng(12)
    model = classifier.Ftrl(20, l1=1.5)
    z, n = [0.0] * 21, [0.0] * 21
    a, b, l1, l2 = model.alpha, model.beta, model.l1, model.l2

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((b + math.sqrt(n[i])) / a + l2)

    for _ in range(300):
        at = np.append(np.sort(rng.choice(20, int(rng.integers(1, 6)), replace=False)), 20)
        x, y = np.append(rng.random(len(at) - 1), 1.0), float(rng.random() < 0.4)
        p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in zip(at.tolist(), x.tolist()))))
        step = [(i, (p - y) * v, weight(i)) for i, v in zip(at.tolist(), x.tolist())]
        for i, g, w in step:
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a
            z[i] += g - sigma * w
            n[i] += g * g
        model.learn(at, x, y)
    assert np.allclose(model.weights(), [weight(i) for i in range(21)], rtol=1e-9, atol=1e-12)
    assert (model.weights() == 0).any() and (model.weights() != 0).any()


def test_models_on_empty_tables_long_texts_and_repeated_ids(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, quality int")
    assert classifier.classify(empty(spark), labels).count() == 0
    assert langid.identify(empty(spark)).count() == 0
    # one id that repeats without end is one row of the sample; one text is far longer than a chunk
    rows = [(i, ("good words here " if i % 2 else "BAD!! ##1 ") * 5, "en" if i % 2 else "de") for i in range(50)]
    rows += [(3, "good words here again", "en")] * 400 + [(7, "long text of words " * 200_000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = classifier.classify(docs, labels).collect()
    assert len(out) == len(rows) and {r.score for r in out if r.doc_id == 3} and all(0 <= r.score <= 1 for r in out)
    assert sum(r.predicted == r.doc_id % 2 for r in out) > 0.9 * len(out)
    found = langid.identify(docs).collect()
    assert len(found) == len(rows) and sum((r.lang_pred == "en") == (r.doc_id % 2 == 1) for r in found) > 0.9 * len(found)


def unigram():
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    rows = [("<unk>", 0, 2), ("<s>", 0, 3), ("</s>", 0, 3)] + [(f"<0x{i:02X}>", 0, 6) for i in range(256)]
    rng = random.Random(4)
    parts = {"▁", "▁▁", "a", "b", "c", "é", "▁ab", "abc", "bc", "▁a", "ca", "cab", "éa", "\n"}
    parts |= {"".join(rng.choice("abcé") for _ in range(rng.randint(2, 5))) for _ in range(40)}
    rows += [(p, -rng.randint(8, 80) / 8, 1) for p in sorted(parts)]
    for p, s, k in rows:
        x = m.pieces.add()
        x.piece, x.score, x.type = p, s, k
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, True
    m.normalizer_spec.name = "identity"
    m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = True, False
    m.normalizer_spec.escape_whitespaces = True
    return m


def test_sentencepiece_matches_library(spark):
    import sentencepiece

    proto = unigram()
    lib = sentencepiece.SentencePieceProcessor()
    lib.LoadFromSerializedProto(proto.SerializeToString())
    model = pieces.Model.of(proto)
    rng = random.Random(9)
    some = ["".join(rng.choice("aabbccé  \nz☃") for _ in range(rng.randint(0, 30))) for _ in range(300)] + ["", None, " ", "a" * 3000]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").withColumn("ids", F.lit(1))
    out = pieces.encode(docs, model)
    got = {r.doc_id: r.ids for r in out.collect()}
    same = 0
    for i, t in enumerate(some):
        want = lib.encode(t or "")
        worth = lambda ids: sum(proto.pieces[x].score for x in ids)
        same += got[i] == want
        assert model.decode(np.array(got[i], dtype=np.int64)).decode() == (t or "")
        assert worth(got[i]) >= worth(want) - 1e-4 or got[i] == want
    assert same >= 0.97 * len(some)  # the library sums in single precision: ties may differ
    assert {r.doc_id: r.text for r in pieces.decode(out, model).collect()} == {i: t or "" for i, t in enumerate(some)}
    assert pieces.encode(docs.limit(0), model, digest=True).count() == 0


def test_crf_marginals_match_enumeration():
    from itertools import product

    rng = np.random.default_rng(1)
    e, a, b = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    first = np.array([0, 4, 4, 7])
    langid_block, langid.BLOCK = langid.BLOCK, 2
    try:
        got = langid.marginals(e, first, a, b)
    finally:
        langid.BLOCK = langid_block
    for lo, hi in ((0, 4), (4, 7)):
        want = np.zeros((hi - lo, 3))
        for path in product(range(3), repeat=hi - lo):
            s = np.exp(b[path[0]] + sum(e[lo + t, y] for t, y in enumerate(path)) + sum(a[x, y] for x, y in zip(path, path[1:])))
            for t, y in enumerate(path):
                want[t, y] += s
        assert np.allclose(got[lo:hi], want / want.sum(axis=1, keepdims=True))


def test_language_id(spark):
    rng = random.Random(3)
    stems = {"en": ["thing", "other", "which", "there"], "de": ["nicht", "schon", "über", "auch"]}
    rows = []
    for i in range(240):
        lang = "en" if i % 2 else "de"
        rows.append((i, " ".join(rng.choice(stems[lang]) + rng.choice(["", "en", "er"]) for _ in range(30)), lang))
    rows += [(900, None, "en"), (901, "12 34 !!", "en"), (902, "which there other nicht auch schon", None), (None, "there which", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("names", F.lit(1))
    names, model = langid.train(docs)
    out = {r.doc_id: r for r in langid.predict(docs, names, model, words=True).collect()}
    held = [(out[i].lang_pred, lang) for i, _, lang in rows[:240] if out[i].held_out]
    assert len(held) > 30 and all(a == b for a, b in held)
    assert out[900].lang_pred == out[901].lang_pred == "und" and out[901].score == 0
    assert out[902].word_langs == ["en"] * 3 + ["de"] * 3
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_id_samples_every_language(spark):
    rng = random.Random(4)
    stems = {"en": ["thing", "other", "which", "there"], "de": ["nicht", "schon", "über", "auch"], "cy": ["llyn", "ffordd", "wyth", "ysgol"]}
    rows = [(i, " ".join(rng.choice(stems[lang]) for _ in range(20)), lang)
            for i in range(400) for lang in ["cy" if i % 100 == 1 else "en" if i % 2 else "de"]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, model = langid.train(docs, train_docs=30)
    assert names == ["cy", "de", "en"]
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, names, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows)
    assert langid.train(docs, train_docs=2)[0] == names  # one of each at least


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, capacity):
    from tokenizers import Tokenizer

    docs = table(spark)
    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    out = packing.pack(docs, capacity=capacity, with_ids=True)
    rows = out.collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for d in docs.collect():
        ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [0]
        own = sorted(by[d.doc_id], key=lambda r: r.piece)
        assert [x for r in own for x in r.ids] == ids
        assert all(r.length == capacity for r in own[1:]) and [r.start for r in own] == [
            sum(x.length for x in own[:k]) for k in range(len(own))]
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) for r in own)
    lanes = {}
    for r in rows:
        lanes.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for lane in lanes.values():
        at = 0
        for offset, length in sorted(lane):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r.length for r in rows) // capacity)
    assert len(lanes) <= 1.2 * least + 1
    assert packing.sequences(out).count() == len(lanes)
    assert packing.pack(empty(spark)).count() == 0


def plain_best_fit(lengths, capacity):
    """Best-fit decreasing, piece by piece: the fullest sequence with room takes it."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [r for r in room if r >= length]
        if fits:
            room.remove(min(fits))
            room.append(min(fits) - length)
        else:
            room.append(capacity - length)
    return len(room)


@pytest.mark.parametrize("seed", range(12))
def test_rounds_against_plain_best_fit(seed):
    """As many sequences as the sequential algorithm, within one in a hundred, and every piece placed once without overlap."""
    rng = random.Random(seed)
    capacity = rng.choice([50, 256, 2048])
    sizes = [[rng.randint(1, capacity) for _ in range(400)], [rng.choice([1, 7, capacity // 3, capacity // 2 + 1]) for _ in range(600)],
             [min(capacity, int(rng.expovariate(4 / capacity)) + 1) for _ in range(1500)], [capacity // 3 + 1] * 300 + [capacity // 4] * 500][seed % 4]
    counts = {}
    for s in sizes:
        counts[s] = counts.get(s, 0) + 1
    given, lanes = {}, {}
    for length, low, high, first, offset in packing.plan_rounds(counts, capacity):
        for k in range(high - low):
            given.setdefault(length, []).append(low + k)
            lanes.setdefault(first + k, []).append((offset, length))
    assert {s: sorted(r) for s, r in given.items()} == {s: list(range(n)) for s, n in counts.items()}
    for lane in lanes.values():
        at = 0
        for offset, length in sorted(lane):
            assert offset == at
            at += length
        assert at <= capacity
    plain = plain_best_fit(sizes, capacity)
    assert len(lanes) <= plain + max(1, plain // 100)


def test_plan_packs_equal_pieces_tightly():
    plan = packing.plan_rounds({100: 1000}, 2048)
    assert max(first + high - low for _, low, high, first, _ in plan) == 50
    assert sum(high - low for _, low, high, _, _ in plan) == 1000
