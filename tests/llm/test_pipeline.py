"""The pipeline, and the registered queries with SQL, on the small test tables."""

import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_ORACLE, SF_SMALL
from oracle_check import compare, duck

SQL = ["op1_ngram_jaccard_join", "op2_warc", "op3_quality_rules", "op4_exact_top_k", "op5_line_dedup",
       "op8_substring_dedup"]
SF_HELD_OUT = "/root/testdata/sf0.1"  # enough labelled rows in the holdout
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, name):
    ok, said = compare(spark, duck(SF_ORACLE), name, entry.queries()[name], entry.oracle_sql()[name], SF_ORACLE)
    assert ok, said


def after_lines(docs):
    """Line dedup by a scan in doc_id order; documents that lost all lines go."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs.items()):
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if WORD.search(x.encode())]
        gone = set()
        for n in (1, 2, 3):
            for j in range(len(at) - n + 1):
                key = tuple(lines[i] for i in at[j:j + n])
                if n < 3 and sum(len(WORD.findall(x.encode())) for x in key) < 50:
                    continue
                if key in seen:
                    gone |= set(at[j:j + n])
                seen.add(key)
        if not gone or len(gone) < len(at):
            out[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def after_near_copies(docs, width=5, num=80):
    """Every pair of documents is compared; the smallest of each component stays."""
    rows = []
    for doc_id, text in sorted(docs.items()):
        w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
        rows.append((doc_id, {tuple(w[j:j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()))
    root = {doc_id: doc_id for doc_id, _ in rows}
    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and root[a] != root[b] and 100 * len(x & y) >= num * len(x | y):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    return {k: t for k, t in docs.items() if root[k] == k}


def after_passages(docs, size=13):
    """A dictionary of all windows; documents that lost all their words go."""
    words = {k: [(m.group(), m.start()) for m in WORD.finditer(t.encode())] for k, t in docs.items()}
    first, out = {}, {}
    for doc_id in sorted(docs):
        w, raw = words[doc_id], docs[doc_id].encode()
        keep = [True] * len(w)
        for j in range(len(w) - size + 1):
            if first.setdefault(tuple(x for x, _ in w[j:j + size]), doc_id) < doc_id:
                keep[j:j + size] = [False] * size
        ends = [s for _, s in w[1:]] + [len(raw)]
        if not w or any(keep):
            head = raw[:w[0][1]] if w else raw
            out[doc_id] = (head + b"".join(raw[s:e] for (_, s), e, k in zip(w, ends, keep) if k)).decode()
    return out


def test_pipeline_matches_brute_force(spark):
    from tokenizers import Tokenizer

    from ringcast.llm import packing

    con = duck(SF_SMALL)
    kept = con.execute(f"SELECT doc_id, coalesce(text, '') FROM documents JOIN ({entry.oracle_sql()['op3_quality_rules']}) "
                       "USING (doc_id) WHERE kept").fetchall()
    docs = after_passages(after_near_copies(after_lines(dict(kept))))
    tokenizer, want = Tokenizer.from_file(packing.default_tokenizer()), []
    for doc_id, text in docs.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        begin, stop = 0, (len(ids) - 1) % 2048 + 1
        for k in range(-(-len(ids) // 2048)):
            want.append((doc_id, k, begin, stop - begin, zlib.crc32(ids[begin:stop].tobytes())))
            begin, stop = stop, stop + 2048
    rows = entry.queries()["pipeline"](spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    lanes = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert lanes.get(r.sequence_id, 0) == r.offset
        lanes[r.sequence_id] = r.offset + r.length
    assert max(lanes.values()) <= 2048
    assert len(lanes) <= 1.01 * sum(r.length for r in rows) / 2048 + 1


@pytest.mark.parametrize("name,columns,least", [("op6_quality_classifier", ("predicted", "quality"), 0.95),
                                                ("op9_language_id", ("lang_pred", "lang"), 0.98)])
def test_held_out_accuracy(spark, name, columns, least):
    found = {r.doc_id: r for r in entry.queries()[name](spark, SF_HELD_OUT).collect()}
    rows = duck(SF_HELD_OUT).execute(f"SELECT doc_id, {columns[1]} FROM documents LEFT JOIN (SELECT doc_id, any_value(quality) "
                                   f"AS quality FROM labels GROUP BY 1) USING (doc_id)").fetchall()
    assert set(found) == {k for k, _ in rows}
    held = [(found[k][columns[0]], y) for k, y in rows if found[k].held_out and y is not None]
    parts, part = (5, 0) if "quality" in name else (4, 2)
    assert all(found[k].held_out == (zlib.crc32(str(k).encode()) % parts == part) for k, _ in rows)
    assert len(held) > 100 and sum(a == b for a, b in held) >= least * len(held)


def test_sentencepiece_query_decodes_to_the_texts(spark):
    from ringcast.llm import pieces

    model = pieces.Model.load(pieces.default_model())
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    whole = pieces.decode(pieces.encode(docs, model), model)
    assert whole.join(docs.withColumnRenamed("text", "before"), "doc_id").filter("text <> coalesce(before, '')").isEmpty()
    assert entry.queries()["op7_sentencepiece"](spark, SF_SMALL).count() == docs.count() == whole.count()


def test_pipeline_stages(spark, tmp_out):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = docs.columns
    before = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, SF_SMALL)
        out.write.parquet(f"{tmp_out}/{name}")
        after = spark.read.parquet(f"{tmp_out}/{name}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == names
            assert after.join(before, "doc_id", "left_anti").isEmpty()
            before = after
    assert after.select("doc_id").distinct().count() == before.count()
    assert 0 < before.count() < docs.count()


def test_entry_lists_every_operator():
    found = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in found) == list(range(1, 14))
    assert "pipeline" in entry.queries()
