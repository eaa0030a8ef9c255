"""Line dedup by winnowing over line hashes, in DataFrame functions only.

A line with a word is a token; its hash stands for it. From each run of
``size`` consecutive tokens of a document (a window) the smallest hash is a
fingerprint, so any two equal runs of at least ``size`` lines share one. A run of
fewer lines is a window too if it holds at least ``words`` words, so a long
passage on one line and an exact copy of a short document are found.

Only fingerprints are stored: each place once, with the hashes of the ``size - 1``
lines on both sides of it. Those whose mark is in one place only go. The windows
around the remaining places are read off the neighbours' hashes and joined with
the first place of their lines, by doc_id, then position: a match of a later
place with its source. A match is extended both ways over the matches that meet
or overlap it, to the longest run of lines that are all repeated, and the run is
deleted. No two places are paired but a later one and the first, so a line
repeated by a third of all documents costs one match per place. First places are
stored before they are joined, so that a hot mark's or run's rows are split over
tasks as in any join of two tables.

Defined results: null text: no lines, nothing removed, text stays null. Lines
without a word are no tokens and are never removed. Runs of fewer than ``size``
tokens and fewer than ``words`` words (with ``words`` None: any such run) lose
nothing. Lines are equal if their texts are, compared by two 64-bit hashes of the
window. Rows with a null doc_id lose nothing and are no source. Rows that repeat a
doc_id are told apart by their text; equal rows count as one. Other columns are
kept; names that begin with __ are refused. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.session import materialize

SIZE = 3
WORDS = 50
WORD = r"[^\x20\x09-\x0D]"


def fingerprints(docs: DataFrame, size: int = SIZE, words: int | None = WORDS) -> DataFrame:
    """(doc_id, text_key, mark, place, before, h, c): every place that is the smallest
    hash of a window, with the hashes (and word counts) of the lines around it, of
    which ``before`` lie before the place."""
    d = docs.filter("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("t"))
    counts = F.transform("t", lambda x: F.regexp_count(x, F.lit(WORD + "+"))) if words is not None \
        else F.array().cast("array<int>")
    d = d.select("doc_id", "text_key", F.transform("t", lambda x: F.xxhash64(x)).alias("h"), counts.alias("c"))
    places = []
    for n in range(size if words is None else 1, size + 1):
        long = "true" if n == size else " + ".join(f"c[i + {k}]" for k in range(n)) + f" >= {words}"
        run = f"slice(h, i + 1, {n})"
        places.append(f"if(size(h) < {n}, array(), transform(filter(sequence(0, greatest(size(h) - {n}, 0)), i -> {long}), "
                      f"i -> cast(i + array_position({run}, array_min({run})) - 1 as int)))")
    d = d.withColumn("place", F.explode(F.expr(f"array_distinct(concat({', '.join(places)}))")))
    first = f"greatest(place - {size - 1}, 0)"
    around = f"least(place + {size}, size(h)) - {first}"
    return d.select("doc_id", "text_key", F.expr("h[place]").alias("mark"), "place", F.expr(f"place - {first}").alias("before"),
                    F.expr(f"slice(h, {first} + 1, {around})").alias("h"),
                    (F.expr(f"slice(c, {first} + 1, {around})") if words is not None else F.col("c")).alias("c"))


def windows(places: DataFrame, size: int = SIZE, words: int | None = WORDS) -> DataFrame:
    """(doc_id, text_key, at, run, a, b): the windows whose fingerprint is one of the
    places: first token, number of lines, and two hashes of the lines."""
    runs = []
    for n in range(size if words is None else 1, size + 1):
        lines = ", ".join(f"h[j + {k}]" for k in range(n))
        run = f"slice(h, j + 1, {n})"
        long = "true" if n == size else " + ".join(f"c[j + {k}]" for k in range(n)) + f" >= {words}"
        own = f"{long} and j + array_position({run}, array_min({run})) - 1 = before"
        starts = f"sequence(greatest(before - {n - 1}, 0), least(before, size(h) - {n}))"
        runs.append(f"if(size(h) < {n} or greatest(before - {n - 1}, 0) > least(before, size(h) - {n}), array(), "
                    f"transform(filter({starts}, j -> {own}), j -> struct(cast(place - before + j as int) as at, {n} as run, "
                    f"xxhash64({lines}) as a, xxhash64(1, {lines}) as b)))")
    return places.select("doc_id", "text_key", F.inline(F.expr(f"concat({', '.join(runs)})")))


def repeats(docs: DataFrame, size: int = SIZE, words: int | None = WORDS) -> DataFrame:
    """(doc_id, text_key, runs): first and last token of each document's later repeated runs."""
    every = materialize(fingerprints(docs, size, words), "lines-marks")
    place = F.struct("doc_id", "text_key", "place")
    marks = materialize(every.groupBy("mark").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
                        .filter("lo <> hi").select("mark"), "lines-recurring")
    found = materialize(windows(every.join(marks, "mark"), size, words), "lines-windows")
    at = F.struct("doc_id", "text_key", "at")
    first = materialize(found.groupBy("a", "b").agg(F.min(at).alias("source"), F.max(at).alias("last"))
                        .filter("source <> last").select("a", "b", "source"), "lines-sources")
    matches = found.join(first, ["a", "b"]).filter(at != F.col("source")).select("doc_id", "text_key", "at", (F.col("at") + F.col("run")).alias("stop"))
    # a match starts a run of its own where no earlier one reaches it
    before = Window.partitionBy("doc_id", "text_key").orderBy("at", "stop").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("doc_id", "text_key").orderBy("at", "stop").rowsBetween(Window.unboundedPreceding, 0)
    apart = (F.col("at") > F.coalesce(F.max("stop").over(before), F.lit(-1))).cast("int")
    runs = matches.withColumn("apart", apart).withColumn("one", F.sum("apart").over(upto)) \
        .groupBy("doc_id", "text_key", "one").agg(F.min("at").alias("at"), (F.max("stop") - 1).alias("last"))
    return runs.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("at", "last")).alias("runs"))


def line_dedup(docs: DataFrame, size: int = SIZE, words: int | None = WORDS) -> DataFrame:
    """``docs`` with later repeated runs taken out of ``text``, and ``__n_lines``
    (tokens), ``__n_removed``."""
    names = docs.columns
    taken = [c for c in names if c.startswith("__")]
    if taken:
        raise ValueError(f"columns {taken}: names that begin with __ are taken")
    found = repeats(docs, size, words).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__found_key"),
                                              F.col("runs").alias("__runs"))
    own = docs.withColumn("__key", F.xxhash64("text"))
    own = own.join(found, (own.doc_id == found["__id"]) & (own["__key"] == found["__found_key"]), "left")
    own = own.withColumns({
        "__lines": F.split("text", "\n"),
        "__drop": F.flatten(F.transform("__runs", lambda s: F.sequence(s["at"], s["last"])))})
    own = own.withColumn("__at", F.expr(
        f"filter(sequence(0, size(__lines) - 1), i -> __lines[i] rlike r'{WORD}')"))
    kept = F.expr("array_join(transform(array_except(sequence(0, size(__lines) - 1), "
                  "transform(__drop, j -> __at[j])), i -> __lines[i]), '\\n')")
    text = F.when(F.col("__runs").isNull(), F.col("text")).otherwise(kept)
    return own.select(*(text.alias(c) if c == "text" else own[c] for c in names),
                      F.coalesce(F.size("__at"), F.lit(0)).cast("long").alias("__n_lines"),
                      F.coalesce(F.size("__drop"), F.lit(0)).cast("long").alias("__n_removed"))


def without_repeats(docs: DataFrame, size: int = SIZE, words: int | None = WORDS) -> DataFrame:
    """``docs`` after ``line_dedup``; a document that lost all its lines goes."""
    return line_dedup(docs, size, words).filter("__n_removed = 0 or __n_removed < __n_lines").select(*docs.columns)


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, text, list_transform(range(1, len(s) + 1), lambda i: {'i': i, 't': s[i]}) AS s
           FROM (SELECT doc_id, text, string_split(text, chr(10)) AS s FROM documents)),
t AS (SELECT doc_id, text, s, list_filter(s, lambda x: regexp_matches(x.t, '[^\x20\x09-\x0D]')) AS k FROM l),
u AS (SELECT doc_id, k, list_transform(k, lambda x: len(list_filter(string_split_regex(x.t, '[\x20\x09-\x0D]+'), lambda y: y <> ''))) AS c FROM t),
p AS (SELECT doc_id, k, c, n, unnest(range(1, len(k) - n + 2)) AS pos FROM u, (VALUES (1), (2), (3)) r(n) WHERE len(k) >= n),
w AS (SELECT doc_id, pos, n, list_transform(k[pos:pos + n - 1], lambda x: x.t) AS g FROM p
      WHERE n = 3 OR list_sum(c[pos:pos + n - 1]) >= 50),
r AS (SELECT doc_id, pos, n FROM (SELECT doc_id, pos, n, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS i FROM w) WHERE i > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS pos FROM r),
x AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY 1),
f AS (SELECT t.*, coalesce(gone, []) AS gone FROM t LEFT JOIN x USING (doc_id)),
o AS (SELECT doc_id, len(k) AS n_lines, len(gone) AS n_removed, text, s, list_transform(gone, lambda a: k[a].i) AS drop_at FROM f)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN text IS NULL THEN NULL ELSE sha256(coalesce(array_to_string(list_transform(
         list_filter(s, lambda x: NOT list_contains(drop_at, x.i)), lambda x: x.t), chr(10)), '')) END AS kept_sha256
FROM o"""
