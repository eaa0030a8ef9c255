"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word shingles; documents with equal sets
form one class. Shingles have one global order (estimated document frequency
from a fixed-size count sketch of the whole corpus, then hash), so rare ones
come first. With ``T = ceil(t * n)`` the l-prefix of a set of n shingles is its
first ``n - T + l``: two sets with Jaccard >= t share at least ``min(l, m)``
shingles of their l- and m-prefixes. Each set takes the l of least estimated
cost: the postings its prefix meets, plus verification of the candidates, of
which at most ``postings / l`` can share l of them. A longer prefix so demands
more shared shingles before a pair is verified.

Lists of up to ``light`` classes give pairs, counted against ``min(l, m)``.
A longer list never gives all its pairs: its members are verified against one
hub (the member with the most common shingles), components are built, and only
members of a list that are still in different components, and whose sizes and
positions allow the overlap, are verified in a second round. Links inside one
component need no more work, as the result is components.

Defined results: null text, no words: empty set, linked with nothing, its own
component. Fewer words than the shingle width: the whole sequence is the one
shingle. Repeated rows are members of one class like any other copies; a null
doc_id takes part but is no component's id unless all its members are null.
Other columns are ignored. An empty table gives an empty result. Shingles and
classes are compared by 64-bit hashes.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.llm import words as W
from ringcast.llm.components import connected_components
from ringcast.llm.ship import drop
from ringcast.session import materialize

SKETCH_BITS = 20
SKETCH_PARTS = 16
MAX_LEVEL = 4
LIGHT = 24
VERIFY_COST = 0.05


def _class_of(shingles: np.ndarray) -> int:
    """Hash of a set, from its members' hashes."""
    if not len(shingles):
        return 0
    total = int(W.mix(shingles).sum(dtype=np.uint64))
    turned = int(np.bitwise_xor.reduce(W.mix(shingles + np.uint64(0x2545F4914F6CDD1D))))
    both = (total * 3 + turned + len(shingles)) & 0xFFFFFFFFFFFFFFFF
    return int(W.mix(np.array([both], dtype=np.uint64)).view(np.int64)[0])


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: doc_id, cls (its set's hash), n (its size). Rows
    with ``part`` set hold a task's piece of the corpus count sketch."""
    slots = 1 << SKETCH_BITS

    def sets(batches):
        sketch = np.zeros(slots, dtype=np.int64)
        for rows, data, offsets in W.chunks(batches):
            cls, n, every = [], [], []
            for s in W.word_sets(W.LOWER[data], offsets, width):
                cls.append(_class_of(s))
                n.append(len(s))
                every.append(s)
            flat = np.concatenate(every) if every else np.zeros(0, np.uint64)
            sketch += np.bincount((flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64),
                                  minlength=slots)
            yield pa.record_batch({"doc_id": rows.column(0), "cls": pa.array(cls, pa.int64()),
                                   "n": pa.array(n, pa.int64()),
                                   "part": pa.nulls(len(n), pa.int32()),
                                   "counts": pa.nulls(len(n), pa.binary())})
        if sketch.any():
            parts = [zlib.compress(x.astype("<i8").tobytes(), 1)
                     for x in np.split(sketch, SKETCH_PARTS)]
            k = len(parts)
            yield pa.record_batch({"doc_id": pa.nulls(k, pa.int64()), "cls": pa.nulls(k, pa.int64()),
                                   "n": pa.nulls(k, pa.int64()),
                                   "part": pa.array(range(k), pa.int32()),
                                   "counts": pa.array(parts, pa.binary())})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sets, "doc_id long, cls long, n long, part int, counts binary")


def merge_sketch(parts: DataFrame) -> np.ndarray:
    """The whole sketch (2^SKETCH_BITS counters, a fixed size), summed in two steps."""

    def add(batches):
        total, part = None, None
        for batch in batches:
            for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(zlib.decompress(c), dtype="<i8")
                total, part = x.copy() if total is None else total + x, p
        if total is not None:
            yield pa.record_batch({"part": pa.array([part], pa.int32()), "counts": pa.array(
                [zlib.compress(total.tobytes(), 1)], pa.binary())})

    def group(rows: pa.Table) -> pa.Table:
        done = list(add(rows.select(["part", "counts"]).to_batches()))
        return pa.Table.from_batches(done)

    some = parts.withColumn("salt", F.pmod(F.xxhash64("counts"), F.lit(64)))
    some = some.groupBy("part", "salt").applyInArrow(group, "part int, counts binary")
    done = some.groupBy("part").applyInArrow(group, "part int, counts binary").collect()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    size = len(out) // SKETCH_PARTS
    for r in done:
        out[r.part * size:(r.part + 1) * size] = np.frombuffer(zlib.decompress(r.counts), "<i8")
    return out


def choose_level(frequencies: np.ndarray, n: int, least: int) -> int:
    """The l of least estimated cost for a set whose shingles, in order, have
    these estimated frequencies."""
    best, level = None, 1
    met = float(frequencies[:n - least].sum())
    for k in range(1, min(MAX_LEVEL, least) + 1):
        met += float(frequencies[n - least + k - 1])
        cost = met + VERIFY_COST * n * met / k
        if best is None or cost < best:
            best, level = cost, k
    return level


def postings(docs: DataFrame, sketch, width: int, num: int, den: int) -> DataFrame:
    """(token, cls, n, pos, level, centre) for the prefix of each class; a task
    gives each class once."""
    shift = np.uint64(64 - SKETCH_BITS)

    def prefixes(batches):
        counts = np.frombuffer(zlib.decompress(sketch.value), dtype="<i8")
        floor = int(np.median(counts))
        seen: set[int] = set()
        for _, data, offsets in W.chunks(batches):
            out = []
            for s in W.word_sets(W.LOWER[data], offsets, width):
                n, cls = len(s), _class_of(s)
                if not n or cls in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(cls)
                f = counts[(s >> shift).astype(np.int64)]
                least = -(-num * n // den)
                # only the first n - least + MAX_LEVEL places matter: select, then sort those
                size = min(n, n - least + MAX_LEVEL)
                if size < n:
                    top = np.flatnonzero(f <= np.partition(f, size - 1)[size - 1])
                else:
                    top = np.arange(n)
                order = top[np.lexsort((s[top], f[top]))][:size]
                level = choose_level(np.maximum(f[order] - floor, 1), n, least)
                order = order[:n - least + level]
                out.append((s[order], cls, n, level, int(np.maximum(f - floor, 1).sum() // n)))
            if out:
                sizes = [len(x[0]) for x in out]
                wide = lambda i, t: np.repeat(np.array([x[i] for x in out], dtype=t), sizes)
                yield pa.record_batch({
                    "token": np.concatenate([x[0] for x in out]).view(np.int64),
                    "cls": wide(1, np.int64), "n": wide(2, np.int32),
                    "pos": np.concatenate([np.arange(k, dtype=np.int32) for k in sizes]),
                    "level": wide(3, np.int32), "centre": wide(4, np.int64)})

    return docs.select("text").mapInArrow(
        prefixes, "token long, cls long, n int, pos int, level int, centre long")


def _lists(post: DataFrame, light: int) -> DataFrame:
    """Postings whose token has two classes or more, with the list's length and,
    for a long one, its hub. Both sides are stored before the join, so that the
    postings of a hot token are split over tasks like those of any hot key."""
    post = materialize(post.groupBy("token", "cls").agg(
        *(F.first(c).alias(c) for c in ("n", "pos", "level", "centre"))), "jaccard-postings")
    stats = materialize(post.groupBy("token").agg(
        F.count("*").alias("length"),
        F.max(F.struct("centre", "cls", "n", "pos", "level")).alias("hub")).filter("length > 1"), "jaccard-tokens")
    lists = post.join(stats, "token").select(
        "token", "cls", "n", "pos", "level", "centre", "length",
        F.when(F.col("length") > light, F.col("hub")).alias("hub"))
    # tokens of short lists before this one: no more of them can be shared before it
    before = Window.partitionBy("cls").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    lists = materialize(lists.withColumn("before", F.coalesce(F.count_if(F.col("hub").isNull()).over(before), F.lit(0))),
                        "jaccard-lists")
    drop(post.sparkSession, post, stats)
    return lists


def _fits(num: int, den: int, overlap: str, a: str, b: str) -> str:
    """SQL: sizes a and b and at most ``overlap`` common shingles allow the threshold."""
    return (f"least({a}, {b}) * {den} >= greatest({a}, {b}) * {num} "
            f"and ({overlap}) * {num + den} >= {num} * ({a} + {b})")


# Common shingles of a pair whose first shared token in a long list is this one:
# before it they share only tokens of short lists, and fewer than make them a pair there.
_LONG_BOUND = "least({a}n - {a}pos, {b}n - {b}pos) + least({a}level - 1, {b}level - 1, {befores})"


def _light_pairs(lists: DataFrame, light: int, num: int, den: int) -> DataFrame:
    some = lists.filter(F.col("length") <= light).select("token", "cls", "n", "pos", "level")
    a = some.select("token", *(F.col(c).alias("a_" + c) for c in ("cls", "n", "pos", "level")))
    b = some.select("token", *(F.col(c).alias("b_" + c) for c in ("cls", "n", "pos", "level")))
    sized = f"least(a_n, b_n) * {den} >= greatest(a_n, b_n) * {num}"
    pairs = a.join(b, (a.token == b.token) & (a.a_cls < b.b_cls) & F.expr(sized))
    # the first shared shingle has the largest bound
    pairs = pairs.groupBy("a_cls", "b_cls").agg(
        F.count("*").alias("shared"),
        F.first(F.least("a_level", "b_level")).alias("wanted"),
        F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"),
        F.max(F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))).alias("most"))
    return pairs.filter("shared >= wanted").filter(_fits(num, den, "most", "a_n", "b_n")) \
        .select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b"))


def _hub_pairs(lists: DataFrame, num: int, den: int) -> DataFrame:
    most = _LONG_BOUND.format(a="", b="hub.", befores="before")
    return lists.filter("hub is not null and cls <> hub.cls") \
        .filter(_fits(num, den, most, "n", "hub.n")) \
        .select(F.least("cls", "hub.cls").alias("a"), F.greatest("cls", "hub.cls").alias("b"))


def _left_over(lists: DataFrame, labels: DataFrame, done: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of long lists whose members are in different components."""
    long = lists.filter("hub is not null").select("token", "cls", "n", "pos", "level", "before") \
        .join(labels.withColumnRenamed("node", "cls"), "cls", "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    long = materialize(long, "jaccard-rooted")
    mixed = materialize(long.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                        .filter("lo <> hi").select("token"), "jaccard-mixed")
    long = materialize(long.join(mixed, "token"), "jaccard-long")
    a = long.select("token", *(F.col(c).alias("a_" + c) for c in ("cls", "n", "pos", "level", "before", "root")))
    b = long.select("token", *(F.col(c).alias("b_" + c) for c in ("cls", "n", "pos", "level", "before", "root")))
    most = _LONG_BOUND.format(a="a_", b="b_", befores="a_before, b_before")
    return a.join(b, (a.token == b.token) & (a.a_cls < b.b_cls) & (a.a_root != b.b_root)
                  & F.expr(_fits(num, den, most, "a_n", "b_n"))) \
        .select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")).distinct() \
        .join(done, ["a", "b"], "left_anti")


def _set_table(docs: DataFrame, members: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(cls, shingles) of the classes in ``pairs``."""
    return _sets_of(docs, members, pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), width)


def _sets_of(docs: DataFrame, members: DataFrame, needed: DataFrame, width: int) -> DataFrame:
    """(cls, shingles) of the classes in ``needed``, from one document each; of a
    class without any doc_id, from the rows that have none."""
    one = members.groupBy("cls").agg(F.min("doc_id").alias("doc_id")).join(needed, "cls")

    def sets(batches):
        for rows, data, offsets in W.chunks(batches):
            found = [s.view(np.int64) for s in W.word_sets(W.LOWER[data], offsets, width)]
            yield pa.record_batch({"cls": pa.array([_class_of(s.view(np.uint64)) for s in found], pa.int64()),
                                   "shingles": pa.array(found, pa.list_(pa.int64()))})

    schema = "cls long, shingles array<long>"
    text = docs.select("doc_id", "text").join(one.select("doc_id").distinct(), "doc_id")
    unnamed = docs.filter("doc_id is null").select("text").mapInArrow(sets, schema) \
        .join(one.filter("doc_id is null").select("cls"), "cls", "left_semi")
    return text.select("text").mapInArrow(sets, schema).union(unnamed).dropDuplicates(["cls"])


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v) of the pairs whose sets reach the threshold."""
    a = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(a, "a").join(b, "b").select(
        F.col("a").alias("u"), F.col("b").alias("v"), F.size("x").alias("p"), F.size("y").alias("q"),
        F.size(F.array_intersect("x", "y")).alias("common"))
    return both.filter(f"common * {den} >= (p + q - common) * {num}").select("u", "v")


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                       light: int = LIGHT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest
    doc_id reachable over links of Jaccard >= num/den), cls."""
    spark = docs.sparkSession
    found = materialize(shingle_sets(docs, width), "jaccard-sets")
    members = found.filter("part is null").select("doc_id", "cls", "n")
    counts = merge_sketch(found.filter("part is not null").select("part", "counts"))
    sketch = spark.sparkContext.broadcast(zlib.compress(counts.astype("<i8").tobytes(), 1))
    lists = _lists(postings(docs, sketch, width, num, den), light)
    pairs = materialize(_light_pairs(lists, light, num, den)
                        .union(_hub_pairs(lists, num, den)).distinct(), "jaccard-pairs")
    known = members.filter("n > 0")
    sets = materialize(_set_table(docs, known, pairs, width), "jaccard-texts")
    links = materialize(_verify(pairs, sets, num, den), "jaccard-links")
    drop(spark, sets)
    labels = connected_components(links)
    more = materialize(_left_over(lists, labels, pairs, num, den), "jaccard-more")
    if not more.isEmpty():
        sets = materialize(_set_table(docs, known, more, width), "jaccard-texts")
        labels = connected_components(links.union(_verify(more, sets, num, den)))
    labels = materialize(labels, "jaccard-labels")
    drop(spark, lists, pairs, more, links)
    return _result(members, labels)


def _result(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component's smallest doc_id; classes are reduced to
    their smallest doc_id first, so a large group of copies is one row."""
    low = members.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("low"))
    rooted = low.join(labels.withColumnRenamed("node", "cls"), "cls", "left") \
        .withColumn("root", F.coalesce("root", "cls"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of_class = rooted.join(lowest, "root").select("cls", "component_id")
    out = members.withColumn("key", F.when(F.col("n") > 0, F.col("cls")))
    out = out.join(of_class.withColumnRenamed("cls", "key"), "key", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"), "cls")


def one_per_component(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents whose doc_id is their component's smallest (all columns of
    ``docs``). Rows that repeat that doc_id stay."""
    keep = jaccard_components(docs, width, num, den)
    keep = keep.filter("doc_id = component_id or doc_id is null").select("doc_id").distinct()
    return docs.join(keep, docs.doc_id.eqNullSafe(keep.doc_id), "left_semi")


#: every pair of sets with a common shingle is counted; a component's smallest
#: doc_id reaches all its members through larger ones
ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(
      list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS k FROM d),
c AS (SELECT k, min(doc_id) AS lo, len(k) AS n FROM s WHERE len(k) > 0 GROUP BY k),
p AS (SELECT lo, n, unnest(k) AS x FROM c),
l AS (SELECT a.lo AS u, b.lo AS v FROM p a JOIN p b ON a.x = b.x AND a.lo < b.lo AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
      GROUP BY a.lo, b.lo, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(node, low) AS (SELECT lo, lo FROM c UNION SELECT e.v, r.low FROM r JOIN e ON e.u = r.node WHERE e.v > r.low),
m AS (SELECT node, min(low) AS low FROM r GROUP BY 1)
SELECT s.doc_id, len(s.k)::BIGINT AS n_shingles, coalesce(m.low, s.doc_id) AS component_id
FROM s LEFT JOIN c ON c.k = s.k LEFT JOIN m ON m.node = c.lo"""
