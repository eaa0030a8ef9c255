"""Hard negatives by anchor-clustered shared lists.

Scores are inner products of whole-number vectors. Anchors are dealt to clusters
by spherical k-means (fitted on all anchors, or a hash sample of about ``SAMPLE``
where there are more; every anchor is then dealt to its nearest centre). For a centre and a
block of candidates the candidates' angles to the centre are computed once; with
the widest angle of the cluster's members they bound every member's score:

    member . candidate <= |member| |candidate| cos(max(0, angle to centre - widest))

The block is sorted once by the bound without |member|, and every member of the
cluster walks that shared list from the top until certified: the bound of
what is left cannot reach the member's worst kept score (or, for negatives, the
window's floor). Scores are exact, so bounds only say where a walk ends.

Two walks: the positives of every anchor (its best rows of the same label), then,
per anchor and positive, the best rows of other labels with
``low * positive <= 100 * score <= high * positive``. A task holds one block of
candidates and one group of anchors, both of bounded size; a cluster of any size
is cut into groups. The best of all blocks are the best of all rows.

Defined results: rows with a null vec_id, null label, null vector, or null or
non-finite components (before or after scaling) take no part. A shorter vector
counts as zero beyond its end. Rows that repeat a vec_id are candidates each,
never for an anchor of their own vec_id, and anchors each. Ties go to the smaller
vec_id. A returned score that does not fit a long is an error. Fewer rows than
asked for are all returned; an anchor without positives, or a positive without
rows in its window, returns none. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.llm.vectors import FINITE, matrix
from ringcast.session import materialize

BLOCK = 1 << 19  # numbers (rows x components) of a block of candidates
GROUP = 1 << 17  # and of a group of anchors
SAMPLE = 4096
CLUSTER = 64  # anchors of the sample per centre
STEP = 512
LONG = 1 << 63


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and the whole numbers floor(scale * x), as doubles, of the rows that take part."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                       F.transform(F.col("embedding").cast("array<double>"), lambda x: x * F.lit(float(scale))).alias("v"))
    v = v.filter(f"vec_id is not null and label is not null and {FINITE.format('v')}")
    # floor() of a double is a long; beyond 2^53 a double is whole already
    return v.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) < F.lit(2.0 ** 53), F.floor(x).cast("double")).otherwise(x)))


def exact_type(a: np.ndarray, b: np.ndarray) -> type:
    """The number type in which every inner product of a row of a and one of b is exact."""
    x, y = (max(1.0, float(np.abs(v).max(initial=0))) for v in (a, b))
    most = x * y * max(1, a.shape[1])
    return np.float64 if most < 2.0 ** 53 else np.int64 if most < 2.0 ** 62 else object


def as_type(v: np.ndarray, kind: type) -> np.ndarray:
    if kind is object:
        return np.array([[int(x) for x in row] for row in v.tolist()], dtype=object).reshape(v.shape)
    return v.astype(kind)


def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit rows, lengths); a zero row stays zero."""
    size = np.abs(v).max(axis=1, initial=0)
    v = v / np.where(size > 0, size, 1)[:, None]
    length = np.sqrt((v * v).sum(axis=1))
    return v / np.where(length > 0, length, 1)[:, None], length * size


def fit_centres(v: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Spherical k-means; centres start at rows far from each other."""
    v, length = unit(v)
    v = v[length > 0]
    if not len(v):
        return np.zeros((1, v.shape[1]))
    centres, nearest = v[:1], v @ v[0]
    for _ in range(min(k, len(v)) - 1):
        far = int(nearest.argmin())
        centres = np.vstack([centres, v[far]])
        nearest = np.maximum(nearest, v @ v[far])
    for _ in range(rounds):
        own = (v @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, v)
        moved, length = unit(sums)
        centres = np.where((length > 0)[:, None], moved, centres)
    return centres


def shared_list(candidates: np.ndarray, lengths: np.ndarray, centre: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds): candidates by falling bound on the score with a member of
    length 1. ``candidates`` and ``members`` are unit rows; zero rows score 0,
    which every bound allows for by not being below it."""
    some = members[np.any(members != 0, axis=1)]
    widest = np.arccos(np.clip(some @ centre, -1, 1)).max(initial=0)
    angle = np.maximum(0, np.arccos(np.clip(candidates @ centre, -1, 1)) - widest - 1e-7)
    with np.errstate(invalid="ignore", over="ignore"):
        bound = lengths * np.cos(np.minimum(angle, np.pi)) + 1e-9 * lengths
    bound = np.where(np.isnan(bound), np.inf, bound)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def ranked(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's k best (score falling, then id rising)."""
    by_id = np.argsort(ids, axis=1, kind="stable")
    scores, ids = np.take_along_axis(scores, by_id, 1), np.take_along_axis(ids, by_id, 1)
    by_score = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, by_score, 1), np.take_along_axis(ids, by_score, 1)


def as_floats(numbers: np.ndarray) -> np.ndarray:
    """Doubles of whole numbers of any size; what no double holds is infinite."""
    if numbers.dtype != object:
        return numbers.astype(np.float64)
    return np.array([float(x) if abs(x) < 1 << 1023 else np.copysign(np.inf, x > 0 or -1) for x in numbers])


def walk(members: np.ndarray, lengths: np.ndarray, own: np.ndarray, candidates: np.ndarray, ids: np.ndarray,
         bounds: np.ndarray, k: int, floor: np.ndarray | None = None, ceiling: np.ndarray | None = None):
    """(scores, ids, steps): each member's k best candidates down one shared list,
    with 100 * score between floor and ceiling where these are given. ``lengths``
    are the members'; rows that are not there score below everything."""
    kind = exact_type(members, candidates)
    members, candidates = as_type(members, kind), as_type(candidates, kind)
    # 100 * score must be exact too
    number = object if kind is object or (floor is not None and (kind is np.int64 or floor.dtype == object)) else np.int64
    none = -(1 << 4200) if number is object else -(1 << 62) - 1
    best, found = np.full((len(members), k), none, dtype=number), np.zeros((len(members), k), dtype=np.int64)
    open_, steps = np.arange(len(members)), 0
    for at in range(0, len(candidates), STEP):
        with np.errstate(invalid="ignore", over="ignore"):
            # nothing from here on scores above this
            reach = lengths[open_] * bounds[at]
            reach = np.where(np.isnan(reach), np.inf, reach)
            go = reach >= as_floats(best[open_, -1])
            if floor is not None:
                go &= reach * 100 >= as_floats(floor[open_]) * (1 - 1e-12)
        open_ = open_[go]
        if not len(open_):
            break
        steps += len(open_)
        score = members[open_] @ candidates[at:at + STEP].T
        score = score.astype(number)
        there = own[open_][:, None] != ids[None, at:at + STEP]
        if floor is not None:
            there &= (score * 100 >= floor[open_][:, None]) & (score * 100 <= ceiling[open_][:, None])
        some = (there & (score >= best[open_, -1][:, None])).any(axis=1)
        rows = open_[some]
        if len(rows):
            new = np.where(there[some], score[some], none)
            best[rows], found[rows] = ranked(np.concatenate([best[rows], new], axis=1), np.concatenate(
                [found[rows], np.broadcast_to(ids[None, at:at + STEP], new.shape)], axis=1), k)
    return best, found, steps, none


def as_long(score: int) -> int | None:
    """A score below all longs is None (it may not be among the returned), one above them an error."""
    if score >= LONG:
        raise OverflowError("a score does not fit a long")
    return score if score >= -LONG else None


def search(block: pa.Table, anchors: pa.Table, centres: np.ndarray, k: int, same: bool,
           low: int = 0, high: int = 0) -> pa.Table:
    """One block of candidates against one group of anchors."""
    out = {"anchor": [], "positive": [], "vec_id": [], "score": []}
    width = max([centres.shape[1], *(int(np.diff(np.asarray(t.column("v").combine_chunks().offsets)).max(initial=0)) for t in (block, anchors))])
    centres = np.pad(centres, ((0, 0), (0, width - centres.shape[1])))
    c, a = matrix(block.column("v"), width), matrix(anchors.column("v"), width)
    ids, labels = (block.column(x).to_numpy() for x in ("vec_id", "label"))
    c_unit, c_length = unit(c)
    a_unit, a_length = unit(a)
    a_id, a_label, a_row, cluster = (anchors.column(x).to_numpy() for x in ("vec_id", "label", "row", "cluster"))
    positive = None if same else anchors.column("positive").to_pylist()
    score = None if same else np.array(anchors.column("positive_score").to_pylist(), dtype=np.int64)
    for one in np.unique(cluster).tolist():
        of_cluster = np.flatnonzero(cluster == one)
        order, bounds = shared_list(c_unit, c_length, centres[one], a_unit[of_cluster])
        for label in np.unique(a_label[of_cluster]).tolist():
            m = of_cluster[a_label[of_cluster] == label]
            kept = (labels[order] == label) == same
            mine = order[kept]
            window = {}
            if not same:
                s = score[m]
                number = object if np.abs(s).max(initial=0) >= 1 << 55 else np.int64
                window = {"floor": s.astype(number) * low, "ceiling": s.astype(number) * high}
            best, found, _, none = walk(a[m], a_length[m], a_id[m], c[mine], ids[mine], bounds[kept], k, **window)
            r, j = np.nonzero(best > none)
            out["anchor"].extend(a_row[m[r]].tolist())
            out["positive"].extend([None] * len(r) if same else [positive[i] for i in m[r].tolist()])
            out["vec_id"].extend(found[r, j].tolist())
            out["score"].extend(as_long(int(x)) for x in best[r, j].tolist())
    return pa.table({name: pa.array(x, pa.int64()) for name, x in out.items()})


def hard_negatives(vectors: DataFrame, anchors: str, positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    for the rows that the SQL condition ``anchors`` names."""
    rows = materialize(whole_vectors(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    asked = F.expr(anchors)
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.count_if(asked).alias("anchors")).first()
    width = max(1, shape.d or 0)
    blocks, per_group = max(1, -(-shape.n * width // BLOCK)), max(1, GROUP // width)
    chosen = rows.filter(asked)
    share = F.pmod(F.xxhash64(F.lit("sample"), "row"), F.lit(1 << 20)) * F.lit(max(1, shape.anchors)) < F.lit(SAMPLE << 20)
    sample = chosen.filter(share).select("v").toArrow()
    centres = fit_centres(matrix(sample.column("v")), -(-max(1, sample.num_rows) // CLUSTER))

    def nearest(batches):
        for batch in batches:
            v = matrix(batch.column("v"), centres.shape[1])
            # components beyond the sample's width do not choose the centre
            own = (unit(v)[0][:, :centres.shape[1]] @ centres.T).argmax(axis=1)
            yield batch.append_column("cluster", pa.array(own, pa.int32()))

    placed = materialize(chosen.mapInArrow(nearest, "vec_id long, label long, v array<double>, row long, cluster int"), "negatives-anchors")
    # clusters in order, cut into groups of about per_group anchors: one small row per cluster
    sizes = {r.cluster: r["count"] for r in placed.groupBy("cluster").count().collect()}
    start, total = {}, 0
    for one in sorted(sizes):
        start[one], total = total, total + sizes[one]
    groups = max(1, -(-total // per_group))
    first = F.create_map(*[F.lit(x) for one in sorted(sizes) for x in (one, start[one])]) if sizes else None
    size = F.create_map(*[F.lit(x) for one in sorted(sizes) for x in (one, sizes[one])]) if sizes else None

    def grouped(some: DataFrame) -> DataFrame:
        if not sizes:
            return some.withColumn("group", F.lit(0))
        at = first[F.col("cluster")] + F.pmod(F.xxhash64("row"), size[F.col("cluster")].cast("long"))
        return some.withColumn("group", F.floor(at / F.lit(per_group)).cast("int"))

    left = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")) \
        .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def against_all(some: DataFrame, **how) -> DataFrame:
        right = grouped(some).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(
            lambda block, group: search(block, group, centres, **how),
            "anchor long, positive long, vec_id long, score long")

    order = [F.desc_nulls_last("score"), F.col("vec_id")]
    near = against_all(placed, k=positives, same=True)
    near = near.withColumn("r", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).filter(F.col("r") <= positives)
    fits = F.coalesce("score", F.raise_error(F.lit("a score does not fit a long")).cast("long"))
    near = materialize(near.select("anchor", F.col("r").alias("positive"), F.col("vec_id").alias("positive_id"),
                                   fits.alias("positive_score")), "negatives-positives")
    # a window needs a positive score of 0 or more: low <= high
    asked = placed.join(near.filter(F.col("positive_score") >= 0).withColumnRenamed("anchor", "row"), "row")
    asked = asked.select("vec_id", "label", "v", "row", "cluster", "positive", "positive_score")
    far = against_all(asked, k=negatives, same=False, low=low, high=high)
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(*order))) \
        .filter(F.col("rank") <= negatives)
    named = near.join(placed.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    return far.join(named, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


ORACLE_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS i FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.i, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
      FROM r a JOIN r c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.i, p.k ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
      FROM p JOIN s ON s.i = p.i AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
