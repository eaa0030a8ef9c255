"""Nearest neighbours, hard negatives and whitening against brute force, and their edge cases."""

import math

import numpy as np
import pytest

from ringcast.llm import hnsw, negatives, whitening
from ringcast.llm.ship import ship

SCHEMA = "vec_id long, embedding array<float>, label int, score double, rank int, row long, v string, shard string, x int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def table(spark, vectors, labels=None):
    """(vec_id, vector) pairs as a table with columns whose names clash with the operators' own."""
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v],
             (labels or {}).get(i, 1) if i is not None else 1, 1.0, 1, 1, "v", "s", 1) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def f32(v):
    return np.asarray(v, dtype=np.float32).astype(np.float64)


# --- nearest neighbours

def brute_nearest(vectors, is_query, k):
    """query id -> [(score, id)] by falling score, then id; score summed in double precision."""
    good = [(i, f32(v)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and np.any(f32(v))]
    width = max((len(v) for _, v in good), default=0)
    good = [(i, np.pad(v, (0, width - len(v)))) for i, v in good]
    out = {}
    for q in sorted({i for i, _ in good if is_query(i)}):
        found = sorted((-float(np.dot(a, b)), i) for j, a in good if j == q for i, b in good if i != q)[:k]
        out[q] = [(-s, i) for s, i in found]
    return out


def listed(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_nearest_small_shards_are_exact(spark):
    draw = np.random.default_rng(3)
    v = [(i, draw.standard_normal(8).tolist()) for i in range(60)]
    v += [(i, v[7][1]) for i in range(60, 100)]  # one vector many times
    v += [(100, None), (101, []), (102, [0.0] * 8), (103, [1.0, None]), (104, [float("nan")] * 8), (105, [float("inf")] * 8),
          (None, [1.0] * 8), (110, [3.0]), (120, [1e30] * 8), (130, [1e-30] * 8), (20, v[3][1]), (-40, v[5][1])]
    got, want = listed(hnsw.nearest(table(spark, v), "vec_id % 20 = 0", k=5)), brute_nearest(v, lambda i: i % 20 == 0, 5)
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}
    for q, found in got.items():
        assert np.allclose([s for s, _ in found], [s for s, _ in want[q]], rtol=1e-12)


def test_nearest_empty_table(spark):
    df = hnsw.nearest(table(spark, []), "vec_id % 20 = 0")
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and df.count() == 0


def test_nearest_fewer_candidates_than_asked(spark):
    assert listed(hnsw.nearest(table(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0])]), "vec_id % 20 = 0")) == {0: [(0.5, 1)]}
    assert listed(hnsw.nearest(table(spark, [(0, [1.0, 0.0])]), "vec_id % 20 = 0")) == {}


def test_nearest_recall_through_the_graph(spark, monkeypatch):
    """Shards far larger than the beam: rows of very different length, a third of them near copies of one."""
    monkeypatch.setattr(hnsw, "SHARD", 1500 * 32)
    draw = np.random.default_rng(5)
    v = draw.standard_normal((3000, 32)) * np.exp(draw.standard_normal((3000, 1)) * 0.4)
    v[::3] = v[0] + draw.standard_normal((1000, 32)) * 1e-3
    v = [(i, x.tolist()) for i, x in enumerate(v)]
    got, want = listed(hnsw.nearest(table(spark, v), "vec_id % 20 = 0")), brute_nearest(v, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    recall = np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 20 for q in want])
    assert recall >= 0.9, recall


def test_registered_recall(spark):
    import __spark_entry__
    sf = "/root/testdata/sf0.1"
    v = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = listed(__spark_entry__.queries()["op11_nearest_neighbours"](spark, sf))
    want = brute_nearest(v, lambda i: i % 20 == 0, 20)
    assert got.keys() == want.keys()
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 20 for q in want]) >= 0.95


def test_graph_links():
    draw = np.random.default_rng(1)
    points = hnsw.on_sphere(draw.standard_normal((700, 16)))
    graph = hnsw.Graph(points, links=8, beam=40)
    for level, array in enumerate(graph.arrays):
        for node in range(700):
            some = array[node][array[node] >= 0]
            assert len(set(some.tolist())) == len(some) and node not in some
            assert graph.level[node] >= level or not len(some)
            assert (graph.level[some] >= level).all()


# --- hard negatives

def brute_negatives(vectors, labels, is_anchor, scale=256, positives=5, negatives_=10, low=30, high=90):
    rows = []
    for i, v in vectors:
        label = labels.get(i, 1)
        if i is None or label is None or v is None or None in v or not np.isfinite(f32(v)).all():
            continue
        rows.append((i, label, [math.floor(scale * x) for x in f32(v).tolist()]))
    out = []
    for i, label, v in rows:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if j != i]
        for p, j, _ in sorted(x for x in scored if x[2] == label)[:positives]:
            found = sorted((s, n) for s, n, other in scored if other != label and 30 * -p <= 100 * -s <= 90 * -p)
            out += [(i, j, rank, n, -p, -s) for rank, (s, n) in enumerate(found[:negatives_], start=1)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in df.collect())


def test_hard_negatives_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 64 * 12)
    monkeypatch.setattr(negatives, "GROUP", 8 * 12)
    monkeypatch.setattr(negatives, "STEP", 16)
    monkeypatch.setattr(negatives, "CLUSTER", 6)
    draw = np.random.default_rng(11)
    centres = draw.standard_normal((5, 12))
    v = [(i, (centres[i % 5] + 0.3 * draw.standard_normal(12)).tolist()) for i in range(300)]
    labels = {i: int(draw.integers(0, 4)) for i in range(300)} | {7: None, 8: None, 300: None}
    v += [(i, v[40][1]) for i in range(301, 330)]  # ties
    v += [(300, v[1][1]), (330, None), (331, [1.0, None]), (332, [float("nan")] * 12), (333, [float("-inf")] * 12), (None, v[2][1]),
          (340, []), (350, [0.0] * 12), (360, [2.0]), (-10, v[3][1]), (30, v[4][1]), (31, v[31][1])]
    got = mined(negatives.hard_negatives(table(spark, v, labels), "vec_id % 10 = 0"))
    want = brute_negatives(v, labels, lambda i: i % 10 == 0)
    assert got == want and len(got) > 500


def test_hard_negatives_numbers_of_any_size(spark):
    draw = np.random.default_rng(2)
    v = [(i, draw.standard_normal(4).tolist()) for i in range(40)]
    v += [(50 + i, (draw.standard_normal(4) * 1e6).tolist()) for i in range(20)]
    labels = {i: i % 2 for i in range(100)}
    got = mined(negatives.hard_negatives(table(spark, v, labels), "vec_id % 10 = 0"))
    assert got == brute_negatives(v, labels, lambda i: i % 10 == 0)
    too_large = v + [(90, [1e30] * 4), (92, [1e30] * 4)]
    with pytest.raises(Exception, match="does not fit a long"):
        mined(negatives.hard_negatives(table(spark, too_large, labels), "vec_id % 10 = 0"))
    # as a candidate of the other label it is beyond every window
    assert mined(negatives.hard_negatives(table(spark, v + [(91, [-1e30] * 4)], labels | {91: 9}), "vec_id % 10 = 0")) == got


def test_hard_negatives_empty(spark):
    df = negatives.hard_negatives(table(spark, []), "vec_id % 100 = 0")
    assert df.count() == 0
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.hard_negatives(table(spark, [(0, [1.0])]), "vec_id % 100 = 0").count() == 0


def test_walk_ends_early():
    """A tight cluster's members do not walk the whole list, and find the best all the same."""
    draw = np.random.default_rng(4)
    c = np.round(draw.standard_normal((4000, 6)) * 100)
    members = np.round(np.array([100.0, 0, 0, 0, 0, 0]) + draw.standard_normal((20, 6)))
    (cu, cl), (mu, ml) = negatives.unit(c), negatives.unit(members)
    order, bounds = negatives.shared_list(cu, cl, negatives.unit(members[:1])[0][0], mu)
    best, found, steps, _ = negatives.walk(members, ml, np.full(20, -1), c[order], order, bounds, 5)
    assert (best == -np.sort(-(members @ c.T), axis=1)[:, :5]).all()
    assert steps < 20 * -(-4000 // negatives.STEP)
    assert (members @ c[order].T <= ml[:, None] * bounds[None, :] + 1e-6).all()


# --- whitening

def brute_whitening(vectors, k=32):
    rows = [(i, f32(v)) for i, v in vectors if v is not None and None not in v and np.isfinite(f32(v)).all()]
    d = max(len(v) for _, v in rows)
    x = np.array([np.floor(64 * np.pad(v, (0, d - len(v)))).astype(np.int64) + 1_000_000 for _, v in rows])
    n, total = len(x), x.sum(axis=0)
    diff = n * x - total
    values, axes = np.linalg.eigh((diff / n).T @ (diff / n) / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    return [i for i, _ in rows], n, (diff ** 2).sum(axis=1), diff / n, values, axes


def test_whitening(spark):
    draw = np.random.default_rng(9)
    base = draw.standard_normal((300, 40)) * np.linspace(1, 4, 40)
    v = [(i, x.tolist()) for i, x in enumerate(base)]
    v += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (None, v[3][1]), (3, v[3][1]), (305, []),
          (306, [1.5, -2.5])]
    ids, n, deviation, diff, values, axes = brute_whitening(v)
    rows = whitening.whiten(table(spark, v)).collect()
    assert len(rows) == n * 32 and {r.n for r in rows} == {n}
    key = lambda i: -1 if i is None else i
    assert sorted((key(r.vec_id), r.deviation) for r in rows if r.component == 1) == sorted((key(i), int(x)) for i, x in zip(ids, deviation))
    trace = (diff ** 2).sum() / n
    sign = {}
    for r in rows:
        if r.vec_id in (3, None):
            continue
        want = diff[ids.index(r.vec_id)] @ axes[:, r.component - 1] / math.sqrt(values[r.component - 1])
        if abs(want) > 1e-3:
            sign.setdefault(r.component, np.sign(want * r.whitened))
        assert r.whitened == pytest.approx(want * sign.get(r.component, 1), rel=1e-7, abs=1e-7)
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9


def test_whitening_without_components(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(table(spark, [(1, []), (2, [])])).count() == 0
    # two rows differ in one direction: one component, values 1 and -1
    rows = whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [2.0, 3.0])])).collect()
    assert sorted(round(r.whitened, 9) for r in rows) == [-1.0, 1.0] and {r.component for r in rows} == {1}
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(table(spark, [(1, [1e30]), (2, [1.0])])).count()


def random_covariance(kind, d, draw):
    x = draw.standard_normal((500, d))
    if kind == "rank":
        x = x[:, :5] @ draw.standard_normal((5, d))
    if kind == "equal":
        return np.eye(d) * 3
    if kind == "repeated":
        return np.diag(np.repeat(np.arange(1.0, d), 4)[:d])
    if kind == "blocks":
        half = x[:, :d // 2].T @ x[:, :d // 2] / 500
        return np.kron(np.eye(2), half)
    return x.T @ x / 500


@pytest.mark.parametrize("kind,d", [("plain", 64), ("plain", 1), ("plain", 2), ("plain", 3), ("rank", 40), ("equal", 50),
                                    ("repeated", 48), ("blocks", 64)])
def test_components(kind, d):
    c = random_covariance(kind, d, np.random.default_rng(d))
    values, axes = whitening.principal_components(c, 32)
    k = len(values)
    assert k == (5 if kind == "rank" else min(32, d))
    assert np.allclose(values, np.linalg.eigvalsh(c)[::-1][:k], rtol=1e-10)
    assert np.allclose(axes.T @ axes, np.eye(k), atol=1e-12)
    assert np.allclose(c @ axes, axes * values, atol=1e-11 * values[0])


def test_tridiagonal_and_sturm_counts():
    draw = np.random.default_rng(6)
    a = draw.standard_normal((20, 20))
    a = a + a.T
    diagonal, off, q = whitening.tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(q @ t @ q.T, a) and np.allclose(q @ q.T, np.eye(20))
    exact = np.linalg.eigvalsh(a)
    at = np.linspace(-15, 15, 50)
    assert whitening.sturm_counts(diagonal, off, at).tolist() == [int((exact < x).sum()) for x in at]


def test_deviations_beyond_64_bits_of_products():
    assert whitening.deviations(np.array([[3_000_000_000], [1]])).tolist() == [9_000_000_000_000_000_000, 1]
    with pytest.raises(OverflowError):
        whitening.deviations(np.array([[4_000_000_000]]))
