"""The second round of the n-gram join, links among common sentences, and components with a hub."""

import random

import pytest

from ringcast.llm import jaccard
from ringcast.llm.components import connected_components
from ringcast.llm.ship import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def pool(n, seed=1, of=40, take=20, near=0):
    """Documents of ``take`` of ``of`` shared sentences; each of the last ``near`` is an earlier one with a word changed."""
    rng = random.Random(seed)
    sentences = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(12)) for _ in range(of)]
    out = [" ".join(rng.sample(sentences, take)) for _ in range(n - near)]
    for i in range(near):
        words = out[rng.randrange(n - near)].split()
        words[rng.randrange(len(words))] = f"new{i}"
        out.append(" ".join(words))
    return out


def brute(texts, width, num, den):
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and min(len(x), len(y)) * den >= max(len(x), len(y)) * num:
                both = len(x & y)
                if both * den >= (len(x) + len(y) - both) * num:
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80)])
def test_links_among_common_sentences(spark, width, num):
    texts = pool(260, near=60) + pool(40, seed=2, of=12, take=11)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs, width, num, 100, light=4).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, width, num, 100)
    assert len(set(got.values())) < len(texts) - 40


def test_components_with_a_hub(spark):
    """A third of all edges at one node, chains, loops, repeats and nulls."""
    edges = [(0, i) for i in range(1, 300)] + [(i, i + 1) for i in range(1000, 1600)] + [(5000, 5000), (None, 3), (7000, 7001), (7001, 7000)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(300)}, **{i: 1000 for i in range(1000, 1601)}, 7000: 7000, 7001: 7000}
