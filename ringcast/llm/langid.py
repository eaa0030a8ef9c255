"""Language identification: a linear-chain CRF that labels the words of a text.

A word's features are hashed affixes (its first and last bytes), byte n-grams
with word ends marked, and the word itself (the lexicon); each has a weight per
language, and transitions between the languages of neighbouring words are
learned with them. Training takes a bounded sample of labelled documents
(``train_docs``, a documented parameter: an equal share of each language, one
document of each at least, filled up from all; smallest id hash first), cuts them
into runs of words and strings runs of different documents together, so that
sequences switch language as code-switched texts do; weights follow the
gradient of the log likelihood (forward-backward) with AdaGrad steps.

Scoring labels every word of every whole text by forward-backward. Texts are cut
into blocks only to run them side by side: blocks are joined by their exact
transfer matrices, so the marginals are those of the whole text. A document's
prediction is the language with the highest sum of word marginals, its score
the mean of them.

Defined results: null texts and texts without a letter: ``und``, score 0. Words
without a letter have marginals but no vote. A null lang is not learned; a null
doc_id is held out. Rows that repeat a doc_id are scored one by one. With
nothing to learn from, all predictions are ``und``. Ties go to the language
that sorts first. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ringcast.llm import words as W
from ringcast.llm.classifier import held_out
from ringcast.session import materialize

BITS = 18
TRAIN_DOCS = 1200
SEQUENCE = 32
BATCH = 64
RATE = 0.15
BLOCK = 64
UNDEFINED = "und"


def word_features(words: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of the words, and the word each belongs to."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    data = W.LOWER[np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8)]
    starts = np.cumsum(lengths + 1) - lengths
    ends = starts + lengths
    own = np.arange(len(words))
    shift = np.uint64(64 - bits)
    slots, owners = [], []

    def add(h: np.ndarray, kind: int, owner: np.ndarray) -> None:
        slots.append((W.mix(h + np.uint64(kind)) >> shift).astype(np.int64))
        owners.append(owner)

    add(W.hash_spans(data, starts, ends), 1, own)
    for k in (2, 3, 4):
        add(W.hash_spans(data, starts, np.minimum(starts + k, ends)), 10 + k, own)
        add(W.hash_spans(data, np.maximum(ends - k, starts), ends), 20 + k, own)
    wide = data.astype(np.uint64)
    for n in (2, 3):
        count = lengths + 3 - n
        at = W.spread(starts - 1, np.maximum(count, 0))
        gram = np.zeros(len(at), dtype=np.uint64)
        for k in range(n):
            gram = gram * np.uint64(256) + wide[at + k]
        add(gram, 30 + n, np.repeat(own, np.maximum(count, 0)))
    return np.concatenate(slots), np.concatenate(owners)


def emissions(words: list[bytes], weights: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Score of each word for each language."""
    slots, owner = word_features(words, bits)
    return np.stack([np.bincount(owner, weights=weights[:, k][slots], minlength=len(words))
                     for k in range(weights.shape[1])], axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def train_step(e: np.ndarray, y: np.ndarray, trans: np.ndarray, begin: np.ndarray):
    """Gradients of the negative log likelihood of sequences e [s, t, l], y [s, t]."""
    n, length, k = e.shape
    x = np.exp(e - e.max(axis=2, keepdims=True))
    a, p = np.exp(trans), np.exp(begin)
    alpha, beta = np.empty_like(x), np.ones_like(x)
    alpha[:, 0] = _unit(p * x[:, 0])
    for t in range(1, length):
        alpha[:, t] = _unit((alpha[:, t - 1] @ a) * x[:, t])
    for t in range(length - 2, -1, -1):
        beta[:, t] = _unit((x[:, t + 1] * beta[:, t + 1]) @ a.T)
    hot = np.eye(k)[y]
    g_e = _unit(alpha * beta) - hot
    pair = alpha[:, :-1, :, None] * a * (x * beta)[:, 1:, None, :]
    pair /= np.maximum(pair.sum(axis=(2, 3), keepdims=True), 1e-300)
    g_t = pair.sum(axis=(0, 1)) - np.einsum("sti,stj->ij", hot[:, :-1], hot[:, 1:])
    return g_e, g_t, g_e[:, 0].sum(axis=0)


def fit(texts: list[list[bytes]], labels: list[int], classes: int, bits: int = BITS, seed: int = 7):
    """(weights, transitions, begin) from documents' words and languages."""
    rng = np.random.default_rng(seed)
    runs = []
    for words, y in zip(texts, labels):
        at = 0
        while at < len(words):
            k = int(rng.integers(4, 25))
            runs.append((words[at:at + k], y))
            at += k
    rng.shuffle(runs)
    words = [w for run, _ in runs for w in run]
    y = np.array([c for run, c in runs for _ in run], dtype=np.int64)
    weights, sums = np.zeros((1 << bits, classes)), np.full((1 << bits, classes), 1e-3)
    trans, begin = np.zeros((classes, classes)), np.zeros(classes)
    trans_sum, begin_sum = np.full_like(trans, 1e-3), np.full_like(begin, 1e-3)
    size = SEQUENCE * BATCH
    for lo in range(0, len(words) - SEQUENCE + 1, size):
        n = min(BATCH, (len(words) - lo) // SEQUENCE)
        slots, owner = word_features(words[lo:lo + n * SEQUENCE], bits)
        e = np.stack([np.bincount(owner, weights=weights[:, k][slots], minlength=n * SEQUENCE)
                      for k in range(classes)], axis=1).reshape(n, SEQUENCE, classes)
        g_e, g_t, g_b = train_step(e, y[lo:lo + n * SEQUENCE].reshape(n, SEQUENCE), trans, begin)
        unique, back = np.unique(slots, return_inverse=True)
        flat = g_e.reshape(-1, classes)
        g = np.stack([np.bincount(back, weights=flat[:, k][owner]) for k in range(classes)], axis=1) / n
        sums[unique] += g * g
        weights[unique] -= RATE * g / np.sqrt(sums[unique])
        g_t, g_b = g_t / n, g_b / n
        trans_sum += g_t * g_t
        trans -= RATE * g_t / np.sqrt(trans_sum)
        begin_sum += g_b * g_b
        begin -= RATE * g_b / np.sqrt(begin_sum)
    return weights, trans, begin


def marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Marginals of each word; ``first`` has each text's first word and the end."""
    n, k = e.shape
    count = np.diff(first)
    blocks = -(-count // BLOCK)
    total = int(blocks.sum())
    if not total:
        return np.zeros((0, k))
    text = np.repeat(np.arange(len(count)), blocks)
    number = W.spread(np.zeros(len(blocks), dtype=np.int64), blocks)
    start = first[text] + number * BLOCK
    size = np.minimum(BLOCK, first[text + 1] - start)
    place = start[:, None] + np.minimum(np.arange(BLOCK)[None, :], size[:, None] - 1)
    x = np.exp(e - e.max(axis=1, keepdims=True))[place]
    live = np.arange(BLOCK)[None, :] < size[:, None]
    a, p = np.exp(trans), np.exp(begin)
    head = number == 0
    step = np.where(head[:, None, None], np.eye(k), a)  # the first word of a text follows nothing
    r = step * x[:, 0][:, None, :]
    for t in range(1, BLOCK):
        on = np.flatnonzero(live[:, t])
        if not len(on):
            break
        nxt = (r[on] @ a) * x[on, t][:, None, :]
        r[on] = nxt / np.maximum(nxt.max(axis=(1, 2), keepdims=True), 1e-300)
    enter, leave = np.empty((total, k)), np.ones((total, k))
    enter[head] = p
    of_text = np.cumsum(blocks) - blocks
    for j in range(1, int(blocks.max())):
        b = of_text[blocks > j] + j
        enter[b] = _unit(np.einsum("bi,bij->bj", enter[b - 1], r[b - 1]))
    for j in range(int(blocks.max()) - 1, 0, -1):
        b = of_text[blocks > j] + j
        leave[b - 1] = _unit(np.einsum("bij,bj->bi", r[b], leave[b]))
    alpha, beta = np.empty_like(x), np.empty_like(x)
    alpha[:, 0] = _unit(np.where(head[:, None], enter, enter @ a) * x[:, 0])
    for t in range(1, BLOCK):
        alpha[:, t] = _unit((alpha[:, t - 1] @ a) * x[:, t])
    state = leave
    for t in range(BLOCK - 1, -1, -1):
        beta[:, t] = state
        state = np.where(live[:, t, None], _unit((x[:, t] * state) @ a.T), state)
    return _unit(alpha * beta)[live]


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, bits: int = BITS):
    """(languages, model bytes) from labelled documents outside the holdout."""
    known = docs.filter("lang is not null and text is not null and doc_id is not null").filter(~held_out(4, 2))
    marked = materialize(known.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct(), "langid-labelled")
    order = ["h", "doc_id", "lang"]
    k = max(1, marked.select("lang").distinct().count())
    # an equal share of each language, then the smallest hashes of all that are left
    share = max(1, train_docs // k)
    fair = materialize(marked.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
                       .filter(F.col("at") <= share).drop("at"), "langid-fair") if k > 1 else marked.limit(0)
    rest = marked.join(F.broadcast(fair), ["lang", "doc_id"], "left_anti").select(*marked.columns) \
        .orderBy(*order).limit(max(0, train_docs - fair.count()))
    sample = fair.union(rest).select("lang", "doc_id")
    # one row of an id that repeats: the sample is bounded by rows, not by ids
    rows = known.select("doc_id", "lang", "text").join(F.broadcast(sample), ["lang", "doc_id"]) \
        .groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text")) \
        .repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), F.xxhash64("text")).select("lang", "text")

    def learn(batches):
        texts, langs = [], []
        for batch in batches:
            langs += batch.column(0).to_pylist()
            texts += [t.encode().split() for t in batch.column(1).to_pylist()]
        names = sorted(set(langs))
        if names:
            w, t, b = fit(texts, [names.index(x) for x in langs], len(names), bits)
            blob = zlib.compress(b"".join(x.astype("<f4").tobytes() for x in (w, t, b)), 1)
            yield pa.record_batch({"names": pa.array([names], pa.list_(pa.string())), "model": pa.array([blob], pa.binary())})

    made = rows.mapInArrow(learn, "names array<string>, model binary").first()
    return (list(made.names), bytes(made.model)) if made else ([], b"")


_LETTER = np.zeros(256, dtype=np.int64)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = 1


def predict(docs: DataFrame, names: list[str], model: bytes, bits: int = BITS, words: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; with ``words`` also
    the language of each of its words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    k = len(names)

    def run(batches):
        if k:
            flat = np.frombuffer(zlib.decompress(shared.value), dtype="<f4").astype(np.float64)
            weights, rest = flat[:k << bits].reshape(-1, k), flat[k << bits:]
            trans, begin = rest[:k * k].reshape(k, k), rest[k * k:]
            table = W.SpanTable(lambda new: emissions(new, weights, bits), limit=600_000)
        for rows, data, offsets in W.chunks(batches):
            n = rows.num_rows
            best, share, langs = np.zeros(n, dtype=np.int64), np.zeros(n), [[] for _ in range(n)]
            if k:
                starts, ends, first = W.find_words(data, offsets)
                at = table.look_up(W.hash_spans(data, starts, ends), data, starts, ends)
                e = table.values[at] if len(at) else np.zeros((0, k))
                m = marginals(e, first, trans, begin)
                seen = np.concatenate([[0], np.cumsum(_LETTER[data])])
                vote = (seen[ends] > seen[starts]).astype(np.float64)
                owner = np.repeat(np.arange(n), np.diff(first))
                votes = np.maximum(np.bincount(owner, weights=vote, minlength=n), 1)
                sums = np.stack([np.bincount(owner, weights=m[:, j] * vote, minlength=n) for j in range(k)], axis=1)
                best, share = sums.argmax(axis=1), np.minimum(sums.max(axis=1) / votes, 1.0)
                if words:
                    label = m.argmax(axis=1)
                    langs = [[names[j] for j in label[a:b]] for a, b in zip(first[:-1], first[1:])]
            letter = rows.column(3).to_numpy(zero_copy_only=False) & (k > 0)
            cols = [rows.column(0), rows.column(2),
                    pa.array([names[b] if ok else UNDEFINED for b, ok in zip(best.tolist(), letter.tolist())]),
                    pa.array(np.where(letter, share, 0.0))]
            yield pa.record_batch(cols + [pa.array(langs, pa.list_(pa.string()))] * words,
                                  names=["doc_id", "held_out", "lang_pred", "score"] + ["word_langs"] * words)

    schema = "doc_id long, held_out boolean, lang_pred string, score double" + ", word_langs array<string>" * words
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select("doc_id", "text", held_out(4, 2).alias("held_out"), letter.alias("letter")).mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, *train(docs))
