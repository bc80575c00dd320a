"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

A bounded sample of labelled texts gives the vocabulary (words whose presence goes with the label,
by a chi-square test) and the examples. Inverse document frequencies are counted over all
documents. Each text is a vector of ``(1 + ln tf) * idf`` over the vocabulary, of length one.

The index holds, for each word, the examples that have it, and the largest weight among each
block of examples. For a query the blocks' bounds follow from the words it has; blocks are
scored from the largest bound on, until no bound can reach the neighbours already found. What
is found is the exact nearest ``k`` by cosine, ties by example id. Their votes are weighted by
distance, and a logistic fit on examples that were left out of the index makes a score of the vote.
A text without a word of the vocabulary has no neighbours; its vote is that of the examples
without neighbours.

The score depends on the words of the text alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, gathered, small_batches, steps, text_of, utf8

# Bound of the labelled rows that are read for fitting: those with the smallest hashes of id.
SAMPLE = 12_000
# Of those, one in so many calibrates the score and isn't in the index.
CALIBRATION = 5
NEIGHBOURS = 25
EVIDENCE = 3
BLOCK = 128
# A word is used if its chi-square is this large: one in ten million by chance.
CHI_SQUARE = 28.4
# Bound of the vocabulary: the words with the largest chi-square.
VOCABULARY = 4096


def word_counts(texts: pa.Array, vocabulary: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text, the places in the sorted hashes ``vocabulary`` of its words, and their counts."""
    data, offsets = utf8(texts)
    size = max(len(vocabulary), 1)
    for first, last in steps(offsets, trim=True):
        at = offsets[first : last + 1]
        words = _plain_words(data[at[0] : at[-1]], at - at[0])
        place = np.searchsorted(vocabulary, words.hash)
        known = place < len(vocabulary)
        known[known] = vocabulary[place[known]] == words.hash[known]
        keys, counts = np.unique(words.row[known] * size + place[known], return_counts=True)
        ends = np.searchsorted(keys, np.arange(last - first + 1) * size)
        for lo, hi in zip(ends[:-1], ends[1:]):
            yield keys[lo:hi] % size, counts[lo:hi]


def _plain_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-case words; ASCII signs and controls part words, digits and other bytes belong to them."""
    return Words(_PLAIN[data], offsets, lower=True)


_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[:128] = [b if chr(b).isalnum() else 32 for b in range(128)]


# --- fitting -------------------------------------------------------------------------


@dataclass
class Model:
    """What a task needs to score: vocabulary, weights and index. Bounded by the parameters."""

    vocabulary: np.ndarray  # sorted word hashes
    idf: np.ndarray
    ids: np.ndarray  # examples, in order of index
    labels: np.ndarray
    postings: list[tuple[np.ndarray, np.ndarray]]  # examples and weights of each word
    tops: np.ndarray  # largest weight of each word (row) in each block (column)
    alone: float  # vote of a text without neighbours
    slope: float = 1.0
    offset: float = 0.0

    def vector(self, places: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = (1 + np.log(counts)) * self.idf[places]
        norm = math.sqrt(float(w @ w))
        return w / norm if norm else w

    def nearest(self, places: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of largest cosine above 0 and their cosines, ties by place."""
        bounds = weights @ self.tops[places]
        order = np.argsort(-bounds, kind="stable")
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        step = 8
        for first in range(0, len(order), step):
            blocks = order[first : first + step]
            least = scores[k - 1] if len(scores) >= k else 0.0
            blocks = blocks[bounds[blocks] >= max(least - 1e-12, 1e-12)]
            if not len(blocks):
                break
            total = np.zeros((len(blocks), BLOCK))
            for p, w in zip(places, weights):
                at, value = self.postings[p]
                for row, block in enumerate(blocks):
                    lo, hi = np.searchsorted(at, (block * BLOCK, (block + 1) * BLOCK))
                    total[row, at[lo:hi] - block * BLOCK] += w * value[lo:hi]
            row, column = np.nonzero(total > 0)
            found = np.concatenate([found, blocks[row] * BLOCK + column])
            scores = np.concatenate([scores, total[row, column]])
            best = np.lexsort((found, -np.round(scores, 12)))[:k]
            found, scores = found[best], scores[best]
        return found, scores

    def vote(self, found: np.ndarray, scores: np.ndarray) -> float:
        """Share of label 1 among the neighbours, weighted by the inverse of their distance."""
        if not len(found):
            return self.alone
        weight = 1 / (1.05 - np.minimum(scores, 1.0))
        return float(weight @ self.labels[found] / weight.sum())

    def score(self, vote: float) -> float:
        return 1 / (1 + math.exp(-(self.slope * vote + self.offset)))


def _index(vectors: list[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[list, np.ndarray]:
    lists: list[list[tuple[int, float]]] = [[] for _ in range(size)]
    for number, (places, weights) in enumerate(vectors):
        for p, w in zip(places.tolist(), weights.tolist()):
            lists[p].append((number, w))
    blocks = -(-len(vectors) // BLOCK) or 1
    tops = np.zeros((size, blocks))
    postings = []
    for p, items in enumerate(lists):
        at = np.array([i for i, _ in items], np.int64)
        weights = np.array([w for _, w in items])
        if len(at):
            np.maximum.at(tops[p], at // BLOCK, weights)
        postings.append((at, weights))
    return postings, tops


def _logistic(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the score, by Newton's method with a small ridge; slope above 0."""
    x = np.stack([votes, np.ones(len(votes))], axis=1)
    w = np.array([4.0, -2.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (labels - p) - 1e-2 * (w - np.array([4.0, -2.0]))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        change = np.linalg.solve(hessian, gradient)
        w = w + change
        if np.abs(change).max() < 1e-9:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0.1 else (4.0, -2.0)


def training_rows(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, sample: int) -> DataFrame:
    """``id, text, label`` of at most ``sample`` labelled texts outside the held-out fold.

    Null labels and ids and repeated label rows of two minds are left out. The sample is bounded,
    so that it is broadcast to the documents, which don't move.
    """
    known = labels.select(labels[id].alias("id"), labels[label].cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out("id"))
    known = known.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    known = known.filter("label = most").select("id", "label")
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(docs[id].alias("id"), text_of(docs[text]).alias("text"))
    return rows.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"), F.min("label").alias("label"))


def held_out(id: str) -> Column:
    """Whether an id is in the fold that nothing is learnt from; null is not."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _vocabulary(rows: DataFrame) -> np.ndarray:
    """Hashes of the words that go with the label, by their presence in the sample's texts."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            data, offsets = utf8(batch.column(0))
            w = _plain_words(data, offsets)
            pairs = np.unique(np.stack([w.hash, label[w.row].astype(np.uint64), w.row.astype(np.uint64)]), axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].astype(np.int32))], ["word", "label"]
            )

    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = float(n.get(1, 0)), float(n.get(0, 0))
    if not ones or not zeros:
        return np.zeros(0, np.uint64)
    counts = rows.select("text", "label").mapInArrow(words, "word long, label int").groupBy("word")
    counts = counts.agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    a, b = F.col("a"), F.col("b")
    c, d = F.lit(ones) - a, F.lit(zeros) - b
    cross = a * d - b * c
    chi = F.lit(ones + zeros) * cross * cross / ((a + b) * (c + d) * F.lit(ones) * F.lit(zeros))
    best = counts.withColumn("chi", chi).filter(F.col("chi") >= CHI_SQUARE)
    best = best.orderBy(F.desc("chi"), "word").limit(VOCABULARY)
    return np.sort(np.array([r["word"] for r in best.collect()], np.int64).view(np.uint64))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    small_batches(docs.sparkSession)
    rows = training_rows(docs, labels, id, text, label, sample).persist()
    vocabulary = _vocabulary(rows)
    size = max(len(vocabulary), 1)

    def fill(counts: np.ndarray, batch: pa.RecordBatch) -> None:
        for places, _ in word_counts(batch.column(0), vocabulary):
            counts[places] += 1
            counts[-1] += 1

    room = 64 * (-(-(size + 1) // 64))
    frequency = gathered(docs.select(text_of(docs[text])), room, "int64", fill)
    idf = np.log((1.0 + frequency[-1]) / (1.0 + frequency[:size])) + 1.0

    @F.arrow_udf("struct<places:array<int>,counts:array<int>>")
    def known(texts: pa.Array) -> pa.Array:
        pairs = list(word_counts(texts, vocabulary))
        lists = [pa.array([p[i].tolist() for p in pairs], pa.list_(pa.int32())) for i in (0, 1)]
        return pa.StructArray.from_arrays(lists, ["places", "counts"])

    found = rows.select("id", "label", known("text").alias("v")).orderBy("id").collect()
    rows.unpersist()
    examples = [r for i, r in enumerate(found) if i % CALIBRATION]
    others = [r for i, r in enumerate(found) if not i % CALIBRATION]
    array = lambda r: (np.array(r["v"]["places"], np.int64), np.array(r["v"]["counts"], np.float64))
    model = Model(
        vocabulary,
        idf,
        np.array([r["id"] for r in examples], np.int64),
        np.array([r["label"] for r in examples], np.float64),
        [],
        np.zeros((size, 1)),
        0.0,
    )
    # Like examples share blocks, so that few blocks have large bounds for a query.
    vectors = [(p, model.vector(p, c)) for p, c in map(array, examples)]
    order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0].tolist(), model.ids[i]))
    model.ids, model.labels = model.ids[order], model.labels[order]
    vectors = [vectors[i] for i in order]
    model.postings, model.tops = _index(vectors, size)
    bare = np.array([not len(p) for p, _ in vectors], bool)
    if bare.any():
        model.alone = float(model.labels[bare].mean())
    elif len(vectors):
        model.alone = float(model.labels.mean())
    if len(others):
        votes = [model.vote(*model.nearest(p, model.vector(p, c), NEIGHBOURS)) for p, c in map(array, others)]
        model.slope, model.offset = _logistic(np.array(votes), np.array([r["label"] for r in others], np.float64))
    return model


# --- scoring -------------------------------------------------------------------------


def _judged(model: Broadcast) -> Column:
    @F.arrow_udf("score double, evidence array<struct<example:long,label:int,cosine:double>>")
    def judge(texts: pa.Array) -> pa.Array:
        m: Model = model.value
        scores, evidence = [], []
        known: dict[bytes, tuple] = {}
        for places, counts in word_counts(texts, m.vocabulary):
            key = places.tobytes() + counts.tobytes()
            if key not in known:
                found, cosines = m.nearest(places, m.vector(places, counts), NEIGHBOURS)
                near = zip(found[:EVIDENCE].tolist(), cosines[:EVIDENCE].tolist())
                known[key] = (
                    m.score(m.vote(found, cosines)),
                    [{"example": int(m.ids[i]), "label": int(m.labels[i]), "cosine": c} for i, c in near],
                )
            scores.append(known[key][0])
            evidence.append(known[key][1])
        kind = pa.list_(pa.struct([("example", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(evidence, kind)], ["score", "evidence"])

    return judge.asNondeterministic()


def judged(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """``score, evidence`` of a text column; null is an empty text."""
    return _judged(docs.sparkSession.sparkContext.broadcast(model))(text_of(docs[text]))


def scored(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic"
) -> DataFrame:
    """``id, held_out, score, predicted, evidence`` of each row, null and repeated ids included.

    ``evidence`` has the nearest examples with their labels and cosines. Without any labelled row,
    or with labels of one kind, no word is known, and all texts get one score.
    """
    model = fit(docs, labels, id, text, label)
    rows = docs.select(docs[id].alias("id"), judged(docs, model, text).alias("j"))
    return rows.select(
        F.col("id").alias(id),
        held_out("id").alias("held_out"),
        "j.score",
        (F.col("j.score") >= 0.5).cast("int").alias("predicted"),
        "j.evidence",
    )
