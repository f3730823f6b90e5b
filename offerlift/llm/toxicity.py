"""Toxicity by the nearest labelled examples.

A text is a TF-IDF vector over a vocabulary of words and word beginnings that
labelled toxic texts use more than others, plus one dimension for all of its
other words. The labelled vectors nearest to it by exact cosine cast a
distance-weighted vote. Its score is the share of toxic examples among fitted
examples of that vote, each of which was voted on by the others: an isotonic
regression learns the map from vote to share, so the threshold is a probability.

The examples lie in an inverted index whose postings are cut into ranges of
vector numbers. Each range keeps, for each term, the largest weight in it, so
the sum of query weight times largest weight bounds every cosine in the range.
Ranges are visited from the highest bound down until no bound can beat the
neighbours already found, which leaves the result exact.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.llm.texts import small_batches, text_or_empty, tidy
from offerlift.sources.workspace import materialize

#: Bound on the labelled rows that a model is fitted on.
MAX_EXAMPLES = 20_000
#: A term needs so many toxic examples, and a rate in toxic examples that is so many
#: times its rate in the others. Neither moves with the number of examples.
MIN_SUPPORT = 3
MIN_RATIO = 6.0
#: Votes are counted until so many examples have been met.
NEIGHBOURS = 12
#: Added to a neighbour's distance, one less its cosine, before it is inverted.
NEAR = 0.05
#: Weight of the overall rate of label 1 in every vote; an equal vector has 20.
PRIOR = 2.0
THRESHOLD = 0.3
#: Share of the vote itself in a score, which keeps texts of one calibrated value in order.
VOTE_SHARE = 0.01
BEGINNING = 5
RANGE = 256
_WORD = re.compile(r"\w+")
_REMEMBERED = 5_000
_REMEMBERED_WORDS = 50_000


def terms(text: str) -> tuple[Counter, int]:
    """Counts of words and of the beginnings of longer words, and number of words."""
    words = Counter(_WORD.findall(text.lower()))
    found = Counter(words)
    for word, n in words.items():
        if len(word) > BEGINNING:
            found["^" + word[:BEGINNING]] += n
    return found, sum(words.values())


class Known(dict):
    """Word to the numbers and weights of the terms it stands for, filled as words come."""

    def __init__(self, idf: dict[str, tuple[int, float]]):
        super().__init__()
        self.idf = idf

    def __missing__(self, word: str):
        parts = (word, "^" + word[:BEGINNING]) if len(word) > BEGINNING else (word,)
        found = tuple(self.idf[p] for p in parts if p in self.idf)
        if len(self) >= _REMEMBERED_WORDS:
            self.clear()
        self[word] = found
        return found


def vector(text: str, known: Known) -> tuple[tuple[int, ...], np.ndarray]:
    """Term numbers and unit-length TF-IDF weights; number 0 is for other words."""
    words = Counter(_WORD.findall(text.lower()))
    tf: dict[tuple[int, float], int] = {}
    other = words.total()
    for word in list(compress(words, map(known.__getitem__, words))):
        other -= words[word]
        for term in known[word]:
            tf[term] = tf.get(term, 0) + words[word]
    numbers = sorted((i, (1 + math.log(n)) * idf) for (i, idf), n in tf.items())
    # A text without a word stands where a text of other words stands.
    numbers.insert(0, (0, 1 + math.log(other) if other else float(not numbers)))
    weights = np.array([w for _, w in numbers])
    return tuple(t for t, _ in numbers), weights / math.sqrt(float(weights @ weights))


@dataclass
class Index:
    """Labelled vectors as postings with a largest weight per term and range."""

    idf: dict[str, tuple[int, float]]
    vectors: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    largest: np.ndarray
    count: np.ndarray
    toxic: np.ndarray
    example: list
    rate: float
    votes: np.ndarray = field(default_factory=lambda: np.empty(0))
    shares: np.ndarray = field(default_factory=lambda: np.empty(0))

    @classmethod
    def build(cls, idf, rows) -> Index:
        """``rows``: (key, label, terms, weights); equal vectors become one."""
        merged: dict = {}
        for key, label, numbers, weights in rows:
            at = (tuple(numbers), tuple(round(w, 9) for w in weights))
            n, t, first = merged.get(at, (0, 0, key))
            merged[at] = (n + 1, t + label, first)
        # Neighbours in this order share their heaviest terms, which makes bounds tight.
        order = sorted(merged, key=lambda v: ([v[0][i] for i in np.argsort(v[1])[::-1][:3]], v))
        n_ranges = max(1, -(-len(order) // RANGE))
        n_terms = len(idf) + 1
        postings = sorted(
            (t, i, w) for i, (ts, ws) in enumerate(order) for t, w in zip(ts, ws, strict=True)
        )
        term = np.array([p[0] for p in postings], np.int64)
        vectors = np.array([p[1] for p in postings], np.int64)
        weights = np.array([p[2] for p in postings], np.float64)
        slot = term * n_ranges + vectors // RANGE
        offsets = np.searchsorted(slot, np.arange(n_terms * n_ranges + 1))
        largest = np.zeros(n_terms * n_ranges)
        np.maximum.at(largest, slot, weights)
        stats = [merged[v] for v in order]
        total = sum(s[0] for s in stats)
        return cls(
            idf,
            vectors,
            weights,
            offsets,
            largest.reshape(n_terms, n_ranges),
            np.array([s[0] for s in stats], np.int64),
            np.array([s[1] for s in stats], np.int64),
            [s[2] for s in stats],
            sum(s[1] for s in stats) / total if total else 0.0,
        )

    def nearest(self, numbers, weights, k: int) -> list[tuple[float, int]]:
        """Cosine and number of the nearest vectors, until they stand for ``k`` examples.

        Vectors as near as the last one needed all belong to the result.
        """
        if not len(self.count):
            return []
        rows = np.array(numbers)
        bounds = weights @ self.largest[rows]
        n_ranges = self.largest.shape[1]
        near, place = np.empty(0), np.empty(0, np.int64)
        least = -1.0
        offsets = (rows * n_ranges).tolist()
        for r in np.argsort(-bounds, kind="stable").tolist():
            if bounds[r] < least - 1e-9 or bounds[r] <= 0:
                break
            scores = np.zeros(RANGE)
            for at, w in zip(offsets, weights.tolist(), strict=True):
                start, end = self.offsets[at + r : at + r + 2]
                if start < end:
                    scores[self.vectors[start:end] - r * RANGE] += w * self.weights[start:end]
            hits = np.flatnonzero(scores >= max(least - 1e-9, 1e-12))
            if not len(hits):
                continue
            near, place = np.r_[near, scores[hits]], np.r_[place, hits + r * RANGE]
            order = np.lexsort((place, -near))
            near, place = near[order], place[order]
            enough = np.searchsorted(np.cumsum(self.count[place]), k)
            if enough < len(near):
                least = near[enough]
                last = np.searchsorted(-near, -(least - 1e-9), "right")
                near, place = near[:last], place[:last]
        return list(zip(near.tolist(), place.tolist(), strict=True))

    def vote(self, near: list[tuple[float, int]], own: int | None = None) -> float:
        """The distance-weighted share of label 1 among neighbours.

        ``own`` is the label of the example that was asked about, which is then left
        out; as the nearest to itself it stands first.
        """
        near_by = [(s / (NEAR + max(0.0, 1 - s)), i) for s, i in near]
        votes = sum(w * self.count[i] for w, i in near_by)
        for_it = sum(w * self.toxic[i] for w, i in near_by)
        rate = self.rate
        if own is not None:
            votes, for_it = votes - near_by[0][0], for_it - near_by[0][0] * own
            total = int(self.count.sum())
            rate = (rate * total - own) / (total - 1) if total > 1 else 0.0
        return min(1.0, max(0.0, float((for_it + PRIOR * rate) / (votes + PRIOR))))

    def calibrated(self, vote: float) -> float:
        if not len(self.votes):
            return vote
        share = float(np.interp(vote, self.votes, self.shares))
        return (1 - VOTE_SHARE) * share + VOTE_SHARE * vote

    def score(self, text: str, known: Known, memory: dict, k: int = NEIGHBOURS):
        """Score of ``text`` and keys of its nearest examples; ``memory`` has earlier results."""
        numbers, weights = vector(text, known)
        at = (numbers, weights.tobytes())
        if at not in memory:
            if len(memory) >= _REMEMBERED:
                memory.clear()
            near = self.nearest(numbers, weights, k)
            value = self.calibrated(self.vote(near))
            memory[at] = (value, [self.example[i] for _, i in near[:3]])
        return memory[at]


def held_out(key: str = "doc_id"):
    """Rows that no model is fitted on: every fourth by checksum of the key."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_examples: int = MAX_EXAMPLES,
    min_support: int = MIN_SUPPORT,
    min_ratio: float = MIN_RATIO,
    min_chi2: float = 0.0,
) -> Index:
    """The index over at most ``max_examples`` labelled rows, chosen by hash of the key.

    Held-out rows, null keys and null labels are left out; a key with several
    labels has the larger one. Without any example every score is 0. What comes
    to the driver is bounded by ``max_examples`` vectors, the terms of their toxic
    texts and the steps of the map from votes to scores. ``min_chi2`` leaves out
    terms of a smaller chi-square as well.
    """
    small_batches(docs.sparkSession)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
    known = known.groupBy(key).agg((F.max(label) > 0).cast("int").alias("__label"))
    known = known.orderBy(F.xxhash64(key), key).limit(max_examples)
    known = known.select(F.col(key).alias("__key"), "__label")
    rows = docs.select(F.col(key).alias("__key"), text_or_empty(text).alias("__text"))
    rows = rows.join(F.broadcast(known), "__key").dropDuplicates(["__key"])
    rows = materialize(rows, "examples")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n, toxic = Counter(), Counter()
            for t, y in zip(frame["__text"], frame["__label"], strict=True):
                found = terms(t)[0]
                n.update(found.keys())
                if y:
                    toxic.update(found.keys())
            yield pd.DataFrame(
                {"term": list(n), "n": list(n.values()), "toxic": [toxic[t] for t in n]}
            )

    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum("__label"), F.lit(0))).first()
    used = rows.mapInPandas(tidy(count), "term string, n long, toxic long").groupBy("term")
    used = used.agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    # Of the two-by-two table of term and label, in doubles: counts of four factors overflow.
    n, toxic = F.col("n").cast("double"), F.col("toxic").cast("double")
    all_, ones = F.lit(float(total)), F.lit(float(positive))
    over = toxic * all_ - n * ones
    # Null where the term is in every example or all examples have one label.
    chi2 = F.try_divide(all_ * over * over, n * (all_ - n) * ones * (all_ - ones))
    often = toxic * (all_ - ones) >= (n - toxic) * ones * min_ratio
    best = used.where((over > 0) & often & (toxic >= min_support)).withColumn("chi2", chi2)
    best = best.where(F.col("chi2") >= min_chi2).orderBy(F.desc("chi2"), "term").collect()
    idf = {
        r.term: (i + 1, math.log((1 + total) / (1 + r.n)) + 1) for i, r in enumerate(best)
    }

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Known(idf)
        for frame in frames:
            made = [vector(t, known) for t in frame["__text"]]
            yield pd.DataFrame(
                {
                    "key": frame["__key"],
                    "label": frame["__label"],
                    "terms": [list(m[0]) for m in made],
                    "weights": [m[1] for m in made],
                }
            )

    schema = T.StructType(
        [
            T.StructField("key", rows.schema["__key"].dataType),
            T.StructField("label", T.IntegerType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("weights", T.ArrayType(T.DoubleType())),
        ]
    )
    placed = materialize(rows.mapInPandas(tidy(place), schema), "vectors")
    examples = sorted((tuple(r) for r in placed.collect()), key=lambda r: str(r[0]))
    index = Index.build(idf, examples)
    if examples:
        index.votes, index.shares = _calibration(placed, index)
    return index


def _calibration(placed: DataFrame, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Votes and shares of toxic examples, rising, from each example's vote by the others."""
    shared = placed.sparkSession.sparkContext.broadcast(index)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        for frame in frames:
            votes = []
            for own, numbers, weights in frame.itertuples(index=False):
                near = index.nearest(tuple(numbers), np.asarray(weights), NEIGHBOURS + 1)
                votes.append(round(index.vote(near, own), 12))
            yield pd.DataFrame({"label": frame["label"].astype(float), "vote": votes})

    spread = placed.repartition(F.xxhash64("key")).select("label", "terms", "weights")
    votes = spread.mapInPandas(tidy(run), "label double, vote double")
    # The regression sends equal votes to one task, so they arrive as one weighted row.
    equal = votes.groupBy("vote").agg(F.avg("label").alias("label"), F.count("*").alias("n"))
    equal = materialize(equal.withColumn("n", F.col("n").cast("double")), "votes")
    regression = IsotonicRegression(featuresCol="vote", labelCol="label", weightCol="n")
    model = regression.fit(equal)
    return model.boundaries.toArray(), model.predictions.toArray()


def score(docs: DataFrame, index: Index, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, evidence`` for every row; evidence are keys of the nearest examples.

    One pass over the rows, no shuffle. A null or empty text has no word and
    gets the score of texts without a telling term; without any example every
    score is 0. Repeated rows get equal scores, other columns are ignored, an
    empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("score", T.DoubleType()),
            T.StructField("evidence", T.ArrayType(kind)),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, memory = Known(shared.value.idf), {}
        for frame in frames:
            made = [shared.value.score(t, known, memory) for t in frame.iloc[:, 1]]
            yield pd.DataFrame(
                {
                    key: frame.iloc[:, 0],
                    "score": [m[0] for m in made],
                    "evidence": [m[1] for m in made],
                }
            )

    return docs.select(key, text_or_empty(text).alias("__text")).mapInPandas(tidy(run), schema)


def without_toxic(
    docs: DataFrame, index: Index, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns as they are."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, memory = Known(shared.value.idf), {}
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            scores = [shared.value.score(t or "", known, memory)[0] for t in texts]
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
