"""Hard negatives: rows of another label that score close below an anchor's positives.

Each vector is cut into segments, and for each segment its sum and its sum of
squares are stored, which give its mean and its deviation from the mean. With
``n`` components in a segment, the inner product of two segments is ``n`` times
the product of the means, plus or minus at most the product of the deviations.
So the summaries of two vectors bound their score from both sides. Neighbouring
segments are joined to coarser ones, whose summaries are sums of the finer ones.

Anchors are taken in blocks of a fixed number, and every row meets each block. A
pair is first bounded by the coarsest segments. Only pairs whose bounds touch the
scores that are still wanted are bounded again by finer ones, and only what is
left then is scored exactly. A task keeps the best few rows of each anchor, and
the last of them raises what is wanted from there on. The kept rows of all tasks
are ranked by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlift.llm.texts import small_batches, tidy
from offerlift.llm.vectors import (
    BLOCK,
    COLUMNS,
    ROWS,
    as_matrix,
    best_of_groups,
    blocks,
    extent,
    matrix,
    products,
    slices,
    whole_vectors,
)
from offerlift.sources.workspace import materialize

SCALE = 256
#: Rows whose id is divisible by this are the anchors.
EVERY = 100
POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least so many hundredths of the positive's score.
LEAST = 80
#: Segments of the stored summaries, and how many of them a coarser level joins.
SEGMENTS = 16
LEVELS = (4, 1)
_LOWEST, _HIGHEST = -(1 << 62), 1 << 62


def segment_ends(dim: int) -> list[int]:
    """Where the stored segments end; vectors of few components have fewer segments."""
    n = max(1, min(SEGMENTS, dim))
    return [dim * (i + 1) // n for i in range(n)]


def summaries(v: Column, dim: int) -> tuple[Column, Column]:
    """Sums and sums of squares of the segments of ``v``, as arrays of doubles."""
    ends = segment_ends(dim)

    def total(part: Column, square: bool) -> Column:
        def add(done: Column, x: Column) -> Column:
            return done + (x.cast("double") * x if square else x)

        return F.aggregate(part, F.lit(0.0), add)

    parts = [F.slice(v, s + 1, max(e - s, 1)) for s, e in zip([0, *ends], ends)]
    return F.array(*[total(p, False) for p in parts]), F.array(*[total(p, True) for p in parts])


def _factors(sums: np.ndarray, squares: np.ndarray, ends: list[int], joined: int):
    """Means and deviations per level, scaled so that products of rows are bounds."""
    at = np.arange(0, len(ends), joined)
    sizes = np.add.reduceat(np.diff([0, *ends]), at).clip(1)
    total = np.add.reduceat(sums, at, axis=1)
    mean = total / np.sqrt(sizes)
    spread = np.add.reduceat(squares, at, axis=1) - mean * mean
    return mean, np.sqrt(spread.clip(0))


@dataclass
class Wanted:
    """A block of anchors; each wants the best rows in one or more ranges of scores."""

    keys: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    bound: float
    same_label: bool
    low: np.ndarray  # anchors x ranges
    high: np.ndarray
    most: int

    def best(self, batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
        """Anchor, range, id and score of the best rows of ``batches``, and pairs scored."""
        dim = self.vectors.shape[1]
        ends, ranges = segment_ends(dim), self.low.shape[1]
        slack = 1 + 1e-7 * self.bound  # covers rounding, also of roots
        least = self.low.copy()  # rises as rows are found
        ours = [_factors(self.sums, self.squares, ends, j) for j in LEVELS]
        held = [np.empty(0, np.int64) for _ in range(3)]  # anchor and range, id, score
        scored = 0
        for batch in batches:
            ids, labels = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            vectors = matrix(batch.column(1), dim)
            sums, squares = (matrix(batch.column(i), len(ends)) for i in (3, 4))
            theirs = [_factors(sums, squares, ends, j) for j in LEVELS]
            for r in slices(len(ids), ROWS):
                for a in slices(len(self.keys), COLUMNS):
                    match = (self.labels[a][:, None] == labels[None, r]) == self.same_label
                    match &= self.keys[a][:, None] != ids[None, r]
                    low, high = least[a].min(axis=1), self.high[a].max(axis=1)
                    rows, columns = np.arange(a.start, a.stop), np.arange(r.start, r.stop)
                    for (mean, spread), (their_mean, their_spread) in zip(ours, theirs):
                        i, j = match.any(axis=1), match.any(axis=0)
                        rows, columns, low, high = rows[i], columns[j], low[i], high[i]
                        match = match[np.ix_(i, j)]
                        middle = mean[rows] @ their_mean[columns].T
                        reach = spread[rows] @ their_spread[columns].T + slack
                        match &= middle + reach >= low[:, None]
                        match &= middle - reach <= high[:, None]
                    i, j = match.any(axis=1), match.any(axis=0)
                    rows, columns, match = rows[i], columns[j], match[np.ix_(i, j)]
                    if not len(rows):
                        continue
                    scores = products(self.vectors[rows], vectors[columns], self.bound)
                    scored += scores.size
                    found = [held]
                    for t in range(ranges):
                        hit = match & (scores >= least[rows, t][:, None])
                        x, y = np.nonzero(hit & (scores <= self.high[rows, t][:, None]))
                        found.append([rows[x] * ranges + t, ids[columns[y]], scores[x, y]])
                    held = [np.concatenate(c) for c in zip(*found, strict=True)]
                    first = best_of_groups(held[0], [held[1], -held[2]], self.most)
                    held = [c[first] for c in held]
                    full = np.flatnonzero(np.bincount(held[0], minlength=least.size) == self.most)
                    last = np.full(least.size, _HIGHEST)
                    np.minimum.at(last, held[0], held[2])
                    least.flat[full] = np.maximum(least.flat[full], last[full])
        return held[0] // ranges, held[0] % ranges, held[1], held[2], scored


def _best(made: DataFrame, wanted: Wanted) -> DataFrame:
    """``anchor, range, key, score, pairs``: the best rows of all tasks for every range."""
    shared = made.sparkSession.sparkContext.broadcast(wanted)
    names = ["anchor", "range", "key", "score", "pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, of, key, score, pairs = shared.value.best(batches)
        columns = [shared.value.keys[anchor], of, key, score, np.full(len(key), pairs)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    rows = made.mapInArrow(tidy(run), ", ".join(f"`{n}` long" for n in names))
    order = Window.partitionBy("anchor", "range").orderBy(F.desc("score"), "key")
    return rows.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= wanted.most
    )


def hard_negatives(
    rows: DataFrame,
    label: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    every: int = EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose key is divisible by ``every``. A row's score is
    its inner product with the anchor, of components ``floor(scale * x)``. The
    first ``positives`` other rows of the anchor's label are its positives, and
    for each of them come the first ``negatives`` rows of other labels that
    score from ``least`` hundredths of the positive's score up to that score.
    Higher scores come first, ties by smaller key; with fewer rows, all come.

    Rows without a key or a label, and vectors that are null or hold a null or
    non-finite component, take no part. Of shorter vectors the missing
    components count as zero. Repeated rows count as often as they occur, rows
    with the anchor's key never; of several rows with one anchor's key the least
    vector, then label, is the anchor. Other columns are ignored, whatever their
    names; an empty table, or one without an anchor, gives an empty one.
    Products that do not fit a long are refused.
    """
    spark = rows.sparkSession
    small_batches(spark)
    made = whole_vectors(rows, key, vector, scale, {"label": label.cast("long")})
    made = made.where("label is not null").withColumn("key", F.col("key").cast("long"))
    plain = materialize(made, "vectors")
    dim, bound = extent(plain)
    sums, squares = summaries(F.col("v"), dim)
    made = plain.select("key", "v", "label", sums.alias("sums"), squares.alias("squares"))
    made = materialize(made, "summaries")
    best = F.min(F.struct("v", "label", "sums", "squares")).alias("best")
    anchors = made.where(F.col("key") % every == 0).groupBy("key").agg(best)
    anchors = materialize(anchors.select("key", "best.*"), "anchors")
    found = spark.createDataFrame(
        [],
        "anchor_id long, positive_id long, rank int, negative_id long,"
        " positive_score long, negative_score long",
    )
    for part in blocks(anchors, block):
        n_segments = len(segment_ends(dim))
        wanted = Wanted(
            keys=np.array([r["key"] for r in part], np.int64),
            labels=np.array([r["label"] for r in part], np.int64),
            vectors=as_matrix([r["v"] for r in part], dim),
            sums=np.array([r["sums"] for r in part]).reshape(-1, n_segments),
            squares=np.array([r["squares"] for r in part]).reshape(-1, n_segments),
            bound=bound,
            same_label=True,
            low=np.full((len(part), 1), _LOWEST),
            high=np.full((len(part), 1), _HIGHEST),
            most=positives,
        )
        near = materialize(_best(made, wanted), "positives")
        low = np.full((len(part), positives), _HIGHEST)
        high = np.full((len(part), positives), _LOWEST)
        place = {k: i for i, k in enumerate(wanted.keys.tolist())}
        for r in near.select("anchor", "rank", "score").collect():  # a few for each anchor
            low[place[r["anchor"]], r["rank"] - 1] = -(-least * r["score"] // 100)
            high[place[r["anchor"]], r["rank"] - 1] = r["score"]
        wanted.same_label, wanted.low, wanted.high, wanted.most = False, low, high, negatives
        far = _best(made, wanted).select("anchor", "range", "rank", "key", "score")
        near = near.select(
            "anchor",
            (F.col("rank") - 1).cast("long").alias("range"),
            F.col("key").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        joined = far.join(near, ["anchor", "range"]).select(
            F.col("anchor").alias("anchor_id"),
            "positive_id",
            "rank",
            F.col("key").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        found = found.unionByName(materialize(joined, "negatives"))
    return found
