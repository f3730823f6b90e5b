"""Exact top-k search by selecting the kth score in histograms.

Queries are taken in blocks of a fixed number, and every row of the table is
scored against each block. No score is stored or shuffled. A pass makes one
histogram of scores for each query and task, of which a task sends the highest
bins only, down to where it has counted ``k`` itself: the kth score of the whole
table cannot lie below. Summed up, they tell the bin that the kth score is in,
and the next pass divides that bin alone, until it is a single score or holds no
more rows than are wanted.

A last pass keeps what lies above that score. Rows with just that score are
taken by smallest id, as many as there is room for, so a score that very many
rows share adds at most ``k`` rows of a task to a query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
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

K = 10
SCALE = 1024
#: Rows whose id is divisible by this are the queries.
EVERY = 100
#: A histogram has at most ``2 ** BITS`` bins.
BITS = 8


@dataclass
class Search:
    """A block of queries and what is known of their kth scores."""

    keys: np.ndarray
    vectors: np.ndarray
    bound: float  # no score is larger
    k: int
    low: np.ndarray  # the kth score is not below
    shift: int  # bins are 2 ** shift wide
    above: np.ndarray  # rows that surely score higher than the last bin chosen
    inside: np.ndarray  # rows in that bin

    @property
    def open(self) -> np.ndarray:
        """Queries whose last bin has more rows than are wanted, and more than one score."""
        return (self.above + self.inside > self.k) & (self.shift > 0)

    def scores(self, batches: Iterator[pa.RecordBatch], chosen: np.ndarray):
        """``queries, ids, scores`` of all pairs but those of a query with its own row."""
        vectors, keys = self.vectors[chosen], self.keys[chosen]
        for batch in batches:
            found, ids = matrix(batch.column(1), self.vectors.shape[1]), batch.column(0).to_numpy()
            for r in slices(len(ids), ROWS):
                for c in slices(len(keys), COLUMNS):
                    scores = products(vectors[c], found[r], self.bound)
                    own = keys[c][:, None] == ids[None, r]
                    yield chosen[c], ids[r], scores, own


def _histograms(search: Search, made: DataFrame) -> DataFrame:
    """``query, wanted, bin, n``: the highest bins of every open query."""
    shared = made.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        chosen, shift = np.flatnonzero(s.open), max(0, s.shift - BITS)
        bins = 1 << (s.shift - shift)
        counts = np.zeros((len(s.keys), bins), np.int64)
        for queries, _, scores, own in s.scores(batches, chosen):
            place = (scores - s.low[queries][:, None]) >> shift
            place[own] = -1
            row, column = np.nonzero((place >= 0) & (place < bins))
            flat = row * bins + place[row, column]
            counts[queries] += np.bincount(flat, minlength=len(queries) * bins).reshape(-1, bins)
        higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
        wanted = s.k - s.above
        query, place = np.nonzero((counts > 0) & (higher < wanted[:, None]))
        columns = [query, wanted[query], place, counts[query, place]]
        names = ["query", "wanted", "bin", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    rows = made.mapInArrow(tidy(run), "query long, wanted long, bin long, n long")
    return rows.groupBy("query", "wanted", "bin").agg(F.sum("n").alias("n"))


def _narrowed(search: Search, made: DataFrame) -> Search:
    """``search`` after a pass; one row of each query comes to the driver."""
    by = Window.partitionBy("query").orderBy(F.desc("bin"))  # as many rows as there are bins
    rows = _histograms(search, made).withColumn("upto", F.sum("n").over(by))
    last = rows.where("upto >= wanted and upto - n < wanted").collect()
    shift = max(0, search.shift - BITS)
    low, above, inside = search.low.copy(), search.above.copy(), search.inside.copy()
    was_open = search.open
    inside[was_open] = 0  # fewer rows than wanted: all of them are
    for r in last:
        low[r["query"]] += r["bin"] << shift
        above[r["query"]] += r["upto"] - r["n"]
        inside[r["query"]] = r["n"]
    return replace(search, low=low, shift=shift, above=above, inside=inside)


def _selected(search: Search, made: DataFrame) -> DataFrame:
    """``query_id, vec_id, score``: at most a few rows of a task more than wanted."""
    shared = made.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        exact = s.above + s.inside > s.k  # ``low`` is then the kth score itself
        room = np.where(exact, s.k - s.above, s.k)
        tied = [np.empty(0, np.int64), np.empty(0, np.int64)]
        names = ["query_id", "vec_id", "score"]

        def batch(query, ids, scores):
            columns = [s.keys[query], ids, scores]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        for queries, ids, scores, own in s.scores(batches, np.arange(len(s.keys))):
            low = s.low[queries][:, None]
            more = (scores > low) | ((scores == low) & ~exact[queries][:, None])
            row, column = np.nonzero(more & ~own)
            if len(row):
                yield batch(queries[row], ids[column], scores[row, column])
            row, column = np.nonzero((scores == low) & exact[queries][:, None] & ~own)
            if len(row):
                query = np.r_[tied[0], queries[row]]
                key = np.r_[tied[1], ids[column]]
                first = best_of_groups(query, [key], room)
                tied = [query[first], key[first]]
        yield batch(tied[0], tied[1], s.low[tied[0]])

    return made.mapInArrow(tidy(run), "query_id long, vec_id long, score long")


def top_k(
    rows: DataFrame,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    every: int = EVERY,
    block: int = BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of every query.

    Components count as ``floor(scale * x)``. Queries are the rows whose key is
    divisible by ``every``; candidates are all rows but those of the query's own
    key. Ties go to the smaller key; with fewer candidates than ``k`` all come.
    Rows without a key, and vectors that are null or hold a null or non-finite
    component, take no part. Of shorter vectors the missing components count as
    zero. A repeated row is a candidate as often as it occurs, and of several
    rows with one query's key the least vector asks. Other columns are ignored,
    whatever their names; an empty table, or one without a query, gives an empty
    one. Products that do not fit a long are refused.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = rows.sparkSession
    small_batches(spark)
    made = whole_vectors(rows, key, vector, scale)
    made = materialize(made.withColumn("key", F.col("key").cast("long")), "vectors")
    dim, bound = extent(made)
    asked = made.where(F.col("key") % every == 0).groupBy("key").agg(F.min("v").alias("v"))
    asked = materialize(asked, "queries")
    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for part in blocks(asked, block):
        n, least = len(part), -math.ceil(bound)
        search = Search(
            keys=np.array([r["key"] for r in part], np.int64),
            vectors=as_matrix([r["v"] for r in part], dim),
            bound=bound,
            k=k,
            low=np.full(n, least, np.int64),
            shift=(-2 * least).bit_length(),
            above=np.zeros(n, np.int64),
            inside=np.full(n, k + 1, np.int64),
        )
        while search.open.any():
            search = _narrowed(search, made)
        found = found.unionByName(materialize(_selected(search, made), "selected"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
