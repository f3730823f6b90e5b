"""Best-fit packing of tokenized texts into sequences of a fixed length.

Only the number of pieces of each length matters to a packing, and there are at
most as many lengths as a sequence has tokens. That histogram comes to the
driver, and a minimum-bin-slack packing of it is a list of patterns: for each
new sequence, a subset-sum dynamic program over the lengths still there, with
sums as the bits of one integer, finds the fullest feasible combination, longer
pieces first among equals. The combination stays the fullest as long as its
pieces last, so it is taken as often as they do. A pattern uses up a length or
leaves fewer than it needs, so the number of patterns is bounded by the sequence
length, whatever the number of texts.

The pieces are numbered within their length in parallel, and a piece's number
tells its pattern, sequence and offset.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.llm.texts import small_batches, tidy
from offerlift.llm.tokens import MAX_TOKENS, _as_bytes, worker_cache
from offerlift.sources.workspace import materialize

END = (0).to_bytes(4, "little")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def pieces(docs: DataFrame, path: str, key: str, text: str, capacity: int) -> DataFrame:
    """``key, piece, start, length, ids_crc32``: texts as token ids and a last id 0, cut."""
    small_batches(docs.sparkSession)
    longs = ("start", "length", "ids_crc32")
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField("piece", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in longs]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = worker_cache(path, _packed)
        for frame in frames:
            texts = [cache.tokens.pretokens(t) for t in frame.iloc[:, 1]]
            cache.fill(texts)
            rows = []
            for i, words in enumerate(texts):
                ids = b"".join(map(cache.__getitem__, words)) + END
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((i, n, at // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["row", "piece", *longs])
            out.insert(0, key, frame.iloc[:, 0].iloc[out["row"]].array)
            yield out.drop(columns="row")

    return _as_bytes(docs, key, text).mapInPandas(tidy(run), schema)


def fullest_patterns(
    counts: dict[int, int], capacity: int
) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns ``[(length, uses), ...]`` with how many sequences have them."""
    lengths = sorted(n for n, c in counts.items() if c)
    left = [counts[n] for n in lengths]
    all_sums = (1 << (capacity + 1)) - 1
    reach = [1]  # sums of the first i lengths, one bit each
    patterns = []
    while lengths:
        for n, c in zip(lengths[len(reach) - 1 :], left[len(reach) - 1 :], strict=True):
            sums, c, part = reach[-1], min(c, capacity // n), 1
            while c:
                part = min(part, c)
                sums |= (sums << (part * n)) & all_sums
                c -= part
                part *= 2
            reach.append(sums)
        rest = reach[-1].bit_length() - 1
        pattern = []
        for i in range(len(lengths) - 1, -1, -1):
            if not rest:
                break
            uses = min(left[i], rest // lengths[i])
            while not reach[i] >> (rest - uses * lengths[i]) & 1:
                uses -= 1
            if uses:
                pattern.append((i, uses))
                rest -= uses * lengths[i]
        times = min(left[i] // uses for i, uses in pattern)
        patterns.append(([(lengths[i], uses) for i, uses in pattern], times))
        for i, uses in pattern:
            left[i] -= times * uses
        lowest = min(i for i, _ in pattern)
        del reach[lowest + 1 :]
        lengths = [n for n, c in zip(lengths, left, strict=True) if c]
        left = [c for c in left if c]
    return patterns


def _slots(patterns) -> dict[str, np.ndarray]:
    """Runs of numbers within a length, with where they lead, in order of length and number."""
    rows, used, sequence = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length, uses in pattern:
            first = used.get(length, 0)
            rows.append((length, first, sequence, uses, offset))
            used[length] = first + times * uses
            offset += length * uses
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "sequence", "uses", "offset"), table.T, strict=True))


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    """Number of each row among those of its length, from 0, as ``number``.

    Rows of a length are dealt to parts by hash, so a frequent length is no
    single group.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(parts)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("length", "part").agg(F.count("*").alias("size"))
    sizes = sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    inside = Window.partitionBy("length", "part").orderBy(key, "piece", "ids_crc32")
    rows = rows.withColumn("inside", F.row_number().over(inside))
    rows = rows.join(sizes.drop("size"), ["length", "part"])
    number = F.col("before") + F.col("inside") - 1
    return rows.withColumn("number", number).drop("part", "before", "inside")


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = MAX_TOKENS,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` for every piece.

    A text is its token ids and id 0; only what is longer than ``capacity`` is
    cut. A null or empty text is id 0 alone. Every row of ``docs`` is packed,
    repeated ones too, and null keys are kept; other columns are ignored. An
    empty table gives an empty one.
    """
    cut = materialize(pieces(docs, path, key, text, capacity), "pieces")
    counts = dict(cut.groupBy("length").count().collect())  # at most ``capacity`` rows
    slots = docs.sparkSession.sparkContext.broadcast(_slots(fullest_patterns(counts, capacity)))
    rows = _numbered(cut, key)
    schema = T.StructType(
        [*cut.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = slots.value
        starts = table["length"] << 40 | table["first"]
        for frame in frames:
            length, number = frame["length"].to_numpy(), frame["number"].to_numpy()
            at = np.searchsorted(starts, length << 40 | number, "right") - 1
            inside = number - table["first"][at]
            frame["sequence_id"] = table["sequence"][at] + inside // table["uses"][at]
            frame["offset"] = table["offset"][at] + inside % table["uses"][at] * length
            yield frame.drop(columns="number")

    return rows.select(*cut.columns, "number").mapInPandas(tidy(run), schema)
