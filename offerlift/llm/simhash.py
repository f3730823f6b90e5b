"""Near duplicates by SimHash, found in a grid of per-segment bit counts.

A 64-bit fingerprint is cut into segments of two bits and embedded as its 32 bit
counts. The Manhattan distance of two embeddings is never larger than the
number of differing bits. The grid has one layer for every choice of ``kept``
out of ``kept + distance`` runs of segments, and a cell is the bit counts of the
chosen runs: embeddings at most ``distance`` apart differ in at most
``distance`` runs, so they share a cell of some layer. What shares a cell is
tested by the bound on all counts and then by the exact number of bits.

Counts are kept in unary inside their segment (00, 01, 11), so the Manhattan
distance is the number of ones of an exclusive or.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.llm.components import components
from offerlift.llm.sketch import mark_possible
from offerlift.llm.texts import keeps_names, small_batches, text_or_empty, tidy
from offerlift.sources.workspace import materialize

SHINGLE = 4
DISTANCE = 4
SEED = 42
SEGMENTS = 32
_LOW_BITS = 0x5555555555555555
#: Members of a crowded cell that one task compares with as many others.
BLOCK = 4096


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of the word shingles of ``text``; 0 without a word."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    shingles = zip(*(words[i:] for i in range(width)), strict=False)
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    n = len(words) - width + 1
    hashes = np.fromiter(map(digest, map(b" ".join, shingles)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        part = np.ascontiguousarray(hashes[at : at + 65536], "<u8").view(np.uint8)
        ones += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """``key, bits``: one row per row of ``docs``, the fingerprint as a signed long."""
    schema = T.StructType([docs.schema[key], T.StructField("bits", T.LongType())])
    schema[0].nullable = True

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bits = np.array([fingerprint(t, shingle) for t in frame.iloc[:, 1]], np.uint64)
            yield pd.DataFrame({key: frame.iloc[:, 0], "bits": bits.view(np.int64)})

    small_batches(docs.sparkSession)
    return docs.select(key, text_or_empty(text).alias("__text")).mapInPandas(tidy(run), schema)


def embedded(bits: Column) -> Column:
    """Bit counts of the two-bit segments, each in unary in its own segment."""
    low = bits.bitwiseAND(F.lit(_LOW_BITS))
    high = F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(_LOW_BITS))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseOR(high))


def _layers(kept: int, distance: int) -> list[int]:
    """Masks over the embedding, one for every choice of ``kept`` runs."""
    runs = np.array_split(np.arange(SEGMENTS), kept + distance)
    masks = [sum(3 << int(2 * s) for s in run) for run in runs]
    chosen = (sum(c) for c in combinations(masks, kept))
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def kept_runs(n: int, distance: int = DISTANCE) -> int:
    """How many runs a cell fixes, from the number of fingerprints.

    More runs give more layers, so more rows per fingerprint, and smaller cells.
    The result is the same for every choice; the least work is taken, a row
    counted as twenty comparisons and a segment as one and a half bits.
    """

    def work(kept: int) -> float:
        layers = len(list(combinations(range(kept + distance), kept)))
        cells = 2.0 ** (1.5 * SEGMENTS * kept / (kept + distance))
        return layers * (20 + n / cells)

    return min(range(1, 7), key=work)


def _spanning(key: np.ndarray, bits: np.ndarray, unary: np.ndarray, distance: int):
    """Links that connect what is near within equal, adjacent keys; at most n - 1."""
    n = len(bits)
    label = np.arange(n)
    a_all, b_all = [], []
    step = 1
    while step < n:
        i = np.flatnonzero(key[:-step] == key[step:])
        if not len(i):
            break
        j = i + step
        i, j = i[label[i] != label[j]], j[label[i] != label[j]]
        near = np.bitwise_count(unary[i] ^ unary[j]) <= distance
        i, j = i[near], j[near]
        near = np.bitwise_count(bits[i] ^ bits[j]) <= distance
        for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True):
            while label[x] != x:
                label[x] = label[label[x]]
                x = label[x]
            while label[y] != y:
                label[y] = label[label[y]]
                y = label[y]
            if x != y:
                label[max(x, y)] = min(x, y)
                a_all.append(x)
                b_all.append(y)
        while not np.array_equal(label, label[label]):
            label = label[label]
        step += 1
    return bits[np.array(a_all, np.int64)], bits[np.array(b_all, np.int64)]


def links(distinct: DataFrame, distance: int = DISTANCE, kept: int | None = None) -> DataFrame:
    """``a, b``: links between fingerprints that join all that are near each other.

    ``distinct`` has each fingerprint once, as ``bits``. Within a cell the links
    are a spanning forest of the near pairs, so a crowd of near copies costs as
    many rows as it has members. Cells of more than ``BLOCK`` members are cut
    into blocks, and pairs of blocks are compared in separate groups.
    """
    kept = kept_runs(distinct.count(), distance) if kept is None else kept
    unary = embedded(F.col("bits"))
    layers = F.array(
        *[
            F.struct(F.lit(i).alias("layer"), F.col("unary").bitwiseAND(F.lit(m)).alias("cell"))
            for i, m in enumerate(_layers(kept, distance))
        ]
    )
    placed = distinct.select("bits", unary.alias("unary")).select("bits", F.inline(layers))
    crowds = placed.groupBy("layer", "cell").agg(F.count("*").alias("members"))
    crowds = crowds.where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("bits"), F.col("blocks")).cast("int")
    met = placed.join(crowds, ["layer", "cell"]).withColumn("blocks", blocks)
    met = met.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    met = met.select(
        F.xxhash64("layer", "cell", F.least("own", "other"), F.greatest("own", "other")).alias(
            "meeting"
        ),
        "bits",
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, bits = np.empty(0, np.int64), np.empty(0, np.uint64)

        def linked(key, bits):
            x = bits & np.uint64(_LOW_BITS)
            y = (bits >> np.uint64(1)) & np.uint64(_LOW_BITS)
            unary = ((x & y) << np.uint64(1)) | (x | y)
            a, b = _spanning(key, bits, unary, distance)
            return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

        for frame in frames:
            key = np.concatenate([key, frame["meeting"].to_numpy(np.int64)])
            bits = np.concatenate([bits, frame["bits"].to_numpy(np.int64).view(np.uint64)])
            if not len(key):
                continue
            whole = int(np.searchsorted(key, key[-1]))  # the last group may go on
            if whole:
                yield linked(key[:whole], bits[:whole])
                key, bits = key[whole:], bits[whole:]
        if len(key):
            yield linked(key, bits)

    sorted_meetings = met.repartition("meeting").sortWithinPartitions("meeting", "bits")
    return sorted_meetings.mapInPandas(tidy(run), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """``key, fingerprint, component_id`` of every row of ``docs``.

    Rows are linked when their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the smallest key reachable over links. Fingerprints are
    made distinct before they are compared, so exact copies cost one
    comparison. A null text counts as empty; a text without words has
    fingerprint zero and is linked like any other. Repeated rows stay repeated.
    A component whose keys are all null has a null id. Other columns, whatever
    their names, are ignored; an empty table gives an empty one.
    """
    made = materialize(fingerprints(docs, key, text, shingle), "simhash")
    distinct = materialize(made.groupBy("bits").agg(F.min(key).alias("first")), "simhash")
    labels = components(links(distinct, distance))
    named = distinct.join(labels, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("label", "bits").alias("label")
    )
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = named.join(least, "label").select(F.col("bits").alias("__bits"), "component_id")
    return made.join(classes, F.col("bits") == F.col("__bits")).select(
        key, F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )


@keeps_names
def without_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest key.

    Of repeated rows one stays. Rows without a key get one above all others
    from their text. Keys are whole numbers. A null text counts as empty, all
    texts without words are one component, an empty table gives an empty one.
    Only rows that may have to go are shuffled.
    """
    spare = F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit(1 << 61))
    keyed = docs.withColumn("__key", F.coalesce(F.col(key).cast("long"), spare))
    found = near_duplicates(keyed, "__key", text, shingle, distance).groupBy("__key")
    found = found.agg(F.min("component_id").alias("first"), F.count("*").alias("rows"))
    gone = F.col("__key") != F.col("first")
    facts = materialize(
        found.where(gone | (F.col("rows") > 1)).select("__key", gone.alias("__gone")), "copies"
    )
    rows = mark_possible(keyed, "__key", facts, "__possible")
    checked = rows.where("__possible").join(facts, "__key", "left")
    checked = checked.where(~F.coalesce("__gone", F.lit(False))).dropDuplicates(["__key"])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return rows.where("not __possible").select(*columns).unionByName(checked.select(*columns))
