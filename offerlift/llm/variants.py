"""Spelling variants of the words of a corpus, joined by pivotal grams.

Two words are near if one insertion, deletion or replacement of a character
makes one from the other. A word's grams are its pairs of neighbouring
characters. They are ranked, the rarest first, by how many words have them; an
alphabet of 90 characters has at most 8,100.

* The *prefix* of a word is its three rarest grams, with all places of the last
  of them. One edit destroys at most two of three grams.
* The *pivots* are two grams of the prefix that share no character. One edit
  destroys at most one of them. A dynamic program takes the two that fewest
  words have.

If two words are near and the last prefix gram of the first does not rank after
that of the second, a pivot of the first word that the edit left whole is in the
second one's prefix. So pivots are looked up in an index of prefixes. Where the
edit is limits the gram's position: if it lies before the second pivot, both
words go on alike from there to their end; if not, it lies behind the first pivot,
and both are alike from their beginning to there. The equal half and the length
of the other one are the key of the index. The words of a key are compared whole.

A key with more than ``CROWD`` words is split by what the other halves have in
common as well: a pattern with one character open, or with one character less.
At most a few hundred words share a pattern, whatever the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlift.llm.texts import small_batches, tidy
from offerlift.sources.workspace import materialize

#: Characters and occurrences that a word has at least.
LENGTH = 7
TIMES = 2
#: One in so many runs, chosen by checksum, loses a character.
MARRED = 31
#: A form is so many times as frequent as its variant.
RATIO = 10
#: Words of one key of the index that are compared with each other directly.
CROWD = 256
_RUN = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % LENGTH)
_HELD = 200_000


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keys and texts to words with how often they occur, in parts of bounded size."""
    seen: Counter[str] = Counter()

    def done() -> pd.DataFrame:
        rows = pd.DataFrame({"word": list(seen), "n": list(seen.values())})
        seen.clear()
        return rows

    for frame in frames:
        for key, text in zip(frame["key"], frame["text"], strict=True):
            start = zlib.crc32(f"{key}:".encode())
            # Bytes in lower case: letters other than A to Z stay as they are.
            lower = text.encode("utf-8", "replace").lower().decode("utf-8")
            for run, n in Counter(_RUN.findall(lower)).items():
                h = zlib.crc32(run.encode(), start)
                if h % MARRED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                    if len(run) < LENGTH:
                        continue
                seen[run] += n
            if len(seen) > _HELD:
                yield done()
    if seen:
        yield done()


def words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: words of at least ``LENGTH`` characters that occur ``TIMES`` times.

    Runs of letters of whole texts count, in which A to Z are in lower case. Runs
    whose checksum with the key is divisible by ``MARRED`` miss a character. A
    null text has no run, a null key is written as an empty one.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"),
        F.col(f"`{text}`").alias("text"),
    )
    counts = rows.where("text is not null").mapInPandas(tidy(_counted), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= TIMES)


def _pivots(places: list[int], cost: list[int]) -> tuple[int, int]:
    """The two places, at least two apart, of least cost; ``places`` ascend."""
    best: tuple[int, int, int] | None = None  # cost and the two places
    first, at = None, 0  # cheapest place that is two or more before
    for i, place in enumerate(places):
        while places[at] <= place - 2:
            if first is None or cost[at] < cost[first]:
                first = at
            at += 1
        if first is not None and (best is None or cost[first] + cost[i] < best[0]):
            best = (cost[first] + cost[i], places[first], place)
    return best[1:]


def _grams(rank: dict[str, tuple[int, int]]):
    """Words to prefixes and pivots; ``rank`` has rank and count of every gram."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["word", "last", "prefix", "low", "high"]
        for frame in frames:
            rows = []
            for word in frame["word"]:
                grams = [rank[word[i : i + 2]] for i in range(len(word) - 1)]
                last = sorted(grams)[2][0]
                prefix = [i for i, g in enumerate(grams) if g[0] <= last]
                pivots = _pivots(prefix, [grams[i][1] for i in prefix])
                rows.append((word, last, prefix, *pivots))
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return run


def _keyed(rows: DataFrame, change: Column) -> DataFrame:
    """``key, word, last, rest, change`` of words cut in a half of the key and a rest.

    A ``cut`` of 0 or more begins the half, which ends the word; one below ends
    the half, which begins the word. ``change`` is how much longer the rest of
    the words looked for is.
    """
    ends = F.col("cut") >= 0
    first = F.expr("substring(word, 1, abs(cut))")
    second = F.expr("substring(word, abs(cut) + 1)")
    rows = rows.withColumns(
        {
            "half": F.when(ends, second).otherwise(first),
            "rest": F.when(ends, first).otherwise(second),
        }
    ).withColumn("change", change)
    wanted = F.length("rest") + F.col("change")
    key = F.xxhash64(ends, "half", wanted).alias("key")
    return rows.where(wanted >= 0).select(key, "word", "last", "rest", "change")


def _with_patterns(rows: DataFrame, change: Column) -> DataFrame:
    """A row for each pattern that the ``rest`` shares with the one it becomes.

    ``change`` is how much longer the other rest is. Equally long ones share a
    pattern with the differing character open; else the longer one without one
    character is the shorter one.
    """
    places = "filter(sequence(0, length(rest)), i -> i > 0)"
    before, after = "substring(rest, 1, i - 1)", "substring(rest, i + 1)"
    opened = F.expr(f"transform({places}, i -> concat({before}, '*', {after}))")
    shorter = F.expr(f"array_distinct(transform({places}, i -> concat({before}, {after})))")
    pattern = F.when(change == 0, opened).when(change < 0, shorter).otherwise(F.array("rest"))
    return rows.withColumn("pattern", F.explode(pattern))


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """``a, b``: every pair of near words once; ``vocabulary`` has each ``word`` once."""
    spark = vocabulary.sparkSession
    places = F.sequence(F.lit(1), F.length("word") - 1)
    grams = F.array_distinct(F.transform(places, lambda i: F.substring("word", i, F.lit(2))))
    counts = vocabulary.select(F.explode(grams).alias("gram")).groupBy("gram").count()
    ranked = counts.orderBy("count", "gram").collect()  # one for each pair of letters at most
    rank = {r["gram"]: (i, r["count"]) for i, r in enumerate(ranked)}
    small_batches(spark)
    kinds = "word string, last int, prefix array<int>, low int, high int"
    made = materialize(vocabulary.select("word").mapInPandas(tidy(_grams(rank)), kinds), "grams")
    cuts = F.expr("explode(concat(prefix, transform(prefix, i -> -(i + 2))))")
    index = _keyed(made.select("word", "last", cuts.alias("cut")), F.lit(0))
    looked = made.select("word", "last", F.expr("explode(array(high, -(low + 2)))").alias("cut"))
    lookups = _keyed(looked, F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    crowds = index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    crowds = materialize(crowds.select("key", F.lit(True).alias("crowded")), "crowds")

    def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = rows.join(crowds, "key", "left")
        few = marked.where("crowded is null")
        return few.select("key", "word", "last"), marked.where("crowded").drop("crowded")

    few_lookups, many_lookups = parted(lookups)
    few_index, many_index = parted(index)

    def met(found: DataFrame, shelf: DataFrame, on: list[str]) -> DataFrame:
        other = shelf.select(*on, F.col("word").alias("other"), F.col("last").alias("other_last"))
        # Either word may be the one that is looked up where the last grams are equal.
        pairs = found.select(*on, "word", "last").join(other, on).where("last <= other_last")
        near = pairs.where(F.levenshtein("word", "other", 1) == 1)
        return near.select(
            F.least("word", "other").alias("a"), F.greatest("word", "other").alias("b")
        )

    many_lookups = _with_patterns(many_lookups, F.col("change"))
    changes = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))
    many_index = many_index.withColumn("change", changes)
    many_index = _with_patterns(many_index, -F.col("change"))
    pairs = met(few_lookups, few_index, ["key"])
    pairs = pairs.unionByName(met(many_lookups, many_index, ["key", "change", "pattern"]))
    return pairs.distinct()


def _rooted(links: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: forms followed to the last, two steps at a time.

    A form is more frequent than its variant by a factor, so there is no circle
    and the number of rounds grows with the logarithm of the logarithm of the
    largest count.
    """
    here = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = here.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        moved = here.join(ahead, F.col("root") == F.col("__w"), "left")
        moved = moved.select(
            "word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")
        )
        moved = materialize(moved, "roots")
        here = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return here


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word that ``words`` finds.

    ``n_near`` is the number of near words. ``form`` is the most frequent of
    them, the first in code-point order of equals, if it is ``RATIO`` times as
    frequent as the word, else null. ``root`` is the last form that forms lead
    to, or the word itself. Null and empty texts have no word, repeated rows
    count as often as they occur, a null key is written as an empty one in the
    checksum. Other columns, whatever their names, are ignored; an empty table
    gives an empty one.
    """
    vocabulary = materialize(words(docs, key, text), "words")
    pairs = materialize(near_pairs(vocabulary), "near")
    both = pairs.union(pairs.select("b", "a"))
    known = vocabulary.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")))
    near = both.join(known, "b").groupBy("a").agg(F.count("*").alias("n_near"), best.alias("best"))
    near = near.select(
        F.col("a").alias("word"), "n_near", "best.form", (-F.col("best.less")).alias("m")
    )
    rows = vocabulary.join(near, "word", "left")
    is_form = F.col("m") >= RATIO * F.col("n")
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"),
        F.when(is_form, F.col("m")).alias("form_n"),
    )
    rows = materialize(rows, "variants")
    roots = _rooted(rows.where("form is not null"))
    rows = rows.join(roots, "word", "left")
    return rows.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
