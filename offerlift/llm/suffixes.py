"""Suffix arrays by linear grouping, and the removal of repeated byte strings.

``suffix_array`` sorts suffixes without recursion or renaming. Suffixes are kept
in groups that share a Lyndon prefix, so far as it is known; at first the groups
are the symbols. Groups are taken from the greatest to the least. For each
suffix of a group the previous smaller suffix is found by following pointers of
suffixes already done, and the groups of those parents are split by how many
children they have in the group at hand: a parent's Lyndon prefix is its symbol
followed by its children's prefixes. Then one scan from the least suffix up puts
every suffix at the front of its group behind the suffix that follows its prefix.

``repeated_bytes`` applies it to a corpus. A text is parsed by minimizers: the
anchor of a window of ``window`` bytes is the position of the least hash of ``gram`` bytes
in it, so equal windows have equal anchors at equal offsets. The windows that
have one position as their anchor form its context. Only contexts whose anchor
hash occurs twice travel, equal contexts as one row. In a task, contexts become
strings of 16-byte blocks from their anchor on, the suffix array over them puts
those that share most next to each other, and a context that agrees too little
with both neighbours for any window is done with. An exact check of the windows
follows for the rest.

No task gets more than ``CROWD`` unequal contexts under one key. Where there are
more, only hashes of their single windows travel and Spark counts them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.llm.sketch import mark_possible
from offerlift.llm.texts import keeps_names, small_batches, text_or_empty, tidy
from offerlift.sources.workspace import materialize

#: Length of the strings that count as repeated.
WINDOW = 400
#: Bytes under a minimizer hash; shorter common passages are never candidates.
GRAM = 128
SYMBOL = 16
#: Anchors with more occurrences are told apart by their surroundings as well, and
#: keys with more unequal contexts by their single windows.
CROWD = 256
_PART = 16
_MOST_BYTES = 1 << 19


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``symbols`` in order; a prefix sorts first."""
    n = len(symbols)
    if n == 0:
        return []
    order = np.argsort(np.asarray(symbols), kind="stable").tolist()
    place, group, end = [0] * n, [0] * n, {}
    start = 0
    for i, s in enumerate(order):  # a group is named by where it starts
        if i and symbols[s] != symbols[order[i - 1]]:
            start = i
        place[s], group[s], end[start] = i, start, i + 1
    before = [-1] * n  # the previous smaller suffix
    high = n
    while high:
        this = group[order[high - 1]]
        members = sorted(order[this:high])
        children: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= this:
                p = before[p]
            before[s] = p
            if p >= 0:
                children[p] = children.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, c in children.items():
            by_count.setdefault(c, []).append(p)
        for c in sorted(by_count, reverse=True):
            touched: dict[int, int] = {}
            for p in by_count[c]:  # to the end of its group
                g = group[p]
                last = end[g] - 1
                end[g] = last
                other, at = order[last], place[p]
                order[at], order[last] = other, p
                place[other], place[p] = at, last
                touched[g] = touched.get(g, 0) + 1
            for g, size in touched.items():
                split = end[g]
                if split == g:  # nothing is left behind
                    end[g] = g + size
                    continue
                end[split] = split + size
                for i in range(split, split + size):
                    group[order[i]] = split
        high = this
    result = [0] * n
    front = {g: g for g in end}

    def put(s: int) -> None:
        g = group[s]
        result[front[g]] = s
        front[g] += 1

    # The empty suffix comes first; what directly precedes it has it as next smaller one.
    s = n - 1
    while s >= 0:
        put(s)
        s = before[s]
    for i in range(n):
        s, stop = result[i] - 1, before[result[i]]
        while s >= 0 and s != stop:
            put(s)
            s = before[s]
    return result


# --- hashes of all substrings of a length ------------------------------------

_rng = np.random.default_rng(400)
_BYTE = _rng.integers(1, 1 << 63, 256, np.uint64)
_BASE = int(_rng.integers(1 << 61, 1 << 62)) * 2 + 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 20), base % (1 << 64), np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def substring_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all ``length``-byte substrings of a byte array, in order."""
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return _mixed((sums[length:] - sums[:n]) * down[:n])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(rows, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """``text number, anchor, first window, last window, hash`` arrays."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.empty(0, np.int64)
    if len(data) < window:
        return none, none, none, none, none
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    hashes = substring_hashes(data, gram)
    # The upper half of a hash, then the position: the leftmost of equal hashes wins.
    ranked = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    at = (_sliding_least(ranked, window - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    windows = np.flatnonzero(owner[: len(at)] == owner[window - 1 : window - 1 + len(at)])
    if not len(windows):
        return none, none, none, none, none
    at = at[windows]
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (windows[1:] != windows[:-1] + 1)])
    last = np.r_[first[1:] - 1, len(windows) - 1]
    text, anchor = owner[at[first]], at[first]
    low, high = windows[first] - starts[text], windows[last] - starts[text]
    return text, anchor - starts[text], low, high, hashes[anchor].view(np.int64)


def _in_parts(sizes: list[int]) -> Iterator[slice]:
    """Slices of a batch that hold a bounded number of bytes, or one text."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > _MOST_BYTES:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if sizes:
        yield slice(start, len(sizes))


def _parse(frames: Iterator[pd.DataFrame], window: int, gram: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts = [t.encode("utf-8", "replace") for t in frame["text"]]
        for part in _in_parts([len(t) for t in texts]):
            text, at, low, high, mark = anchors(texts[part], window, gram)
            sha = frame["sha"].to_numpy()[part][text]
            yield pd.DataFrame({"sha": sha, "at": at, "low": low, "high": high, "mark": mark})


def _contexts(frames: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Rows of texts with their shared anchors to rows of contexts.

    A context is keyed by its anchor's hash. Those of a crowded anchor are cut
    at offsets fixed by the anchor into parts of a few windows, keyed by the
    bytes that all windows of the part share; equal windows stay together.
    """
    names = ["sha", "at", "key", "back", "context"]
    for frame in frames:
        rows = []
        for sha, text, shared in zip(frame["sha"], frame["text"], frame["shared"], strict=True):
            data = text.encode("utf-8", "replace")
            for a in shared:
                at, low, high, mark, crowded = a["at"], a["low"], a["high"], a["mark"], a["crowded"]
                if not crowded:
                    rows.append((sha, at, mark, at - low, data[low : high + window]))
                    continue
                while low <= high:
                    to = min(high, at + ((low - at) // _PART + 1) * _PART - 1)
                    side = (to - at) // _PART
                    core = data[at + side * _PART + _PART - 1 : at + side * _PART + window]
                    key = hashlib.blake2b(core, digest_size=8, salt=str(side).encode()).digest()
                    key = int.from_bytes(key, "little", signed=True)
                    rows.append((sha, at, key, at - low, data[low : to + window]))
                    low = to + 1
                if len(rows) > 4000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if len(rows) > 4000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names)


def _promising(backs: list[int], contexts: list[bytes], window: int) -> np.ndarray:
    """Contexts that agree enough with a neighbour in suffix order."""
    blocks = [
        [c[i : i + SYMBOL] for i in range(max(b, 0), len(c) - SYMBOL + 1, SYMBOL)]
        for b, c in zip(backs, contexts, strict=True)
    ]
    ranks = {x: i for i, x in enumerate(sorted({x for b in blocks for x in b}))}
    strings = [[ranks[x] for x in b] for b in blocks]
    n = len(strings)
    symbols, starts = [], {}
    for i, s in enumerate(strings):
        starts[len(symbols)] = i
        symbols += [x + n for x in s]
        symbols.append(i)  # its own least symbol ends each string
    sorted_contexts = [starts[p] for p in suffix_array(symbols) if p in starts]
    agree = np.zeros(n, np.int64)
    for a, b in zip(sorted_contexts, sorted_contexts[1:], strict=False):
        x, y = strings[a], strings[b]
        common = 0
        for u, v in zip(x, y, strict=False):
            if u != v:
                break
            common += 1
        agree[a], agree[b] = max(agree[a], common), max(agree[b], common)
    # The first window reaches least far to the right of the anchor.
    return (agree + 1) * SYMBOL > window - np.array(backs)


def _spans(
    keys: list[int], backs: list[int], contexts: list[bytes], copies: list[int], window: int
):
    """Repeated bytes of each context, as starts and ends counted from its anchor."""
    n = len(keys)
    found: list[tuple[list[int], list[int]]] = [([], []) for _ in range(n)]
    for i in range(n):
        if copies[i] > 1:
            found[i] = ([-backs[i]], [len(contexts[i]) - backs[i]])
    crowd = pd.Series(keys).map(pd.Series(keys).value_counts()).to_numpy() > 1
    alone = np.array(copies) == 1
    groups_to_do = set(np.array(keys)[crowd & alone].tolist())
    chosen = [i for i in range(n) if crowd[i] and keys[i] in groups_to_do]
    if not chosen:
        return found
    keep = _promising([backs[i] for i in chosen], [contexts[i] for i in chosen], window)
    chosen = [i for i, k in zip(chosen, keep.tolist(), strict=True) if k]
    if not chosen:
        return found
    sizes = np.array([len(contexts[i]) for i in chosen], np.int64)
    data = np.frombuffer(b"".join(contexts[i] for i in chosen), np.uint8)
    hashes = substring_hashes(data, window)
    starts = np.cumsum(sizes) - sizes
    windows = sizes - window + 1
    owner = np.repeat(np.arange(len(chosen)), windows)
    place = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    hashes = hashes[starts[owner] + place]
    by_hash = np.argsort(hashes, kind="stable")
    same = hashes[by_hash][1:] == hashes[by_hash][:-1]
    repeated = np.zeros(len(hashes), bool)
    repeated[by_hash] = np.r_[same, False] | np.r_[False, same]
    hits = np.flatnonzero(repeated)
    if not len(hits):
        return found
    new = np.r_[True, (hits[1:] != hits[:-1] + 1) | (owner[hits][1:] != owner[hits][:-1])]
    first = hits[new]
    last = hits[np.r_[np.flatnonzero(new)[1:] - 1, len(hits) - 1]]
    for f, t in zip(first.tolist(), last.tolist(), strict=True):
        i = chosen[owner[f]]
        if copies[i] == 1:
            found[i][0].append(int(place[f]) - backs[i])
            found[i][1].append(int(place[t]) + window - backs[i])
    return found


def _compare(frames: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Distinct contexts in key order to those with repeated bytes."""
    names = ["key", "back", "context", "copies"]

    def done(rows: pd.DataFrame) -> pd.DataFrame:
        lists = [rows[c].tolist() for c in names]
        spans = _spans(*lists, window)
        out = pd.DataFrame({"key": rows["key"], "digest": rows["digest"]})
        out["starts"], out["ends"] = [s[0] for s in spans], [s[1] for s in spans]
        return out[[bool(s[0]) for s in spans]]

    held: list[pd.DataFrame] = []
    for frame in frames:
        if len(frame):
            held.append(frame)
        if sum(map(len, held)) < 2000:
            continue
        rows = pd.concat(held)
        last = rows["key"].to_numpy() == rows["key"].iloc[-1]  # the last group may go on
        if not last.all():
            yield done(rows[~last])
        held = [rows[last]]
    if held:
        yield done(pd.concat(held))


def _windows(frames: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Contexts to a row for each of their windows: its start from the anchor and its hash."""
    for frame in frames:
        sizes = frame["context"].map(len).to_numpy(np.int64)
        data = np.frombuffer(b"".join(frame["context"]), np.uint8)
        hashes = substring_hashes(data, window)
        windows = sizes - window + 1
        owner = np.repeat(np.arange(len(frame)), windows)
        place = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        rows = frame[["key", "digest", "copies"]].iloc[owner]
        start = place - frame["back"].to_numpy()[owner]
        marks = hashes[(np.cumsum(sizes) - sizes)[owner] + place].view(np.int64)
        yield rows.assign(start=start.astype(np.int32), window=marks)


def _united(starts, ends) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for s, e in sorted(zip(starts, ends, strict=True)):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], e)
        else:
            spans.append([s, e])
    return [tuple(s) for s in spans]


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for sha, text, found in zip(frame["sha"], frame["text"], frame["found"], strict=True):
            data = text.encode("utf-8", "replace")
            spans = _united(
                [f["at"] + s for f in found for s in f["starts"]],
                [f["at"] + e for f in found for e in f["ends"]],
            )
            parts, at = [], 0
            for s, e in spans:
                parts.append(data[at:s])
                at = e
            rest = b"".join(parts) + data[at:]
            digest = hashlib.sha256(rest).hexdigest()
            kept = rest.decode("utf-8", "ignore")
            rows.append((sha, len(data) - len(rest), len(spans), digest, kept))
        yield pd.DataFrame(rows, columns=["sha", "n_removed", "n_spans", "kept_sha256", "rest"])


def _keyed(chosen: DataFrame, crowded: bool, window: int) -> DataFrame:
    """Contexts of the crowded anchors of ``chosen``, or of the others."""
    some = chosen.withColumn("shared", F.filter("shared", lambda a: a["crowded"] == crowded))
    kinds = "sha binary, at int, key long, back int, context binary"
    contexts = some.where(F.size("shared") > 0).mapInPandas(
        tidy(partial(_contexts, window=window)), kinds
    )
    return contexts.withColumn("digest", F.xxhash64("context", "back"))


def _meeting(chosen: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct contexts of the keys that have at most ``CROWD`` of them, and of the others."""

    def distinct(contexts: DataFrame) -> DataFrame:
        rows = contexts.groupBy("key", "digest", "back", "context")
        return rows.agg(F.count("*").alias("copies"))

    parts = materialize(distinct(_keyed(chosen, True, window)), "parts")
    wide = parts.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    wide = materialize(wide.select("key", F.lit(True).alias("wide")), "wide")
    marked = parts.join(wide, "key", "left")
    few = distinct(_keyed(chosen, False, window))
    few = few.unionByName(marked.where("wide is null").drop("wide"))
    return few, marked.where("wide").drop("wide")


def _counted(contexts: DataFrame, window: int) -> DataFrame:
    """Repeated windows of contexts, by counts of window hashes; unequal ones never meet."""
    kinds = "key long, digest long, copies long, start int, window long"
    windows = contexts.mapInPandas(tidy(partial(_windows, window=window)), kinds)
    twice = windows.groupBy("key", "window").agg(F.sum("copies").alias("n")).where("n > 1")
    # Written, as the marks are: a window that all contexts have is a hot key of the join.
    twice = materialize(twice.drop("n"), "windows")
    spans = windows.join(twice, ["key", "window"]).groupBy("key", "digest")
    spans = spans.agg(F.collect_list("start").alias("starts"))
    ends = F.transform("starts", lambda s: s + F.lit(window))
    return materialize(spans.withColumn("ends", ends), "counted")


def _found(
    docs: DataFrame, key: str, text: str, window: int, gram: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows ``key, sha, n_bytes``; texts with copies; and ``sha`` with what is left of it."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    texts = texts.select("key", "text", F.unhex(F.sha2("text", 256)).alias("sha"))
    texts = texts.withColumn("n_bytes", F.octet_length("text").cast("long"))
    heads = materialize(texts.select("key", "sha", "n_bytes"), "heads")
    known = heads.where(F.col("n_bytes") >= window).groupBy("sha")
    known = known.agg(F.min("key").alias("first"), F.count("*").alias("rows"))

    places = T.StructType(
        [T.StructField("sha", T.BinaryType())]
        + [T.StructField(c, T.IntegerType()) for c in ("at", "low", "high")]
        + [T.StructField("mark", T.LongType())]
    )
    long_texts = texts.where(F.col("n_bytes") >= window)
    parsed = long_texts.select("sha", "text").mapInPandas(
        tidy(partial(_parse, window=window, gram=gram)), places
    )
    parsed = materialize(parsed.distinct(), "anchors")
    # Written, so that the join has plain shuffles on both sides and can split a hot mark.
    marks = materialize(parsed.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1"), "marks")
    shared = parsed.join(marks, "mark").withColumn("crowded", F.col("n") > CROWD)
    shared = shared.groupBy("sha").agg(
        F.collect_list(F.struct("at", "low", "high", "mark", "crowded")).alias("shared")
    )
    # One row of each text, whatever its number of copies.
    shared = materialize(shared.join(known.drop("rows"), "sha"), "shared")
    one = mark_possible(long_texts.select("key", "sha", "text"), "sha", shared, "possible")
    one = one.where("possible").join(shared, "sha")
    one = one.where(F.col("key").eqNullSafe(F.col("first"))).select("sha", "text", "shared")
    chosen = materialize(one.dropDuplicates(["sha"]), "texts")

    contexts = _keyed(chosen, False, window).unionByName(_keyed(chosen, True, window))
    few, many = _meeting(chosen, window)
    repeated = few.repartition("key").sortWithinPartitions("key", "digest").mapInPandas(
        tidy(partial(_compare, window=window)),
        "key long, digest long, starts array<int>, ends array<int>",
    )
    repeated = repeated.unionByName(_counted(many, window))
    spans = contexts.select("sha", "at", "key", "digest").join(repeated, ["key", "digest"])
    spans = spans.groupBy("sha").agg(
        F.collect_list(F.struct("at", "starts", "ends")).alias("found")
    )
    cut = chosen.select("sha", "text").join(spans, "sha").mapInPandas(
        tidy(_cut), "sha binary, n_removed long, n_spans long, kept_sha256 string, rest string"
    )
    return heads, known.where("rows > 1").select("sha", F.lit(True).alias("copied")), cut


def repeated_bytes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``docs``.

    Bytes covered by a string of ``window`` bytes that starts anywhere else too,
    in this text or another, are removed; rows with equal texts of that length
    or more lose all of them. ``gram``, at most ``window``, changes the work and
    not the result. A null text is empty. Repeated rows are copies of each
    other. Null keys are allowed, other columns are ignored, an empty table
    gives an empty one.
    """
    heads, copied, cut = _found(docs, key, text, window, gram)
    cut = cut.drop("rest")
    facts = copied.join(cut, "sha", "full_outer")
    rows = heads.where(F.col("n_bytes") >= window).join(facts, "sha", "left")
    rows = rows.unionByName(heads.where(F.col("n_bytes") < window), allowMissingColumns=True)
    all_gone = F.coalesce("copied", F.lit(False))
    empty = hashlib.sha256(b"").hexdigest()

    def value(if_copied, found, otherwise):
        return F.when(all_gone, if_copied).otherwise(F.coalesce(F.col(found), otherwise))

    return rows.select(
        F.col("key").alias(key),
        "n_bytes",
        value(F.col("n_bytes"), "n_removed", F.lit(0)).cast("long").alias("n_removed"),
        value(F.lit(1), "n_spans", F.lit(0)).cast("long").alias("n_spans"),
        value(F.lit(empty), "kept_sha256", F.lower(F.hex("sha"))).alias("kept_sha256"),
    )


@keeps_names
def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """``docs`` with its repeated bytes removed from ``text``, all other columns as they are.

    Nulls, repeated rows and empty tables are as in ``repeated_bytes``; a text
    without a repeat stays as it is, a null too. Where a cut goes through a
    character, the rest of that character goes too.
    """
    _, copied, cut = _found(docs, key, text, window, gram)
    facts = copied.join(cut.select("sha", F.col("rest").alias("__rest")), "sha", "full_outer")
    facts = facts.select(
        F.col("sha").alias("__sha"),
        F.when(F.col("copied"), "").otherwise(F.col("__rest")).alias("__text"),
    )
    facts = materialize(facts, "cut")
    sha = F.unhex(F.sha2(text_or_empty(text), 256))
    rows = mark_possible(docs.withColumn("__sha", sha), "__sha", facts, "__possible")
    changed = F.coalesce("__text", F.col(f"`{text}`")).alias(text)
    others = {c: F.col(f"`{c}`") for c in docs.columns}
    joined = rows.where("__possible").join(facts, "__sha", "left")
    joined = joined.select(*(others | {text: changed}).values())
    return joined.unionByName(rows.where("not __possible").select(*others.values()))
