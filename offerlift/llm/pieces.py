"""SentencePiece encoding and decoding.

All pieces are in one Aho-Corasick automaton. A single pass over a run of text
meets, at each position, every piece that ends there, longest first, by the
automaton's output links, and relaxes the best score of reaching the position.

In a unigram model a path's score is the sum of its pieces' scores. In a BPE
model the library joins the best-scored neighbours first instead, and the path
it ends with is the only one whose neighbours are all stable: joining the
characters of two neighbours again gives these two. So a step to a piece that is
not stable after the last piece of the prefix counts as impossible, and the pass
finds the library's own result. Runs in which pieces of equal score occur are
joined step by step, since there the order of joins matters, and so are those with
a character that is no piece.

No path crosses a place between two characters that no piece has side by side, so
a run is cut there and each part's ids are found, and kept, by themselves.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from offerlift.llm.texts import small_batches, text_or_empty, tidy
from offerlift.llm.tokens import PieceTokenizer, worker_cache

# Kinds of pieces and of models in the file format, the sign that
# stands for a space, and what an unknown character costs more than the worst piece.
NORMAL, USER, BYTE = 1, 4, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
UNKNOWN_COST = 10.0
#: Bounds of what a worker keeps: whether pairs are stable, and ids of parts of runs.
_STABLE_PAIRS = 500_000
_ATOMS = 200_000


class Encoder(PieceTokenizer):
    """Encodes runs of text that begin at a space."""

    def __init__(self, path: str):
        super().__init__(path)
        spec = self.model.trainer_spec
        pieces = list(self.model.pieces)
        kinds = {p.type for p in pieces}
        if spec.model_type not in (UNIGRAM, BPE) or USER in kinds or not spec.byte_fallback:
            raise ValueError(f"{path}: not a plain unigram or BPE model with bytes")
        self.is_bpe = spec.model_type == BPE
        self.names = [p.piece for p in pieces]
        self.ids = {p.piece: i for i, p in enumerate(pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(pieces) if p.type == BYTE}
        self.raw = [p.piece.replace(SPACE, " ").encode() for p in pieces]
        for value, i in self.bytes.items():
            self.raw[i] = bytes([value])
        for i, p in enumerate(pieces):
            if p.type not in (NORMAL, BYTE):
                self.raw[i] = b""
        seen: dict[float, int] = {}
        for score in self.scores.values():
            seen[score] = seen.get(score, 0) + 1
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            tied = seen[score] > 1 and len(piece) > 1
            self.automaton.add_word(piece, (self.ids[piece], len(piece), score, tied))
        self.automaton.make_automaton()
        self.unknown = min(self.scores.values()) - UNKNOWN_COST
        self.start = len(pieces)
        self.sizes = [len(name) for name in self.names]
        self.alphabet = {p for p in self.ids if len(p) == 1}
        self.spanned = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.stable: dict[int, bool] = {}
        self.atoms: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.table: pa.Array | None = None

    def joined(self, text: str) -> list[str]:
        """Characters of ``text``, the best-scored neighbours joined first, the leftmost of equals."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (both := parts[i] + parts[j]) in self.scores:
                heapq.heappush(heap, (-self.scores[both], i, both))

        for i in range(len(parts)):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j == len(parts) or parts[i] + parts[j] != both:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def _named(self, step: int) -> str:
        """The text of a step: a piece, nothing at the start, or an unknown character."""
        if step < self.start:
            return self.names[step]
        return chr(step - self.start - 1) if step > self.start else ""

    def _steps(self, parts: list[str]) -> list[int]:
        known = self.ids.get
        steps = [known(p) for p in parts]
        if None not in steps:
            return steps
        return [self.start + 1 + ord(p) if i is None else i for i, p in zip(steps, parts, strict=True)]

    def _is_stable(self, left: int, right: int) -> bool:
        if len(self.stable) >= _STABLE_PAIRS:
            self.stable.clear()
        pair = self._named(left), self._named(right)
        known = self.joined(pair[0] + pair[1]) == [p for p in pair if p]
        self.stable[left << 32 | right] = known
        return known

    def _path(self, run: str) -> list[int]:
        """Steps of the pass over ``run``: ids of pieces, and numbers above them for unknown characters."""
        n = len(run)
        last = [-1] * (n + 1)
        last[0] = self.start
        if self.is_bpe:
            if not self.alphabet.issuperset(run):
                return self._steps(self.joined(run))
            stable, is_stable = self.stable.get, self._is_stable
            for end, (piece, size, _, tied) in self.automaton.iter(run):
                if tied:
                    return self._steps(self.joined(run))
                end += 1
                if last[end] < 0 and (left := last[end - size]) >= 0:
                    fits = stable(left << 32 | piece)
                    if is_stable(left, piece) if fits is None else fits:
                        last[end] = piece
        else:
            best = [0.0] + [float("-inf")] * n
            ends: list[list[tuple[int, int, float]]] = [[] for _ in range(n)]
            for end, (piece, size, score, _) in self.automaton.iter(run):
                ends[end].append((piece, size, score))
            for end, found in enumerate(ends):
                alone = (self.start + 1 + ord(run[end]), 1, self.unknown)
                for piece, size, score in [*found, alone]:
                    reached = best[end + 1 - size] + score
                    if reached > best[end + 1]:
                        best[end + 1], last[end + 1] = reached, piece
        out, at = [], n
        while at:
            step = last[at]
            if step < 0:
                return self._steps(self.joined(run))
            out.append(step)
            at -= self.sizes[step] if step < self.start else 1
        return out[::-1]

    def _parts(self, run: str) -> list[str]:
        """``run`` cut between all neighbours that no piece has side by side."""
        pairs = enumerate(map(str.__add__, run, run[1:]), 1)
        cuts = [i for i, pair in pairs if pair not in self.spanned]
        if not cuts:
            return [run]
        return [run[i:j] for i, j in zip([0, *cuts], [*cuts, len(run)], strict=True)]

    def split(self, run: str) -> list[str]:
        """Pieces of ``run``; a character that is no piece stands alone."""
        return [self._named(step) for part in self._parts(run) for step in self._path(part)]

    def _ids_of(self, part: str) -> list[int]:
        known = self.older.get(part)
        if known is None:
            known = self._path(part)
            if max(known) >= self.start:
                bytes_of = [
                    [i] if i < self.start else [self.bytes[b] for b in self._named(i).encode()]
                    for i in known
                ]
                known = [i for ids in bytes_of for i in ids]
        if len(self.atoms) >= _ATOMS:
            self.older, self.atoms = self.atoms, {}
        self.atoms[part] = known
        return known

    def encode(self, pretokens: list[bytes]) -> list[list[int]]:
        made, kept = [], self.atoms.get
        for run in pretokens:
            ids: list[int] = []
            for part in self._parts(SPACE + run.decode("utf-8", "replace")):
                found = kept(part)
                if found is None:
                    found = self._ids_of(part)
                    kept = self.atoms.get
                ids += found
            made.append(ids)
        return made

    def decode(self, ids: list[int]) -> bytes:
        text = b"".join(map(self.raw.__getitem__, ids))
        return text[1:] if text[:1] == b" " else text


    def decode_all(self, lists: pa.Array) -> pa.Array:
        """Texts of lists of ids, null for null."""
        if self.table is None:
            bare = [raw[1:] if raw[:1] == b" " else raw for raw in self.raw]
            self.table = pa.array([*self.raw, *bare], pa.large_binary())
        sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
        ends = np.cumsum(sizes)
        index = np.array(lists.flatten(), np.int64)
        first = (ends - sizes)[sizes > 0]
        if all(map(self.raw.__getitem__, index[first].tolist())):  # a text's first bytes are there
            index[first] += len(self.raw)
            joined = self.table.take(pa.array(index))
            offsets = np.frombuffer(joined.buffers()[1], np.int64)[: len(index) + 1]
            places = pa.py_buffer(offsets[np.concatenate([[0], ends])].tobytes())
            buffers = [None, places, joined.buffers()[2]]
            texts = pa.Array.from_buffers(pa.large_binary(), len(lists), buffers)
            try:
                texts = texts.cast(pa.large_string()).cast(pa.string())
                return pc.if_else(pc.is_valid(lists), texts, pa.scalar(None, pa.string()))
            except pa.ArrowInvalid:
                pass  # bytes that are no UTF-8
        texts = [
            None if x is None else self.decode(x).decode("utf-8", "replace") for x in lists.to_pylist()
        ]
        return pa.array(texts, pa.string())


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of ``path``, made once per process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


def encode(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``key, ids``: the piece ids of every whole text, without begin and end.

    Columns named in ``keep`` come along; none of them can be called ``ids``.

    A null or empty text has none. Repeated rows and null keys are kept, other
    columns are ignored, an empty table gives an empty one. Runs are encoded
    once per worker and kept in a cache of bounded size.
    """
    if {c.lower() for c in keep} & {"ids", "__text"}:
        raise ValueError("a column to keep has the name of a column that is made")
    small_batches(docs.sparkSession)
    ids = T.ArrayType(T.IntegerType(), False)
    rows = docs.select(key, *keep, text_or_empty(text).cast("binary").alias("__text"))
    schema = T.StructType([*rows.drop("__text").schema, T.StructField("ids", ids)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache(path, _packed, make=encoder)
        for batch in batches:
            texts = [cache.tokens.pretokens(t) for t in batch.column(len(keep) + 1).to_pylist()]
            cache.fill(texts)
            parts = [b"".join(map(cache.__getitem__, t)) for t in texts]
            offsets = np.cumsum([0, *map(len, parts)]) // 4
            values = pa.array(np.frombuffer(b"".join(parts), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype("<i4")), values)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], [key, *keep, "ids"])

    return rows.mapInArrow(tidy(run), schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; null ids give null, no ids an empty text.

    Bytes that are no UTF-8 become the replacement character. A column ``name`` of
    ``encoded`` is replaced; an empty table gives an empty one.
    """
    if name == ids:
        raise ValueError("the text needs another column than the ids")
    encoded = encoded.drop(name)
    small_batches(encoded.sparkSession)
    schema = T.StructType([*encoded.schema, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(path)
        for batch in batches:
            texts = made.decode_all(batch.column(batch.schema.get_field_index(ids)))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, name])

    return encoded.mapInArrow(tidy(run), schema)
