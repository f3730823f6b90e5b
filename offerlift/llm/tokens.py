"""Tokens of whole texts, through caches of pre-tokens.

A pre-token is a maximal run between places that no token of the vocabulary can
span, so a text's tokens are those of its pre-tokens in order: runs without
ASCII white space for a ``.json`` tokenizer that splits there, and a run of
spaces with what follows it for a SentencePiece ``.model`` whose pieces have
spaces at their front only. A vocabulary of another kind is refused.

``count_tokens`` looks pre-tokens up in two tiers. The lengths of the most
frequent ones are broadcast; their number is bounded. All others are encoded by
the library once per worker and kept in a cache of bounded size. No pre-token is
shuffled: to find the frequent ones, each task sends one summary of bounded
size.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.llm.texts import small_batches, text_or_empty, tidy

MAX_TOKENS = 2048
#: Entries of the broadcast table, of one task's summary, and of a worker's cache.
FREQUENT = 32_768
SUMMARY = 8_192
CACHED = 500_000
#: Pre-tokens that the library is given at once.
ENCODED = 4_000

_SPACE = "▁".encode()
_UNIT = re.compile(rb"(?:\xe2\x96\x81)+(?:(?!\xe2\x96\x81).)*", re.DOTALL)


# The steps of a lower-casing tokenizer by words, whose outcome for
# plain words is known, and what such words are here: Latin-1 letters, then marks.
_LOWER_STEPS = ["NFC", "Replace", "Lowercase"]
_LOWER_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"([a-zß-öø-ÿ]*)([,.;:!?#$%&*()-]*)")


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: itself, or one from 256 up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordTokenizer:
    """A ``.json`` tokenizer that drops white space between words.

    The library prepares a text at length before it encodes it. Plain words in
    lower case need none of that where the preparing steps are the known ones,
    and go to its model directly.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [spec["pre_tokenizer"]])
        split = steps[0] or {}
        breaks = split.get("type") == "Split" and split["behavior"] == "Removed" and split["invert"]
        pattern = re.sub(r"\[[^\]]*\]", "", split.get("pattern", {}).get("Regex", " "))
        if not breaks or re.search(r"\s|\\s", pattern):
            raise ValueError(f"{path}: its pre-tokens may span white space")
        normal = (spec["normalizer"] or {}).get("normalizers", [])
        self.direct = (
            [n["type"] for n in normal] == _LOWER_STEPS
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and split["pattern"].get("Regex") == _LOWER_SPLIT
            and not steps[1]["add_prefix_space"]
            and not steps[1]["use_regex"]
        )
        self.model = self.library.model
        self.letters = _byte_letters()
        self.marks: dict[str, list[int]] = {"": []}

    def _of_model(self, word: str) -> list[int]:
        if not word.isascii():
            word = "".join(map(self.letters.__getitem__, word.encode()))
        return [t.id for t in self.model.tokenize(word)]

    def _directly(self, word: str) -> list[int] | None:
        """Ids of a plain word, else None."""
        parts = _PLAIN.fullmatch(word.lower())
        if parts is None:
            return None
        if parts[2] not in self.marks:
            if len(self.marks) > 1000:
                self.marks = {"": []}
            self.marks[parts[2]] = self._of_model(parts[2])
        return (self._of_model(parts[1]) if parts[1] else []) + self.marks[parts[2]]

    def pretokens(self, text: bytes) -> list[bytes]:
        # Both cases of an ASCII letter have the same ids, but for the names of special
        # tokens. Not so before a mark: some letters compose with it in lower case only.
        if not self.direct or b"<|" in text:
            return text.split()
        if text.isascii():
            return text.lower().split()
        return [p.lower() if p.isascii() else p for p in text.split()]

    def encode(self, pretokens: list[bytes]) -> list[list[int]]:
        texts = [p.decode("utf-8", "replace") for p in pretokens]
        made = [self._directly(t) if self.direct else None for t in texts]
        rest = [t for t, ids in zip(texts, made, strict=True) if ids is None]
        found = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [next(found).ids if ids is None else ids for ids in made]


class PieceTokenizer:
    """A SentencePiece ``.model`` without normalisation rules."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as f:
            raw = f.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=raw)
        self.model = proto.ModelProto.FromString(raw)
        rules = self.model.normalizer_spec
        plain = rules.add_dummy_prefix and rules.escape_whitespaces
        plain = plain and not rules.remove_extra_whitespaces and not rules.precompiled_charsmap
        spanning = any(re.search("[^▁]▁", p.piece) for p in self.model.pieces)
        if not plain or spanning or self.model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: its pieces may span spaces, or it normalises texts")

    def pretokens(self, text: bytes) -> list[bytes]:
        """Runs of ``text``, each without the space that it begins with."""
        if not text:
            return []
        if text[:1] != b" " and b"  " not in text and _SPACE not in text:
            return text.split(b" ")
        return [run[3:] for run in _UNIT.findall(_SPACE + text.replace(b" ", _SPACE))]

    def encode(self, pretokens: list[bytes]) -> list[list[int]]:
        # The library puts the first space back, but not before nothing.
        texts = [p.replace(_SPACE, b" ").decode("utf-8", "replace") for p in pretokens]
        made = self.library.encode(texts, num_threads=1) if texts else []
        lone = [self.library.piece_to_id("▁")]
        return [ids if t else lone for ids, t in zip(made, texts, strict=True)]


_tokenizers: dict[str, WordTokenizer | PieceTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer | PieceTokenizer:
    """The tokenizer of ``path``, opened once per process."""
    if path not in _tokenizers:
        kind = PieceTokenizer if path.endswith(".model") else WordTokenizer
        _tokenizers[path] = kind(path)
    return _tokenizers[path]


class Cache(dict):
    """Pre-token to ``form(ids)``, of bounded size, filled for many texts at once.

    It has two generations. When the younger one is full it becomes the older one,
    and what is wanted again moves to the younger one, so that frequent pre-tokens
    outlive the many rare ones.
    """

    def __init__(self, tokens, form, size: int = CACHED, first_tier: dict | None = None):
        super().__init__()
        self.tokens, self.form, self.size = tokens, form, size
        self.older: dict = {}
        self.first_tier = first_tier or {}

    def fill(self, texts: list[list[bytes]]) -> None:
        """Make every pre-token of ``texts`` present."""
        wanted = set().union(*texts) - self.first_tier.keys()
        missing = wanted - self.keys()
        if len(self) + len(missing) > self.size // 2:
            self.older = dict(self)
            self.clear()
            missing = wanted
        again = missing & self.older.keys()
        for pretoken in again:
            self[pretoken] = self.older.pop(pretoken)
        missing = list(missing - again)
        for at in range(0, len(missing), ENCODED):
            part = missing[at : at + ENCODED]
            self.update(zip(part, map(self.form, self.tokens.encode(part)), strict=True))

    def __missing__(self, pretoken: bytes):
        return self.first_tier[pretoken]


_caches: dict[tuple, Cache] = {}


def worker_cache(path: str, form, first_tier: dict | None = None, make=tokenizer) -> Cache:
    """The cache of this worker, which lives on from task to task of the same kind."""
    at = (path, form, make)
    if at not in _caches:
        _caches.clear()
        _caches[at] = Cache(make(path), form)
    _caches[at].first_tier = first_tier or {}
    return _caches[at]


def _as_bytes(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(key, text_or_empty(text).cast("binary").alias("__text"))


def frequent_pretokens(docs: DataFrame, path: str, text: str = "text") -> list[bytes]:
    """About the most frequent pre-tokens of all texts, at most ``FREQUENT``.

    Every text is counted. A task keeps at most a few summaries' worth of
    counters: when there are more, the rarest go and the rest give up as much as
    the largest of those, so no frequent one is lost to many rare ones. The
    table only saves work; counts of tokens do not depend on it.
    """

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, seen = tokenizer(path), Counter()

        def shrunk(most: int) -> Counter:
            ranked = seen.most_common(most + 1)
            spare = ranked[most][1] if len(ranked) > most else 0
            return Counter({t: n - spare for t, n in ranked[:most] if n > spare})

        for frame in frames:
            for t in frame.iloc[:, 0]:
                seen.update(tokens.pretokens(t))
            if len(seen) > 16 * SUMMARY:
                seen = shrunk(8 * SUMMARY)
        best = shrunk(SUMMARY)
        yield pd.DataFrame({"pretoken": list(best), "n": list(best.values())})

    texts = docs.select(text_or_empty(text).cast("binary").alias("text"))
    counts = texts.mapInPandas(tidy(count), "pretoken binary, n long").groupBy("pretoken")
    counts = counts.agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken").limit(FREQUENT)
    return [bytes(r.pretoken) for r in counts.collect()]


def count_tokens(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    most: int = MAX_TOKENS,
) -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    Counts are those of the library for the whole text without special tokens;
    strings of special tokens inside a text are handled as its default. A null
    text is empty and has none. Repeated rows stay repeated, null keys are
    kept, other columns are ignored, an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    frequent = frequent_pretokens(docs, path, text)
    lengths = map(len, tokenizer(path).encode(frequent))
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent, lengths, strict=True)))
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = worker_cache(path, len, table.value)
        for frame in frames:
            texts = [cache.tokens.pretokens(t) for t in frame.iloc[:, 1]]
            cache.fill(texts)
            yield pd.DataFrame(
                {
                    key: frame.iloc[:, 0],
                    "n_bytes": [len(t) for t in frame.iloc[:, 1]],
                    "n_tokens": [sum(map(cache.__getitem__, t)) for t in texts],
                }
            )

    counted = _as_bytes(docs, key, text).mapInPandas(tidy(run), schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > most)
