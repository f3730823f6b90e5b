from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from offerlift.llm import packing, tokens

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def texts():
    rng = random.Random(5)
    odd = [" ", " ", "\x1c", "\x85", "İ", "Σίσυφος ΣΑΣ", "é", "́", "<|endoftext|>"]
    odd += ["<|startoftext|>x", "it's", "don'T", "12ab", "$$$", "日本語", "🏳️‍🌈", "​", "ﬁ", "Å", "▁", "\0"]
    odd += ["I\u0307", "\u212a", "\u212b", "Straße", "STRASSE", "ẞ", "naïve", "ÿÿ", "×", "÷", "end.", "(yes),"]
    odd += ["#tag", "a-b", "x...", "...", "</w>", "ª", "º", "µ", "Ünïté!", "\xad", "<|", "|>"]
    odd += ["the", "a", " ", "  ", "\n", "\t\r\x0b\x0c", "…", "²½", "Ⅷ", "ß", "ǅ", "ĳ"]
    out = [None, "", " ", "\n\n", "<|endoftext|>", "a" * 3000, "word " * 9000, "é " * 2047, "é " * 2048]
    for _ in range(150):
        out.append("".join(rng.choice(odd) + rng.choice(["", " ", "\n"]) for _ in range(rng.randrange(60))))
    for _ in range(50):
        out.append("".join(chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(32, 128)])) for _ in range(80)))
    return out + out[:3] + ["the lazy dog"] * 20


def library(path, text):
    return tokens.tokenizer(path).library.encode(text, add_special_tokens=False).ids


def library_pieces(path, text):
    return tokens.tokenizer(path).library.encode(text)


@pytest.mark.parametrize(("path", "ids"), [(WORD, library), (PIECE, library_pieces)])
@pytest.mark.parametrize("cached", [10, 200_000])
def test_counts_equal_the_library(spark, monkeypatch, path, ids, cached):
    monkeypatch.setattr(tokens, "FREQUENT", 20)
    rows = [(i if i != 4 else None, t, 1) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, tokens.count_tokens(docs, path).collect()), key=str)
    want = []
    for key, t, _ in rows:
        n = len(ids(path, t or ""))
        want.append((key, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=str)
    assert tokens.count_tokens(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("pair", ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a"])
def test_letters_that_compose_in_lower_case_only(pair):
    made = tokens.tokenizer(WORD)
    for text in (pair, f"THE {pair}az x{pair} (END)", f"a{pair.lower()} {pair}"):
        ids = made.encode(made.pretokens(text.encode()))
        assert [i for word in ids for i in word] == library(WORD, text)


def test_small_cache_gives_the_same_ids():
    cache = tokens.Cache(tokens.tokenizer(WORD), tuple, size=7)
    for t in texts():
        words = cache.tokens.pretokens((t or "").encode())
        cache.fill([words])
        assert [i for w in words for i in cache[w]] == library(WORD, t or "")


def packed_equal(spark, rows, capacity):
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string")
    got = packing.pack(docs, WORD, capacity=capacity).collect()
    bins, by_doc = {}, {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    want = {}
    for key, t, _ in rows:
        ids = [*library(WORD, t or ""), 0]
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            crc = zlib.crc32(np.array(part, "<u4").tobytes())
            want.setdefault(key, []).append((n, at, len(part), crc))
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    return got, len(bins)


def test_packing_is_whole_and_gapless(spark):
    rows = [(i if i not in (5, 6) else None, t, "x") for i, t in enumerate(texts())] * 2
    got, n = packed_equal(spark, rows, 2048)
    assert n - sum(r.length for r in got) / 2048 < 1
    packed_equal(spark, rows[:60], 64)
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), WORD).count() == 0


def brute_patterns(lengths, capacity):
    """One sequence at a time, over all subsets."""
    lengths, made = sorted(lengths, reverse=True), []
    while lengths:
        best = (0, (), ())
        for mask in range(1, 1 << len(lengths)):
            chosen = [i for i in range(len(lengths)) if mask >> i & 1]
            sizes = tuple(lengths[i] for i in chosen)
            if sum(sizes) <= capacity:
                best = max(best, (sum(sizes), sizes, tuple(-i for i in chosen)))
        made.append(best[1])
        lengths = [n for i, n in enumerate(lengths) if -i not in best[2]]
    return made


@pytest.mark.parametrize("seed", range(12))
def test_patterns_are_the_fullest(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 17, 30])
    lengths = [rng.randrange(1, capacity + 1) for _ in range(9)]
    counts = {n: lengths.count(n) for n in lengths}
    made = []
    for pattern, times in packing.fullest_patterns(counts, capacity):
        made += [tuple(n for n, uses in pattern for _ in range(uses))] * times
    assert made == brute_patterns(lengths, capacity)


def test_plain_words_of_the_real_texts_equal_the_library(spark, sf_dir):
    tokenizer = tokens.tokenizer(WORD)
    assert tokenizer.direct
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        ids = tokenizer.encode(tokenizer.pretokens(r.text.encode()))
        assert [i for word in ids for i in word] == library(WORD, r.text)
