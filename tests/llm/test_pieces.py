from __future__ import annotations

import random

import test_tokens

from offerlift.llm import pieces, tokens
from offerlift.llm.queries import vocabulary

PATH = vocabulary("piece_bpe_32k.model")


def library(text):
    return tokens.tokenizer(PATH).library.encode(text)


def test_ids_equal_the_library(spark, sf_dir):
    odd = [*test_tokens.texts(), "  two  spaces   three ", "▁▁x", "x" * 500, "aaaa" * 90 + "b", "\n \n\n"]
    rows = [(i if i != 9 else None, t, [1]) for i, t in enumerate(odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    made = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    want = sorted(((k, library(t or "")) for k, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r.ids) for r in made), key=str) == want
    whole = tokens.tokenizer(PATH).library
    for r in made:
        assert r.decoded == whole.decode(r.ids)
    real = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for r in pieces.decode(pieces.encode(real, PATH, keep=["text"]), PATH).collect():
        assert r.ids == library(r.text) and r.decoded == r.text
    assert pieces.encode(docs.limit(0), PATH).count() == 0


def brute_best(encoder, run):
    """Best sum of scores over all ways to split ``run``."""
    best = {0: (0.0, [])}
    for end in range(1, len(run) + 1):
        options = []
        for start in range(end):
            piece = run[start:end]
            score = encoder.scores.get(piece, encoder.unknown if end - start == 1 else None)
            if score is not None and start in best:
                options.append((best[start][0] + score, [*best[start][1], piece]))
        best[end] = max(options, key=lambda o: o[0])
    return best[len(run)]


def test_unigram_models_take_the_best_sum():
    encoder = pieces.Encoder(PATH)
    encoder.is_bpe = False
    rng = random.Random(6)
    for _ in range(200):
        run = "▁" + "".join(rng.choice("theanoi日") for _ in range(rng.randrange(1, 14)))
        made = encoder.split(run)
        assert "".join(made) == run
        total = sum(encoder.scores.get(p, encoder.unknown) for p in made)
        assert abs(total - brute_best(encoder, run)[0]) < 1e-9


def test_texts_of_ids(spark):
    encoder = pieces.encoder(PATH)
    rows = [library("hello world, ñß"), None, [], library("  two  日本😀"), [1, *library("a b")]]
    rows.append([encoder.bytes[255], encoder.bytes[128]])  # no UTF-8
    for some in (rows, rows[:4], rows[:2]):
        ids = spark.createDataFrame(list(enumerate(some)), "i int, ids array<int>")
        made = {r.i: r.decoded for r in pieces.decode(ids, PATH).collect()}
        for i, x in enumerate(some):
            assert made[i] == (None if x is None else encoder.decode(x).decode("utf-8", "replace"))


def test_no_piece_spans_a_cut():
    encoder = pieces.encoder(PATH)
    parts = encoder._parts("▁word.\nNext,日x")
    assert "".join(parts) == "▁word.\nNext,日x" and len(parts) > 3
    for left, right in zip(parts, parts[1:]):
        assert not any(left[-1] + right[0] in piece for piece in encoder.ids)
