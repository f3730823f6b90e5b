"""Columns of the documents that are called like columns of the operators."""

from __future__ import annotations

import os

import pytest

from offerlift.llm import pieces, pii, quality, simhash, suffixes

CLASHING = [
    "__text", "__found", "__key", "__KEPT", "__possible", "__gone", "__sha", "__rest",
    "__slot", "__word", "__bits", "component_id", "first", "rows", "rejected_by",
]


@pytest.fixture(scope="module")
def docs(spark):
    shared = " ".join(f"shared{i}" for i in range(60))
    texts = {
        1: f"{shared} alone 2024-03-05",
        2: f"other words {shared} and others",
        3: "a near copy of a text of some more than ten words here",
        4: "a near copy of a text of some more than ten words here",
        5: None,
        6: "",
    }
    rows = [(k, t, *[f"{c}-{k}" for c in CLASHING]) for k, t in texts.items()]
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


OPERATORS = {
    "pii": pii.pseudonymise,
    "near": simhash.without_near_duplicates,
    "repeats": lambda docs: suffixes.without_repeats(docs, window=204, gram=16),
    "quality": lambda docs: quality.filter_quality(docs, name="verdict").drop("verdict"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_come_through_and_change_nothing(docs, name):
    made = OPERATORS[name](docs)
    assert made.columns == docs.columns
    got = {r["doc_id"]: r for r in made.collect()}
    for key, row in got.items():
        assert [row[c] for c in CLASHING] == [f"{c}-{key}" for c in CLASHING]
    plain = OPERATORS[name](docs.select("doc_id", "text")).collect()
    assert {k: r["text"] for k, r in got.items()} == {r.doc_id: r.text for r in plain}


def test_key_and_text_cannot_be_called_like_own_columns(docs):
    with pytest.raises(ValueError, match="underscores"):
        pii.pseudonymise(docs, text="__text")
    with pytest.raises(ValueError, match="underscores"):
        simhash.without_near_duplicates(docs, key="__key")


def test_decoded_texts_replace_a_column_of_their_name(spark):
    import public_tokenizers

    names = sorted(n for n in os.listdir("/opt/tokenizers") if n.endswith(".model"))
    path = public_tokenizers.path(names[0])
    texts = spark.createDataFrame([(1, "some words", "x"), (2, None, "y")], "doc_id long, text string, ids string")
    with pytest.raises(ValueError, match="a column to keep"):
        pieces.encode(texts, path, keep=["ids"])
    encoded = pieces.encode(texts, path).selectExpr("*", "'old' as decoded")
    decoded = pieces.decode(encoded, path)
    assert decoded.columns == ["doc_id", "ids", "decoded"]
    assert sorted(r.decoded for r in decoded.collect()) == ["", "some words"]
    assert pieces.decode(encoded.where("false"), path).count() == 0
