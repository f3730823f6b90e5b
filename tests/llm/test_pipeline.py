"""The pipeline against a plain version of every stage."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
import test_pii
import test_simhash
import test_suffixes
import test_tokens

from offerlift.llm import toxicity
from offerlift.sources.workspace import materialize

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_stages(rows, index):
    """Rows that each stage keeps, from those it is given."""
    known = toxicity.Known(index.idf)
    kept = [r for r in rows if index.score(r[1] or "", known, {})[0] < toxicity.THRESHOLD]
    yield kept
    prints = [(r[0], test_simhash.brute_fingerprint(r[1] or "")) for r in kept]
    classes = test_simhash.brute_components(prints, 4)
    kept = [r for r, c in zip(kept, classes, strict=True) if r[0] == c]
    yield kept
    cut = test_suffixes.brute([r[1] for r in kept], corpus_pipeline.PASSAGE)
    cut = [b[4].decode("utf-8", "ignore") for b in cut]
    kept = [(r[0], t, *r[2:4], len(t)) for r, t in zip(kept, cut, strict=True)]
    yield kept
    hidden = [test_pii.brute(r[1]) for r in kept]
    yield [(r[0], t, *r[2:4], len(t)) for r, t in zip(kept, hidden, strict=True)]


def test_stages_equal_plain_ones(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [tuple(r) for r in docs.collect()]
    for (_, stage), want in zip(corpus_pipeline.STAGES, plain_stages(rows, index), strict=False):
        docs = materialize(stage(spark, docs, sf_dir))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert sorted(map(tuple, docs.collect())) == sorted(want)
        rows = want
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    lengths = defaultdict(int)
    for r in packed:
        lengths[r.doc_id] += r.length
    want = {k: len(test_tokens.library(test_tokens.WORD, t)) + 1 for k, t, *_ in rows}
    assert lengths == want
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(whole.select("doc_id", "piece", "ids_crc32").collect()) == sorted(
        (r.doc_id, r.piece, r.ids_crc32) for r in packed
    )


def test_odd_rows_go_through(spark, sf_dir):
    odd = [None, "", "a b c", "same text here now", "same text here now", "x " * 30_000]
    rows = [(i if i != 1 else None, t, None, "s", None) for i, t in enumerate(odd)]
    docs = spark.createDataFrame([*rows, rows[3], (None, "other words", "en", None, 3)], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
    # Null and empty text are near copies of each other, as are the three equal texts.
    assert sorted(set(ids), key=str) == [0, 2, 3, 5, None]
    empty = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        empty = materialize(stage(spark, empty, sf_dir))
    assert empty.count() == 0
