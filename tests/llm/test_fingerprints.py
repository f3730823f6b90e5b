from __future__ import annotations

import hashlib
import random
import re

import pytest

from offerlift.llm import fingerprints


def paragraphs(text):
    return set(re.findall(fingerprints.PARAGRAPH, text))


def near(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def texts():
    rng = random.Random(8)

    def prose(n):
        out = []
        for _ in range(n):
            out.append("".join(rng.choice("abcdé 𝒳xyz") for _ in range(rng.randrange(1, 60))))
            out.append(rng.choice([". ", "! ", "\n", "?? ", " "]))
        return "".join(out)

    base = prose(30)
    out = [None, "", "...", "one", "one", "a" * 1000, base, base, base + " More.", "First. " + base]
    for _ in range(60):
        out.append(prose(rng.choice([1, 3, 12, 40, 150])))
    sentences = base.split(". ")
    for _ in range(12):
        some = [s for s in sentences if rng.random() < 0.8]
        out.append(". ".join(some))
    return [*out, prose(3000)]


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (key, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((key, len(t), digest, near(t, edited), near(t, following)))
    return out


@pytest.mark.parametrize("first", [0, 100])
def test_likeness_equals_the_exact_one(spark, first):
    rows = [(first + i * 7, t) for i, t in enumerate(texts())]
    if first:
        rows += [(None, "null key. two."), (None, "another. two."), rows[10], rows[10], (rows[11][0], "x")]
    docs = spark.createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, fingerprint string")
    got = fingerprints.edits(docs.repartition(4)).collect()
    made = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got]
    assert sorted(made, key=str) == sorted(brute(rows), key=str)
    prints = {}
    for r in got:
        prints.setdefault(r.n_chars and (r.doc_id, r.n_chars), r.fingerprint)
    by_text = dict(zip([(k, len(t or "")) for k, t in rows], [t or "" for _, t in rows], strict=True))
    one = [prints[k] for k, t in by_text.items() if t == rows[6][1] and k in prints]
    assert len(one) >= 2 and len(set(one)) == 1


def test_one_row_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "abcd. efgh.")], "doc_id long, text string")
    r = fingerprints.edits(docs).first()
    assert r.near_next == 1.0 and r.n_chars == 11
    assert fingerprints.edits(docs.limit(0)).count() == 0
    assert fingerprints.fingerprint(docs).first().fingerprint == r.fingerprint


def test_small_differences_peel_from_the_fingerprint(spark):
    rng = random.Random(1)
    solved = 0
    for _ in range(30):
        a = [rng.getrandbits(40) for _ in range(200)]
        b = a[3:] + [rng.getrandbits(40)]
        a, b = ("\n".join(map(str, x)) for x in (a, b))
        differing = len(paragraphs(a) ^ paragraphs(b))
        rows = spark.createDataFrame([(a, b)], "a string, b string")
        keys = [fingerprints.sketch(fingerprints.digests(c), fingerprints.CELLS) for c in "ab"]
        d = rows.selectExpr(
            fingerprints.peeled(fingerprints._difference(*keys), fingerprints.CELLS) + " as d"
        ).first().d
        assert d in (differing, -1)
        solved += d >= 0
    assert solved >= 15


def test_edited_short_texts_keep_their_likeness(spark):
    texts = [" ".join(f"Sentence {i} of text {n} is here." for i in range(8)) for n in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = fingerprints.edits(docs).collect()
    assert all(200 < r.n_chars < 300 and 0.3 < r.near_edited < 1 for r in rows)
