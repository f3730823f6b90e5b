from __future__ import annotations

import hashlib
import random

import pytest

from offerlift.llm import suffixes


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array_is_the_sorted_suffixes(seed):
    rng = random.Random(seed)
    for alphabet in (1, 2, 3, 20):
        s = [rng.randrange(alphabet) for _ in range(rng.randrange(0, 120))]
        assert suffixes.suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:])
    word = [0, 1, 0, 0, 1] * rng.randrange(1, 12)
    assert suffixes.suffix_array(word) == sorted(range(len(word)), key=lambda i: word[i:])


def brute(texts, width=400):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - width + 1):
            w = d[i : i + width]
            seen[w] = seen.get(w, 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if seen[d[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def texts():
    rng = random.Random(9)
    words = ["the", "é", "wörter", "日本", "alpha", "beta", "gamma", "delta", "x", "1234"]
    words += ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passages = [prose(n) for n in (60, 75, 90, 150, 400)]
    out = [None, "", "short", "short", "a" * 399, "a" * 400, "a" * 1200, "ab" * 700, prose(3000)]
    for _ in range(60):
        out.append(prose(rng.randrange(120)) + " " + rng.choice(passages) + prose(rng.randrange(90)))
    for _ in range(12):
        base = out[rng.randrange(9, 60)]
        cut = rng.randrange(len(base))
        out += [base[:cut] + "!" + base[cut:], base]
    unit = prose(70)
    out += [unit * 3, prose(10) + unit, passages[4][1:399], passages[4][:400]]
    return out


@pytest.mark.parametrize("crowd", [2, 256])
def test_removed_bytes_equal_brute_force(spark, crowd, monkeypatch):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    rows = [(i if i != 3 else None, t, "s") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sha string").repartition(5)
    got = sorted(map(tuple, suffixes.repeated_bytes(docs).collect()), key=str)
    found = brute([r[1] for r in rows])
    want = sorted(((r[0], *b[:4]) for r, b in zip(rows, found, strict=True)), key=str)
    assert got == want


@pytest.mark.parametrize("window, gram", [(204, 64), (100, 100)])
def test_other_lengths_equal_brute_force(spark, window, gram):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffixes.repeated_bytes(docs, window=window, gram=gram).collect()
    brute_rows = brute([t for _, t in rows], window)
    assert sorted(map(tuple, found)) == [(i, *b[:4]) for i, b in enumerate(brute_rows)]


def test_unequal_contexts_of_one_key_meet_up_to_a_bound_only(spark, monkeypatch):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(600))
    rows = []
    for i in range(60):
        around = ["".join(rng.choice("klmnopq ") for _ in range(450)) for _ in range(2)]
        # Half of the rows share up to five bytes more on each side.
        near = passage if i % 2 else "stuvw"[i % 5 :] + passage + "stuvw"[: i % 5]
        rows.append((i, around[0] + near + around[1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffixes, "CROWD", 16)
    met, split = [], suffixes._meeting

    def meeting(chosen, window):
        met.append(split(chosen, window))
        return met[-1]

    monkeypatch.setattr(suffixes, "_meeting", meeting)
    got = sorted(map(tuple, suffixes.repeated_bytes(docs).collect()))
    want = [(i, *b[:4]) for i, b in enumerate(brute([t for _, t in rows]))]
    assert got == want
    few, many = ({r.key: r["count"] for r in m.groupBy("key").count().collect()} for m in met[0])
    assert few and max(few.values()) <= 16 < min(many.values())


def test_texts_lose_what_repeats(spark):
    rows = [(i, t, i) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, context int")
    got = {r.doc_id: r for r in suffixes.without_repeats(docs).collect()}
    assert len(got) == len(rows) and all(r.context == i for i, r in got.items())
    for (i, t, _), b in zip(rows, brute([r[1] for r in rows]), strict=True):
        if t is None or b[1] == 0:
            assert got[i].text == t
        else:
            assert got[i].text.replace("�", "") == b[4].decode("utf-8", "ignore")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.repeated_bytes(docs).count() == 0
    assert suffixes.without_repeats(docs).count() == 0
