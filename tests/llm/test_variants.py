from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from offerlift.llm import variants


def brute_words(rows):
    seen = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def brute_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute(rows):
    n = brute_words(rows)
    near = {w: [] for w in n}
    for a, b in combinations(n, 2):
        if brute_near(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(11)
    letters = "abcdeé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(7, 12))) for _ in range(60)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "bababab", "Ünterwegs", "ünterwegs"]
    changed = []
    for w in base:
        for _ in range(3):
            i = rng.randrange(len(w))
            changed += [w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + rng.randrange(2) :]]
    texts = []
    for i in range(400):
        some = [rng.choice(base) for _ in range(60)] + [rng.choice(changed) for _ in range(2)]
        rng.shuffle(some)
        texts.append((i, rng.choice([" ", ", ", "-", "1"]).join(some).title()))
    texts += [(None, "lostkey lostkey"), (3, None), (4, ""), (5, "short x")]
    texts += [(6, "œuvresœuvres ×÷×÷×÷× ×÷×÷×÷×")]
    chain = {"chainword": 800, "chainwort": 60, "chaimwort": 1}
    texts += [(i, " ".join(w for w, n in chain.items() for _ in range(n))) for i in range(700, 704)]
    return texts + texts[:5] + [(900, " ".join(base * 400))]


@pytest.mark.parametrize("crowd", [variants.CROWD, 0, 3])
def test_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(variants, "CROWD", crowd)
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, word string")
    got = sorted((tuple(r) for r in variants.variants(docs).collect()), key=str)
    want = brute(rows)
    assert got == want
    assert any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)


def test_pivots_share_no_character_and_cost_least():
    rng = random.Random(2)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randrange(3, 8)))
        cost = [rng.randrange(1, 9) for _ in places]
        a, b = variants._pivots(places, cost)
        pairs = [(x, y) for x, y in combinations(range(len(places)), 2) if places[y] - places[x] >= 2]
        least = min(cost[x] + cost[y] for x, y in pairs)
        assert b - a >= 2
        assert cost[places.index(a)] + cost[places.index(b)] == least


def test_a_pattern_splits_a_crowd(spark):
    """All words share one half; no key of the split index has more than a few of them."""
    words = [a + b + "zzzzzz" for a in "abcdefgh" for b in "abcdefgh"]
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")
    rows = vocabulary.selectExpr("'R' side", "'zzzzzz' half", "substring(word, 1, 2) rest")
    patterns = variants._with_patterns(rows, variants.F.lit(0))
    assert patterns.groupBy("pattern").count().agg({"count": "max"}).first()[0] == 8


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = variants.variants(docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got.count() == 0
