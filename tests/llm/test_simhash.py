from __future__ import annotations

import random

import pytest
import xxhash

from offerlift.llm import simhash
from offerlift.llm.components import components


def brute_fingerprint(text, k=4):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, distance):
    root = {i: i for i in range(len(rows))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [least.get(find(i)) for i in range(len(rows))]


def texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    out = [None, "", " \n\t", "One", "one", "ONE two three", "é ü É", "a b c d", "A B c d"]
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.choice([5, 60, 300]))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(3)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    out.append(" ".join(rng.choice(words) for _ in range(70000)))
    return out + out[5:9]


def test_components_equal_brute_force(spark):
    rows = [(i if i % 17 else None, t, "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(docs).collect()
    prints = [(r[0], brute_fingerprint(r[1] or "")) for r in rows]
    want = brute_components(prints, 4)
    expected = sorted(
        ((k, f"{f:016x}", c) for (k, f), c in zip(prints, want, strict=True)), key=str
    )
    assert sorted(map(tuple, got), key=str) == expected


@pytest.mark.parametrize("kept", [1, 2, 3])
def test_links_join_all_that_are_near(spark, kept, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(kept)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        values.add(base)
        for _ in range(25):
            other = base
            for b in rng.sample(range(64), rng.randrange(1, 7)):
                other ^= 1 << b
            values.add(other)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "bits long")
    labels = components(simhash.links(frame, 4, kept)).collect()
    label = {r.node: r.label for r in labels}
    got = {}
    for v in signed:
        got.setdefault(label.get(v, v), set()).add(v)
    rows = [(i, v % (1 << 64)) for i, v in enumerate(signed)]
    want = {}
    for v, c in zip(signed, brute_components(rows, 4), strict=True):
        want.setdefault(c, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert got.count() == 0


def test_embedding_bounds_the_distance(spark):
    rng = random.Random(1)
    rows = [(rng.getrandbits(64) - (1 << 63), rng.getrandbits(64) - (1 << 63)) for _ in range(300)]
    frame = spark.createDataFrame(rows, "a long, b long")
    a, b = simhash.embedded(frame.a), simhash.embedded(frame.b)
    from pyspark.sql import functions as F

    bound = F.bit_count(a.bitwiseXOR(b)) <= F.bit_count(frame.a.bitwiseXOR(frame.b))
    assert frame.where(~bound).count() == 0
