from __future__ import annotations

import random
import re
from collections import Counter

from offerlift.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    n = len(w)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[i : i + 8]) for i in range(n - 7))
    covered = {i + o for i in range(n - 7) if seen[tuple(w[i : i + 8])] > 1 for o in range(8)}
    chars = sum(map(len, w))
    marks = sum(c in "#*$%&|<>" for c in t)
    dup = len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(covered) > 30 * n
    stutter = sum(a == b for a, b in zip(w, w[1:], strict=False))
    letters = sum(any(c.isalpha() for c in x) for x in w)
    bad = 10 * marks > 3 * n or 2 * dup > len(lines) or 10 * stutter > 3 * n or 2 * letters < n
    bad = bad or not 2 * n <= chars <= 15 * n
    return n, chars, marks, dup, len(covered), failed, not failed and not bad


def texts():
    rng = random.Random(2)
    out = [None, "", " \n\t\x0b", "a\xa0b c d", "\n\n\n", "one " * 19, "one " * 20, "x" * 9000, "é𝒳 " * 30]
    vocabulary = [f"w{i}" for i in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    for _ in range(40):
        line = prose(9)
        out.append("\n".join([prose(30), line, prose(rng.randrange(60)), line, " ", line][: rng.randrange(2, 7)]))
    out += [prose(40) + " ### $$ %% ||" * 5, "\n".join([prose(5)] * 3 + [prose(40)]), "12 34 56 78 " * 9 + prose(9)]
    out += [prose(30) + " a a a a a a a a a a a b b b b b b b b b", prose(30000), prose(7), prose(8) + " " + prose(8)]
    return out + out[9:12]


def test_counts_and_verdicts_equal_brute_force(spark):
    rows = [(i if i != 7 else None, t, 0) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = sorted(map(tuple, quality.measure(docs).collect()), key=str)
    assert got == sorted(((k, *brute(t)) for k, t, _ in rows), key=str)
    assert quality.measure(docs.limit(0)).count() == 0


def test_order_of_rules_does_not_change_what_is_kept(spark):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    kept = []
    for rules in (quality.RULES, quality.RULES[::-1], quality.RULES[2:] + quality.RULES[:2]):
        rows = docs.withColumn("__text", docs.text).fillna("", ["__text"])
        kept.append(rows.where(quality.rejected_by(rules).isNull()).count())
    assert len(set(kept)) == 1


def test_cheap_and_selective_rules_come_first(spark):
    docs = spark.createDataFrame([(i, "word " * 400) for i in range(400)], "doc_id long, text string")
    costly = quality.Rule("costly", f"{quality.repeated_words(quality.words())} > 0")
    nothing = quality.Rule("nothing", "length(__text) < 0")
    cheap = quality.Rule("cheap", "length(__text) > 0")
    order = [e.rule.name for e in quality.estimate(docs, [nothing, costly, cheap])]
    assert order == ["cheap", "costly", "nothing"]
    got = quality.filter_quality(docs, [costly, cheap]).select("rejected_by").distinct().collect()
    assert [r.rejected_by for r in got] == ["cheap"]
