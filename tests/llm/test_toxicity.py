from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from offerlift.llm import toxicity


def table(spark, n=600):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(500)]
    docs, labels = [], []
    for i in range(n):
        body = [rng.choice(words) for _ in range(rng.randrange(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                body.insert(rng.randrange(len(body)), rng.choice(["nasty", "awful", "vileness", "Vilest"]))
        docs.append((i, " ".join(body), "x"))
        labels.append((i, int(toxic)))
    docs += [(n, None, "x"), (n + 1, "", "x"), (n + 2, "nasty awful", "x"), (None, "awful", "x")]
    docs += [(n + 3, "word1 " * 60_000 + "nasty", "x"), docs[0], docs[1]]
    labels += [labels[0], (None, 1), (n + 1, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    return docs, frame, spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def scored(spark):
    docs, frame, labels = table(spark)
    index = toxicity.fit(frame, labels, min_support=3, min_chi2=20.0)
    return docs, frame, labels, index


def test_scores_tell_held_out_rows_apart(scored):
    docs, frame, _, index = scored
    rows = toxicity.score(frame, index).collect()
    assert len(rows) == len(docs)
    held = [r for r in rows if r.doc_id is not None and r.doc_id < 600]
    held = [r for r in held if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 100
    wrong = [r for r in held if (r.score >= toxicity.THRESHOLD) != (r.doc_id % 5 == 0)]
    assert len(wrong) <= 0.02 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[600].score == by_id[601].score < 0.3 <= by_id[602].score
    assert by_id[602].evidence and all(e % 5 == 0 for e in by_id[602].evidence)


def test_production_values_find_terms_in_the_smallest_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    index = toxicity.fit(docs, labels)
    assert index.idf
    scores = {row.score for row in toxicity.score(docs, index).collect()}
    assert len(scores) > 1 and max(scores) >= toxicity.THRESHOLD


def test_held_out_rows_do_not_change_the_index(spark, scored):
    _, frame, labels, index = scored
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 4 = 2, 1 - toxic, toxic) as toxic"
    )
    other = toxicity.fit(frame, flipped, min_support=3, min_chi2=20.0)
    assert other.idf == index.idf and other.example == index.example
    assert np.array_equal(other.toxic, index.toxic)
    assert np.array_equal(other.votes, index.votes) and np.array_equal(other.shares, index.shares)


@pytest.mark.parametrize("size", [1, 4, 64])
def test_neighbours_equal_the_full_search(monkeypatch, size):
    monkeypatch.setattr(toxicity, "RANGE", size)
    rng = np.random.default_rng(size)
    idf = {f"t{i}": (i + 1, 1.0) for i in range(12)}
    rows = []
    for key in range(300):
        numbers = np.flatnonzero(rng.random(13) < 0.25)
        weights = rng.integers(1, 4, len(numbers)).astype(float)
        if len(numbers):
            rows.append((key, int(rng.random() < 0.3), numbers.tolist(), weights / np.linalg.norm(weights)))
    index = toxicity.Index.build(idf, rows)
    assert index.count.sum() == len(rows) and index.toxic.sum() == sum(r[1] for r in rows)
    full = np.zeros((len(index.count), 13))
    for t in range(13):
        n = index.largest.shape[1]
        here = slice(index.offsets[t * n], index.offsets[(t + 1) * n])
        full[index.vectors[here], t] = index.weights[here]
    for _, _, numbers, weights in rows[:60]:
        q = np.zeros(13)
        q[numbers] = weights
        cosine = full @ q
        order = np.argsort(-cosine, kind="stable")
        least = cosine[order[np.searchsorted(np.cumsum(index.count[order]), 12)]]
        want = {i for i in np.flatnonzero(cosine >= least - 1e-9).tolist() if cosine[i] > 0}
        got = index.nearest(tuple(numbers), np.array(weights), 12)
        assert {i for _, i in got} == want
        assert all(abs(cosine[i] - s) < 1e-9 for s, i in got)


def dense(index, numbers, weights):
    full = np.zeros(len(index.idf) + 1)
    full[list(numbers)] = weights
    return full


def plain_vote(rows, query, rate):
    """The vote of the twelve nearest rows ``(vector, label)`` and of all as near as the last."""
    cosine = np.array([v @ query for v, _ in rows])
    least = max(np.sort(cosine)[::-1][: toxicity.NEIGHBOURS][-1] - 1e-9, 1e-12)
    near = [(c, y) for c, (_, y) in zip(cosine, rows, strict=True) if c >= least]
    weights = [c / (toxicity.NEAR + max(0.0, 1 - c)) for c, _ in near]
    for_it = sum(w * y for w, (_, y) in zip(weights, near, strict=True))
    return (for_it + toxicity.PRIOR * rate) / (sum(weights) + toxicity.PRIOR)


def test_scores_and_their_map_equal_brute_force(scored):
    docs, frame, labels, index = scored
    toxic = {}
    for key, y in [tuple(r) for r in labels.collect()]:
        if key is not None and y is not None and zlib.crc32(str(key).encode()) % 4 != 2:
            toxic[key] = max(y, toxic.get(key, 0))
    texts = {key: text for key, text, _ in docs if key in toxic}
    known = toxicity.Known(index.idf)
    rows = [(dense(index, *toxicity.vector(t, known)), toxic[k]) for k, t in texts.items()]
    positive, n = sum(y for _, y in rows), len(rows)
    votes = []
    for i, (query, y) in enumerate(rows):
        votes.append(plain_vote(rows[:i] + rows[i + 1 :], query, (positive - y) / (n - 1)))
    # Pooling adjacent violators over equal votes.
    pools = []
    for vote in sorted(set(np.round(votes, 9))):
        ys = [y for v, (_, y) in zip(votes, rows, strict=True) if round(v, 9) == vote]
        pools.append([sum(ys), len(ys), vote, vote])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, c, _, last = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + c, pools[-1][2], last]
    at = [v for _, _, first, last in pools for v in (first, last)]
    share = [s / c for s, c, _, _ in pools for _ in range(2)]
    for vote in np.linspace(0, 1, 101):
        want = (1 - toxicity.VOTE_SHARE) * np.interp(vote, at, share) + toxicity.VOTE_SHARE * vote
        assert abs(index.calibrated(vote) - want) < 1e-6
    got = {r.doc_id: r.score for r in toxicity.score(frame, index).collect()}
    for key, text, _ in docs[:80]:
        query = dense(index, *toxicity.vector(text or "", known))
        assert abs(got[key] - index.calibrated(plain_vote(rows, query, positive / n))) < 1e-6


def test_a_score_is_a_share_of_toxic_texts(spark):
    """Most held-out toxic texts reach the threshold, few others do."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null")
    scores = toxicity.score(docs, toxicity.fit(docs, labels))
    held = scores.join(labels, "doc_id").where(toxicity.held_out()).collect()
    caught = [r.score >= toxicity.THRESHOLD for r in held if r.toxic]
    alarms = [r.score >= toxicity.THRESHOLD for r in held if not r.toxic]
    assert np.mean(caught) >= 0.9 and np.mean(alarms) <= 0.03


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels)
    assert toxicity.score(docs, index).count() == 0
    some = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    assert [r.score for r in toxicity.score(some, index).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert toxicity.score(some, toxicity.fit(some, one)).count() == 2
