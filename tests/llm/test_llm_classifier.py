"""The quality classifier's features, training and scores next to plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash

from jobtide.llm import quality_classifier as qc

MASK = 2**64 - 1


def plain_features(text):
    """Buckets of words, of the n-grams of <word>, and of runs of equal words, with their counts."""
    out, words = Counter(), (text or "").split()
    for word in words:
        out[xxhash.xxh3_64_intdigest(word) % qc.BUCKETS] += 1
        marked = f"<{word}>"
        for size in range(qc.SHORTEST_NGRAM, qc.LONGEST_NGRAM + 1):
            for i in range(len(marked) - size + 1):
                value = (size + sum((ord(c) + 1) * int(f) for c, f in zip(marked[i : i + size], qc._FACTORS))) & MASK
                value = ((value ^ (value >> 32)) * int(qc._FACTORS[-1])) & MASK
                out[(value >> 32) % qc.BUCKETS] += 1
    for size, bucket in qc.RUNS.items():
        out[bucket] += sum(len(set(words[i : i + size])) == 1 for i in range(len(words) - size + 1))
    return +out


def plain_score(text, model):
    counts = plain_features(text)
    mean = sum(n * float(model.weights[b]) for b, n in counts.items()) / max(sum(counts.values()), 1)
    return 1 / (1 + math.exp(-mean - model.bias))


def texts():
    rng = random.Random(23)
    words = ["spam", "spam", "the", "a", "é\U0001f600", "x" * 50, "lorem", "ipsum", "#", "<>"]
    made = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    return [None, "", " \n\t", "w", "a a a a a", "x" * 30_000, *made, *made[:10]]


def test_plain_features():
    table = qc._features(pd.Series(texts()))
    for text, buckets, counts in zip(texts(), table["buckets"], table["counts"], strict=True):
        assert dict(zip(buckets.tolist(), counts.tolist())) == plain_features(text)


@pytest.mark.parametrize("kept", [qc.KEPT_WORDS, 3])
def test_plain_scores(spark, monkeypatch, kept):
    """Scores are the softmax of the mean of the vectors, also when known words are forgotten on the way."""
    monkeypatch.setattr(qc, "TEXTS_AT_ONCE", 7)
    monkeypatch.setattr(qc, "KEPT_WORDS", kept)
    rng = np.random.default_rng(3)
    model = qc.Model(rng.normal(0, 3, qc.BUCKETS).astype(np.float32), 0.4)
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id BIGINT, text STRING").repartition(3)
    got = {r.doc_id: r.score for r in docs.select("doc_id", qc.quality_score(docs.text, model).alias("score")).collect()}
    assert len(got) == len(texts())
    for i, text in enumerate(texts()):
        assert got[i] == pytest.approx(plain_score(text, model), abs=1e-6)


def test_folded_weights_are_the_softmax():
    """With one class's vectors folded into one number per bucket nothing is lost: learned texts come out on their side."""
    good, bad = ["calm words of good prose here", "more good and calm prose"], ["buy buy buy now", "now buy cheap cheap"]
    rows = []
    for text in good + bad:
        counts = plain_features(text)
        ids = np.array(sorted(counts))
        shares = np.array([counts[i] for i in ids], np.float32)
        rows.append((ids, shares / shares.sum()))
    model = qc.fit(rows * 20, [1, 1, 0, 0] * 20)
    assert [plain_score(t, model) > 0.5 for t in good + bad] == [True, True, False, False]
    again = qc.fit(rows * 20, [1, 1, 0, 0] * 20)
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(i % 9, t) for i, t in enumerate(texts())] + [(None, "spam"), (4, "a a a a a"), (4, "a a a a a")]
    clashing = spark.createDataFrame(
        [(*r, "t", 7, 0.1, 3, b"") for r in rows], "doc_id BIGINT, text STRING, held_out STRING, predicted INT, score DOUBLE, f INT, label BINARY"
    )
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(9)] * 2, "doc_id BIGINT, quality INT")
    plain = clashing.select("doc_id", "text")
    got = [sorted(map(tuple, qc.scored(d, labels).collect()), key=str) for d in (clashing, plain)]
    assert got[0] == got[1] and len(got[0]) == len(rows)
    for doc_id, held_out, score, predicted in got[0]:
        assert held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= score <= 1 and predicted == (score >= 0.3)
    assert qc.good_documents(clashing, labels).columns == clashing.columns
