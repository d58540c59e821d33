"""Quality classifier: supervised subword embeddings.

Every word stands for itself and for its character n-grams; each of these is hashed to one of ``BUCKETS``
learned vectors.  A document is the average of the vectors of all its features, a softmax over it gives the
probability of label 1.  Vectors and output weights are trained by stochastic gradient descent in numpy (step sizes
per vector, from the sum of its squared gradients) on a bounded sample of the labelled documents.

Runs of one word add the word n-grams of two, three and four equal words, whatever the word.

Fitting: at most ``SAMPLE`` labelled documents of at most ``LONGEST`` characters, those with the smallest hash of their
id, so the sample is the same however the tables are split; one task trains on it.  Scoring: whole texts.  As the output is linear in the
average, a bucket's vector reduces to one number; each task keeps the sum of each word it has met.

Results for odd input: null or empty text has no features and gets the score of the bias alone; without labels every score
is 0.5; a null quality is no label; where labels of a document differ the lower counts; a null id is never
held out and never labelled; repeated rows are scored each; extra columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf

BUCKETS = 1 << 17
DIMENSIONS = 8
SHORTEST_NGRAM, LONGEST_NGRAM = 2, 4
SAMPLE = 4000
LONGEST = 20_000
EPOCHS = 6
STEP = 0.3
THRESHOLD = 0.3
FOLDS = 5
KEPT_WORDS = 300_000
TEXTS_AT_ONCE = 100
_FACTORS = np.random.default_rng(97).integers(1, 2**63, LONGEST_NGRAM + 1, np.uint64) * np.uint64(2) + np.uint64(1)
# n-grams of equal words, by their length
RUNS = {size: xxhash.xxh3_64_intdigest("= " * size) % BUCKETS for size in (2, 3, 4)}


def features_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of their character n-grams, and the place in the list that each belongs to.

    The n-grams of all words are hashed together, as windows over the code points of ``<word>``.
    """
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) % np.uint64(BUCKETS)
    buckets, owners = [own], [np.arange(len(words))]
    points = np.frombuffer("".join([f"<{word}>" for word in words]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))
    for size in range(SHORTEST_NGRAM, LONGEST_NGRAM + 1):
        inside = np.flatnonzero(left >= size)
        hashes = np.full(len(inside), size, np.uint64)
        for k in range(size):
            hashes += (points[inside + k] + np.uint64(1)) * _FACTORS[k]
        hashes = (hashes ^ (hashes >> np.uint64(32))) * _FACTORS[-1]
        buckets.append((hashes >> np.uint64(32)) % np.uint64(BUCKETS))
        owners.append(owner[inside])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def _counts(text: str | None) -> tuple[Counter, dict[int, int]]:
    """Counts of the words, and of the n-grams of equal words by bucket."""
    words = text.split() if text else []
    same, runs = [a == b for a, b in zip(words, words[1:])], {}
    for size, bucket in RUNS.items():
        if not any(same):
            break
        runs[bucket] = sum(same)
        same = [a and b for a, b in zip(same, same[1:])]
    return Counter(words), runs


def _features(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        counts, runs = _counts(text)
        found, owners = features_of(list(counts))
        times = np.fromiter(counts.values(), np.float64, len(counts))[owners]
        total = np.bincount(found, times, BUCKETS)
        for bucket, often in runs.items():
            total[bucket] += often
        ids = np.flatnonzero(total)
        rows.append((ids.astype(np.int32), total[ids].astype(np.int32)))
    return pd.DataFrame(rows, columns=["buckets", "counts"])


@dataclass
class Model:
    """What a bucket adds to the log-odds of label 1, and their bias."""

    weights: np.ndarray
    bias: float


def fit(features: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Train on documents given as buckets and the shares they have in the document's features."""
    random = np.random.default_rng(seed)
    vectors = random.uniform(-0.5, 0.5, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    squares = np.full(BUCKETS, 1e-8)
    output, bias = random.normal(0, 0.5, (2, DIMENSIONS)), np.zeros(2)
    output_squares, bias_squares = np.full((2, DIMENSIONS), 1e-8), np.full(2, 1e-8)
    examples = [(ids, shares, label) for (ids, shares), label in zip(features, labels, strict=True) if len(ids)]
    for epoch in range(epochs):
        step = STEP * (1 - epoch / epochs)
        for i in random.permutation(len(examples)):
            ids, shares, label = examples[i]
            hidden = shares @ vectors[ids]
            scores = output @ hidden + bias
            error = np.exp(scores - scores.max())
            error /= error.sum()
            error[label] -= 1
            back = error @ output
            squares[ids] += shares**2 * (back @ back) / DIMENSIONS
            vectors[ids] -= (step * shares / np.sqrt(squares[ids]))[:, None] * back * 0.1
            gradient = np.outer(error, hidden)
            output_squares += gradient**2
            output -= step * gradient / np.sqrt(output_squares)
            bias_squares += error**2
            bias -= step * error / np.sqrt(bias_squares)
    return Model((vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> Model | None:
    """A model from labels (doc_id, quality) outside the held-out fold; None without labels."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"))
    texts = docs.select("doc_id", "text").where(F.char_length("text") <= longest)
    sized = docs.select("doc_id", F.char_length("text").alias("size")).where(F.col("size") <= longest)
    chosen = known.join(sized, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "label").collect()
    if not chosen:
        return None
    label_of = {row["doc_id"]: int(row["label"] > 0) for row in chosen}
    features = pandas_udf(_features, "buckets array<int>, counts array<int>")("text")
    rows = texts.where(F.col("doc_id").isin(list(label_of))).select("doc_id", features.alias("f")).select("doc_id", "f.*")

    def trained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = {}
        for batch in batches:
            for doc_id, buckets, counts in zip(batch["doc_id"], batch["buckets"], batch["counts"], strict=True):
                shares = np.asarray(counts, np.float32)
                found[doc_id] = np.array(buckets), shares / max(shares.sum(), 1)
        if found:
            order = sorted(found)
            model = fit([found[i] for i in order], [label_of[i] for i in order])
            yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    # the sample is bounded, so one task can train on it; the driver gets one number per bucket
    model = rows.repartition(1).mapInPandas(trained, "weights binary, bias double").first()
    return Model(np.frombuffer(model["weights"], np.float32), model["bias"]) if model else None


def quality_score(text: Column, model: Model | None) -> Column:
    """Probability of label 1."""
    if model is None:
        return F.lit(0.5)
    # one number per bucket: half a megabyte, whatever the corpus
    handle = SparkSession.getActiveSession().sparkContext.broadcast((model.weights, model.bias))

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias = handle.value
        known: dict[str, tuple[float, int]] = {}

        def learn(words: list[str]) -> None:
            found, owners = features_of(words)
            sums = np.bincount(owners, weights[found], len(words)).tolist()
            sizes = np.bincount(owners, minlength=len(words)).tolist()
            known.update(zip(words, zip(sums, sizes)))

        def one(counts: Counter, runs: dict[int, int]) -> float:
            total, size = sum(times * float(weights[bucket]) for bucket, times in runs.items()), sum(runs.values())
            for word, times in counts.items():
                value, features = known[word]
                total += times * value
                size += times * features
            return 1 / (1 + np.exp(-(total / size if size else 0.0) - bias))

        for texts in batches:
            scores = []
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                some = [_counts(text) for text in texts.iloc[at : at + TEXTS_AT_ONCE]]
                if len(known) > KEPT_WORDS:
                    known.clear()
                new = list(set().union(*(counts for counts, _ in some)).difference(known))
                if new:
                    learn(new)
                scores += [one(*each) for each in some]
            yield pd.Series(scores, dtype=float)

    return score(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels, **bounds)
    score = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(F.col("text"), model).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    model = train(docs, labels, **bounds)
    return docs.where(quality_score(F.col("text"), model) >= THRESHOLD)
