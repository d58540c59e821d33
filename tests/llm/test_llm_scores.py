"""Language-model scores against a model of plain dictionaries, and the filters by themselves."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from jobtide.llm import bloom_lm
from jobtide.llm.tables import Scratch

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
END = None


def tokens(text):
    return [word for word in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if word] + [END]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def level(count, least):
    """Number of steps of one half that lead from the least count to this one at most."""
    steps, bound = 0, float(least)
    while math.ceil(bound) <= count:
        steps, bound = steps + 1, bound * 1.5
    return steps


def standing_for(count, least):
    """Middle of all counts with this count's level; 0 for those that are not held."""
    if count < least:
        return 0.0
    low = math.ceil(least * 1.5 ** (level(count, least) - 1))
    high = math.ceil(least * 1.5 ** level(count, least)) - 1
    return (low + high) / 2


def expected(rows, one_in, order=3):
    counts = [Counter() for _ in range(order + 1)]
    for doc_id, text, *_ in rows:
        if not is_held_out(doc_id):
            row = tokens(text)
            counts[1].update((one,) for one in row)
            for size in range(2, order + 1):
                counts[size].update(zip(*([END, *row][i:] for i in range(size))))
    total, kinds = sum(counts[1].values()), len(counts[1])
    least = max(1, -(-total // one_in))
    held = [{gram: n for gram, n in some.items() if n >= least} for some in counts]
    weights = {}
    for size in range(2, order + 1):
        sums = {}
        for context, n in held[size - 1].items():
            if size > 2 and context[-1] is END:
                continue
            after = [m for gram, m in held[size].items() if gram[:-1] == context]
            one = sums.setdefault(level(n, least), [0, 0, 0])
            one[0] += n
            one[1] += sum(after)
            one[2] += len(after)
        for at, (n, followed, different) in sums.items():
            weights[size, at] = n / (n + different), (n - followed + different) / (n + different)
    even = total - sum(held[1].values()) + len(held[1])
    made = []
    for doc_id, text, *_ in rows:
        row, score = tokens(text), 0.0
        line = [END, *row]
        for at in range(1, len(line)):
            p = 1 / (kinds + 1)
            if total:
                p = min(1.0, (standing_for(counts[1][line[at],], least) + even * p) / (total + len(held[1])))
            for size in range(2, min(order, at + 1) + 1):
                context, gram = tuple(line[at - size + 1 : at]), tuple(line[at - size + 1 : at + 1])
                if context in held[size - 1]:
                    share, rest = weights[size, level(held[size - 1][context], least)]
                    whole = standing_for(held[size - 1][context], least)
                    p = share * min(standing_for(counts[size][gram], least), whole) / whole + rest * p
            score += math.log10(p)
        base = sum(math.log10((counts[1][one,] + 0.5) / (total + 0.5 * (kinds + 1))) for one in row)
        known = sum(counts[1][one,] > 0 for one in row)
        made.append((doc_id, is_held_out(doc_id), len(row), known, total, base, score))
    return sorted(made, key=repr)


def result(spark, rows, one_in):
    docs, scratch = spark.createDataFrame(rows, SCHEMA), Scratch(spark, "test-lm")
    model, counts = bloom_lm.train(docs, scratch, one_in=one_in)
    return sorted(map(tuple, bloom_lm.score(docs, model, counts, scratch).collect()), key=repr), model


def same(made, wanted):
    assert [row[:5] for row in made] == [row[:5] for row in wanted]
    for got, want in zip(made, wanted):
        assert got[5:] == pytest.approx(want[5:], rel=1e-9)


def some_rows(count=90):
    rng = random.Random(11)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(80)] + ["THE", "the", "É", "é", "x.", "\x1c"]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "\t "]) for _ in range(rng.randrange(70))), "en", "s", 0) for i in range(count)]
    return rows + [(count + i, rows[i][1], "en", "copy", 0) for i in range(min(20, count))]


@pytest.mark.parametrize(("one_in", "common"), [(10**7, 1 << 17), (400, 1 << 17), (150, 2), (10**7, 0)])
def test_scores(spark, monkeypatch, one_in, common):
    monkeypatch.setattr(bloom_lm, "BITS", 96)  # hardly a false positive
    monkeypatch.setattr(bloom_lm, "COMMON", common)
    rows = some_rows()
    same(result(spark, rows, one_in)[0], expected(rows, one_in))


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "BITS", 96)
    monkeypatch.setattr(bloom_lm, "COMMON", 5)
    long_word = "z" * 100_000
    rows = some_rows(30) + [
        (None, "no id at all", "en", "s", 0),
        (None, None, None, None, None),
        (3, None, "en", "s", 0),
        (3, "", "en", "s", 0),
        (3, " \n\t ", "en", "s", 0),
        (500, f"{long_word} {long_word} once", "en", "s", 0),
        (501, "the w1 É " * 20_000, "en", "s", 0),
        (501, "the w1 É " * 20_000, "en", "s", 0),
    ]
    same(result(spark, rows, 10**7)[0], expected(rows, 10**7))


def test_only_held_out_texts(spark):
    ids = [i for i in range(50) if is_held_out(i)]
    rows = [(i, "some words", "en", "s", 0) for i in ids]
    made = result(spark, rows, 10**7)[0]
    same(made, expected(rows, 10**7))
    assert {row[3:5] for row in made} == {(0, 0)}


def test_empty_and_extra_columns(spark):
    assert bloom_lm.report(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = some_rows(10)
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], f"{SCHEMA}, held_out STRING, row INT")
    made = sorted(map(tuple, bloom_lm.report(docs).collect()), key=repr)
    assert [row[:5] for row in made] == [row[:5] for row in expected(rows, 10**7)]


def test_levels(spark):
    for least in (1, 2, 7, 1000):
        low = bloom_lm.lowest_counts(least)
        counts = np.unique(np.concatenate((low, low - 1, low + 1, [2**50])))
        counts = counts[(counts >= 0) & (counts < 2**60)]
        levels = np.searchsorted(low, counts, side="right")
        assert levels.tolist() == [level(int(n), least) for n in counts]
        middle = bloom_lm.middle_counts(least)[levels]
        assert middle.tolist() == pytest.approx([standing_for(int(n), least) for n in counts])
        # the bound of the filters' sizes
        assert all(3 * at <= 4 * n / least for at, n in zip(levels, counts) if n >= least)


def test_filter_errs_only_upwards(spark):
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(-(2**55), 2**55, 60_000) << 8)  # the bits below tell the kind
    levels = rng.geometric(0.4, len(grams)).clip(max=20)
    table = spark.createDataFrame(zip(grams.tolist(), levels.tolist()), "gram BIGINT, level INT")
    made = bloom_lm._build(table, int(levels.sum()))
    read = made.levels(grams.view(np.uint64))
    assert (read >= levels).all() and (read > levels).mean() < 0.01
    others = rng.integers(0, 2**64, 60_000, np.uint64)
    assert (made.levels(others) > 0).mean() < 0.01


def test_held_out_texts_are_likelier_in_their_order(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("n_chars > 500")
    from pyspark.sql import functions as F

    mixed_up = docs.select(
        (F.col("doc_id") + 0).alias("doc_id"),
        F.array_join(F.sort_array(F.split("text", r"\s+")), " ").alias("text"),
    )
    scratch = Scratch(spark, "test-lm")
    model, counts = bloom_lm.train(docs, scratch)
    sums = [
        bloom_lm.score(some, model, counts, scratch).where("held_out").selectExpr("sum(score)", "sum(base_score)").first() for some in (docs, mixed_up)
    ]
    (real, base), (mixed_score, _) = sums
    assert real > base and real > mixed_score


def test_rare_grams_of_a_large_corpus_are_held(spark):
    from pyspark.sql import functions as F

    docs = spark.range(150).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a "), F.lit(100_000)).alias("text"))
    docs = docs.union(spark.createDataFrame([(1000, "met once only")], "doc_id BIGINT, text STRING"))
    assert not is_held_out(1000)
    made = bloom_lm.report(docs).where("doc_id = 1000").first()
    assert made["train_tokens"] > 10_000_000
    # each word but the first follows from the one before it; as words that are not held they had 10^-7 each
    assert made["score"] > -5


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for i in range(blocks.size()) if (name := blocks.apply(i).name()).startswith("shuffle_")}


def new_shuffle_files(spark, before):
    for _ in range(100):  # files are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    made = Scratch(spark, "test-store").store(spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count(), "counts")
    assert new_shuffle_files(spark, before) == set()
    assert sorted(map(tuple, made.collect())) == [(k, 100) for k in range(10)]


def test_shuffles_of_stored_tables_are_removed(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "BITS", 96)
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    made = bloom_lm.report(spark.createDataFrame(some_rows(), SCHEMA))
    assert new_shuffle_files(spark, before) == set()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    # nothing of these shuffles is needed for the result, however often it is read
    first = sorted(map(tuple, made.collect()), key=repr)
    assert first == sorted(map(tuple, made.collect()), key=repr)
    same(first, expected(some_rows(), 10**7))
