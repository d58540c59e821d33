"""Collocations against counts of every phrase in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from jobtide.llm import collocations
from jobtide.llm.tables import arrow_rows
from jobtide.llm.words import chunks, split_words, word_hashes

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield [word for word in re.split(r"[\x20\x09]+", piece) if word]


def counted(rows):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for size in range(1, 5):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return counts, totals


def expected(rows, least):
    made = []
    counts, totals = counted(rows)
    for lang, f in counts.items():
        candidates = {s: a for s, a in f.items() if len(s) > 1 and a >= least}
        covered = set()
        for longer, more in candidates.items():
            for size in range(2, len(longer)):
                for i in range(len(longer) - size + 1):
                    if 100 * more >= 80 * candidates[longer[i : i + size]]:
                        covered.add(longer[i : i + size])
        for s, a in candidates.items():
            if s not in covered:
                score, _, left, right = min((2_000_000 * a // (f[s[:k]] + f[s[k:]]), k, f[s[:k]], f[s[k:]]) for k in range(1, len(s)))
                made.append((lang, " ".join(s), a, left, right, totals[lang], score))
    return sorted(made)


def found(spark, rows, least):
    graph = collocations.Graph(spark.createDataFrame(rows, SCHEMA), least=least)
    made = graph.collocations().select("lang", "phrase", "a", "l", "r", "n", "score")
    return sorted(map(tuple, made.collect())), graph


def passage(words, seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(words))


def some_rows():
    rng = random.Random(5)
    vocabulary = ["The", "of", "a", "NEW", "york", "City", "é", "É", "x y", "-"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n"]) for _ in range(rng.randrange(60)))
        rows.append((i, text, rng.choice(["en", "de", None, "und"]), "s", 0))
    return rows


@pytest.mark.parametrize("least", [2, 30])
def test_all_phrases(spark, least):
    rows = some_rows()
    assert found(spark, rows, least)[0] == expected(rows, least)


def test_passages_become_paths(spark):
    shared = [passage(61, 1), passage(4, 2), passage(5, 3), passage(3, 4)]
    rows = [(i, f"own{i} {shared[i % 4]} end{i}. {shared[0]}!", "en", "s", 0) for i in range(160)]
    made, graph = found(spark, rows, 30)
    assert made == expected(rows, 30)
    paths = {row["phrase"]: (row["weight"], row["steps"]) for row in graph.paths.collect()}
    assert paths[shared[0]] == (200, 58)
    assert paths[shared[2]] == (40, 2)


def test_repeats_of_one_word(spark):
    rows = [(i, "ha " * (i % 9), "en", "s", 0) for i in range(90)] + [(i, "ha ho " * (i % 7), "en", "s", 0) for i in range(90)]
    assert found(spark, rows, 10)[0] == expected(rows, 10)


def test_very_long_text(spark):
    rows = [(0, "one two three four five " * 60_000, "en", "s", 0), (1, "x" * 2_000_000, "en", "s", 0), (2, "one two. three four", "en", "s", 0)]
    assert found(spark, rows, 30)[0] == expected(rows, 30)


def rare_words(spark, texts, often=""):
    """Texts of 500 words, each of which is met once."""
    words = spark.range(500 * texts, numPartitions=8).selectExpr("id div 500 as doc_id", "md5(cast(id as string)) as word")
    return words.groupBy("doc_id").agg(F.concat(F.lit(often), F.array_join(F.collect_list("word"), " ")).alias("text")).withColumn("lang", F.lit("en"))


def test_cells_grow_with_the_text(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST_BITS", 14)
    shares = []
    for texts in (64, 4096):  # at one size of the maps, 64 times the text would mark all cells
        docs = rare_words(spark, texts).cache()
        bits = collocations.cell_bits(docs)
        held = collocations.frequent_cells(docs, bits, least=5)
        shares.append(np.unpackbits(held).mean())
        assert len(held) == (1 << bits) // 8
        docs.unpersist()
    assert shares[1] < 2 * shares[0] and shares[1] < 0.5


@pytest.mark.parametrize("bits", [14, 15, 27])
def test_number_of_cells_does_not_change_results(spark, monkeypatch, bits):
    monkeypatch.setattr(collocations, "LEAST_BITS", bits)
    monkeypatch.setattr(collocations, "MOST_BITS", bits)
    docs = rare_words(spark, 60, "some often met words. ")
    rows = some_rows() + [(i, row["text"], "en", "s", 0) for i, row in enumerate(docs.collect())]
    assert found(spark, rows, 30)[0] == expected(rows, 30)


def handed_over(docs, monkeypatch, rows_together, least=2):
    """Rows that the tasks hand over, and the edges made of them."""
    made, plain = [], DataFrame.mapInArrow
    with arrow_rows(docs.sparkSession, rows_together):
        held = [collocations.frequent_cells(docs, 20, least=least)]
        held.append(collocations.frequent_cells(docs, 20, held, least=least))
        monkeypatch.setattr(DataFrame, "mapInArrow", lambda *given: made.append(plain(*given)) or made[-1])
        edges = collocations.edges(docs, held)
        return made[-1].count(), sorted(map(tuple, edges.collect()))


def test_a_task_hands_over_each_edge_once(spark, monkeypatch):
    rows = [(i, f"one two three four five. own{i}, {passage(9, i % 3)}", ["en", "de", None][i % 3], "s", 0) for i in range(90)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1).cache()
    count, made = handed_over(docs, monkeypatch, 4)  # in 23 parts
    assert count == len(made)
    monkeypatch.undo()
    assert handed_over(docs, monkeypatch, 1000) == (count, made)
    docs.unpersist()


def test_edges_beyond_what_a_task_holds_are_handed_over_before(spark, monkeypatch):
    rows = some_rows()
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1).cache()
    count, made = handed_over(docs, monkeypatch, 4)
    monkeypatch.undo()
    monkeypatch.setattr(collocations, "HELD_BYTES", 2_000)
    monkeypatch.setattr(collocations, "_WAITING", 1_000)
    early, same = handed_over(docs, monkeypatch, 4)
    assert same == made and len(made) == count < early
    docs.unpersist()


def test_rows_handed_over_do_not_grow_with_the_splits(spark, monkeypatch):
    made, plain = [], DataFrame.mapInArrow
    rows = [(i, "one two three four five. " * 3, "en", "s", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(100).cache()
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda *given: made.append(plain(*given)) or made[-1])
    graph = collocations.Graph(docs)
    assert made[-1].columns[1] == "phrase"
    assert made[-1].count() <= 2 * spark.sparkContext.defaultParallelism * 6  # five edges and the number of words
    assert sorted(map(tuple, graph.collocations().select("lang", "phrase", "a", "l", "r", "n", "score").collect())) == expected(rows, 30)
    docs.unpersist()


def test_counting_tasks_follow_cores_then_the_text():
    gb = 1_000_000_000
    assert collocations.counting_tasks(0, 6) == collocations.counting_tasks(6 * gb, 6) == 12
    assert [collocations.counting_tasks(size * gb, 6) for size in (48, 96, 480)] == [94, 188, 938]


def test_report_is_ranked(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LEAST", 2)
    monkeypatch.setattr(collocations, "SHOWN", 5)
    rows = [(None, "B a. b A. c d. d c. c d. d c. a b c. q", lang, None, None) for lang in ("en", None) for _ in range(30)]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], f"{SCHEMA}, phrase STRING, words INT")
    made = [tuple(row) for row in collocations.report(docs).orderBy("lang", "rank").collect()]
    for lang in ("en", "und"):
        best = sorted((row for row in expected(rows, 2) if row[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:5]
        assert [row for row in made if row[0] == lang] == [(r[0], i + 1, r[1], *r[2:]) for i, r in enumerate(best)]


def test_large_counts_stay_exact(spark):
    big = 2**62
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)], "lang STRING, phrase STRING, words BYTE, n BIGINT")
    candidates = spark.createDataFrame([("en", "a b", 2, big - 1, None, None)], "lang STRING, phrase STRING, words BYTE, a BIGINT, left BIGINT, right BIGINT")
    assert collocations.scored(candidates, counts).collect()[0]["score"] == 2_000_000 * (big - 1) // (2 * big + 1)
    table = spark.createDataFrame([("en", "a b c", 3, big), ("en", "a b", 2, big // 4 * 5 + 1), ("en", "b c", 2, big // 4 * 5)], "lang STRING, phrase STRING, words BYTE, n BIGINT")
    empty = spark.createDataFrame([], "lang STRING, phrase STRING, weight BIGINT, steps BIGINT")
    kept = collocations._candidates(empty, collocations.nodes(table))
    assert sorted(row["phrase"] for row in kept.collect()) == ["a b", "a b c"]


def test_empty_tables(spark):
    for rows in ([], [(1, None, "en", "s", 0), (2, "", None, None, None), (3, " ., \n", "en", "s", 0)]):
        assert collocations.report(spark.createDataFrame(rows, SCHEMA)).collect() == []


@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(list(" \t\n.,aBÀé  😀\x00\x0b\x1c")), max_size=30), max_size=5))
def test_words_and_pieces(texts):
    made = split_words(pa.array(texts, pa.string()), collocations.BLANKS, collocations.STOPS)
    different = made.different.to_pylist()
    got = [[] for _ in texts]
    last = None
    for code, text, piece in zip(made.codes, made.text, made.piece):
        if piece != last:
            got[text].append([])
        got[text][-1].append(different[code])
        last = piece
    assert got == [[words for words in pieces(text) if words] for text in texts]


@given(st.lists(st.none() | st.text(st.sampled_from("aB é"), max_size=9), max_size=40), st.integers(1, 20), st.integers(0, 5))
def test_chunks_are_whole_texts(texts, size, skipped):
    made = [one for chunk in chunks(pa.array(texts, pa.string()).slice(skipped), size) for one in chunk.to_pylist()]
    assert made == [text or "" for text in texts[skipped:]]
    # words of a part of an array
    for chunk in chunks(pa.array(texts, pa.string()).slice(skipped), size):
        whole = split_words(pa.array(chunk.to_pylist()), b" ")
        assert split_words(chunk, b" ").different.to_pylist() == whole.different.to_pylist()


def test_words_have_different_hashes():
    words = pa.array([f"{a}{b}" for a in "abcdefgh" * 4 for b in range(2_000)] + ["ab", "ba", "aab", "aba", "a" * 5_000, "a" * 5_001])
    different = words.dictionary_encode().dictionary
    assert len(set(word_hashes(different).tolist())) == len(different)
    assert word_hashes(different.slice(100, 50)).tolist() == word_hashes(different)[100:150].tolist()
    assert (word_hashes(different, 7) != word_hashes(different)).all()
