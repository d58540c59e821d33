"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from jobtide.llm import merkle

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    return digest(*map(field, (doc_id, source, lang, None if n_chars is None else n_chars + more, text)))


def climb(nodes):
    """The top of a list of nodes, and for each the siblings on its way up (None where it is alone)."""
    ways, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for way, place in zip(ways, places):
            other = place ^ 1
            way.append((nodes[other] if other < len(nodes) else None, other < place))
        nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        places = [place // 2 for place in places]
    return nodes[0], ways


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        groups[lang].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf(row)))
    tops = {lang: climb([leaf(row) for row in groups[lang]]) for lang in order}
    root, outer = climb([tops[lang][0] for lang in order])
    made = []
    for lang, more in zip(order, outer):
        for row, inner in zip(groups[lang], tops[lang][1]):
            way = inner + more
            here = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0)
            for sibling, before in way:
                here = digest(*([sibling, here] if before else [here, sibling or ""]))
            siblings = digest(*[sibling for sibling, _ in way if sibling])
            made.append((row[0], leaf(row), tops[lang][0], root, siblings, here, here == root))
    return sorted(made, key=repr)


def result(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, merkle.report(docs).collect()), key=repr)


def some(count, lang="en", start=0):
    return [(i, f"text {i}", lang, f"src{i % 3}", 6 + i % 5) for i in range(start, start + count)]


@pytest.mark.parametrize("levels", [1, 2, 3, 10])
def test_trees_of_many_sizes(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = [row for size in (1, 2, 3, 4, 5, 8, 9, 17) for row in some(size, f"l{size}", 100 * size)]
    assert result(spark, rows) == expected(rows)


def test_more_leaves_than_a_segment(spark):
    rows = some(2_100) + some(3, "de", 5_000) + some(1, "fr", 6_000)
    made = result(spark, rows)
    assert made == expected(rows)
    assert {row[-1] for row in made} == {True, False}


def test_odd_rows(spark):
    odd = [
        (None, "no id", "en", "a", 3),
        (None, None, None, None, None),
        (7, "", "", "", 0),
        (7, "same id", "", "a", 1),
        (7, "same id", "", "a", 1),
        (14, "é" * 50_000, "ü", "ß", None),
        (21, "ties", None, "a", 2**62),
    ]
    rows = odd + some(40, "en", 30) + [(i, "nulls", "en", None, None) for i in range(100, 140)]
    assert result(spark, rows) == expected(rows)


def test_only_one_leaf(spark):
    rows = some(1)
    assert result(spark, rows) == expected(rows)
    assert result(spark, rows)[0][4] == digest()


def test_nulls_are_not_tampered_with(spark):
    rows = [(i, "x", "en", "s", None) for i in range(30)]
    assert all(row[-1] for row in result(spark, rows))


def test_empty_and_extra_columns(spark):
    empty = merkle.report(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns[:3] == ["doc_id", "leaf", "subroot"]
    rows = some(9)
    docs = spark.createDataFrame([(*row, *["x"] * 8) for row in rows], f"{SCHEMA}, leaf STRING, index STRING, tree STRING, range STRING, copy STRING, proof STRING, root STRING, nodes STRING")
    assert sorted(map(tuple, merkle.report(docs).collect()), key=repr) == expected(rows)
