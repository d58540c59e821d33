"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Wherever a paragraph (lines up to one without a word, so that notices may be wrapped) holds enough of a template's word pairs (``CONFIRMED``) close together, windows around
that place are seen as their distinct word n-grams (one to three words, hashed, sparse), so the length of the paragraph
does not count.  A multinomial logistic regression over them tells licence families, licences of no known family
(``UNLISTED``) and plain prose apart.  It is trained here, by
stochastic gradient descent in numpy, on variations of short licence notices and, for prose, on
prose made of the notices' own words in random order and on paragraphs of a bounded sample of the corpus.
Probabilities are calibrated by a temperature fitted on variations that training has not seen.  A place counts if in one of
its windows the best family is the template's and reaches ``SURE``.  Other places that are surely no prose and hold
a word that grants are reported as ``UNLISTED``.

Results for odd input: null, empty or blank texts have no licence (empty list); very long texts are read whole;
repeated rows are scanned each; an empty table gives an empty table; extra columns are not looked at.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

BUCKETS = 1 << 15
SURE = 0.6
CONFIRMED = 0.6
# for the class of prose: documents of the corpus, and paragraphs of these
SAMPLE = 400
PARAGRAPHS = 1000
LONGEST = 20_000
VARIATIONS = 40
EPOCHS = 15
# other words that may stand inside a notice, and words that a window takes along on either side
SLACK = 8
MARGINS = (1, 4, 8)
# plain prose
UNKNOWN = "none"
# notices that name no licence of a known family
RESERVED, UNLISTED = "AllRightsReserved", "unknown"

# notices as licences ask for them or as people write them
TEMPLATES = {
    "Apache": (
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
        "spdx license identifier apache 2.0",
    ),
    "MIT": (
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "spdx license identifier mit",
    ),
    "GPL": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "spdx license identifier gpl 3.0 or later",
    ),
    "LGPL": (
        "licensed under the gnu lesser general public license version 3",
        "this library is free software you can redistribute it under the terms of the gnu lesser general public license",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
        "spdx license identifier lgpl 2.1",
    ),
    "BSD": (
        "released under the bsd 3 clause license",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "spdx license identifier bsd 3 clause",
    ),
    "MPL": (
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        "spdx license identifier mpl 2.0",
    ),
    "CC-BY": (
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
    ),
    "CC-BY-NC": (
        "licensed under cc by nc 4.0",
        "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    ),
    "CC-BY-SA": (
        "licensed under cc by sa 4.0",
        "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    ),
    "PublicDomain": (
        "this is free and unencumbered software released into the public domain",
        "dedicated to the public domain under cc0 1.0 universal",
    ),
    RESERVED: ("all rights reserved",),
    # a star stands for a name
    UNLISTED: (
        "licensed under epl 2.0",
        "licensed under eupl 1.2",
        "licensed under agpl 3.0",
        "licensed under cddl 1.0",
        "licensed under zlib",
        "licensed under the * license",
        "released under the * license",
        "distributed under the * license",
        "available under the terms of the * license",
        "this work is licensed under the * license",
        "spdx license identifier *",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
        "this program and the accompanying materials are made available under the terms of the * public license",
        "this library is free software you can redistribute it and or modify it under the same terms as perl itself",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license",
    ),
}
# names for the stars in training, besides words of the corpus
NAMES = ("eclipse", "eclipse public", "zlib", "isc", "artistic", "boost software", "european union public", "open software", "gnu affero general public", "postgresql")
FAMILIES = (*TEMPLATES, UNKNOWN)
# words of the longest template, and as many around them as a window takes along
WINDOW = max(len(t.replace(".", " ").split()) for texts in TEMPLATES.values() for t in texts) + 2 * MARGINS[-1]
_WORD = re.compile(r"[^\W_]+")
_GRANTS = re.compile(r"licen[cs]|permi(?:t|ssion)|redistribut")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def paragraphs_of(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """Words of each paragraph, and the number of the line that each word is on; a line without a word ends a paragraph."""
    words, lines = [], []
    for number, line in enumerate(text.split("\n")):
        more = words_of(line)
        if not more and words:
            yield words, lines
            words, lines = [], []
        words += more
        lines += [number] * len(more)
    if words:
        yield words, lines


def ngrams(words: list[str]) -> np.ndarray:
    """Buckets of the distinct n-grams of one to three words."""
    joined = [*words, *map(" ".join, zip(words, words[1:])), *map(" ".join, zip(words, words[1:], words[2:]))]
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(x) % BUCKETS for x in joined), np.int64, len(joined)))


def _pairs(words: list[str]) -> set[tuple[str, ...]]:
    # digits of version numbers vary
    kept = [w for w in words if not w.isdigit()]
    return set(zip(kept, kept[1:])) or {tuple(kept)}


@lru_cache(maxsize=1)
def _template_pairs() -> dict[str, list[set]]:
    return {family: [_pairs(words_of(t)) for t in texts] for family, texts in TEMPLATES.items()}


@lru_cache(maxsize=1)
def _templates() -> tuple[list[tuple[str, int, int]], dict[tuple, list[int]]]:
    """Family, pairs needed and longest span of every template, and the templates that hold a pair."""
    rules, holders = [], defaultdict(list)
    for family, texts in TEMPLATES.items():
        for text, pairs in zip(texts, _template_pairs()[family], strict=True):
            for pair in pairs:
                holders[pair].append(len(rules))
            kept = [w for w in words_of(text) if not w.isdigit()]
            rules.append((family, math.ceil(CONFIRMED * len(pairs) - 1e-9), len(kept) + SLACK))
    return rules, dict(holders)


def confirmed(family: str, words: list[str]) -> float:
    """The largest share of a template's word pairs that the paragraph holds."""
    pairs = _pairs(words)
    return max(len(t & pairs) / len(t) for t in _template_pairs()[family])


def _other_numbers(words: list[str], random: np.random.Generator) -> list[str]:
    return [str(random.integers(0, 10)) if w.isdigit() else w for w in words]


def _variation(words: list[str], random: np.random.Generator, spare: np.ndarray) -> list[str]:
    """A notice at any place of a long paragraph, with words lost and digits changed, cut to a window."""
    kept = _other_numbers([w for w in words if random.random() > 0.05], random)
    before, after = random.integers(0, 500, 2)
    margin = random.integers(0, MARGINS[-1] + 1)
    around = [list(random.choice(spare, min(n, margin))) for n in (before, after)]
    return [*around[0], *kept, *around[1]]


def _named(template: str, random: np.random.Generator, spare: np.ndarray) -> str:
    """A name in the place of the star: words of the corpus, or that of a licence."""
    name = " ".join(random.choice(spare, random.integers(0, 4))) if random.random() < 0.6 else str(random.choice(NAMES))
    return template.replace("*", name)


def examples(unknown: list[list[str]], random: np.random.Generator) -> list[tuple[np.ndarray, int]]:
    spare = np.array([w for words in unknown for w in words] or ["and"])
    made = []
    for number, family in enumerate(FAMILIES[:-1]):
        for template in TEMPLATES[family]:
            for _ in range(VARIATIONS):
                words = words_of(_named(template, random, spare))
                made.append((ngrams(_variation(words, random, spare)), number))
                shuffled = _other_numbers(list(random.permutation(words)), random)
                # short of the whole, so that no shuffle is the notice itself
                made.append((ngrams(shuffled[: random.integers(1, len(words))]), len(FAMILIES) - 1))
    for words in filter(None, unknown):
        start = random.integers(0, max(len(words) - WINDOW, 0) + 1)
        made.append((ngrams(words[start : start + WINDOW]), len(FAMILIES) - 1))
    return made


@dataclass
class Model:
    weights: np.ndarray  # bucket, family
    bias: np.ndarray
    temperature: float


def _scores(weights: np.ndarray, bias: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return weights[ids].sum(axis=0) / np.sqrt(max(len(ids), 1)) + bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit(unknown: list[list[str]], seed: int = 11) -> Model:
    random = np.random.default_rng(seed)
    training, held = examples(unknown, random), examples(unknown[:200], random)
    weights, bias = np.zeros((BUCKETS, len(FAMILIES)), np.float32), np.zeros(len(FAMILIES))
    for epoch in range(EPOCHS):
        step = 0.5 * (1 - epoch / EPOCHS)
        for i in random.permutation(len(training)):
            ids, label = training[i]
            error = _softmax(_scores(weights, bias, ids))
            error[label] -= 1
            weights[ids] -= step * error / np.sqrt(max(len(ids), 1))
            bias -= 0.1 * step * error
    # the temperature with the smallest log loss on variations not trained on
    losses = {}
    scores = [(_scores(weights, bias, ids), label) for ids, label in held]
    for temperature in np.geomspace(0.25, 8, 26):
        losses[temperature] = -sum(np.log(_softmax(s / temperature)[label] + 1e-12) for s, label in scores)
    return Model(weights, bias, float(min(losses, key=losses.get)))


def _places(words: list[str]) -> list[tuple[int, str, set[int]]]:
    """Where enough of a template's pairs stand close together: number of pairs, family, and the places of their words."""
    rules, holders = _templates()
    kept = [(i, w) for i, w in enumerate(words) if not w.isdigit()]
    hits = defaultdict(list)  # by template: place among the kept words, pair
    for k, ((_, w), (_, x)) in enumerate(zip(kept, kept[1:])):
        for t in holders.get((w, x), ()):
            hits[t].append((k, (w, x)))
    found = []
    for t, places in hits.items():
        family, need, longest = rules[t]
        best, left, inside = None, 0, Counter()  # best: number of pairs, first and last hit
        for right, (k, pair) in enumerate(places):
            inside[pair] += 1
            # as short as possible with the same pairs, and within the bound
            while inside[places[left][1]] > 1 or k + 1 - places[left][0] >= longest:
                inside[places[left][1]] -= 1
                if not inside[places[left][1]]:
                    del inside[places[left][1]]
                left += 1
            if len(inside) < need:
                continue
            if best and places[left][0] > places[best[2]][0]:
                found.append((family, best, places))
                best = None
            if not best or len(inside) > best[0]:
                best = (len(inside), left, right)
        if best:
            found.append((family, best, places))
    return [(n, family, {kept[k + j][0] for k, _ in places[left : right + 1] for j in (0, 1)}) for family, (n, left, right), places in found]


def chances_of(model: Model, words: list[str]) -> np.ndarray:
    return _softmax(_scores(model.weights, model.bias, ngrams(words)) / model.temperature)


def notices(model: Model, words: list[str], lines: list[int] | None = None) -> list[tuple[int, str, float]]:
    """Place of the first word, family and probability of every notice in a paragraph."""
    lines = lines or [0] * len(words)
    seen = {}

    def chances(start: int, end: int) -> np.ndarray:
        if (start, end) not in seen:
            seen[start, end] = chances_of(model, words[start:end])
        return seen[start, end]

    sure, like = [], []  # of a known family; of any licence
    for n, family, places in _places(words):
        first, last = min(places), max(places) + 1
        bounds = [(max(first - m, 0), min(last + m, len(words))) for m in MARGINS]
        # also without the lines before and after, which may hold other notices
        start, end = bisect_left(lines, lines[first]), bisect_right(lines, lines[last - 1])
        windows = [chances(*b) for b in {*bounds, (max(start, bounds[-1][0]), min(end, bounds[-1][1]))}]
        best = max((c.max() for c in windows if FAMILIES[c.argmax()] == family), default=0)
        if best >= SURE and family != UNLISTED:
            sure.append((n, float(best), family, places))
        some = max(1 - c[-1] for c in windows)
        if some >= SURE and family != RESERVED and any(map(_GRANTS.match, words[max(first - MARGINS[1], 0) : last + MARGINS[1]])):
            like.append((n, float(some), UNLISTED, places))
    counted, taken = [], defaultdict(set)  # taken: by word, the numbers of the notices that hold it
    for n, chance, family, places in sorted(sure, key=lambda x: (-x[0], -x[1], min(x[3]))):
        # what lies wholly in a larger notice is part of it, and so is what a notice of the same family shares words with
        over = [taken[i] for i in places]
        if not set.intersection(*over) and all(counted[c][1] != family for c in set().union(*over)):
            for i in places:
                taken[i].add(len(counted))
            counted.append((min(places), family, chance))
    for _, chance, family, places in sorted(like, key=lambda x: (-x[0], -x[1], min(x[3]))):
        if not any(taken[i] for i in places):
            for i in places:
                taken[i].add(len(counted))
            counted.append((min(places), family, chance))
    return sorted(counted)


def classify(model: Model, paragraph: str) -> tuple[str, float]:
    """Family (``UNKNOWN`` for prose) and its probability, confirmed by the templates."""
    found = [n for words, lines in paragraphs_of(paragraph) for n in notices(model, words, lines)]
    if found:
        return max(found, key=lambda x: x[2])[1:]
    return UNKNOWN, float(chances_of(model, words_of(paragraph))[-1])


def _chosen(texts: dict, paragraphs: int) -> list[list[str]]:
    """Words of the plain paragraphs with the smallest hashes of document, line and place in it, long ones cut to windows."""
    plain = []
    for doc_id, text in texts.items():
        for number, line in enumerate(text.split("\n")):
            words = words_of(line)
            for start in range(0, len(words), WINDOW):
                part = words[start : start + WINDOW]
                known = any(confirmed(family, part) >= CONFIRMED / 2 for family in TEMPLATES if family != UNLISTED)
                if not known and not _places(part):
                    plain.append((xxhash.xxh3_64_intdigest(f"{doc_id} {number} {start}"), part))
    return [part for _, part in sorted(plain)[:paragraphs]]


def train(docs: DataFrame, sample: int = SAMPLE, longest: int = LONGEST, paragraphs: int = PARAGRAPHS) -> Model:
    """The class of prose also sees paragraphs of the documents with the smallest hashes of their id."""
    # ids first: each task offers its smallest ones, and texts of all these would come to the driver
    sized = docs.where(F.col("doc_id").isNotNull() & (F.char_length("text") <= longest)).select("doc_id")
    ids = [row["doc_id"] for row in sized.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
    chosen = docs.where(F.col("doc_id").isin(ids) & (F.char_length("text") <= longest))
    rows = chosen.groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    return fit(_chosen({row["doc_id"]: row["text"] for row in rows}, paragraphs))


FOUND = "array<struct<paragraph:int,family:string,chance:double>>"


def licence_paragraphs(text: Column, model: Model, handle) -> Column:
    """Licence notices of each text: number of the first line (from 0), family, probability."""

    @pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = handle.value

        def one(text: str) -> list[dict]:
            found = []
            for words, lines in paragraphs_of(text):
                for place, family, chance in notices(model, words, lines):
                    found.append({"paragraph": lines[place], "family": family, "chance": chance})
            return found

        for texts in batches:
            yield texts.map(one)

    return find(F.coalesce(text, F.lit("")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """doc_id and ``found``, the licence paragraphs of every document."""
    model = train(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), **bounds)
    handle = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(doc_id), licence_paragraphs(F.col(text), model, handle).alias("found"))


def report(docs: DataFrame) -> DataFrame:
    """Families (sorted, comma-joined) and places of the notices of every document.

    ``licences`` has the known families, ``other_notices`` the notices that name none (``RESERVED``, ``UNLISTED``).
    """
    others = F.lit(RESERVED), F.lit(UNLISTED)
    families = F.array_sort(F.array_distinct(F.transform("found", lambda p: p["family"])))
    lines = F.array_join(F.transform("found", lambda p: F.concat_ws(":", p["paragraph"], p["family"])), ",")
    return scan(docs).select(
        "doc_id",
        F.array_join(F.filter(families, lambda f: ~f.isin(*others)), ",").alias("licences"),
        F.size("found").cast("bigint").alias("n_paragraphs"),
        lines.alias("paragraphs"),
        F.array_join(F.filter(families, lambda f: f.isin(*others)), ",").alias("other_notices"),
    )
