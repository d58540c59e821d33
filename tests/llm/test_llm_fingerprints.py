"""Fingerprints next to an Order MinHash in plain Python, and the whole report by hand."""

import hashlib
import random
from collections import Counter

import pytest

from jobtide.llm import order_minhash as omh

MASK = 2**64 - 1


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def plain_fingerprint(text):
    """Number the k-mers, take the smallest per sketch, put them back into text order, hash the tuple."""
    width, seen, kmers = min(omh.K, len(text)), Counter(), []
    for i in range(len(text) - width + 1 if text else 0):
        gram = text[i : i + width]
        value = mixed((width + sum((ord(c) + 1) * int(f) for c, f in zip(gram, omh._CHARS))) & MASK)
        if seen[gram]:
            value = mixed((value + seen[gram] * int(omh._AGAIN)) & MASK)
        seen[gram] += 1
        kmers.append(value >> 32)
    out = []
    for s in range(omh.SKETCHES):
        if len(kmers) <= omh.PICKED:
            made = 0
            for value in kmers:
                made = mixed((made * 31 + value + s + 1) & MASK)
            out.append(made >> 32)
            continue
        rank = [((k ^ int(omh._SHIFTS[s])) * int(omh._FACTORS[s])) & 0xFFFFFFFF for k in kmers]
        places = sorted(sorted(range(len(kmers)), key=lambda i: (rank[i], i))[: omh.PICKED])
        made = s + 1
        for at in places:
            made = ((made ^ kmers[at]) * 0x9E3779B97F4A7C15 + 0x7F4A7C15) & MASK
            made ^= made >> 29
        out.append(mixed(made) >> 32)
    return "".join(f"{x:08x}" for x in out)


def agreement(a, b):
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / omh.SKETCHES


def texts():
    rng = random.Random(17)
    made = ["", "a", "1234567", "12345678", "123456789", "1234567890", "a" * 40, "é\U0001f600" * 9, "\x00" * 12]
    made += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 200))) for letters in ("ab", "abc", "abcdefgh ", "aé\U0001f600\n") for _ in range(12)]
    return made + ["".join(rng.choice("ab cd") for _ in range(6000))]


def test_plain_order_min_hash():
    for text in texts():
        assert omh.sketches(text).astype(">u4").tobytes().hex() == plain_fingerprint(text), text[:30]


def test_a_repeat_does_not_change_the_other_kmers():
    rng = random.Random(5)
    text = "".join(map(chr, rng.sample(range(0x4E00, 0x9000), 400)))
    more = text + text[:10]
    assert len(set(omh.numbered_kmers(text))) == len(omh.numbered_kmers(text))
    assert agreement(plain_fingerprint(text), omh.sketches(more).astype(">u4").tobytes().hex()) > 0.8
    turned = text[200:] + text[:200]
    assert agreement(plain_fingerprint(text), plain_fingerprint(turned)) < 0.7  # the same k-mers in another order


@pytest.mark.parametrize("clashing", [False, True])
def test_report_by_hand(spark, clashing):
    """Every column from the definition, with null texts, one very long text and extra columns of the names used inside."""
    rng = random.Random(29)
    rows = [(i * 3, None if i % 11 == 5 else t) for i, t in enumerate(texts())] + [(100_000, "lorem ipsum " * 20_000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, True, "x") for r in rows], "doc_id BIGINT, text STRING, range INT, copy BOOLEAN, fingerprint STRING")
    if not clashing:
        docs = docs.select("doc_id", "text")
    got = {r.doc_id: r for r in omh.report(docs).collect()}
    order = sorted((i, t or "") for i, t in rows)
    prints = {t: (plain_fingerprint(t) if len(t) < 10_000 else omh.sketches(t).astype(">u4").tobytes().hex()) for _, t in order}
    assert len(got) == len(rows)
    for place, (doc_id, text) in enumerate(order):
        following = order[(place + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = got[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row.fingerprint == prints[text]
        if len(edited) < 10_000:
            assert row.edited_fingerprint == plain_fingerprint(edited)
        assert row.near_edited == pytest.approx(agreement(row.fingerprint, row.edited_fingerprint))
        assert row.near_next == pytest.approx(agreement(prints[text], prints[following]))
