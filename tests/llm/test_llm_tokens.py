"""BPE and packing against the tokenizers library."""

import random
import string
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from jobtide.llm import bpe, packing

PLAIN = Tokenizer.from_file(bpe.word_tokenizer_file())
SCHEMA = "doc_id BIGINT, text STRING, ids STRING, document STRING"


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(bpe.word_tokenizer_file())


ODD = "'s 'll ' ''' <|endoftext|> <|startoftext|> <| |> é e\u0301 \u0301 \u0344 İ ß ǅ \u1100\u1161\u11a8 \uac00\u11a8 1 23 ... !'s don't 世界 👩‍👩‍👧 \u200d \x00 \x1c \x85 \u00a0 \u3000 a".split(" ")
TEXTS = st.lists(st.sampled_from([*ODD, " ", "\n", "\t", "\r\n", "hello", "WORLD", "Île", "ÉCOLE", "straße,", "end.", "ĲSSEL", "İstanbul", "ŉ", "÷", ".", ",", "aaaaaaaa", "thththth"]), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_kept_words_are_exact(text):
    assert np.frombuffer(next(bpe.encoder(bpe.word_tokenizer_file()).encode_all([text])), bpe.ID).tolist() == ids(text)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 30))
def test_tree_is_exact(text, leaf):
    assert bpe.encode_tree(bpe.encoder(bpe.word_tokenizer_file()), text, leaf) == ids(text)


@pytest.mark.parametrize("letters", ["a", "ab", "the", "é", "abcdefghijklmnopqrstuvwxyz", "ation", "!?", "'s", "ths'"])
def test_tree_on_long_unsplit_text(coder, letters):
    rng = random.Random(5)
    for leaf in (97, 500, 1024):
        text = "".join(rng.choices(letters, k=5000))
        assert bpe.encode_tree(coder, text, leaf) == ids(text)
    text = letters * (6000 // len(letters))
    assert bpe.encode_tree(coder, text, 333) == ids(text)


def test_packed_leaves_return(coder):
    for text in ("Some wörds, don't they? 123 é", "word " * 2000, ""):
        leaf = coder.leaf(text)
        back = bpe._unpacked(bpe._packed(leaf))
        assert all((getattr(back, n) == getattr(leaf, n)).all() for n in ("ids", "head", "tail"))
        assert leaf.ids.tolist() == ids(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=60).map("".join), st.integers(40, 400), st.sampled_from([10, 30]))
def test_tree_with_short_edges(text, leaf, reach):
    """Edges so short that windows often reach beyond what is placed."""
    before = bpe.REACH, bpe.EDGE
    bpe.REACH, bpe.EDGE = reach, 2 * reach
    try:
        assert bpe.encode_tree(bpe.encoder(bpe.word_tokenizer_file()), text, leaf) == ids(text)
    finally:
        bpe.REACH, bpe.EDGE = before


MARKED = st.tuples(
    st.sampled_from("ABCDEFGHIJKLMNOPQRSTUVWXYZaé"), st.lists(st.characters(min_codepoint=0x300, max_codepoint=0x331), max_size=3).map("".join), st.sampled_from(["", " ", "x", "\u0591", "\u0308", "."])
).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(MARKED | st.sampled_from(["word ", "Word", "<|endoftext|>", " "]), max_size=12).map("".join), st.integers(1, 30))
def test_capitals_before_marks(text, leaf):
    made = bpe.encoder(bpe.word_tokenizer_file())
    whole = np.frombuffer(next(made.encode_all([text])), bpe.ID)
    assert whole.tolist() == ids(text) == bpe.encode_tree(made, text, leaf)
    assert made.decode(whole.tobytes()) == PLAIN.decode(ids(text), skip_special_tokens=False)


def test_a_capital_before_a_mark_has_the_same_ids_anywhere(coder):
    for letter in string.ascii_uppercase:
        for mark in map(chr, range(0x300, 0x332)):
            assert np.frombuffer(next(coder.encode_all([letter + mark])), bpe.ID).tolist() == ids(letter + mark)
    for place in (0, 3_600, 12_000, 23_990):
        text = "word " * 4_800
        text = text[:place] + " J\u030c T\u0308 " + text[place:]
        assert bpe.encode_tree(coder, text) == ids(text) == np.frombuffer(next(coder.encode_all([text])), bpe.ID).tolist()


def test_other_forms_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="not cut and normalised"):
        bpe.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts():
    rng = random.Random(9)
    unsplit = "".join(rng.choices("abcdefgh", k=50_000))
    return [None, "", " ", "a", "A b\nC", "same", "same", "<|endoftext|> x", unsplit, "word " * 9000, "é" * 17_000]


def test_encode_and_decode(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "null id", "", ""), (3, "a", "", "")], SCHEMA)
    got = bpe.encode(docs).withColumn("back", bpe.decoded("ids")).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        want = ids("null id" if r.doc_id is None else texts[r.doc_id])
        assert np.frombuffer(r.ids, bpe.ID).tolist() == want
        assert r.back == PLAIN.decode(want, skip_special_tokens=False)
    assert bpe.report(docs.where("false")).count() == 0


@pytest.mark.parametrize("length", [1, 2, 3, 2047, 2048, 2049, 4095, 6000, 123_457])
def test_piece_lengths(spark, length):
    from pyspark.sql import functions as F

    pieces = spark.range(1).select(packing.piece_list(F.lit(length).cast("bigint")).alias("p")).first().p
    at = 0
    for piece in pieces:
        assert piece.start == at and piece.length.bit_count() == 1 and piece.length <= 2048
        at += piece.length
    assert at == length and len(pieces) == length // 2048 + (length % 2048).bit_count()


def test_packing(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA).repartition(5)
    got = packing.report(docs).collect()
    assert len({r.sequence_id for r in got}) == len(got) and {r.offset for r in got} == {0}
    for i, text in enumerate(texts):
        want, at = [*ids(text), 1], 0
        for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(np.array(want[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(want)
    assert packing.report(docs.where("false")).count() == 0


def test_buckets(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a")], "doc_id BIGINT, text STRING")
    packing.write_buckets(packing.pack(docs), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert all(r.length == 2**r.bucket for r in back.collect())
