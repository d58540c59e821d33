"""Language-model scores from log-frequency Bloom filters.

**Filters.** For each order (one to three words) Bloom filters hold all n-grams of the training texts with their
quantised counts: an n-gram of level q is entered with each of the numbers 1 to q, and its level is read by probing 1, 2, … until
one is not held.  Levels rise by half of the count each time; a probe errs only upwards.  Whatever the size of the corpus,
no n-gram is left out, unless ``one_in`` asks for those only that make up one in so many training tokens.

**Shards.** The n-grams of an order are dealt out by their hashes, one shard for every ``SHARD`` training tokens, and each
shard has a filter of its own, 12 bits an entry, so a filter has the same size at any size of the corpus and none passes the driver.
Texts are taken in chunks.  A chunk asks each shard for its different n-grams, by 32 bits of their hashes, with how often
training texts of the chunk have them; the shard adds these up, makes its filter, probes it and sends the levels back to the chunk.

**Probabilities** are interpolated.  For a context h of level q the probability of w is
``share[q] * count(h w) / count(h) + rest[q] * P(w | shorter h)``, a context that is not held is passed over, and the
lowest order is interpolated with the even distribution over all words and an unknown one.  share and rest are Witten-Bell
weights, taken over all contexts of a level, with the weight of n-grams that are not held left to the rest.
All counts of a score come from probes.

**Base score.** It needs the exact count of each word.  The ``COMMON`` most frequent short words are broadcast
(8 MB at most); all others meet their counts in a join of (text, word) pairs.

A text's tokens are its words and one end.  The end of the text before stands in front of the first word, so the
beginning is a context, too; no n-gram reaches over it.

Results for odd input: a null or empty text is only an end; a null id has no remainder, its text is for training;
repeated rows count and are scored each; an empty table gives an empty table; without training texts every
count is 0; extra columns of any name are not looked at.  A very long text is one unit of work of its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from jobtide.llm.tables import Scratch, arrow_rows, shuffles_freed
from jobtide.llm.words import Words, chunks, mixed, split_words, word_hashes

ORDER = 3
SHARD = 2_000_000  # training tokens whose n-grams of an order meet in one filter
STEP = 1.5  # between the counts of levels
BITS, PROBES = 12, 4  # of an entry
CHUNK, ROWS = 4_000_000, 4_000  # bytes of text held as arrays together, texts handed over together
COMMON, SHORT = 1 << 17, 64  # words, bytes
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
END = " "  # no word
_KIND = np.uint64(0xFF)  # bits below the hash of an n-gram
_OWNED = 0x80  # beside the level: of all chunks with this n-gram, this one counts it
_END_HASH = word_hashes(pa.array([END]))[0] & ~_KIND
_NEXT = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = np.uint64(0xD1B54A32D192ED03)
_BLOCK = 4096  # bytes, as Spark's bitmap functions have it
HELD_OUT_OF, HELD_OUT = 5, 1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def lowest_counts(least: int) -> np.ndarray:
    """The lowest count of each level from 1 on."""
    counts, bound = [], float(least)
    while bound < 2**62:
        counts.append(int(np.ceil(bound)))
        bound *= STEP
    return np.array(counts, np.int64)


def middle_counts(least: int) -> np.ndarray:
    """The count that stands for each level from 0 on."""
    low = lowest_counts(least).astype(np.float64)
    return np.concatenate(([0.0], (low + np.append(low[1:] - 1, low[-1])) / 2))


class Filter(NamedTuple):
    bits: np.ndarray  # bytes

    def holds(self, keys: np.ndarray) -> np.ndarray:
        held, alive = np.zeros(len(keys), bool), np.arange(len(keys))
        first, step = _spread(keys)
        for _ in range(PROBES):
            bit = _place(first, 8 * len(self.bits))
            hit = (self.bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            alive, step = alive[hit], step[hit]
            first = first[hit] + step
        held[alive] = True
        return held

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Level of each n-gram, by repeated probes."""
        level = np.zeros(len(grams), np.int8)
        alive, at = np.arange(len(grams)), 0
        while len(alive):
            at += 1
            alive = alive[self.holds(grams[alive] + np.array([at], np.uint64) * _LEVEL)]
            level[alive] = at
        return level


def _place(first: np.ndarray, size: int) -> np.ndarray:
    """Bit of a filter for a number, of which 32 bits count: no division."""
    return (first & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)


def _spread(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bit of each key, and how far each further one lies behind the one before (both modulo 32 bits)."""
    spread = mixed(keys)
    return spread >> np.uint64(32), (spread & np.uint64(0xFFFFFFFF)) | np.uint64(1)


class Sizes(NamedTuple):
    """What the counts of words say of the training texts."""

    least: int  # count of an n-gram that is held
    tokens: int
    kinds: int
    even: int  # weight of the even distribution, in tokens
    whole: int  # that and the tokens of words that are held

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.kinds + 1)))


class Model(NamedTuple):
    """All that scoring needs; only the filters grow with the corpus, and they stay in a table."""

    filters: DataFrame  # shard, levels: the bits of its filter
    shards: int  # of an order
    sizes: Sizes
    weights: list[tuple[np.ndarray, np.ndarray]]  # share and rest by level of the context, from order 2 on
    own: tuple[DataFrame, DataFrame]  # the table that was trained on, and its texts with their levels


class Tokens:
    """The tokens of some texts in one row, an end behind each text, and their n-grams."""

    def __init__(self, words: Words, texts: int):
        places = np.arange(1, len(words.codes) + 1) + words.text  # behind the end before the first text
        self.is_end = np.ones(len(words.codes) + texts + 1, bool)
        self.is_end[places] = False
        self.words = places - 1
        self.text = np.empty(len(self.is_end) - 1, np.int64)  # of each token
        self.text[self.words] = words.text
        self.text[self.is_end[1:]] = np.arange(texts)
        self.different = np.append(word_hashes(words.different) & ~_KIND, _END_HASH)
        self.which = np.full(len(self.is_end), len(words.different))  # word or end
        self.which[places] = words.codes
        self.hashes = self.different[self.which]

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each order: the tokens that end an n-gram, which one it is, and the different n-grams."""
        grams, whole = self.hashes, np.ones(len(self.text), bool)
        yield np.arange(len(self.text)), self.which[1:], self.different
        for size in range(2, order + 1):
            grams = np.append(grams[:1], mixed(grams[:-1] * _NEXT + self.hashes[1:] + np.uint64(size)) & ~_KIND)
            if size > 2:  # no n-gram reaches over an end; higher orders inherit this from the n-gram inside
                whole = np.append(False, whole[:-1]) & ~self.is_end[:-1]
            at = np.flatnonzero(whole)
            yield at, *pd.factorize(grams[1:][at])


def _dealt(grams: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of n-grams by shard, the shards that have any, and where each of these begins (and the last one ends)."""
    shard = ((grams >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.min_scalar_type(shards))
    order = np.argsort(shard, kind="stable")
    ordered = shard[order].astype(np.int32)
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(grams)])
    return order, ordered[starts], np.append(starts, len(grams))


def _split(texts: pa.Array) -> Words:
    return split_words(texts, BLANKS)


def _batches(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[pa.Array]:
    for batch in batches:
        yield from chunks(batch.column(column), CHUNK)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all tokens; the end is a blank."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _batches(batches):
            words = _split(some)
            rows = np.bincount(words.codes, minlength=len(words.different))
            kinds = pa.concat_arrays([words.different, pa.array([END])])
            yield pa.RecordBatch.from_arrays([kinds, pa.array(np.append(rows, len(some)), pa.int64())], ["word", "n"])

    return texts.mapInArrow(counted, "word STRING, n BIGINT").groupBy("word").agg(F.sum("n").alias("n"))


def _enter(bits: np.ndarray, grams: np.ndarray, level: np.ndarray) -> None:
    """Enter each n-gram with the numbers up to its level; each bit is a byte while a filter is made."""
    at = np.arange(1, level.sum() + 1) - np.repeat(np.cumsum(level) - level, level)
    first, step = _spread(np.repeat(grams, level) + at.astype(np.uint64) * _LEVEL)
    for probe in range(PROBES):
        bits[_place(first + np.uint64(probe) * step, len(bits))] = True


def _build(held: DataFrame, entries: int) -> Filter:
    """One filter of a table of n-grams with their levels; its parts are made in tasks and put together by their blocks."""
    blocks = max(1, -(-entries * BITS // (8 * _BLOCK)))
    size = blocks * _BLOCK * 8

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, bool)
        for batch in batches:
            grams = batch.column(0).to_numpy().view(np.uint64) & ~_KIND
            level = batch.column(1).to_numpy()
            _enter(bits, grams, level)
        parts = np.packbits(bits, bitorder="little").reshape(-1, _BLOCK)
        for block in np.flatnonzero(parts.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([parts[block].tobytes()])], ["block", "bits"])

    parts = held.select("gram", "level").mapInArrow(entered, "block BIGINT, bits BINARY")
    bits = np.zeros(size // 8, np.uint8)
    for block, part in parts.groupBy("block").agg(F.bitmap_or_agg("bits")).toLocalIterator():
        bits[block * _BLOCK : (block + 1) * _BLOCK] = np.frombuffer(part, np.uint8)
    return Filter(bits)


_ASKED = "shard INT, chunk BIGINT, place BIGINT, keys BINARY, n BINARY"
_ANSWERS = "shard INT, chunk BIGINT, place BIGINT, levels BINARY"


def _chunked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, held_out, text, the chunk a text is in and its place in there."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = [*rows.columns, "chunk", "place"]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            done = 0
            for some in chunks(batch.column(2), CHUNK):
                places = np.arange(len(some))
                columns = [column.slice(done, len(some)) for column in batch.columns]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(some), chunk)), pa.array(places)], names)
                done, chunk = done + len(some), chunk + 1

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(numbered, f"doc_id {kind}, held_out BOOLEAN, text STRING, chunk BIGINT, place BIGINT")


def _asked(texts: DataFrame, shards: int, order: int) -> DataFrame:
    """What each chunk asks the shards: keys of its different n-grams, with how often training texts have them.

    A chunk that a task meets in parts asks for each part, by the place of its first text.
    """

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunk, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for begin, end in zip(bounds, bounds[1:]):
                if end == begin:
                    continue
                trained = ~batch.column(2).slice(begin, end - begin).to_numpy(zero_copy_only=False)
                tokens = Tokens(_split(batch.column(3).slice(begin, end - begin).cast(pa.string())), end - begin)
                for size, (at, which, grams) in enumerate(tokens.grams(order)):
                    n = np.bincount(which, weights=trained[tokens.text[at]], minlength=len(grams)).astype(np.int32)
                    ordered, have, starts = _dealt(grams, shards)
                    keys, n = (grams[ordered] >> np.uint64(8)).astype(np.uint32), n[ordered]
                    columns = [
                        pa.array(have + size * shards, pa.int32()),
                        pa.repeat(pa.scalar(int(chunk[begin]), pa.int64()), len(have)),
                        pa.repeat(pa.scalar(int(place[begin]), pa.int64()), len(have)),
                        *[pa.array([some[i:j].tobytes() for i, j in zip(starts, starts[1:])], pa.binary()) for some in (keys, n)],
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "chunk", "place", "keys", "n"])

    return texts.select("chunk", "place", "held_out", "text").mapInArrow(asked, _ASKED)


def _numbers(blobs: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(blobs.to_pylist()), kind)


def _answer(asked: pa.Table, levels: np.ndarray) -> list[bytes]:
    ends = np.cumsum(pc.binary_length(asked["keys"]).to_numpy() // 4)
    return [levels[i:j].tobytes() for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _trained(asked: DataFrame, least: int) -> DataFrame:
    """Each shard's filter (without chunk) and its answers.

    Of the training chunks that have an n-gram that is held, the first one met is told that it counts it.
    """
    bounds, bits = lowest_counts(least), BITS

    def trained(some: pa.Table) -> pa.Table:
        n = _numbers(some["n"], np.int32)
        which, keys = pd.factorize(_numbers(some["keys"], np.uint32))
        level = np.searchsorted(bounds, np.bincount(which, weights=n, minlength=len(keys)).astype(np.int64), side="right")
        keys, held = keys.astype(np.uint64), level > 0
        entered = np.zeros(8 * max(8, -(-int(level.sum()) * bits // 8)), bool)
        _enter(entered, keys[held], level[held])
        made = Filter(np.packbits(entered, bitorder="little"))
        levels = made.levels(keys).view(np.uint8)[which]
        owners = np.flatnonzero((n > 0) & held[which])
        owners = owners[~pd.Series(which[owners]).duplicated().to_numpy()]
        levels[owners] |= _OWNED
        shard = some["shard"][0]
        return pa.table(
            {
                "shard": pa.repeat(shard, len(some) + 1),
                "chunk": pa.concat_arrays([*some["chunk"].chunks, pa.array([None], pa.int64())]),
                "place": pa.concat_arrays([*some["place"].chunks, pa.array([None], pa.int64())]),
                "levels": pa.array([*_answer(some, levels), made.bits.tobytes()], pa.binary()),
            }
        )

    return asked.groupBy("shard").applyInArrow(trained, _ANSWERS)


def _probed(asked: DataFrame, filters: DataFrame) -> DataFrame:
    """Answers for texts from the filters of a model."""

    def probed(some: pa.Table, bits: pa.Table) -> pa.Table:
        which, keys = pd.factorize(_numbers(some["keys"], np.uint32))
        levels = np.zeros(len(keys), np.int8)
        if len(bits):
            levels = Filter(np.frombuffer(bits["levels"][0].as_py(), np.uint8)).levels(keys.astype(np.uint64))
        made = pa.array(_answer(some, levels[which]) if len(some) else [], pa.binary())
        return pa.table({"shard": some["shard"], "chunk": some["chunk"], "place": some["place"], "levels": made})

    return asked.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(probed, _ANSWERS)


def _told(tokens: Tokens, trained: np.ndarray, answers: dict[int, bytes], shards: int, order: int) -> list[np.ndarray]:
    """For each order the level of the n-gram that ends at each token, from the answers of the shards.

    An n-gram that this chunk counts is marked at the first of its tokens in training texts.
    """
    told = []
    for size, (at, which, grams) in enumerate(tokens.grams(order)):
        level, (ordered, have, starts) = np.zeros(len(grams), np.uint8), _dealt(grams, shards)
        for shard, i, j in zip(have.tolist(), starts, starts[1:]):
            level[ordered[i:j]] = np.frombuffer(answers[shard + size * shards], np.uint8)
        told.append(np.zeros(len(tokens.text), np.uint8))
        told[-1][at] = level[which] & ~np.uint8(_OWNED)
        owned = np.flatnonzero((level[which] >= _OWNED) & trained[tokens.text[at]])
        told[-1][at[owned[~pd.Series(which[owned]).duplicated().to_numpy()]]] |= _OWNED
    return told


def _looked_up(texts: DataFrame, answers: DataFrame, shards: int, sizes: Sizes, counts: DataFrame, order: int) -> DataFrame:
    """One row per text: its part of the base score, its words that are not common, and the levels of its n-grams, order by order."""
    common = common_words(counts, sizes)
    shared = texts.sparkSession.sparkContext.broadcast(common)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "others", "times", "levels"]
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, others ARRAY<STRING>, times ARRAY<INT>, levels BINARY"

    def looked_up(some: pa.Table, answers: pa.Table) -> pa.Table:
        some = some.sort_by("place").combine_chunks()
        by_part: dict[int, dict[int, bytes]] = {}
        for shard, place, levels in zip(*(answers[c].to_pylist() for c in ("shard", "place", "levels"))):
            by_part.setdefault(place, {})[shard] = levels
        begins = sorted(by_part)
        bounds = [*np.searchsorted(some["place"].to_numpy(), begins).tolist(), len(some)]
        parts = []
        for place, begin, end in zip(begins, bounds, bounds[1:]):
            part = some.slice(begin, end - begin).combine_chunks()
            words = _split(part["text"].chunk(0).cast(pa.string()))
            tokens = Tokens(words, end - begin)
            base = _base_parts(words, tokens, sizes, shared.value)
            trained = ~part["held_out"].to_numpy()
            told = np.concatenate(_told(tokens, trained, by_part[place], shards, order))
            texts_of = np.tile(tokens.text, order)
            told = told[np.argsort(texts_of, kind="stable")]
            ends = np.append(0, np.cumsum(base[0].to_numpy() * order))
            blobs = [told[i:j].tobytes() for i, j in zip(ends, ends[1:])]
            parts.append(pa.table([part["doc_id"], part["held_out"], *base, pa.array(blobs, pa.binary())], names))
        return pa.concat_tables(parts)

    return texts.groupBy("chunk").cogroup(answers.where("chunk is not null").groupBy("chunk")).applyInArrow(looked_up, schema)


class _Levels:
    """Levels of the n-grams that end at each token of some texts, and of their contexts."""

    def __init__(self, n_tokens: np.ndarray, blobs: pa.Array, order: int):
        data = np.frombuffer(b"".join(blobs.to_pylist()), np.uint8)
        ends = np.cumsum(n_tokens)
        first = ends - n_tokens
        self.text = np.repeat(np.arange(len(n_tokens)), n_tokens)
        own = [data[np.arange(len(self.text)) + np.repeat((order - 1) * first + size * n_tokens, n_tokens)] for size in range(order)]
        self.levels, self.owned = [one & ~np.uint8(_OWNED) for one in own], [one >= _OWNED for one in own]
        self.contexts = []
        for size, level in enumerate(self.levels[:-1]):
            context = np.append(np.uint8(0), level[:-1])[: len(level)]
            context[first] = level[ends - 1] if size == 0 else 0  # the end before a text is like its own
            self.contexts.append(context)


def _weights(looked: DataFrame, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """share and rest for each level of a context, from order 2 on: one row per level reaches the driver."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((order - 1, 3, 128), np.int64)
        for batch in batches:
            rows = _Levels(batch.column(0).to_numpy(), batch.column(1), order)
            for at, context in enumerate(rows.contexts):
                for kind, chosen in enumerate((slice(None), rows.levels[at + 1] > 0, rows.owned[at + 1])):
                    sums[at, kind] += np.bincount(context[chosen], minlength=128)
        size, level = np.nonzero(sums[:, 0])
        columns = [pa.array(size.astype(np.int32)), pa.array(level.astype(np.int32)), *[pa.array(sums[size, kind, level]) for kind in range(3)]]
        yield pa.RecordBatch.from_arrays(columns, ["size", "level", "n", "followed", "kinds"])

    made = looked.where("not held_out").select("n_tokens", "levels").mapInArrow(summed, "size INT, level INT, n BIGINT, followed BIGINT, kinds BIGINT")
    weights = [(np.zeros(128), np.ones(128)) for _ in range(order - 1)]
    for size, level, n, followed, kinds in made.groupBy("size", "level").agg(F.sum("n"), F.sum("followed"), F.sum("kinds")).collect():
        share, rest = weights[size]
        share[level] = n / (n + kinds)
        rest[level] = max(0, n - followed + kinds) / (n + kinds)
    return weights


def train(docs: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, one_in: int | None = None) -> tuple[Model, DataFrame]:
    """The model of the training texts, and their exact word counts (word, n)."""
    counts = scratch.store(word_counts(docs.where(~held_out(F.col(doc_id))).select(F.col(text).alias("text"))), "words")
    tokens, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = max(1, -(-tokens // one_in)) if one_in else 1
    sum_held, rows = counts.where(F.col("n") >= least).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    sizes = Sizes(least, tokens, kinds, tokens - sum_held + rows, tokens + rows)
    shards = max(1, -(-tokens // SHARD))
    texts = scratch.store(_chunked(docs, doc_id, text), "texts")
    answers = scratch.store(_trained(_asked(texts, shards, order), least), "levels")
    looked = scratch.store(_looked_up(texts, answers, shards, sizes, counts, order), "looked-up")
    filters = answers.where("chunk is null").select("shard", "levels")
    return Model(filters, shards, sizes, _weights(looked, order), (docs, looked)), counts


def token_scores(rows: _Levels, model: Model) -> np.ndarray:
    """log10 of the probability of each token, given the ones before it in its text."""
    sizes = model.sizes
    middle = middle_counts(sizes.least)
    if sizes.whole:
        likely = (middle[rows.levels[0]] + sizes.even / (sizes.kinds + 1)) / sizes.whole
    else:  # without training tokens all words are alike
        likely = np.full(len(rows.text), 1 / (sizes.kinds + 1))
    likely = np.minimum(likely, 1.0)
    for context, level, (share, rest) in zip(rows.contexts, rows.levels[1:], model.weights):
        count = middle[context]
        seen = np.minimum(middle[level], count) / np.maximum(count, 1)
        likely = np.where(context > 0, share[context] * seen + rest[context] * likely, likely)
    return np.log10(likely)


def common_words(counts: DataFrame, sizes: Sizes) -> pa.Table:
    """Counts of the end, which comes first, and of frequent words: ``COMMON`` short words at most; which ones does not matter for results."""
    found = {END: 0} | dict(counts.where(F.col("word") == END).collect())
    share = 1 - COMMON / max(COMMON, sizes.kinds, 1)
    least = counts.agg(F.percentile_approx("n", share)).first()[0]
    frequent = counts.where((F.col("n") > (least or 0)) & (F.octet_length("word") <= SHORT)) if share else counts.where(F.octet_length("word") <= SHORT)
    found |= dict(frequent.limit(COMMON).collect())
    return pa.table({"word": pa.array(list(found)), "n": pa.array(list(found.values()), pa.int64())})


def _base_parts(words: Words, tokens: Tokens, sizes: Sizes, common: pa.Table) -> list[pa.Array]:
    """n_tokens, n_known, base_score of each text as far as its words are common, its other words, and how often it has them."""
    count = int(tokens.is_end.sum()) - 1
    common_n = common["n"].to_numpy()
    place = pc.index_in(words.different, common["word"].chunk(0)).fill_null(-1).to_numpy()
    n, end_n = np.append(common_n, -1)[place], common_n[0]  # -1: its count is not known here
    # each different word's part of the sums, then that of the end
    base = sizes.base(np.append(n.clip(min=0), end_n))
    base[:-1][n < 0] = 0.0
    known = np.append(n > 0, end_n > 0)
    token = np.full(len(tokens.text), len(n))
    token[tokens.words] = words.codes
    other = np.flatnonzero(n[words.codes] < 0)
    pairs, times = np.unique(words.text[other].astype(np.int64) * len(n) + words.codes[other], return_counts=True)
    owner, code = np.divmod(pairs, max(1, len(n)))
    ends = pa.array(np.searchsorted(owner, np.arange(count + 1)), pa.int32())

    def summed(values: np.ndarray) -> np.ndarray:
        return np.bincount(tokens.text, weights=values, minlength=count)

    return [
        pa.array(np.bincount(tokens.text, minlength=count), pa.int64()),
        pa.array(summed(known[token]).astype(np.int64)),
        pa.array(summed(base[token])),
        pa.ListArray.from_arrays(ends, words.different.take(pa.array(code))),
        pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())),
    ]


def score(docs: DataFrame, model: Model, counts: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    sizes, weights, order = model.sizes, model.weights, len(model.weights) + 1
    trained_on, looked = model.own
    if docs is not trained_on:
        texts = scratch.store(_chunked(docs, doc_id, text), "texts")
        answers = scratch.store(_probed(_asked(texts, model.shards, order), model.filters), "levels")
        looked = scratch.store(_looked_up(texts, answers, model.shards, sizes, counts, order), "looked-up")
    scorer = Model(None, model.shards, sizes, weights, None)
    names = [*[c for c in looked.columns if c != "levels"], "score"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _Levels(batch.column("n_tokens").to_numpy(), batch.column("levels"), order)
            sums = np.bincount(rows.text, weights=token_scores(rows, scorer), minlength=len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums)], names)

    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in looked.schema if f.name != "levels"], "score DOUBLE"])
    made = scratch.store(looked.mapInArrow(scored, schema).withColumn("row", F.monotonically_increasing_id()), "scores")

    # exact counts of the words that were not broadcast
    pairs = made.select("row", F.explode(F.arrays_zip("others", "times")).alias("one")).select("row", F.col("one.others").alias("word"), "one.times")
    found = pairs.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    base = F.log10((F.col("n") + 0.5) / F.lit(sizes.tokens + 0.5 * (sizes.kinds + 1)))
    rest = found.groupBy("row").agg(F.sum(F.col("times") * base).alias("rest"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("known"))
    return made.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(sizes.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        "score",
    )


def report(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    scratch = Scratch(spark, "bloom-lm")
    with arrow_rows(spark, ROWS), shuffles_freed(spark):
        model, counts = train(docs, scratch)
        return score(docs, model, counts, scratch)
