"""BPE encoding and decoding of whole texts with a public tokenizer file of one form.

The file has to normalise by NFC, blanks and lower case and to cut words as ``word_bpe_49k.json`` does; others are refused.

**Short texts** are cut at ASCII blanks (which no token, no normalisation and no merge of these
files crosses) and each word's ids are kept per process, so words met again cost one look-up.  ASCII letters
are lowered before, but for words with a capital before a mark: normalisation may join these two first.

**Long texts** are encoded by tree concatenation.  The text is cut into leaves of ``LEAF`` code
points without regard to words; the leaves are encoded in parallel tasks and joined pairwise, as a
tree.  At each join a window around the cut is encoded on its own and grows until it shares a token
(same id, same start, same end) with the left side before the cut and with the right side after it.
The tokens between the shared ones are taken from the window, the others stay.  This is exact: all
pairs of neighbouring tokens then come from an encoding of the text around them, and BPE pieces are
fixed by their neighbouring pairs.  A shared token must not touch a combining character, so
normalisation cannot reach over it.  Where no agreement is found the window is both sides.

Results for odd input: null or empty text has no ids and decodes to the empty text; repeated rows
and null ids are encoded each; extra columns of any name are not looked at.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from jobtide.llm.words import split_words

LEAF = 16384
WINDOW = 64
REACH = 1024  # characters at both ends of a leaf whose tokens are placed
EDGE = 4096  # places kept at both ends of a joined stretch
KEPT_WORDS = 900_000  # some 170 MB
KEPT_MARKS = 10_000
PORTION = 3_000_000  # characters whose words are looked up together
LONGEST_KEPT = 64  # bytes
ASCII_BLANKS = bytes([0x20, *range(0x09, 0x0E)])
ID = np.dtype("<u4")


def word_tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# how files of this form show their normaliser and the cut into words (fixed values)
_FORM = (
    'Sequence(normalizers=[NFC(), Replace(pattern=Regex("\\s+"), content=" "), Lowercase()])',
    'Sequence(pretokenizers=[Split(pattern=Regex("\'s|\'t|\'re|\'ve|\'m|\'ll|\'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"), behavior=Removed, invert=True), ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])',
)

# a line: lower-case Latin letters (one token group, in normal form already) and marks after them
# (one more group), or anything else
# normalisation joins a capital and the marks behind it before letters are lowered; marks begin at U+0300
_CAPITAL_BEFORE_MARK = re.compile(rb"[A-Z][\xcc-\xf4]")
_KEEPS_CASE = re.compile("<\\||[A-Z][\u0300-\U0010ffff]")
_PARTS = re.compile(r"^(?:([a-zß-öø-ɏ]+)([!-/:-@\[-`{-~]*)|(.+))$", re.MULTILINE)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class Encoder:
    """A tokenizer with the ids of known words, as bytes (little-endian, 32 bits each).

    Words of plain letters go straight to the merges; all others take the whole way.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        form = str(self.tokenizer.normalizer), str(self.tokenizer.pre_tokenizer)
        if form != _FORM:
            raise ValueError(f"words are not cut and normalised here as in {file}: {form}")
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = Tokenizer(self.tokenizer.model)
        self.letters = _byte_letters()
        self.known: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.pieces = {number: piece for piece, number in self.tokenizer.get_vocab(with_added_tokens=True).items()}

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        known, learned, lowered = self.known, {}, b"\n".join(words).decode().lower()
        composed, other, new = [], [], {}
        for word, (core, marks, rest) in zip(words, _PARTS.findall(lowered), strict=True):
            if rest or (marks and b"<|" in word):
                other.append(word)
                continue
            key = core.encode()
            if key != word:
                composed.append((word, key, marks))
            if key in known:
                learned[key] = known[key]
            elif key not in new:
                new[key] = core if len(core) == len(key) else "".join(map(self.letters.__getitem__, key))
        for key, one in zip(new, self.merges.encode_batch_fast(list(new.values()), add_special_tokens=False), strict=True):
            learned[key] = array("I", one.ids).tobytes()
        for word, key, marks in composed:
            learned[word] = learned[key] + (self.marks.get(marks) or self._marks(marks))
        coded = self.tokenizer.encode_batch_fast([word.decode() for word in other], add_special_tokens=False)
        learned.update([(word, array("I", one.ids).tobytes()) for word, one in zip(other, coded, strict=True)])
        return learned

    def _marks(self, marks: str) -> bytes:
        ids = array("I", self.tokenizer.encode(marks, add_special_tokens=False).ids).tobytes()
        if len(self.marks) < KEPT_MARKS:
            self.marks[marks] = ids
        return ids

    def _known(self, words: list[bytes]) -> list[bytes]:
        """Ids of different words."""
        found = list(map(self.known.get, words))
        new = [word for word, ids in zip(words, found) if ids is None]
        if new:
            learned = self._learn(new)
            found = [learned[word] if ids is None else ids for word, ids in zip(words, found)]
            if len(self.known) > KEPT_WORDS:
                self.known.clear()
            self.known.update(learned if max(map(len, new)) <= LONGEST_KEPT else {w: ids for w, ids in learned.items() if len(w) <= LONGEST_KEPT})
        return found

    def _portion(self, texts: list[str]) -> list[bytes]:
        """Ids of texts all of whose ASCII letters may be lowered at once."""
        words = split_words(pa.array(texts, pa.string()), ASCII_BLANKS)
        found = self._known(words.different.cast(pa.binary()).to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // ID.itemsize
        starts, every = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), ID)
        # the ids of each word of the texts, one after the other
        size = sizes[words.codes]
        ends = np.cumsum(size)
        ids = every[np.repeat(starts[words.codes] - (ends - size), size) + np.arange(size.sum())].tobytes()
        last = np.searchsorted(words.text, np.arange(len(texts)), side="right")
        bounds = [0, *(np.append(0, ends)[last] * ID.itemsize).tolist()]
        return [ids[i:j] for i, j in zip(bounds, bounds[1:])]

    def _word_by_word(self, text: str) -> bytes:
        """Ids of a text with words that must keep their case until they are normalised, or whose case tells a special token."""
        words = [one if b"<|" in one or _CAPITAL_BEFORE_MARK.search(one) else one.lower() for one in text.encode().split()]
        different = list(set(words))
        ids = dict(zip(different, self._known(different)))
        return b"".join(map(ids.__getitem__, words))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text; the unknown words of a few texts are learned together."""
        for some in _portions(texts):
            # millions of small objects without cycles: the collector would only walk over them
            gc.disable()
            try:
                odd = [bool(_KEEPS_CASE.search(text)) for text in some]
                plain = iter(self._portion([text for text, is_odd in zip(some, odd) if not is_odd]))
                coded = [self._word_by_word(text) if is_odd else next(plain) for text, is_odd in zip(some, odd)]
            finally:
                gc.enable()
            yield from coded

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, ID).tolist()
        if self.tokenizer.decoder is None:
            # the library then joins the tokens with blanks
            return " ".join(map(self.pieces.__getitem__, numbers))
        return self.tokenizer.decode(numbers, skip_special_tokens=False)

    def leaf(self, text: str) -> "Leaf":
        """Ids of a text, with the places of the tokens near its ends.

        Cut at a blank, the parts of a text have the same tokens as the whole; the inner part goes by the words.
        """
        begin = max((text.find(blank, REACH) for blank in " \n"), default=-1)
        end = max(text.rfind(blank, 0, len(text) - REACH) for blank in " \n") if len(text) > REACH else -1
        if begin < 0 or end <= begin:
            tokens = self.tokens(text)
            return Leaf(tokens[:, 0].astype(ID), tokens, tokens)
        head, tail = self.tokens(text[:begin]), self.tokens(text[end:], end)
        inner = np.frombuffer(next(self.encode_all([text[begin:end]])), ID)
        return Leaf(np.concatenate((head[:, 0].astype(ID), inner, tail[:, 0].astype(ID))), head, tail)

    def tokens(self, text: str, at: int = 0) -> np.ndarray:
        """Ids with the start and end of each token in the text: an array of three columns."""
        coded = self.tokenizer.encode(text, add_special_tokens=False)
        made = np.empty((len(coded.ids), 3), np.int64)
        made[:, 0] = coded.ids
        if len(made):
            made[:, 1:] = coded.offsets
            made[:, 1:] += at
        return made


def _portions(texts: Iterable[str]) -> Iterator[list[str]]:
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= PORTION:
            yield some
            some, size = [], 0
    if some:
        yield some


@lru_cache(maxsize=4)
def encoder(file: str) -> Encoder:
    return Encoder(file)


def _steady(text: str, at: int) -> bool:
    """No normalisation reaches over this place: the character there begins a new one."""
    if at >= len(text):
        return True
    point = ord(text[at])
    return point < 0x300 or (unicodedata.category(text[at])[0] in "LNPSZ" and not 0x1160 <= point <= 0x11FF and not 0xD7B0 <= point <= 0xD7FF)


class Leaf:
    """Ids of a stretch of text, and the places of its first and last tokens (rows of id, start, end)."""

    def __init__(self, ids: np.ndarray, head: np.ndarray, tail: np.ndarray):
        self.ids, self.head, self.tail = ids, head, tail

    def moved(self, by: int) -> "Leaf":
        shift = np.array([0, by, by])
        return Leaf(self.ids, self.head + shift, self.tail + shift)


def _shared(text: str, side: np.ndarray, window: np.ndarray, low: int, high: int, last: bool) -> tuple[int, int] | None:
    """Places (in side, in window) of one token that both have strictly inside low..high.

    ``last`` takes the one nearest to the end of that range, else the nearest to its start.
    """
    a = np.flatnonzero((side[:, 1] > low) & (side[:, 2] < high))
    b = np.flatnonzero((window[:, 1] > low) & (window[:, 2] < high))
    places = {tuple(window[j]): j for j in b}
    for i in a[::-1] if last else a:
        token = tuple(side[i])
        if token not in places or not (_steady(text, token[1]) and _steady(text, token[2])):
            continue
        j = places[token]
        ends = all(
            (k == 0 or t[k - 1, 2] <= token[1]) and (k + 1 == len(t) or t[k + 1, 1] >= token[2]) for t, k in ((side, i), (window, j))
        )
        if ends:
            return i, j
    return None


def join(coder: Encoder, text: str, left: Leaf, right: Leaf, low: int, cut: int, high: int) -> Leaf:
    """Tokens of ``text[low:high]`` from those of its parts before and after ``cut``."""
    reach = WINDOW
    while True:
        begin, end = max(low, cut - reach), min(high, cut + reach)
        window = coder.tokens(text[begin:end], begin)
        if begin == low:
            kept, first = 0, 0
        elif found := _shared(text, left.tail, window, begin, cut, True):
            kept, first = len(left.ids) - len(left.tail) + found[0], found[1]
        else:
            first = None
        if end == high:
            dropped, second = len(right.ids), len(window)
        elif found := _shared(text, right.head, window, cut, end, False):
            dropped, second = found
        else:
            second = None
        if first is not None and second is not None:
            break
        reach *= 2
    middle = window[first:second]
    ids = np.concatenate((left.ids[:kept], middle[:, 0].astype(ID), right.ids[dropped:]))
    # places known at both ends of the result; those of a whole side are known only if it is short
    head = left.head[:kept]
    if kept <= len(left.head):
        head = np.concatenate((head, middle, right.head[dropped:]))[:EDGE]
    tail = right.tail[max(0, dropped - (len(right.ids) - len(right.tail))) :]
    if len(right.ids) - len(right.tail) <= dropped:
        before = left.tail[: max(0, kept - (len(left.ids) - len(left.tail)))]
        tail = np.concatenate((before, middle, tail))[-EDGE:]
    return Leaf(ids, head, tail)


def concatenate(coder: Encoder, leaves: list[str], coded: list[Leaf]) -> bytes:
    """Ids of the joined leaves; ``coded`` has those of each leaf, places counted from its own start."""
    text = "".join(leaves)
    starts = [0, *np.cumsum([len(one) for one in leaves]).tolist()]
    parts = [(at, one.moved(at)) for at, one in zip(starts, coded)]
    while len(parts) > 1:
        bounds = [at for at, _ in parts] + [len(text)]
        parts = [
            (bounds[i], join(coder, text, parts[i][1], parts[i + 1][1], bounds[i], bounds[i + 1], bounds[i + 2]))
            if i + 1 < len(parts)
            else parts[i]
            for i in range(0, len(parts), 2)
        ]
    return parts[0][1].ids.astype(ID).tobytes() if parts else b""


def encode_tree(coder: Encoder, text: str, leaf: int = LEAF) -> list[int]:
    """The tree on one machine, for tests."""
    leaves = [text[at : at + leaf] for at in range(0, len(text), leaf)]
    coded = [_unpacked(_packed(coder.leaf(one))) for one in leaves]
    return np.frombuffer(concatenate(coder, leaves, coded), ID).tolist()


def _ids_function(file: str):
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoder(file)
        for texts in batches:
            yield pd.Series(list(coder.encode_all(texts)), dtype=object)

    return ids


def word_ids(text: Column, file: str | None = None) -> Column:
    """Ids of each text as binary (little-endian, 32 bits each), by the words' kept ids."""
    return pandas_udf(_ids_function(file or word_tokenizer_file()), "binary")(F.coalesce(text, F.lit("")))


def decoded(ids: Column, file: str | None = None) -> Column:
    """The text that ids (binary) stand for, special tokens kept."""
    file = file or word_tokenizer_file()

    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoder(file)
        for values in batches:
            yield values.map(coder.decode)

    return pandas_udf(text, "string")(ids)


def _packed(leaf: Leaf) -> bytes:
    sizes = np.array([len(leaf.head), len(leaf.tail)], "<i4")
    edges = np.concatenate((leaf.head.ravel(), leaf.tail.ravel())).astype("<i4")
    return sizes.tobytes() + edges.tobytes() + leaf.ids.astype(ID).tobytes()


def _unpacked(data: bytes) -> Leaf:
    head, tail = np.frombuffer(data, "<i4", 2).tolist()
    edges = np.frombuffer(data, "<i4", 3 * (head + tail), 8).astype(np.int64).reshape(-1, 3)
    return Leaf(np.frombuffer(data, ID, offset=8 + 12 * (head + tail)), edges[:head], edges[head:])


CODED = "ids binary, decoded string"


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file: str | None = None, leaf: int = LEAF) -> DataFrame:
    """One row per document: its id, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``, the text they stand for."""
    file = file or word_tokenizer_file()
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    is_long = F.char_length("text") > leaf

    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = encoder(file)
        for texts in batches:
            ids = list(coder.encode_all(texts))
            yield pd.DataFrame({"ids": ids, "decoded": list(map(coder.decode, ids))})

    def leaf_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = encoder(file)
        for texts in batches:
            yield texts.map(lambda one: _packed(coder.leaf(one)))

    def tree(rows: pd.DataFrame) -> pd.DataFrame:
        coder, rows = encoder(file), rows.sort_values("place")
        ids = concatenate(coder, list(rows["leaf"]), list(map(_unpacked, rows["tokens"])))
        return pd.DataFrame({"doc_id": rows["doc_id"].iloc[:1], "ids": [ids], "decoded": [coder.decode(ids)]})

    short = whole.where(~is_long).select("doc_id", pandas_udf(both, CODED)("text").alias("coded")).select("doc_id", "coded.*")
    # a cut into pieces of fixed length in one pass over the text
    leaves = (
        whole.where(is_long)
        .withColumn("document", F.monotonically_increasing_id())
        .select("doc_id", "document", F.posexplode(F.expr(f"regexp_extract_all(text, '(?s).{{1,{leaf}}}', 0)")).alias("place", "leaf"))
        .repartition("document", "place")
        .withColumn("tokens", pandas_udf(leaf_tokens, "binary")("leaf"))
    )
    kind = whole.schema["doc_id"].dataType.simpleString()
    long = leaves.groupBy("document").applyInPandas(tree, f"doc_id {kind}, {CODED}")
    return short.unionByName(long)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", file: str | None = None, leaf: int = LEAF) -> DataFrame:
    """One row per document: its id and ``ids`` (binary, little-endian unsigned 32-bit)."""
    return round_trip(docs, doc_id, text, file, leaf).drop("decoded")


def report(docs: DataFrame) -> DataFrame:
    """Number and digest of the ids, digest of the text they decode to."""
    return round_trip(docs).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
