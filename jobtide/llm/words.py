"""Words of many texts at once, as numbers into a list of the different ones."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 8_000_000  # bytes of text that are held as arrays together
_END = 0xFF  # no byte of UTF-8
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)


class Words(NamedTuple):
    codes: np.ndarray  # number of each word, in the order of the texts
    different: pa.Array  # the different words
    text: np.ndarray  # number of the text each word is in
    piece: np.ndarray  # number of the piece each word is in, rising over all texts


def split_words(texts: pa.Array, blanks: bytes, stops: bytes = b"") -> Words:
    """Words with A-Z lower-cased; ``blanks`` part words, ``stops`` (ASCII, too) and ends of texts part pieces."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, np.int32)
    data = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
    letters = np.insert(_LOWER[data], offsets[1:] - offsets[0], _END)
    kinds = np.zeros(256, np.uint8)
    kinds[list(blanks)] = 1
    kinds[[*stops, _END]] = 2
    kind = kinds[letters]
    inside = kind == 0
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edges = np.append(0, edges)
    starts, ends = edges[::2], edges[1::2]  # the last byte is never part of a word
    lengths = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=lengths[1:])
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(lengths), pa.py_buffer(letters[inside]))
    coded = words.dictionary_encode()
    return Words(
        coded.indices.to_numpy(),
        coded.dictionary,
        np.searchsorted(np.flatnonzero(letters == _END), starts).astype(np.int32),
        np.searchsorted(np.flatnonzero(kind == 2), starts).astype(np.int32),
    )


def word_hashes(different: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word: the sum of a number for each byte and its place."""
    if not len(different):
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(different.buffers()[1], np.int32, len(different) + 1, 4 * different.offset)
    letters = np.frombuffer(different.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts, lengths = offsets[:-1] - offsets[0], np.diff(offsets)
    place = np.arange(len(letters)) - np.repeat(starts, lengths)
    # words are not empty
    sums = np.add.reduceat(mixed((place.astype(np.uint64) << np.uint64(8)) + letters + np.uint64(seed)), starts)
    return mixed(sums + lengths.astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of the number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array, size: int = CHUNK) -> Iterator[pa.Array]:
    """Whole texts, as many together as have about ``size`` bytes; null is the empty text."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
    parts = (np.cumsum(sizes) - sizes) // size  # of the first byte of each text
    bounds = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(texts)]
    for begin, end in zip(bounds, bounds[1:]):
        if end > begin:
            yield texts.slice(begin, end - begin)
