"""Sets of word shingles as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from shelfcast.llm.common import encode_dictionary, split_words

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets and hashes of the words of each text, A-Z in lower case."""
    offsets, words = split_words(pc.ascii_lower(texts))
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    index, distinct = encode_dictionary(words)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))
    kept = np.concatenate([[0], np.cumsum(filled)])
    return kept[offsets], hashes[index[filled]]


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the `width`-word shingles of each text.

    A text of fewer words gives its whole sequence as one shingle; one without words gives none.
    """
    offsets, words = word_hashes(texts)
    n = max(len(words) - width + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = mix(rolled * _A + words[k : k + n] + _B)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            h = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                h = mix(h * _B + words[k] + _A)
            yield h
        else:
            yield words[:0]
