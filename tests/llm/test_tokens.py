"""Token counts, BPE and packing against the tokenizer libraries."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_rows import rows_of
from shelfcast.llm import bpe, packing, token_counts

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD_LIBRARY = Tokenizer.from_file(WORDS)
PIECE_LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)

TEXTS = st.text(st.sampled_from("abcdeABDES'’ \n\t  .,!?0159éÉßΣσςİ日本😀<|>_-́ı\x1c\x85▁"), max_size=60)


def library_ids(text):
    return WORD_LIBRARY.encode(text or "", add_special_tokens=False).ids


def own_ids(texts):
    return [np.frombuffer(x, "<u4").tolist() for x in bpe.ids_of_texts(WORDS, pa.array(texts, pa.string()))]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_ids_equal_the_library(texts):
    assert own_ids(texts) == [library_ids(t) for t in texts]


def test_special_tokens_and_long_words():
    random.seed(1)
    texts = ["<|endoftext|>", "a<|startoftext|>b<|endoftext|>'s", "<|EndOfText|>", "x" * 3000,
             "".join(random.choice("abcdefgh") for _ in range(2000)), "the" * 500]
    assert own_ids(texts) == [library_ids(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS | st.text(st.sampled_from("ab ▁"), max_size=12), min_size=1, max_size=5))
def test_counts_equal_the_library(texts):
    offsets, flat = token_counts.pre_tokens(pa.array(texts))
    counts = np.concatenate([[0], np.cumsum(token_counts.counts_of(PIECES, flat.to_pylist()))])
    own = [int(counts[b] - counts[a]) if t else 0 for t, a, b in zip(texts, offsets, offsets[1:])]
    assert own == [len(PIECE_LIBRARY.encode(t)) for t in texts]


def test_count_tokens(edge_docs, clashing_docs, no_docs):
    want = Counter(
        (i, len((t or "").encode()), len(PIECE_LIBRARY.encode(t or "")), len(PIECE_LIBRARY.encode(t or "")) > 50)
        for i, t in rows_of(edge_docs, "doc_id", "text")
    )
    docs = clashing_docs
    found = token_counts.count_tokens(docs, PIECES, limit=50)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(rows_of(found)) == want
    assert rows_of(token_counts.count_tokens(no_docs, PIECES, limit=50)) == []


def test_round_trip(edge_docs, clashing_docs, no_docs):
    def digest(text):
        ids = library_ids(text)
        decoded = WORD_LIBRARY.decode(ids, skip_special_tokens=False)
        return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))

    want = Counter((i, *digest(t)) for i, t in rows_of(edge_docs, "doc_id", "text"))
    docs = clashing_docs
    assert Counter(rows_of(bpe.round_trip_digest(docs, WORDS))) == want
    assert rows_of(bpe.round_trip_digest(no_docs, WORDS)) == []
    encoded = bpe.encode(edge_docs, WORDS)
    decoded = {(i, t) for i, t in rows_of(bpe.decode(encoded, WORDS))}
    assert decoded == {
        (i, WORD_LIBRARY.decode(library_ids(t), skip_special_tokens=False)) for i, t in rows_of(edge_docs, "doc_id", "text")
    }


# -- packing

def check_packing(rows, capacity):
    """Gapless sequences within the capacity, each place used once."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30), max_size=25))
def test_plan_places_every_rank_once(counts):
    used = defaultdict(list)
    filled = defaultdict(list)
    for length, first, count, copies, sequence, offset in packing.plan(counts, 40):
        used[length] += range(first, first + count * copies)
        for s in range(sequence, sequence + count):
            filled[s] += [(offset + c * length, length) for c in range(copies)]
    assert {k: sorted(v) for k, v in used.items()} == {k: list(range(n)) for k, n in counts.items() if n}
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 40
        assert sum(3 * length > 40 for _, length in places) <= 2
    large = sorted((k for k, n in counts.items() for _ in range(n) if 3 * k > 40), reverse=True)
    assert len(filled) >= -(-sum(k * n for k, n in counts.items()) // 40)
    if len(large) == sum(counts.values()):
        assert len(filled) == fewest_pairs(large, 40)


def fewest_pairs(sizes, capacity):
    """Fewest sequences for items of which two fit at most: the largest with the largest that fits."""
    sizes, n = sorted(sizes), 0
    while sizes:
        a, n = sizes.pop(), n + 1
        fits = [i for i, b in enumerate(sizes) if a + b <= capacity]
        if fits:
            sizes.pop(fits[-1])
    return n


@pytest.mark.parametrize("capacity", [64, 4096])
def test_pack(edge_docs, clashing_docs, no_docs, capacity):
    want = Counter()
    for i, t in rows_of(edge_docs, "doc_id", "text"):
        ids = [*library_ids(t), 1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want[i, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    docs = clashing_docs
    rows = packing.pack(docs, WORDS, capacity).collect()
    assert Counter(tuple(r[:5]) for r in rows) == want
    n = check_packing(rows, capacity)
    assert n <= 1.15 * sum(r["length"] for r in rows) / capacity + 1
    assert rows_of(packing.pack(no_docs, WORDS, capacity)) == []
