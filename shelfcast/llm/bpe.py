"""BPE encoding and decoding with contiguous rank arrays.

A word of b bytes starts as b parts. Its part ids lie in one contiguous array and the merge ranks of adjacent
parts in another; the least rank is found by a scan, the boundary there is deleted from both arrays, and the
ranks of the two new neighbours are looked up. Words of the same length are worked on together, one row each:
every pass deletes one boundary in every row, so the rows stay contiguous and of equal length. Words longer than
`SHORT` bytes, where scans would cost the square of the length, keep their candidates in a heap.

Texts are cut at ASCII white space; the ids of each distinct chunk are worked out once and kept in a bounded
cache of the Python worker, so that a text is the concatenation of cached chunks.

Defined results: a null text is an empty one; an empty text has no ids, and the hashes of empty strings. Rows
are independent: repeated rows, null ids and further columns (ignored) change nothing, an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from shelfcast.llm.common import encode_dictionary, slices, split_words, sums_by_row, texts_of

#: Longest word, in bytes, that is merged by scanning.
SHORT = 64
#: Distinct chunks kept by a Python worker; when full, the cache starts anew.
CACHED = 600_000
NO_RANK = np.int32(2**31 - 1)


def printable_bytes() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, all other bytes for the characters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Merges:
    """Merge table: rank and result of every mergeable pair of part ids."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        glyphs = printable_bytes()
        self.inner = np.array([vocabulary[c] for c in glyphs], np.int64)
        self.last = np.array([vocabulary[c + suffix] for c in glyphs], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        keys, first = np.unique(keys, return_index=True)
        self.keys = np.append(keys, np.iinfo(np.int64).max)
        self.ranks = np.append(first, NO_RANK).astype(np.int32)
        self.result = np.array([vocabulary[a + b] for a, b in pairs], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def rows(self, words: np.ndarray) -> list[bytes]:
        """Ids of words of one length; `words` holds their bytes, a row each."""
        done: list[bytes] = [b""] * len(words)

        def finish(which: np.ndarray, found: np.ndarray) -> None:
            raw, size = found.astype("<u4").tobytes(), 4 * found.shape[1]
            for k, i in enumerate(which.tolist()):
                done[i] = raw[k * size : (k + 1) * size]

        ids = self.inner[words]
        ids[:, -1] = self.last[words[:, -1]]
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(words))
        while ids.shape[1] > 1 and len(rows):
            at = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), at]
            going = least < NO_RANK
            if not going.all():
                finish(rows[~going], ids[~going])
                rows, ids, ranks, at, least = rows[going], ids[going], ranks[going], at[going], least[going]
            here, parts = np.arange(len(rows)), ids.shape[1]
            ids[here, at] = self.result[least]
            kept = np.ones(ids.shape, bool)
            kept[here, at + 1] = False
            ids = ids[kept].reshape(len(rows), parts - 1)
            kept = np.ones(ranks.shape, bool)
            kept[here, at] = False
            ranks = ranks[kept].reshape(len(rows), parts - 2)
            if parts > 2:
                before = np.flatnonzero(at > 0)
                left = at[before] - 1
                ranks[before, left] = self.rank(ids[before, left], ids[before, left + 1])
                after = np.flatnonzero(at < parts - 2)
                right = at[after]
                ranks[after, right] = self.rank(ids[after, right], ids[after, right + 1])
        finish(rows, ids)
        return done

    def long(self, word: bytes) -> bytes:
        """Ids of one long word: candidates in a heap by rank, then place."""
        raw = np.frombuffer(word, np.uint8)
        ids = self.inner[raw]
        ids[-1] = self.last[raw[-1]]
        ranks = self.rank(ids[:-1], ids[1:])
        places = np.flatnonzero(ranks < NO_RANK)
        parts, n = ids.tolist(), len(ids)
        heap = [(int(ranks[i]), int(i), parts[i], parts[i + 1]) for i in places]
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranked = dict(zip(self.keys[:-1].tolist(), self.ranks[:-1].tolist(), strict=True)) if heap else {}
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j >= n or parts[i] != left or parts[j] != right:
                continue
            parts[i], parts[j] = int(self.result[rank]), -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := ranked.get(parts[a] << 32 | parts[b])) is not None:
                    heapq.heappush(heap, (r, a, parts[a], parts[b]))
        return np.array([p for p in parts if p >= 0], "<u4").tobytes()

    def encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each word, as unsigned little-endian 32-bit integers; all words must hold a byte."""
        by_size: dict[int, list[bytes]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        found: dict[bytes, bytes] = {}
        for size, chosen in by_size.items():
            if size > SHORT:
                ids = map(self.long, chosen)
            else:
                ids = self.rows(np.frombuffer(b"".join(chosen), np.uint8).reshape(-1, size))
            found.update(zip(chosen, ids, strict=True))
        return found


class WordTokenizer:
    """Lower-casing word BPE as its JSON file describes it: NFC, lower case by character, words by pattern,
    bytes, merges with word ends. Special tokens in a text keep their ids. Decoding joins tokens by a space."""

    #: The word pattern of the tokenizer file.
    PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        self.merges = Merges(vocabulary, spec["model"]["merges"], spec["model"]["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(s) for s in self.special) + ")")
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*vocabulary.items(), *self.special.items()]:
            self.tokens[i] = token

    def words(self, chunk: str) -> list:
        """Words of a chunk as bytes; a special token as its id."""
        if "<|" in chunk:
            parts = self.special_pattern.split(chunk)
            return [x for p in parts for x in ([self.special[p]] if p in self.special else self._plain(p))]
        return self._plain(chunk)

    def _plain(self, chunk: str) -> list[bytes]:
        if chunk.isascii():
            lower = chunk.lower()
            if lower.isalpha():
                return [lower.encode()]
        else:
            lower = unicodedata.normalize("NFC", chunk)
            # by character: the whole-string rule for a final sigma does not apply
            lower = "".join(map(str.lower, lower)) if "Σ" in lower else lower.lower()
        return [w.encode("utf-8", "surrogatepass") for w in self.PATTERN.findall(lower)]

    def encode(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk of text, as unsigned little-endian 32-bit integers."""
        split = [self.words(c) for c in chunks]
        ids = self.merges.encode(list({w for ws in split for w in ws if isinstance(w, bytes)}))
        ids.update((i, int(i).to_bytes(4, "little")) for i in self.special.values())
        return [ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws]) for ws in split]

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


class ChunkCache:
    """What `make` gives for each distinct chunk, kept while fewer than `CACHED` are held."""

    def __init__(self, make: Callable[[list[str]], list]):
        self.make, self.kept = make, {}

    def __call__(self, chunks: list[str]) -> np.ndarray:
        kept = self.kept
        values = [kept.get(c) for c in chunks]
        missing = [i for i, v in enumerate(values) if v is None]
        if missing:
            if len(kept) + len(missing) > CACHED:
                kept.clear()
            for i, v in zip(missing, self.make([chunks[i] for i in missing]), strict=True):
                values[i] = kept[chunks[i]] = v
        out = np.empty(len(values), object)
        out[:] = values
        return out


@lru_cache(maxsize=4)
def id_bytes(path: str) -> ChunkCache:
    """Chunk to its ids as unsigned little-endian 32-bit integers."""
    t = tokenizer(path)
    return ChunkCache(t.encode)


def ids_of_texts(path: str, texts: pa.Array) -> Iterator[bytes]:
    """Ids of each text, as unsigned little-endian 32-bit integers."""
    offsets, chunks = split_words(texts)
    index, distinct = encode_dictionary(chunks)
    values = id_bytes(path)(distinct.to_pylist())[index]
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield b"".join(values[a:b].tolist())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id_col` and the ids of each text as `ids`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            raw = list(ids_of_texts(path, texts_of(batch.column(1))))
            sizes = np.fromiter((len(x) // 4 for x in raw), np.int64, len(raw))
            flat = np.frombuffer(b"".join(raw), "<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "ids"])

    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {source.schema[0].dataType.simpleString()}, ids array<int>"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`id_col` and the decoded `text` of each list of ids; a null list counts as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            texts = [t.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    source = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    schema = f"id {source.schema[0].dataType.simpleString()}, text string"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


@lru_cache(maxsize=4)
def round_trips(path: str) -> ChunkCache:
    """Chunk to (count, ids in decimal, decoded text), the last two with a space after each token."""
    t = tokenizer(path)

    def make(chunks: list[str]) -> list[tuple[int, bytes, bytes]]:
        decimal, tokens = _spellings(path)
        out = []
        for ids in t.encode(chunks):
            ids = memoryview(ids).cast("I").tolist()
            out.append((len(ids), b"".join([decimal[i] for i in ids]), b"".join([tokens[i] for i in ids])))
        return out

    return ChunkCache(make)


@lru_cache(maxsize=4)
def _spellings(path: str) -> tuple[list[bytes], list[bytes]]:
    t = tokenizer(path)
    return [b"%d " % i for i in range(len(t.tokens))], [(x + " ").encode() for x in t.tokens]


def round_trip_digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_tokens, SHA-256 of the decimal ids joined by a space, SHA-256 of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            offsets, chunks = split_words(texts_of(batch.column(1)))
            index, distinct = encode_dictionary(chunks)
            values = round_trips(path)(distinct.to_pylist())
            parts = [np.empty(len(values), object) for _ in range(2)]
            counts = np.fromiter((v[0] for v in values), np.int64, len(values))
            for k, part in enumerate(parts):
                part[:] = [v[k + 1] for v in values]
            digests: list[list[str]] = [[], []]
            for k, part in enumerate(parts):
                flat = part[index]
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    digests[k].append(hashlib.sha256(b"".join(flat[a:b].tolist())[:-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums_by_row(offsets, counts[index]), pa.int64()),
                 pa.array(digests[0], pa.string()), pa.array(digests[1], pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = (
        f"id {source.schema[0].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
