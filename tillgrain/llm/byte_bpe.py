"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves pre-tokens that are whole entries.
Tier two: the remaining pre-tokens start as linked single bytes; a heap yields the adjacent pair
of least rank, leftmost first, until no pair is an entry.

Each task asks once for every distinct pre-token it meets, so repeated words cost a dictionary
look-up; the memory for that is bounded. Nothing is shuffled.

Defined cases: a NULL text is empty and has no ids; an empty table gives no rows; repeated rows
give repeated rows; texts that spell special tokens are ordinary text; broken UTF-8 is read with
replacement characters; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import as_bytes, map_texts, text_of

#: Distinct pre-tokens a worker remembers before it starts over.
REMEMBERED_PIECES = 400_000
# Keys per bucket of the hash; smaller buckets build faster and take more space.
BUCKET_KEYS = 1
_MASK = (1 << 64) - 1

ENCODED = [
    ("doc_id", pa.int64(), "bigint"),
    ("n_tokens", pa.int64(), "bigint"),
    ("ids_sha256", pa.string(), "string"),
    ("decoded_sha256", pa.string(), "string"),
]
TOKENS = [
    ("doc_id", pa.int64(), "bigint"),
    ("ids", pa.list_(pa.int32()), "array<int>"),
    ("decoded", pa.string(), "string"),
]


class PerfectHash:
    """Minimal perfect hash by displacement: n keys fill n slots, one probe per look-up.

    A key's digest gives its bucket and a start and step; the bucket's displacement sends every
    key of the bucket to a slot of its own. Buckets of one key name their slot directly, as a
    negative displacement. The stored key settles whether a probe is a member.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n = self.n = len(keys)
        self.buckets = max(1, n // BUCKET_KEYS)
        self.displacement = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        held: list[list[int]] = [[] for _ in range(self.buckets)]
        digests = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for i, digest in enumerate(digests):
            held[digest % self.buckets].append(i)
        order = sorted(range(self.buckets), key=lambda b: -len(held[b]))
        for b in order:
            if len(held[b]) < 2:
                break
            d = 1
            while True:
                slots = [self._slot(digests[i], d) for i in held[b]]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
            self.displacement[b] = d
            for i, s in zip(held[b], slots):
                self.keys[s], self.values[s] = keys[i], values[i]
        free = (s for s in range(n) if self.keys[s] is None)
        singles = [b for b in order if len(held[b]) == 1]
        for b, s in zip(singles, list(free)):
            i = held[b][0]
            self.displacement[b] = -s - 1
            self.keys[s], self.values[s] = keys[i], values[i]

    def _slot(self, digest: int, d: int) -> int:
        mixed = ((digest >> 20) ^ (d * 0x9E3779B97F4A7C15)) & _MASK
        mixed = (mixed ^ (mixed >> 29)) * 0xBF58476D1CE4E5B9 & _MASK
        return (mixed >> 16) % self.n

    def get(self, key: bytes) -> int | None:
        digest = xxhash.xxh3_64_intdigest(key)
        d = self.displacement[digest % self.buckets]
        slot = -d - 1 if d < 0 else self._slot(digest, d)
        return self.values[slot] if self.keys[slot] == key else None


class ByteBPE:
    """A vocabulary of byte strings and ranks, with its encoder and decoder."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.whole = PerfectHash(list(ranks), list(ranks.values()))
        self.bytes_of = {str(i): b for b, i in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, str] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by merging adjacent pairs, least rank first."""
        n, rank = len(piece), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # Rank of the pair that starts at a byte; -1: no entry, or no longer a start.
        pair = [rank(piece[i : i + 2], -1) for i in range(n - 1)]
        pair.append(-1)
        heap = [r << 40 | i for i, r in enumerate(pair) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFFFF
            if pair[i] != top >> 40:
                continue
            gone = after[i]
            end = after[i] = after[gone]
            pair[gone] = -1
            if end < n:
                before[end] = i
                r = pair[i] = rank(piece[i : after[end]], -1)
                if r >= 0:
                    heappush(heap, r << 40 | i)
            else:
                pair[i] = -1
            left = before[i]
            if left >= 0:
                r = pair[left] = rank(piece[left:end], -1)
                if r >= 0:
                    heappush(heap, r << 40 | left)
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i : after[i]]])
            i = after[i]
        return ids

    def _piece(self, piece: str) -> str:
        raw = piece.encode("utf-8")
        whole = self.whole.get(raw)
        return str(whole) if whole is not None else " ".join(map(str, self.merge(raw)))

    def encode(self, texts: Iterable[str]) -> Iterator[str]:
        """Decimal ids of each text, joined by one space."""
        if len(self.known) > REMEMBERED_PIECES:
            self.known.clear()
        known = self.known
        for text in texts:
            pieces = self.pieces(text)
            for new in set(pieces).difference(known):
                known[new] = self._piece(new)
            yield " ".join([known[p] for p in pieces])

    def decode(self, ids: str) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids.split(" ")]) if ids else b""


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> ByteBPE:
    """The codec of a rank file: per line a base64 byte string and its rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
    return ByteBPE(ranks, pattern)


def _digests(parts: Iterator[pa.RecordBatch], path: str, pattern: str):
    bpe = codec(path, pattern)
    for part in parts:
        texts = map(text_of, part.column("body").to_pylist())
        rows = []
        for key, ids in zip(part.column("doc_id").to_pylist(), bpe.encode(texts)):
            count = ids.count(" ") + 1 if ids else 0
            decoded = hashlib.sha256(bpe.decode(ids)).hexdigest()
            rows.append((key, count, hashlib.sha256(ids.encode()).hexdigest(), decoded))
        yield rows


def _tokens(parts: Iterator[pa.RecordBatch], path: str, pattern: str):
    bpe = codec(path, pattern)
    for part in parts:
        texts = map(text_of, part.column("body").to_pylist())
        yield [
            (key, [int(i) for i in ids.split()], text_of(bpe.decode(ids)))
            for key, ids in zip(part.column("doc_id").to_pylist(), bpe.encode(texts))
        ]


def _bodies(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("body"))


def encode_documents(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the text decoded from them."""
    return map_texts(_bodies(documents), "body", _tokens, TOKENS, path, pattern, limit=1 << 20)


def encoded_digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the bytes decoded from them."""
    return map_texts(_bodies(documents), "body", _digests, ENCODED, path, pattern)
