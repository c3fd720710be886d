"""Benchmark decontamination over suffix arrays of the training text.

A task joins the words of its documents to one sequence, a shard, and sorts the suffixes of the
shard by their first ``window`` words with prefix doubling. Every suffix of every test item is
then searched by binary search in the sorted suffixes: the range that shares its whole window
gives all verbatim occurrences. ``longest_matches`` extends them: per run of hits of a document and
an item its place in both and its greatest length. Words that no test item has get numbers of their own, end matches, and start none, so suffixes
that begin with them need not be sorted.

Test items are sent to the tasks in blocks of bounded size (``BLOCK_BYTES``); a larger test set
takes several blocks, whose hits are merged per document. Documents are never shuffled.

Words are runs of letters and digits with A-Z in lower case; all bytes above 127 count as letters.
An item with fewer words than the window, but at least one, is a window of its own. A document is
contaminated where ``cut`` times its hit words reach its number of words.

Defined cases: NULL and wordless texts have no words and are clean; NULL items are ignored; items
that share an id are one item; rows of documents that share an id stay rows of their own; an
empty test set leaves all documents clean; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import append_columns, as_bytes, map_texts, packed

WINDOW = 13
CUT = 20
#: Bytes of test text that are sent to the tasks at once.
BLOCK_BYTES = 8 << 20
_words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall

HITS = [
    ("_n_words", pa.int64(), "bigint"),
    ("_starts", pa.list_(pa.int32()), "array<int>"),
    ("_ends", pa.list_(pa.int32()), "array<int>"),
    ("_items", pa.list_(pa.string()), "array<string>"),
]


def words_of(raw: bytes) -> list[bytes]:
    return _words(raw.lower())


class TestItems:
    """Suffixes of test items as rows of ``window`` word numbers, padded with 0."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.names: list[str] = []
        rows, lengths, owner, place = [], [], [], []
        for name, raw in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(raw)]
            need = min(window, len(words))
            if words:
                self.names.append(name)
            # Suffixes shorter than the window (or the whole short item) cannot hold one.
            for i in range(len(words) - need + 1 if words else 0):
                rows.append(words[i : i + need] + [0] * (window - need))
                lengths.append(need)
                owner.append(len(self.names) - 1)
                place.append(i)
        self.rows = np.array(rows, dtype=np.int64).reshape(-1, window)
        self.lengths = np.array(lengths, dtype=np.int64)
        self.owner = np.array(owner, dtype=np.int64)
        self.place = np.array(place, dtype=np.int64)


def suffix_array(shard: np.ndarray, window: int) -> np.ndarray:
    """Suffixes that do not begin with 0, sorted by their first ``window`` numbers.

    ``shard`` ends with ``window`` zeros. Prefix doubling: ranks over 2h numbers come from pairs
    of ranks over h; the last step overlaps so that exactly ``window`` numbers count. Whatever
    follows a 0 cannot be part of a match, so all suffixes that begin with 0 have rank 0.
    """
    starts = np.flatnonzero(shard)
    rank, covered = shard.astype(np.int64), 1
    while covered < window:
        step = min(covered, window - covered)
        pair = rank[starts] * (int(rank.max()) + 1) + rank[starts + step]
        _, dense = np.unique(pair, return_inverse=True)
        rank = np.zeros_like(rank)
        rank[starts] = dense + 1
        covered += step
    return starts[np.argsort(rank[starts], kind="stable")]


def occurrences(shard: np.ndarray, order: np.ndarray, items: TestItems) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 place in ``order`` of the suffixes that begin with each test row."""
    window, rows, count = items.window, items.rows, len(items.rows)
    used = np.arange(window) < items.lengths[:, None]
    span = np.arange(window)

    def search(after_equal: bool) -> np.ndarray:
        low, high = np.zeros(count, dtype=np.int64), np.full(count, len(order), dtype=np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_]) // 2
            found = shard[order[middle][:, None] + span]
            found = np.where(np.minimum.accumulate(found > 0, axis=1), found, 0)
            unequal = (found != rows[open_]) & used[open_]
            first = unequal.argmax(axis=1)
            at = np.arange(len(open_))
            equal = ~unequal[at, first]
            below = found[at, first] < rows[open_][at, first]
            right = below | equal if after_equal else below & ~equal
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]

    return search(False), search(True)


def _merged(starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Union of half-open spans as maximal spans in order."""
    out: list[list[int]] = []
    for start, end in sorted(zip(starts, ends)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [s for s, _ in out], [e for _, e in out]


def _shard(bodies: list[bytes], items: TestItems) -> tuple[np.ndarray, list[int]]:
    """Word numbers of the texts, a 0 behind each, and where each text begins."""
    number = items.numbers.get
    numbers, bounds = [], [0]
    for raw in bodies:
        words = words_of(raw)
        numbers.extend([number(w, 0) for w in words])
        numbers.append(0)  # no match crosses the end of a text
        bounds.append(len(numbers))
    return np.array(numbers + [0] * items.window, dtype=np.int32), bounds


def _occurring(shard: np.ndarray, items: TestItems) -> tuple[np.ndarray, np.ndarray]:
    """Test row and place in the shard of every occurrence."""
    none = np.zeros(0, dtype=np.int64)
    if not len(items.rows):
        return none, none
    order = suffix_array(shard, items.window)
    low, high = occurrences(shard, order, items)
    hits = high - low
    if not hits.any():
        return none, none
    row = np.repeat(np.arange(len(hits)), hits)
    place = np.arange(len(row)) - np.repeat(np.cumsum(hits) - hits, hits)
    return row, order[low[row] + place]


def shard_hits(bodies: list[bytes], items: TestItems) -> list[tuple[int, list[int], list[int], list[str]]]:
    """Per text of one shard: its words, its hit spans and the items that occur in it."""
    shard, bounds = _shard(bodies, items)
    lengths = [b - a - 1 for a, b in zip(bounds, bounds[1:])]
    found = [(n, [], [], []) for n in lengths]
    row, position = _occurring(shard, items)
    if not len(row):
        return found
    edge = np.zeros(len(shard) + 1, dtype=np.int64)
    np.add.at(edge, position, 1)
    np.add.at(edge, position + items.lengths[row], -1)
    hit = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
    change = np.diff(hit)
    starts = np.flatnonzero(change == 1)
    ends = np.flatnonzero(change == -1)
    limits = np.array(bounds)
    for text, start, end in zip(
        (np.searchsorted(limits, starts, side="right") - 1).tolist(), starts.tolist(), ends.tolist()
    ):
        found[text][1].append(start - bounds[text])
        found[text][2].append(end - bounds[text])
    text = np.searchsorted(limits, position, side="right") - 1
    for pair in np.unique(text * len(items.names) + items.owner[row]).tolist():
        found[pair // len(items.names)][3].append(items.names[pair % len(items.names)])
    return found


def shard_matches(bodies: list[bytes], items: TestItems) -> list[tuple[int, str, int, int, int]]:
    """Longest verbatim matches: text, item, first word in the text and in the item, words.

    Windows that follow each other in text and item alike are one match, which no word before or
    behind it could make longer.
    """
    shard, bounds = _shard(bodies, items)
    row, position = _occurring(shard, items)
    if not len(row):
        return []
    owner, place = items.owner[row], items.place[row]
    order = np.lexsort((position, position - place, owner))
    row, position, owner, place = row[order], position[order], owner[order], place[order]
    follows = (np.diff(owner) == 0) & (np.diff(position) == 1) & (np.diff(place) == 1)
    first = np.flatnonzero(np.concatenate([[True], ~follows]))
    runs = np.diff(np.concatenate([first, [len(row)]]))
    text = np.searchsorted(np.array(bounds), position[first], side="right") - 1
    words = runs - 1 + items.lengths[row[first]]
    return [
        (t, items.names[o], p - bounds[t], q, n)
        for t, o, p, q, n in zip(
            text.tolist(), owner[first].tolist(), position[first].tolist(), place[first].tolist(), words.tolist()
        )
    ]


MATCHES = [
    ("doc_id", pa.int64(), "bigint"), ("item_id", pa.string(), "string"), ("text_place", pa.int64(), "bigint"),
    ("item_place", pa.int64(), "bigint"), ("n_words", pa.int64(), "bigint"),
]


def _match_rows(parts: Iterator[pa.RecordBatch], block, window: int):
    items = TestItems(block.value, window)
    for part in parts:
        keys = part.column("doc_id").to_pylist()
        yield [(keys[t], *match) for t, *match in shard_matches(part.column("body").to_pylist(), items)]


def longest_matches(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per longest match of ``window`` words or more (or a whole shorter item): doc_id,
    item_id, text_place and item_place (words before it, in the row of the item), n_words."""
    bodies = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("body"))
    context, found = documents.sparkSession.sparkContext, None
    for block in item_blocks(items, block_bytes):
        rows = map_texts(bodies, "body", _match_rows, MATCHES, context.broadcast(block), window)
        found = rows if found is None else found.unionByName(rows)
    return found


def _search(parts: Iterator[pa.RecordBatch], block, window: int, merge: bool):
    items = TestItems(block.value, window)
    for part in parts:
        rows = shard_hits(part.column("body").to_pylist(), items)
        if merge:
            earlier = part.column("row")
            old = [earlier.field(name).to_pylist() for name in ("_starts", "_ends", "_items")]
            rows = [
                (n, *_merged(s + a, e + b), i + c) for (n, s, e, i), a, b, c in zip(rows, *old)
            ]
        yield rows


def item_blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    """Test items in blocks of about ``limit`` bytes, each read on its own."""
    texts = items.filter("item_id is not null").select(
        F.col("item_id").cast("string").alias("item_id"), as_bytes().alias("body")
    )
    size = texts.agg(F.sum(F.length("body"))).first()[0] or 0
    count = size // limit + 1
    for i in range(count):
        mine = texts.filter(F.pmod(F.xxhash64("item_id"), F.lit(count)) == i)
        yield [(r["item_id"], bytes(r["body"])) for r in mine.toLocalIterator()]


def with_matches(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``documents`` with _n_words, _starts and _ends of hit word spans, and _items, all found."""
    context, merge = documents.sparkSession.sparkContext, False
    for block in item_blocks(items, block_bytes):
        sent = context.broadcast(block)
        columns = [c for c in documents.columns if not merge or c not in ("_n_words", "_starts", "_ends", "_items")]
        found = append_columns(documents, as_bytes(), _search, _renamed(merge), sent, window, merge)
        documents = found.select(
            *columns, *[F.col(f"{name}{'+' if merge else ''}").alias(name) for name, _, _ in HITS]
        )
        merge = True
    return documents


def _renamed(merge: bool) -> list[tuple[str, pa.DataType, str]]:
    return [(f"{name}{'+' if merge else ''}", *kinds) for name, *kinds in HITS]


def _verdict(cut: int):
    hit = F.expr("aggregate(zip_with(_ends, _starts, (e, s) -> e - s), 0L, (a, n) -> a + n)")
    return hit, (hit > 0) & (cut * hit >= F.col("_n_words"))


def match_digests(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = with_matches(documents.select("doc_id", "text"), items)
    hit, contaminated = _verdict(CUT)
    names = F.array_sort(F.array_distinct("_items"))
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size(names).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated.alias("contaminated"),
        "_starts",
        "_ends",
    ).withColumnsRenamed({"_starts": "hit_starts", "_ends": "hit_ends"})


def decontaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``documents`` without those that are contaminated."""
    _, contaminated = _verdict(CUT)
    return with_matches(packed(documents, "text"), items).filter(~contaminated).select("_row.*")
