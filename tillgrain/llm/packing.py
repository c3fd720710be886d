"""Best-fit packing of token ids into sequences of one length, in a hierarchy.

Each task encodes its documents, cuts what is longer than a sequence, and packs the pieces by
best fit, longest first: a piece goes where the least room is left that still holds it. Bins
that are nearly full are finished. The others go up a tree: each of them is one item of its used
length, the bins of several tasks meet in one, and best fit puts items together again. Levels
follow, with ``FAN_IN`` times fewer groups each, until one group is left or groups hold
``BLOCK`` items and nothing fits together any more. Two bins of a group that fit together are
always merged, so a level leaves at most one bin per group that is not over half full.

Only numbers of pieces and bins are stored and shuffled, never ids or texts. A piece finds its
sequence through one join with the composed moves of its bin.

Defined cases: a NULL text is empty and gives the end id alone; rows that share an id or have
none are documents of their own; a document longer than a sequence has whole sequences behind
its first piece; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import as_bytes, batch_of, find_package, map_texts, stored, text_of
from tillgrain.llm.token_files import tokenizer

#: Pieces or bins that a task packs at once; also the items of a group from which groups stop growing.
BLOCK = 200_000
#: Groups of a level that meet in one group of the next.
FAN_IN = 16
#: A bin with at most this share of its length free is nearly full and takes no further part.
FREE_SHARE = 1 / 128
#: Numbers of bins start with the task's number, shifted by this many bits.
TASK_SHIFT = 36
#: The split of the library's byte-level tokenizers. Fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = [
    ("doc_id", pa.int64(), "bigint"),
    ("piece", pa.int32(), "int"),
    ("start", pa.int64(), "bigint"),
    ("length", pa.int64(), "bigint"),
    ("ids_crc32", pa.int64(), "bigint"),
    ("bin", pa.int64(), "bigint"),
    ("offset", pa.int64(), "bigint"),
    ("used", pa.int64(), "bigint"),
]
MOVES = pa.schema([("bin", pa.int64()), ("into", pa.int64()), ("shift", pa.int64()), ("used", pa.int64())])


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every item, and the used length of every bin; longest items first.

    ``held[r]`` are the bins with r free places, and bit r of ``filled`` tells if there are any,
    so the tightest bin for an item is the lowest bit from its size on.
    """
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    held: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled, used = 0, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        above = filled >> size
        if above:
            free = size + (above & -above).bit_length() - 1
            number = held[free].pop()
            if not held[free]:
                filled ^= 1 << free
        else:
            free, number = capacity, len(used)
            used.append(0)
        bins[i], offsets[i] = number, capacity - free
        left = free - size
        used[number] = capacity - left
        if not held[left]:
            filled |= 1 << left
        held[left].append(number)
    return bins, offsets, np.array(used, dtype=np.int64)


def _byte_ranks(path: str) -> dict[bytes, int] | None:
    """Rank of every byte string of a plain byte-level vocabulary in the order of its merges.

    None for a tokenizer that does anything else, which then goes to the library.
    """
    with open(path, encoding="utf-8") as file:
        described = json.load(file)
    model, split = described["model"], described.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE" and not described.get("normalizer")
        and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and not any(model.get(x) for x in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        return None
    # Printable bytes stand for themselves, the others for the characters from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in described.get("added_tokens", [])}
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocabulary[t] for t in merged]
    if ids != sorted(set(ids)) or len(vocabulary) != 256 + len(merged):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items()}


@lru_cache(maxsize=2)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Text to ids without special tokens, equal to the library's for the file at ``path``.

    A byte-level vocabulary whose ids follow its merges gives the same ids by ranks, which takes
    a fifth of the time.
    """
    ranks = _byte_ranks(path)
    if ranks is not None:
        return tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    library = tokenizer(path)
    return lambda text: library.encode(text, add_special_tokens=False).ids


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: a shorter first one, then whole sequences."""
    first = length % capacity or capacity
    return [(0, min(first, length)), *((s, capacity) for s in range(first, length, capacity))]


def _pieces(parts: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, block: int):
    encode, number = encoder(path), TaskContext.get().partitionId() << TASK_SHIFT
    waiting: list[tuple] = []

    def packed() -> list[tuple]:
        nonlocal number
        bins, offsets, used = best_fit(np.array([w[3] for w in waiting], dtype=np.int64), capacity)
        rows = [
            (*w, number + b, o, u)
            for w, b, o, u in zip(waiting, bins.tolist(), offsets.tolist(), used[bins].tolist())
        ]
        number += len(used)
        waiting.clear()
        return rows

    for part in parts:
        for key, raw in zip(part.column("doc_id").to_pylist(), part.column("body").to_pylist()):
            ids = np.array([*encode(text_of(raw)), end_id], dtype="<u4")
            for i, (start, length) in enumerate(cut(len(ids), capacity)):
                crc = zlib.crc32(ids[start : start + length].tobytes())
                waiting.append((key, i, start, length, crc))
                if len(waiting) >= block:
                    yield packed()
    if waiting:
        yield packed()


def local_bins(
    documents: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, block: int = BLOCK
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, its bin, its offset and the bin's used length."""
    bodies = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("body"))
    return map_texts(bodies, "body", _pieces, PIECES, path, end_id, capacity, block)


def _merged(items: DataFrame, capacity: int, block: int) -> DataFrame:
    """Best fit over the items (bin, used) of each task; a bin's number is that of its first item."""
    find_package(items)

    def pack(numbers: list[int], sizes: list[int]) -> pa.RecordBatch:
        bins, shifts, used = best_fit(np.array(sizes, dtype=np.int64), capacity)
        names = np.empty(len(used), dtype=np.int64)
        first = shifts == 0
        names[bins[first]] = np.array(numbers, dtype=np.int64)[first]
        rows = list(zip(numbers, names[bins].tolist(), shifts.tolist(), used[bins].tolist()))
        return batch_of(rows, MOVES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, sizes = [], []
        for batch in batches:
            numbers += batch.column("bin").to_pylist()
            sizes += batch.column("used").to_pylist()
            if len(sizes) >= block:
                yield pack(numbers, sizes)
                numbers, sizes = [], []
        if sizes:
            yield pack(numbers, sizes)

    return items.select("bin", "used").mapInArrow(run, "bin bigint, into bigint, shift bigint, used bigint")


def merged_bins(items: DataFrame, tasks: int, capacity: int = 1024, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """Per item (bin, used) of ``tasks`` tasks: bin, the bin it ends in (into) and its shift there.

    The tree of groups: bins that a level leaves nearly full are not passed on.
    """
    most = capacity - int(capacity * FREE_SHARE)
    open_bins = stored(items.filter(F.col("used") < most).select("bin", "used"), "open-bins")
    composed, groups, level = None, max(tasks, 1), 0
    while (count := open_bins.count()) > 1:
        before, groups, level = groups, max(-(-groups // fan_in), -(-count // block)), level + 1
        # Bins of neighbouring tasks are dealt out, so every group has items of all lengths.
        group = F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups))
        dealt = open_bins.withColumn("_group", group).repartition(groups, "_group").sortWithinPartitions("bin")
        moves = stored(_merged(dealt, capacity, block), "moves")
        step = moves.select("bin", "into", "shift")
        if composed is None:
            composed = step
        else:
            onward = step.select(F.col("bin").alias("into"), F.col("into").alias("_on"), F.col("shift").alias("_by"))
            composed = stored(
                composed.join(onward, "into", "left").select(
                    "bin", F.coalesce("_on", "into").alias("into"), (F.col("shift") + F.coalesce("_by", F.lit(0))).alias("shift")
                ),
                "composed",
            )
        if groups == 1 or (groups >= before and moves.filter("bin != into").isEmpty()):
            break
        left = moves.filter((F.col("bin") == F.col("into")) & (F.col("used") < most))
        open_bins = stored(left.select("bin", "used"), "open-bins")
    if composed is None:
        return open_bins.select("bin", F.col("bin").alias("into"), F.lit(0).cast("bigint").alias("shift"))
    return composed


def packed_sequences(
    documents: DataFrame, path: str, end_id: int = 2, capacity: int = 1024, block: int = BLOCK
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset in the sequence.

    ``path`` is the tokenizer's file, which every executor can read; ids come without special
    tokens, and ``end_id`` ends every document.
    """
    local = local_bins(documents, path, end_id, capacity, block)
    pieces = stored(local, "pieces")
    # A bin's first piece stands for it.
    heads = pieces.filter("offset = 0").select("bin", "used")
    tasks = heads.agg(F.count_distinct(F.shiftright("bin", TASK_SHIFT))).first()[0]
    moves = merged_bins(heads, tasks, capacity, block)
    return pieces.join(moves, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
