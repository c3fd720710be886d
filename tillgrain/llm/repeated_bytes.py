"""Removal of long repeated byte strings by distributed prefix doubling over anchored positions.

Classical prefix doubling ranks every position by its first h bytes, then by pairs of ranks at
growing offsets, until ranks are unique or h passes the threshold. One row per byte and round is
many times the text, so here positions are ranked in runs that share an anchor:

* The anchor of a ``length``-byte string is its least ``GRAM``-byte hash, leftmost first. Equal
  strings have equal anchors at equal distance, and neighbouring strings mostly share theirs, so
  a text has one run of positions per 140 bytes or so. Runs are cut into blocks of ``BLOCK``
  distances.
* A block's first rank is the hash of its core, the bytes all its strings have in common. Spark
  groups by it; what is unique is dropped, for no string of the block occurs elsewhere.
* Blocks whose whole content (all bytes of all their strings) occurs twice are settled: all their
  strings are repeated. One of them stays to compare others with.
* Where a core has several contents, blocks are halved and reranked by the pair (rank of the core,
  bytes by which the half's core grows), until every string has been found unique, found repeated,
  or has grown to full length, where core and content are one.

Hashes are combined before shuffles, so a passage that a third of all rows share is a count in
every task, and the joins that bring ranks back to positions are plain joins whose hot keys Spark
splits. Texts meet their results by (id, hash of the text). Ranks are two 64-bit hashes.

Defined cases: a NULL text is empty; texts shorter than ``length`` lose nothing; rows that share
id and text count as separate occurrences and lose the same bytes; NULL ids stay rows of their
own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import Passing, append_columns, as_bytes, map_texts, stored

LENGTH = 400
GRAM = 16
BLOCK = 128
_FIELD = 20  # bits of either distance beside the anchor's place
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)

KEYS = ["k1", "k2"]
BLOCKS = [
    ("core", pa.int64(), "bigint"), ("content", pa.int64(), "bigint"),
    ("k1", pa.int64(), "bigint"), ("k2", pa.int64(), "bigint"), ("anchor", pa.int64(), "bigint"),
    ("low", pa.int32(), "int"), ("high", pa.int32(), "int"),
]
CONTEXTS = [
    ("core", pa.int64(), "bigint"), ("settled", pa.bool_(), "boolean"),
    ("k1", pa.int64(), "bigint"), ("k2", pa.int64(), "bigint"), ("anchor", pa.int64(), "bigint"),
    ("low", pa.int32(), "int"), ("high", pa.int32(), "int"),
    ("before", pa.binary(), "binary"), ("after", pa.binary(), "binary"),
]
KEPT = [
    ("_bytes", pa.int64(), "bigint"), ("_removed", pa.int64(), "bigint"), ("_spans", pa.int64(), "bigint"),
    ("_kept", pa.binary(), "binary"), ("_sha256", pa.string(), "string"),
]


def anchor_runs(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all ``length``-byte strings of a text, with their first and last start."""
    width = length - GRAM + 1
    grams = len(raw) - GRAM + 1
    words = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    mixed = (words[:grams] * _MIX) ^ (words[8 : 8 + grams] * _MIX2)
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    # Hash above, place below: the least is the least hash, leftmost first.
    least = (mixed & _HIGH) | np.arange(grams, dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    anchors = (least & _LOW).astype(np.int64)
    cuts = np.flatnonzero(np.diff(anchors)) + 1
    first = np.concatenate([[0], cuts])
    last = np.concatenate([cuts, [len(anchors)]]) - 1
    return anchors[first], first, last


def _block_end(low: int, length: int) -> int:
    return min(low - low % BLOCK + BLOCK - 1, length - GRAM)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _blocks(parts: Iterator[pa.RecordBatch], length: int):
    digest = xxhash.xxh3_64_intdigest
    for part in parts:
        rows = []
        keys = zip(part.column("k1").to_pylist(), part.column("k2").to_pylist())
        for (k1, k2), raw in zip(keys, part.column("body").to_pylist()):
            if len(raw) < length:
                continue
            for anchor, first, last in zip(*(x.tolist() for x in anchor_runs(raw, length))):
                low, top = anchor - last, anchor - first
                while low <= top:
                    base, end = low - low % BLOCK, _block_end(low, length)
                    high = min(end, top)
                    core = digest(raw[anchor - base : anchor + length - end], base)
                    content = digest(raw[anchor - high : anchor + length - low], low << _FIELD | high)
                    rows.append((_signed(core), _signed(content), k1, k2, anchor, low, high))
                    low = high + 1
            if len(rows) > 50_000:
                yield rows
                rows = []
        yield rows


def _contexts(parts: Iterator[pa.RecordBatch], length: int):
    for part in parts:
        rows = []
        row = part.column("row")
        columns = [row.field(n).to_pylist() for n in ("k1", "k2", "wanted")]
        for raw, k1, k2, wanted in zip(part.column("body").to_pylist(), *columns):
            for w in wanted:
                anchor, low, high = w["anchor"], w["low"], w["high"]
                base, end = low - low % BLOCK, _block_end(low, length)
                before = raw[anchor - high : anchor - base]
                after = raw[anchor + length - end : anchor + length - low]
                rows.append((w["core"], w["settled"], k1, k2, anchor, low, high, before, after))
        yield rows


def _keyed(documents: DataFrame) -> DataFrame:
    body = as_bytes()
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body"),
        F.xxhash64(F.col("doc_id").cast("bigint"), body).alias("k1"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)).alias("k2"),
    )


def _ranked(blocks: DataFrame) -> DataFrame:
    """Contents of shared cores: core, content, n (blocks with it), kinds (contents of the core).

    Both sides of the join are stored, so Spark can split a core with very many contents.
    """
    passing = Passing(blocks.sparkSession)
    contents = passing.stored(
        blocks.groupBy("core", "content").agg(F.count(F.lit(1)).alias("n")), "contents"
    )
    cores = contents.groupBy("core").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
    shared = passing.stored(cores.filter("all > 1").select("core", "kinds"), "shared-cores")
    ranked = stored(contents.join(shared, "core"), "ranks")
    passing.drop()
    return ranked


def _half(items: DataFrame, size: int, length: int, right: bool) -> DataFrame:
    """Items cut to one half of their block of ``size`` distances, with rank and content anew.

    ``before`` holds the bytes from the farthest string's start to the block's core, ``after``
    those from the core to the nearest string's end.
    """
    half = size // 2
    base = F.col("low") - F.col("low") % size
    end = F.least(base + size - 1, F.lit(length - GRAM))
    start = base + (half if right else 0)
    stop = F.least(start + half - 1, F.lit(length - GRAM))
    low, high = F.greatest("low", start), F.least("high", stop)
    # The half's core grows by these bytes of either side.
    grown_before, grown_after = start - base, end - stop
    n_before = F.length("before")
    cut = items.filter(low <= high).select(
        "core", "settled", *KEYS, "anchor", low.alias("new_low"), high.alias("new_high"),
        "before", "after", n_before.alias("nb"),
        grown_before.alias("gb"), grown_after.alias("ga"), start.alias("start"), stop.alias("stop"),
    )
    nb = F.col("nb")
    core_before = F.substring("before", nb - F.col("gb") + 1, F.col("gb"))
    core_after = F.substring("after", F.lit(1), F.col("ga"))
    left = F.col("new_high") - F.col("start")
    rest_before = F.substring("before", nb - F.col("gb") - left + 1, left)
    right_bytes = F.col("stop") - F.col("new_low")
    rest_after = F.substring("after", F.col("ga") + 1, right_bytes)
    return cut.select(
        F.xxhash64("core", "start", "stop", core_before, core_after).alias("core"),
        F.xxhash64("new_low", "new_high", rest_before, rest_after).alias("content"),
        "settled", *KEYS, "anchor", F.col("new_low").alias("low"), F.col("new_high").alias("high"),
        rest_before.alias("before"), rest_after.alias("after"),
    )


def repeated_starts(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of starts of repeated strings: k1, k2, first, last; runs of one text may touch."""
    keyed = _keyed(documents)
    blocks = map_texts(keyed.select(*KEYS, "body"), "body", _blocks, BLOCKS, length)
    ranked = _ranked(blocks.select("core", "content"))
    passing = Passing(documents.sparkSession)
    # Places of contents that are repeated or share their core with others; texts are read again.
    places = passing.stored(blocks.join(ranked, ["core", "content"]).filter("n > 1 or kinds > 1"), "places")
    starts = [(F.col("anchor") - F.col("high")).alias("first"), (F.col("anchor") - F.col("low")).alias("last")]
    found = [stored(places.filter("n > 1").select(*KEYS, *starts), "starts")]
    one = F.min(F.struct("k1", "k2", "anchor", "low", "high")).alias("one")
    wanted = (
        places.filter("kinds > 1").groupBy("core", "content").agg(one, F.max(F.col("n") > 1).alias("settled"))
        .groupBy("one.k1", "one.k2")
        .agg(F.collect_list(F.struct("core", "settled", "one.anchor", "one.low", "one.high")).alias("wanted"))
    )
    asked = keyed.select(*KEYS, "body").join(wanted, KEYS)
    items = stored(_context_rows(asked, length).dropDuplicates(["k1", "k2", "anchor", "low"]), "contexts")
    passing.drop()
    size = BLOCK
    while size > 1 and not items.isEmpty():
        halves = stored(
            _half(items, size, length, False).unionByName(_half(items, size, length, True)), "halves"
        )
        ranks = _ranked(halves.select("core", "content"))
        seen = stored(halves.join(ranks, ["core", "content"]).filter("n > 1 or kinds > 1"), "ranked")
        found.append(stored(seen.filter("n > 1 and not settled").select(*KEYS, *starts), "starts"))
        rest = seen.filter("kinds > 1")
        row = F.struct("k1", "k2", "anchor", "low", "high", "before", "after")
        items = stored(
            rest.groupBy("core", "content").agg(F.min(row).alias("row"), F.max(F.col("settled") | (F.col("n") > 1)).alias("settled"))
            .select("core", "settled", "row.*"),
            "items",
        )
        size //= 2
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _context_rows(asked: DataFrame, length: int) -> DataFrame:
    packed = asked.select(F.struct(*KEYS, "wanted").alias("row"), "body")
    return map_texts(packed, "body", _contexts, CONTEXTS, length)


def _remove(parts: Iterator[pa.RecordBatch], length: int, keep: bool):
    for part in parts:
        rows = []
        for raw, runs in zip(part.column("body").to_pylist(), part.column("row").field("_runs").to_pylist()):
            spans: list[list[int]] = []
            for run in sorted((r["first"], r["last"] + length) for r in runs or ()):
                if spans and run[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], run[1])
                else:
                    spans.append(list(run))
            pieces, at = [], 0
            for start, end in spans:
                pieces.append(raw[at:start])
                at = end
            kept = b"".join([*pieces, raw[at:]])
            rows.append(
                (len(raw), len(raw) - len(kept), len(spans), kept if keep else None, hashlib.sha256(kept).hexdigest())
            )
        yield rows


def with_repeats_removed(documents: DataFrame, length: int = LENGTH, keep: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if ``keep``, the bytes left (``kept``)."""
    runs = (
        repeated_starts(documents, length)
        .groupBy(*KEYS).agg(F.collect_set(F.struct("first", "last")).alias("_runs"))
    )
    joined = _keyed(documents).join(runs, KEYS, "left").select("doc_id", F.col("body").alias("_body"), "_runs")
    found = append_columns(joined, F.col("_body"), _remove, KEPT, length, keep)
    columns = {"_bytes": "n_bytes", "_removed": "n_removed", "_spans": "n_spans", "_sha256": "kept_sha256"}
    return found.select(
        "doc_id", *[F.col(a).alias(b) for a, b in columns.items()], *([F.col("_kept").alias("kept")] if keep else [])
    )
