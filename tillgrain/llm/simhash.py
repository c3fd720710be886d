"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints are 64-bit SimHashes over word shingles. Pairs within the Hamming budget are found
by walking a trie of the distinct fingerprints with itself, level by level: a row is a pair of
nodes of equal depth and the number of bits in which their paths differ. A level replaces each
pair by the pairs of its children and drops those beyond the budget. Leaves that remain are links.

Walking from the root would visit every pair of short prefixes within the budget, so there are
``budget + 1`` tries, each with another block of bits first: of two fingerprints within the
budget at least one block is equal, and in that trie the walk stays on one path up to the end of
the block. Each trie is walked from there, from nodes with at least two fingerprints. A level
has at most 256 children per node, and a node has few others within the budget, so no task
receives all pairs of a group.

Components are minima over links, with pointer jumping, on tables in the shared folder.

Defined cases: a NULL or wordless text has fingerprint zero and is linked like any other; equal
fingerprints are one trie leaf, so copies are never paired with each other; NULL ids do not name
a component unless it has no other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import append_columns, as_bytes, map_texts, packed, stored

BITS = 64
HASH_SEED = 42
#: Bits by which one level of the walk goes down.
LEVEL_BITS = 8

FINGERPRINTS = [("doc_id", pa.int64(), "bigint"), ("bits", pa.int64(), "bigint")]


def shingle_hashes(raw: bytes, words: int) -> list[int]:
    """XXH64 of the word shingles; bytes.lower() and bytes.split() touch ASCII only."""
    found = raw.lower().split()
    if not found:
        return []
    if len(found) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(found), HASH_SEED)]
    runs = zip(*(found[i:] for i in range(words)))
    return [xxhash.xxh64_intdigest(s, HASH_SEED) for s in map(b" ".join, runs)]


def _fingerprint(hashes: list[int]) -> int:
    """Signed 64-bit number whose bit i is set where over half of the hashes have bit i."""
    if not hashes:
        return 0
    raw = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, BITS // 8)
    ones = np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(parts: Iterator[pa.RecordBatch], words: int):
    for part in parts:
        yield [
            (key, _fingerprint(shingle_hashes(raw, words)))
            for key, raw in zip(part.column("doc_id").to_pylist(), part.column("body").to_pylist())
        ]


def _row_prints(parts: Iterator[pa.RecordBatch], words: int):
    for part in parts:
        yield [(_fingerprint(shingle_hashes(raw, words)),) for raw in part.column("body").to_pylist()]


def fingerprints(documents: DataFrame, words: int) -> DataFrame:
    """doc_id and the fingerprint as a signed number, ``bits``."""
    bodies = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("body"))
    return map_texts(bodies, "body", _fingerprints, FINGERPRINTS, words)


def _rotated(bits: Column, by: int) -> Column:
    if by == 0:
        return bits
    return F.shiftleft(bits, by).bitwiseOR(F.shiftrightunsigned(bits, BITS - by))


def _prefix(key: Column, depth: int) -> Column:
    return key if depth == BITS else F.shiftrightunsigned(key, BITS - depth)


def links(distinct: DataFrame, budget: int) -> DataFrame:
    """Pairs a < b of values of ``bits`` that differ in 1 to ``budget`` bits, each pair once."""
    block = BITS // (budget + 1)
    starts = [i * block for i in range(budget + 1)]
    rotations = F.array(
        *[F.struct(F.lit(i).alias("trie"), _rotated(F.col("bits"), s).alias("key"))
          for i, s in enumerate(starts)]
    )
    keys = distinct.select(F.inline(rotations)).withColumn("node", _prefix(F.col("key"), block))
    shared = keys.groupBy("trie", "node").count().filter("count > 1").select("trie", "node")
    live = stored(keys.join(shared, ["trie", "node"]).select("trie", "key", "node"), "trie")
    pairs = live.select(
        "trie", F.col("node").alias("a"), F.col("node").alias("b"), F.lit(0).alias("errors")
    ).distinct()
    depth = block
    while depth < BITS:
        # Close to the leaves few nodes have several children, so the last step takes the rest.
        lower = depth + LEVEL_BITS if depth + LEVEL_BITS + 4 < BITS else BITS
        children = live.groupBy(
            "trie", _prefix(F.col("key"), depth).alias("node"), _prefix(F.col("key"), lower).alias("child")
        ).agg(F.count(F.lit(1)).alias("leaves"))
        left = children.select("trie", F.col("node").alias("a"), F.col("child").alias("ca"), "leaves")
        right = children.select("trie", F.col("node").alias("b"), F.col("child").alias("cb"))
        below = F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit((1 << (lower - depth)) - 1))
        errors = (F.col("errors") + F.bit_count(below)).cast("int")
        ordered = (F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb"))
        # A node paired with itself is worth keeping only while it has two leaves.
        alone = (F.col("ca") == F.col("cb")) & (F.col("leaves") == 1)
        pairs = (
            pairs.join(left, ["trie", "a"])
            .join(right, ["trie", "b"])
            .filter(ordered & ~alone & (errors <= budget))
            .select("trie", F.col("ca").alias("a"), F.col("cb").alias("b"), errors.alias("errors"))
        )
        depth = lower
    back = F.lit(None).cast("bigint")
    ends = {}
    for side in ("a", "b"):
        value = back
        for i, s in enumerate(starts):
            value = F.when(F.col("trie") == i, _rotated(F.col(side), (BITS - s) % BITS)).otherwise(value)
        ends[side] = value
    return (
        pairs.filter("errors > 0")
        .select(F.least(ends["a"], ends["b"]).alias("a"), F.greatest(ends["a"], ends["b"]).alias("b"))
        .distinct()
    )


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``root``, the least vertex of its component; edges have columns a and b.

    Each round takes the least root among the neighbours, hands it to the former root as well,
    and jumps to the root's root, so long chains shrink by a factor in every round.
    """
    both = stored(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "links",
    )
    roots = stored(
        both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.col("vertex"), F.min("b")).alias("root")),
        "roots",
    )
    while True:
        near = (
            both.join(roots, both["b"] == roots["vertex"])
            .groupBy(F.col("a").alias("vertex")).agg(F.min("root").alias("near"))
        )
        offered = stored(
            roots.join(near, "vertex").select("vertex", "root", F.least("root", "near").alias("near")),
            "offers",
        )
        hooked = stored(
            offered.select("vertex", F.col("near").alias("root"))
            .unionByName(offered.filter("near < root").select(F.col("root").alias("vertex"), F.col("near").alias("root")))
            .groupBy("vertex").agg(F.min("root").alias("root")),
            "hooked",
        )
        above = hooked.select(F.col("vertex").alias("root"), F.col("root").alias("top"))
        jumped = stored(
            hooked.join(above, "root").select("vertex", F.least("root", "top").alias("root")), "roots"
        )
        changed = roots.join(jumped.withColumnRenamed("root", "now"), "vertex").filter("root != now")
        if changed.isEmpty():
            return jumped
        roots = jumped


def _components(prints: DataFrame, budget: int) -> DataFrame:
    """Per distinct fingerprint: bits, first (least id) and root, one fingerprint per component."""
    distinct = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct")
    found = stored(links(distinct.select("bits"), budget), "pairs")
    if found.isEmpty():
        return distinct.withColumn("root", F.col("bits"))
    roots = smallest_reachable(found).withColumnRenamed("vertex", "bits")
    return stored(
        distinct.join(roots, "bits", "left").select(
            "bits", "first", F.coalesce("root", "bits").alias("root")
        ),
        "components",
    )


def near_duplicates(documents: DataFrame, words: int = 5, budget: int = 2) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (least reachable id)."""
    prints = stored(fingerprints(documents, words), "fingerprints")
    known = _components(prints, budget)
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    components = stored(known.join(least, "root").select("bits", "component_id"), "component-ids")
    return prints.join(components, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(documents: DataFrame, words: int = 5, budget: int = 2) -> DataFrame:
    """``documents`` with one row of every component: that of the least id.

    Rows that share this id and its fingerprint count as one.
    """
    rows = packed(documents, "doc_id", "text").withColumn("_id", F.col("doc_id").cast("bigint"))
    rows = append_columns(rows.drop("doc_id"), as_bytes(), _row_prints, [("_bits", pa.int64(), "bigint")], words)
    prints = stored(rows.select(F.col("_id").alias("doc_id"), F.col("_bits").alias("bits")), "fingerprints")
    known = _components(prints, budget)
    one = F.min(F.struct(F.col("first").isNull(), "first", F.col("bits").alias("print"))).alias("one")
    stays = known.groupBy("root").agg(one).select("one.first", "one.print")
    kept = rows.select("_row", "_id", "_bits").join(stays, (F.col("_bits") == F.col("print")) & F.col("_id").eqNullSafe(F.col("first")))
    return kept.dropDuplicates(["_id", "_bits"]).select("_row.*")
