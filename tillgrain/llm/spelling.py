"""Spelling variants of a corpus by neighbourhoods over a reduced alphabet.

The letters of a word are hashed to a few symbols, so words become strings over a small alphabet
whose whole one-edit neighbourhood is small. Of two words that differ by one inserted, deleted or
replaced letter, the reduced ones differ by one edit at most; so the reduced form of the one lies
in the other's neighbourhood: itself, all deletions, replacements and insertions. Neighbourhoods
are joined with the reduced vocabulary, and the pairs found are verified on the words themselves.

A reduced string is known by a polynomial number modulo 2^64, from which the number of each of
its neighbours follows at once; so a word of n letters costs n times the symbols, not n squared.
Numbers that meet by chance, and words that only share their symbols, are sorted out by a mask of
the letters that occur an odd number of times (one edit changes two of them at most) and then by
the words.

Counting is combined per task before the shuffle, by word, so a hot word or document is spread.
The number of symbols grows with the vocabulary, so that the words of the least length have about
as many reduced forms as there are words.

Defined cases: a NULL or empty text has no words; a NULL id is written as nothing before the
colon when a run is hashed; repeated rows count as often as they occur; ties go to the smallest
word in code-point order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import SLICE_BYTES, as_bytes, batch_of, find_package, map_texts, slices, stored, text_of

#: Code points of the least word, and its least number of occurrences.
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: One run in this many loses a code point when ``worn`` counts.
WORN = 199
#: A form is this many times as frequent as its variant.
FORM_RATIO = 5
#: Distinct words that a task counts before it passes the counts on.
COUNTED_WORDS = 500_000
#: Neighbours in one batch from a task.
BATCH_NEIGHBOURS = 1 << 18
#: Odd multiplier of the polynomial, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

COUNTS = [("word", pa.string(), "string"), ("n", pa.int64(), "bigint")]
REDUCED = pa.schema([("number", pa.int64()), ("id", pa.int64()), ("mask", pa.int64())])
REDUCED_DDL = "number bigint, id bigint, mask bigint"


def _count(parts: Iterator[pa.RecordBatch], least: int, worn: int, held: int):
    """Counts of the words of the texts; a worn run may lose its length, so runs of it are enough."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least).findall
    found: Counter[str] = Counter()
    for part in parts:
        for key, raw in zip(part.column("key").to_pylist(), part.column("body").to_pylist()):
            words = Counter(runs(text_of(raw.lower())))  # bytes.lower() touches ASCII only
            if worn:
                start, changed = zlib.crc32(f"{key or ''}:".encode()), {}
                for word in words:
                    h = zlib.crc32(word.encode(), start)
                    if h % worn == 0:
                        changed[word] = h % len(word)
                # A worn word may be equal to one that stays, so all leave before any comes back.
                taken = [(w, at, words.pop(w)) for w, at in changed.items()]
                for word, at, n in taken:
                    if len(word) > least:
                        words[word[:at] + word[at + 1 :]] += n
            found.update(words)
        if len(found) > held:
            yield list(found.items())
            found = Counter()
    if found:
        yield list(found.items())


def vocabulary(
    documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, worn: int = WORN
) -> DataFrame:
    """Words of the texts (word, n, id): runs of Latin letters, A-Z in lower case.

    With ``worn``, a run whose crc32 behind its document's id is divisible by it loses one code
    point; 0 leaves all runs as they are.
    """
    bodies = documents.select(F.col("doc_id").cast("string").alias("key"), as_bytes().alias("body"))
    counts = map_texts(bodies, "body", _count, COUNTS, least_length, worn, COUNTED_WORDS)
    frequent = counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)
    # Written once, so every word keeps the id of the attempt that was kept.
    return stored(frequent.withColumn("id", F.monotonically_increasing_id()), "vocabulary")


def symbols_for(words: int, least_length: int = LEAST_LENGTH) -> int:
    """Least alphabet with at least as many strings of the least length as there are words."""
    return max(4, math.ceil(max(words, 1) ** (1 / least_length)))


def _symbol_table(symbols: int) -> np.ndarray:
    """Symbol, from 1, of every code point below 256 by its hash."""
    return np.array([1 + zlib.crc32(bytes([c])) % symbols for c in range(256)], dtype=np.uint64)


def _mask_table() -> np.ndarray:
    """A bit for every code point below 256; letters from a to z do not share theirs."""
    bit = [(c - 97) if 97 <= c < 123 else 26 + c % 38 for c in range(256)]
    return np.uint64(1) << np.array(bit, dtype=np.uint64)


def _powers(count: int) -> np.ndarray:
    """1, BASE, BASE^2, ... modulo 2^64."""
    steps = np.full(count, BASE, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def reduced_number(word: np.ndarray, powers: np.ndarray) -> np.uint64:
    return (word * powers[: len(word)]).sum(dtype=np.uint64)


def neighbourhood(word: np.ndarray, powers: np.ndarray, symbols: int) -> np.ndarray:
    """Numbers of a reduced word and of all strings one edit away from it, each once."""
    n, alphabet = len(word), np.arange(1, symbols + 1, dtype=np.uint64)
    before = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * powers[:n], dtype=np.uint64)])
    whole = before[-1]
    deleted = before[:-1] + (whole - before[1:]) * np.uint64(INVERSE)
    replaced = whole + (alphabet[None, :] - word[:, None]) * powers[:n, None]
    inserted = (before + (whole - before) * np.uint64(BASE))[:, None] + alphabet[None, :] * powers[: n + 1, None]
    return np.unique(np.concatenate([deleted, replaced.ravel(), inserted.ravel(), [whole]]).astype(np.uint64))


def _reduced(words: DataFrame, symbols: int, spread: bool) -> DataFrame:
    """Per word its reduced number, or with ``spread`` those of its neighbourhood: number, id, mask."""
    find_package(words)
    packed = words.select("id", F.col("word").cast("binary").alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, masks, powers = _symbol_table(symbols), _mask_table(), _powers(64)

        def flushed(numbers: list[np.ndarray], ids: list[int], kept: list[int]) -> pa.RecordBatch:
            sizes = [len(x) for x in numbers]
            columns = [
                np.concatenate(numbers).view(np.int64),
                np.repeat(np.array(ids, dtype=np.int64), sizes),
                np.repeat(np.array(kept, dtype=np.uint64).view(np.int64), sizes),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=REDUCED)

        for part in slices(batches, "body", SLICE_BYTES):
            numbers, ids, kept, held = [], [], [], 0
            for key, raw in zip(part.column("id").to_pylist(), part.column("body").to_pylist()):
                codes = np.frombuffer(text_of(raw).encode("latin-1"), dtype=np.uint8)
                if len(codes) >= len(powers):
                    powers = _powers(2 * len(codes))
                word = table[codes]
                numbers.append(
                    neighbourhood(word, powers, symbols) if spread else np.array([reduced_number(word, powers)])
                )
                ids.append(key)
                kept.append(int(np.bitwise_xor.reduce(masks[codes])))
                held += len(numbers[-1])
                if held >= BATCH_NEIGHBOURS:
                    yield flushed(numbers, ids, kept)
                    numbers, ids, kept, held = [], [], [], 0
            if ids:
                yield flushed(numbers, ids, kept)

    return packed.mapInArrow(run, REDUCED_DDL)


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """Pairs (id a, id b) of ``words`` (word, n, id) that differ by exactly one edit, each pair once."""
    symbols = symbols or symbols_for(words.count())
    # Stored words lie in few files; their neighbourhoods are a hundred times as large.
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = words.repartition(tasks, "id")
    plain = _reduced(words, symbols, False).select("number", F.col("id").alias("b"), F.col("mask").alias("mask_b"))
    spread = _reduced(words, symbols, True).select("number", F.col("id").alias("a"), "mask")
    # Both neighbourhoods hold the other's reduced word: the pair is taken from one side.
    few = F.bit_count(F.col("mask").bitwiseXOR(F.col("mask_b"))) <= 2
    met = stored(spread.join(plain, "number").filter((F.col("a") < F.col("b")) & few).select("a", "b"), "candidates")
    one = words.select(F.col("id").alias("a"), F.col("word").alias("word_a"))
    two = words.select(F.col("id").alias("b"), F.col("word").alias("word_b"))
    return (
        met.join(one, "a").join(two, "b")
        .filter(F.levenshtein("word_a", "word_b", 1) == 1)
        .select("a", "b")
    )


def _last_forms(forms: DataFrame) -> DataFrame:
    """``id`` and ``root`` for every row of ``forms`` (id, form_id): where the forms lead in the end.

    Each round jumps to the form's own last known form; counts rise by ``FORM_RATIO`` along a
    chain, so it has no circles and few links.
    """
    roots = stored(forms.select("id", F.col("form_id").alias("root")), "forms")
    while True:
        onward = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        jumped = stored(
            roots.join(onward, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "roots",
        )
        if jumped.filter("moved").isEmpty():
            return jumped.select("id", "root")
        roots = jumped.select("id", "root")


def variant_groups(documents: DataFrame, symbols: int | None = None) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root, as the module says."""
    words = vocabulary(documents)
    pairs = stored(near_words(words, symbols), "near-words")
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("id"), F.col("a").alias("other"))
    )
    others = words.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("order"), "near", "other")).alias("best")
    nearest = stored(
        both.join(others, "other").groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best), "nearest"
    )
    form_n = -F.col("best.order")
    is_form: Column = form_n >= F.lit(FORM_RATIO) * F.col("n")
    found = stored(
        words.join(nearest, "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, form_n).alias("form_n"),
            F.when(is_form, F.col("best.other")).alias("form_id"),
        ),
        "word-forms",
    )
    roots = _last_forms(found.filter("form_id is not null").select("id", "form_id"))
    names = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    last = roots.join(names, "root").select("id", F.col("root_word"))
    return found.join(last, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"
    )
