"""Spelling variants, packing and hard negatives against plain versions and on odd rows."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from tillgrain.llm import hard_negatives, packing, queries, spelling, suffix_matches, vector_tree
from tillgrain.llm.token_files import tokenizer

FOLDER = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


def documents(spark, rows):
    extra = "word string, n string, bin string, used string, key string, body string, _row string, id string"
    df = spark.createDataFrame([(*r, *["x"] * 8) for r in rows], f"doc_id bigint, text string, {extra}")
    return df.repartition(3)


# --- Spelling variants ---------------------------------------------------------------------


def test_spelling_of_the_table(spark, small):
    found = queries.queries()["op11_spelling_variants"](spark, FOLDER)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in found.collect()} == brute.spelling(small)


def test_spelling_of_odd_rows(spark):
    pick = random.Random(3)
    words = ["".join(pick.choice("abÀ÷") for _ in range(pick.randint(6, 9))) for _ in range(60)]
    longest = "q" * 30_000
    rows = [(i, " ".join(pick.choices(words, weights=range(1, 61), k=40))) for i in range(120)]
    rows += [(1, rows[1][1])] * 3 + [(None, "aaaaaab,aaaaaab AAAAAAB"), (None, None), (7, ""), (8, "short words only")]
    rows += [(1000 + i, f"{longest} {longest[1:]}x {longest}ÿ") for i in range(6)]
    assert {tuple(r) for r in spelling.variant_groups(documents(spark, rows)).collect()} == brute.spelling(rows)
    assert spelling.variant_groups(documents(spark, rows).limit(0)).count() == 0
    for symbols in (4, 9):  # the alphabet changes the work only
        again = spelling.variant_groups(documents(spark, rows), symbols)
        assert {tuple(r) for r in again.collect()} == brute.spelling(rows)


def test_forms_lead_to_the_root(spark):
    counts = {"colour": 3000, "colou": 2, "coulour": 400, "coulou": 60, "koulou": 9, "colours": 600}
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate(counts.items())]
    found = {r["word"]: r["root"] for r in spelling.variant_groups(documents(spark, rows)).collect()}
    wanted = {w: root for w, _, root, *_ in brute.spelling(rows)}
    assert found == wanted and found["koulou"] == "colour"


def test_neighbourhood_is_whole():
    symbols, powers = 5, spelling._powers(16)
    word = np.array([1, 5, 5, 2], dtype=np.uint64)
    around = {tuple(word)}
    for i in range(5):
        around |= {(*word[:i], s, *word[i:]) for s in range(1, 6)}
        if i < 4:
            around |= {(*word[:i], *word[i + 1 :])} | {(*word[:i], s, *word[i + 1 :]) for s in range(1, 6)}
    wanted = {int(spelling.reduced_number(np.array(w, dtype=np.uint64), powers)) for w in around}
    assert wanted == set(spelling.neighbourhood(word, powers, symbols).tolist())


# --- Packing ---------------------------------------------------------------------------------


def sequences_of(rows, capacity):
    """Used length of every sequence; fails where one has a gap, an overlap or is too long."""
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return {key: sum(n for _, n in found) for key, found in places.items()}


def as_pieces(rows):
    return sorted(
        ((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows),
        key=lambda p: (p[0] is not None, p),
    )


def test_packing_of_the_table(spark, small):
    rows = queries.queries()["op12_best_fit_packing"](spark, FOLDER).collect()
    wanted = brute.pieces(small, BYTE_BPE)
    assert as_pieces(rows) == sorted(wanted)
    used = sequences_of(rows, 1024)
    best = packing.best_fit(np.array([p[3] for p in wanted]), 1024)[2]
    assert len(used) <= len(best) + 1


def test_packing_of_odd_rows(spark):
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, "one"), (3, "one"), (None, "no id"), (None, None), (6, long), (7, " \t\n"), (8, "a" * 5000)]
    rows += [(9, "<|endoftext|> 's DON'T \x1c\x85\xa0 ﬁ 12345"), (10, " " * 3000)] + [(20 + i, "word " * (i % 50)) for i in range(200)]
    df = documents(spark, rows)
    for capacity, block in ((1024, 200_000), (64, 7), (1, 50)):
        found = packing.packed_sequences(df, BYTE_BPE, 2, capacity, block).collect()
        wanted = brute.pieces(rows, BYTE_BPE, 2, capacity)
        assert as_pieces(found) == sorted(wanted, key=lambda p: (p[0] is not None, p))
        sequences_of(found, capacity)
    assert packing.packed_sequences(df.limit(0), BYTE_BPE).count() == 0


@pytest.mark.parametrize("fan_in", [2, 16])
def test_bins_merge_up_the_tree(spark, fan_in):
    pick = np.random.default_rng(2)
    sizes = pick.integers(1, 1000, 3000).tolist() + [600] * 400 + [300] * 40
    items = spark.createDataFrame(list(enumerate(sizes)), "bin bigint, used bigint")
    rows = packing.merged_bins(items, tasks=9, block=500, fan_in=fan_in).collect()
    of = {r["bin"]: r for r in rows}
    finished = [s for s in sizes if s >= 1016]
    assert len(rows) == len(sizes) - len(finished)
    places = defaultdict(list)
    for key, size in enumerate(sizes):
        if key in of:
            places[of[key]["into"]].append((of[key]["shift"], size))
    for found in places.values():
        at = 0
        for shift, size in sorted(found):
            assert shift == at
            at += size
        assert at <= 1024
    best = packing.best_fit(np.array(sizes), 1024)[2]
    assert len(places) <= 1.02 * len(best) + 9


def test_best_fit_never_leaves_two_bins_that_fit_together():
    for seed in range(20):
        sizes = np.random.default_rng(seed).integers(1, 101, 200)
        bins, offsets, used = packing.best_fit(sizes, 100)
        assert used.tolist() == [int(sizes[bins == b].sum()) for b in range(len(used))]
        low = sorted(used)[:2]
        assert sum(low) > 100


def test_ranks_give_the_ids_of_the_library():
    pick, library = random.Random(1), tokenizer(BYTE_BPE)
    encode = packing.encoder(BYTE_BPE)
    for letters in ("ab", "=-", "etaoin shrdlu", " \n\t\r\x1c\x85\xa0 ​﻿ x1", "éèüßñ中", "'sStTrReE 0123"):
        for _ in range(500):
            text = "".join(pick.choice(letters) for _ in range(pick.randint(1, 30)))
            assert encode(text) == library.encode(text, add_special_tokens=False).ids
    assert packing._byte_ranks(WORD_BPE) is None
    assert packing.encoder(WORD_BPE)("Some words") == tokenizer(WORD_BPE).encode("Some words", add_special_tokens=False).ids


# --- Hard negatives --------------------------------------------------------------------------


def mined(spark, rows, kind="float", **settings):
    extra = "id string, label2 string, code string, components string, sampled string"
    df = spark.createDataFrame([(*r, *["x"] * 5) for r in rows], f"vec_id bigint, label int, embedding array<{kind}>, {extra}")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mined(df.repartition(3), F.col("id") % 100 == 0, label, **settings).collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


def test_hard_negatives_of_the_table(spark):
    folder = FOLDER.replace("0.001", "0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    found = {tuple(r) for r in queries.queries()["op13_hard_negatives"](spark, folder).collect()}
    assert found == brute.hard_negatives(rows) and found


def test_hard_negatives_of_odd_rows(spark):
    pick = np.random.default_rng(4)
    rows = [(i, int(pick.integers(0, 3)), pick.normal(size=12).tolist()) for i in range(1, 420)]
    rows += [(500 + i, 1, [1.0] * 12) for i in range(40)]  # ties
    rows += [(600, 1, [0.5] * 12), (700, 2, [0.0] * 12), (800, None, [1.0] * 12), (900, 1, None), (1000, 1, [])]
    rows += [(1100, 1, [1.0] * 11 + [None]), (1200, 1, [float("nan")] * 12), (1300, 1, [float("inf")] + [1.0] * 11)]
    rows += [(None, 1, [1.0] * 12), (1400, 1, [1.0, 2.0]), (1401, 1, [1.0, 1.0]), (1402, 2, [0.5, 0.5])]
    rows += [(1500, 1, [1e-9] * 12), (1501, 1, [-1e-9] * 12), (-100, 1, (pick.normal(size=12) * 50).tolist())]
    rows += [(1600, 4, pick.normal(size=12).tolist())]  # no positive
    wanted = brute.hard_negatives(rows)
    assert mined(spark, rows, "double") == wanted and wanted
    assert mined(spark, rows, "double", block_bytes=100) == wanted  # several passes
    large = [(2000, 1, [1e300] * 12), (2001, 1, [1e308] * 12), (2100, 2, [1e9] * 12)]
    assert mined(spark, rows + large, "double") == wanted
    assert mined(spark, [], "double") == set()


def test_intervals_hold_every_score():
    pick = np.random.default_rng(9)
    for dims in (1, 3, 64, 200):
        whole = np.floor(256 * pick.normal(size=(400, dims)) * pick.choice([0.01, 1, 30], (400, 1)))
        turned = hard_negatives.rotated(whole)
        length = np.sqrt(np.square(whole).sum(axis=1))
        assert np.allclose(np.sqrt(np.square(turned).sum(axis=1)), length)
        size = turned.shape[1]
        aligned = np.minimum(np.abs(turned).sum(axis=1) / np.sqrt(size) / np.where(length > 0, length, 1), 1)
        codes = np.packbits(turned > 0, axis=1, bitorder="little").view("<u8")
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        for i in range(40):
            anchor = hard_negatives._Prepared(
                hard_negatives.Wanted(i, 0, whole[i].astype(np.int64), [(0, 1)], [0])
            )
            low, high = anchor.interval(codes, ones, length, aligned)
            score = whole @ whole[i]
            assert (low <= score).all() and (score <= high).all()
            if dims == 64:
                assert np.mean(high - low) < 1.6 * np.mean(length * length[i])


# --- Longest matches and vector types --------------------------------------------------------


def test_longest_matches(spark, small):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    rows = sorted(small, key=lambda r: len(r[1] or ""))[:60]
    hot = [tuple(r) for r in items.select("item_id", "text").limit(8).collect()]
    rows += [(9000 + i, f"before words {t} behind {t[len(t) // 2:]} {t}") for i, (_, t) in enumerate(hot)]
    rows += [(1, None), (2, ""), (None, hot[0][1]), (9000, hot[1][1])]
    df = documents(spark, rows)
    few = spark.createDataFrame([*hot, (77, "a a a"), (78, None), (None, "before words")], items.select("item_id", "text").schema)
    tests = [tuple(r) for r in few.collect()]
    rows += [(3, "a a a a a")]
    df = documents(spark, rows)
    for block in (1 << 20, 400):
        found = {tuple(r) for r in suffix_matches.longest_matches(df, few, block_bytes=block).collect()}
        assert found == brute.longest_matches(rows, tests)
    assert suffix_matches.longest_matches(df.limit(0), few).count() == 0


def test_neighbours_of_doubles_keep_their_precision(spark):
    rows = [(20, [0.123456789012345, 0.3], "x"), (21, [0.123456789, 0.3], "x"), (40, [1.0, 0.0], "x"), (41, [0.5, 0.5], "x")]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, ids string")
    found = vector_tree.nearest(df, F.col("vec_id") == 40).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(41, 0.5), (20, 0.123456789012345), (21, 0.123456789)]
