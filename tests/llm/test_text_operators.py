"""Operators against brute-force versions: on the small tables and on rows with every odd case."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from tillgrain.llm import byte_bpe, language, queries, repeated_bytes, simhash, suffix_matches
from tillgrain.llm import surrogates, token_files, toxicity, vector_tree, wrappers

FOLDER = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
KEY = b"test"


def tuples(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return [tuple(r) for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    """NULLs, empty and very long texts, ties, repeated rows and clashing extra columns."""
    long = " ".join(f"w{i * 7919 % 5003}" for i in range(40_000))
    copied = "Some words that many texts share, again and again. " * 20
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (4, "one"), (5, "one two"), (None, "no id"), (None, None),
        (6, long), (7, copied), (8, copied + "tail"), (9, "head" + copied), (10, "Ünïcödé ÀÉ 'S don't 𝔘 \x1c x y"),
        (11, "a\x00b <|endoftext|> 123 ,,.. "), (12, copied), (13, "ber " * 3000),
    ]
    extra = "_bits bigint, _row string, body string, row string, n_words string, _text string, found string, key string"
    df = spark.createDataFrame([(*r, 1, *["x"] * 7) for r in rows], f"doc_id bigint, text string, {extra}")
    return df.repartition(3), rows


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


ITEMS = [(1, None), (2, ""), (3, "one"), (4, "words that many texts share again and again some words that many texts"), (3, "one"), (None, "one"), (5, "absent words only here")]


def test_simhash(spark, small, odd, empty):
    found = queries.queries()["op1_simhash"](spark, FOLDER)
    assert tuples(found, "doc_id", "fingerprint", "component_id") == brute.simhash(small)
    df, rows = odd
    known = [r for r in rows if r[0] is not None]
    got = simhash.near_duplicates(df.filter("doc_id is not null"), 3, 2)
    assert tuples(got, "doc_id", "fingerprint", "component_id") == brute.simhash(known)
    assert simhash.near_duplicates(df, 3, 2).count() == len(rows)
    assert simhash.near_duplicates(empty).count() == 0


def test_links_within_the_budget_on_dense_fingerprints(spark):
    pick = np.random.default_rng(5)
    centre = pick.integers(-(2**63), 2**63 - 1, dtype=np.int64)
    values = {int(centre ^ np.int64(sum({1 << int(b) for b in pick.integers(0, 40, 3)}))) for _ in range(400)}
    values |= {0, -1, 1, 3, 7, -(2**63), 2**63 - 1}
    array = np.array(sorted(values), dtype=np.int64)
    wanted = {
        (int(a), int(b)) for i, a in enumerate(array) for b in array[i + 1 :]
        if np.bitwise_count(np.uint64(np.int64(a ^ b).view(np.uint64))) <= 2
    }
    df = spark.createDataFrame([(v,) for v in sorted(values)], "bits bigint")
    found = [tuple(r) for r in simhash.links(df, 2).select("a", "b").collect()]
    assert len(found) == len(set(found)) and set(found) == wanted


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 102), (200, 100)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = dict(tuples(simhash.smallest_reachable(df), "vertex", "root"))
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100, 200: 100}


def test_one_document_of_each_group_stays(spark, odd):
    df, rows = odd
    kept = simhash.deduplicated(df, 5, 2)
    assert kept.columns == df.columns
    wanted = {c for _, _, c in brute.simhash([r for r in rows if r[0] is not None], 5)}
    ids = [r["doc_id"] for r in kept.filter("doc_id is not null").collect()]
    assert len(ids) == len(set(ids)) and set(ids) <= wanted


def test_decontamination(spark, small, odd, empty):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries.queries()["op3_decontamination"](spark, FOLDER)
    assert tuples(found, *columns) == brute.decontamination(small, items)
    df, rows = odd
    tests = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = suffix_matches.match_digests(df, tests)
    assert got.count() == len(rows)
    assert tuples(got, *columns) == brute.decontamination(rows, ITEMS)
    bad = {r[0] for r in brute.decontamination(rows, ITEMS) if r[5]}
    kept = suffix_matches.decontaminated(df, tests)
    assert kept.columns == df.columns and bad
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows} - bad
    assert suffix_matches.match_digests(df, tests.limit(0)).filter("contaminated").isEmpty()
    assert suffix_matches.match_digests(empty, tests).count() == 0


def test_test_sets_larger_than_a_block(spark, odd):
    df, rows = odd
    tests = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    whole = suffix_matches.with_matches(df.select("doc_id", "text"), tests)
    parts = suffix_matches.with_matches(df.select("doc_id", "text"), tests, block_bytes=20)
    columns = ["doc_id", "_n_words", F.col("_starts").cast("string"), F.col("_ends").cast("string"), F.array_sort(F.array_distinct("_items")).cast("string")]
    assert tuples(parts, *columns) == tuples(whole, *columns)


def test_byte_bpe(spark, small, odd, empty):
    columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    found = queries.queries()["op5_byte_bpe"](spark, FOLDER)
    assert tuples(found, *columns) == brute.byte_bpe(small, BYTE_BPE, public_tokenizers.PATTERN)
    df, rows = odd
    got = byte_bpe.encoded_digests(df, BYTE_BPE, public_tokenizers.PATTERN)
    assert got.count() == len(rows)
    assert tuples(got, *columns) == brute.byte_bpe(rows, BYTE_BPE, public_tokenizers.PATTERN)
    back = byte_bpe.encode_documents(df, BYTE_BPE, public_tokenizers.PATTERN).select("doc_id", "decoded").collect()
    assert sorted(map(str, back)) == sorted(str(type(back[0])(doc_id=i, decoded=t or "")) for i, t in rows)
    assert byte_bpe.encoded_digests(empty, BYTE_BPE, public_tokenizers.PATTERN).count() == 0


def test_perfect_hash_is_minimal_and_complete():
    keys = [f"key{i}".encode() for i in range(3000)]
    table = byte_bpe.PerfectHash(keys, list(range(3000)))
    assert len(table.keys) == 3000 and None not in table.keys
    assert [table.get(k) for k in keys] == list(range(3000))
    assert table.get(b"absent") is None


def test_repeated_bytes(spark, small, odd, empty):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = queries.queries()["op6_repeated_bytes"](spark, FOLDER)
    assert tuples(found, *columns) == brute.repeated_bytes(small)
    df, rows = odd
    got = repeated_bytes.with_repeats_removed(df)
    assert got.count() == len(rows)
    assert tuples(got, *columns) == brute.repeated_bytes(rows)
    kept = got.filter("kept is not null").select("kept", "kept_sha256").collect()
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in kept)
    assert repeated_bytes.with_repeats_removed(empty).count() == 0


def test_repeated_bytes_on_strings_of_few_letters(spark):
    """Shifted, overlapping and nearly equal passages, down to the last byte."""
    pick = np.random.default_rng(9)
    pool = ["".join(pick.choice(list("ab"), n)) for n in (900, 700, 401, 400, 399)]
    rows = []
    for i in range(60):
        one, other = pool[i % 5], pool[(i * 3 + 1) % 5]
        start, stop = sorted(pick.integers(0, len(one), 2))
        rows.append((i, other[: pick.integers(0, 300)] + one[start:] + "".join(pick.choice(list("ab"), 50)) + one[:stop]))
    got = repeated_bytes.with_repeats_removed(spark.createDataFrame(rows, "doc_id bigint, text string"))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert tuples(got, *columns) == brute.repeated_bytes(rows)


def test_repeated_bytes_counts_bytes_not_words(spark, tmp_path):
    """A shared passage of 60 words stays at 399 bytes and goes at 400; n_bytes is the length of the input."""
    pick = np.random.default_rng(4)
    words = [["".join(pick.choice(list("abcdefgh"), 6 if i % 3 else 5)) for i in range(60)] for _ in range(2)]
    short, long = " ".join(words[0]), " ".join(words[1]) + "i"
    assert (len(short), len(long)) == (399, 400)
    rows = [(0, f"1{short}2"), (1, f"3{short}4"), (2, f"5{long}6"), (3, f"7{long}8")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.queries()["op6_repeated_bytes"](spark, str(tmp_path))
    assert tuples(found, "doc_id", "n_bytes", "n_removed", "n_spans", "text") == {
        (0, 401, 0, 0, rows[0][1]), (1, 401, 0, 0, rows[1][1]), (2, 402, 400, 1, "56"), (3, 402, 400, 1, "78")
    }


def test_nearest_neighbours(spark):
    pick = np.random.default_rng(2)
    base = pick.normal(size=(600, 8)).astype(np.float32)
    rows = [(i, base[i % 400].tolist()) for i in range(600)]  # 200 vectors twice
    rows += [(1000 + i, base[0].tolist()) for i in range(100)]  # and one a hundred times
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [float("nan")] * 8), (2004, [1.0] * 3), (None, [1.0] * 8), (2005, [None] * 8)]
    rows += [rows[0]]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label string")
    found = vector_tree.nearest(df, F.col("vec_id") % 20 == 0).collect()
    good = {i: np.array(v, dtype=np.float64) for i, v in rows if i is not None and i < 2000}
    ids = sorted(good)
    vectors = np.array([good[i] for i in ids])
    hits = total = 0
    for q in (i for i in ids if i % 20 == 0):
        score = vectors @ good[q]
        best = [ids[j] for j in np.lexsort((ids, -score)) if ids[j] != q][:20]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(good[v] @ good[q] - s) < 1e-12 for _, v, s in mine)
        assert [(-s, v) for _, v, s in mine] == sorted((-s, v) for _, v, s in mine)
        hits, total = hits + len(set(best) & {v for _, v, _ in mine}), total + 20
    assert hits / total >= 0.9
    assert vector_tree.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = vector_tree.nearest(df.filter("vec_id in (0, 20, 21)"), F.col("vec_id") % 20 == 0)
    assert tuples(few, "query_id", "rank") == {(0, 1), (0, 2), (20, 1), (20, 2)}


def test_recall_on_the_table(spark):
    found = queries.queries()["op7_nearest_neighbours"](spark, FOLDER).collect()
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], dtype=np.float64)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        best = [j for j in np.lexsort((ids, -(vectors @ vectors[i]))) if j != i][:20]
        hits += len({int(ids[j]) for j in best} & {r["vec_id"] for r in found if r["query_id"] == ids[i]})
        total += 20
    assert hits / total >= 0.9


PAGE = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{x}</style></head><body class="home">
<header>Site</header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Head &amp; line</h1><p>One <b>two</b>
three<br>four<p>Five&nbsp;six<div class="ad">Buy</div><form><input>Mail</form><ul><li>a</li><li>b</li></ul>
<section id="comments"><p>First!</p></section></article><aside>More</aside><footer>&copy; me</footer>
<script>var t="</p><p>no</p>";</script>"""


def test_pages(spark, empty):
    found = queries.queries()["op8_html_main_text"](spark, FOLDER).collect()
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert {r["page_id"]: (r["text"], r["n_chars"]) for r in found} == {
        p["page_id"]: (t := brute.article(p["html"]), len(t)) for p in pages
    }
    rows = [(1, "http://a.org/1", PAGE), (2, None, None), (3, "http://a.org/2", ""), (4, "odd", "just text"), (5, "http://a.org/3", "<p>x</b></article><li>"), (1, "http://a.org/1", PAGE)]
    df = spark.createDataFrame([(*r, "y", "z") for r in rows], "page_id bigint, url string, html string, host string, _wrapper string")
    got = wrappers.extract_pages(df).collect()
    texts = {r["page_id"]: r["text"] for r in got}
    assert len(got) == 6
    assert texts[1] == "Head & line\n\nOne two three four\n\nFive six\n\na\n\nb"
    assert (texts[2], texts[3], texts[4]) == ("", "", "just text")
    assert wrappers.extract_pages(df.limit(0)).count() == 0


def test_pages_without_an_article_beside_pages_with_one(spark):
    rows = [(1, "http://a.org/1", PAGE), (2, "http://a.org/3", "<p>x</b></article><li>"), (3, None, "<article>own</article>"), (4, None, "<div>plain</div>"), (5, "odd", "just text")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    texts = {r["page_id"]: r["text"] for r in wrappers.extract_pages(df).collect()}
    assert (texts[2], texts[3], texts[4], texts[5]) == ("x", "own", "plain", "just text")


def test_wrappers_tell_template_from_content_without_an_article(spark):
    def page(i):
        body = "".join(f"<div class=x>Text {i} {k} of its own.</div>" for k in range(i % 3 + 1))
        return f"<body><div>Brand name</div><div><a href=/>Link</a> <a href=/b>Other</a></div>{body}<div>All rights reserved</div></body>"

    rows = [(i, f"http://h.net/{i}", page(i)) for i in range(9)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for r in wrappers.extract_pages(df).collect():
        i = r["page_id"]
        assert r["text"] == "\n\n".join(f"Text {i} {k} of its own." for k in range(i % 3 + 1))


def test_inline_links_and_copies_are_content_without_an_article(spark):
    def page(i):
        told = "".join(f"<p>Story {i} {k} tells of <a href=/x>a place</a> far away.</p>" for k in range(3))
        return f"<body><div>Brand name</div><div><a href=/{i}>Link {i}</a> | <a href=/b>Other</a></div>{told}<div>All rights reserved</div></body>"

    told = [f"Story {{0}} {k} tells of a place far away." for k in range(3)]
    rows = [(i, f"http://h.net/{i}", page(i)) for i in range(5)]
    rows += [(100 + i, f"http://copies.net/{i}", "<body><h1>Title</h1><p>The only text.</p></body>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for r in wrappers.extract_pages(df).collect():
        i = r["page_id"]
        wanted = "\n\n".join(told).format(i) if i < 100 else "Title\n\nThe only text."
        assert r["text"] == wanted


def test_folding_and_aligning():
    items, places = wrappers.fold("u l x /l l x /l l x /l /u p".split())
    assert items == ["u", "(l x /l)+", "/u", "p"] and places == [0, *[1] * 9, 2, 3]
    one = wrappers.Wrapper(["a", "b", "c"], [False] * 3, [1] * 3, [None, "v", None])
    two = wrappers.Wrapper(["a", "c", "d"], [False] * 3, [1] * 3, [None, None, None])
    both = one.merged(two)
    assert both.expression() == "a (b)? c (d)?" and both.pages == [2, 1, 2, 1]


def test_surrogates(spark, odd, empty):
    text = (
        'Mrs Anna Kowalski met Mr. John Smith; a.b@mail.org, A.B@mail.org, +1 (017) 555-7713, 10.0.0.7, 8.8.8.8, '
        '4111 1111 1111 1111, DE89 3702 0044 0532 0130 00, 078-05-1120, token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" 2020-01-02'
    )
    made = surrogates.replace_text(text, KEY)
    for private in ("Kowalski", "Anna", "Smith", "a.b@", "555-7713", "10.0.0.7", "8.8.8.8", "4111", "3702", "078-05", "04dbebab"):
        assert private not in made
    assert made.startswith("Mrs ") and " met Mr. " in made and made.endswith("2020-01-02") and "token = \"" in made
    first = made.split()[1]
    assert first in surrogates.GIVEN_NAMES[("female", "latin")]
    emails = [w.strip(",;") for w in made.split() if "@" in w]
    assert len(emails) == 2 and emails[0] == emails[1].lower() and emails[0].endswith(".org")
    assert surrogates.replace_text(text, KEY) == made != surrogates.replace_text(text, b"other")
    df, rows = odd
    found = surrogates.with_surrogates(df, KEY)
    assert found.columns == [*df.columns, "_entities"]
    assert sorted(map(str, tuples(found, "doc_id", "text"))) == sorted({str(r) for r in rows})
    assert surrogates.pseudonymised(empty, KEY).count() == 0


def test_names_end_at_the_first_word_that_is_none():
    for text, names, rest in (
        ("Dr Weber in Berlin", ["Weber"], "Dr {} in Berlin"),
        ("Mr Smith and Mrs Jones left", ["Smith", "Jones"], "Mr {} and Mrs {} left"),
        ("Mr and Mrs Jones", ["Jones"], "Mr and Mrs {}"),
        ("Prof. Dr. Weber", ["Weber"], "Prof. Dr. {}"),
        ("Mr Smith Mrs Jones", ["Smith", "Jones"], "Mr {} Mrs {}"),
        ("Frau Anna Weber Berlin", ["Anna Weber Berlin"], "Frau {}"),
    ):
        found = []
        made = surrogates.replace_text(text, KEY, lambda *x: found.append(x))
        assert [f[1] for f in found] == names
        assert made == rest.format(*[f[2] for f in found]) and not any(n in made for n in names)
    for text in ("Dr Weber mail ab.c@mail.org", "Mr Smith Ab.c@mail.org", "Mrs Jones Token: abcdefgh12"):
        kinds = []
        surrogates.replace_text(text, KEY, lambda *x: kinds.append(x[0]))
        assert kinds[0] == "name" and kinds[1] in ("email", "secret")


def test_a_name_is_the_same_person_all_through_a_text():
    made = surrogates.replace_text("Smith came. Mr Smith left. Smith's dog, SMITH and Smithson stayed, said Smith.", KEY)
    name = made.split()[0]
    assert made == f"{name} came. Mr {name} left. {name}'s dog, {name.upper()} and Smithson stayed, said {name}."
    assert name not in ("Smith", "Smithson") and len(name) == 5
    text = "Anna Kowalski wrote to John Smith. Kowalski and John met, Anna said."
    found = []
    made = surrogates.replace_text(text, KEY, lambda *x: found.append(x[:2]))
    assert not any(w in made for w in ("Anna", "Kowalski", "John", "Smith"))
    assert found == [("name", x) for x in ("Anna Kowalski", "John Smith", "Kowalski", "John", "Anna")]
    words = made.replace(".", "").replace(",", "").split()
    assert words[0] == words[-2] and words[1] == words[6] and words[4] == words[8]
    # A given name on its own, and words in lower case, are no names.
    for text in ("Anna said so", "Paul and others", "the smith and Anna went"):
        assert surrogates.replace_text(text, KEY) == text


def test_entities_behind_a_cue_and_addresses_of_version_6():
    for text, private in (
        ("Phone 5551234567 now", "5551234567"), ("tel: 5551234567", "5551234567"), ("SSN 078051120.", "078051120"),
        ("social security number 078051120", "078051120"), ("password is hunter2x9 ok", "hunter2x9"),
        ("from 2001:db8:0:0:8:800:200c:417a to", "800:200c"), ("at fe80::1ff:fe23:4567:890a,", "fe23"), ("2001:DB8::8:800", "::8:800"),
    ):
        made = surrogates.replace_text(text, KEY)
        assert private not in made and made.split()[0] == text.split()[0] or made[:4].lower() == text[:4].lower(), text
        assert surrogates.replace_text(text, KEY) == made != text
    assert surrogates.replace_text("at fe80::1 ok", KEY).startswith("at fe80:")
    for text in ("version 10.2.3.4 is out", "password is required", "order 5551234567 came", "at 12:30:45 sharp", "a::b", "std::vector"):
        assert surrogates.replace_text(text, KEY) == text
    maps = surrogates.Surrogates(KEY)
    made = {maps.ip6(f"2001:db8::{i:x}") for i in range(500)}
    assert len(made) == 500 and all(m.startswith("2001:") for m in made)


def test_surrogates_are_one_to_one():
    maps = surrogates.Surrogates(KEY)
    for make, values in (
        (lambda v: maps.text("t", v), [f"{i:03d}" for i in range(1000)]),
        (maps.card, [f"{4111111111111 * 1000 + i}" for i in range(2000)]),
        (maps.ip, [f"10.1.{i // 250}.{i % 250}" for i in range(2000)]),
        (maps.ip, [f"93.4.{i // 250}.{i % 250}" for i in range(500)]),
        (maps.name, sorted({n for names in surrogates.GIVEN_NAMES.values() for n in names} | {f"{a}{b}on" for a in "BCDFG" for b in "aeiou"})),
    ):
        made = [make(v) for v in values]
        assert len(set(made)) == len(values) and not any(a == b for a, b in zip(made, values))
        assert [len(a) for a in made] == [len(v) for v in values] or make in (maps.ip, maps.name)
    valid = "4111111111111111"
    assert surrogates._luhn(maps.card(valid)[:-1]) == int(maps.card(valid)[-1])
    iban = maps.iban("DE89370400440532013000")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def test_surrogate_collisions_are_seen(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    entities = surrogates.surrogate_table(documents, KEY)
    assert entities.count() > 0 and surrogates.collisions(entities).isEmpty()
    rows = [("ip", "a", "s"), ("ip", "b", "s"), ("ip", "c", "c"), ("card", "d", "e")]
    bad = surrogates.collisions(spark.createDataFrame(rows, "kind string, original string, surrogate string"))
    assert {r["surrogate"] for r in bad.collect()} == {"s", "c"}


def test_token_files(spark, small, odd, empty, tmp_path):
    columns = ["doc_id", "start", "n_tokens", "ids_crc32"]
    found = queries.queries()["op10_token_files"](spark, FOLDER)
    assert tuples(found, *columns) == brute.token_files(small, WORD_BPE)
    df, rows = odd
    folder = str(tmp_path / "tokens")
    parts = token_files.write_tokens(df, folder, WORD_BPE)
    got = token_files.read_documents(parts, folder)
    assert got.count() == len(rows)
    assert tuples(got, *columns) == brute.token_files(rows, WORD_BPE)
    nothing = str(tmp_path / "none")
    assert token_files.read_documents(token_files.write_tokens(empty, nothing, WORD_BPE), nothing).count() == 0


def test_toxicity(spark, odd, empty):
    rows = [(i, f"calm words number {i} about the sea and hills", 0) for i in range(300)]
    rows += [(1000 + i, f"calm words {i} you stupid fool about the hills", 1) for i in range(60)]
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    found = toxicity.toxicity(documents, labels).collect()
    truth = {i: y for i, _, y in rows}
    assert all(r["predicted"] == truth[r["doc_id"]] for r in found if r["held_out"])
    model = toxicity.fit(toxicity.training_rows(documents, labels))
    assert toxicity.Scorer(model)("some stupidd words") > 0.5 > toxicity.Scorer(model)("some calm words")
    df, _ = odd
    scores = toxicity.toxicity(df, labels)
    assert scores.count() == df.count() and scores.filter("score < 0 or score > 1 or score is null").isEmpty()
    assert toxicity.toxicity(df, labels.limit(0)).filter("score != 0").isEmpty()
    assert toxicity.toxicity(empty, labels).count() == 0


def test_language(spark, odd, empty):
    found = queries.queries()["op2_language_id"](spark, FOLDER)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    wrong = found.join(documents.select("doc_id", F.col("lang").alias("truth")), "doc_id").filter("lang != truth")
    assert wrong.count() <= 0.02 * documents.count()
    pages = found.filter("page_id is not null")
    assert pages.count() == spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    model = language.train(documents)
    df, rows = odd
    sourced = df.withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.lit("a.b.org")))
    kept = language.accepted(sourced, model)
    assert kept.columns == sourced.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert not ids & {1, 2, 3} and {4, 5, 7} <= ids
    assert language.accepted(empty, model).count() == 0
    nothing = language.fit([])
    assert language.accepted(sourced, nothing).count() == len(rows)


def test_junk_and_other_languages_are_rejected(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(documents)
    pick = np.random.default_rng(1)
    letters = " ".join("".join(pick.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(60))
    rows = [
        (1, "Привет, как дела? Это русский текст о погоде и природе.", "no known language"),
        (2, "これは日本語の文章です。今日は天気がいいですから、散歩に行きましょう。", "no known language"),
        (3, letters, "no known language"),
        (4, "x" * 500, "no known language"),
        (5, "asdf 1234 !!!!", "mostly other characters"),
        (6, "a", "too few letters"),
        (7, "12345 67890 $$$", "too few letters"),
        (8, None, "too few letters"),
    ]
    df = spark.createDataFrame([(*r, None, None) for r in rows], "id bigint, text string, wanted string, _host string, _declared string")
    found = {r["id"]: (r["kept"], r["reason"]) for r in language.identify(df, ["id"], "text", model).collect()}
    assert found == {i: (False, wanted) for i, _, wanted in rows}
    # The documents that have a language all stay.
    labelled = documents.filter("lang is not null and text is not null")
    assert language.accepted(labelled, model).count() == labelled.count()


def test_hosts_sway_short_texts(spark):
    model = language.fit([("der die und nicht ist das", "de"), ("the and of not is that", "en")] * 20)
    rows = [(i, "der und nicht", "x.de", None) for i in range(200)] + [(900, "ok", "x.de", None), (901, "ok", "y.com", "en")]
    rows += [(300 + i, "the and of", "y.com", "en") for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, text string, _host string, _declared string")
    found = {r["id"]: r["lang"] for r in language.identify(df, ["id"], "text", model).collect()}
    assert (found[900], found[901]) == ("de", "en")
