"""Plain versions of the operators over lists of rows, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash


def simhash(docs, words=3, budget=2):
    prints = []
    for key, text in docs:
        found = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode().lower()) if w]
        runs = [found[i : i + words] for i in range(max(1, len(found) - words + 1))] if found else []
        hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        prints.append((key, bits if hashes else 0))
    distinct = sorted({b for _, b in prints})
    at = {b: i for i, b in enumerate(distinct)}
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array(distinct, dtype=np.uint64)
    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= budget) + i + 1:
            parent[root(i)] = root(int(j))
    least = {}
    for key, b in prints:
        r = root(at[b])
        least[r] = key if r not in least else min(least[r], key)
    return {(k, f"{b:016x}", least[root(at[b])]) for k, b in prints}


def decontamination(docs, items, window=13, cut=20):
    def words(text):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())

    wanted = defaultdict(set)
    for key, text in items:
        found = words(text)
        if key is not None and found:
            n = min(window, len(found))
            for i in range(len(found) - n + 1):
                wanted[tuple(found[i : i + n])].add(str(key))
    sizes = sorted({len(w) for w in wanted})
    out = set()
    for key, text in docs:
        found, hit, names = words(text), set(), set()
        for n in sizes:
            for i in range(len(found) - n + 1):
                if owners := wanted.get(tuple(found[i : i + n])):
                    names |= owners
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        bad = bool(hit) and cut * len(hit) >= len(found)
        out.add((key, len(found), len(hit), len(names), digest, bad))
    return out


def byte_bpe(docs, path, pattern):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = set()
    for key, text in docs:
        ids = library.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        decoded = hashlib.sha256(library.decode_bytes(ids)).hexdigest()
        out.add((key, len(ids), hashlib.sha256(joined).hexdigest(), decoded))
    return out


def token_files(docs, path, end_id=1):
    from tokenizers import Tokenizer

    library, out, start = Tokenizer.from_file(path), set(), 0
    library.encode_special_tokens = True
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, (d[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.add((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def repeated_bytes(docs, length=400):
    raws = [(key, (text or "").encode()) for key, text in docs]
    counts = defaultdict(int)
    for _, raw in raws:
        for p in range(len(raw) - length + 1):
            counts[raw[p : p + length]] += 1
    out = set()
    for key, raw in raws:
        hit = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if counts[raw[p : p + length]] > 1:
                hit[p : p + length] = b"\1" * length
        kept = bytes(b for b, h in zip(raw, hit) if not h)
        spans = len(re.findall(rb"\x01+", bytes(hit)))
        out.add((key, len(raw), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def article(source):
    """Main text of the synthetic pages, whose articles hold headings and paragraphs only."""
    import html

    body = re.search(r"(?s)<article>(.*?)</article>", source)
    blocks = re.split(r"</?(?:p|h1)>", body[1] if body else "")
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b.replace("<b>", ""))).split()) for b in blocks)
    return "\n\n".join(b for b in blocks if b)


def spelling(docs):
    counts = defaultdict(int)
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if h % 199 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    known = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    holed = defaultdict(set)  # a word with a letter taken out or blotted
    for w in known:
        for i in range(len(w)):
            holed[w[:i] + w[i + 1 :]].add(w)
            holed[w[:i] + "\0" + w[i + 1 :]].add(w)
    near = {}
    for w in known:
        found = {x for i in range(len(w)) for x in holed[w[:i] + "\0" + w[i + 1 :]]} | holed[w]
        found |= {w[:i] + w[i + 1 :] for i in range(len(w))} & set(known)
        near[w] = found - {w}
    form = {}
    for w, found in near.items():
        if found:
            best = min(found, key=lambda x: (-known[x], x))
            if known[best] >= 5 * known[w]:
                form[w] = best
    out = set()
    for w in known:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, known[w], len(near[w]), known[form[w]] if w in form else None))
    return out


def pieces(docs, path, end_id=2, capacity=1024):
    """Pieces of all documents, repeated ones included: doc_id, piece, start, length, crc."""
    from tokenizers import Tokenizer

    library, out = Tokenizer.from_file(path), []
    library.encode_special_tokens = True
    for key, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [end_id]
        starts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            crc = zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())
            out.append((key, i, a, b - a, crc))
    return out


def hard_negatives(rows, positives=5, negatives=10):
    """rows: (vec_id, label, vector) with labels as they are in the table."""
    known = []
    for key, label, vector in rows:
        bad = key is None or label is None or not vector or any(x is None or x != x or abs(x) == float("inf") for x in vector)
        if not bad:
            known.append((key, (label + 1) % 10 if key % 7 == 0 else label, [int(256 * x // 1) for x in vector]))
    out = set()
    for a, own, v in known:
        if a % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), k, label) for k, label, w in known if k != a and len(v) == len(w)]
        scores.sort()
        for p, positive, _ in [s for s in scores if s[2] == own][:positives]:
            fits = [s for s in scores if s[2] != own and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out |= {(a, positive, i + 1, k, -p, -s) for i, (s, k, _) in enumerate(fits)}
    return out


def longest_matches(docs, items, window=13):
    """Longest runs of equal words of documents and items, found cell by cell."""
    def words(text):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())

    out = set()
    for key, text in docs:
        one = words(text)
        for name, item in items:
            two = words(item)
            if name is None or not two:
                continue
            for i in range(len(one)):
                for j in range(len(two)):
                    if one[i] == two[j] and not (i and j and one[i - 1] == two[j - 1]):
                        n = 0
                        while i + n < len(one) and j + n < len(two) and one[i + n] == two[j + n]:
                            n += 1
                        if n >= min(window, len(two)):
                            out.add((key, str(name), i, j, n))
    return out
