"""Toxicity scores from subword-bag embeddings and a linear softmax, trained together in numpy.

A word is the bag of its character n-grams, each hashed to a row of an embedding table, so a
misspelling shares most of its rows with the word it spells. The mean over the n-grams of a run
of ``SEGMENT_WORDS`` words goes through a linear softmax over two classes. A text is as toxic as
its runs together: the log-odds of its runs are joined by log-sum-exp, so a short insult is not
averaged away by a long text. Table and softmax are fitted together by Adam on whole gradients.

The fit takes a bounded sample of the labelled rows (``TRAIN_ROWS`` ids in hash order, texts of
at most ``TRAIN_BYTES``). Scoring reads every text whole; tasks get one number per table row,
the projection of its embedding on the difference of the two classes.

Defined cases: a NULL or wordless text scores the share of toxic rows in the sample; without
labelled rows of both kinds every score is that share (0 without any rows); NULL ids and labels
are no labels; repeated rows get repeated scores; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import append_columns, as_bytes, labelled_sample, text_of

TRAIN_ROWS = 3500
TRAIN_BYTES = 16_384
TABLE_ROWS = 1 << 17
DIMENSIONS = 4
SEGMENT_WORDS = 2
GRAMS = (3, 4, 5, 6)
EPOCHS = 40
STEP = 0.15
SHRINK = 1e-5
#: Texts in which a gram must occur to be learned, and the table row of words without such grams.
LEAST_TEXTS = 5
SPARE = 0
#: Distinct words a worker remembers before it starts over.
REMEMBERED_WORDS = 300_000
_EDGES = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'"

SCORES = [("_score", pa.float64(), "double")]


def words_of(text: str) -> list[str]:
    return [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w]


def grams(word: str) -> list[int]:
    """Table rows of a word: the word itself and its n-grams with marked ends."""
    marked = f"<{word}>"
    found = [marked]
    for n in GRAMS:
        found += [marked[i : i + n] for i in range(len(marked) - n + 1)]
    return [xxhash.xxh32_intdigest(g.encode("utf-8", "replace")) % TABLE_ROWS for g in found]


@dataclass
class Model:
    """One number per table row, the bias, and the score of a text without words."""

    weight: np.ndarray
    bias: float
    base: float


class _Corpus:
    """Sample texts as flat arrays: grams of distinct words, words of segments, segments of texts."""

    def __init__(self, texts: list[str]):
        seen: dict[str, int] = {}
        words, segments, texts_at, each = [], [0], [0], []
        for text in texts:
            found = [seen.setdefault(w, len(seen)) for w in words_of(text)]
            each.append(set(found))
            for i in range(0, len(found), SEGMENT_WORDS):
                words += found[i : i + SEGMENT_WORDS]
                segments.append(len(words))
            texts_at.append(len(segments) - 1)
        # Grams that few texts hold only let the fit learn its rows by heart.
        often = np.bincount(np.array([w for f in each for w in f], dtype=np.int64), minlength=len(seen))
        rows = [grams(w) for w in seen]
        reach = np.zeros(TABLE_ROWS, dtype=np.int64)
        for row, n in zip(rows, often.tolist()):
            reach[list(set(row))] += n
        common = reach >= LEAST_TEXTS
        counts = [len(r) for r in rows]
        rows = [[g for g in r if common[g]] or [SPARE] for r in rows]
        self.sizes = np.array([len(r) for r in rows])
        self.grams = np.array([g for r in rows for g in r])
        self.gram_starts = np.cumsum(self.sizes) - self.sizes
        self.words = np.array(words)
        self.segment_starts = np.array(segments[:-1])
        self.segment_of_word = np.repeat(np.arange(len(segments) - 1), np.diff(segments))
        self.weights = 1.0 / np.add.reduceat(np.array(counts)[self.words], self.segment_starts)
        self.text_starts = np.array(texts_at[:-1])
        self.text_of_segment = np.repeat(np.arange(len(texts_at) - 1), np.diff(texts_at))


def _logsumexp(logits: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(logits, starts)
    return top + np.log(np.add.reduceat(np.exp(logits - top[owner]), starts))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def fit(rows: list[tuple[str, int]], seed: int = 7) -> Model:
    """Fit on (text, label) rows; every tenth row decides how many epochs are kept."""
    rows = [(t, y) for t, y in rows if words_of(t)]
    share = float(np.mean([y for _, y in rows])) if rows else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(TABLE_ROWS, dtype=np.float32), 0.0, share)
    c, labels = _Corpus([t for t, _ in rows]), np.array([y for _, y in rows], dtype=float)
    held = np.arange(len(labels)) % 10 == 9
    cost = np.where(held, 0.0, np.where(labels == 1, min(4.0, (1 - share) / share), 1.0))
    cost /= cost.sum()
    rng = np.random.default_rng(seed)
    used, gram = np.unique(c.grams, return_inverse=True)
    table = rng.normal(0, 0.03, (len(used), DIMENSIONS))
    softmax = rng.normal(0, 0.5, (DIMENSIONS, 2))
    runs = np.median(np.bincount(c.text_of_segment))
    bias = np.array([0.0, np.log(share / (1 - share) / runs)])
    values = [table, softmax, bias]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    best, kept = np.inf, None
    for epoch in range(1, EPOCHS + 1):
        vectors = np.add.reduceat(table[gram], c.gram_starts)
        means = np.add.reduceat(vectors[c.words], c.segment_starts) * c.weights[:, None]
        scores = means @ softmax + bias
        logits = scores[:, 1] - scores[:, 0]
        joined = _logsumexp(logits, c.text_starts, c.text_of_segment)
        chance = _sigmoid(joined)
        loss = -(labels * np.log(chance + 1e-12) + (1 - labels) * np.log(1 - chance + 1e-12))
        missed = loss[held].mean() if held.any() else loss.mean()
        if missed < best:
            direction = softmax[:, 1] - softmax[:, 0]
            best, kept = missed, (table @ direction, float(bias[1] - bias[0]))
        pull = (cost * (chance - labels))[c.text_of_segment] * np.exp(logits - joined[c.text_of_segment])
        two = np.stack([-pull, pull], axis=1)
        d_means = (two @ softmax.T) * c.weights[:, None]
        d_table = np.empty_like(table)
        for k in range(DIMENSIONS):
            per_word = np.bincount(c.words, weights=d_means[c.segment_of_word, k], minlength=len(c.sizes))
            d_table[:, k] = np.bincount(gram, weights=np.repeat(per_word, c.sizes), minlength=len(used))
        slopes = [d_table + SHRINK * table, means.T @ two, two.sum(axis=0)]
        for value, slope, (first, second) in zip(values, slopes, moments):
            first += 0.1 * (slope - first)
            second += 0.01 * (slope * slope - second)
            scale = np.sqrt(second / (1 - 0.99**epoch)) + 1e-9
            value -= STEP * first / (1 - 0.9**epoch) / scale
    weight = np.zeros(TABLE_ROWS, dtype=np.float32)
    weight[used] = kept[0]
    weight[SPARE] = 0.0
    return Model(weight, kept[1], share)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, tuple[float, int]] = {}
        self.fitted = bool(model.weight.any())

    def __call__(self, text: str) -> float:
        words = words_of(text)
        if not words or not self.fitted:
            return self.model.base
        known = self.known
        if len(known) > REMEMBERED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            rows = grams(word)
            known[word] = (float(self.model.weight[rows].sum()), len(rows))
        found = np.array([known[w] for w in words])
        starts = np.arange(0, len(words), SEGMENT_WORDS)
        sums = np.add.reduceat(found, starts)
        logits = sums[:, 0] / sums[:, 1] + self.model.bias
        top = logits.max()
        return float(_sigmoid(top + np.log(np.exp(logits - top).sum())))


def held_out(doc_id: str = "doc_id"):
    """Rows that no fit may learn from: a fifth of the ids, by CRC-32 of their text."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_rows(documents: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> list[tuple[str, int]]:
    """A bounded sample of labelled texts outside the held-out fifth."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("id"), as_bytes().alias("body"))
    known = labels.filter(~held_out()).select(
        F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("label")
    )
    return [(text, label) for _, text, label in labelled_sample(texts, known, rows, TRAIN_BYTES)]


def _score(parts: Iterator[pa.RecordBatch], model):
    score = Scorer(model.value)
    for part in parts:
        yield [(score(text_of(raw)),) for raw in part.column("body").to_pylist()]


def with_score(documents: DataFrame, model: Model) -> DataFrame:
    """``documents`` with ``_score`` from 0 to 1."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    return append_columns(documents, as_bytes(), _score, SCORES, sent)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    model = fit(training_rows(documents, labels))
    return with_score(documents.select("doc_id", "text"), model).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out().alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )
