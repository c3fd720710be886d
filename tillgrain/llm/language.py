"""Language identification by Bayesian fusion of evidence.

Evidence about a text is taken as independent given its language:

* the text: naive Bayes over hashed character trigrams, tempered because trigrams overlap;
* the language its markup declares and the suffix of its address: likelihoods from grouped counts;
* its host: a prior smoothed level by level, host towards domain, domain towards suffix, suffix
  towards the whole corpus, each level weighing ``PRIOR_WEIGHT`` rows of the level above.

The counts behind likelihoods and priors are sums of the texts' own posteriors over all rows,
found by grouped aggregation, so wrong declarations lose weight where texts contradict them. The
trigram table is fitted on a bounded sample of labelled texts (``TRAIN_ROWS``, ``TRAIN_BYTES``).

Rows are joined to the priors by host. Only ids and evidence are shuffled, never texts; Spark's
skew handling splits a host that holds a large share of the rows.

A language is the best of those known, so there is one more hypothesis: none of them. In a text of a
known language most trigrams occur in some labelled text, in others few do, so the share of unseen
trigrams is evidence between the two (``OUTSIDE_UNSEEN``, ``KNOWN_UNSEEN``, ``OUTSIDE_ODDS``).

Rejected (kept false, with a reason) are rows with fewer than ``LEAST_LETTERS`` letters, rows with
less than ``LETTER_SHARE`` of letters among their visible characters, rows of no known language, and
rows whose best language has a posterior below ``LEAST_POSTERIOR``, in this order.

Defined cases: a text without letters (NULL, empty) gives no evidence of its own and is rejected
whatever its host says; missing markup, address and host give no evidence and the
corpus prior; ties go to the first language in order; without labelled texts the language is NULL
and nothing is kept; repeated rows stay; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.rows import append_columns, as_bytes, labelled_sample, stored, text_of

TRAIN_ROWS = 2000
TRAIN_BYTES = 16_384
TABLE_ROWS = 1 << 16
#: Share of the trigrams that counts as independent evidence.
TEMPER = 0.25
#: Rows of the level above that a host, domain or suffix starts from.
PRIOR_WEIGHT = 20.0
LEAST_POSTERIOR = 0.5
#: Probability that a trigram occurs in no labelled text, outside all known languages and in one of
#: them at most, and the odds of such a text before it is read.
OUTSIDE_UNSEEN, KNOWN_UNSEEN, OUTSIDE_ODDS = 0.85, 0.35, 0.05
#: Trigrams in all labelled texts from which on unseen ones count.
LEAST_TRIGRAMS = 1000
LEAST_LETTERS, LETTER_SHARE = 2, 0.35

_TAGS = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_ENTITIES = re.compile(r"&#?\w+;")
EVIDENCE = [
    ("_loglik", pa.list_(pa.float64()), "array<double>"), ("_letters", pa.int64(), "bigint"),
    ("_shown", pa.int64(), "bigint"), ("_unseen", pa.int64(), "bigint"), ("_trigrams", pa.int64(), "bigint"),
]
REASONS = ("too few letters", "mostly other characters", "no known language", "undecided")


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """Code points of the basic plane as they count: letters in lower case, all else a space."""
    table = np.full(1 << 16, 32, dtype=np.int64)
    for c in range(1 << 16):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def trigrams(text: str) -> tuple[np.ndarray, int, int]:
    """Table rows of the trigrams over runs of letters, and the letters and visible characters."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), dtype="<u4").astype(np.int64)
    wide = points >= 1 << 16
    codes = _letter_table()[np.where(wide, 0, points)]
    codes = np.where(wide, points, codes)
    letters, shown = codes != 32, int((points > 32).sum())
    keep = letters | np.concatenate([[True], letters[:-1]])  # one space between runs
    codes = codes[keep]
    if len(codes) < 3:
        return np.zeros(0, dtype=np.int64), int(letters.sum()), shown
    mixed = (codes[:-2] * 0x9E3779B1 + codes[1:-1] * 0x85EBCA77 + codes[2:] * 0xC2B2AE3D) >> 7
    return mixed % TABLE_ROWS, int(letters.sum()), shown


@dataclass
class TextModel:
    languages: list[str]
    table: np.ndarray  # log-likelihood per trigram row and language
    seen: np.ndarray  # whether a labelled text has a trigram of the row


def fit(rows: list[tuple[str, str]]) -> TextModel:
    languages = sorted({label for _, label in rows})
    counts = np.zeros((TABLE_ROWS, max(1, len(languages))))
    for text, label in rows:
        counts[:, languages.index(label)] += np.bincount(trigrams(text)[0], minlength=TABLE_ROWS)
    smoothed = counts + 0.05
    # Too few labelled texts say nothing about what lies outside of them.
    seen = counts.any(axis=1) | (counts.sum() < LEAST_TRIGRAMS)
    return TextModel(languages, np.log(smoothed / smoothed.sum(axis=0)).astype(np.float32), seen)


def train(documents: DataFrame, rows: int = TRAIN_ROWS) -> TextModel:
    """Fit on documents that carry their language in ``lang``."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("id"), as_bytes().alias("body"))
    known = documents.select(
        F.col("doc_id").cast("bigint").alias("id"), F.col("lang").cast("string").alias("label")
    )
    return fit([(t, label) for _, t, label in labelled_sample(texts, known, rows, TRAIN_BYTES)])


def _likelihoods(parts: Iterator[pa.RecordBatch], model, markup: bool):
    table, seen = model.value.table, model.value.seen
    for part in parts:
        rows = []
        for raw in part.column("body").to_pylist():
            text = text_of(raw)
            if markup:
                text = _ENTITIES.sub(" ", _TAGS.sub(" ", text))
            found, letters, shown = trigrams(text)
            logs = (TEMPER * table[found].sum(axis=0, dtype=np.float64)).tolist()
            rows.append((logs, letters, shown, int((~seen[found]).sum()), len(found)))
        yield rows


def declared_language(html: str = "html") -> Column:
    tag = F.regexp_extract(F.col(html), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1)
    return F.nullif(F.lower(tag), F.lit(""))


def host_of(url: str = "url") -> Column:
    host = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(host), F.lit(""))


def _sums(languages: int) -> list[Column]:
    return [F.sum(F.col("_own")[i]).alias(f"n{i}") for i in range(languages)]


def _array(languages: int, make) -> Column:
    return F.array(*[make(i) for i in range(languages)])


def _normal(logs: Column) -> Column:
    """Posterior from log weights."""
    top = F.array_max(logs)
    scaled = F.transform(logs, lambda x: F.exp(x - top))
    total = F.aggregate(scaled, F.lit(0.0), lambda a, x: a + x)
    return F.transform(scaled, lambda x: x / total)


def _conditional(rows: DataFrame, column: str, totals: list[float], n: int) -> DataFrame:
    """Log-likelihood of each value of ``column`` by language, from grouped counts."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(*_sums(n))
    return counts.select(
        column,
        _array(n, lambda i: F.log((F.col(f"n{i}") + 1.0) / (totals[i] + 10.0))).alias(f"_{column}"),
    )


@dataclass
class Priors:
    """What grouped counts say: tables of log-likelihoods and priors, and the corpus prior."""

    model: TextModel
    base: list[float]
    hosts: DataFrame
    declared: DataFrame
    suffixes: DataFrame


def _located(rows: DataFrame) -> DataFrame:
    labels = F.split("host", r"\.")
    domain = F.when(F.size(labels) > 1, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(F.col("host"))
    return rows.withColumn("suffix", F.element_at(labels, -1)).withColumn("domain", domain)


def _evidence(rows: DataFrame, body: str, model: TextModel, markup: bool) -> DataFrame:
    """``rows`` with _loglik and _letters of the text in column ``body``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    return append_columns(rows, as_bytes(body), _likelihoods, EVIDENCE, sent, markup)


def _counted(evidence: DataFrame, model: TextModel) -> Priors:
    """Likelihoods and hierarchically smoothed priors; evidence: host, declared, _loglik, _letters."""
    n = len(model.languages)
    counted = _located(evidence).filter("_letters > 0").withColumn("_own", _normal(F.col("_loglik")))
    totals = counted.agg(*[F.coalesce(F.sum(F.col("_own")[i]), F.lit(0.0)).alias(f"n{i}") for i in range(n)])
    whole = totals.first()
    base = [(whole[i] + 1.0) / (sum(whole) + n) for i in range(n)]

    # Hosts, domains and suffixes with their counts; each level starts from the one above.
    hosts = counted.filter("host is not null").groupBy("host", "domain", "suffix").agg(*_sums(n))
    domains = hosts.groupBy("domain", "suffix").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(n)])
    suffixes = domains.groupBy("suffix").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(n)])

    def smoothed(above):
        total = sum(F.col(f"n{i}") for i in range(n))
        return lambda i: (F.col(f"n{i}") + PRIOR_WEIGHT * above(i)) / (total + PRIOR_WEIGHT)

    by_suffix = suffixes.select("suffix", _array(n, smoothed(lambda i: F.lit(base[i]))).alias("_up"))
    by_domain = domains.join(by_suffix, "suffix").select(
        "domain", "suffix", _array(n, smoothed(lambda i: F.col("_up")[i])).alias("_up")
    )
    by_host = hosts.join(by_domain, ["domain", "suffix"]).select(
        "host", _array(n, smoothed(lambda i: F.col("_up")[i])).alias("_prior")
    )
    return Priors(
        model, base,
        stored(by_host, "host-priors"),
        stored(_conditional(counted, "declared", whole, n), "declared"),
        stored(_conditional(counted, "suffix", whole, n), "suffixes"),
    )


def _decided(rows: DataFrame, priors: Priors) -> DataFrame:
    """``rows`` with _lang, _confidence and _reason (NULL where accepted); rows: host, declared and
    the columns of EVIDENCE."""
    model = priors.model
    n = len(model.languages)
    none = _array(n, lambda i: F.lit(0.0))
    prior = _array(n, lambda i: F.lit(float(priors.base[i])))
    joined = (
        _located(rows).join(priors.hosts, "host", "left")
        .join(priors.declared, "declared", "left").join(priors.suffixes, "suffix", "left")
    )
    logs = _array(
        n,
        lambda i: F.log(F.coalesce("_prior", prior)[i])
        + F.coalesce("_declared", none)[i] + F.coalesce("_suffix", none)[i] + F.col("_loglik")[i],
    )
    best = F.array_max("_posterior")
    at = (F.array_position("_posterior", best) - 1).cast("int")

    names = F.array(*[F.lit(x) for x in model.languages])
    unseen, met = F.col("_unseen"), F.col("_trigrams") - F.col("_unseen")
    outside = (
        unseen * math.log(OUTSIDE_UNSEEN / KNOWN_UNSEEN)
        + met * math.log((1 - OUTSIDE_UNSEEN) / (1 - KNOWN_UNSEEN)) + math.log(OUTSIDE_ODDS)
    )
    refused = [
        F.col("_letters") < LEAST_LETTERS,
        F.col("_letters") < LETTER_SHARE * F.col("_shown"),
        outside > 0,
        best < LEAST_POSTERIOR,
    ]
    reason = F.lit(None).cast("string")
    for condition, name in reversed(list(zip(refused, REASONS))):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    return joined.withColumn("_posterior", _normal(logs)).select(
        *rows.columns, F.get(names, at).alias("_lang"), F.round(best, 9).alias("_confidence"), reason.alias("_reason")
    )


def identify(
    texts: DataFrame, key: list[str], body: str, model: TextModel, markup: bool = False
) -> DataFrame:
    """Per row: ``key``, host, declared, lang, confidence, kept and, where not kept, the reason.

    ``texts`` has the columns of ``key``, ``body`` and, NULL where unknown, _host and _declared.
    """
    rows = texts.select(
        F.struct(*key).alias("_key"), F.col("_host").alias("host"), F.col("_declared").alias("declared"),
        F.col(body).alias("_text"),
    )
    if not model.languages:
        lost = rows.select("_key.*", "host", "declared", F.lit(None).cast("string").alias("lang"))
        return lost.select(
            "*", F.lit(None).cast("double").alias("confidence"), F.lit(False).alias("kept"), F.lit(REASONS[2]).alias("reason")
        )
    evidence = stored(_evidence(rows, "_text", model, markup).drop("_text"), "language-evidence")
    found = _decided(evidence, _counted(evidence, model))
    return found.select(
        "_key.*", "host", "declared", F.col("_lang").alias("lang"), F.col("_confidence").alias("confidence"),
        F.col("_reason").isNull().alias("kept"), F.col("_reason").alias("reason"),
    )


def accepted(documents: DataFrame, model: TextModel) -> DataFrame:
    """``documents`` (text, source as host) without those whose language is rejected.

    The texts are read twice: for the counts, and to be judged by them. Without labelled texts
    there is nothing to judge by, and all documents stay.
    """
    if not model.languages:
        return documents
    rows = documents.select(
        F.struct("*").alias("_row"), F.col("source").cast("string").alias("host"),
        F.lit(None).cast("string").alias("declared"),
    )
    found = _evidence(rows, "_row.text", model, False)
    evidence = stored(found.drop("_row"), "language-evidence")
    judged = _decided(found, _counted(evidence, model))
    return judged.filter("_reason is null").select("_row.*")
