"""Flat token-id files with 64-bit document offsets.

A range shuffle on the document id gives every task one contiguous run of documents. The task
encodes its texts and appends the ids to one flat file of little-endian unsigned integers
(16 bits where the vocabulary allows it, else 32), beside a file of 64-bit offsets and one of
document ids. Files bear a name of their own for every attempt, and only the names that a
finished task returns are used, so repeated and lost attempts do no harm. The position of a part
in the whole corpus, its base, is the prefix sum over the parts' token counts.

Defined cases: a NULL text is empty and yields the end id alone; NULL ids come first; rows that
share an id keep the order of their texts' bytes; an empty table yields no files and no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers.pre_tokenizers import ByteLevel

from tillgrain.llm.rows import as_bytes, map_texts, stored, text_of
from tillgrain.session import shared_folder

#: Distinct words whose ids a worker remembers before it starts over.
REMEMBERED_WORDS = 500_000
#: Letters below this point are Latin ones that all Unicode versions agree on.
LATIN_END = "\u0250"


def _composed(word: str) -> bool:
    return word.isascii() or (word.isalpha() and unicodedata.is_normalized("NFC", word))


# ASCII punctuation but the apostrophe, which opens a token of its own kind with letters.
PUNCTUATION = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
# White space of str.split() that the tokenizer's \s does not know.
_odd_space = re.compile("[\x1c-\x1f]").search

PARTS = [
    ("part", pa.int64(), "bigint"),
    ("name", pa.string(), "string"),
    ("documents", pa.int64(), "bigint"),
    ("tokens", pa.int64(), "bigint"),
]
DOCUMENTS = [
    ("doc_id", pa.int64(), "bigint"),
    ("start", pa.int64(), "bigint"),
    ("n_tokens", pa.int64(), "bigint"),
    ("ids_crc32", pa.int64(), "bigint"),
]


@lru_cache(maxsize=2)
def tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # a text that spells a special token is ordinary text
    return found


class WordEncoder:
    """The library's ids for whole texts, asking it once for each distinct word.

    No token of this tokenizer spans white space and its normalisation works inside words, so
    the ids of a text are those of its words. Texts with separators that the two notions of
    white space treat differently go to the library whole. Ids come as bytes of ``kind``.
    """

    def __init__(self, path: str, kind: str, remembered: int = REMEMBERED_WORDS):
        self.tokenizer, self.remembered = tokenizer(path), remembered
        self.dtype, self.kind = kind, {"<u2": "H", "<u4": "I"}[kind]
        self.known: dict[str, bytes] = {}
        # Composed lower-case Latin letters pass normalisation and splitting as they are. For ASCII
        # that leaves the model alone, for the others the step that spells bytes as characters.
        self.plain = type(self.tokenizer)(self.tokenizer.model)
        self.latin = type(self.tokenizer)(self.tokenizer.model)
        self.latin.pre_tokenizer = ByteLevel(add_prefix_space=False, use_regex=False)

    def _ask(self, words: set[str]) -> None:
        """Learn new words: letters and a closing run of ASCII punctuation are never one token."""
        known, encode = self.known, self.tokenizer.encode
        plain, latin = self.plain.encode, self.latin.encode
        whole, parts = [], []
        for word in words:
            head = word.rstrip(PUNCTUATION)
            if head and len(head) < len(word):
                parts.append((word, head, word[len(head) :]))
            else:
                whole.append(word)
        needed = dict.fromkeys(whole)
        needed.update((x, None) for _, head, tail in parts for x in (head, tail) if x not in known)
        kind = self.kind
        for word in needed:
            if word.isalpha() and (low := word.lower()) and max(low) < LATIN_END and _composed(low):
                ids = (plain if low.isascii() else latin)(low).ids
            else:
                ids = encode(word, add_special_tokens=False).ids
            known[word] = struct.pack(f"<{len(ids)}{kind}", *ids)
        known.update((word, known[head] + known[tail]) for word, head, tail in parts)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.remembered:
            self.known.clear()
        split = [None if _odd_space(t) else t.split() for t in texts]
        new: set[str] = set()
        for words in filter(None, split):
            new.update(words)
        self._ask(new.difference(self.known))
        known = self.known.__getitem__
        whole = self.tokenizer
        return [
            b"".join(map(known, words))
            if words is not None
            else np.array(whole.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
            for text, words in zip(texts, split)
        ]


@lru_cache(maxsize=2)
def encoder(path: str, kind: str) -> WordEncoder:
    """The encoder of a worker, so that its tasks share what it has learnt."""
    return WordEncoder(path, kind)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (
        fs.LocalFileSystem(), uri
    )


def _encode(parts: Iterator[pa.RecordBatch], path: str, folder: str, end_id: int, kind: str):
    encode, disk = encoder(path, kind), None
    last, size = np.array([end_id], dtype=kind).tobytes(), np.dtype(kind).itemsize
    offset, documents = 0, 0
    number = TaskContext.get().partitionId()
    name = f"part-{number:05d}-{uuid4().hex}"
    for part in parts:
        if disk is None:
            system, root = _opened(folder)
            disk = {
                x: system.open_output_stream(f"{root}/{name}.{x}")
                for x in ("ids", "offsets", "documents", "known")
            }
        ids = part.column("doc_id")
        found = encode([text_of(t) for t in part.column("body").to_pylist()])
        ends = offset + np.cumsum([len(x) // size + 1 for x in found], dtype="<u8")
        disk["ids"].write(last.join(found) + last)
        disk["offsets"].write(ends.astype("<u8").tobytes())
        disk["documents"].write(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        disk["known"].write(ids.is_valid().to_numpy(zero_copy_only=False).astype("u1").tobytes())
        offset, documents = int(ends[-1]), documents + part.num_rows
    if disk is not None:
        for stream in disk.values():
            stream.close()
        yield [(number, name, documents, offset)]


def write_tokens(
    documents: DataFrame, folder: str, path: str, end_id: int = 1, partitions: int | None = None
) -> DataFrame:
    """Write the token files of ``documents`` below ``folder``; returns the table of parts.

    Columns: part, name (without suffix), documents, tokens, base (tokens in earlier parts).
    ``path`` is the tokenizer's file, which every executor can read.
    """
    spark = documents.sparkSession
    kind = "<u2" if max(tokenizer(path).get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
    system, root = _opened(folder)
    system.create_dir(root, recursive=True)
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), as_bytes().alias("body"))
        .repartitionByRange(count, "doc_id")
        .sortWithinPartitions("doc_id", "body")
    )
    parts = stored(map_texts(ordered, "body", _encode, PARTS, path, folder, end_id, kind), "parts")
    # One row per part, at most as many as shuffle partitions.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn(
        "base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).cast("bigint")
    ).withColumn("kind", F.lit(kind))


def _mapped(system: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A file's integers: mapped where the store is a local or mounted folder, else read."""
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with system.open_input_file(path) as stream:
        return np.frombuffer(stream.read(), dtype=kind)


def read_part(folder: str, name: str, kind: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, offset inside the part, ids) of every document of one part."""
    system, root = _opened(folder)
    at = f"{root}/{name}"
    ids, ends = _mapped(system, f"{at}.ids", kind), _mapped(system, f"{at}.offsets", "<u8")
    keys, known = _mapped(system, f"{at}.documents", "<i8"), _mapped(system, f"{at}.known", "u1")
    start = 0
    for i in range(len(ends)):
        end = int(ends[i])
        yield (int(keys[i]) if known[i] else None), start, ids[start:end]
        start = end


def _read(parts: Iterator[pa.RecordBatch], folder: str):
    for part in parts:
        for row in part.to_pylist():
            rows = []
            for key, start, ids in read_part(folder, row["name"], row["kind"]):
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((key, row["base"] + start, len(ids), crc))
                if len(rows) == 10_000:
                    yield rows
                    rows = []
            yield rows


def read_documents(parts: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    count = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_texts(parts.repartition(count, "part"), "name", _read, DOCUMENTS, folder)


def new_folder(spark: SparkSession) -> str:
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tillgrain/{application}/tokens-{uuid4().hex}"
