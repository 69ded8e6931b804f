"""Helpers shared by the operators of this subpackage.

Text handling works on the UTF-8 bytes of an Arrow batch: words, their hashes
and the document each belongs to are computed for some megabytes of text at a
time with numpy, never word by word in Python.

A word is a maximal run of characters other than space and U+0009 to U+000D,
``[^\\x20\\x09-\\x0D]+``. All these separators are single bytes in UTF-8, so
bytes can be split without decoding.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartscope.session import scratch_path

#: Bytes of text handled at once by the numpy code.
CHUNK_BYTES = 4 << 20
#: Bytes hashed at once; longer words are hashed by xxh3 instead.
_SEGMENT = 1 << 19
#: Bytes of a batch between Spark and Python, see ``bound_batches``.
BATCH_BYTES = 2 << 20

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_FOLDED = _BYTE.copy()
_BYTE_FOLDED[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(kind: str) -> np.ndarray:
    if kind not in _POWERS:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(_SEGMENT + 1, base, dtype=np.uint64)
        steps[0] = 1
        _POWERS[kind] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[kind]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    """Words of several texts: byte spans, 64-bit hashes, and for document i
    the range ``doc[i]:doc[i + 1]`` of its words."""
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    doc: np.ndarray

    def n_docs(self) -> int:
        return len(self.doc) - 1

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs()), np.diff(self.doc))


def text_chunks(column: pa.Array, max_bytes: int = CHUNK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``max_bytes``.

    Yields ``(first_row, end_row, bytes, offsets)``; null texts are empty. A
    longer text is a run of its own, whole.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[off[i]:off[j]], (off[i:j + 1] - off[i])
        i = j


def text_column(df: DataFrame, text_col: str) -> list[Column]:
    """The text as a column of its own beside ``row``, the struct of all columns; none
    if the row holds it as a string already, so that no text travels twice."""
    as_is = df.schema[text_col].dataType.simpleString() == "string"
    return [] if as_is else [df[text_col].cast("string").alias("__text")]


def text_of(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    """The texts of a batch of ``row`` and, if there is one, ``text_column``."""
    at = batch.schema.get_field_index("__text")
    return batch.column(at) if at >= 0 else batch.column(batch.schema.get_field_index("row")).field(text_col)


#: Separators that leave runs of letters, digits and non-ASCII bytes.
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False


def split_words(data: np.ndarray, offsets: np.ndarray, fold_case: bool,
                separators: np.ndarray = _SPACE) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; with
    ``fold_case`` A-Z hash as a-z. ``separators`` flags the bytes between words."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Words(data, z, z, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~separators[data]
    first = np.empty(n, dtype=bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    first[cuts] = True
    last = np.empty(n, dtype=bool)
    last[-1] = True
    last[:-1] = ~inside[1:]
    last[cuts[cuts > 0] - 1] = True
    starts = np.flatnonzero(inside & first)
    ends = np.flatnonzero(inside & last) + 1
    hashes = _hash_spans(data, starts, ends, _BYTE_FOLDED if fold_case else _BYTE, fold_case)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def _hash_spans(data, starts, ends, table, fold_case) -> np.ndarray:
    """Polynomial hashes modulo 2^64 of byte spans, from running sums."""
    out = np.empty(len(starts), dtype=np.uint64)
    up, down = _powers("up"), _powers("down")
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(ends, base + _SEGMENT, side="right"))
        if j <= i:  # one word longer than a segment
            word = data[starts[i]:ends[i]].tobytes()
            out[i] = xxhash.xxh3_64_intdigest(word.lower() if fold_case else word)
            i += 1
            continue
        seg = data[base:ends[j - 1]]
        sums = np.zeros(len(seg) + 1, dtype=np.uint64)
        np.cumsum(table[seg] * up[:len(seg)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out)


def window_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of each run of ``size`` words within one document, and
    the index of its first word."""
    n = len(words.hashes)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = words.hashes[:n - size + 1].copy()
    base = np.uint64(_BASE)
    for k in range(1, size):
        acc *= base
        acc += words.hashes[k:n - size + 1 + k]
    whole = np.ones(n - size + 1, dtype=bool)
    for edge in words.doc[1:-1]:
        whole[max(0, edge - size + 1):edge] = False
    at = np.flatnonzero(whole)
    return mix(acc[at]), at


def as_binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, type=pa.binary())


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (``addPyFile``), once
    per application. Only code goes this way, never data."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="cartscope-code-"), "cartscope.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def bound_batches(spark: SparkSession) -> None:
    """Batches of at most about ``BATCH_BYTES`` between Spark and Python in this session,
    so that memory on both sides doesn't follow the length of the texts (10,000 rows
    are a batch else). A size that the session has been given stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared work folder and read it back:
    later steps start from the files, also after an executor is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    row = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("b")).first()
    return int(row["b"] or 0)


def groups_for(total_bytes: int, per_group: int) -> int:
    """Groups of about ``per_group`` bytes; their number follows the input."""
    return max(1, -(-total_bytes // per_group))


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id written in decimal, modulo ``mod`` (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(mod)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and the text, under fixed names; other columns of the input
    can't clash with what an operator adds."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"),
                       docs[text_col].cast("string").alias("text"))
