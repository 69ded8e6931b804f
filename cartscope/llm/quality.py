"""Quality rules by distribution divergence.

Method: each document's histogram of character classes and of common words is
compared with a reference histogram of each language by Jensen-Shannon
divergence (base 2, 0 to 1). The references are learned in Spark from all
documents of a language that pass the base rules: mean character-class shares,
and shares of the language's ``COMMON`` most frequent words, everything else
being one more bin. A document is rejected if its character classes are far
from *every* language's, or its words are. Texts of fewer words than a guard
are too short for a histogram and are not judged by that distance.

Common words are counted as hashed words in ``2^BITS`` slots, so a task holds
one bounded table per language, whatever its vocabulary.

Distances are judged against limits that are parameters of the method.
Character classes settle within some tens of words: clean texts of that length
lie within 0.03, texts in capitals or with symbols on every word beyond 0.1.
Common words settle with the square root of the length, and so does their
limit, chosen on one half of the labelled sf0.1 rows; it is never less than what
words drawn from the reference reach. Lists without a
language's function words lie beyond it from some tens of words on.

Defined results: a null or empty text has no words and fails the base rules;
a document whose language has no reference (fewer than ``min_docs`` documents)
is judged by the base rules only, one without a language by all references; repeated rows and null ids
are judged like any other; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartscope.llm.common import (NOT_ALNUM, read_documents, ship_package, split_words,
                                  text_chunks, window_hashes)

MIN_WORDS = 10
REPEAT_WINDOW, REPEAT_PERCENT = 5, 20
BITS, COMMON = 16, 64
CHAR_LIMIT, CHAR_GUARD = 0.1, 30
WORD_LIMIT, WORD_GUARD = 0.1, 40
#: A text of n words may lie as far as WORD_BASE + WORD_SPREAD / sqrt(n), if that is more.
WORD_BASE, WORD_SPREAD = 0.04, 1.05
NOISE_WORDS = (40, 60, 100, 160, 250, 400, 1000)

# The symbols counted, and character classes by byte.
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "punctuation", "other")
_CLASS = np.full(256, 6, dtype=np.int64)
_CLASS[33:127] = 5
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9, 10, 11, 12, 13]] = 3
_CLASS[list(SYMBOLS)] = 4
_CLASS[128:192] = 7  # inside a character, counted with its first byte


def _duplicate_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def _covered(words, size: int) -> np.ndarray:
    """Per document, how many words lie in a window that occurs twice or more in it."""
    hashes, at = window_hashes(words, size)
    mark = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    if len(at):
        doc = np.searchsorted(words.doc, at, side="right") - 1
        order = np.lexsort((hashes, doc))
        d, h = doc[order], hashes[order]
        same = (d[1:] == d[:-1]) & (h[1:] == h[:-1])
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        np.add.at(mark, at[twice], 1)
        np.add.at(mark, at[twice] + size, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(mark[:-1]) > 0)])
    return inside[words.doc[1:]] - inside[words.doc[:-1]]


@dataclass
class Facts:
    """Base counts and histograms of the documents of one chunk."""
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    classes: np.ndarray  # documents x classes
    word_doc: np.ndarray
    word_slot: np.ndarray

    def failed(self) -> np.ndarray:
        return (self.n_words < MIN_WORDS) | (100 * self.n_repeat_words > REPEAT_PERCENT * self.n_words)


def facts(data: np.ndarray, off: np.ndarray) -> Facts:
    words = split_words(data, off, fold_case=False)
    n = len(off) - 1
    cls = _CLASS[data]
    doc_of = np.repeat(np.arange(n), np.diff(off))
    classes = np.bincount(doc_of * 8 + cls, minlength=8 * n).reshape(n, 8)
    lead = np.concatenate([[0], np.cumsum(cls != 7)])
    chars = lead[words.ends] - lead[words.starts]
    blob = data.tobytes()
    plain = split_words(data, off, fold_case=True, separators=NOT_ALNUM)
    return Facts(
        np.diff(words.doc), np.bincount(words.doc_of_word(), chars, minlength=n).astype(np.int64),
        classes[:, 4], np.array([_duplicate_lines(blob[a:b]) for a, b in zip(off[:-1], off[1:])], dtype=np.int64),
        _covered(words, REPEAT_WINDOW), classes[:, :7].astype(np.float64),
        plain.doc_of_word(), (plain.hashes >> np.uint64(64 - BITS)).astype(np.int64))


def _add_up(batches):
    """Sums over the partition for each language: class shares and word slots."""
    shares: dict[str, np.ndarray] = {}
    slots: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for batch in batches:
        names = batch.column(batch.schema.get_field_index("lang")).to_pylist()
        for i, j, data, off in text_chunks(batch.column(batch.schema.get_field_index("text"))):
            f = facts(data, off)
            good = ~f.failed()
            lang = np.array(names[i:j], dtype=object)
            for name in {x for x in names[i:j] if x is not None}:
                mine = good & (lang == name)
                if not mine.any():
                    continue
                c = f.classes[mine]
                shares[name] = shares.get(name, 0) + (c / c.sum(axis=1, keepdims=True)).sum(axis=0)
                docs[name] = docs.get(name, 0) + int(mine.sum())
                if name not in slots:
                    slots[name] = np.zeros(1 << BITS, dtype=np.int64)
                slots[name] += np.bincount(f.word_slot[mine[f.word_doc]], minlength=1 << BITS)
    for name in shares:
        used = np.flatnonzero(slots[name])
        yield pa.RecordBatch.from_arrays([
            pa.array([name] * (len(used) + 7)),
            pa.array(np.concatenate([used, -1 - np.arange(7)])),
            pa.array(np.concatenate([slots[name][used].astype(float), shares[name]])),
            pa.array([docs[name]] * (len(used) + 7), pa.int64())], names=["lang", "bin", "amount", "docs"])


@dataclass
class Reference:
    classes: np.ndarray
    slots: np.ndarray  # the common words' slots
    words: np.ndarray  # their shares, and the share of the rest


def references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
               min_docs: int = 20) -> dict[str, Reference]:
    """A reference for each language with at least ``min_docs`` documents that
    pass the base rules."""
    ship_package(docs.sparkSession)
    rows = docs.select(docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text")) \
        .filter("lang IS NOT NULL AND text IS NOT NULL")
    sums = (rows.mapInArrow(_add_up, "lang string, bin long, amount double, docs long")
            .groupBy("lang", "bin").agg(F.sum("amount").alias("amount"), F.sum("docs").alias("docs")))
    total = F.sum(F.when(F.col("bin") >= 0, F.col("amount"))).over(Window.partitionBy("lang"))
    top = (sums.withColumn("total", total).withColumn("word", F.col("bin") >= 0)
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "word").orderBy(F.desc("amount"), "bin")))
           .withColumn("passed", F.max(F.when(F.col("bin") < 0, F.col("docs"))).over(Window.partitionBy("lang")))
           .filter(F.col("passed") >= min_docs)
           .filter((F.col("bin") < 0) | (F.col("rank") <= COMMON)))
    got: dict[str, list] = {}
    for r in top.select("lang", "bin", "amount", "passed", "total").collect():  # COMMON + 7 rows a language
        got.setdefault(r["lang"], []).append(r)
    out = {}
    for lang, rs in sorted(got.items()):
        n = rs[0]["passed"]
        classes = np.zeros(7)
        for r in rs:
            if r["bin"] < 0:
                classes[-1 - r["bin"]] = r["amount"] / n
        common = sorted((r for r in rs if r["bin"] >= 0), key=lambda r: r["bin"])
        total_words = common[0]["total"] if common else 1.0
        share = np.array([r["amount"] / total_words for r in common])
        out[lang] = Reference(classes / classes.sum(), np.array([r["bin"] for r in common], dtype=np.int64),
                              np.append(share, max(0.0, 1 - share.sum())))
    return out


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits of each row of ``p`` from ``q``."""
    m = 0.5 * (p + q)

    def kl(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0.0).sum(axis=1)
    return 0.5 * kl(p) + 0.5 * kl(np.broadcast_to(q, p.shape))


def word_limit(n_words: np.ndarray, ref: Reference) -> np.ndarray:
    """The limit by length, or four standard deviations above the mean distance
    of as many words drawn from the reference itself, if that is more."""
    rng = np.random.default_rng(5)
    share = ref.words / ref.words.sum()
    drawn = [divergence(rng.multinomial(n, share, 200) / n, ref.words) for n in NOISE_WORDS]
    noise = np.interp(n_words, NOISE_WORDS, [d.mean() + 4 * d.std() for d in drawn])
    own = WORD_BASE + WORD_SPREAD / np.sqrt(np.maximum(n_words, 1))
    return np.maximum(np.maximum(WORD_LIMIT, own), noise)


def distances(f: Facts, refs: dict[str, Reference]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least distance to any language, by character classes and by words, and
    whether the words are beyond every language's limit."""
    n = len(f.n_words)
    by_char, by_word, beyond = np.full(n, 1.0), np.full(n, 1.0), np.full(n, True)
    shares = f.classes / np.maximum(f.classes.sum(axis=1, keepdims=True), 1)
    total = np.maximum(np.bincount(f.word_doc, minlength=n), 1)
    for ref in refs.values():
        by_char = np.minimum(by_char, divergence(shares, ref.classes))
        place = np.full(1 << BITS, len(ref.slots), dtype=np.int64)
        place[ref.slots] = np.arange(len(ref.slots))
        k = len(ref.slots) + 1
        hist = np.bincount(f.word_doc * k + place[f.word_slot], minlength=n * k).reshape(n, k) / total[:, None]
        apart = divergence(hist, ref.words)
        by_word = np.minimum(by_word, apart)
        beyond &= apart > word_limit(f.n_words, ref)
    return by_char, by_word, beyond


OUT = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
       "base_failed boolean, kept boolean, char_distance double, word_distance double")


def _judge(refs: dict[str, Reference]):
    def judge(batches):
        for batch in batches:
            for i, j, data, off in text_chunks(batch.column(batch.schema.get_field_index("text"))):
                f = facts(data, off)
                failed = f.failed()
                lang = batch.column(batch.schema.get_field_index("lang")).slice(i, j - i).to_pylist()
                judged = np.array([x is None or x in refs for x in lang], dtype=bool)
                by_char, by_word, beyond = distances(f, refs) if refs else (np.zeros(j - i),) * 3
                far = judged & (((f.n_words >= CHAR_GUARD) & (by_char > CHAR_LIMIT)) |
                                ((f.n_words >= WORD_GUARD) & (beyond > 0)))
                cols = [f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("doc_id")).slice(i, j - i),
                     *(pa.array(c.astype(np.int64)) for c in cols), pa.array(failed), pa.array(~failed & ~far),
                     pa.array(by_char), pa.array(by_word)], names=[c.split()[0] for c in OUT.split(", ")])
    return judge


def judge(docs: DataFrame, refs: dict[str, Reference], id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: the base counts, ``base_failed``, both distances, ``kept``."""
    ship_package(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       docs[lang_col].cast("string").alias("lang")) \
        .mapInArrow(_judge(refs), OUT)


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return judge(docs, references(docs))
