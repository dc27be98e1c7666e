"""Problem 10: repetition inside a single document.

Suffix arrays over words. The words of a batch of documents form one sequence in which
every document has symbols of its own, so that one suffix array, built by prefix doubling
on whole arrays, holds all documents' suffixes without mixing them. Ranks of every doubling
step give the longest common prefix of neighbours in the array; intervals of neighbours that
share `span` words or more are the repeated substrings, all of whose places but the
first are later occurrences; the union of their spans is the repeated part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
RESULT = "doc_id bigint, n_words bigint, n_repeated bigint, longest_repeat bigint"


def words(text: str | None) -> list[str]:
    """Longest runs of letters and digits, in lower case."""
    return [w.lower() for w in WORD.findall(text)] if text else []


def _ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4 ... symbols, until all differ.

    Equal ranks at step k mean equal first 2**k symbols. Symbols of different documents
    must differ, and each document must end in a symbol of its own.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
    steps, width = [rank], 1
    count = int(rank.max()) + 1 if n else 0
    while count < n:
        key = rank.astype(np.int64) * (n + 1)
        key[: n - width] += rank[width:] + 1
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], (np.diff(key[order]) != 0).astype(np.int64)])
        rank = np.empty(n, np.int32)
        rank[order] = np.cumsum(fresh)
        count = int(rank[order[-1]]) + 1
        steps.append(rank)
        width *= 2
    return steps


def _common(steps: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefixes of the suffixes at a and b."""
    n, out = len(steps[0]), np.zeros(len(a), np.int64)
    for k in range(len(steps) - 1, -1, -1):
        at, bt = a + out, b + out
        inside = (at < n) & (bt < n)
        same = np.zeros(len(a), bool)
        same[inside] = steps[k][at[inside]] == steps[k][bt[inside]]
        out[same] += 1 << k
    return out


def repeated_words(documents: list[list[str]], span: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each document its number of words, of repeated words, and the longest repeat in words.

    A word is repeated if it lies in `span` consecutive words that also occur, in the same
    order, starting earlier in the document.
    """
    n_words = np.array([len(d) for d in documents], np.int64)
    long = np.flatnonzero(n_words > span)
    repeated, longest = np.zeros(len(documents), np.int64), np.zeros(len(documents), np.int64)
    if not len(long):
        return n_words, repeated, longest
    names: dict[str, int] = {}
    ids = np.array([names.setdefault(w, len(names)) for i in long.tolist() for w in documents[i]], np.int64)
    size = n_words[long]
    doc = np.repeat(np.arange(len(long)), size + 1)
    ends = np.cumsum(size + 1) - 1
    symbols = np.full(len(doc), len(names), np.int64)
    symbols[np.setdiff1d(np.arange(len(doc)), ends, assume_unique=True)] = ids
    steps = _ranks(doc * (len(names) + 1) + symbols)
    array = np.argsort(steps[-1], kind="stable")
    common = _common(steps, array[:-1], array[1:])
    # Intervals of the array whose neighbours share `span` words or more.
    interval = np.concatenate([[0], np.cumsum(common < span)])
    first = np.minimum.reduceat(array, np.flatnonzero(np.concatenate([[True], common < span])))
    later = array[array != first[interval]]
    cover = np.zeros(len(doc) + 1, np.int64)
    np.add.at(cover, later, 1)
    np.add.at(cover, later + span, -1)
    covered = np.cumsum(cover)[:-1] > 0
    repeated[long] = np.add.reduceat(covered.astype(np.int64), ends - size)
    most = np.zeros(len(long), np.int64)
    np.maximum.at(most, doc[array[1:]], np.where(common >= span, common, 0))
    longest[long] = most
    return n_words, repeated, longest


def _measure(batches: Iterator[pa.RecordBatch], span: int, words_at_once: int = 400_000) -> Iterator[pa.RecordBatch]:
    def out(ids: list, docs: list) -> pa.RecordBatch:
        n, repeated, longest = repeated_words(docs, span)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n), pa.array(repeated), pa.array(longest)], ["doc_id", "n_words", "n_repeated", "longest_repeat"])

    ids, docs, n = [], [], 0
    for b in batches:
        for i, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
            w = words(text.as_py())
            ids.append(i)
            docs.append(w)
            n += len(w)
            if n >= words_at_once or len(ids) >= 20_000:
                yield out(ids, docs)
                ids, docs, n = [], [], 0
    if ids:
        yield out(ids, docs)


def repetition(documents: DataFrame, span: int = 6) -> DataFrame:
    """doc_id, n_words, n_repeated, share (0 for texts of no words), longest_repeat of every row.

    Null, empty and blank texts have no words. Whole texts are read, whatever their length;
    repeated rows are measured each; an empty table gives an empty result; other columns
    are ignored. No shuffle: a document is measured where it lies.
    """
    measured = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(lambda x: _measure(x, span), RESULT)
    return measured.withColumn("share", F.when(F.col("n_words") > 0, F.col("n_repeated") / F.col("n_words")).otherwise(0.0))


def mostly_repeated(documents: DataFrame, span: int = 6, least_share: float = 0.4, longest: int | None = None) -> DataFrame:
    """The rows of `repetition` with at least that share of repeated words, or, where `longest` is given, a repeat of more words than that."""
    mostly = (F.col("n_words") > 0) & (F.col("n_repeated") >= F.lit(least_share) * F.col("n_words"))
    return repetition(documents, span).where(mostly if longest is None else mostly | (F.col("longest_repeat") > longest))
