"""Operator 3: quality scores from boosted trees over document statistics.

Statistics of every whole text (byte classes, word and line lengths, repeated
words, word pairs and lines) are computed with array operations per Arrow
batch and written once.  The trees (``_trees``) are fitted on about
``TRAIN_DOCS`` labelled documents per label, taken by key hash, and scored by
vectorised traversal of their flat arrays.

Defined results: a null text is an empty text, scored like any other (all its
statistics are 0); labels that are null or whose document is missing do not
train; with several labels for a document each counts; without any labelled
row every score is 0.5.  Repeated rows give repeated rows; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _trees
from ._common import hash_sample, written
from ._text import LETTER_BYTE, NOT_SPACE, U, chunks, counts_by, mix, span_hashes, word_spans

TRAIN_DOCS = 20_000
_LINE = np.ones(256, bool)
_LINE[10] = False
#: Byte classes: upper, lower, digit, sentence mark, other ASCII sign, space, line end, beyond ASCII.
_CLASS = np.full(256, 4, np.int64)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 7
_CLASS[[33, 39, 44, 46, 58, 59, 63]] = 3
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 5, 6
N_CLASSES = 8


def _repeats(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(share of distinct values, share of the most frequent value) by document."""
    total = np.maximum(1, counts_by(doc, n))
    if not len(h):
        return np.zeros(n), np.zeros(n)
    o = np.lexsort((h, doc))
    d, v = doc[o], h[o]
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (v[1:] != v[:-1])])
    size = np.diff(np.r_[first, len(d)])
    top = np.zeros(n, np.int64)
    np.maximum.at(top, d[first], size)
    return counts_by(d[first], n) / total, top / total


def statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of statistics for each text of a chunk."""
    n = len(offs) - 1
    size = np.diff(offs)
    doc_of = np.repeat(np.arange(n), size)
    classes = counts_by(doc_of * N_CLASSES + _CLASS[buf], n * N_CLASSES).reshape(n, N_CLASSES)
    s, e, doc = word_spans(buf, offs, NOT_SPACE)
    length = e - s
    words = counts_by(doc, n)
    w = np.maximum(1, words)
    h = span_hashes(buf, s, e) if len(s) else np.zeros(0, np.uint64)
    mean = counts_by(doc, n, length) / w
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, doc, length)
    letters = np.r_[0, np.cumsum(LETTER_BYTE[buf])]
    plain = letters[e] - letters[s]
    pair = doc[:-1] == doc[1:] if len(doc) else np.zeros(0, bool)
    pairs = mix(h[:-1] * U(3) + h[1:] * U(5))[pair] if len(h) else h
    ls, le, ldoc = word_spans(buf, offs, _LINE)
    lines = np.maximum(1, counts_by(ldoc, n))
    lh = span_hashes(buf, ls, le) if len(ls) else np.zeros(0, np.uint64)
    line_len = le - ls
    line_mean = counts_by(ldoc, n, line_len) / lines
    last = buf[le - 1] if len(le) else np.zeros(0, np.uint8)
    first = buf[s] if len(s) else np.zeros(0, np.uint8)
    upper = (first >= 65) & (first <= 90)
    signs = np.r_[0, np.cumsum(_CLASS[buf] == 4)]
    return np.column_stack([
        np.log1p(size), np.log1p(words), np.log1p(counts_by(ldoc, n)),
        classes / np.maximum(1, size)[:, None],
        mean, longest, np.sqrt(np.maximum(0, counts_by(doc, n, length**2) / w - mean**2)),
        counts_by(doc, n, length <= 3) / w, counts_by(doc, n, plain == length) / w,
        counts_by(doc, n, upper) / w, counts_by(doc, n, signs[e] - signs[s] > 0) / w,
        counts_by(doc, n, plain == 0) / w,
        *_repeats(doc, h, n), *_repeats(doc[:-1][pair] if len(doc) else doc, pairs, n),
        line_mean, np.sqrt(np.maximum(0, counts_by(ldoc, n, line_len.astype(float)**2) / lines - line_mean**2)),
        counts_by(ldoc, n, _CLASS[last] == 3) / lines, *_repeats(ldoc, lh, n),
    ])


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``x`` (the statistics) of every row of ``docs``."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, buf, offs in chunks(b, "text"):
                x = statistics(buf, offs).astype(np.float32)
                cells = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([rows.column(0), cells], names=["doc_id", "x"])

    return docs.mapInArrow(run, f"doc_id {id_type}, x array<float>")


def fit(stats: DataFrame, labels: DataFrame, label: str, train_docs: int = TRAIN_DOCS) -> _trees.Forest:
    """Trees on about ``train_docs`` rows of each label; ``labels``: doc_id, label."""
    labels = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    rows = hash_sample(stats.join(labels, "doc_id"), "doc_id", "label", train_docs)
    got = rows.select("doc_id", "label", "x").collect()
    got.sort(key=lambda r: (str(r.doc_id), r.label, r.x))      # the same trees in every run
    x = np.array([r.x for r in got] or np.zeros((0, 1)), np.float64)
    return _trees.fit(x, np.array([r.label for r in got], float))


def score(stats: DataFrame, forest: _trees.Forest, cut: float = 0.3) -> DataFrame:
    """doc_id, score and predicted (score >= cut) of every row of ``stats``."""
    id_type = stats.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            s = forest.predict(x.astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(s), pa.array((s >= cut).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return stats.select("doc_id", "x").mapInArrow(run, f"doc_id {id_type}, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality",
            doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics once, trees from ``labels``, scores of all documents."""
    stats = written(features(docs, doc_id, text))
    return score(stats, fit(stats, labels, label))
