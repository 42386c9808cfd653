"""Operator 5: toxicity by the nearest labelled examples.

Texts become TF-IDF vectors over every word and word beginning of the labelled
examples (document frequencies over all documents); words that separate the
labels best (chi-square and purity on the sample) weigh ``BOOST`` times as
much.  The examples are kept in an inverted index: rare terms as postings,
frequent ones as tiles (rows of single-precision weights).  Postings are added
up in double precision, tiles multiplied in single precision; the examples whose
cosine may so be among the k largest, given the largest rounding error, are
computed again in double precision.  The neighbours found are exact.  Spark
counts the document frequencies, weighs the examples and sorts the postings; the
calibrating votes are a job as well.  Votes weighted by distance are calibrated
(isotonic, with class weights) on labelled documents that are no examples; the
neighbours are returned as evidence.

About ``SAMPLE`` documents of each label are used, by key hash over the whole
table: two thirds become examples, one third calibrates.

Defined results: a null text, an empty text and a text without any term of an
example have no neighbour and get the calibrated score of such texts; null labels
and labels without a document do not count; without usable labels every score
is 0.  Words that no example holds do not count.  Equal cosines are ordered by the example's key.  Repeated rows give
repeated rows; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import hash_sample, written
from ._text import LETTER_BYTE, U, chunks, counts_by, mix, prefix_sums, span_hashes, word_spans

SAMPLE = 3_000
VOCABULARY = 2_048          # terms that weigh more
BOOST = 6.0
LEAST_DF = 5
LEAST_CHI2 = 10.83          # 0.1 % level
NEIGHBOURS = 10
FREQUENT = 24               # a term of more than 1/24 of the examples is kept in tiles
CHUNK = 1 << 20             # bytes of text at a time: a task's arrays are many times as large
ROWS = 512                  # documents handled at once
ADDED = 100_000             # weights added up at once (few enough to stay in the cache)
LEAST_PURITY = 0.85         # a term's documents that share a label, classes weighed alike
BEGINNINGS = (3, 4, 5, 6, 7, 8)      # bytes
NEAR = 0.05                 # added to a distance before it is inverted


def terms(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, term hash) of every word and word beginning of a chunk."""
    s, e, doc = word_spans(buf, offs, LETTER_BYTE)
    if not len(s):
        return doc, np.zeros(0, np.uint64)
    docs, out = [doc], [span_hashes(buf, s, e)]
    for k in BEGINNINGS:
        longer = e - s > k
        docs.append(doc[longer])
        out.append(mix(span_hashes(buf, s[longer], s[longer] + k) + U(k)))
    return np.concatenate(docs), np.concatenate(out)


def _distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, value) pairs and how often each occurs."""
    o = np.lexsort((h, doc))
    d, v = doc[o], h[o]
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (v[1:] != v[:-1])]) if len(d) else o
    return d[first], v[first], np.diff(np.r_[first, len(d)])


def vectors(buf: np.ndarray, offs: np.ndarray, vocab: np.ndarray, start_of: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, vocabulary index, count) of a chunk; ``start_of``: buckets of ``vocab``.

    Terms are looked up once for each distinct word of the chunk.
    """
    s, e, doc = word_spans(buf, offs, LETTER_BYTE)
    none = np.zeros(0, np.int64)
    if not len(s) or not len(vocab):
        return none, none, none
    h = span_hashes(buf, s, e)
    o = np.argsort(h)
    new = np.r_[True, h[o[1:]] != h[o[:-1]]]
    at, word = o[new], np.empty(len(o), np.int64)
    word[o] = np.cumsum(new) - 1
    size = e[at] - s[at]
    start = np.cumsum(size) - size
    buf = buf[np.repeat(s[at] - start, size) + np.arange(size.sum())]      # the distinct words alone
    s, e = start, start + size
    sums = prefix_sums(buf)
    # ``of``: each distinct word's vocabulary indexes, -1 for none
    of = np.full((len(at), 1 + len(BEGINNINGS)), -1, np.int32)
    for column, k in enumerate((0, *BEGINNINGS)):
        row = np.flatnonzero(e - s > k)
        h = span_hashes(buf, s[row], s[row] + k if k else e, sums)
        row, i = _look_up(mix(h + U(k)) if k else h, row, vocab, start_of)
        of[row, column] = i
    term = of[word]
    key = np.sort((doc[:, None] * len(vocab) + term)[term >= 0])
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else none
    return key[first] // len(vocab), key[first] % len(vocab), np.diff(np.r_[first, len(key)])


def families(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A value that copies of a text mostly share: two min-hashes of its terms."""
    n = len(offs) - 1
    doc, h = terms(buf, offs)
    out = np.zeros(n, np.uint64)
    for salt in (1, 2):
        low = np.full(n, 2**64 - 1, np.uint64)
        np.minimum.at(low, doc, mix(h + U(salt)))
        out = mix(out * U(3) + low)
    return out


def buckets(vocab: np.ndarray) -> np.ndarray:
    """Where the hashes of each value of the leading bits start in the sorted ``vocab``."""
    bits = len(vocab).bit_length() + 2
    many = np.bincount((vocab >> U(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.r_[0, np.cumsum(many)].astype(np.int32)


def _look_up(h: np.ndarray, row: np.ndarray, vocab: np.ndarray, start_of: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Of the hashes in ``vocab``: their ``row`` and their index."""
    top = (h >> U(65 - len(start_of).bit_length())).astype(np.int64)
    at, end = start_of[top], start_of[top + 1]
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    while True:
        more = at < end
        h, row, at, end = h[more], row[more], at[more], end[more]
        if not len(h):
            return np.concatenate(rows), np.concatenate(found)
        same = vocab[at] == h
        rows.append(row[same])
        found.append(at[same])
        h, row, at, end = h[~same], row[~same], at[~same] + 1, end[~same]


def weights(doc: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """Unit-length TF-IDF weights and the row pointer of ``n`` documents."""
    w = (1 + np.log(count)) * idf[term]
    norm = np.sqrt(counts_by(doc, n, w * w))
    return w / np.maximum(1e-300, norm)[doc], np.r_[0, np.cumsum(counts_by(doc, n))]


@dataclass
class Index:
    """Inverted index of the examples, whose vectors have unit length."""
    key: np.ndarray            # example keys, ascending
    label: np.ndarray
    tile_of: np.ndarray        # row of a frequent term in the tiles, else -1
    first: np.ndarray          # rare terms: start of each term's postings
    postings: np.ndarray       # (example, weight), side by side: one look-up finds both
    own: np.ndarray            # frequent terms: start of each example's weights
    tile: np.ndarray           # row in the tiles
    tile_weight: np.ndarray

    @staticmethod
    def build(key, label, ptr, term, weight, n_terms: int) -> Index:
        """From the examples' vectors."""
        row = np.repeat(np.arange(len(key), dtype=np.int32), np.diff(ptr))
        o = np.argsort(term, kind="stable")
        first = np.r_[0, np.cumsum(np.bincount(term, minlength=n_terms))]
        return Index.of_postings(key, label, first, row[o], weight[o])

    @staticmethod
    def of_postings(key, label, first, posting, weight) -> Index:
        """From the terms' posting lists: those of frequent terms become tiles."""
        n, size = len(key), np.diff(first)
        frequent = size * FREQUENT > n
        tile_of = np.where(frequent, np.cumsum(frequent) - 1, -1).astype(np.int32)
        f = np.repeat(frequent, size)
        row = posting[f]
        o = np.argsort(row, kind="stable")
        return Index(key, label, tile_of, np.r_[0, np.cumsum(np.where(frequent, 0, size))], 
                     np.stack([posting[~f], weight[~f]], 1), np.r_[0, np.cumsum(counts_by(row, n))], np.repeat(tile_of[frequent], size[frequent])[o],
                     weight[f][o])

    @cached_property
    def tiles(self) -> np.ndarray:
        """(frequent terms, examples): weights, made once in each worker."""
        out = np.zeros((int(self.tile_of.max(initial=-1)) + 1, len(self.key)), np.float32)
        out[self.tile, np.repeat(np.arange(len(self.key)), np.diff(self.own))] = self.tile_weight
        return out

    def nearest(self, ptr: np.ndarray, term: np.ndarray, weight: np.ndarray, k: int
                ) -> tuple[np.ndarray, np.ndarray]:
        """(example or -1, cosine) of the k nearest with a positive cosine."""
        n = len(ptr) - 1
        best = np.full((n, k), -1, np.int64)
        sim = np.zeros((n, k))
        if not len(self.key):
            return best, sim
        for lo in range(0, n, ROWS):         # bounded memory
            hi = min(n, lo + ROWS)
            a, b = ptr[lo], ptr[hi]
            self._nearest(ptr[lo:hi + 1] - a, term[a:b], weight[a:b], best[lo:hi], sim[lo:hi])
        return best, sim

    def _nearest(self, ptr, term, weight, best, sim) -> None:
        n, k = best.shape
        n_tiles, wide = self.tiles.shape
        row = np.repeat(np.arange(n), np.diff(ptr))
        cos = np.zeros((n, wide))
        size = self.first[term + 1] - self.first[term]
        added = np.r_[0, np.cumsum(size)][ptr]
        lo = 0
        while lo < n:
            hi = min(n, max(lo + 1, int(np.searchsorted(added, added[lo] + ADDED, side="right")) - 1))
            part = slice(ptr[lo], ptr[hi])
            many = size[part]
            take = np.repeat(self.first[term[part]] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            got = self.postings.take(take, axis=0)
            at = np.repeat((row[part] - lo) * wide, many) + got[:, 0].astype(np.int64)
            cos[lo:hi] = np.bincount(at, np.repeat(weight[part], many) * got[:, 1],
                                     (hi - lo) * wide).reshape(hi - lo, wide)
            lo = hi
        f = self.tile_of[term] >= 0
        dense = np.zeros((n, n_tiles))
        dense[row[f], self.tile_of[term[f]]] = weight[f]
        near = dense.astype(np.float32) @ self.tiles
        near += cos
        # vectors have unit length: rounded factors, products and sums differ by less than this
        error = (n_tiles + 8) * 2.0**-23
        kth = np.partition(near, wide - min(k, wide), axis=1)[:, wide - min(k, wide)]
        doc, example = np.nonzero((near >= kth[:, None] - 2 * error) & (near > 0))
        cos = cos[doc, example]
        size = self.own[example + 1] - self.own[example]
        total = np.r_[0, np.cumsum(size)]
        lo = 0
        while lo < len(doc):
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + ADDED, side="right")) - 1)
            many = size[lo:hi]
            take = np.repeat(self.own[example[lo:hi]] - total[lo:hi], many) + np.arange(total[lo], total[hi])
            at = np.repeat(doc[lo:hi] * n_tiles, many) + self.tile.take(take)
            cos[lo:hi] += np.bincount(np.repeat(np.arange(hi - lo), many),
                                      dense.ravel().take(at) * self.tile_weight.take(take), hi - lo)
            lo = hi
        # rounded: the order of equal cosines must not hang on how they were added up
        cos = np.round(cos, 12)
        o = np.lexsort((example, -cos, doc))
        o = o[cos[o] > 1e-12]
        many = counts_by(doc[o], n)
        place = np.arange(len(o)) - np.repeat(np.cumsum(many) - many, many)
        o, place = o[place < k], place[place < k]
        best[doc[o], place], sim[doc[o], place] = example[o], cos[o]


def votes(label: np.ndarray, best: np.ndarray, sim: np.ndarray) -> np.ndarray:
    """Share of label 1 among the neighbours, weighted by inverse distance."""
    w = np.where(best >= 0, 1 / (NEAR + np.maximum(0, 1 - sim)), 0.0)
    y = np.where(best >= 0, label[best], 0) if len(label) else np.zeros(best.shape)
    return (w * y).sum(1) / np.maximum(1e-300, w.sum(1))


@dataclass
class Model:
    """Vocabulary, index and calibration.  Its arrays reach the tasks by one
    Python broadcast; their size is bounded by the sample."""
    arrays: Broadcast          # vocabulary, idf, index
    knots: np.ndarray
    rates: np.ndarray
    k: int = NEIGHBOURS

    @property
    def index(self) -> Index:
        return self.arrays.value[2]


def neighbours(batches: Iterator[pa.RecordBatch], arrays: tuple, k: int
               ) -> Iterator[tuple[pa.RecordBatch, Index, np.ndarray, np.ndarray]]:
    """Chunks of the rows with the k nearest examples (or -1) and their cosines."""
    vocab, idf, index = arrays
    start_of = buckets(vocab)
    for b in batches:
        for r, buf, offs in chunks(b, "text", CHUNK):
            doc, term, count = vectors(buf, offs, vocab, start_of)
            w, ptr = weights(doc, term, count, idf, r.num_rows)
            yield r, index, *index.nearest(ptr, term, w, k)


def calibrate(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic steps (pool adjacent violators): knots and rates."""
    blocks: list[list[float]] = []
    for i in np.argsort(raw, kind="stable").tolist():
        blocks.append([raw[i], w[i] * y[i], w[i], raw[i]])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            b = blocks.pop()
            a = blocks[-1]
            blocks[-1] = [a[0], a[1] + b[1], a[2] + b[2], b[3]]
    if not blocks:
        return np.zeros(1), np.zeros(1)
    knots = np.array([x for b in blocks for x in (b[0], b[3])])
    rates = np.repeat([b[1] / b[2] for b in blocks], 2)
    return knots, rates


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", doc_id: str = "doc_id",
        text: str = "text", sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model:
    """``labels``: doc_id and label of the rows that may be learned from."""
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    labels = labels.select("doc_id", F.col(label).cast("int").alias("label")).dropna()
    total = {r[0]: r[1] for r in labels.groupBy("label").count().collect()}
    chosen = hash_sample(labels, "doc_id", "label", sample)
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id").cast("string")), F.lit(3))
    spark = docs.sparkSession
    context = spark.sparkContext
    rows = written(docs.join(F.broadcast(chosen), "doc_id").withColumn("calibrates", part == 0)
                   .withColumn("row", F.monotonically_increasing_id()))

    def emit_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, buf, offs in chunks(b, "text", CHUNK):
                doc, h, _ = _distinct(*terms(buf, offs))
                y = r.column(0).to_numpy(zero_copy_only=False)[doc] if len(doc) else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(y.astype(np.int32))], names=["term", "label"])

    id_type = rows.schema["doc_id"].dataType.simpleString()

    def emit_families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, buf, offs in chunks(b, "text", CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [r.column(0), r.column(1), pa.array(families(buf, offs).view(np.int64))],
                    names=["doc_id", "label", "family"])

    # copies of one text would make its chance words look like signs of its label
    fitting = rows.where(~F.col("calibrates"))
    first = (fitting.select("doc_id", "label", "text")
             .mapInArrow(emit_families, f"doc_id {id_type}, label int, family long")
             .groupBy("label", "family").agg(F.min("doc_id").alias("doc_id")))
    fitting = fitting.join(F.broadcast(first.select("doc_id", "label")), ["doc_id", "label"])
    of = {r[0]: r[1] for r in fitting.groupBy("label").count().collect()}
    n1, n0 = of.get(1, 0), of.get(0, 0)
    a, n = F.col("a"), F.col("n")
    chi2 = (F.pow(a * F.lit(float(n0)) - (n - a) * F.lit(float(n1)), 2) * F.lit(float(n0 + n1))
            / (F.lit(max(1.0, float(n0) * n1)) * n * F.greatest(F.lit(1.0), F.lit(float(n0 + n1)) - n)))
    share1 = a / F.lit(max(1.0, float(n1)))
    share0 = (n - a) / F.lit(max(1.0, float(n0)))
    purity = F.greatest(share0, share1) / (share0 + share1)
    chosen_terms = (fitting.select("label", "text").mapInArrow(emit_terms, "term long, label int")
                    .groupBy("term").agg(F.sum("label").cast("double").alias("a"),
                                         F.count("*").cast("double").alias("n"))
                    .where((n >= LEAST_DF) & (chi2 >= LEAST_CHI2) & (purity >= LEAST_PURITY))
                    .orderBy(chi2.desc(), "term").limit(vocabulary).select("term").collect())
    chosen_terms = np.array([r.term for r in chosen_terms], np.int64).view(np.uint64)

    # examples, numbered in the order of their keys (at most the sample)
    numbers = sorted(((r.doc_id, r.label, r.h, r.row) for r in rows.where("not calibrates").select(
        "doc_id", "label", F.xxhash64("text").alias("h"), "row").collect()))
    example = spark.createDataFrame([(r[3], i) for i, r in enumerate(numbers)], "row long, example int")
    examples = written(rows.join(F.broadcast(example), "row").select("example", "text"))

    def emit_vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, buf, offs in chunks(b, "text", CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(terms(buf, offs)[1]).view(np.int64))],
                                                 names=["term"])

    vocab = np.sort(examples.select("text").mapInArrow(emit_vocabulary, "term long").distinct()
                    .toArrow()["term"].to_numpy().view(np.uint64))
    vocabulary_of = context.broadcast(vocab)

    def count_df(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary_of.value
        df, n, start_of = np.zeros(len(vocab), np.int64), 0, buckets(vocab)
        for b in batches:
            for r, buf, offs in chunks(b, "text", CHUNK):
                df += counts_by(vectors(buf, offs, vocab, start_of)[1], len(vocab))
                n += r.num_rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, -1].astype(np.int32)), pa.array(np.r_[df[at], n])],
                                         names=["term", "df"])

    got = (docs.select("text").mapInArrow(count_df, "term int, df long")
           .groupBy("term").agg(F.sum("df").alias("df")).toArrow())
    at, n_docs = got["term"].to_numpy(), got["df"].to_numpy()
    df = np.zeros(len(vocab))
    df[at[at >= 0]] = n_docs[at >= 0]
    idf = np.log((1 + n_docs[at < 0].sum()) / (1 + df)) + 1
    idf[np.searchsorted(vocab, chosen_terms)] *= BOOST
    del got, at, n_docs, df
    weighing = context.broadcast((vocab, idf))

    def emit_postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, idf = weighing.value
        start_of = buckets(vocab)
        for b in batches:
            for r, buf, offs in chunks(b, "text", CHUNK):
                doc, term, count = vectors(buf, offs, vocab, start_of)
                w, _ = weights(doc, term, count, idf, r.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term.astype(np.int32)), r.column(0).take(pa.array(doc)), pa.array(w)],
                    names=["term", "example", "weight"])

    postings = (examples.mapInArrow(emit_postings, "term int, example int, weight double")
                .orderBy("term", "example").toArrow())
    size = np.bincount(postings["term"].to_numpy(), minlength=len(vocab))
    first, example, weight = np.r_[0, np.cumsum(size)], postings["example"].to_numpy(), postings["weight"].to_numpy()
    del postings
    arrays = context.broadcast((vocab, idf, Index.of_postings(
        np.array([r[0] for r in numbers]), np.array([r[1] for r in numbers], np.int32), first, example, weight)))
    del example, weight
    weighing.unpersist()
    vocabulary_of.unpersist()

    def emit_votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, index, best, sim in neighbours(batches, arrays.value, NEIGHBOURS):
            yield pa.RecordBatch.from_arrays([r.column(0), pa.array(votes(index.label, best, sim))],
                                             names=["label", "vote"])

    held = (rows.where("calibrates").select("label", "text").mapInArrow(emit_votes, "label int, vote double")
            .groupBy("vote", "label").count().orderBy("vote", "label").collect())
    y = np.array([r["label"] for r in held], float)
    n = np.array([r["count"] for r in held], float)
    taken = {v: max(1.0, n[y == v].sum()) for v in (0, 1)}
    w = np.array([total[int(v)] / taken.get(int(v), 1) for v in y], float) * n
    return Model(arrays, *calibrate(np.array([r["vote"] for r in held], float), y, w))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text",
          cut: float = 0.3) -> DataFrame:
    """doc_id, score, predicted (score >= cut) and evidence (neighbours, nearest first)."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    id_arrow = pa.string() if id_type == "string" else pa.int32() if id_type == "int" else pa.int64()

    arrays, knots, rates, k = model.arrays, model.knots, model.rates, model.k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, index, best, sim in neighbours(batches, arrays.value, k):
            s = np.interp(votes(index.label, best, sim), knots, rates)
            # a list column: the neighbours of a row are the first ones of its k
            found = best >= 0
            of = best[found]
            ends = np.r_[0, np.cumsum(found.sum(1))].astype(np.int32)
            one = pa.StructArray.from_arrays(
                [pa.array(index.key[of], id_arrow), pa.array(sim[found]), pa.array(index.label[of].astype(np.int32))],
                names=["doc_id", "cosine", "label"])
            yield pa.RecordBatch.from_arrays(
                [r.column(0), pa.array(s), pa.array((s >= cut).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends), one)],
                names=["doc_id", "score", "predicted", "evidence"])

    return docs.mapInArrow(run, f"doc_id {id_type}, score double, predicted int, "
                                f"evidence array<struct<doc_id:{id_type},cosine:double,label:int>>")
