"""Operator 9: language identification of mixed-language text.

1. Words are runs of letters (Unicode category L, with the marks that follow
   them); every other character ends one.  *Script ranges* narrow the
   candidates of each word: a language competes for a word only if its training
   words use that script (if none does, all compete).
2. *Per-word scores* are sums of log probabilities of hashed byte 4-grams
   (with word borders), learned for each language.
3. *Viterbi* over the words with a switching penalty labels spans of the
   text.  The documents of a few chunks of text advance together, word by word, so
   the loop is over positions, not documents.

A document's language is the one whose spans hold the most letters (ties: the
first by name); the score is its share of the letters times the logistic of
its mean lead per word over the runner-up.

Training uses about ``TRAIN_DOCS`` documents of each language, taken by key
hash over the whole table (rows with null lang or text are left out).

Defined results: null text, or text without a letter, gives ``und`` with score
0; without any training row everything is ``und``.  Repeated rows give
repeated rows; texts are read whole; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import hash_sample
from ._text import LETTER_BYTE, U, chunks, counts_by, mix, word_spans

TRAIN_DOCS = 5_000
SWITCH = 10.0
BUCKETS = 1 << 16
SMOOTH = 0.05
NEVER = -1e6
CHUNK = 1 << 20            # bytes of text scored at once: 4 bytes for each byte and language
TOGETHER = 4               # chunks of text that advance together

#: First code points of script ranges and their scripts (8: any other).
SCRIPT_RANGES = (
    (0x0, 1), (0x2C2, 8), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6),
    (0x900, 7), (0xD80, 8), (0xE00, 9), (0xE80, 8), (0x10A0, 10), (0x1100, 11), (0x1200, 8),
    (0x1E00, 1), (0x1F00, 2), (0x2000, 8), (0x3005, 13), (0x3041, 12), (0x3100, 13),
    (0x3130, 11), (0x3190, 13), (0xA000, 8), (0xAC00, 11), (0xD7B0, 8), (0xF900, 13), (0xFB00, 1),
    (0xFB07, 8), (0xFE70, 6), (0xFF00, 1), (0xFF66, 12), (0xFFA0, 11), (0x10000, 8), (0x20000, 13),
    (0xE0000, 8),
)
N_SCRIPTS = 14
NO_LETTER, MARK = 0, -1


def _ranges() -> tuple[np.ndarray, np.ndarray]:
    """First code points of runs of one kind: the script of letters, by Unicode
    general category (L), marks (M), and all else."""
    first, script = zip(*SCRIPT_RANGES)
    kinds = np.zeros(0x110000, np.int8)
    for c in range(0x110000):
        category = unicodedata.category(chr(c))[0]
        if category in "LM":
            kinds[c] = 1 if category == "L" else MARK
    of = np.array(script)[np.searchsorted(first, np.arange(0x110000), side="right") - 1]
    kinds = np.where(kinds == 1, of, kinds)
    new = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
    return new, kinds[new]


_FIRST, _SCRIPT = _ranges()

_LOWER = np.full(256, 32, np.uint32)
_LOWER[97:123] = np.arange(97, 123)
_LOWER[65:91] = np.arange(97, 123)
_LOWER[128:] = np.arange(128, 256)


def _scripts(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Script of each word's first character."""
    pad = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.int64)
    a, b, c, d = (pad[starts + i] for i in range(4))
    b, c, d = b & 63, c & 63, d & 63
    cp = np.select([a < 0x80, a < 0xE0, a < 0xF0],
                   [a, (a & 31) << 6 | b, (a & 15) << 12 | b << 6 | c],
                   (a & 7) << 18 | b << 12 | c << 6 | d)
    return _SCRIPT[np.searchsorted(_FIRST, cp, side="right") - 1]


def letters_only(buf: np.ndarray) -> np.ndarray:
    """The text with a space for every byte of a multi-byte character that is no
    letter, so that such marks, dashes and spaces end words.  A combining mark
    stays with the letter before it."""
    lead = np.flatnonzero(buf >= 0xC0)
    script = _scripts(buf, lead)
    drop = script == NO_LETTER
    if (script == MARK).any():
        char = np.flatnonzero((buf & 0xC0) != 0x80)                # first bytes of characters
        kind = LETTER_BYTE[buf[char]].astype(np.int8)
        kind[np.searchsorted(char, lead)] = np.sign(script)
        last = np.maximum.accumulate(np.where(kind >= 0, np.arange(len(char)), -1))
        alone = (kind == MARK) & ((last < 0) | (kind[last] != 1))
        drop |= alone[np.searchsorted(char, lead)]
    lead = lead[drop]
    out = buf.copy()
    for i, least in enumerate((0xC0, 0xC0, 0xE0, 0xF0)):
        out[lead[buf[lead] >= least] + i] = 32
    return out


def _grams(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A bucket for every letter byte: the 4-gram from the byte before it."""
    m = _LOWER[buf]
    p, q, r = np.full((3, len(buf)), 32, np.uint32)
    p[1:], q[:-1], r[:-2] = m[:-1], m[1:], m[2:]
    p[starts] = 32
    q[ends - 1] = r[ends - 1] = 32
    r[np.maximum(ends - 2, 0)] = 32
    code = (p << 24 | m << 16 | q << 8 | r)[LETTER_BYTE[buf]]
    return (mix(code.astype(np.uint64)) & U(BUCKETS - 1)).astype(np.int64)


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray          # (BUCKETS, langs) float32
    allowed: np.ndarray       # (N_SCRIPTS, langs) bool
    switch: float = SWITCH


def training_docs(docs: DataFrame, train: Column, doc_id: str, text: str, lang: str,
                  train_docs: int = TRAIN_DOCS) -> DataFrame:
    rows = docs.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull())
    return hash_sample(rows.select(docs[doc_id].alias("doc_id"), docs[lang].alias("lang"),
                                   docs[text].alias("text")), "doc_id", "lang", train_docs)


def fit(docs: DataFrame, train: Column | None = None, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang", train_docs: int = TRAIN_DOCS, switch: float = SWITCH) -> Model:
    """Count n-grams and scripts of the training documents by language."""
    rows = training_docs(docs, F.lit(True) if train is None else train, doc_id, text, lang, train_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for part, buf, offs in chunks(b, "text", CHUNK):
                buf = letters_only(buf)
                starts, ends, doc = word_spans(buf, offs, LETTER_BYTE)
                if not len(starts):
                    continue
                names, code = np.unique(np.array(part.column(0).to_pylist(), object).astype(str),
                                        return_inverse=True)
                g = _grams(buf, starts, ends)
                of = np.repeat(code[doc], ends - starts)
                s = _scripts(buf, starts)
                for k, name in enumerate(names.tolist()):
                    t = total.setdefault(name, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                    t[:BUCKETS] += counts_by(g[of == k], BUCKETS)
                    t[BUCKETS:] += counts_by(s[code[doc] == k], N_SCRIPTS)
        for name, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(t[at])],
                names=["lang", "bucket", "n"])

    got = (rows.select("lang", "text").mapInArrow(run, "lang string, bucket long, n long")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(got["lang"].unique())
    n = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    if langs:
        n[got["bucket"].to_numpy(), np.searchsorted(langs, got["lang"].to_numpy().astype(str))] = got["n"]
    grams = n[:BUCKETS] + SMOOTH
    words = n[BUCKETS:] / np.maximum(1, n[BUCKETS:].sum(0))
    allowed = words >= 0.01
    allowed[~allowed.any(1)] = True
    return Model(langs, np.log(grams / grams.sum(0)).astype(np.float32), allowed, switch)


def word_scores(buf: np.ndarray, offs: np.ndarray, model: Model
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, doc, letters, scores) of the words of a chunk."""
    buf = letters_only(buf)
    starts, ends, doc = word_spans(buf, offs, LETTER_BYTE)
    if not len(starts):
        return starts, ends, doc, np.zeros(0), np.zeros((0, len(model.langs)), np.float32)
    script = _scripts(buf, starts)
    size = ends - starts
    first = np.cumsum(size) - size
    score = np.add.reduceat(model.logp[_grams(buf, starts, ends)], first, axis=0)
    score[~model.allowed[script]] = NEVER
    return starts, ends, doc, size, score


def viterbi(score: np.ndarray, first: np.ndarray, count: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word; documents are runs of ``count`` words at ``first``.

    Step t handles the t-th word of all documents that have one.
    """
    label = np.zeros(len(score), np.int8 if score.shape[1] < 128 else np.int32)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    longest = int(count[0]) if len(count) else 0
    if not longest:
        return label
    active = np.searchsorted(-count, -np.arange(longest), side="left")
    stay = np.empty(score.shape, bool)           # at a word: keep the label before it
    jump = np.empty(len(score), label.dtype)     # else: the best label before it
    v = score[first[:active[0]]].astype(np.float64)
    for t in range(1, longest):
        n = active[t]
        at = first[:n] + t
        if len(v) > n:
            ended = first[n:len(v)] + t - 1
            label[ended] = v[n:].argmax(1)
            v = v[:n]
        best = v.argmax(1)
        leap = v[np.arange(n), best] - switch
        keep = v >= leap[:, None]
        stay[at], jump[at] = keep, best
        v = np.where(keep, v, leap[:, None]) + score[at]
    label[first[:len(v)] + longest - 1] = v.argmax(1)
    for t in range(longest - 1, 0, -1):
        at = first[:active[t]] + t
        now = label[at]
        label[at - 1] = np.where(stay[at, now], now, jump[at])
    return label


def _decide(n: int, doc: np.ndarray, letters: np.ndarray, score: np.ndarray, model: Model
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language index or -1, score, label of each word) of ``n`` documents."""
    k = len(model.langs)
    count = counts_by(doc, n)
    label = viterbi(score, np.cumsum(count) - count, count, model.switch)
    mass = counts_by(doc * k + label, n * k, letters).reshape(n, k)
    total = mass.sum(1)
    pred = mass.argmax(1)
    sums = np.stack([counts_by(doc, n, np.maximum(score[:, j], -200)) for j in range(k)], 1).astype(float)
    own = sums[np.arange(n), pred]
    if k > 1:
        sums[np.arange(n), pred] = -np.inf
        lead = (own - sums.max(1)) / np.maximum(1, count)
    else:
        lead = np.full(n, 40.0)
    conf = mass.max(1) / np.maximum(1, total) / (1 + np.exp(-np.clip(lead, -40, 40)))
    none = total == 0
    return np.where(none, -1, pred), np.where(none, 0.0, conf), label


def identify_rows(batch: pa.RecordBatch, text: str, model: Model
                  ) -> tuple[list[str], list[float], list[list[tuple[str, int, int]]]]:
    """Language, score and labelled byte spans of every row of a batch."""
    langs, scores, spans = [], [], []
    if not model.langs:
        n = batch.num_rows
        return ["und"] * n, [0.0] * n, [[] for _ in range(n)]
    parts, base = [], 0
    todo = batch.num_rows
    for rows, buf, offs in chunks(batch, text, CHUNK):
        s, e, doc, letters, score = word_scores(buf, offs, model)
        parts.append((s - offs[doc], e - offs[doc], doc + base, letters, score))
        base += rows.num_rows
        todo -= rows.num_rows
        if len(parts) == TOGETHER or not todo:
            for out, x in zip((langs, scores, spans), _label(parts, base, model)):
                out += x
            parts, base = [], 0
    return langs, scores, spans


def _label(parts: list, base: int, model: Model) -> tuple[list[str], list[float], list]:
    s, e, doc, letters, score = (np.concatenate(x) for x in zip(*parts))
    pred, conf, label = _decide(base, doc, letters, score, model)
    spans = [[] for _ in range(base)]
    cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])]) if len(doc) else []
    for lo, hi in zip(cut, np.r_[cut[1:], len(doc)] if len(doc) else []):
        spans[doc[lo]].append((model.langs[label[lo]], int(s[lo]), int(e[hi - 1])))
    return [model.langs[p] if p >= 0 else "und" for p in pred], conf.tolist(), spans


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and ``spans`` (lang, start, end in UTF-8 bytes)."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores, spans = identify_rows(b, "text", model)
            cells = [[{"lang": x, "start": s, "end": e} for x, s, e in row] for row in spans]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(cells, kind)], names=["doc_id", "lang_pred", "score", "spans"])

    return docs.mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double, "
                                "spans array<struct<lang:string,start:int,end:int>>")


def keep_identified(docs: DataFrame, model: Model, least_share: float = 0.4,
                    text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which one language labels enough of the text.

    Rejected are ``und`` rows and those whose language holds less than
    ``least_share`` of the labelled bytes (no language is dominant).
    """
    def share(lang: str, spans: list[tuple[str, int, int]]) -> float:
        return sum(e - s for x, s, e in spans if x == lang) / max(1, sum(e - s for _, s, e in spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, _, spans = identify_rows(b, text, model)
            yield b.filter(pa.array([x != "und" and share(x, s) >= least_share
                                     for x, s in zip(langs, spans)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
