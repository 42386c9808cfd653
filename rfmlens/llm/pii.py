"""Operator 8: personal data by candidate gradient boosting.

1. *Generators* with high recall propose overlapping spans: the four base
   formats before their checks, and loose forms (spelled-out mail addresses,
   digits and digit groups without a plus sign, letter-and-digit account
   numbers).
2. *Boosted trees* score every candidate from format features (digit and
   separator counts, group lengths, Luhn digit, octet range) and context
   features (cue words and character classes around it).  What labels a loose
   candidate in training is not among them (see ``features``), so the trees
   have to find the form of such spans, not repeat the rule.
3. *Calibrated thresholds*: a third of all candidates of the table is held back
   from the trees; scores are calibrated on them, and a kind's threshold is the
   smallest calibrated score at which its precision there is at least
   ``PRECISION``; a kind with too few candidates to tell takes the threshold of
   all kinds together.  The held-back candidates are scored and counted by kind
   and score step (``STEPS`` of them) in a Spark job; the counts reach the driver.

The base formats' checked matches are always kept; the model adds spans that
overlap no base span (and each other), best score first.

Training labels are weak.  A candidate of a base format is positive if it
passes the format's check; a loose one if evidence other than that check holds
(``evidence``: check digits of an account number, a spelled-out address with a
proper last label, a number plan or a cue word right before a phone number).
All others are negative, except that candidates that overlap a base span are
not used.
The trees' sample holds the candidates of about ``TRAIN_DOCS`` documents, taken by
key hash over the whole table, and of those at most ``TRAIN_ROWS``, an equal
share for each kind, in the order of a hash, those held back left out; what
reaches the driver does not grow with the input.

Defined results: a null text is empty and has no span; repeated rows give
repeated rows; an empty table gives an empty result and an untrained model;
extra columns are ignored by ``detect`` and kept by ``redact``.  Of added spans
that overlap the best score stays, of equal ones the longest.  Texts of any
length are read whole, in time proportional to n log n of their candidates;
memory is one Arrow batch.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _trees
from ._common import hash_share

TRAIN_DOCS = 100_000
TRAIN_ROWS = 20_000
PRECISION = 0.98
STEPS = 1 << 14            # of the score: what is calibrated and counted is its step
KINDS = ("email", "ip", "card", "phone")
#: Cue words looked for around a candidate.
CUES = {"mail": ("mail", "contact", "write", "@"), "ip": ("ip", "host", "server", "addr"),
        "card": ("card", "visa", "credit", "pay", "iban", "account"),
        "phone": ("phone", "tel", "call", "mobile", "fax", "dial")}
CONTEXT = 24

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_AT = re.compile(r"[\[(] ?at ?[\])]")
#: No space beside a plain dot: does not run on into the next sentence.
_SPELLED = re.compile(r"[A-Za-z0-9._-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}"
                      r"(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]{2,63}){1,4}")
LOOSE = (("email", _SPELLED),
         ("email", re.compile(r"[A-Za-z0-9._-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}"
                              r"(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]{2,63}){1,4}")),
         ("phone", re.compile(r"(?<![0-9])\(?[0-9]{2,4}\)?[ ./-][0-9]{2,4}[ ./-][0-9]{2,8}(?![0-9])")),
         ("phone", re.compile(r"(?<![0-9])\(?[0-9]{2,5}\)?(?:[ ./-][0-9]{2,8}){1,4}(?![0-9])")),
         ("phone", re.compile(r"(?<![0-9])\([0-9]{2,5}\) [0-9]{2,4}(?:[ ./-][0-9]{2,8}){0,3}(?![0-9])")),
         ("phone", re.compile(r"(?<![0-9])[0-9]{7,15}(?![0-9])")),
         ("card", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
                             r"(?![A-Za-z0-9])")))
_DIGITS = re.compile("[0-9]+")
_LABEL = re.compile(r"[^A-Za-z][A-Za-z]{2,24}$")
_DATE = re.compile(r"[0-9]{1,2}[ ./-][0-9]{1,2}[ ./-][0-9]{4}(?![0-9])|[0-9]{4}[ ./-][0-9]{2}[ ./-][0-9]{2}(?![0-9])")
_CALLED = re.compile(r"(?<![a-z])(?:(?:tele|cell)?phone|tel|call|mobile|fax|dial)(?![a-z])[^0-9a-z]{0,4}"
                     r"(?:(?:us|me|at|on|is|no|nr|number)[^0-9a-z]{1,3}){0,2}$")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ (linear time)."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done and (m := _DOMAIN.match(text, at)):
            lo = at
            while lo > done and text[lo - 1] in _LOCAL_CHARS:
                lo -= 1
            if lo < at:
                out.append((lo, m.end()))
                done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def _octets_ok(s: str) -> bool:
    return all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in s.split("."))


def base_candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, passes its check) of the base formats."""
    out = [(0, s, e, True) for s, e in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):      # nothing below matches without a digit
        return out
    out += [(1, m.start(), m.end(), _octets_ok(m[0])) for m in _IP.finditer(text)]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if len(digits) >= 7:      # shorter ones propose nothing
            out.append((2, m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)))
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = sum(c.isdigit() for c in m[0])
            out.append((3, m.start(), m.end(), 8 <= n <= 15))
    return out


def mod97(account: str) -> bool:
    """The check digits of an international account number hold."""
    a = account.replace(" ", "")
    return 15 <= len(a) <= 34 and int("".join(str(int(c, 36)) for c in a[4:] + a[:4])) % 97 == 1


def _account_end(text: str, start: int, end: int) -> int:
    """Where the longest part up to a space ends whose check digits hold; else ``end``."""
    at = end
    while at - start >= 15:
        if mod97(text[start:at]):
            return at
        at = text.rfind(" ", start, at)
    return end


def number_plan(s: str) -> bool:
    """Grouped digits as North American or trunk-prefixed (leading 0) numbers have them."""
    g = _DIGITS.findall(s)
    if len(g) < 2 or _DATE.search(s):
        return False
    if [len(x) for x in (g[1:] if g[0] == "1" else g)] == [3, 3, 4]:
        return g[-3][0] >= "2" and g[-2][0] >= "2"
    return g[0][0] == "0" and g[0][:2] != "00" and 9 <= sum(map(len, g)) <= 12


def whole_run(text: str, start: int, end: int) -> bool:
    """Not a part of a longer code: no letter beside it, nor digits behind one of its own separators."""
    s, left, right = text[start:end], text[max(0, start - 2):start], text[end:end + 2]
    return not (left[-1:].isalpha() or right[:1].isalpha()
                or len(left) == 2 and left[1] in " ./-" and left[1] in s and left[0].isdigit()
                or len(right) == 2 and right[0] in " ./-" and right[0] in s and right[1].isdigit())


def called(text: str, start: int) -> bool:
    """A phone cue word stands right before ``start``."""
    return bool(_CALLED.search(text[max(0, start - CONTEXT):start].lower()))


def evidence(text: str, kind: int, start: int, end: int) -> bool:
    """What speaks for a loose candidate, other than a base format's check."""
    s = text[start:end]
    if KINDS[kind] == "email":
        return bool("@" not in s and _SPELLED.fullmatch(s) and _LABEL.search(s))
    if KINDS[kind] == "card":
        return s[:2].isalpha() and mod97(s)
    if KINDS[kind] == "phone" and s[0] != "+" and 7 <= sum(map(len, _DIGITS.findall(s))) <= 15:
        return number_plan(s) and whole_run(text, start, end) or called(text, start) and not _DATE.search(s)
    return False


def candidates(text: str) -> list[tuple[int, int, int, bool]]:
    out = base_candidates(text)
    seen = {c[:3] for c in out}
    digits = bool(_DIGITS.search(text))
    for name, rx in LOOSE:
        if not (_AT.search(text) if name == "email" else digits):
            continue
        kind = KINDS.index(name)
        for m in rx.finditer(text):
            c = (kind, m.start(), _account_end(text, *m.span()) if name == "card" else m.end())
            if c not in seen:
                seen.add(c)
                out.append((*c, False))
    return out


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format and context of a candidate.  None of the labelling rules below is
    among them: not the check digits, not the number plans, and no cue words
    where a cue word may have given the label (phone numbers)."""
    s = text[start:end]
    left, right = text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    runs = _DIGITS.findall(s)
    digits = "".join(runs)
    groups = [len(g) for g in runs] or [0]
    around = (left + " " + right).lower()
    octets = s.split(".")
    cued = KINDS[kind] != "phone"
    shape = (groups + [0, 0, 0])[:3]
    return [
        *(float(kind == k) for k in range(len(KINDS))),
        len(s), len(digits), len(groups), max(groups), min(groups), *shape, groups[-1],
        sum(c.isalpha() for c in s), s.count("."), s.count("-"), s.count(" "), s.count("("), s.count("["),
        float(s[:1] == "+"), float("@" in s), len(s) - s.rfind(".") - 1 if "." in s else 0,
        float(s[:1] == "0"), float(s[:2].isalpha() and s[:2].isupper()), float(runs[0][:1] or -1) if runs else -1.0,
        float(runs[1][:1]) if len(runs) > 1 else -1.0, float(s[-1:].isalpha()),
        float(len(digits) >= 12 and luhn(digits)),
        max((int(o) for o in octets if 0 < len(o) < 6 and o.isascii() and o.isdigit()), default=-1),
        *(float(cued and any(c in around for c in cues)) for cues in CUES.values()),
        float(left[-1:].isalnum()), float(right[:1].isalnum()), float(left[-1:] in "\"'([{<"),
        float(left[-1:] == "" or left[-1:].isspace()), float(right[:1] == "" or right[:1].isspace()),
        float(whole_run(text, start, end)),
        sum(c.isdigit() for c in around) / max(1, len(around)),
    ]


@dataclass
class Model:
    forest: _trees.Forest
    knots: np.ndarray
    rates: np.ndarray
    least: tuple[float, ...]          # calibrated threshold of each kind

    def score(self, rows: list[list[float]]) -> np.ndarray:
        raw = self.forest.predict(np.array(rows, np.float64))
        return _trees.calibrated(steps(raw) / STEPS, self.knots, self.rates)


def steps(raw: np.ndarray) -> np.ndarray:
    return np.floor(raw * STEPS).astype(np.int32)


class Taken:
    """Spans that others must not overlap; a look-up halves its way to them."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        i = bisect.bisect_left(self.starts, b) - 1          # the last one that starts before b
        return i >= 0 and self.ends[i] > a

    def add(self, a: int, b: int) -> None:
        """A span that meets none."""
        i = bisect.bisect_left(self.starts, a)
        self.starts.insert(i, a)
        self.ends.insert(i, b)


def weak_labels(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, label) of the candidates that have a weak label (see above)."""
    cand = candidates(text)
    base = Taken([(s, e) for _, s, e, ok in cand if ok])
    for k, s, e, ok in cand:
        if ok or not base.meets(s, e):
            yield k, s, e, ok or evidence(text, k, s, e)


def training_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row for each candidate with a weak label, from all documents."""
    docs = docs.select(docs[doc_id].cast("string").alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: tuple[list, ...] = ([], [], [], [], [])
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py() or ""
                for k, s, e, label in weak_labels(t):
                    for c, v in zip(cols, (i, k, s, label, features(t, k, s, e))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                 pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.bool_()),
                 pa.array(cols[4], pa.list_(pa.float64()))],
                names=["doc_id", "kind", "start", "label", "x"])

    return docs.mapInArrow(run, "doc_id string, kind int, start int, label boolean, x array<double>")


#: The part of the candidates that the trees do not see.
HELD = "pmod(xxhash64(doc_id, start, kind), 3) = 0"


def held_counts(docs: DataFrame, forest: _trees.Forest, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """kind, step of the score, n, positive: the held-back candidates of all documents."""
    docs = docs.select(docs[doc_id].cast("string").alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, found, x = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                t = t.as_py() or ""
                for c in weak_labels(t):
                    ids.append(i)
                    found.append(c)
                    x.append(features(t, *c[:3]))
            if ids:
                kind, start, _, label = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.string()), pa.array(kind, pa.int32()), pa.array(start, pa.int32()),
                     pa.array(label, pa.bool_()), pa.array(steps(forest.predict(np.array(x, np.float64))), pa.int32())],
                    names=["doc_id", "kind", "start", "label", "step"])

    rows = docs.mapInArrow(run, "doc_id string, kind int, start int, label boolean, step int")
    return (rows.where(HELD).groupBy("kind", "step")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("label").alias("positive")))


def threshold(score: np.ndarray, positive: np.ndarray, n: np.ndarray, precision: float,
              least_rows: int = 30) -> float | None:
    """The smallest score from which on ``precision`` of the rows are positive
    (2.0: none is); None with too few rows to tell.  An entry stands for ``n``
    rows, ``positive`` of them."""
    if n.sum() < least_rows:
        return None
    o = np.argsort(-score, kind="stable")
    s, rows = score[o], np.cumsum(n[o])
    share = np.cumsum(positive[o]) / rows
    last = np.r_[s[1:] != s[:-1], True]
    good = np.flatnonzero((share >= precision) & last & (rows >= least_rows))
    return float(s[good[-1]]) if len(good) else 2.0


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
        train_docs: int = TRAIN_DOCS, train_rows: int = TRAIN_ROWS,
        precision: float = PRECISION) -> Model:
    """Trees on a sample of two thirds of the candidates, calibration and
    thresholds on all of the rest."""
    # each kind has its share of the rows, so that none starves another
    order = Window.partitionBy("kind").orderBy(F.xxhash64("doc_id", "start", "kind"), "doc_id", "start")
    some = hash_share(docs, doc_id, train_docs)
    sample = (training_rows(some, doc_id, text).withColumn("h", F.xxhash64("doc_id", "start", "kind"))
              .withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= train_rows // len(KINDS)).collect())
    sample.sort(key=lambda r: (r.h, r.doc_id or "", r.kind, r.start))
    x = np.array([r.x for r in sample] or np.zeros((0, 1)), np.float64)
    y = np.array([r.label for r in sample], float)
    held = np.array([r.h % 3 == 0 for r in sample], bool)
    none = Model(_trees.fit(np.zeros((0, 1)), np.zeros(0)), np.zeros(1), np.zeros(1), (2.0,) * len(KINDS))
    if held.all():
        return none
    forest = _trees.fit(x[~held], y[~held])
    counts = sorted(held_counts(docs, forest, doc_id, text).collect())
    if not counts:
        return none
    kind, step, n, positive = np.array(counts, np.int64).T
    raw = step / STEPS
    steps_of = np.unique(step, return_inverse=True)[1]             # all kinds are calibrated together
    knots, rates = _trees.isotonic(np.unique(raw), np.bincount(steps_of, positive), np.bincount(steps_of, n))
    score = _trees.calibrated(raw, knots, rates)
    least = [threshold(score[kind == k], positive[kind == k], n[kind == k], precision) for k in range(len(KINDS))]
    pooled = threshold(score, positive, n, precision)              # for kinds too rare to judge alone
    least = [(2.0 if pooled is None else pooled) if t is None else t for t in least]
    return Model(forest, knots, rates, tuple(least))


def spans_of(text: str, model: Model) -> list[tuple[int, int, int, bool]]:
    """Selected spans (kind, start, end, base) by kind, then start."""
    cand = candidates(text)
    out = [c for c in cand if c[3]]
    rest = [c for c in cand if not c[3]]
    if rest:
        taken = Taken([(s, e) for _, s, e, _ in out])
        score = model.score([features(text, k, s, e) for k, s, e, _ in rest])
        for i in np.lexsort(([s - e for _, s, e, _ in rest], -score)).tolist():      # equal scores: longest first
            k, s, e, _ = rest[i]
            if score[i] >= model.least[k] and not taken.meets(s, e):
                out.append(rest[i])
                taken.add(s, e)
    return sorted(out)


def _text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e, _ in spans)


OUT = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def detect(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts and digest of the base spans, all spans."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: list[list[int]] = [[], [], [], []]
            sha, spans = [], []
            for t in b.column(1):
                found = spans_of(t.as_py() or "", model)
                base = [f for f in found if f[3]]
                for k in range(4):
                    n[k].append(sum(f[0] == k for f in base))
                sha.append(hashlib.sha256(_text(base).encode()).hexdigest())
                spans.append(_text(found))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in n),
                 pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.mapInArrow(run, f"doc_id {id_type}, {OUT}")


def redact_text(text: str, model: Model) -> str:
    """Spans replaced by their kind in brackets; overlaps become one gap."""
    out, done = [], 0
    for s, e, k in sorted((s, -e, k) for k, s, e, _ in spans_of(text, model)):
        e = -e
        if e <= done:
            continue
        if s >= done:
            out += [text[done:s], f"[{KINDS[k].upper()}]"]
        done = e
    return "".join(out) + text[done:]


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the selected spans of ``text`` replaced; a null stays null."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [None if (v := t.as_py()) is None else redact_text(v, model) for t in b.column(at)]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
