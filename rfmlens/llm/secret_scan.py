"""Operator 1: secret scans with a trigram inverted index.

Each rule's regular expression is parsed and turned into a Boolean query over
trigrams of the lower-cased text (the scheme published for regular expression
search over trigram indexes).  A task reads an Arrow batch as one index
segment: postings (trigram -> documents of the segment) for the trigrams that
any query names, built over the raw bytes; queries intersect and unite the
postings, and only candidates are verified with the regex.  A rule without a
mandatory trigram (the hex rule) scans every text.  Segments live inside a
task, so there is no shuffle and memory is bounded by one chunk of text.

Defined results: a null text is an empty text (no span, digest of the empty
string); repeated rows give repeated rows; texts of any length are scanned
whole; an empty table gives an empty result; a null ``doc_id`` passes
through; columns other than the two named ones are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import chunks

#: One literal set may grow to this many strings before it is flushed.
MAX_STRINGS = 64


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0          # the group whose length counts
    least: int = 1          # shorter matches are dropped


#: The base kinds in their listed order, then the added ones.
BASE_RULES = (
    Rule("assign", "(" + "|".join(_any_case(w) for w in (
        "password", "passwd", "secret", "token", "api_?key"))
        + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
)
MORE_RULES = (
    Rule("forge", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("cloud", "AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 30),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 27),
)


# --- Boolean trigram queries -------------------------------------------------
# A query is True (everything), a trigram, or ("and"|"or", frozenset of queries).

def _join(op: str, parts) -> object:
    out = set()
    for p in parts:
        if p is True:
            if op == "or":
                return True
            continue
        if isinstance(p, tuple) and p[0] == op:
            out |= p[1]
        else:
            out.add(p)
    if op == "or":       # A or (A and B) is A
        sets = {q: q[1] if isinstance(q, tuple) and q[0] == "and" else {q} for q in out}
        out = {q for q in out if not any(sets[p] < sets[q] for p in out)}
    if not out:
        return True
    return next(iter(out)) if len(out) == 1 else (op, frozenset(out))


def _grams(strings: set[str]) -> object:
    return _join("or", [_join("and", [s.encode()[i:i + 3] for i in range(len(s.encode()) - 2)])
                        for s in strings])


def _low(code: int) -> str:
    return chr(code).lower() if code < 128 else chr(code)


def _exact(item) -> set[str] | None:
    """All (lower-cased) strings an AST item can match, if they are few."""
    op, arg = item
    if op is sre.LITERAL:
        return {_low(arg)}
    if op is sre.IN:
        out = set()
        for o, a in arg:
            if o is sre.LITERAL:
                out.add(_low(a))
            elif o is sre.RANGE and a[1] - a[0] < MAX_STRINGS:
                out |= {_low(c) for c in range(a[0], a[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _exact_seq(arg[-1])
    if op is sre.BRANCH:
        sets = [_exact_seq(b) for b in arg[1]]
        return None if any(s is None for s in sets) else set().union(*sets)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 2 and (s := _exact_seq(arg[2])):
        out, reps = set(), {""}
        for n in range(arg[1] + 1):
            if n >= arg[0]:
                out |= reps
            reps = {a + b for a in reps for b in s}
        return out if len(out) <= MAX_STRINGS else None
    return None


def _exact_seq(seq) -> set[str] | None:
    out = {""}
    for item in seq:
        s = _exact(item)
        if s is None or len(out) * len(s) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _need(seq) -> object:
    """The query every match of a sequence satisfies."""
    found, run = [], {""}
    for item in seq:
        s = _exact(item)
        if s is not None and len(run) * len(s) <= MAX_STRINGS:
            run = {a + b for a in run for b in s}
            continue
        found.append(_grams(run))
        run = s if s is not None else {""}
        if s is None:
            op, arg = item
            if op is sre.SUBPATTERN:
                found.append(_need(arg[-1]))
            elif op is sre.BRANCH:
                found.append(_join("or", [_need(b) for b in arg[1]]))
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
                found.append(_need(arg[2]))
    return _join("and", [*found, _grams(run)])


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a regex; True if it has no mandatory trigram."""
    return _need(sre_parser.parse(pattern))


def query_grams(q: object) -> set[bytes]:
    if q is True:
        return set()
    return {q} if isinstance(q, bytes) else set().union(*map(query_grams, q[1]))


class Segment:
    """Postings of one chunk for the given trigrams: trigram -> document bitmap."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, grams: list[bytes]):
        self.n = len(offs) - 1
        self.postings = {g: np.zeros(self.n, bool) for g in grams}
        if len(buf) < 3 or not grams:
            return
        low = buf.astype(np.uint32)
        low[(buf >= 65) & (buf <= 90)] += 32
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
        known = np.zeros(1 << 24, bool)
        codes = [int.from_bytes(g, "big") for g in grams]
        known[codes] = True
        at = np.flatnonzero(known[code])
        doc = np.searchsorted(offs, at, side="right") - 1
        inside = at + 3 <= offs[doc + 1]
        at, doc = at[inside], doc[inside]
        found = code[at]
        for g, c in zip(grams, codes):
            self.postings[g][doc[found == c]] = True

    def candidates(self, q: object) -> np.ndarray:
        if q is True:
            return np.ones(self.n, bool)
        if isinstance(q, bytes):
            return self.postings[q]
        parts = [self.candidates(p) for p in q[1]]
        return np.logical_and.reduce(parts) if q[0] == "and" else np.logical_or.reduce(parts)


def spans_of(text: str, rule: Rule, compiled: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches; too short ones are dropped."""
    return [m.span() for m in compiled.finditer(text)
            if m.end(rule.group) - m.start(rule.group) >= rule.least]


def _scan_regex(rule: Rule) -> re.Pattern:
    # a rule that is one repeated class: its matches are maximal runs
    if m := re.fullmatch(r"(\[[^\]\\]+\])\+", rule.pattern):
        return re.compile(f"{m[1]}{{{rule.least},}}")
    return re.compile(rule.pattern)


def _text(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)


OUT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
         more: tuple[Rule, ...] = MORE_RULES) -> DataFrame:
    """One row per row of ``docs``: counts, digest of the base spans, all spans."""
    rules = (*BASE_RULES, *more)
    id_type = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [_scan_regex(r) for r in rules]
        queries = [trigram_query(r.pattern) for r in rules]
        grams = sorted(set().union(*map(query_grams, queries)))
        base = len(BASE_RULES)
        for batch in batches:
            for rows, buf, offs in chunks(batch, "text"):
                seg = Segment(buf, offs, grams)
                found: list[list] = [[] for _ in range(seg.n)]
                texts: dict[int, str] = {}
                for k, (rule, rx, q) in enumerate(zip(rules, compiled, queries)):
                    for i in np.flatnonzero(seg.candidates(q)).tolist():
                        if i not in texts:
                            texts[i] = rows.column(1)[i].as_py() or ""
                        found[i] += [(s, k, rule.kind, e) for s, e in spans_of(texts[i], rule, rx)]
                cols: dict[str, list] = {c: [] for c in ("a", "c", "h", "sha", "all")}
                for f in found:
                    f.sort()
                    own = [x for x in f if x[1] < base]
                    for c, k in (("a", 0), ("c", 1), ("h", 2)):
                        cols[c].append(sum(x[1] == k for x in own))
                    cols["sha"].append(hashlib.sha256(_text(own).encode()).hexdigest())
                    cols["all"].append(_text(f))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *(pa.array(cols[c], pa.int64()) for c in "ach"),
                     pa.array(cols["sha"], pa.string()), pa.array(cols["all"], pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.mapInArrow(run, f"doc_id {id_type}, {OUT}")
