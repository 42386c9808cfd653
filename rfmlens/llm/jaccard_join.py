"""Operator 10: exact n-gram Jaccard join by universe partition.

A document's set holds 64-bit hashes of its distinct word shingles.  For a
size band, the hash universe is dealt into segments.  Two linked sets differ
in at most ``H`` elements, so with segment weights (1: compared whole, 2:
compared with its one-deletion neighbourhood) that sum to more than ``H`` some
segment must match; equal segment hashes are the index.  How many segments of
either kind a band gets is the cheapest allocation under a cost model (index
rows plus expected chance collisions at the table's row count).

Exact handling of the two usual weak spots:

* *Empty segments* would put unrelated documents together.  The weights sum
  to ``H + 1 + z``; a document whose empty segments weigh at most ``z`` need
  not index them, because any link it has also matches a non-empty segment.
* *Groups of similar but unlinked texts* share many keys.  Every document that
  shares a key keeps a sketch: one byte for each sub-segment of its segments.
  Two sets differ in at least as many elements as their sketches do in bytes,
  which dismisses most pairs before whole sets are read.  Inside a group only
  the block of segments around the key is compared: the differences allowed to
  a pair of these sizes are shared out among the blocks by weight (rounded
  up); some block with a shared key keeps its share.  Pairs that do not are
  dismissed inside the task, without being emitted.  A set of segments that weigh
  up to ``SINGLE`` is one block: its pairs are held against the whole sketch there.

Steps: (1) keys with more than one distinct set (map-side combined, so copies
and hot keys collapse); (2) key rows and sketches of their documents (a
bitmap of fixed size thins the rest); (3) members are paired with the first
or last member of their groups, survivors verified on whole sets, links
united to components (this only spares work); (4) members outside their
group's larger components are paired with the closest member of another one
and linked likewise, ``LINKING`` times (this only spares work); (5) all pairs of
a group that are still in different components are compared by block,
survivors verified, components united.  Equal sets are
one class throughout.  Large groups are cut into chunk pairs; groups are compared
in ``PASSES`` jobs, so that only a part of the blocks is on disk at a time.

Defined results: a null or empty text (or one of spaces) has the empty set
and is linked with nothing; fewer words than a shingle make one shingle of
them all; repeated rows give repeated rows (with one component); rows with a
null ``doc_id`` get a null component and link with nothing; an empty table
gives an empty result; extra columns are ignored.  Sets are compared as
64-bit hashes of the words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_k
from ._common import written
from ._components import components
from ._text import NOT_SPACE, U, chunks, counts_by, mix, span_hashes, word_spans

SINGLE = 240               # a set whose segments weigh so much is one block, its whole sketch
BLOCK = 120                # about the segments of a block of a larger set; no block weighs over 255
SHORT = 40                 # a set of so many segments has finer sub-segments
FINEST, FINE = 12, 4       # sub-segments of a segment: of a short set, of a longer one
WIDTH = 960                # bytes of a block, at most (SINGLE * FINE, SHORT * FINEST)
CHUNK = 2 << 20            # bytes of text at a time
GROUP = 512                # rows of a group's chunk
PASSES = 2                 # jobs that compare the groups, each a part of them ...
PASS_ROWS = 100_000        # ... unless they have no more rows than this
LINKING = 2                # rounds that link outsiders before all pairs are compared
HELD_PAIRS = 1 << 18       # pairs a task holds back to drop repeated ones
FILTER_BITS = 1 << 26      # bitmap of shared keys; a full bitmap only costs time
COMMON = 1e-3              # share of shingles that unrelated documents have in common
PAIR_COST = 0.02           # a sketch comparison, in index rows
BAND_SHARE = 0.1           # documents of one band, as a share of all
WIDE = 2                   # a band spans this many threshold ratios


@dataclass
class Plan:
    """Bands and their allocation for a threshold num/den."""
    num: int
    den: int
    low: np.ndarray        # smallest size of each band (one more entry at the end)
    segs: np.ndarray       # segments of a band; 0: only equal sets can link
    loose: np.ndarray      # of these, segments with one-deletion neighbourhoods (the first ones)
    spare: np.ndarray      # z

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Most elements by which linked sets of these sizes differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)


def allocate(size: int, most: int, rows: int) -> tuple[int, int, int]:
    """(segments, loose segments, spare weight) of least cost for a band.

    Cost: index rows of a document, plus its expected chance collisions with
    ``rows`` others: segments of few and common elements, and empty segments
    where their expected weight (and three deviations) exceeds the spare.
    """
    best = (math.inf, 0, 0, 0)
    for part in (0, 0.25, 0.5, 0.75, 1):              # share of the weight in loose segments
        for extra in (0, 1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128):
            loose = round(part * (most + 1 + extra) / 2)
            whole = max(0, most + 1 + extra - 2 * loose)
            m, spare = whole + loose, whole + 2 * loose - most - 1
            mean = size / m
            none = math.exp(-mean)
            empty = whole * none + 2 * loose * none * (1 + mean)
            chance = (whole * (math.exp(-mean * (1 - COMMON)) - none)
                      + loose * 2 * mean * COMMON * math.exp(-mean * (1 - COMMON)))
            if empty + 3 * math.sqrt(2 * empty) > spare:
                chance += whole * none**2 + loose * none**2 * (1 + 2 * mean)
            cost = whole + loose * (1 + mean) + PAIR_COST * rows * chance
            if cost < best[0]:
                best = (cost, m, loose, spare)
    return best[1:]


def make_plan(num: int, den: int, rows: int, largest: int = 1 << 31) -> Plan:
    low = [1]
    while low[-1] <= largest:
        top = low[-1]
        for _ in range(WIDE):
            top = top * den // num + 1
        low.append(top)
    p = Plan(num, den, np.array(low), *np.zeros((3, len(low) - 1), np.int64))
    for b in range(len(low) - 1):
        top = low[b + 1] - 1
        most = int(p.differ(np.int64(top), np.int64(top * den // num)))
        if most:
            # the typical member of a band is smaller than its top
            p.segs[b], p.loose[b], p.spare[b] = allocate((low[b] + top) // 2, most, int(rows * BAND_SHARE))
    return p


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all documents, their number by document)."""
    n = len(offs) - 1
    s, e, doc = word_spans(buf, offs, NOT_SPACE)
    words = counts_by(doc, n)
    if not len(s):
        return np.zeros(0, np.uint64), words
    h = span_hashes(buf, s, e)
    first = np.cumsum(words) - words
    full = np.maximum(0, words - k + 1)
    size = np.where(words > 0, np.maximum(1, full), 0)
    at = np.cumsum(size) - size
    out = np.zeros(size.sum(), np.uint64)
    if len(h) >= k:
        roll = np.full(len(h) - k + 1, U(k))
        for i in range(k):
            roll = mix(roll * U(0x2545F4914F6CDD1D) + h[i:len(h) - k + 1 + i])
        inside = doc[:len(h) - k + 1] == doc[k - 1:]
        start = np.repeat(at - first, words)[:len(h) - k + 1] + np.arange(len(h) - k + 1)
        out[start[inside]] = roll[inside]
    for i in np.flatnonzero((words > 0) & (words < k)).tolist():
        v = np.full(1, U(words[i]))
        for w in h[first[i]:first[i] + words[i]]:
            v = mix(v * U(0x2545F4914F6CDD1D) + w)
        out[at[i]] = v[0]
    for lo, hi in zip(at.tolist(), (at + size).tolist()):
        if hi - lo > 1:
            out[lo:hi].sort()
    d = np.repeat(np.arange(n), size)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (d[1:] != d[:-1])
    return out[new], counts_by(d[new], n)


def _sums(at: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 of hashes by slot (exact: halves add below 2**53)."""
    lo = np.bincount(at, (h & U(0xFFFFFFFF)).astype(np.float64), n)
    hi = np.bincount(at, (h >> U(32)).astype(np.float64), n)
    return (hi.astype(np.uint64) << U(32)) + lo.astype(np.uint64)


def classes(sets: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each whole set; equal sets have equal ones."""
    d = np.repeat(np.arange(len(size)), size)
    return mix(_sums(d, mix(sets + U(5)), len(size)) + size.astype(np.uint64) * U(0x9E3779B97F4A7C15))


def keys(sets: np.ndarray, size: np.ndarray, p: Plan, bitmap: np.ndarray | None = None) -> Iterator[tuple]:
    """Index rows by family: (document, key).

    A document indexes the family of its own band, and that of the band below
    if sets of that band are large enough to link with it.  With a bitmap only
    the rows whose key it holds: (document, key, own, deleted, weights of block
    and family and spare weight (packed), start and length of the block's
    bytes (packed), bytes of all sketches, their offsets by document).
    """
    band = np.searchsorted(p.low, np.maximum(1, size), side="right") - 1
    d_all = np.repeat(np.arange(len(size)), size)
    for own in (True, False):
        b = band if own else band - 1
        use = (size > 0) & (b >= 0) & (p.segs[np.maximum(b, 0)] > 0)
        if not own:
            use &= size * p.num <= (p.low[np.maximum(b, 0) + 1] - 1) * p.den
        if not use.any():
            continue
        b = np.where(use, b, 0)
        m = np.where(use, p.segs[b], 0)
        base = np.r_[0, np.cumsum(m)]
        pick = use[d_all]
        d, h = d_all[pick], sets[pick]
        fineness = np.where(m <= SHORT, FINEST, FINE)
        wide = np.r_[0, np.cumsum(m * fineness)]
        fine = (mix(h + U(99)) % (m * fineness)[d].astype(np.uint64)).astype(np.int64)
        part = _sums(wide[d] + fine, h, wide[-1])
        sl = base[d] + fine // fineness[d]
        full = _sums(sl, h, base[-1])
        count = np.bincount(sl, minlength=base[-1])
        doc = np.repeat(np.arange(len(size)), m)
        seg = np.arange(base[-1]) - base[doc]
        salt = mix(seg.astype(np.uint64) * U(1000003) + b[doc].astype(np.uint64) * U(7919) + U(17))
        is_loose = seg < p.loose[b[doc]]
        empty = np.where(is_loose, 2 * (count <= 1), count == 0)
        shy = np.bincount(doc, empty, len(size)) <= p.spare[b]       # need not index empty segments
        slot = np.flatnonzero(~(shy[doc] & (count == 0)))
        key, gone = mix(full[slot] * U(3) + salt[slot]), np.zeros(len(slot), bool)
        drop = np.flatnonzero(is_loose[sl] & ~(shy[d] & (count[sl] == 1)))
        if len(drop):
            key = np.r_[key, mix((full[sl[drop]] - h[drop]) * U(3) + salt[sl[drop]])]
            slot, gone = np.r_[slot, sl[drop]], np.r_[gone, np.ones(len(drop), bool)]
        if bitmap is None:
            yield doc[slot], key
            continue
        keep = _has(bitmap, key)
        if not keep.any():
            continue
        slot, key, gone = slot[keep], key[keep], gone[keep]
        of, at = doc[slot], seg[slot]
        loose = p.loose[b[of]]
        first, after = _block(at, m[of], loose)
        weight = after - first + np.clip(loose - first, 0, after - first)
        weights = weight | (m[of] + loose) << 8 | p.spare[b[of]] << 36
        span = first * fineness[of] | (after - first) * fineness[of] << 32
        byte = (mix(part) & U(255)).astype(np.uint8)
        yield of, key, own, gone, weights, span, byte, wide


def _block(seg: np.ndarray, m: np.ndarray, loose: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """First segment and end of the block of a segment: all up to a weight of SINGLE,
    else blocks of about equal size."""
    blocks = np.where(m + loose <= SINGLE, 1, -(-(m + loose) // BLOCK))
    at = (seg * blocks + blocks - 1) // m              # floor(i * m / blocks) <= seg
    at = np.where(at * m // blocks > seg, at - 1, at)
    return at * m // blocks, (at + 1) * m // blocks


def _bitmap(found: DataFrame, key: str) -> np.ndarray:
    """A bitmap of FILTER_BITS bits of a column of hashes, built by the executors."""
    bit = F.pmod(F.col(key), F.lit(FILTER_BITS))
    rows = (found.select(bit.alias("bit"))
            .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8 + 4096 * 2, np.uint8)
    for r in rows:              # bucket numbers start at 1 for bits 1..32768
        lo = (r.bucket - 1) * 4096 + 4096
        part = np.frombuffer(r.bits, np.uint8)
        out[lo:lo + len(part)] = part
    return out


def _has(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    # Spark numbers: bucket = 1 + (bit - 1) / 32768, position = (bit - 1) mod 32768 for bit > 0
    bit = np.mod(key.view(np.int64), FILTER_BITS)
    at = np.where(bit > 0, bit - 1 + 32768, 0)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _firsts(cls: np.ndarray) -> np.ndarray:
    """Marks the first document of each class (copies of a chunk need no rows)."""
    first = np.zeros(len(cls), bool)
    first[np.unique(cls, return_index=True)[1]] = True
    return first


def _only(pick: np.ndarray, sets: np.ndarray, size: np.ndarray, cls: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return sets[pick[np.repeat(np.arange(len(size)), size)]], size[pick], cls[pick]


def index_rows(docs: DataFrame, k: int, p: Plan) -> DataFrame:
    """(key, cls): every index row of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, buf, offs in chunks(b, "text", CHUNK):
                sets, size = shingle_sets(buf, offs, k)
                cls = classes(sets, size).view(np.int64)
                sets, size, cls = _only(_firsts(cls), sets, size, cls)
                for doc, key in keys(sets, size, p):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(cls[doc])], names=["key", "cls"])

    return docs.select("text").mapInArrow(run, "key long, cls long")


DOC, ROW, SKETCH = 0, 1, 2


def member_rows(docs: DataFrame, k: int, p: Plan, bitmap: np.ndarray) -> DataFrame:
    """Of every document a DOC row; of the first document of a class in a chunk,
    if it shares a key, ROW rows (meta: own, deleted, weights; span: block of
    the sketch) and a SKETCH row of each family (meta: own).  A class may so
    have the same rows from several chunks."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(kind, cls, n, ids=None, key=None, meta=None, span=None, data=None):
            m, none = len(n), pa.nulls(len(n), pa.int64())
            long = lambda x: none if x is None else pa.array(x.astype(np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, kind, np.int32)), long(ids), pa.array(cls), pa.array(n.astype(np.int32)),
                 none if key is None else pa.array(key.view(np.int64)), long(meta), long(span),
                 pa.nulls(m, pa.binary()) if data is None else data],
                names=["kind", "doc_id", "node", "n", "key", "meta", "span", "data"])

        for b in batches:
            for r, buf, offs in chunks(b, "text", CHUNK):
                ids = r.column(0).to_numpy(zero_copy_only=False)
                sets, size = shingle_sets(buf, offs, k)
                cls = classes(sets, size).view(np.int64)
                yield out(DOC, cls, size, ids)
                sets, size, cls = _only(_firsts(cls), sets, size, cls)
                for doc, key, own, gone, weights, span, byte, wide in keys(sets, size, p, shared.value):
                    yield out(ROW, cls[doc], size[doc], key=key, span=span,
                              meta=int(own) | gone.astype(np.int64) << 1 | weights << 2)
                    mine = np.zeros(len(size), bool)
                    mine[doc] = True
                    width = np.diff(wide)
                    yield out(SKETCH, cls[mine], size[mine], meta=np.full(mine.sum(), int(own)),
                              data=_binary(np.r_[0, np.cumsum(width[mine])], byte[np.repeat(mine, width)]))

    return (docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(
        run, "kind int, doc_id long, node long, n int, key long, meta long, span long, data binary"))


def sketched(pairs: DataFrame, sketches: DataFrame, p: Plan) -> DataFrame:
    """Of (a, na, b, nb, own), with a in its own family, those whose sketches
    differ in no more bytes than linked sets of these sizes may in elements."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            most = p.differ(b.column("na").to_numpy().astype(np.int64), b.column("nb").to_numpy())
            keep = [(np.frombuffer(x.as_py(), np.uint8) != np.frombuffer(y.as_py(), np.uint8)).sum() <= h
                    for x, y, h in zip(b.column("x"), b.column("y"), most)]
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sketches.where("own = 1").select(F.col("node").alias("a"), F.col("data").alias("x"))
    two = sketches.select(F.col("node").alias("b"), "own", F.col("data").alias("y"))
    return (pairs.join(one, "a").join(two, ["b", "own"]).select("a", "b", "na", "nb", "x", "y")
            .mapInArrow(run, "a long, b long")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def compared(rows: DataFrame, p: Plan, nearest: bool = False) -> DataFrame:
    """Distinct pairs of a group, of different components, whose blocks pass:
    (a, na, b, nb, own) as ``sketched`` takes them.

    ``nearest``: only one pair of each outsider and task, that of the closest
    blocks, with columns outsider and far.  The outsider of a pair is the one
    whose component has fewer rows in the group.

    ``rows``: key, lo, hi, chunk, node, n, meta, data, comp.
    """
    columns = [*(["outsider", "far"] if nearest else []), "a", "na", "b", "nb", "own"]
    names = ("key", "lo", "hi", "chunk", "node", "n", "meta", "comp")

    def distinct(got: np.ndarray) -> np.ndarray:
        """Each row once; of an outsider's rows the first one."""
        got = np.unique(got, axis=0)
        return got[np.r_[True, got[1:, 0] != got[:-1, 0]]] if nearest and len(got) else got

    def passing(c: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs of rows of a group may be links; how much of their share differs."""
        big, small = np.maximum(c["n"][j], c["n"][i]), np.minimum(c["n"][j], c["n"][i])
        own, gone = c["meta"] & 1, c["meta"] >> 1 & 1
        ok = np.flatnonzero((c["comp"][j] != c["comp"][i]) & (gone[j] & gone[i] == 0) & (own[j] | own[i] == 1)
                            & (small * p.den >= big * p.num)
                            & ((c["lo"][j] == c["hi"][j]) | (c["chunk"][j] != c["chunk"][i])))
        keep, far = [], []
        for part in np.array_split(ok, len(ok) // 16_384 + 1):
            x, y = i[part], j[part]
            meta = c["meta"][y]
            block, whole, spare = meta >> 2 & 255, meta >> 10 & (1 << 28) - 1, meta >> 38
            most = p.differ(c["n"][x].astype(np.int64), c["n"][y])
            share = np.minimum(most, -(-block * (most + 1 + spare) // whole) - 1)
            differ = (c["data"][x] != c["data"][y]).sum(1)
            keep.append(part[differ <= share])
            far.append((differ * 1_000 // (share + 1))[differ <= share])
        return np.concatenate(keep), np.concatenate(far)

    def crossings(c: dict[str, np.ndarray], cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The passing pairs of the groups that hold several components; how far they are."""
        mixed = np.minimum.reduceat(c["comp"], cut[:-1]) != np.maximum.reduceat(c["comp"], cut[:-1])
        size = np.diff(cut)
        row = np.flatnonzero(np.repeat(mixed, size))
        after = np.repeat(cut[1:], size)[row] - row - 1          # later rows of the group
        left, right, far = [[np.zeros(0, np.int64)] for _ in range(3)]
        total = np.r_[0, np.cumsum(after)]
        lo = 0
        while lo < len(row):                                     # about 256k pairs at a time
            hi = max(lo + 1, int(np.searchsorted(total, total[lo] + (1 << 18), side="right")) - 1)
            n = after[lo:hi]
            i = np.repeat(row[lo:hi], n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            ok, share = passing(c, i, j)
            left.append(i[ok])
            right.append(j[ok])
            far.append(share)
            lo = hi
        return np.concatenate(left), np.concatenate(right), np.concatenate(far)

    def of_component(c: dict[str, np.ndarray], cut: np.ndarray) -> np.ndarray:
        """Rows of each row's group that are in its component."""
        group = np.repeat(np.arange(len(cut)), np.diff(np.r_[cut, len(c["comp"])]))
        o = np.lexsort((c["comp"], group))
        new = np.r_[True, (group[o][1:] != group[o][:-1]) | (c["comp"][o][1:] != c["comp"][o][:-1])]
        out = np.zeros(len(o), np.int64)
        out[o] = np.diff(np.r_[np.flatnonzero(new), len(o)])[np.cumsum(new) - 1]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros((0, len(columns)), np.int64)
        held = [none]                                # a pair meets under many keys: one row for all of a task

        def emit() -> pa.RecordBatch:
            got = distinct(np.concatenate(held))
            held[:] = [none]
            return pa.RecordBatch.from_arrays([pa.array(got[:, x]) for x in range(len(columns))], names=columns)

        def pairs(c: dict[str, np.ndarray], cut: np.ndarray) -> bool:
            """Keeps the passing pairs; true when enough of them wait."""
            i, j, far = crossings(c, cut) if len(cut) > 1 else np.zeros((3, 0), np.int64)
            own = c["meta"] & 1
            first = []
            if nearest and len(i):
                rows = of_component(c, cut[:-1])
                fewer = (rows[i] < rows[j]) | ((rows[i] == rows[j]) & (c["comp"][i] > c["comp"][j]))
                first = [np.where(fewer, c["node"][i], c["node"][j]), far]
            elif nearest:
                first = [far, far]
            # a is in its own family; of two such, the smaller node
            swap = (own[i] == 0) | ((own[j] == 1) & (c["node"][j] < c["node"][i]))
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            got = np.stack([*first, c["node"][i], c["n"][i], c["node"][j], c["n"][j], own[j]], 1)
            held.append(distinct(got.astype(np.int64)))
            if sum(map(len, held)) < HELD_PAIRS:
                return False
            held[:] = [distinct(np.concatenate(held))]
            return len(held[0]) >= HELD_PAIRS // 2

        rest: dict[str, np.ndarray] | None = None       # the last group of a batch may go on
        for b in batches:
            if not b.num_rows:
                continue
            c = {x: b.column(x).to_numpy() for x in names}
            data = b.column("data").cast(pa.large_binary())
            o = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
            c["data"] = np.zeros((b.num_rows, WIDTH), np.uint8)
            inside = np.arange(WIDTH) < np.diff(o)[:, None]
            c["data"][inside] = np.frombuffer(data.buffers()[2], np.uint8)[o[0]:o[-1]]
            if rest is not None:
                c = {x: np.concatenate([rest[x], v]) for x, v in c.items()}
            new = np.logical_or.reduce([c[x][1:] != c[x][:-1] for x in ("key", "lo", "hi")])
            cut = np.r_[0, np.flatnonzero(new) + 1]
            rest = {x: v[cut[-1]:] for x, v in c.items()}
            if pairs({x: v[:cut[-1]] for x, v in c.items()}, cut):
                yield emit()
        if rest is not None:
            pairs(rest, np.array([0, len(rest["key"])]))
        yield emit()

    order = ("key", "lo", "hi")
    return (rows.select("key", "lo", "hi", "chunk", "node", "n", "meta", "comp", "data")
            .repartition(*order).sortWithinPartitions(*order, "node")
            .mapInArrow(run, ", ".join(f"{x} long" for x in columns)).distinct())


def whole_sets(docs: DataFrame, k: int, nodes: DataFrame) -> DataFrame:
    """node and its whole set (data), of the nodes that a bitmap of ``nodes`` holds."""
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(nodes, "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, buf, offs in chunks(b, "text", CHUNK):
                sets, size = shingle_sets(buf, offs, k)
                cls = classes(sets, size)
                data, n, c = _only(_firsts(cls) & _has(wanted.value, cls) & (size > 0), sets, size, cls)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.view(np.int64)), _binary(np.r_[0, np.cumsum(n)] * 8, data)], names=["node", "data"])

    return docs.where("doc_id is not null").select("text").mapInArrow(run, "node long, data binary")


def verified(pairs: DataFrame, docs: DataFrame, k: int, p: Plan) -> DataFrame:
    """The pairs (a written table) whose whole sets reach the threshold, written.

    Sets are cut anew for the documents in question: fewer bytes than keeping
    the sets of all documents that share a key.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                u, v = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(both * p.den >= (len(u) + len(v) - both) * p.num)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = written(whole_sets(docs, k, nodes).dropDuplicates(["node"]))
    one = sets.select(F.col("node").alias("a"), F.col("data").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("data").alias("y"))
    return written(pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
                   .mapInArrow(run, "a long, b long"))


def mixed_rows(slim: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows of the groups that hold several components, written: key, node, n,
    meta, span, comp and the number of chunks of the group (of)."""
    known = slim.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = written(known.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"),
                                             F.count("*").alias("size")).where("x != y")
                    .select("key", F.ceil(F.col("size") / GROUP).cast("int").alias("of")))
    return written(slim.join(mixed, "key").join(comp, "node", "left")
                   .withColumn("comp", F.coalesce("comp", "node")))


def members(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows of ``mixed_rows`` as ``compared`` takes them: a large group in chunks,
    each pair of chunks a group of its own."""
    place = F.col("span").bitwiseAND((1 << 32) - 1).cast("int") + 1
    return (rows.withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("of")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
            .withColumn("own", F.col("meta").bitwiseAND(1)).join(sketches, ["node", "own"])
            .select("key", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                    "chunk", "node", "n", "meta", "comp",
                    F.substring("data", place, F.shiftright("span", 32).cast("int")).alias("data")))


def candidates(slim: DataFrame, sketches: DataFrame, comp: DataFrame, p: Plan, nearest: bool = False) -> DataFrame:
    """What ``compared`` finds in all groups that hold several components.

    The groups are dealt out by key into jobs, one after the other: the
    members' blocks, the most that the join shuffles, lie on disk for one
    job's groups at a time.
    """
    rows = mixed_rows(slim, comp)
    passes = PASSES if rows.count() > PASS_ROWS else 1
    turn = F.pmod(F.xxhash64("key"), F.lit(passes))
    found = [written(compared(members(rows.where(turn == i), sketches), p, nearest)) for i in range(passes)]
    return reduce(DataFrame.union, found).distinct()


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3,
         num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Documents link when den * intersection >= num * union of their sets of
    ``words``-word shingles; ids are integers.
    """
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    p = make_plan(num, den, docs.count())
    shared = written(index_rows(docs, words, p).groupBy("key")
                     .agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x != y").select("key"))
    rows = written(member_rows(docs, words, p, _bitmap(shared, "key")))
    is_doc, is_row = F.col("kind") == DOC, F.col("kind") == ROW
    cls = written(rows.where(is_doc).groupBy("node", "n").agg(F.min("doc_id").alias("least")))
    slim = written(rows.where(is_row).select("key", "node", "n", "meta", "span").dropDuplicates())
    sketches = written(rows.where(F.col("kind") == SKETCH).select("node", F.col("meta").alias("own"), "data")
                       .dropDuplicates(["node", "own"]))
    # members with the first and the last whole member (of the family's own band)
    # of their groups: the two of these each shares most keys with
    whole = F.struct("node", "n")
    ends = slim.where("(meta & 3) = 1").groupBy("key").agg(F.min(whole).alias("x"), F.max(whole).alias("y"))
    star = (slim.join(ends, "key")
            .select(F.explode(F.array("x", "y")).alias("e"), "node", "n", F.col("meta").bitwiseAND(1).alias("own"))
            .select(F.col("e.node").alias("a"), F.col("e.n").alias("na"), F.col("node").alias("b"),
                    F.col("n").alias("nb"), "own").where("a != b")
            .where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
            .groupBy("a", "na", "b", "nb", "own").count())
    star = top_k(star, ["b"], [F.desc("count"), F.col("a"), F.col("own")], 2)
    star = verified(written(sketched(star, sketches, p)), docs, words, p)
    links, comp = star, components(star)
    for _ in range(LINKING):
        # outsiders with the closest member of another component: links found
        # here spare all other pairs between the two components
        near = candidates(slim, sketches, comp, p, nearest=True)
        near = top_k(near, ["outsider"], ["far", "a", "b", "own"], 2).select("a", "na", "b", "nb", "own").distinct()
        near = verified(written(sketched(near, sketches, p)), docs, words, p)
        if near.isEmpty():
            break
        links = links.union(near)
        comp = components(links)
    cross = candidates(slim, sketches, comp, p)
    cross = verified(written(sketched(cross, sketches, p)), docs, words, p)
    comp = comp if cross.isEmpty() else components(links.union(cross))
    named = cls.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = named.join(least, "comp").select("node", "n", "component_id")
    found = rows.where(is_doc).select("doc_id", "n", "node").join(named, ["node", "n"]).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return found.union(_null_ids(docs.where("doc_id is null"), words))


def _null_ids(docs: DataFrame, k: int) -> DataFrame:
    """Rows without an id: their set sizes, no component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, buf, offs in chunks(b, "text", CHUNK):
                size = shingle_sets(buf, offs, k)[1].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [r.column(0), pa.array(size), pa.nulls(len(size), pa.int64())],
                    names=["doc_id", "n_shingles", "component_id"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, component_id long")
