"""Ranked lexical search by pipelined term partitioning.

Index: a task cuts its documents into shards of some megabytes and writes, for
every term of a shard, one row of postings (document numbers in the shard and
frequencies), and for the shard its ids and lengths.  All terms and all
documents are indexed; the table serves any number of searches.

Search: the query terms are dealt to successive owners, rarest first, by their
share of all postings.  A bundle - the items of a block and one shard, with a
sparse set of document accumulators - travels from owner to owner: each stage
cogroups the bundles with the postings its owner holds and adds their integer
contributions.  A bundle drops an accumulator when even the largest
contributions of all later owners could not lift it to the k-th best score of
its item in the shard: that cannot change the result, since scores only grow.
The last stage keeps the k best of each item and shard, and the k best of
these are the answer.  Bundles hold at most ``SHARD_DOCS`` x ``BLOCK_ITEMS``
accumulators, whatever the size of the corpus or of the query set.

Terms: maximal runs of letters, digits and characters beyond ASCII, A-Z lower
case.  A document scores w * (10^9 tf div (1000 tf + 8 m)) for each query term
it holds, m = 25 + 75 n N div L, w = floor(1000 ln((2 N + 2) / (2 df + 1))).
In a task, words are told apart by 64-bit hashes whose bytes are then compared.

Defined results.  Null and empty texts, and texts without a term, are not
counted and never found; an item without a term has no rows.  Texts of any
length are indexed whole (a longer one is a shard of its own).  Equal scores
rank by ascending id, a null id first.  Repeated rows and equal ids are
documents of their own, each with its rank.  Items that share an id (a null id
too) are one query whose terms add up.  Empty tables give no rows.  Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import written
from ._order import running
from ._text import chunks, counts_by, span_hashes, word_spans

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[48:58] = TERM_BYTE[65:91] = TERM_BYTE[97:123] = True
TERM_BYTE[128:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SHARD_BYTES = 8 << 20
SHARD_DOCS = 1 << 14
BLOCK_ITEMS = 256
STAGES = 3
MASS_STEP = 4                   # an owner holds about so many times the postings of the one before
TOP = 10


def _gather(buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The bytes of the given spans, end to end."""
    before = np.cumsum(lens) - lens
    return buf[np.repeat(starts - before, lens) + np.arange(int(lens.sum()))]


def _distinct(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word's term, one word of each term): equal terms, equal bytes."""
    _, first, number = np.unique(span_hashes(buf, starts, ends), return_index=True, return_inverse=True)
    lens = ends - starts
    same = (lens == lens[first][number]).all()
    if same and (_gather(buf, starts, lens) == _gather(buf, starts[first][number], lens)).all():
        return number, first
    words = [buf[a:b].tobytes() for a, b in zip(starts, ends)]      # two words share a hash
    seen: dict[bytes, int] = {}
    number = np.array([seen.setdefault(w, len(seen)) for w in words])
    return number, np.unique(number, return_index=True)[1]


def _narrow(a: np.ndarray) -> np.ndarray:
    """Positive numbers in as few bytes as they need."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def _binaries(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int64) * flat.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [
        None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def _shard(shard: int, ids: pa.Array, buf: np.ndarray, offs: np.ndarray) -> Iterator[pa.RecordBatch]:
    starts, ends, doc = word_spans(buf, offs, TERM_BYTE)
    if not len(starts):
        return
    n = counts_by(doc, len(ids)).astype(np.int64)
    kept = n > 0                                     # a document without a term is in no shard
    doc, n, ids = (np.cumsum(kept) - 1)[doc], n[kept], ids.filter(pa.array(kept))
    buf = LOWER[buf]
    number, first = _distinct(buf, starts, ends)
    key, tf = np.unique(number * len(ids) + doc, return_counts=True)
    term, doc = key // len(ids), key % len(ids)
    stop = np.cumsum(np.bincount(term))
    lens = (ends - starts)[first]
    text = _gather(buf, starts[first], lens)
    terms = pa.Array.from_buffers(pa.large_string(), len(first), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)), pa.py_buffer(text)])
    k = len(first)
    no_ids = pa.nulls(k, pa.list_(ids.type))
    tops = np.maximum.reduceat(tf, np.concatenate([[0], stop[:-1]]))
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(k, shard), pa.int64()), terms.cast(pa.string()), _binaries(doc.astype("<u2"), stop),
        _binaries(_narrow(tf), stop), pa.array(tops.astype(np.int64)), no_ids], names=COLS)
    yield pa.RecordBatch.from_arrays([
        pa.array([shard], pa.int64()), pa.array([None], pa.string()), pa.array([None], pa.binary()),
        pa.array([n.astype("<i8").tobytes()], pa.binary()), pa.array([int(n.sum())], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names=COLS)


COLS = ["shard", "term", "docs", "tfs", "top", "ids"]


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index, written: rows (shard, term, docs, tfs, top) with ``docs`` the
    16-bit numbers of the documents that hold the term, ``tfs`` its frequencies
    and ``top`` the largest; and one row a shard without a term, with the
    documents' ids, ascending, their lengths (``tfs``, 64 bits each) and the sum
    of these (``top``); documents without a term are left out."""
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("shard", T.LongType()), T.StructField("term", T.StringType()),
                           T.StructField("docs", T.BinaryType()), T.StructField("tfs", T.BinaryType()),
                           T.StructField("top", T.LongType()), T.StructField("ids", T.ArrayType(kind))])
    most_bytes, most_docs = SHARD_BYTES, SHARD_DOCS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal shard
            rows = pa.Table.from_batches(held).sort_by([("id", "ascending")]).combine_chunks()
            nulls = rows["id"].is_null()
            rows = pa.concat_tables([rows.filter(nulls), rows.filter(pa.compute.invert(nulls))]).combine_chunks()
            for batch in rows.to_batches(most_docs):
                for part, buf, offs in chunks(batch, "text", most_bytes):
                    yield from _shard(shard, part.column(0), buf, offs)
                    shard += 1

        for b in batches:
            for part, buf, _ in chunks(b, "text", most_bytes):
                if held and (size + len(buf) > most_bytes or sum(map(len, held)) + len(part) > most_docs):
                    yield from flush()
                    held, size = [], 0
                held.append(part)
                size += len(buf)
        if held:
            yield from flush()

    named = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return written(named.mapInArrow(run, schema))


def query_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """block, slot, item_id, term, qtf of every item with a term, written."""
    lower = F.translate(F.col(text), ascii_uppercase, ascii_lowercase)
    words = items.select(F.col(item_id).alias("item_id"), F.explode(F.regexp_extract_all(
        lower, F.lit(TERM), F.lit(0))).alias("term"))
    bags = (words.groupBy("item_id", "term").agg(F.count("*").alias("qtf"))
            .groupBy("item_id").agg(F.collect_list(F.struct("term", "qtf")).alias("bag")))
    placed = running(bags, [], ["item_id"], {"pos": F.lit(1)})
    return written(placed.select(
        F.expr(f"pos div {BLOCK_ITEMS}").alias("block"), F.expr(f"cast(pos % {BLOCK_ITEMS} as int)").alias("slot"),
        "item_id", F.explode("bag").alias("b")).select("block", "slot", "item_id", "b.term", "b.qtf"))


def owners(postings: DataFrame, n_docs: int, stages: int) -> DataFrame:
    """term, w, owner (from 0, rarest terms first) and the largest part a posting can have."""
    df = (postings.groupBy("term").agg(F.sum(F.octet_length("docs") / 2).cast("long").alias("df"),
                                       F.max("top").alias("top")))
    placed = running(written(df), [], ["df", "term"], {"mass": F.col("df")})
    share = F.col("mass") / F.col("mass_all")
    owner = sum((F.when(share >= MASS_STEP ** (s - stages), 1).otherwise(0) for s in range(1, stages)), F.lit(0))
    w = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * n_docs + 2)) / (F.lit(2.0) * F.col("df") + 1)))
    part = F.expr("(1000000000 * top) div (1000 * top + 200)")
    return written(placed.select("term", w.cast("long").alias("w"), owner.cast("int").alias("owner"),
                                 part.alias("part")))


def _stage(n_docs: int, n_terms: int, k: int, last: bool) -> Callable:
    """The task function of one owner: bundles + its postings -> bundles (or the k best)."""
    def run(key: tuple, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        none = {"shard": pa.int64(), "block": pa.int64(), "slots": pa.int32(), "lengths": pa.binary(),
                "rest": pa.list_(pa.list_(pa.int64())), "accs": pa.binary(), "scores": pa.binary()}
        if last:
            none = {"block": pa.int64(), "slot": pa.int32(), "doc": pa.int32(), "shard": pa.int64(),
                    "score": pa.int64()}
        if not bundle.num_rows:
            return pa.table({c: pa.array([], t) for c, t in none.items()})
        b = bundle.to_pylist()[0]
        lengths = np.frombuffer(b["lengths"], "<i8")
        slots, n = b["slots"], len(lengths)
        m = 25 + (75 * lengths * n_docs) // n_terms
        score = np.zeros((n, slots), np.int64)
        if b["accs"]:
            score.reshape(-1)[np.frombuffer(b["accs"], np.uint32)] = np.frombuffer(b["scores"], np.int64)
        for w, docs, tfs, uses in zip(*(postings[c].to_pylist() for c in ("w", "docs", "tfs", "uses"))):
            at = np.frombuffer(docs, "<u2").astype(np.int64)
            tf = _wide(tfs, len(at))
            part = w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[at]))
            to = np.array([u["slot"] for u in uses])
            times = np.array([u["qtf"] for u in uses])
            score[at[:, None], to[None, :]] += part[:, None] * times[None, :]
        least = np.partition(score, n - k, axis=0)[n - k] if n > k else np.zeros(slots, np.int64)
        if last:
            doc, slot = np.nonzero((score > 0) & (score >= least))
            got = score[doc, slot]
            o = np.lexsort((doc, -got, slot))            # ids ascend with document numbers
            doc, slot, got = doc[o], slot[o], got[o]
            first = np.searchsorted(slot, np.arange(slots))
            o = np.arange(len(slot)) - first[slot] < k if len(slot) else np.zeros(0, bool)
            doc, slot, got = doc[o], slot[o], got[o]
            return pa.table([pa.array(np.full(len(doc), b["block"]), pa.int64()), pa.array(slot.astype(np.int32)),
                             pa.array(doc.astype(np.int32)), pa.array(np.full(len(doc), b["shard"]), pa.int64()),
                             pa.array(got)], names=list(none))
        rest = np.array(b["rest"][0], np.int64)
        at = np.flatnonzero((score > 0) & (score + rest >= least))
        out = {"shard": [b["shard"]], "block": [b["block"]], "slots": [slots], "lengths": [b["lengths"]],
               "rest": [b["rest"][1:]], "accs": [at.astype(np.uint32).tobytes()],
               "scores": [score.reshape(-1)[at].tobytes()]}
        return pa.table({c: pa.array(v, none[c]) for c, v in out.items()})
    return run


def search(index: DataFrame, items: DataFrame, k: int = TOP, stages: int = STAGES,
           item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``k`` best documents of each item."""
    query = query_terms(items, item_id, text)
    shards = index.where("term IS NULL").select("shard", F.col("tfs").alias("lengths"), "ids", "top")
    n_docs, n_terms = shards.agg(F.sum(F.size("ids")), F.sum("top")).first()
    item_type = items.schema[item_id].dataType
    doc_type = index.schema["ids"].dataType.elementType
    if not n_docs:
        spark = index.sparkSession
        return spark.createDataFrame([], T.StructType([
            T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", doc_type), T.StructField("score", T.LongType())]))
    postings = written(index.where("term IS NOT NULL").select("shard", "term", "docs", "tfs", "top")
                       .join(query.select("term").distinct(), "term"))
    owned = owners(postings, n_docs, stages)
    uses = query.join(owned, "term")
    # what later owners can still add to each item, after each stage but the last
    later = [F.sum(F.when(F.col("owner") > s, F.col("qtf") * F.col("w") * F.col("part")).otherwise(0))
             for s in range(stages)]
    rests = uses.groupBy("block", "slot").agg(F.array(*later).alias("r"))
    slots = F.max("slot") + 1
    blocks = (query.select("block", "slot").distinct().join(rests, ["block", "slot"], "left")
              .withColumn("r", F.coalesce("r", F.array_repeat(F.lit(0).cast("long"), stages)))
              .groupBy("block").agg(slots.alias("slots"), F.array_sort(F.collect_list(F.struct("slot", "r"))).alias("s"))
              .select("block", "slots", F.transform(
                  F.sequence(F.lit(0), F.lit(stages - 1)),
                  lambda i: F.transform("s", lambda x: F.get(x["r"], i))).alias("rest")))
    empty = F.lit(b"")
    # the stated items, in blocks, against every shard
    bundles = shards.crossJoin(written(blocks)).select(
        "shard", "block", "slots", "lengths", "rest", empty.alias("accs"), empty.alias("scores"))
    per_block = (uses.groupBy("term", "owner", "w", "block").agg(F.collect_list(F.struct("slot", "qtf")).alias("uses")))
    per_block = written(per_block)
    for s in range(stages):
        held = (postings.join(per_block.where(F.col("owner") == s), "term")
                .select("shard", "block", "w", "docs", "tfs", "uses"))
        last = s == stages - 1
        schema = ("block long, slot int, doc int, shard long, score long" if last else
                  "shard long, block long, slots int, lengths binary, rest array<array<bigint>>, "
                  "accs binary, scores binary")
        bundles = (bundles.groupBy("shard", "block").cogroup(held.groupBy("shard", "block"))
                   .applyInArrow(_stage(n_docs, n_terms, k, last), schema))
    ids = shards.select("shard", "ids")
    best = written(bundles).join(ids, "shard").withColumn("doc_id", F.get("ids", F.col("doc")))
    order = Window.partitionBy("block", "slot").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "shard", "doc")
    best = best.drop("ids").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = query.select("block", "slot", "item_id").distinct()
    return best.join(names, ["block", "slot"]).select("item_id", "rank", "doc_id", "score")


ORACLE_SQL = f"""
WITH q AS (
  SELECT item_id, term, count(*) AS qtf FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '{TERM}')) AS term FROM benchmark)
  GROUP BY item_id, term),
d AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
    translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '{TERM}') AS w FROM documents),
s AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
p AS (SELECT uid, term, count(*) AS tf FROM (SELECT uid, unnest(w) AS term FROM d) GROUP BY uid, term),
v AS (SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM p, s GROUP BY term, n),
c AS (
  SELECT item_id, p.uid, doc_id,
    CAST(sum(qtf * v.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.w) * n) // l)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN v USING (term) JOIN d ON d.uid = p.uid, s
  GROUP BY item_id, p.uid, doc_id),
r AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {TOP}
"""
