"""Operator 7 [native]: benchmark phrases in documents by positional postings.

The test side is cut into windows (``WINDOW`` consecutive words of an item; an
item with fewer is one window).  Corpus counts of the test vocabulary rank the
terms of each window, rarest first.  The corpus is read as a positional
index partitioned by document: every token of a document is a posting (term,
document, position).  The postings of a window's rarest term are looked up
first; at the offsets of the second and third rarest terms the same
document's lists are intersected, and only what is left compares the whole
window.  All of it runs in the partition that holds the document, so no token
is shuffled; what leaves a task is exact phrase occurrences.

``rare_postings`` stores the postings of the rarest terms as a table and
``proximity_matches`` intersects them with a distance instead of offsets.

Windows are broadcast in blocks of at most ``BLOCK_BYTES`` (measured before);
a larger test set is read in more blocks, each against all documents.

Defined results: null or empty texts have no words, no hits, and the digest
of the empty string; items with a null id or without words count as absent;
repeated items count once; a document row is told apart by (doc_id, hash of
text), so repeated rows give repeated rows; empty tables on either side give
no hits; extra columns are ignored.  A null id is an id like any other: such
rows are reported, and removed by ``clean_documents``, by what their own text
holds.  Texts of any length are cut whole, in one row.
"""

from __future__ import annotations

import math
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import small_side, written

WINDOW = 10
BLOCK_BYTES = 4 << 20
#: Fixed value: a word is a run of characters outside these ASCII ranges.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same class, written as what it contains (several times faster in Java).
WORD_CHARS = r"[0-9a-z\x80-\x{10FFFF}]+"


def lower(text: str | Column) -> Column:
    """A-Z as a-z, every other character as it is."""
    c = F.col(text) if isinstance(text, str) else text
    return (F.when(F.length(c) == F.octet_length(c), F.lower(c))          # ASCII: the fast way
            .otherwise(F.translate(c, ascii_uppercase, ascii_lowercase)))


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(lower(text), F.lit(WORD_CHARS), F.lit(0))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, h (hash of the text) and text of the rows that have a text."""
    return docs.select(docs[doc_id].alias("doc_id"), F.xxhash64(docs[text]).alias("h"),
                       docs[text].alias("text"))


def items(bench: DataFrame, item_id: str, text: str) -> DataFrame:
    return (bench.select(bench[item_id].alias("item_id"), words(bench[text]).alias("w"))
            .where("item_id is not null and size(w) > 0").distinct())


def windows(bench: DataFrame, item_id: str = "item_id", text: str = "text",
            window: int = WINDOW) -> DataFrame:
    """item_id, pid (hash of the phrase), w (its words) of every window."""
    cut = (items(bench, item_id, text)
           .withColumn("s", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))))
           .select("item_id", F.slice("w", F.col("s"), F.lit(window)).alias("w")))
    return cut.select("item_id", F.xxhash64(F.concat_ws(" ", "w")).alias("pid"), "w").distinct()


def _blocks(df: DataFrame, key: str, size: Column) -> list[DataFrame]:
    """``df`` in parts of about BLOCK_BYTES by a hash of ``key``; sizes are measured."""
    total = df.agg(F.sum(size)).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES))
    if n == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(F.lit("block"), key), F.lit(n)) == i) for i in range(n)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n: postings of each of ``terms`` (a table of distinct terms) in all documents."""
    tokens = docs.select(F.explode_outer(words("text")).alias("term"))      # outer: see phrase_matches
    tokens = tokens.select(F.xxhash64("term").alias("k"), F.col("term").alias("t"))
    return _union([tokens.join(F.broadcast(part.withColumn("k", F.xxhash64("term"))), "k")    # long keys: faster
                   .where("t = term").groupBy("term").agg(F.count("*").alias("n"))
                   for part in _blocks(terms, "term", F.octet_length("term") + 32)])


def ranked_windows(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """pid, w and its three rarest terms (t1..t3 at offsets o1..o3) of each phrase."""
    phrases = wins.select("pid", "w").dropDuplicates(["pid"])
    terms = written(phrases.select(F.explode("w").alias("term")).distinct())
    counts = written(term_counts(docs, terms))
    placed = phrases.select("pid", "w", F.posexplode("w").alias("o", "term"))
    ranked = (placed.join(counts, "term")                  # a term without a posting ends its windows
              .groupBy("pid").agg(F.count("*").alias("found"), F.first("w").alias("w"),
                                  F.array_sort(F.collect_list(F.struct("n", "term", "o"))).alias("r"))
              .where("found = size(w)"))
    nth = lambda i: F.get("r", F.least(F.lit(i), F.size("r") - 1))
    return ranked.select("pid", "w", *(nth(i)[f].alias(f"{c}{i + 1}") for i in range(3)
                                       for c, f in (("t", "term"), ("o", "o"))))


def phrase_matches(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """doc_id, h, pid, start, len of every occurrence of a phrase.

    ``docs``: doc_id, h, text.  ``ranked``: as of ``ranked_windows``.
    """
    # the outer form keeps Spark from testing the word array for emptiness first,
    # which would cut each text into words a second time; nulls do not join
    tokens = (docs.select("doc_id", "h", words("text").alias("words"))
              .select("doc_id", "h", "words", F.posexplode_outer("words").alias("pos", "t1"))
              .select("doc_id", "h", "words", "pos", F.xxhash64("t1").alias("k")))
    start = F.col("pos") - F.col("o1")
    at = lambda o: F.get("words", start + F.col(o))
    found = []
    for part in _blocks(ranked, "pid", F.octet_length(F.concat_ws(" ", "w")) + 200):
        part = part.select(F.xxhash64("t1").alias("k"), "pid", "w", "o1", "t2", "o2", "t3", "o3")
        found.append(tokens.join(F.broadcast(part), "k")
                     .where((start >= 0) & (at("o2") == F.col("t2")) & (at("o3") == F.col("t3"))
                            & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.size("w")) == F.col("w")))
                     .select("doc_id", "h", "pid", start.alias("start"), F.size("w").alias("len")))
    return _union(found)


def occurrences(docs: DataFrame, bench: DataFrame, window: int = WINDOW, doc_id: str = "doc_id",
                text: str = "text", item_id: str = "item_id", item_text: str = "text"
                ) -> tuple[DataFrame, DataFrame]:
    """(phrase occurrences, windows), both written."""
    d = keyed(docs, doc_id, text)
    wins = written(windows(bench, item_id, item_text, window))
    ranked = written(ranked_windows(d, wins))
    return written(phrase_matches(d, ranked).distinct()), wins


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``."""
    from pyspark.sql import Window
    occ, wins = occurrences(docs, bench, window, doc_id, text, item_id, item_text)
    spans = occ.select("doc_id", "h", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    before = Window.partitionBy("doc_id", "h").orderBy("start", "end").rowsBetween(
        Window.unboundedPreceding, -1)
    new = spans.select("doc_id", "h", F.greatest(F.lit(0), F.col("end") - F.greatest(
        F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))).alias("n"))
    hits = new.groupBy("doc_id", "h").agg(F.sum("n").alias("n_hit"))
    per_phrase = wins.select("pid", F.col("item_id").cast("string").alias("item_id"))
    found = (occ.select("doc_id", "h", "pid").distinct().join(per_phrase, "pid")
             .groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    rows = keyed(docs, doc_id, text).select(
        "doc_id", "h", F.coalesce(F.size(words("text")), F.lit(0)).cast("long").alias("n_words"))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:          # a null id is an id too
        r = right.withColumnsRenamed({"doc_id": "__id", "h": "__h"})
        return left.join(r, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left").drop(
            "__id", "__h")
    return (beside(beside(rows, hits), found)
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def clean_documents(docs: DataFrame, bench: DataFrame, window: int = WINDOW, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """The rows of ``docs`` without any phrase of ``bench``, null ids told apart by their text."""
    occ, _ = occurrences(docs, bench, window, doc_id, text)
    bad = small_side(occ.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h")).distinct())
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["__id"]) & (F.xxhash64(docs[text]) == bad["__h"]), "left_anti")


def rare_postings(docs: DataFrame, bench: DataFrame, terms: int = 3, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text"
                  ) -> tuple[DataFrame, DataFrame]:
    """(postings, item terms), both written.

    Postings: doc_id, h, term, pos of the ``terms`` rarest terms of each item;
    item terms: item_id, term, rank (from 1, rarest first).
    """
    d = keyed(docs, doc_id, text)
    vocab = items(bench, item_id, item_text).select("item_id", F.explode("w").alias("term")).distinct()
    vocab = written(vocab)
    counts = written(term_counts(d, vocab.select("term").distinct()))
    ranked = (vocab.join(counts, "term", "left").groupBy("item_id")
              .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("r"))
              .select("item_id", F.posexplode(F.slice("r", 1, terms)).alias("rank", "r"))
              .select("item_id", F.col("r.term").alias("term"), (F.col("rank") + 1).alias("rank")))
    ranked = written(ranked)
    tokens = (d.select("doc_id", "h", words("text").alias("words"))
              .select("doc_id", "h", F.posexplode_outer("words").alias("pos", "term")))
    parts = _blocks(ranked.select("term").distinct(), "term", F.octet_length("term") + 32)
    return written(_union([tokens.join(F.broadcast(p), "term") for p in parts])), ranked


def proximity_matches(docs: DataFrame, bench: DataFrame, terms: int = 3, slop: int = 20, **names: str
                      ) -> DataFrame:
    """doc_id, h, item_id, first, last: places where all of an item's ``terms``
    rarest terms (all its terms, if fewer) lie within ``slop`` words of its
    rarest one, in any order."""
    postings, ranked = rare_postings(docs, bench, terms, **names)
    placed = postings.join(ranked, "term").withColumn("b", F.expr(f"pos div {slop + 1}"))
    size = ranked.groupBy("item_id").agg(F.count("*").alias("size"))
    lead = (placed.where("rank = 1").select("doc_id", "h", "item_id", F.col("pos").alias("p"), "b")
            .withColumn("b", F.explode(F.array(F.col("b") - 1, F.col("b"), F.col("b") + 1))))
    near = (lead.join(placed, ["doc_id", "h", "item_id", "b"]).where(F.abs(F.col("pos") - F.col("p")) <= slop)
            .groupBy("doc_id", "h", "item_id", "p")
            .agg(F.countDistinct("rank").alias("found"), F.min("pos").alias("first"), F.max("pos").alias("last")))
    return near.join(size, "item_id").where("found = size").select("doc_id", "h", "item_id", "first", "last")


ORACLE_SQL = f"""
WITH iw AS (
  SELECT DISTINCT item_id,
    regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least({WINDOW}, len(w)) AS l,
    array_to_string(w[s + 1 : s + least({WINDOW}, len(w))], ' ') AS p
  FROM iw, unnest(range(0, greatest(len(w) - {WINDOW}, 0) + 1)) AS t(s) WHERE len(w) > 0),
dw AS (
  SELECT doc_id,
    coalesce(regexp_extract_all(translate(text, '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}'), []) AS w
  FROM documents),
dwin AS (
  SELECT doc_id, l, s, array_to_string(w[s + 1 : s + l], ' ') AS p
  FROM dw, (SELECT DISTINCT l FROM win) AS ls, unnest(range(0, len(w) - l + 1)) AS t(s)),
occ AS (SELECT DISTINCT doc_id, item_id, s, dwin.l FROM dwin JOIN win USING (l, p)),
hit AS (
  SELECT doc_id, count(DISTINCT s + i) AS n_hit
  FROM occ, unnest(range(0, l)) AS t(i) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN hit ON dw.doc_id IS NOT DISTINCT FROM hit.doc_id
LEFT JOIN its ON dw.doc_id IS NOT DISTINCT FROM its.doc_id
"""
