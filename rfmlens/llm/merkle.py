"""Merkle manifest of a dataset, built by a butterfly exchange.

Leaves are hashed where the texts lie (JVM functions only); after that only
digests move.  Each part (a source) is cut into aligned blocks of
``FANOUT ** HEIGHT`` consecutive leaves, and a task reduces a block to its
root.  Then the blocks climb together, round by round: the subtrees of an
aligned group of ``FANOUT`` swap their roots, and every block of the group
hashes the common parent itself.  So each block holds all its ancestors and
their siblings - its upper proof - when the last round ends, and nothing is
sent down the tree.  A block at offset o of a subtree of s blocks sends its
root to the offsets o, o + s, o + 2s ... of the other subtrees of its group,
so every block receives each missing root exactly once, also where the last
subtree is ragged.  The same rounds first join the blocks of a part (the last
digest is its ``subroot``) and then the parts, ordered by name (``root``).
Finally a block meets its leaves again (cogroup) and completes their proofs.

Tree: H is lowercase hex sha256 of its inputs concatenated, digests as hex
text.  While several nodes remain, every ``FANOUT`` consecutive ones (the last
run: fewer, even one) become their H.

Defined results.  A null in a hashed column is ``-``; a null source is a part
of its own and comes first; a null id sorts first.  Empty texts hash as
``0:``.  Texts of any length are hashed whole, by the JVM, in one row.  Equal
ids, and rows repeated as a whole, are leaves of their own, ordered by id and
then by leaf digest, so the tree does not depend on the order of the input.
An empty table has no rows, no parts and no root.  Columns other than those
named are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import written
from ._order import running

FANOUT = 3
HEIGHT = 7                      # a block has FANOUT ** HEIGHT leaves
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    """H of the encoded columns, in the order given."""
    return F.sha2(F.concat(*[field(c) for c in columns.values()]), 256)


def part_key(c: Column) -> Column:
    """Never null, and ordered as the parts are: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


def levels(digests: list[str], height: int | None) -> list[list[str]]:
    """The digests and each level above, for ``height`` levels or up to one node."""
    out = [digests]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        d = out[-1]
        out.append([hashlib.sha256("".join(d[i:i + FANOUT]).encode()).hexdigest()
                    for i in range(0, len(d), FANOUT)])
    return out


def _block_levels(table: pa.Table, span: int) -> tuple[pa.Table, list[list[str]]]:
    table = table.sort_by("pos")
    several = table["pos_all"][0].as_py() > span
    return table, levels(table["leaf"].to_pylist(), HEIGHT if several else None)


def _block_root(key: tuple, table: pa.Table) -> pa.Table:
    _, lv = _block_levels(table, FANOUT ** HEIGHT)
    return pa.table({"part": [key[0].as_py()], "block": [key[1].as_py()], "digest": lv[-1]})


def _proofs(key: tuple, leaves: pa.Table, state: pa.Table) -> pa.Table:
    """Leaves with the siblings on their way to the block's root, then the block's own."""
    leaves, lv = _block_levels(leaves, FANOUT ** HEIGHT)
    top = state.to_pylist()[0]
    n = leaves.num_rows
    lefts, rights = [], []
    for i in range(n):
        left, right, k = [], [], i
        for level in lv[:-1]:
            lo = k - k % FANOUT
            left.append("".join(level[lo:k]))
            right.append("".join(level[k + 1:lo + FANOUT]))
            k //= FANOUT
        lefts.append(left + top["lefts"])
        rights.append(right + top["rights"])
    strings = pa.list_(pa.string())
    return (leaves.drop_columns(["part", "block", "pos", "pos_all"])
            .append_column("subroot", pa.array([top["subroot"]] * n, pa.string()))
            .append_column("root", pa.array([top["root"]] * n, pa.string()))
            .append_column("lefts", pa.array(lefts, strings))
            .append_column("rights", pa.array(rights, strings)))


def _swap(state: DataFrame, edges: Column, active: Column) -> DataFrame:
    """One round.  ``edges``: FANOUT + 1 ascending block numbers that bound the
    subtrees of the block's group; ``active``: the subtree is not yet the whole."""
    s = state.withColumns({"__e": edges, "__on": active})
    e, g = F.col("__e"), F.col("g")
    digit = sum((F.when(g >= e[i], 1).otherwise(0) for i in range(1, FANOUT)), F.lit(0))
    s = s.withColumn("__d", digit).withColumns({
        "__o": g - F.get("__e", F.col("__d")), "__s": F.get("__e", F.col("__d") + 1) - F.get("__e", F.col("__d"))})

    def to(i: int) -> Column:
        first, last = e[i] + F.col("__o"), e[i + 1] - 1
        return F.when((F.col("__d") != i) & (first <= last),
                      F.sequence(first, F.greatest(first, last), F.col("__s")))

    targets = F.flatten(F.array_compact(F.array(*[to(i) for i in range(FANOUT)])))
    sent = (s.where("__on").select("__d", "digest", F.explode(targets).alias("g"))
            .groupBy("g")
            .agg(F.map_from_entries(F.collect_list(F.struct("__d", "digest"))).alias("__got")))
    s = s.join(sent, "g", "left")

    def those(wanted) -> Column:
        return F.concat(*[F.when(wanted(F.lit(i)), F.coalesce(F.try_element_at("__got", F.lit(i)), F.lit("")))
                          .otherwise("") for i in range(FANOUT)])
    s = s.withColumns({"__l": those(lambda i: i < F.col("__d")), "__r": those(lambda i: i > F.col("__d"))})
    on = F.col("__on")
    return written(s.withColumns({
        "digest": F.when(on, F.sha2(F.concat("__l", "digest", "__r"), 256)).otherwise(F.col("digest")),
        "lefts": F.when(on, F.array_append("lefts", F.col("__l"))).otherwise(F.col("lefts")),
        "rights": F.when(on, F.array_append("rights", F.col("__r"))).otherwise(F.col("rights"))})
        .select(*state.columns))


def _rounds(nodes: int) -> int:
    n = 0
    while nodes > 1:
        nodes, n = -(-nodes // FANOUT), n + 1
    return n


def _parts(placed: DataFrame) -> DataFrame:
    """part, blocks, q (its rank), q_all, base (blocks of the parts before), base_all."""
    span = FANOUT ** HEIGHT
    sizes = placed.groupBy("part").agg(F.expr(f"(max(pos_all) + {span - 1}) div {span}").alias("blocks"))
    return written(running(sizes, [], ["part"], {"q": F.lit(1), "base": F.col("blocks")}))


def _part_edges(parts: DataFrame, rounds: int) -> DataFrame:
    """part and, for each round among the parts, the block numbers that bound the
    subtrees of its group."""
    if not rounds:
        return parts.withColumn("tops", F.array(F.array(F.lit(0).cast("long"))))
    group = F.expr(f"cast(pow({FANOUT}, r + 1) as long)")
    at = (parts.select("q", "q_all", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("r"))
          .select("q", "r", F.explode(F.sequence(F.lit(0), F.lit(FANOUT))).alias("i"),
                  F.least(F.col("q") - F.col("q") % group + F.col("i") * group / FANOUT, "q_all")
                  .cast("long").alias("x")))
    ends = (parts.select(F.col("q").alias("x"), "base")
            .union(parts.where("q = q_all - 1").select("q_all", "base_all")))
    rows = (at.join(ends, "x").groupBy("q", "r").agg(F.array_sort(F.collect_list(F.struct("i", "base"))).alias("e"))
            .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", F.col("e.base").alias("base")))).alias("t")))
    return parts.join(rows.select("q", F.col("t.base").alias("tops")), "q")


def manifest(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
             columns: tuple[str, ...] = COLUMNS, carry: dict[str, Column] | None = None) -> DataFrame:
    """Every row's id, leaf, subroot, root and proof: ``lefts`` and ``rights``
    hold the concatenated sibling digests of each level, leaf level first.
    ``carry`` names further (narrow) columns that a row takes along."""
    leaves = written(docs.select(
        F.col(doc_id).alias("doc_id"), part_key(F.col(source)).alias("part"),
        leaf_digest({c: F.col(c) for c in columns}).alias("leaf"),
        *[c.alias(n) for n, c in (carry or {}).items()], F.monotonically_increasing_id().alias("__uid")))
    placed = running(leaves, ["part"], ["doc_id", "leaf", "__uid"], {"pos": F.lit(1)}).drop("__uid")
    placed = written(placed.withColumn("block", F.expr(f"pos div {FANOUT ** HEIGHT}")))
    roots = (placed.select("part", "block", "pos", "pos_all", "leaf").groupBy("part", "block")
             .applyInArrow(_block_root, "part string, block long, digest string"))
    parts = _parts(placed)
    most = parts.agg(F.max("blocks"), F.max("q_all")).first()
    inner, outer = _rounds(most[0] or 0), _rounds(most[1] or 0)
    parts = _part_edges(parts, outer)
    none = F.array().cast("array<string>")
    state = written(roots.join(parts, "part").select(
        (F.col("base") + F.col("block")).alias("g"), "part", "block", "blocks", "base", "tops", "digest",
        none.alias("lefts"), none.alias("rights")))
    for r in range(inner):
        size = FANOUT ** r
        start = F.col("block") - F.col("block") % (size * FANOUT)
        state = _swap(state, F.array(*[F.col("base") + F.least(start + i * size, F.col("blocks"))
                                       for i in range(FANOUT + 1)]), F.col("blocks") > size)
    state = state.withColumn("subroot", F.col("digest"))
    for r in range(outer):
        state = _swap(state, F.get("tops", F.lit(r)), F.lit(True))
    state = state.select("part", "block", "subroot", F.col("digest").alias("root"), "lefts", "rights")
    kept = [f for f in placed.schema.fields if f.name not in ("part", "block", "pos", "pos_all")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return (placed.groupBy("part", "block").cogroup(state.groupBy("part", "block"))
            .applyInArrow(_proofs, schema + ", subroot string, root string, lefts array<string>, "
                                            "rights array<string>"))


def fold(leaf: Column, lefts: str = "lefts", rights: str = "rights") -> Column:
    """The root that ``leaf`` and the siblings of a proof give."""
    return F.aggregate(F.arrays_zip(lefts, rights), leaf,
                       lambda h, s: F.sha2(F.concat(s[lefts], h, s[rights]), 256))


def proof_digest(lefts: str = "lefts", rights: str = "rights") -> Column:
    """H of all siblings of a proof."""
    return F.sha2(F.concat_ws("", F.zip_with(lefts, rights, lambda a, b: F.concat(a, b))), 256)


def tampered_leaf(doc_id: str = "doc_id", text: str = "text", columns: tuple[str, ...] = COLUMNS) -> Column:
    """The leaf after the text lost its line feeds, where 2 divides the id's
    crc32; null for all other rows (a null id too)."""
    changed = {c: F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == text else F.col(c) for c in columns}
    even = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 2 == 0
    return F.when(even, leaf_digest(changed))


def verified(docs: DataFrame) -> DataFrame:
    """The manifest's rows with proof_sha256, folded_root and verified: each
    row's proof is folded from its (perhaps tampered) leaf."""
    m = manifest(docs, carry={"tampered": tampered_leaf()})
    folded = fold(F.coalesce("tampered", "leaf"))
    return (m.withColumns({"proof_sha256": proof_digest(), "folded_root": folded})
            .withColumn("verified", F.col("folded_root") == F.col("root"))
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


def oracle_sql(leaf_levels: int = 15, part_levels: int = 8) -> str:
    """The same rows in DuckDB, level by level (parts of up to 3^15 rows, 3^8 parts)."""
    def enc(e: str) -> str:
        return f"coalesce(strlen(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    # crc32 by its fixed polynomial; its complement's last bit is 1 where 2 divides it
    crc = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: ascii(c)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
           "lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))")
    ctes = [f"""rows0 AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, doc_id, source, {leaf('text')} AS leaf,
    CASE WHEN {crc} & 1 = 1 THEN {leaf("replace(text, chr(10), '')")} END AS bad FROM documents)""",
            """n0 AS MATERIALIZED (
  SELECT uid, doc_id, leaf, coalesce(bad, leaf) AS f, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS q,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, uid) - 1 AS i FROM rows0)""",
            "l0 AS MATERIALIZED (SELECT q, i, leaf AS d FROM n0)",
            "f0 AS MATERIALIZED (SELECT uid, doc_id, leaf, q, i, f, '' AS p FROM n0)"]

    def level(k: int, fan: int, group: str, src: str) -> None:
        same = f"PARTITION BY {group}, i // {fan} ORDER BY i"
        ctes.append(f"""s{k} AS MATERIALIZED (SELECT q, i, d, count(*) OVER (PARTITION BY {group}) AS c,
    coalesce(string_agg(d, '') OVER ({same} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS a,
    coalesce(string_agg(d, '') OVER ({same} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS b FROM {src})""")
        ctes.append(f"""l{k + 1} AS MATERIALIZED (SELECT {group} AS q, i // {fan} AS i,
    CASE WHEN max(c) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d
  FROM s{k} GROUP BY {group}, i // {fan})""")
        ctes.append(f"""f{k + 1} AS MATERIALIZED (SELECT uid, doc_id, leaf, f{k}.q, f{k}.i // {fan} AS i,
    CASE WHEN c = 1 THEN f ELSE sha256(a || f || b) END AS f, CASE WHEN c = 1 THEN p ELSE p || a || b END AS p
  FROM f{k} JOIN s{k} ON f{k}.q = s{k}.q AND f{k}.i = s{k}.i)""")
    for k in range(leaf_levels):
        level(k, FANOUT, "q", f"l{k}")
    n = leaf_levels
    ctes.append(f"sub AS MATERIALIZED (SELECT q, d AS subroot FROM l{n})")
    # the parts become the leaves of one tree
    ctes.append(f"l{n + 1} AS MATERIALIZED (SELECT 0 AS q, q AS i, subroot AS d FROM sub)")
    ctes.append(f"f{n + 1} AS MATERIALIZED (SELECT uid, doc_id, leaf, 0 AS q, q AS i, f, p FROM f{n})")
    for k in range(n + 1, n + 1 + part_levels):
        level(k, FANOUT, "q", f"l{k}")
    last = n + 1 + part_levels
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT n0.doc_id, n0.leaf, subroot, l{last}.d AS root, sha256(p) AS proof_sha256, f{last}.f AS folded_root,
  f{last}.f = l{last}.d AS verified
FROM n0 JOIN f{last} USING (uid) JOIN sub ON n0.q = sub.q CROSS JOIN l{last}""")
