"""Operator 4 [native]: mixing sources to target weights in a domain-language-source tree.

Every node splits its token budget among its children by weight; a child takes
at most its capacity (its tokens times the allowed epochs).  What a child
cannot take goes to its siblings first, in proportion to their weights.
Capacities are summed bottom-up before budgets go top-down, so only what a
whole node cannot take is left to the node's own siblings.  The split is exact
integer water-filling in closed form: children in the order of capacity per
weight, running sums, no iteration.  Rounding leaves fewer tokens unassigned
than a node has children.

A leaf repeats its documents for as many whole epochs as its budget holds and
takes a token-prefix of the next: documents in the order of a hash of (seed,
epoch, doc_id), each one that starts inside the budget.  The prefix is found
without sorting a leaf: token sums by leading hash digits give the one bucket
in which the budget ends, only that bucket is ordered, and what comes out is
the last hash taken; the documents are then read once and compared with it.

Defined results: a null text or one without a word has 0 tokens and is never
selected; null domain, language or source are the group ''; nodes of weight 0
get nothing; rows of one doc_id in a leaf are taken or left together; an empty
table gives an empty result; all columns of the input stay (an input column
named domain, n_tokens or epoch takes that output's place).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import written

#: Fixed value: a token is a run of characters other than these.
TOKEN = r"[^\x20\x09-\x0D]+"
BUCKET_DIGITS = 3
LEVELS = ("__domain", "__lang", "__source")


@dataclass
class Target:
    """Integer weights by node name and level (others: ``default``), and the budget."""
    domain: dict[str, int] = field(default_factory=dict)
    lang: dict[str, int] = field(default_factory=dict)
    source: dict[str, int] = field(default_factory=dict)
    default: int = 1
    share: tuple[int, int] = (3, 4)      # of all tokens
    epochs: int = 2
    seed: str = "7"


#: The registered query's target.
TARGET = Target(domain={"d0": 4, "d1": 3, "d2": 2, "d3": 1}, lang={"en": 5, "de": 2, "fr": 2, "es": 1})


def domain_of(source: str | Column) -> Column:
    """The registered query's domains: the source's number modulo 4, else ``other``."""
    digits = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    return F.coalesce(F.concat(F.lit("d"), (F.try_to_number(F.nullif(digits, F.lit("")), F.lit("999999999"))
                                            .cast("int") % 4).cast("string")), F.lit("other"))


def _weight(name: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for k, v in sorted(weights.items()):
        out = F.when(F.col(name) == k, F.lit(v)).otherwise(out)
    return out.cast("long")


def _wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def split(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (parent keys, name, cap, weight, budget of the parent) with ``got``."""
    ranked = (Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))).orderBy("__r", name)
    upto = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    c = (children.where("weight > 0 and cap > 0").withColumn("__r", F.col("cap") / F.col("weight"))
         .withColumn("__before", F.sum("cap").over(upto) - F.col("cap"))
         .withColumn("__left", F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight")))
    fills = _wide(F.col("budget") - F.col("__before")) * _wide(F.col("weight")) >= _wide(
        F.col("cap")) * _wide(F.col("__left"))
    c = c.withColumn("__full", F.min(F.when(fills, 1).otherwise(0)).over(upto))
    rest = F.col("budget") - F.sum(F.col("cap") * F.col("__full")).over(whole)
    weight = F.sum(F.col("weight") * (1 - F.col("__full"))).over(whole)
    c = c.withColumn("__rest", rest).withColumn("__w", weight)
    part = F.expr("cast((cast(__rest as decimal(19,0)) * cast(weight as decimal(19,0))) "
                  "div cast(nullif(__w, 0) as decimal(19,0)) as bigint)")
    return (c.withColumn("got", F.when(F.col("__full") == 1, F.col("cap")).otherwise(part))
            .drop("__r", "__before", "__left", "__full", "__rest", "__w"))


def budgets(leaves: DataFrame, target: Target) -> DataFrame:
    """LEVELS, tokens and ``got`` (budget) of every leaf; ``leaves``: LEVELS, tokens."""
    d, la, s = LEVELS
    caps = leaves.select(*LEVELS, "tokens", (F.col("tokens") * target.epochs).alias("cap"))
    total = (leaves.agg(F.sum("tokens")).first()[0] or 0) * target.share[0] // target.share[1]
    domains = (caps.groupBy(d).agg(F.sum("cap").alias("cap")).withColumn("budget", F.lit(total).cast("long"))
               .withColumn("weight", _weight(d, target.domain, target.default)))
    domains = split(domains, [], d).select(d, F.col("got").alias("budget"))
    langs = (caps.groupBy(d, la).agg(F.sum("cap").alias("cap")).join(domains, d)
             .withColumn("weight", _weight(la, target.lang, target.default)))
    langs = split(langs, [d], la).select(d, la, F.col("got").alias("budget"))
    sources = (caps.join(langs, [d, la]).withColumn("weight", _weight(s, target.source, target.default)))
    return split(sources, [d, la], s).select(*LEVELS, "tokens", "got")


def _placed(docs: DataFrame, domain: Column, doc_id: str, lang: str, source: str, text: str) -> DataFrame:
    group = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return docs.select(F.struct(*docs.columns).alias("__row"), F.col(doc_id).alias("__id"),
                       group(domain).alias("__domain"), group(F.col(lang)).alias("__lang"),
                       group(F.col(source)).alias("__source"),
                       F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long").alias("__n"))


def _hashed(placed: DataFrame, leaves: DataFrame, seed: str) -> DataFrame:
    """Documents with their leaf's epochs, rest and their hash in the last epoch."""
    h = F.md5(F.concat_ws(":", F.lit(seed), F.col("__whole").cast("string"),
                          F.coalesce(F.col("__id").cast("string"), F.lit(""))))
    return (placed.where("__n > 0").join(leaves, list(LEVELS))
            .withColumn("__h", h).withColumn("__b", F.substring("__h", 1, BUCKET_DIGITS)))


def mix(docs: DataFrame, target: Target, domain: Column, doc_id: str = "doc_id", lang: str = "lang",
        source: str = "source", text: str = "text") -> DataFrame:
    """The selected rows of ``docs``, one for each epoch, with domain, n_tokens, epoch."""
    keep = docs.columns
    placed = _placed(docs, domain, doc_id, lang, source, text)
    base = written(placed.select("__id", *LEVELS, "__n"))
    tokens = base.groupBy(*LEVELS).agg(F.sum("__n").alias("tokens")).where("tokens > 0")
    leaves = written(budgets(tokens, target).select(
        *LEVELS, F.expr("got div tokens").alias("__whole"), F.expr("got % tokens").alias("__rest"))
        .where("__whole > 0 or __rest > 0"))
    sums = (_hashed(base, leaves, target.seed).groupBy(*LEVELS, "__rest", "__b")
            .agg(F.sum("__n").alias("n")))
    run = Window.partitionBy(*LEVELS).orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the bucket in which the rest ends: the last one that starts inside it
    cut = (sums.withColumn("__offset", F.sum("n").over(run) - F.col("n")).where("__offset < __rest")
           .groupBy(*LEVELS).agg(F.max(F.struct("__b", "__offset")).alias("c"))
           .select(*LEVELS, F.col("c.__b").alias("__b"), F.col("c.__offset").alias("__offset")))
    edge = (_hashed(base, leaves, target.seed).join(cut, [*LEVELS, "__b"])
            .groupBy(*LEVELS, "__rest", "__offset", "__h").agg(F.sum("__n").alias("n")))
    order = run.orderBy("__h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (edge.withColumn("__start", F.col("__offset") + F.sum("n").over(order) - F.col("n"))
            .where("__start < __rest").groupBy(*LEVELS).agg(F.max("__h").alias("__last")))
    leaves = written(leaves.join(last, list(LEVELS), "left"))
    more = F.coalesce(F.col("__h") <= F.col("__last"), F.lit(False)).cast("int")
    return (_hashed(placed, leaves, target.seed)
            .withColumn("__copies", (F.col("__whole") + more).cast("int")).where("__copies > 0")
            .withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
            .select("__row.*", *(F.col(c).alias(a) for c, a in (
                ("__domain", "domain"), ("__n", "n_tokens"), ("__epoch", "epoch")) if a not in keep)))


def _weight_sql(level: str, weights: dict[str, int], default: int) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(weights.items()))
    return f"CASE {level} {cases} ELSE {default} END" if cases else str(default)


def _split_sql(name: str, children: str, keys: str, node: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""
{name}_r AS (
  SELECT *, sum(cap) OVER (o ROWS UNBOUNDED PRECEDING) - cap AS bef,
    sum(weight) OVER ({part}) - sum(weight) OVER (o ROWS UNBOUNDED PRECEDING) + weight AS lft
  FROM ({children}) WHERE weight > 0 AND cap > 0
  WINDOW o AS ({part} ORDER BY cap / weight, {node})),
{name}_f AS (
  SELECT *, min(CASE WHEN (budget - bef) * weight >= cap * lft THEN 1 ELSE 0 END)
    OVER ({part} ORDER BY cap / weight, {node} ROWS UNBOUNDED PRECEDING) AS ful FROM {name}_r),
{name} AS (
  SELECT *, CASE WHEN ful = 1 THEN cap ELSE
    ((budget - sum(cap * ful) OVER ({part})) * weight)
      // nullif(sum(weight * (1 - ful)) OVER ({part}), 0) END AS got FROM {name}_f)"""


def oracle_sql(t: Target = TARGET) -> str:
    """DuckDB SQL of the registered query."""
    d = _split_sql("dom", f"""SELECT domain, sum(cap)::HUGEINT AS cap,
      (SELECT sum(tokens) * {t.share[0]} // {t.share[1]} FROM leaf)::HUGEINT AS budget,
      ({_weight_sql("domain", t.domain, t.default)})::HUGEINT AS weight FROM leaf GROUP BY domain""", "", "domain")
    la = _split_sql("lan", f"""SELECT domain, lang, c.cap, dom.got AS budget,
      ({_weight_sql("lang", t.lang, t.default)})::HUGEINT AS weight
      FROM (SELECT domain, lang, sum(cap)::HUGEINT AS cap FROM leaf GROUP BY domain, lang) c
      JOIN dom USING (domain)""", "domain", "lang")
    s = _split_sql("src", f"""SELECT domain, lang, source, tokens, leaf.cap, lan.got AS budget,
      ({_weight_sql("source", t.source, t.default)})::HUGEINT AS weight
      FROM leaf JOIN lan USING (domain, lang)""", "domain, lang", "source")
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    coalesce('d' || (CAST(nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '') AS INTEGER) % 4), 'other') AS domain,
    coalesce(len(regexp_extract_all(text, '{TOKEN}')), 0)::BIGINT AS n FROM documents),
leaf AS (
  SELECT domain, lang, source, sum(n)::HUGEINT AS tokens, sum(n)::HUGEINT * {t.epochs} AS cap
  FROM base GROUP BY ALL HAVING sum(n) > 0),
{d},
{la},
{s},
placed AS (
  SELECT b.*, got // tokens AS whole, got % tokens AS rest,
    sum(n) OVER (PARTITION BY b.domain, b.lang, b.source
      ORDER BY md5('{t.seed}:' || (got // tokens) || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))
      RANGE UNBOUNDED PRECEDING)
    - sum(n) OVER (PARTITION BY b.domain, b.lang, b.source, doc_id) AS bef
  FROM base b JOIN src USING (domain, lang, source) WHERE n > 0)
SELECT doc_id, domain, lang, source, n AS n_tokens, CAST(e AS INTEGER) AS epoch
FROM placed, unnest(range(0, CAST(whole + (bef < rest)::INTEGER AS BIGINT))) AS u(e)
"""
