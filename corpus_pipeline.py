"""Corpus pipeline: documents to a mixed, redacted, clean training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's ``docs``; all but the last return
the columns of ``documents``.  Every stage works on all its predecessor kept.

1. ``language``: rows without an identified, dominant language go.
2. ``near_duplicates``: five-word shingles, Jaccard similarity 0.8 or more; of
   each group of linked rows the one with the smallest id stays, exactly one
   row of it (a null id counts as the largest; texts without a word link with
   nothing and all stay).
3. ``decontaminate``: documents that hold a window of ten consecutive words of
   a benchmark item go.
4. ``pii``: selected spans of personal data are replaced by their kind;
   ``n_chars`` follows the text.
5. ``mix``: documents repeated and cut to the target weights of the
   domain-language-source tree, one row for each epoch.

Empty tables pass through all stages as empty tables.  Rows that share an id
are rows of their own in every stage; texts of any length are read whole;
columns beside those of ``documents`` are carried along by stages 1 to 4,
whatever their names (those that begin with two underscores excepted).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rfmlens.llm import decontaminate as _decontaminate
from rfmlens.llm import jaccard_join, language, mixing, pii
from rfmlens.llm._common import small_side, table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows, not ids, are linked and removed: a row is known by a hash of all its
    columns.  Of each component the row with the smallest id stays (a null id
    last; of rows with one id the smallest hash), once where it is repeated."""
    row = F.xxhash64(*docs.columns)
    groups = jaccard_join.join(docs.select(row.alias("doc_id"), "text"), words=5, num=80, den=100)
    groups = groups.where("n_shingles > 0").groupBy(F.col("doc_id").alias("__row"), "component_id").count()
    groups = written(groups.join(docs.select(row.alias("__row"), F.col("doc_id").alias("__id")).distinct(), "__row"))
    first = groups.groupBy("component_id").agg(
        F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__row")).alias("first"))
    groups = groups.join(first.select("component_id", F.col("first.__row").alias("__first")), "component_id")
    gone = small_side(groups.where("__row != __first").select("__row").distinct())
    again = small_side(groups.where("__row = __first and count > 1").select("__row").distinct())
    kept = docs.withColumn("__row", row).join(gone, "__row", "left_anti")
    once = kept.join(again, "__row", "left_semi").dropDuplicates(["__row"])
    return kept.join(again, "__row", "left_anti").unionByName(once).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.redact(docs, pii.fit(docs))
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.length("text"), "n_chars").cast(kind)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, mixing.TARGET, mixing.domain_of("source"))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("pii", redact_pii),
    ("mix", mix_sources),
]

#: The stages learn models and link near copies; SQL does not express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
