"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import fold, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import scan
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import license_scan
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return license_scan.scan(docs.select("doc_id", license_scan.document_path().alias("path"), "text"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(fold("doc_id", 5) != 0)
    return (quality(docs, labels)
            .select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(fold("doc_id", 4) != 2)
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted",
                        F.get("evidence", F.lit(0))["doc_id"].alias("nearest"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return mixing.mix(docs, mixing.TARGET, mixing.domain_of("source")).drop("text")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pii.detect(docs, pii.fit(docs))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import language
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.fit(docs, train=fold("doc_id", 3) != 1)
    return (language.identify(docs, model)
            .select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score",
                    F.size("spans").alias("n_spans")))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import join
    return join(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import nearest
    return nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contamination
    return contamination(table(spark, sf_dir, "documents", "doc_id", "text"),
                         table(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .merkle import verified
    return verified(table(spark, sf_dir, "documents"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
                with_ids=False)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical import build_index, search
    return search(build_index(table(spark, sf_dir, "documents", "doc_id", "text")),
                  table(spark, sf_dir, "benchmark", "item_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op")}


def oracle_sql() -> dict[str, str]:
    from . import decontaminate, lexical, license_scan, merkle, mixing, neighbours
    return {"op2_license_scan": license_scan.oracle_sql(), "op4_mixing": mixing.oracle_sql(),
            "op6_neighbours": neighbours.ORACLE_SQL, "op7_decontaminate": decontaminate.ORACLE_SQL,
            "op11_merkle_manifest": merkle.oracle_sql(), "op13_lexical_search": lexical.ORACLE_SQL}
