"""The opN_* queries: each applies its operator to its whole table and derives the digest
columns of the contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .common import documents, table
from .decontaminate import decontaminate
from .hard_negatives import hard_negatives
from .licenses import licenses
from .line_dedup import line_dedup
from .mixing import mix
from .passages import passages
from .pii import KINDS as PII_KINDS
from .pii import pii
from .quality import quality
from .secrets import KINDS as SECRET_KINDS
from .secrets import secrets
from .simhash import simhash
from .token_counts import token_counts
from .warc import warc
from .whitening import whiten


def corpus_path(doc_id: Column) -> Column:
    """A place for each document, as the tables have none: directories of ten documents in
    three levels; every tenth document is its directory's LICENSE, every hundredth and
    thousandth that of the directories above."""
    div = lambda n: F.floor(doc_id / n)
    top, mid, low = div(1000).cast("string"), (div(100) % 10).cast("string"), (div(10) % 10).cast("string")
    return (F.when(doc_id % 1000 == 0, F.concat_ws("/", F.lit("corpus"), top, F.lit("LICENSE")))
            .when(doc_id % 100 == 0, F.concat_ws("/", F.lit("corpus"), top, mid, F.lit("LICENSE")))
            .when(doc_id % 10 == 0, F.concat_ws("/", F.lit("corpus"), top, mid, low, F.lit("LICENSE")))
            .when(doc_id.isNotNull(), F.concat_ws("/", F.lit("corpus"), top, mid, low, F.concat(F.lit("f"), doc_id, F.lit(".txt")))))


def corpus_edits(doc_id: Column, text: Column, n: int = 3) -> Column:
    """Edits that follow from the document: each puts a passage of the text in another place
    and removes a few characters there."""
    size = F.length(text) + 1
    pick = lambda k, m: F.pmod(F.xxhash64(doc_id, F.lit(k)), m).cast("int")
    return F.array(*[F.struct(pick(f"at{k}", size).alias("at"), pick(f"remove{k}", F.lit(20)).alias("remove"),
                              F.substr(text, pick(f"from{k}", size) + 1, pick(f"insert{k}", F.lit(40))).alias("insert"))
                     for k in range(n)])


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(documents(spark, sf_dir), corpus_path(F.col("doc_id"))).select(
        "doc_id", "path", "header_license", F.size("headers").alias("n_headers"), "file_license", "license", "inherited_from")


def _span_digest(found: DataFrame, kinds: tuple[str, ...], base: int) -> DataFrame:
    """Counts of the first ``base`` kinds, the digest of their spans, and all spans as text."""
    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*names):
        return F.filter("spans", lambda s: s["kind"].isin(*names))

    own = of(*kinds[:base])
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds[:base]],
        F.sha2(written(own), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(secrets(documents(spark, sf_dir)), SECRET_KINDS, 3)


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _span_digest(pii(documents(spark, sf_dir)), PII_KINDS, 4)


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), corpus_edits(F.col("doc_id"), F.col("text")))


def q_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws("-", s["start"], s["end"])), ",")
    return passages(documents(spark, sf_dir)).select(
        "doc_id", "component_id", "n_repeated_words", "n_passage_words", "n_removed_words", spans.alias("removed_spans"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash(documents(spark, sf_dir))


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "epochs")


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def q_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def q_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc(table(spark, sf_dir, "pages")).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": q_licenses,
    "op2_quality": q_quality,
    "op3_simhash": q_simhash,
    "op4_secrets": q_secrets,
    "op5_mixing": q_mixing,
    "op6_decontaminate": q_decontaminate,
    "op7_pii": q_pii,
    "op8_token_counts": q_token_counts,
    "op9_line_dedup": q_line_dedup,
    "op10_passages": q_passages,
    "op11_whitening": q_whitening,
    "op12_hard_negatives": q_hard_negatives,
    "op13_warc": q_warc,
}


def oracle_queries() -> dict[str, str]:
    return {k: v for k, v in oracle.SQL.items() if k in QUERIES}
