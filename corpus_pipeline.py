"""The corpus pipeline: five stages over ``documents``, each written and read again.

quality rules -> line dedup -> SimHash near-dedup -> benchmark decontamination -> mixing.

Every stage but the last returns the columns of its input, other columns as they were
(whatever their names), with ``text`` and ``n_chars`` (where there is one) after its
decisions; an empty table gives an empty table.

* Null, empty and blank texts have fewer than ten words and go in the first stage.
* A null host is a host of its own; a null id comes after all others.
* Very long texts are read whole.
* Rows equal in id and text are judged alike; from the third stage on one of them is left.
* A document that loses all its lines to documents before it stays with an empty text;
  the empty ones are one SimHash group, and the mix takes no words of the one that is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from balancete.llm.common import documents, table
from balancete.llm.decontaminate import decontaminate
from balancete.llm.line_dedup import line_dedup_documents
from balancete.llm.mixing import mix
from balancete.llm.quality import quality_documents
from balancete.llm.simhash import simhash_documents
from balancete.session import remove_shared, shared_scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are not depleted, less their boilerplate lines.

    Ties: a line at exactly the limit stays, a text held by several documents counts once.
    """
    return quality_documents(docs)


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the document with the smallest id only, there as often as they stand.

    Ties: rows with the same id are one document; lines of under ten code points stay.
    """
    return line_dedup_documents(docs)


def stage_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints within three bits: the one with the smallest id.

    Ties: of several texts under that id one stays, the same in every run.
    """
    return simhash_documents(docs)


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs; an item without words matches nothing."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), keep_row=True)


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with their size, target and taken words (see ``mix``).

    Ties in finish time go by the hash of the id, then the id; a document without words is not taken.
    """
    return mix(docs).where(F.col("taken") > 0).select(
        "doc_id", "size", "source_size", "target", "epochs", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("quality", stage_quality),
    ("line_dedup", stage_line_dedup),
    ("simhash", stage_simhash),
    ("decontaminate", stage_decontaminate),
    ("mixing", stage_mixing),
]

ORACLE_SQL = None  # XXH64 fingerprints and components have no DuckDB equivalent; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What a stage has written goes once the next has read it;
    the mix keeps only figures, which it has checkpointed when its DataFrame is there."""
    docs, last = documents(spark, sf_dir), None
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        path = shared_scratch_path(spark, f"pipeline-{name}") if k < len(STAGES) - 1 else None
        if path:
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        if last:
            remove_shared(spark, last)
        last = path
    return docs
