"""Helpers shared by the operators of this subpackage (native Column expressions only)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint

# The white space of every contract: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACES_RE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

__all__ = ["SPACES", "SPACES_RE", "arrow_batches", "ascii_lower", "checkpoint", "documents", "drop_lines",
           "let", "prefix_sum", "replace_text", "split_lines", "split_words", "table", "text_hash"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send ``rows`` rows at a time to Python in the jobs run inside, so that a worker and the
    JVM hold a few MB of text each; the session's own setting is put back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable, so that it is evaluated once however often
    ``body`` uses it (an expression inlined below a lambda would run per element)."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def split_words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+``; null and blank texts give an empty array."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(t) > 0, F.split(t, SPACES_RE)).otherwise(
        F.array().cast("array<string>"))


def split_lines(text: Column) -> Column:
    """Array of the \\n-split lines; null and empty texts give one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def text_hash(text: Column) -> Column:
    """With the document id it names a row, so that repeated ids with other texts stay apart."""
    return F.xxhash64(text)


def drop_lines(df: DataFrame, id_col: str, text_col: str, drops: DataFrame,
               drop_empty: bool = False) -> DataFrame:
    """Rows of ``df`` as ``row`` with ``lines``, ``dropped`` and ``kept`` text.

    ``drops(_id, _th, _pos)`` holds the line positions to remove per document, one row per
    document. The kept positions come from one ``array_except`` (a hash set), so a document
    of very many lines costs time in proportion to them. ``drop_empty``: a document with an
    empty list goes altogether.
    """
    src = df.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"),
                    text_hash(F.col(text_col)).alias("_th"))
    d = drops.select(F.col("_id").alias("_did"), F.col("_th").alias("_dth"), "_pos")
    j = src.join(d, F.col("_id").eqNullSafe(F.col("_did")) & (F.col("_th") == F.col("_dth")), "left")
    if drop_empty:
        j = j.where(F.col("_pos").isNull() | (F.size("_pos") > 0))
    text = F.col(f"row.`{text_col}`")
    kept = let(split_lines(text), lambda ls: F.array_join(
        F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("_pos")),
                    lambda p: F.get(ls, p)), "\n"))
    return j.select("row", F.size(split_lines(text)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("_pos"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.when(F.col("_pos").isNotNull(), kept).otherwise(text).alias("kept"))


def replace_text(dropped: DataFrame, df: DataFrame, text_col: str) -> DataFrame:
    """Rows of ``drop_lines`` as rows of ``df`` with the kept text, and with its length in
    ``n_chars`` where that column exists."""
    row = F.col("row").withField(f"`{text_col}`", F.col("kept"))
    if "n_chars" in df.columns:
        row = row.withField("n_chars", F.length("kept").cast(df.schema["n_chars"].dataType))
    return dropped.select(row.alias("row")).select("row.*")


def prefix_sum(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """``out`` = sum of ``value`` over this row and all before it in the order, over all rows.

    Rows are range-partitioned (``order`` should be a total order: a hot leading key is then
    spread by the later ones) and materialised; the per-partition totals, one row per
    partition, are summed up in a window and joined back; each partition sums its own rows.
    """
    from pyspark.sql import Window
    dealt = checkpoint(df.repartitionByRange(*[F.col(c) for c in order])
                       .withColumn("_part", F.spark_partition_id()))
    totals = dealt.groupBy("_part").agg(F.sum(value).alias("_t"))
    before = totals.select("_part", (F.sum("_t").over(Window.orderBy("_part")) - F.col("_t")).alias("_before"))
    own = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (dealt.withColumn("_own", F.sum(value).over(own)).join(F.broadcast(before), "_part")
            .withColumn(out, F.col("_own") + F.col("_before")).drop("_own", "_before", "_part"))
