"""Quality rules (2): per-document base rules and cross-document line frequency. Native.

Line frequency: normalised lines are hashed and, per host (``source``), the distinct
documents that hold each line are counted. A line is above the limit when more than
``max_share`` of the host's distinct documents and at least ``min_docs`` of them hold it.
Every line that is not blank counts, however short. Lines above the limit are removed; a document that loses more than ``max_lost`` of its words, or keeps
fewer than ``min_words``, is depleted and rejected. Documents are distinct by their text, so
a text copied many times counts once and does not make its own lines frequent.

One scan reduces each document to its base figures and an array of line hashes; that digest
(no text) is checkpointed and everything else reads it. The count is a two-step distinct
count (first by host, line and document, then by host and line), so a hot line or host is
pre-aggregated and spread by the document.

Defined results:
* null text: no words, so it fails the base rules; empty table: empty result;
* very long texts are read whole; a line exactly at the share, or documents that lose exactly
  ``max_lost``, are not above it;
* null host: a host of its own; null and repeated ids: every row is judged by itself;
* other columns are not read (``quality_documents`` passes them through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (SPACES, ascii_lower, checkpoint, drop_lines, let, replace_text, split_lines,
                     split_words, text_hash)

SYMBOLS_RE = r"[#*$%&|<>]+"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MIN_DOCS = 3          # on a host of under 60 texts the share alone would be less than three
MAX_SHARE = 0.05
MAX_LOST = 0.8


def _repeat_words(words: Column, window: int) -> Column:
    """Words in windows found twice or more: sort the window hashes with their positions,
    keep those equal to a neighbour, count the positions they cover."""
    n = F.size(words) - (window - 1)

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.size(F.array_distinct(F.flatten(F.transform(
            F.filter(s, lambda p, k: (F.get(s, k - 1)["h"] == p["h"]) | (F.get(s, k + 1)["h"] == p["h"])),
            lambda p: F.sequence(p["i"], p["i"] + (window - 1)))))))

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - window),
                             lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))

    return F.when(n > 0, let(words, counted)).otherwise(0)


def digest(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """One row per document, without its text; ``_rid`` names the row."""
    text = F.col("_text")
    src = df.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.col(text_col).alias("_text"))
    plain = F.coalesce(text, F.lit(""))

    def line_digest(line: Column) -> Column:
        key = ascii_lower(F.btrim(line, F.lit(SPACES)))
        return let(key, lambda k: F.struct(F.length(k).alias("n"), F.xxhash64(k).alias("h1"),
                                           F.xxhash64(F.lit("line"), k).alias("h2"),
                                           F.size(split_words(k)).alias("w")))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        _repeat_words(w, WINDOW).cast("long").alias("n_repeat_words"))

    def of_lines(ls: Column) -> Column:
        filled = F.filter(ls, lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
        return F.struct(let(filled, lambda f: F.size(f) - F.size(F.array_distinct(f))).cast("long").alias("n_dup_lines"),
                        F.transform(ls, line_digest).alias("lines"))

    return src.select("_id", "_host", text_hash(text).alias("_th"),
                      (F.length(plain) - F.length(F.regexp_replace(plain, SYMBOLS_RE, ""))).cast("long").alias("n_symbols"),
                      let(split_words(text), of_words).alias("w"), let(split_lines(text), of_lines).alias("l")) \
        .select("_id", "_host", "_th", "w.*", "n_symbols", "l.*", F.monotonically_increasing_id().alias("_rid"))


def frequent_lines(rows: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(_host, h1, h2) of the lines above the limit."""
    lines = rows.select("_host", "_th", F.explode("lines").alias("x")).where(F.col("x.n") > 0)
    counts = lines.select("_host", "x.h1", "x.h2", "_th").distinct().groupBy("_host", "h1", "h2") \
        .agg(F.count(F.lit(1)).alias("docs"))
    hosts = rows.select("_host", "_th").distinct().groupBy(F.col("_host").alias("_h")).agg(F.count(F.lit(1)).alias("all"))
    return counts.where(F.col("docs") >= min_docs).join(hosts, F.col("_host").eqNullSafe(F.col("_h"))) \
        .where(F.col("docs") > F.col("all") * F.lit(max_share)).select("_host", "h1", "h2")


def _judged(df: DataFrame, id_col: str, text_col: str, host_col: str, min_docs: int, max_share: float,
            max_lost: float) -> tuple[DataFrame, DataFrame]:
    rows = checkpoint(digest(df, id_col, text_col, host_col))
    # Written out, so that AQE can split a hot line of a hot host in the join below.
    frequent = checkpoint(frequent_lines(rows, min_docs, max_share)
                          .select(F.col("_host").alias("_fh"), F.col("h1").alias("_f1"), F.col("h2").alias("_f2")))
    each = rows.select("_rid", "_id", "_th", "_host", F.posexplode("lines").alias("_p", "x")) \
        .where(F.col("x.n") > 0)
    lost = each.join(frequent, F.col("_host").eqNullSafe(F.col("_fh")) & (F.col("x.h1") == F.col("_f1"))
                     & (F.col("x.h2") == F.col("_f2"))) \
        .groupBy("_rid", "_id", "_th").agg(F.sum("x.w").alias("_lost"), F.collect_set("_p").alias("_pos"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_boilerplate_words")
    depleted = (F.col("n_boilerplate_words") > 0) & (
        (left < MIN_WORDS) | (F.col("n_boilerplate_words") > F.col("n_words") * F.lit(max_lost)))
    judged = rows.drop("lines").join(lost.select(F.col("_rid").alias("_r"), "_lost"), F.col("_rid") == F.col("_r"), "left") \
        .withColumn("n_boilerplate_words", F.coalesce("_lost", F.lit(0)).cast("long")) \
        .withColumn("base_failed", failed).withColumn("depleted", depleted) \
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    return judged, lost


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_lost: float = MAX_LOST) -> DataFrame:
    """Per row: id, the base figures, n_boilerplate_words, base_failed, depleted, kept."""
    judged, _ = _judged(df, id_col, text_col, host_col, min_docs, max_share, max_lost)
    return judged.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "n_boilerplate_words", "base_failed", "depleted", "kept")


def quality_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                      min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, max_lost: float = MAX_LOST) -> DataFrame:
    """The documents that are kept, without the lines above the limit."""
    judged, lost = _judged(df, id_col, text_col, host_col, min_docs, max_share, max_lost)
    rejected = judged.where(~F.col("kept")).groupBy("_id", "_th").agg(F.array().cast("array<int>").alias("_pos"))
    # One join: rejected documents are marked by an empty list of positions.
    marks = lost.select("_id", "_th", "_pos").unionByName(rejected.select("_id", "_th", "_pos")) \
        .groupBy("_id", "_th").agg(F.min_by("_pos", F.size("_pos")).alias("_pos"))
    out = drop_lines(df, id_col, text_col, marks, drop_empty=True)
    return replace_text(out, df, text_col)
