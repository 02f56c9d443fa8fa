"""Line dedup (9): explode normalised lines, hash, count distinct documents per hash,
drop the lines found in several documents, reassemble by position. Native.

Only ``(id, text hash, position, two 64-bit hashes)`` of each line is shuffled for the
count; a hot line is pre-aggregated to one ``(min, max)`` row per task. The whole texts
are shuffled once, when their dropped positions are joined to them.

Defined results:
* null or empty text: one empty line, nothing dropped; empty table: empty result;
* a repeated id is one document: its rows never make a line a duplicate of themselves;
* a null id counts as one document that comes after all others;
* other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (SPACES, ascii_lower, checkpoint, drop_lines, replace_text, split_lines,
                     text_hash)

MIN_KEY_CHARS = 10
MIN_DOCUMENTS = 2


def line_rows(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(_id, _th, _p, _h1, _h2) of the lines with a key of ``min_chars`` or more.

    128 bits of hash: at 10^12 lines a 64-bit hash alone would collide.
    """
    src = df.select(F.col(id_col).alias("_id"), text_hash(F.col(text_col)).alias("_th"),
                    F.posexplode(split_lines(F.col(text_col))).alias("_p", "_line"))
    src = src.withColumn("_line", F.btrim("_line", F.lit(SPACES))).where(F.length("_line") >= min_chars)
    key = ascii_lower(F.col("_line"))
    return src.select("_id", "_th", "_p", F.xxhash64(key).alias("_h1"),
                      F.xxhash64(F.lit("line"), key).alias("_h2"))


def find_drops(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """(_id, _th, _pos): per document the positions of the lines it loses."""
    rows = checkpoint(line_rows(df, id_col, text_col, min_chars))
    # Written out, so that the join below has an exchange of its own on either side and AQE
    # can split a line that a large part of all documents holds.
    shared = checkpoint(rows.groupBy("_h1", "_h2")
                        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"),
                             F.max(F.col("_id").isNull()).alias("_nulls"))
                        .where((F.col("_first") != F.col("_last")) | (F.col("_nulls") & F.col("_first").isNotNull()))
                        .select("_h1", "_h2", "_first"))
    lost = rows.join(shared, ["_h1", "_h2"]).where(
        F.col("_id").isNull() | (F.col("_id") != F.col("_first")))
    return lost.groupBy("_id", "_th").agg(F.collect_set("_p").alias("_pos"))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """Per row: id, n_lines, n_dropped, kept (the text that stays)."""
    out = drop_lines(df, id_col, text_col, find_drops(df, id_col, text_col, min_chars))
    return out.select(F.col(f"row.`{id_col}`").alias(id_col), "n_lines", "n_dropped",
                      F.coalesce("kept", F.lit("")).alias("kept"))


def line_dedup_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their remaining text; all other columns as they were."""
    return replace_text(drop_lines(df, id_col, text_col, find_drops(df, id_col, text_col)), df, text_col)
