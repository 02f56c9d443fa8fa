"""Folder of invoice XML -> the three CSV outputs, parsing every document once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.invoices import itens, notas, quarantine
from ..session import remove_shared, shared_scratch_path
from ..sources.csv_sink import write_csv, write_csv_file
from ..sources.invoices import parse_invoices, read_invoice_files


def write_invoices(raw: DataFrame, out_dir: str, suffix: str = "", *, ordered: bool = False,
                   single_file: bool = False) -> None:
    """Parse ``raw`` (see ``read_invoice_files``) once and write ``itens``, ``notas`` and
    ``quarantine`` below ``out_dir``.

    The parsed rows are written as Parquet in the shared folder, read by the three
    outputs (each reads only its columns) and removed. ``ordered``: rows in sorted path
    order, over the part files in the order of their names. ``single_file``: one ordered
    file ``{name}.csv`` per output instead of a folder.
    """
    spark = raw.sparkSession
    path = shared_scratch_path(spark, "invoices")
    parsed = parse_invoices(raw, together=True)
    parsed.select("source_path", "source_file", F.when(F.col("malformed"), F.col("value")).alias("value"),
                  "inf", "inf_key", "malformed").write.parquet(path)
    ordered = ordered or single_file
    try:
        rows = spark.read.parquet(path).withColumns({"header": F.col("inf"), "key": F.col("inf_key"), "readable": ~F.col("malformed")})
        bad = quarantine(rows.orderBy("source_path") if ordered else rows)
        for name, df in (("itens", itens(rows, ordered=ordered)), ("notas", notas(rows, ordered=ordered)), ("quarantine", bad)):
            target = f"{out_dir.rstrip('/')}/{name}{suffix}"
            if single_file:
                write_csv_file(df, f"{target}.csv")
            else:
                write_csv(df, target)
    finally:
        remove_shared(spark, path)


def convert_folder(spark: SparkSession, in_path: str, out_dir: str, *, single_file: bool = False, **read_options) -> None:
    """The whole conversion of a folder (or one file), rows in sorted path order."""
    write_invoices(read_invoice_files(spark, in_path, **read_options), out_dir, ordered=True, single_file=single_file)
