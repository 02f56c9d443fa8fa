"""Semicolon CSV sink with the reference's dialect.

``;`` separator, UTF-8, header, minimal quoting with quotes doubled, CRLF line
ends, blanks and line feeds inside values kept as they are. Output is a directory
of part files written in parallel, each with the header. ``write_csv_file`` makes one
file with one header: the parts are written in parallel and in the order of the rows, and
the file system joins them (by itself where it can, otherwise by copying their bytes).

The lines are built as text: Spark's CSV writer would turn a line feed inside a value
into the record separator.
"""

from __future__ import annotations

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import remove_shared, shared_scratch_path

READ_OPTIONS = {"sep": ";", "header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
                "multiLine": "true", "ignoreLeadingWhiteSpace": "false",
                "ignoreTrailingWhiteSpace": "false", "lineSep": "\r\n"}
FAST = {"zlib.compress.level": "BEST_SPEED"}  # of gzip
_ROW_IN_PARTITION = (1 << 33) - 1  # the low bits of monotonically_increasing_id


def _field(c: Column, alone: bool) -> Column:
    """A value as the csv module writes it with minimal quoting."""
    v = F.coalesce(c.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
    needs = v.rlike('[;"\r\n]')
    return F.when(needs | (v == "") if alone else needs, quoted).otherwise(v)


def csv_lines(df: DataFrame) -> DataFrame:
    """One column ``value``: the record of each row, without its line end."""
    alone = len(df.columns) == 1
    return df.select(F.concat_ws(";", *[_field(F.col(f"`{c}`"), alone) for c in df.columns]).alias("value"))


def csv_header(columns: list[str]) -> str:
    return ";".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ';"\r\n') else c for c in columns)


def write_csv(df: DataFrame, path: str, *, single_file: bool = False, mode: str = "overwrite",
              compression: str = "none") -> None:
    """Write ``df`` in one pass; with no rows the output holds no header either.

    The header goes before the first row of each part, so an empty result has none.
    ``single_file``: one joined part (see ``write_csv_file``). ``compression``: Spark's name of
    the parts' codec; ``read_csv_strings`` knows it by their names.
    """
    if single_file:
        if mode != "overwrite":
            raise ValueError("a single file can only be overwritten")
        if compression != "none":
            raise ValueError("a single file is not compressed")
        remove_shared(df.sparkSession, path)
        return write_csv_file(df, f"{path.rstrip('/')}/part-00000.csv")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_PARTITION)) == 0
    header = F.lit(csv_header(df.columns) + "\r\n")
    lines = csv_lines(df).select(F.when(first, F.concat(header, F.col("value"))).otherwise(F.col("value")).alias("value"))
    lines.write.mode(mode).options(lineSep="\r\n", compression=compression, **FAST).text(path)


def write_csv_file(df: DataFrame, path: str) -> None:
    """Write ``df`` as the one file ``path``, its rows in the order of ``df``; no task holds
    more than its part. With no rows the file is empty (S8)."""
    spark = df.sparkSession
    parts = shared_scratch_path(spark, "csv")
    try:
        csv_lines(df).write.option("lineSep", "\r\n").text(parts)
        join_parts(spark, parts, path, (csv_header(df.columns) + "\r\n").encode("utf-8"))
    finally:
        remove_shared(spark, parts)


def join_parts(spark: SparkSession, folder: str, path: str, header: bytes) -> None:
    """``header`` and the part files of ``folder``, in the order of their names, as one file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(path)
    fs, out_fs = source.getFileSystem(conf), target.getFileSystem(conf)
    files = [f for f in fs.listStatus(source) if f.getPath().getName().startswith("part-") and f.getLen() > 0]
    files = [f.getPath() for f in sorted(files, key=lambda f: f.getPath().getName())]
    out = out_fs.create(target, True)
    try:
        if files:
            out.write(bytearray(header))
    finally:
        out.close()
    if not files or _concatenated(spark, fs, out_fs, target, files):
        return
    out = out_fs.create(target, True)
    try:
        out.write(bytearray(header))
        for f in files:
            read = fs.open(f)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(read, out, 1 << 20, False)
            finally:
                read.close()
    finally:
        out.close()


def _concatenated(spark: SparkSession, fs, out_fs, target, files: list) -> bool:
    """Whether the file system has appended the files to ``target`` by itself (HDFS does)."""
    if fs.getUri().toString() != out_fs.getUri().toString():
        return False
    paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(files))
    for i, f in enumerate(files):
        paths[i] = f
    try:
        out_fs.concat(target, paths)
    except UnsupportedOperationException:
        return False
    return True


def read_csv_strings(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read a written directory back, all columns text; NULL (empty) -> ''."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    df = spark.read.schema(schema).options(**READ_OPTIONS).csv(path)
    return df.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])
