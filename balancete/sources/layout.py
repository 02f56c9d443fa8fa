"""Document facts laid out for their joins: bucketed on a document key, hot documents salted.

Header (F7601B), lines (F7611B), tax detail (F76B011) and DIFAL detail (F5576007) meet on the
document's number, type and series sequence. ``write_layout`` adds ``_K``, a hash of these and
of a salt, and buckets and sorts all four tables on it, so that their joins need no exchange
of any fact. A document of more than ``LINES_PER_KEY`` lines gets several salts: its lines and
details are dealt over them by their line id, and its header row stands once under each. A
document that holds a third of all lines is thereby spread over all buckets, and no key has
many lines to compare. ``_K`` is only a hash; the joins compare the whole keys as well.

The files are ordinary Parquet; the tables are registered in the session's catalog (external,
bucketed), because Spark takes the bucketing from there. Choose at least as many buckets as
shuffle partitions: Spark exchanges both sides again otherwise where only one is laid out.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint
from .schemas import ERP_SCHEMAS

LINES_PER_KEY = 128

# Columns (number, type, series sequence, line id) of each fact; the header has no lines.
DOCUMENT_KEYS = {
    "F7601B": ("FHBNNF", "FHDCT", "FHN001", None),
    "F7611B": ("FDBNNF", "FDDCT", "FDN001", "FDUKID"),
    "F76B011": ("TDBNNF", "TDDCT", "TDN001", "TDUKID"),
    "F5576007": ("DFBNNF", "DFDCT", "DFN001", "DFUKID"),
}
LAYOUT = "_layout"


def _document(number: str, kind: str, sequence: str) -> Column:
    return F.xxhash64(F.col(number), F.rtrim(kind), F.col(sequence))


def write_layout(tables, root: str, buckets: int, names=tuple(DOCUMENT_KEYS)) -> None:
    """Write the facts of ``tables`` (which must have all of ``names``) below ``root``."""
    spark = tables["F7611B"].sparkSession
    # Written out, so that AQE can split a hot document's lines in the joins below.
    many = checkpoint(tables["F7611B"].groupBy(_document(*DOCUMENT_KEYS["F7611B"][:3]).alias("_d"))
                      .agg(F.ceil(F.count("*") / LINES_PER_KEY).cast("int").alias("_salts")).where("_salts > 1"))
    for name in names:
        number, kind, sequence, line = DOCUMENT_KEYS[name]
        rows = tables[name].withColumn("_doc", _document(number, kind, sequence)).join(many, F.col("_doc") == F.col("_d"), "left")
        salts = F.coalesce("_salts", F.lit(1))
        salt = F.explode(F.sequence(F.lit(0), salts - 1)) if line is None else F.coalesce(F.pmod(F.xxhash64(line), salts), F.lit(0))
        rows = rows.withColumn("_SALT", salt.cast("int") if line else salt)
        rows = rows.select(*ERP_SCHEMAS[name].fieldNames(), F.xxhash64("_doc", "_SALT").alias("_K"), "_SALT")
        # One task, and so one file, per bucket.
        (rows.repartition(buckets, "_K").write.mode("overwrite").bucketBy(buckets, "_K").sortBy("_K")
         .option("path", f"{root.rstrip('/')}/{name}").format("parquet").saveAsTable(_table(root, name)))
    spark.createDataFrame([(n, buckets) for n in names], "name string, buckets int").coalesce(1) \
        .write.mode("overwrite").parquet(f"{root.rstrip('/')}/{LAYOUT}")


def _table(root: str, name: str) -> str:
    return f"erp_{hashlib.md5(root.rstrip('/').encode()).hexdigest()[:16]}_{name}".lower()


def read_layout(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The facts that ``write_layout`` has written below ``root``, with ``_K`` and ``_SALT``; none otherwise."""
    path = f"{root.rstrip('/')}/{LAYOUT}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return {}
    out = {}
    for row in spark.read.parquet(path).collect():  # a row per table
        table = _table(root, row.name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ERP_SCHEMAS[row.name])
        spark.sql(f"DROP TABLE IF EXISTS `{table}`")  # external: the files stay
        spark.sql(f"CREATE TABLE `{table}` ({columns}, _K bigint, _SALT int) USING parquet CLUSTERED BY (_K) SORTED BY (_K) "
                  f"INTO {row.buckets} BUCKETS LOCATION '{root.rstrip('/')}/{row.name}'")
        spark.sql(f"ANALYZE TABLE `{table}` COMPUTE STATISTICS NOSCAN")  # its size, for the planner
        out[row.name] = spark.table(table)
    return out


def plain(name: str, laid_out: DataFrame) -> DataFrame:
    """The rows of the ERP table, without the columns and the copies of the layout."""
    rows = laid_out.where("_SALT = 0") if DOCUMENT_KEYS[name][3] is None else laid_out
    return rows.select(*ERP_SCHEMAS[name].fieldNames())


def same(a: Column, b: Column) -> Column:
    """Equality that is no join key of its own: rows under one ``_K`` are compared by it."""
    return (a <= b) & (a >= b)
