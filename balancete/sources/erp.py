"""ERP tables as DataFrames: a bundle type and a validating Parquet reader and writer."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (CharType, DataType, DecimalType, StringType, StructType,
                               VarcharType)

from .layout import DOCUMENT_KEYS, plain, read_layout, write_layout
from .schemas import ERP_SCHEMAS


@dataclass
class ErpTables:
    """The twelve source tables, by ERP name (F0901, F7611B, ...).

    Checks and dimensions are kept for the life of the bundle: after the Parquet below has
    been rewritten, read a new bundle with ``read_erp``; after another table has been put
    into ``tables``, call ``refresh``.
    """

    tables: dict[str, DataFrame] = field(default_factory=dict)
    # Results of size / key-uniqueness checks, computed once per table and key.
    stats: dict = field(default_factory=dict)
    # Facts in the layout of ``sources.layout``, by ERP name; ``tables`` has their plain rows.
    layouts: dict[str, DataFrame] = field(default_factory=dict)
    # Dimensions built from these tables and materialised once (see
    # operators.lookups.materialized).
    derived: dict = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        try:
            return self.tables[name]
        except KeyError as exc:  # pragma: no cover - message only
            raise KeyError(f"ERP table {name} is not loaded") from exc

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def refresh(self) -> None:
        """Forget checks and dimensions; they are built again when they are needed."""
        self.stats.clear()
        for key in [k for k in self.derived if k != "_document_folders"]:
            del self.derived[key]

    def with_tables(self, **more: DataFrame) -> "ErpTables":
        t = dict(self.tables)
        t.update(more)
        # New tables, so no cached checks carried over, and no layout of a table that has changed.
        return ErpTables(t, layouts={} if set(more) & set(DOCUMENT_KEYS) else dict(self.layouts))


class SchemaMismatch(ValueError):
    pass


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema in the footers of a Parquet folder, read by a Spark job; files that disagree
    raise, and a folder without files (an empty table) has none."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as exc:
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def validate(name: str, stored: StructType) -> None:
    """Every column of the ERP table must be stored, under its name and with a type that is
    read without loss: the same one, a shorter whole number, or a decimal of the same scale.
    Further columns may be there. Otherwise a missing column would silently read as NULL."""
    found = {f.name: f.dataType for f in stored}
    problems = []
    for f in ERP_SCHEMAS[name]:
        have = found.get(f.name)
        if have is None:
            problems.append(f"{f.name} is missing")
        elif not _readable(have, f.dataType):
            problems.append(f"{f.name} is {have.simpleString()}, not {f.dataType.simpleString()}")
    if problems:
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))


_WHOLE = ["tinyint", "smallint", "int", "bigint"]


def _readable(have: DataType, want: DataType) -> bool:
    a, b = have.simpleString(), want.simpleString()
    if a in _WHOLE and b in _WHOLE:
        return _WHOLE.index(a) <= _WHOLE.index(b)
    if isinstance(have, DecimalType) and isinstance(want, DecimalType):
        return have.scale == want.scale and have.precision <= want.precision
    text = (StringType, CharType, VarcharType)
    return a == b or isinstance(have, text) and isinstance(want, text)


def read_erp(spark: SparkSession, root: str, names: Mapping[str, str] | None = None, *,
             check: bool = True) -> ErpTables:
    """Read each table from ``{root}/{NAME}`` (Parquet) with its explicit schema.

    The schema is never inferred: the stored padding and types are kept as they are. But the
    footers are checked against it (``validate``) unless ``check`` is false. Facts written by
    ``write_layout`` are read in their layout.
    """
    names = dict(names or {n: n for n in ERP_SCHEMAS})
    layouts = read_layout(spark, root)
    out = {}
    for name, sub in names.items():
        path = f"{root.rstrip('/')}/{sub}"
        stored = stored_schema(spark, path) if check else None
        if stored is not None:
            validate(name, stored)
        out[name] = plain(name, layouts[name]) if name in layouts else spark.read.schema(ERP_SCHEMAS[name]).parquet(path)
    return ErpTables(out, layouts=layouts)


def write_erp(tables: ErpTables, root: str, mode: str = "overwrite", *, buckets: int | None = None) -> None:
    """Write a bundle as Parquet, one folder per table. ``buckets``: the document facts are
    laid out for their joins (``sources.layout``), which always overwrites them."""
    laid_out = [n for n in DOCUMENT_KEYS if n in tables] if buckets else []
    if buckets:
        write_layout(tables, root, buckets, laid_out)
    for name, df in tables.tables.items():
        if name in laid_out:
            continue
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")
