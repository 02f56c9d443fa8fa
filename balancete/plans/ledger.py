"""The common ledger (C7) and the monthly income statement.

``ledger_for_period`` is the current query: monthly balances (allocated)
plus every document branch for the same month. ``ledger_from_journal`` is the
older query: posted journal lines (allocated) plus the document branches
from a start date on, no aggregation. Both return ``LEDGER_SCHEMA``.
"""

from __future__ import annotations

import weakref
from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import MONEY, month_key
from ..operators.documents import (difal_lines, document_branches, document_lines, few_documents,
                                   headers, tax_code_lines)
from ..operators.gl import allocate, gl_balance, gl_detail
from ..session import remove_shared, shared_scratch_path
from ..sources.schemas import INCOME_STATEMENT_SCHEMA, LEDGER_SCHEMA
from .config import DEFAULT_CONFIG, LedgerConfig
from .params import DetailParams, PeriodParams


# The ledger columns that the income statement reads.
STATEMENT_COLUMNS = ("DATA_LANCAMENTO", "VALOR_TRANSACAO", "CONTA", "CONTA_I", "CONTA_ESTRUTURA",
                     "DESCRICAO_CONTA_II", "CONTA_COMPLETA")


def conform(df: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """Cast to the ledger schema, by name, in the ledger's column order.

    Written as SQL expressions: the whole projection is parsed in the JVM in
    one call instead of one driver round trip per column operation.
    """
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
                           for f in LEDGER_SCHEMA.fields if columns is None or f.name in columns])


def union_all(parts: list[DataFrame], columns: Collection[str] | None = None) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [conform(p, columns) for p in parts])


def document_ledger(tables, issue_from: int, issue_to: int | None,
                    cfg: LedgerConfig = DEFAULT_CONFIG, *,
                    columns: Collection[str] | None = None, folders: list | None = None) -> DataFrame:
    """All document branches (C4 incl. DIFAL, C5, C6) for an issue-date range.

    Three consumers read the lines, so they are computed once and written as
    Parquet in the shared folder: columnar, read pruned, with real sizes for the
    planner, and re-read rather than recomputed when an executor is lost. The
    folder is noted in ``folders``, by default the bundle's, which
    ``release_documents`` removes; ``OpenLedger`` owns its own.

    Where the range has few documents (a month's), the facts are cut to them at their scans,
    first by the headers' numbers, then by the written lines' own.
    """
    documents = None
    if cfg.materialize_documents:
        documents = few_documents(headers(tables["F7601B"], issue_from, issue_to), "FHBNNF", cfg)
    doc = document_lines(tables, issue_from, issue_to, cfg, columns=columns, documents=documents)
    if cfg.materialize_documents:
        path = shared_scratch_path(doc.sparkSession, "document_lines")
        doc.write.parquet(path)
        (tables.derived.setdefault("_document_folders", []) if folders is None else folders).append((doc.sparkSession, path))
        doc = doc.sparkSession.read.parquet(path)
        documents = few_documents(doc, "FDBNNF", cfg)
    written = cfg.materialize_documents
    return union_all([document_branches(doc, cfg, columns=columns),
                      difal_lines(doc, tables, cfg, columns=columns, written=written, documents=documents),
                      tax_code_lines(doc, tables, cfg, columns=columns, written=written, documents=documents)], columns)


def release_documents(tables) -> None:
    """Remove the document lines written by earlier ledgers of this bundle."""
    for spark, path in tables.derived.pop("_document_folders", []):
        remove_shared(spark, path)


def ledger_for_period(tables, params: PeriodParams, cfg: LedgerConfig = DEFAULT_CONFIG, *,
                      columns: Collection[str] | None = None, folders: list | None = None) -> DataFrame:
    gl = allocate(gl_balance(tables, params, cfg), cfg)
    docs = document_ledger(tables, params.jul_from, params.jul_to, cfg, columns=columns, folders=folders)
    return union_all([gl, docs], columns)


def ledger_from_journal(tables, params: DetailParams, cfg: LedgerConfig | None = None, *,
                        columns: Collection[str] | None = None, folders: list | None = None) -> DataFrame:
    cfg = cfg or DEFAULT_CONFIG.returns_label_old()
    gl = allocate(gl_detail(tables, params, cfg), cfg)
    docs = document_ledger(tables, params.jul_from, params.jul_to, cfg, columns=columns, folders=folders)
    return union_all([gl, docs], columns)


def income_statement(ledger: DataFrame, params: PeriodParams, *, trim_labels: bool = False,
                     sort: bool = True) -> DataFrame:
    """Month x account sums of the ledger, NULL keys kept as groups.

    ``trim_labels`` trims the label keys before grouping (off by default:
    the source groups on the padded labels, SURVEY B8). The date filter is
    half-open ``[date_from, date_to)``.
    """
    d = F.col("DATA_LANCAMENTO")
    rows = ledger.where((d >= F.lit(params.date_from)) & (d < F.lit(params.date_to)))
    keys = ["CONTA", "CONTA_I", "CONTA_ESTRUTURA", "DESCRICAO_CONTA_II", "CONTA_COMPLETA"]
    if trim_labels:
        rows = rows.select(d, F.col("VALOR_TRANSACAO"), *[F.trim(k).alias(k) for k in keys])
    out = (rows.groupBy(month_key(d).alias("COMPETENCIA"), *keys)
           .agg(F.sum("VALOR_TRANSACAO").cast(MONEY).alias("VALOR_DRE")))
    out = out.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}"
                           for f in INCOME_STATEMENT_SCHEMA.fields])
    if sort:
        out = out.orderBy(F.col("CONTA").asc_nulls_last(), F.col("CONTA_I").asc_nulls_last(),
                          F.col("CONTA_ESTRUTURA").asc_nulls_last())
    return out


def ledger(tables, source: str, params, cfg: LedgerConfig | None = None, *,
           columns: Collection[str] | None = None, folders: list | None = None) -> DataFrame:
    """The common ledger from monthly balances (``source='balance'``, with
    ``PeriodParams``) or from posted journal lines (``source='detail'``, with
    ``DetailParams``). ``columns`` limits it to the ledger columns that are
    wanted (``STATEMENT_COLUMNS`` for an income statement).

    Its document lines are written while the DataFrame is built, and stay until
    ``release_documents``; see ``open_ledger`` for a ledger that looks after them."""
    if source == "balance":
        return ledger_for_period(tables, params, cfg or DEFAULT_CONFIG, columns=columns, folders=folders)
    if source == "detail":
        return ledger_from_journal(tables, params, cfg, columns=columns, folders=folders)
    raise ValueError(f"unknown ledger source {source!r}")


def _remove(folders: list) -> None:
    while folders:
        spark, path = folders.pop()
        if spark.sparkContext._jsc is not None:  # a stopped session has no file system to ask
            remove_shared(spark, path)


class OpenLedger:
    """A ledger that owns its written document lines.

    ``rows`` is the ledger; nothing runs before it is first asked for. The lines it reads are
    this ledger's alone and go when it is closed, at the end of a ``with`` block, or at the
    latest when the object is collected or Python exits::

        with open_ledger(tables, "balance", params) as led:
            led.rows.write.parquet(path)
            led.income_statement().show()

    DataFrames made from ``rows`` are to be used while it is open.
    """

    def __init__(self, tables, source: str, params, cfg: LedgerConfig | None = None, *,
                 columns: Collection[str] | None = None) -> None:
        if source not in ("balance", "detail"):
            raise ValueError(f"unknown ledger source {source!r}")
        self._make = lambda folders: ledger(tables, source, params, cfg, columns=columns, folders=folders)
        self._params, self._rows, self._folders = params, None, []
        self._finalizer = weakref.finalize(self, _remove, self._folders)

    @property
    def rows(self) -> DataFrame:
        if not self._finalizer.alive:
            raise ValueError("the ledger is closed")
        if self._rows is None:
            self._rows = self._make(self._folders)
        return self._rows

    def income_statement(self, params: PeriodParams | None = None, **options) -> DataFrame:
        """C8 of the ledger's own period, or of ``params`` (a ledger of journal lines has no end)."""
        return income_statement(self.rows, params or self._params, **options)

    def close(self) -> None:
        self._rows = None
        self._finalizer()

    def __enter__(self) -> OpenLedger:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def open_ledger(tables, source: str, params, cfg: LedgerConfig | None = None, *,
                columns: Collection[str] | None = None) -> OpenLedger:
    """``ledger`` with an owner of what it writes."""
    return OpenLedger(tables, source, params, cfg, columns=columns)
