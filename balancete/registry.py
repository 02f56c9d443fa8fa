"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the driver tables of one scale-factor folder through the
ERP stand-ins, so its work grows with the data. Keys follow SURVEY §7.3.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .functions import decode_cyyddd, encode_cyyddd, otrim, parse_percent
from .operators.documents import (difal_lines, document_branches, document_lines, few_documents, headers,
                                  tax_code_lines)
from .operators.gl import (account_dimension, allocate, gl_balance, gl_detail, gl_exclusion,
                           period_balances)
from .operators.lookups import center_hierarchy, code_lookup, item_dimension
from .plans.config import DEFAULT_CONFIG
from .plans.ledger import (STATEMENT_COLUMNS, conform, income_statement, ledger_for_period,
                           ledger_from_journal, release_documents)
from .plans.params import DetailParams, PeriodParams
from .operators.invoices import ITENS_COLUMNS, itens, notas, quarantine
from .plans.positions import with_position
from .session import remove_shared, shared_scratch_path
from .sources.csv_sink import read_csv_strings, write_csv
from .sources.invoice_standins import invoice_documents, write_document_files, write_invoice_files
from .sources.erp import read_erp, write_erp
from .sources.invoices import parse_invoices, read_invoices
from .sources.schemas import ERP_SCHEMAS
from .sources.standins import build_standins

# Parameters of the registered queries: one month (the source query's shape),
# a twelve-month range, and an open-ended journal history (the older query).
PERIOD = PeriodParams.month(2000, 3)
RANGE = PeriodParams(_dt.date(2000, 1, 1), _dt.date(2001, 1, 1))
# A range that starts and ends inside a month.
MIDMONTH = PeriodParams(_dt.date(2000, 3, 15), _dt.date(2000, 5, 10))
DETAIL = DetailParams(_dt.date(1999, 1, 1))
OLD_CFG = DEFAULT_CONFIG.returns_label_old()

_TABLES: dict = {}


def tables_for(spark: SparkSession, sf_dir: str):
    """Stand-in bundle per session and folder (lazy plans + cached lookup checks)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = build_standins(spark, sf_dir)
    t = _TABLES[key]
    release_documents(t)  # the previous query has run; remove its written lines
    return t


def use_tables(spark: SparkSession, sf_dir: str, tables) -> None:
    """Serve ``sf_dir`` from a prebuilt bundle (e.g. stand-ins already written as Parquet)."""
    _TABLES.clear()
    _TABLES[(spark.sparkContext.applicationId, sf_dir)] = tables


_INVOICE_SOURCES: dict = {}


def use_invoice_documents(spark: SparkSession, sf_dir: str, docs: DataFrame) -> None:
    """Serve the invoice documents of ``sf_dir`` from a prebuilt DataFrame."""
    _INVOICE_SOURCES.clear()
    _INVOICE_SOURCES[(id(spark), sf_dir)] = docs


# ---------------------------------------------------------------- Spark side

def q_julian_codec(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    enc = encode_cyyddd("o_orderdate")
    return o.select("o_orderkey", F.col("o_orderdate").cast("date").alias("ORDER_DATE"),
                    enc.alias("ENCODED"), decode_cyyddd(enc).alias("DECODED"))


def q_trimmed_lookup(spark, sf):
    t = tables_for(spark, sf)
    a = t["F0901"]
    a = code_lookup(a, F.col("GMR009"), *DEFAULT_CONFIG.account_group_lookup, "CONTA", tables=t)
    a = code_lookup(a, F.col("GMR010"), *DEFAULT_CONFIG.account_subgroup_lookup, "_CI", tables=t)
    return a.select("GMAID", "CONTA", otrim("_CI").alias("CONTA_I"))


def q_item_dimension(spark, sf):
    return item_dimension(tables_for(spark, sf))


def q_center_hierarchy(spark, sf):
    t = tables_for(spark, sf)
    return center_hierarchy(t["F0901"].select("GMAID", "GMMCU"), t, "GMMCU").select(
        "GMAID", "GMMCU", "CENTRO_CUSTO", "FILIAL")


def q_period_balance_pick(spark, sf):
    return period_balances(tables_for(spark, sf), PERIOD)


def q_period_balance_range(spark, sf):
    return period_balances(tables_for(spark, sf), RANGE)


def q_rate_parse(spark, sf):
    t = tables_for(spark, sf)
    u = t["F0006"].select("MCMCU", "MCRP49", "MCRP50")
    u = code_lookup(u, F.col("MCRP49"), *DEFAULT_CONFIG.rate_balloons_lookup, "RATEIO_BALAO_STR",
                    tables=t, value_col="DRSPHD")
    u = code_lookup(u, F.col("MCRP50"), *DEFAULT_CONFIG.rate_multiuse_lookup, "RATEIO_MULTIUSO_STR",
                    tables=t, value_col="DRSPHD")
    return u.select("MCMCU", "RATEIO_BALAO_STR", parse_percent("RATEIO_BALAO_STR").alias("RATEIO_BALAO"),
                    "RATEIO_MULTIUSO_STR", parse_percent("RATEIO_MULTIUSO_STR").alias("RATEIO_MULTIUSO"))


def q_gl_exclusion(spark, sf):
    return account_dimension(tables_for(spark, sf)).where(gl_exclusion()).select(
        "GMAID", "CONTA", "CONTA_I", "CONTA_ESTRUTURA")


def q_gl_balance(spark, sf):
    return gl_balance(tables_for(spark, sf), PERIOD)


def q_gl_detail(spark, sf):
    return gl_detail(tables_for(spark, sf), DETAIL, OLD_CFG)


def q_allocation_split(spark, sf):
    return conform(allocate(gl_balance(tables_for(spark, sf), PERIOD)))


def _doc(spark, sf, classes):
    t = tables_for(spark, sf)
    documents = few_documents(headers(t["F7601B"], PERIOD.jul_from, PERIOD.jul_to), "FHBNNF")
    doc = document_lines(t, PERIOD.jul_from, PERIOD.jul_to, classes=classes, documents=documents)
    return t, doc, documents


def q_document_tax_lines(spark, sf):
    _, doc, _ = _doc(spark, sf, ("sales",))
    return conform(document_branches(doc, classes=("sales",)))


def q_difal_left(spark, sf):
    t, doc, documents = _doc(spark, sf, ("sales",))
    return conform(difal_lines(doc, t, documents=documents))


def q_returns_reversal(spark, sf):
    _, doc, _ = _doc(spark, sf, ("returns",))
    return conform(document_branches(doc, classes=("returns",)))


def q_tax_code_lines(spark, sf):
    t, doc, documents = _doc(spark, sf, ("sales", "returns"))
    return conform(tax_code_lines(doc, t, documents=documents))


def q_ledger_union(spark, sf):
    return ledger_for_period(tables_for(spark, sf), PERIOD)


def q_ledger_detail(spark, sf):
    return ledger_from_journal(tables_for(spark, sf), DETAIL, OLD_CFG)


def q_dre_monthly(spark, sf):
    return income_statement(ledger_for_period(tables_for(spark, sf), PERIOD, columns=STATEMENT_COLUMNS), PERIOD)


def q_dre_range(spark, sf):
    return income_statement(ledger_for_period(tables_for(spark, sf), RANGE, columns=STATEMENT_COLUMNS), RANGE)


def q_dre_midmonth(spark, sf):
    return income_statement(ledger_for_period(tables_for(spark, sf), MIDMONTH, columns=STATEMENT_COLUMNS), MIDMONTH)


def _parsed_invoices(spark, sf):
    docs = _INVOICE_SOURCES.get((id(spark), sf))
    return parse_invoices(docs if docs is not None else invoice_documents(spark, sf))


def q_xml_notas(spark, sf):
    return notas(_parsed_invoices(spark, sf))


def q_xml_itens(spark, sf):
    return itens(_parsed_invoices(spark, sf))


def q_xml_quarantine(spark, sf):
    return quarantine(_parsed_invoices(spark, sf)).select("source_file")


def _scratch(spark, name):
    """A shared folder for what a query writes and reads back; the one of the query's last
    call is removed."""
    old = _SCRATCH.pop(name, None)
    if old and old[0] == spark.sparkContext.applicationId:
        remove_shared(spark, old[1])
    path = shared_scratch_path(spark, name)
    _SCRATCH[name] = (spark.sparkContext.applicationId, path)
    return path


_SCRATCH: dict = {}


def q_csv_roundtrip(spark, sf):
    """Items written with the reference's CSV dialect to the shared folder, read back; every
    product text has a line feed and a quote added before. The parts are compressed: every item
    repeats its document's fields, some fifteen times the size of the tables."""
    path = _scratch(spark, "csv_roundtrip")
    rows = itens(_parsed_invoices(spark, sf))
    write_csv(rows.withColumn("xProd", F.concat("xProd", F.lit('\n"'), "cProd")), path, compression="gzip")
    return read_csv_strings(spark, path, ITENS_COLUMNS)


def q_csv_zero_rows(spark, sf):
    """An output without rows has no header line either (items of unreadable documents)."""
    path = _scratch(spark, "csv_zero_rows")
    parsed = _parsed_invoices(spark, sf)
    write_csv(itens(parsed.where(F.col("malformed"))), path)
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("n_lines"))


def q_xml_folder(spark, sf):
    """One file per document, read back as a folder."""
    path = _scratch(spark, "xml_folder")
    docs = _INVOICE_SOURCES.get((id(spark), sf))
    docs = docs if docs is not None else invoice_documents(spark, sf)
    write_document_files(docs, path)
    return notas(read_invoices(spark, path, glob="*.txt"))


def q_xml_folder_charsets(spark, sf):
    """One ``*.xml`` file per customer in three character sets, read with the default options."""
    path = _scratch(spark, "xml_folder_charsets")
    write_invoice_files(spark, sf, path)
    return notas(read_invoices(spark, path))


def q_xml_itens_order(spark, sf):
    """O2: the reference's file order, as a position."""
    path = _scratch(spark, "xml_itens_order")
    rows = itens(_parsed_invoices(spark, sf), ordered=True, columns=["source_file", "nItem"], through=f"{path}/items")
    return with_position(rows, "position", f"{path}/sorted").select("source_file", "nItem", "position")


def q_erp_scan(spark, sf):
    """All twelve tables written as Parquet and read with their schemas; the account
    master with its padding, and the rows of every table."""
    path = _scratch(spark, "erp")
    write_erp(build_standins(spark, sf), path)
    t = read_erp(spark, path)
    counts = reduce(lambda a, b: a.unionByName(b), [
        t[n].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("name"), "n_rows") for n in sorted(t.tables)])
    labels = t["F0901"].select(F.concat(F.lit("F0901 "), "GMAID", F.lit("|"), "GMOBJ", F.lit("|"), "GMDL01", F.lit("|")).alias("name"),
                               F.lit(1).cast("long").alias("n_rows"))
    return counts.unionByName(labels)


def q_dre_order(spark, sf):
    """O1: the place of each account in the sorted statement (its first row's position)."""
    dre = income_statement(ledger_for_period(tables_for(spark, sf), RANGE, columns=STATEMENT_COLUMNS), RANGE)
    return with_position(dre, "position").groupBy("CONTA", "CONTA_I", "CONTA_ESTRUTURA").agg(
        F.min("position").alias("position"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "julian_codec": q_julian_codec,
    "trimmed_lookup": q_trimmed_lookup,
    "item_dimension": q_item_dimension,
    "center_hierarchy": q_center_hierarchy,
    "period_balance_pick": q_period_balance_pick,
    "period_balance_range": q_period_balance_range,
    "rate_parse": q_rate_parse,
    "gl_exclusion": q_gl_exclusion,
    "gl_balance": q_gl_balance,
    "gl_detail": q_gl_detail,
    "allocation_split": q_allocation_split,
    "document_tax_lines": q_document_tax_lines,
    "difal_left": q_difal_left,
    "returns_reversal": q_returns_reversal,
    "tax_code_lines": q_tax_code_lines,
    "ledger_union": q_ledger_union,
    "ledger_detail": q_ledger_detail,
    "dre_monthly": q_dre_monthly,
    "dre_range": q_dre_range,
    "dre_midmonth": q_dre_midmonth,
    "xml_notas": q_xml_notas,
    "xml_itens": q_xml_itens,
    "xml_quarantine": q_xml_quarantine,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_zero_rows": q_csv_zero_rows,
    "xml_folder": q_xml_folder,
    "xml_folder_charsets": q_xml_folder_charsets,
    "xml_itens_order": q_xml_itens_order,
    "erp_scan": q_erp_scan,
    "dre_order": q_dre_order,
}


# ---------------------------------------------------------------- oracle side

def _gl_cols() -> str:
    return ("DATA_LANCAMENTO, TIPO_DOCUMENTO, NUM_DOCUMENTO, VALOR_TRANSACAO, CONTA_II, EXPLICACAO, "
            "CHAVE_CONTA, ORDEM_CONTA, CONTA_ESTRUTURA, DESCRICAO_CONTA_II, CONTA, CONTA_I, CONTA_COMPLETA, "
            "CENTRO_CUSTO, RATEIO_BALAO, RATEIO_MULTIUSO, EMPRESA, FILIAL, CFOP, NOTA, ITEM, TAMANHO, TIPO, "
            "COR, EMBALAGEM, QUERY_INFO")


def _ledger_period_sql(p: PeriodParams, cfg=DEFAULT_CONFIG) -> list[str]:
    """CTE list + the union SELECT of the full ledger for a period."""
    ctes = [O.standin_ctes(), O.dim_item_cte(cfg), O.acct_cte(cfg), O.gl_balance_cte(p.months(), cfg, p.date_from),
            O.allocation_cte(cfg), O.doc_cte(p.jul_from, p.jul_to, cfg)]
    selects = (["SELECT * FROM glalloc"] + O.sales_branches_sql(cfg) + [O.difal_sql(cfg)]
               + O.returns_branches_sql(cfg) + O.tax_code_sql(cfg))
    return ctes, O.union_sql(selects)


def _dre_sql(p: PeriodParams) -> str:
    ctes, union = _ledger_period_sql(p)
    return O._with(*ctes, f"ledger AS ({union})") + f"""
SELECT strftime(DATA_LANCAMENTO, '%Y-%m') AS COMPETENCIA, CONTA, CONTA_I, CONTA_ESTRUTURA,
       DESCRICAO_CONTA_II, CONTA_COMPLETA, CAST(SUM(VALOR_TRANSACAO) AS DECIMAL(38,4)) AS VALOR_DRE
FROM ledger
WHERE DATA_LANCAMENTO >= DATE '{p.date_from.isoformat()}' AND DATA_LANCAMENTO < DATE '{p.date_to.isoformat()}'
GROUP BY 1, 2, 3, 4, 5, 6
ORDER BY CONTA NULLS LAST, CONTA_I NULLS LAST, CONTA_ESTRUTURA NULLS LAST"""


def _doc_only_sql(selects: list[str], classes_types: tuple, p: PeriodParams = PERIOD) -> str:
    return O._with(O.standin_ctes(), O.dim_item_cte(), O.doc_cte(p.jul_from, p.jul_to)) + "\n" + \
        O.union_sql(selects)


def _range_pick_sql(p: PeriodParams) -> str:
    months = p.months()
    ctes = O._with(O.standin_ctes(), O.gl_balance_cte(months).split("glbase AS")[0].rstrip().rstrip(","))
    return ctes + "\nSELECT GBAID, DATA_LANCAMENTO, VALOR_PERIODO FROM bal WHERE abs(VALOR_PERIODO) > 0"


def oracle_queries() -> dict[str, str]:
    st = O.standin_ctes()
    cfg = DEFAULT_CONFIG
    g = cfg.account_group_lookup
    s = cfg.account_subgroup_lookup
    out = {
        "julian_codec": f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ORDER_DATE, {O._encode('o_orderdate')} AS ENCODED,
       {O._decode(O._encode('o_orderdate'))} AS DECODED
FROM orders""",
        "trimmed_lookup": O._with(st) + f"""
SELECT a.GMAID, d.DRDL01 AS CONTA, {O._otrim('e.DRDL01')} AS CONTA_I
FROM f0901 a
{O._lookup_join('d', g[0], g[1], 'a.GMR009')}
{O._lookup_join('e', s[0], s[1], 'a.GMR010')}""",
        "item_dimension": O._with(st, O.dim_item_cte()) + "\nSELECT * FROM dim_item",
        "center_hierarchy": O._with(st) + f"""
SELECT a.GMAID, a.GMMCU, concat(f.MCMCU, ' ', f.MCDL01) AS CENTRO_CUSTO,
       {O._otrim("concat(b.MCMCU, ' ', b.MCDL01)")} AS FILIAL
FROM f0901 a
LEFT JOIN f0006 f ON rtrim(f.MCMCU) = rtrim(a.GMMCU)
LEFT JOIN f0006 b ON {O._otrim('f.MCRP04')} = {O._otrim('b.MCMCU')}""",
        "period_balance_pick": _range_pick_sql(PERIOD),
        "period_balance_range": _range_pick_sql(RANGE),
        "rate_parse": O._with(st) + f"""
SELECT f.MCMCU, r49.DRSPHD AS RATEIO_BALAO_STR, {O._percent('r49.DRSPHD')} AS RATEIO_BALAO,
       r50.DRSPHD AS RATEIO_MULTIUSO_STR, {O._percent('r50.DRSPHD')} AS RATEIO_MULTIUSO
FROM f0006 f
{O._lookup_join('r49', *cfg.rate_balloons_lookup, 'f.MCRP49')}
{O._lookup_join('r50', *cfg.rate_multiuse_lookup, 'f.MCRP50')}""",
        "gl_exclusion": O._with(st, O.acct_cte()) + "\nSELECT GMAID, CONTA, CONTA_I, CONTA_ESTRUTURA FROM acct",
        "gl_balance": O._with(st, O.acct_cte(), O.gl_balance_cte(PERIOD.months())) + f"\nSELECT {_gl_cols()} FROM glbase",
        "gl_detail": O._with(st, O.acct_cte(OLD_CFG), O.gl_detail_cte(DETAIL.since, OLD_CFG)) + f"\nSELECT {_gl_cols()} FROM glbase",
        "allocation_split": O._with(st, O.acct_cte(), O.gl_balance_cte(PERIOD.months()), O.allocation_cte())
        + "\n" + O.union_sql(["SELECT * FROM glalloc"]),
        "document_tax_lines": _doc_only_sql(O.sales_branches_sql(), ()),
        "difal_left": _doc_only_sql([O.difal_sql()], ()),
        "returns_reversal": _doc_only_sql(O.returns_branches_sql(), ()),
        "tax_code_lines": _doc_only_sql(O.tax_code_sql(), ()),
    }
    ctes, union = _ledger_period_sql(PERIOD)
    out["ledger_union"] = O._with(*ctes) + "\n" + union
    dctes = [st, O.dim_item_cte(OLD_CFG), O.acct_cte(OLD_CFG), O.gl_detail_cte(DETAIL.since, OLD_CFG),
             O.allocation_cte(OLD_CFG), O.doc_cte(DETAIL.jul_from, None, OLD_CFG)]
    dsel = (["SELECT * FROM glalloc"] + O.sales_branches_sql(OLD_CFG) + [O.difal_sql(OLD_CFG)]
            + O.returns_branches_sql(OLD_CFG) + O.tax_code_sql(OLD_CFG))
    out["ledger_detail"] = O._with(*dctes) + "\n" + O.union_sql(dsel)
    out["dre_monthly"] = _dre_sql(PERIOD)
    out["dre_range"] = _dre_sql(RANGE)
    out["dre_midmonth"] = _dre_sql(MIDMONTH)
    out["xml_notas"] = O.notas_sql()
    out["xml_itens"] = O.itens_sql()
    out["xml_quarantine"] = O.quarantine_sql()
    out["csv_roundtrip"] = O.itens_sql("xProd || chr(10) || '\"' || cProd")
    out["csv_zero_rows"] = f"SELECT count(*) AS n_lines FROM ({O.itens_sql()}) WHERE source_file IN ({O.quarantine_sql()})"
    out["xml_folder"] = O.notas_sql()
    out["xml_folder_charsets"] = O.customer_notas_sql()
    out["xml_itens_order"] = O.itens_order_sql()
    tables = " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows FROM {n.lower()}" for n in sorted(ERP_SCHEMAS))
    out["erp_scan"] = O._with(st) + f"""
{tables} UNION ALL
SELECT 'F0901 ' || GMAID || '|' || GMOBJ || '|' || GMDL01 || '|', 1 FROM f0901"""
    out["dre_order"] = f"""
SELECT CONTA, CONTA_I, CONTA_ESTRUTURA, min(position) AS position FROM (
  SELECT *, row_number() OVER (ORDER BY CONTA NULLS LAST, CONTA_I NULLS LAST, CONTA_ESTRUTURA NULLS LAST) AS position
  FROM ({_dre_sql(RANGE)})) GROUP BY 1, 2, 3"""
    return out
