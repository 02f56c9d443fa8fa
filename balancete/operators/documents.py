"""Fiscal-document side of the ledger.

``document_lines`` builds one row per document line that some branch uses:

    lines (type and status filter) ⋈ header (issue-date range)
      ⋈ operation nature, item dimension, company, unit     checked broadcasts

There is one plan for every size. The filters that need only line columns are
applied before any join. The joins between facts (header, tax detail, DIFAL
detail) are plain equi-joins on their full keys: the planner adds the exchanges,
AQE broadcasts a side whose measured size is small and splits a hot document,
and nothing here repartitions or caches. Building the DataFrame runs no job over
the facts; a caller may first count the headers of its range (``few_documents``),
and where they are few the facts are cut to them at their scans.

The source query re-joins the fact in each of its eleven branches; here the fact
is read once and every branch is a column of the same rows: the sales and return
branches come out of one explode of a rule array, DIFAL and PIS/COFINS are joins
on top of the same base. ``plans.ledger.document_ledger``, which feeds all of
them, writes the lines once as Parquet in the shared folder, with only the
columns that its caller wants.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import code_eq, code_in, code_not_in, otrim
from ..functions import sql as Q
from ..plans import rules as R
from ..plans.config import DEFAULT_CONFIG, LedgerConfig
from ..sources.layout import same
from .lookups import (cached_stats, center_hierarchy, checked, companies, item_dimension,
                      materialized, row_width)

_LINE_COLS = ["FDFCO", "FDBNNF", "FDDCT", "FDN001", "FDBSER", "FDUKID", "FDPDCT", "FDNXTR",
              "FDLTTR", "FDBNOP", "FDBSOP", "FDLITM", "FDMCU", "FDCO", "FDGLC",
              "FDAEXP", "FDBIPI", "FDBVIS", "FDBDIZ", "FDBICM"]


def in_key_range(fact: DataFrame, key: str, of: DataFrame, of_key: str) -> DataFrame:
    """Rows of ``fact`` whose ``key`` lies between the least and the largest ``of_key`` of the
    rows it is going to be joined to on that key.

    The bounds are scalar subqueries: they are found when the query runs and reach the Parquet
    scan of ``fact``, which skips row groups outside them. A fact in the order of its document
    numbers is read near the wanted documents only; rows in between are left to the join and to
    the runtime Bloom filter (see ``session.DEFAULT_CONF``).
    """
    bound = lambda f: of.select(f(of_key)).scalar()
    return fact.where((F.col(key) >= bound(F.min)) & (F.col(key) <= bound(F.max)))


def few_documents(of: DataFrame, of_key: str, cfg: LedgerConfig = DEFAULT_CONFIG) -> DataFrame | None:
    """The document numbers of ``of`` for ``in_documents``, or None if they are too many to be
    broadcast. One small job counts the rows, which bounds the numbers."""
    keys = of.select(F.col(of_key).alias("_DOC_NNF"))
    n = keys.agg(F.count("_DOC_NNF")).head()[0]
    return keys.distinct() if n * row_width(keys.schema) <= cfg.broadcast_max_bytes else None


def in_documents(fact: DataFrame, key: str, documents: DataFrame | None) -> DataFrame:
    """Rows of ``fact`` whose ``key`` is among ``documents`` (of ``few_documents``; None: all rows).

    The join that follows would drop the others, but only after they have been built and
    exchanged. As a predicate the test goes down to the scan of ``fact``, below other filters
    and an aggregate by document, where it becomes a broadcast semi join.
    """
    return fact if documents is None else fact.where(F.col(key).isin(F.broadcast(documents)))


def headers(table: DataFrame, issue_from: int, issue_to: int | None) -> DataFrame:
    """Document headers of an issue-date range (inclusive CYYDDD bounds, ``issue_to=None`` is open-ended)."""
    hdr = table.where(F.col("FHISSU") >= issue_from)
    return hdr if issue_to is None else hdr.where(F.col("FHISSU") <= issue_to)


def _join_facts(left: DataFrame, right: DataFrame, keys: list, how: str) -> DataFrame:
    """Join on all ``keys`` (pairs of columns). Two facts in the layout of ``sources.layout``
    are joined on its key, on which they lie together, and the pairs are compared."""
    if "_DOC_K" in left.columns and "_K" in right.columns:
        on = reduce(and_, [same(a, b) for a, b in keys], F.col("_DOC_K") == F.col("_K"))
        return left.join(right, on, how).drop("_K")
    return left.join(right, reduce(and_, [a == b for a, b in keys]), how)


def _fact(doc: DataFrame, tables, name: str) -> tuple[DataFrame, list[str]]:
    """A detail fact for a join with ``doc``, and the names of its layout's key column."""
    if "_DOC_K" in doc.columns and name in tables.layouts:
        return tables.layouts[name], ["_K"]
    return tables[name], []


_ITEM_LABELS = ["ITEM", "LINHA", "TAMANHO", "TIPO", "COR", "EMBALAGEM"]


def document_lines(tables, issue_from: int, issue_to: int | None,
                   cfg: LedgerConfig = DEFAULT_CONFIG, *,
                   classes: tuple = ("sales", "returns"),
                   columns: Collection[str] | None = None,
                   documents: DataFrame | None = None) -> DataFrame:
    """Document lines of any branch, with header, nature, item, company and unit.

    ``issue_from`` / ``issue_to`` are inclusive CYYDDD bounds on the header's
    issue date (``issue_to=None`` is open-ended, as in the older query).
    ``columns`` names the ledger columns that are wanted (None: all).
    ``documents``: the numbers of these headers, if the caller found them few (``few_documents``).
    Adds the class flags _SALES_OK (F1), _RETURNS_OK (F2) and _TC_SALES_OK (F3);
    a line for which none holds is dropped.
    """
    wanted = lambda *names: columns is None or any(n in columns for n in names)
    sales = code_in("FDPDCT", cfg.sales_types)
    returns = code_in("FDPDCT", cfg.return_types)
    sales_ok = (sales & code_not_in("FDNXTR", cfg.sales_excluded_next_status)
                & (F.col("FDLTTR") >= F.lit(cfg.sales_min_last_status)))
    listed = code_in("FDNXTR", cfg.return_next_status)
    parts = ([sales_ok, sales & listed] if "sales" in classes else []) \
        + ([returns & listed] if "returns" in classes else [])
    used = parts[0]
    for part in parts[1:]:
        used = used | part
    types = [*(cfg.sales_types if "sales" in classes else ()), *(cfg.return_types if "returns" in classes else ())]
    # The type test says nothing that ``used`` does not, but its prefixes reach the scan.
    laid_out = {"F7611B", "F7601B"} <= set(tables.layouts)
    line_cols = [*_LINE_COLS, *([F.col("_K").alias("_DOC_K")] if laid_out else [])]
    lines = tables.layouts["F7611B"] if laid_out else tables["F7611B"]
    lines = in_documents(lines, "FDBNNF", documents).where(code_in("FDPDCT", types) & used).select(*line_cols)
    hdr = headers(tables.layouts["F7601B"] if laid_out else tables["F7601B"], issue_from, issue_to)
    hdr = hdr.select("FHFCO", "FHBNNF", "FHDCT", "FHN001", "FHISSU", *(["_K"] if laid_out else []))
    base = _join_facts(lines if laid_out else in_key_range(lines, "FDBNNF", hdr, "FHBNNF"), hdr, [
        (F.col("FDBNNF"), F.col("FHBNNF")), (F.rtrim("FDFCO"), F.rtrim("FHFCO")),
        (F.rtrim("FDDCT"), F.rtrim("FHDCT")), (F.col("FDN001"), F.col("FHN001"))], "inner")

    nature = tables["F76B200"].select(
        F.rtrim("DPBNOP").alias("_N_BNOP"), F.rtrim("DPBSOP").alias("_N_BSOP"),
        F.rtrim("DPFCO").alias("_N_FCO"), F.col("DPBRNOP").alias("CFOP"))
    nstat = cached_stats(tables, "F76B200").get((), (0, 0))
    nature = checked(nature, ["_N_BNOP", "_N_BSOP", "_N_FCO"], nstat, max_bytes=cfg.broadcast_max_bytes,
                     unique=cfg.require_unique_masters, name="F76B200", dedupe=False)
    base = base.join(nature, (F.rtrim("FDBNOP") == F.col("_N_BNOP"))
                     & (F.rtrim("FDBSOP") == F.col("_N_BSOP"))
                     & (F.rtrim("FDFCO") == F.col("_N_FCO")), "inner")

    # At most one row per item (its lookups are unique): the item master's
    # own check bounds it.
    istat = cached_stats(tables, "F4101").get((), (0, 0))
    build = lambda: item_dimension(
        tables, cfg, filter_lines=True, dedupe=not cfg.materialize_dimensions).withColumn(
        "_I_KEY", F.rtrim("IMLITM"))
    items = materialized(tables, ("items", cfg), build) if cfg.materialize_dimensions else build()
    items = checked(items, ["_I_KEY"], istat, max_bytes=cfg.broadcast_max_bytes,
                    unique=cfg.require_unique_masters, name="item dimension",
                    dedupe=not cfg.materialize_dimensions)
    base = base.join(items, F.rtrim("FDLITM") == F.col("_I_KEY"), "inner")

    base = base.join(companies(tables, cfg), F.rtrim("FDCO") == F.col("_C_CCCO"), "inner")
    if wanted("CENTRO_CUSTO"):
        base = center_hierarchy(base, tables, "FDMCU", cfg, with_parent=False)

    cfop_ok = ~F.col("CFOP").isin(list(cfg.excluded_cfop))
    plant = F.when(code_eq("IMSRP1", cfg.plant_item_line), F.lit(cfg.plant_label_special)) \
        .otherwise(F.lit(cfg.plant_label_default))
    flags = {"_SALES_OK": sales_ok, "_RETURNS_OK": returns & listed & cfop_ok,
             "_TC_SALES_OK": sales & listed & cfop_ok}
    labels = [c for c in _ITEM_LABELS if wanted(c)]
    if wanted("CENTRO_CUSTO"):
        labels.append("CENTRO_CUSTO")
    if wanted("EMPRESA"):
        labels.append("CCNAME")
    if wanted("FILIAL"):
        labels.append(otrim(plant).alias("FILIAL"))
    out = base.select(*_LINE_COLS, *(["_DOC_K"] if laid_out else []), "FHISSU", "CFOP", *labels,
                      *[F.coalesce(ok, F.lit(False)).alias(n) for n, ok in flags.items()])
    return out.where("_SALES_OK OR _RETURNS_OK OR _TC_SALES_OK")


# Ledger columns every document branch fills the same way (SQL text).
_COMMON = {
    "DATA_LANCAMENTO": Q.decode_cyyddd("FHISSU"),
    "TIPO_DOCUMENTO": "FDPDCT",
    "NUM_DOCUMENTO": "CAST(FDDCT AS STRING)",
    "CHAVE_CONTA": "CAST(NULL AS STRING)",
    "ORDEM_CONTA": "CAST(NULL AS STRING)",
    "CENTRO_CUSTO": "CENTRO_CUSTO",
    "PERCENTUAL": f"CAST(0 AS {Q.PERCENT})",
    "EMPRESA": Q.ocat("FDCO", Q.lit(" - "), "CCNAME"),
    "FILIAL": "FILIAL", "CFOP": "CFOP", "NOTA": "FDBNNF",
    **{c: c for c in _ITEM_LABELS},
}


def _common(columns: Collection[str] | None) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in _COMMON.items() if columns is None or name in columns]


def _amounts() -> dict[str, str]:
    aexp, bipi = Q.amount("FDAEXP"), Q.amount("FDBIPI")
    bvis, bdiz, bicm = Q.amount("FDBVIS"), Q.amount("FDBDIZ"), Q.amount("FDBICM")
    total = f"({aexp} + {bipi} + {bvis} - {bdiz})"
    return {"neg_total": f"-{total}", "pos_total": total, "ipi": bipi, "neg_ipi": f"-{bipi}",
            "st": bvis, "neg_st": f"-{bvis}", "icms": bicm, "neg_icms": f"-{bicm}"}


def _label_struct(keep: str, branch: str, qi: int, amount: str, labels: dict) -> str:
    fields = [f"'keep', {keep}", f"'BRANCH', {Q.lit(branch)}", f"'QUERY_INFO', {qi}",
              f"'VALOR_TRANSACAO', CAST({amount} AS {Q.MONEY})"]
    fields += [f"'{f}', CAST({labels[f]} AS STRING)" for f in R.LABEL_FIELDS]
    fields.append("'EXPLICACAO', CAST(NULL AS STRING)")
    return f"named_struct({', '.join(fields)})"


def document_branches(doc: DataFrame, cfg: LedgerConfig = DEFAULT_CONFIG, *,
                      classes: tuple = ("sales", "returns"),
                      columns: Collection[str] | None = None) -> DataFrame:
    """C4 (without DIFAL) and C5: up to eight ledger lines per document line.

    Sales: gross revenue (export variant for 'SX'), IPI, ICMS-ST (only where
    the ST value is non-zero), ICMS. Returns: total, IPI, ICMS, ICMS-ST.
    The rule array and the explode are one SQL projection.
    """
    amt = _amounts()
    opts = []
    if "sales" in classes:
        export = Q.code_eq("FDPDCT", cfg.export_type)
        for branch, qi, formula, nonzero_st, labels in R.SALES_RULES:
            if labels is None:
                lab = {f: f"CASE WHEN {export} THEN {Q.lit(e)} ELSE {Q.lit(d)} END"
                       for f, d, e in zip(R.LABEL_FIELDS, R.GROSS_REVENUE_DOMESTIC, R.GROSS_REVENUE_EXPORT)}
            else:
                lab = {f: Q.lit(v) for f, v in zip(R.LABEL_FIELDS, labels)}
            keep = "(_SALES_OK AND coalesce(FDBVIS <> 0, false))" if nonzero_st else "_SALES_OK"
            opts.append(_label_struct(keep, branch, qi, amt[formula], lab))
    if "returns" in classes:
        for branch, qi, formula, c2, est, desc, full in R.RETURN_RULES:
            lab = {f: Q.lit(v) for f, v in zip(R.LABEL_FIELDS, (c2, est, desc, R.ABATEMENTS,
                                                               cfg.returns_subgroup_label, full))}
            opts.append(_label_struct("_RETURNS_OK", branch, qi, amt[formula], lab))
    cond = {("sales", "returns"): "_SALES_OK OR _RETURNS_OK", ("sales",): "_SALES_OK",
            ("returns",): "_RETURNS_OK"}[tuple(classes)]
    arr = f"filter(array({', '.join(opts)}), o -> o.keep)"
    out = doc.where(cond).selectExpr(*_common(columns), f"explode({arr}) AS _b")
    return out.selectExpr(*[c for c in out.columns if c != "_b"], *[f"_b.{f} AS {f}" for f in
                                            ("VALOR_TRANSACAO", *R.LABEL_FIELDS, "EXPLICACAO",
                                             "QUERY_INFO", "BRANCH")])


def difal_lines(doc: DataFrame, tables, cfg: LedgerConfig = DEFAULT_CONFIG, *,
                columns: Collection[str] | None = None, written: bool = False,
                documents: DataFrame | None = None) -> DataFrame:
    """C4's DIFAL branch: sales lines left-joined to the DIFAL detail.

    An unmatched line keeps a NULL amount; a duplicated detail row multiplies
    only this branch, exactly as in the source. ``written``: ``doc`` is a stored table, so
    its key range is cheap to find and limits the scan of the detail. ``documents``: its
    document numbers, if the caller found them few (``few_documents``).
    """
    branch, qi, c2, est, desc, conta, conta_i, full, expl = R.DIFAL_RULE
    d, key = _fact(doc, tables, "F5576007")
    d = in_documents(d, "DFBNNF", documents)
    if written and not key:
        d = in_key_range(d, "DFBNNF", doc, "FDBNNF")
    d = d.select(
        F.col("DFBNNF"), F.rtrim("DFDCT").alias("_D_DCT"), F.col("DFN001"),
        F.rtrim("DFBSER").alias("_D_BSER"), F.col("DFUKID"), "DFBICM", *key)
    j = _join_facts(doc.where(F.col("_SALES_OK")), d, [
        (F.col("FDBNNF"), F.col("DFBNNF")), (F.rtrim("FDDCT"), F.col("_D_DCT")), (F.col("FDN001"), F.col("DFN001")),
        (F.rtrim("FDBSER"), F.col("_D_BSER")), (F.col("FDUKID"), F.col("DFUKID"))], "left")
    return j.selectExpr(
        *_common(columns),
        f"CAST({Q.amount('DFBICM')} AS {Q.MONEY}) AS VALOR_TRANSACAO",
        f"{Q.lit(c2)} AS CONTA_II", f"{Q.lit(est)} AS CONTA_ESTRUTURA",
        f"{Q.lit(desc)} AS DESCRICAO_CONTA_II", f"{Q.lit(conta)} AS CONTA",
        f"{Q.lit(conta_i)} AS CONTA_I", f"{Q.lit(full)} AS CONTA_COMPLETA",
        f"{Q.fit(Q.ocat(Q.lit(expl), 'FDBNNF'), 30)} AS EXPLICACAO",
        f"{qi} AS QUERY_INFO", f"{Q.lit(branch)} AS BRANCH")


def tax_code_lines(doc: DataFrame, tables, cfg: LedgerConfig = DEFAULT_CONFIG, *,
                   classes: tuple = ("sales", "returns"),
                   columns: Collection[str] | None = None, written: bool = False,
                   documents: DataFrame | None = None) -> DataFrame:
    """PIS (code 05) and COFINS (code 06) for sales (+) and returns (-).

    One inner join of the document lines with the per-line tax detail (J10);
    the sign and the labels come from the rule table by (class, code). ``written`` and
    ``documents`` as in ``difal_lines``.
    """
    td, key = _fact(doc, tables, "F76B011")
    td = in_documents(td, "TDBNNF", documents).where(code_in("TDBRTX", [cfg.tax_code_pis, cfg.tax_code_cofins]))
    if written and not key:
        td = in_key_range(td, "TDBNNF", doc, "FDBNNF")
    td = td.select(
        F.col("TDBNNF"), F.rtrim("TDBSER").alias("_T_BSER"), F.rtrim("TDDCT").alias("_T_DCT"),
        F.col("TDN001"), F.col("TDUKID"), F.rtrim("TDBRTX").alias("_T_CODE"), "TDBRTXA", *key)
    keep = None
    if "sales" in classes:
        keep = F.col("_TC_SALES_OK")
    if "returns" in classes:
        keep = F.col("_RETURNS_OK") if keep is None else keep | F.col("_RETURNS_OK")
    j = _join_facts(doc.where(keep), td, [
        (F.col("FDBNNF"), F.col("TDBNNF")), (F.rtrim("FDBSER"), F.col("_T_BSER")), (F.rtrim("FDDCT"), F.col("_T_DCT")),
        (F.col("FDN001"), F.col("TDN001")), (F.col("FDUKID"), F.col("TDUKID"))], "inner")
    codes = {"05": cfg.tax_code_pis, "06": cfg.tax_code_cofins}

    def pick(value) -> str:
        """CASE over the rule rows by (document class, tax code)."""
        whens = []
        for rule in R.TAX_CODE_RULES:
            cls = "_RETURNS_OK" if rule[1] == "returns" else "NOT _RETURNS_OK"
            whens.append(f"WHEN {cls} AND _T_CODE = {Q.lit(codes[rule[2]])} THEN {value(rule)}")
        return "CASE " + " ".join(whens) + " END"

    amount = Q.amount("TDBRTXA")
    return j.selectExpr(
        *_common(columns),
        f"CAST({pick(lambda r: amount if r[4] > 0 else f'-{amount}')} AS {Q.MONEY}) AS VALOR_TRANSACAO",
        f"{pick(lambda r: Q.lit(r[5]))} AS CONTA_II",
        f"{pick(lambda r: Q.lit(r[6]))} AS CONTA_ESTRUTURA",
        f"{pick(lambda r: Q.lit(r[7]))} AS DESCRICAO_CONTA_II",
        f"{Q.lit(R.ABATEMENTS)} AS CONTA",
        f"{pick(lambda r: Q.lit(r[8] if r[8] is not None else cfg.returns_subgroup_label))} AS CONTA_I",
        f"{pick(lambda r: Q.lit(r[9]))} AS CONTA_COMPLETA",
        f"{pick(lambda r: Q.lit(None) if r[10] is None else Q.fit(Q.ocat(Q.lit(r[10]), 'FDBNNF', 'FDGLC'), 30))} AS EXPLICACAO",
        f"{pick(lambda r: str(r[3]))} AS QUERY_INFO",
        f"{pick(lambda r: Q.lit(r[0]))} AS BRANCH")
