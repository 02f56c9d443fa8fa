"""DuckDB oracle SQL for the correctness gate.

Each query of ``__spark_entry__.queries()`` has an independent DuckDB
formulation here, run on the same driver tables (registered as views).
The ERP stand-ins are re-derived in SQL (same mapping as
``sources.standins``), and the ledger is written the *naive* way: one SELECT
per branch, glued with UNION ALL, lookups as left joins, allocation as a
three-branch union. The Spark build computes the same rows with one fact
scan and explodes, so a match checks the consolidation as well.

DuckDB, like Spark, keeps '' distinct from NULL; the source dialect's rules
are spelled out with NULLIF(TRIM(..),'') and concat() (which skips NULLs).
"""

from __future__ import annotations

import datetime as _dt

from .functions.dates import encode_date
from .plans.config import DEFAULT_CONFIG
from .plans import rules as R
from .sources import standins as S

# ---------------------------------------------------------------- helpers


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values) + ")"


def _otrim(x: str) -> str:
    return f"NULLIF(TRIM({x}), '')"


def _case_idx(expr: str, values: list) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {i} THEN {_q(v)}" for i, v in enumerate(values)) + " END"


def _decode(x: str) -> str:
    return f"(make_date(1900 + CAST({x} // 1000 AS INTEGER), 1, 1) + CAST({x} % 1000 - 1 AS INTEGER))"


def _encode(x: str) -> str:
    return f"CAST((year({x}) - 1900) * 1000 + dayofyear({x}) AS INTEGER)"


def _cents(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) * 100 AS DECIMAL(20,0))"


def _percent(x: str) -> str:
    return (f"CASE WHEN regexp_full_match(COALESCE({_otrim(x)}, 'x'), '[0-9]+([.,][0-9]+)?%?') "
            f"THEN TRY_CAST(replace(replace(TRIM({x}), '%', ''), ',', '.') AS DECIMAL(38,12)) END")


def _amt(x: str) -> str:
    return f"CAST({x} * 0.01 AS DECIMAL(20,2))"


# ---------------------------------------------------------------- stand-ins

def standin_ctes() -> str:
    """WITH-list items defining the twelve ERP tables from the driver views."""
    codes = ", ".join(
        f"({_q(sy)}, {_q(rt)}, {_q(k)}, {_q(d)}, {'NULL' if sp is None else _q(sp)})"
        for sy, rt, k, d, sp in S.ACCOUNT_GROUP_ROWS)
    item_types = ", ".join(f"({_q(rt)}, {_q(nm)})"
                           for rt, nm in zip(S.ITEM_CATEGORY_TYPES, S.ITEM_CATEGORY_NAMES))
    nature = ", ".join(f"({_q(a)}, {_q(b)}, {_q(c)}, {d})" for a, b, c, d in S.NATURE_ROWS)
    taxes = ", ".join(f"({_q(c)}, {s})" for c, s in S.TAX_CODE_SHARES)
    obj = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '311210' WHEN 'BUILDING' THEN '410100' "
           "WHEN 'FURNITURE' THEN '510120' WHEN 'HOUSEHOLD' THEN '320100' ELSE '610300' END")
    sub = "lpad(CAST(c_nationkey % 5 AS VARCHAR), 3, '0')"
    signed = (f"CASE WHEN o_orderstatus = 'F' THEN -{_cents('o_totalprice')} "
              f"ELSE {_cents('o_totalprice')} END")
    months = ",\n        ".join(
        f"CAST(SUM(CASE WHEN month(o_orderdate) = {m} THEN sc END) AS DECIMAL(20,0)) AS GBAN{m:02d}"
        for m in range(1, 13))
    doc_type = (f"CASE WHEN rf = 'R' THEN (CASE WHEN ls = 'F' THEN 'VX' ELSE 'VR' END) "
                f"WHEN rf = 'A' AND ls = 'F' THEN 'SX' ELSE {_case_idx('FDBNNF % 9', S._SALES_TYPE_BY_MOD9)} END")
    return f"""
f0010 AS (SELECT '0000' || CAST(r_regionkey AS VARCHAR) AS CCCO, r_name AS CCNAME FROM region),
f0006 AS (
    SELECT lpad(CAST(s_suppkey AS VARCHAR), 12, ' ') AS MCMCU, s_name AS MCDL01,
           CASE WHEN s_suppkey % 10 = 0 THEN '   ' ELSE CAST(s_suppkey - s_suppkey % 10 AS VARCHAR) END AS MCRP04,
           rpad(CAST(s_nationkey % 10 AS VARCHAR), 3, ' ') AS MCRP49,
           rpad(CAST(s_nationkey % 5 AS VARCHAR), 3, ' ') AS MCRP50
    FROM supplier),
f0005 AS (
    SELECT DRSY, DRRT, rpad(k, 10, ' ') AS DRKY, rpad(d, 30, ' ') AS DRDL01, DRSPHD
    FROM (VALUES {codes}) v(DRSY, DRRT, k, d, DRSPHD)
    UNION ALL
    SELECT '41', t.rt, rpad(CAST(n_nationkey AS VARCHAR), 10, ' '), rpad(t.nm || ' ' || n_name, 30, ' '), NULL
    FROM nation CROSS JOIN (VALUES {item_types}) t(rt, nm)),
f4101 AS (
    SELECT CAST(p_partkey AS VARCHAR) AS IMLITM,
           rpad(CASE WHEN p_size % 7 = 6 THEN 'L' ELSE CAST(p_size % 7 AS VARCHAR) END, 3, ' ') AS IMSRP1,
           CASE WHEN p_size % 9 = 0 THEN '   ' ELSE rpad(CAST(p_size % 30 AS VARCHAR), 3, ' ') END AS IMSRP2,
           CAST(length(p_type) % 25 AS VARCHAR) AS IMSRP3,
           CAST(length(p_name) % 27 AS VARCHAR) AS IMSRP4,
           CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(length(p_brand) * 3 % 25 AS VARCHAR) END AS IMSRP5
    FROM part),
f0901 AS (
    SELECT CAST(c_custkey AS VARCHAR) AS GMAID,
           CASE WHEN c_custkey % 50 = 7 THEN '   ' ELSE '100.' || {obj} || '.' || {sub} END AS GMANI,
           CASE WHEN c_custkey % 50 = 7 THEN '      ' ELSE rpad({obj}, 6, ' ') END AS GMOBJ,
           CASE WHEN c_custkey % 50 = 7 THEN '        ' ELSE rpad({sub}, 8, ' ') END AS GMSUB,
           rpad(c_name, 30, ' ') AS GMDL01,
           '0000' || CAST(c_nationkey % 6 AS VARCHAR) AS GMCO,
           lpad(CAST(c_custkey % 120 AS VARCHAR), 12, ' ') AS GMMCU,
           CAST(c_nationkey % 6 AS VARCHAR) AS GMR009,
           CAST(c_custkey % 5 AS VARCHAR) AS GMR010
    FROM customer),
f0902 AS (
    SELECT CAST(o_custkey AS VARCHAR) AS GBAID,
           CASE WHEN o_orderstatus = 'P' THEN 'BA  ' ELSE 'AA  ' END AS GBLT,
           CAST(year(o_orderdate) - 1900 AS INTEGER) AS GBFY,
        {months},
        CAST(NULL AS DECIMAL(20,0)) AS GBAN13, CAST(NULL AS DECIMAL(20,0)) AS GBAN14
    FROM (SELECT *, {signed} AS sc FROM orders)
    GROUP BY 1, 2, 3),
f0911 AS (
    SELECT CAST(o_custkey AS VARCHAR) AS GLAID, {_encode('o_orderdate')} AS GLDGJ, 'JE' AS GLDCT,
           o_orderkey AS GLDOC, {signed} AS GLAA, '100.' || CAST(o_custkey AS VARCHAR) AS GLANI,
           concat_ws(' ', 'PEDIDO', o_orderpriority, 'NUM', CAST(o_orderkey AS VARCHAR)) AS GLEXA,
           'AA  ' AS GLLT, CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE 'P' END AS GLPOST
    FROM orders),
f7601b AS (
    SELECT {_q(S.FISCAL_COMPANY)} AS FHFCO, o_orderkey AS FHBNNF, {_q(S.DOC_TYPE)} AS FHDCT,
           CAST({S.DOC_SUFFIX} AS BIGINT) AS FHN001, {_encode('o_orderdate')} AS FHISSU
    FROM orders),
li_agg AS (
    SELECT l_orderkey AS FDBNNF, CAST(l_linenumber AS BIGINT) AS FDUKID,
           max(l_returnflag) AS rf, max(l_linestatus) AS ls, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey,
           CAST(sum(ext) AS DECIMAL(20,0)) AS FDAEXP,
           CAST(sum(round(ext * tax * 0.5, 0)) AS DECIMAL(20,0)) AS FDBIPI,
           CAST(sum(CASE WHEN tax >= 0.06 THEN round(ext * tax * 0.25, 0) WHEN tax >= 0.02 THEN 0 END) AS DECIMAL(20,0)) AS FDBVIS,
           CAST(sum(round(ext * disc, 0)) AS DECIMAL(20,0)) AS FDBDIZ,
           CAST(sum(round(ext * tax, 0)) AS DECIMAL(20,0)) AS FDBICM
    FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS ext, CAST(l_tax AS DECIMAL(4,2)) AS tax,
                 CAST(l_discount AS DECIMAL(4,2)) AS disc FROM lineitem)
    GROUP BY 1, 2),
f7611b AS (
    SELECT {_q(S.FISCAL_COMPANY)} AS FDFCO, FDBNNF, {_q(S.DOC_TYPE)} AS FDDCT, CAST({S.DOC_SUFFIX} AS BIGINT) AS FDN001,
           {_q(S.DOC_SERIES)} AS FDBSER, FDUKID, {doc_type} AS FDPDCT,
           {_case_idx('FDBNNF % 7', S._NEXT_STATUS_BY_MOD7)} AS FDNXTR,
           {_case_idx('FDUKID % 4', S._LAST_STATUS_BY_MOD4)} AS FDLTTR,
           rf AS FDBNOP, ls AS FDBSOP, CAST(partkey AS VARCHAR) AS FDLITM,
           lpad(CAST(suppkey AS VARCHAR), 12, ' ') AS FDMCU, '0000' || CAST(FDBNNF % 6 AS VARCHAR) AS FDCO,
           rpad('C' || rf, 4, ' ') AS FDGLC, FDAEXP, FDBIPI, FDBVIS, FDBDIZ, FDBICM
    FROM li_agg),
f76b011 AS (
    SELECT FDBNNF AS TDBNNF, FDBSER AS TDBSER, FDDCT AS TDDCT, FDN001 AS TDN001, FDUKID AS TDUKID,
           c.code AS TDBRTX, CAST(round(FDAEXP * c.share, 0) AS DECIMAL(20,0)) AS TDBRTXA
    FROM f7611b CROSS JOIN (VALUES {taxes}) c(code, share)),
f5576007 AS (
    SELECT FDBNNF AS DFBNNF, FDDCT AS DFDCT, FDN001 AS DFN001, FDBSER AS DFBSER, FDUKID AS DFUKID,
           CAST(round(FDAEXP * {S.DIFAL_SHARE}, 0) AS DECIMAL(20,0)) AS DFBICM
    FROM f7611b WHERE FDUKID % 2 = 0),
f76b200 AS (SELECT * FROM (VALUES {nature}) v(DPBNOP, DPBSOP, DPFCO, DPBRNOP))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts if p.strip())


# ---------------------------------------------------------------- dimensions

def _lookup_join(alias: str, sy: str, rt: str, key: str) -> str:
    return (f"LEFT JOIN f0005 {alias} ON rtrim({alias}.DRSY) = {_q(sy)} AND rtrim({alias}.DRRT) = {_q(rt)} "
            f"AND {_otrim(alias + '.DRKY')} = {_otrim(key)}")


def dim_item_cte(cfg=DEFAULT_CONFIG, filtered: bool = True) -> str:
    names = ["LINHA", "TAMANHO", "TIPO", "COR", "EMBALAGEM"]
    joins = "\n    ".join(_lookup_join(f"s{k}", cfg.item_category_system, rt, f"i.IMSRP{k}")
                          for k, rt in enumerate(cfg.item_category_types, start=1))
    cols = ", ".join(f"substring({_otrim(f's{k}.DRDL01')}, 1, 30) AS {nm}"
                     for k, nm in enumerate(names, start=1))
    where = f"WHERE rtrim(i.IMSRP1) IN {_in(cfg.item_line_codes)}" if filtered else ""
    return f"""dim_item AS (
    SELECT i.IMLITM, i.IMSRP1, substring(i.IMLITM, 1, 25) AS ITEM, {cols}
    FROM f4101 i
    {joins}
    {where})"""


def acct_cte(cfg=DEFAULT_CONFIG, excluded: bool = True) -> str:
    g_sy, g_rt = cfg.account_group_lookup
    s_sy, s_rt = cfg.account_subgroup_lookup
    b_sy, b_rt = cfg.rate_balloons_lookup
    m_sy, m_rt = cfg.rate_multiuse_lookup
    where = ""
    if excluded:
        sent = _q(cfg.exclusion_sentinel)
        subgroup_test = (f"COALESCE({_otrim('e.DRDL01')}, {sent}) <> {_q(cfg.gl_excluded_subgroups[0])}"
                         if len(cfg.gl_excluded_subgroups) == 1 else
                         f"COALESCE({_otrim('e.DRDL01')}, {sent}) NOT IN {_in(cfg.gl_excluded_subgroups)}")
        where = f"""WHERE COALESCE({_otrim('d.DRDL01')}, {sent}) NOT IN {_in(cfg.gl_excluded_groups)}
      AND {subgroup_test}
      AND {_otrim('concat(a.GMOBJ, a.GMSUB)')} NOT IN {_in(cfg.gl_excluded_structures)}"""
    return f"""acct AS (
    SELECT a.GMAID, a.GMANI, a.GMSUB,
           {_otrim('concat(a.GMOBJ, a.GMSUB)')} AS CONTA_ESTRUTURA,
           {_otrim('a.GMDL01')} AS DESCRICAO_CONTA_II,
           d.DRDL01 AS CONTA,
           {_otrim('e.DRDL01')} AS CONTA_I,
           NULLIF(concat(a.GMOBJ, a.GMSUB, ' ', a.GMDL01), '') AS CONTA_COMPLETA,
           concat(f.MCMCU, ' ', f.MCDL01) AS CENTRO_CUSTO,
           NULLIF(concat(a.GMCO, ' - ', g.CCNAME), '') AS EMPRESA,
           {_otrim("concat(b.MCMCU, ' ', b.MCDL01)")} AS FILIAL,
           r49.DRSPHD AS RATEIO_BALAO_STR, r50.DRSPHD AS RATEIO_MULTIUSO_STR,
           {_percent('r49.DRSPHD')} AS RATEIO_BALAO,
           {_percent('r50.DRSPHD')} AS RATEIO_MULTIUSO
    FROM f0901 a
    {_lookup_join('d', g_sy, g_rt, 'a.GMR009')}
    {_lookup_join('e', s_sy, s_rt, 'a.GMR010')}
    LEFT JOIN f0006 f ON rtrim(f.MCMCU) = rtrim(a.GMMCU)
    {_lookup_join('r49', b_sy, b_rt, 'f.MCRP49')}
    {_lookup_join('r50', m_sy, m_rt, 'f.MCRP50')}
    JOIN f0010 g ON rtrim(g.CCCO) = rtrim(a.GMCO)
    LEFT JOIN f0006 b ON {_otrim('f.MCRP04')} = {_otrim('b.MCMCU')}
    {where})"""


# ---------------------------------------------------------------- GL side

GL_CONST = ("CAST(NULL AS INTEGER) AS CFOP, CAST(NULL AS BIGINT) AS NOTA, ' ' AS ITEM, ' ' AS TAMANHO, "
            "' ' AS TIPO, ' ' AS COR, ' ' AS EMBALAGEM")
DIM_COLS = ("a.CONTA_ESTRUTURA, a.DESCRICAO_CONTA_II, a.CONTA, a.CONTA_I, a.CONTA_COMPLETA, "
            "a.CENTRO_CUSTO, a.EMPRESA, a.FILIAL, a.RATEIO_BALAO, a.RATEIO_MULTIUSO")


def gl_balance_cte(months: list[tuple[int, int]], cfg=DEFAULT_CONFIG, start: _dt.date | None = None) -> str:
    """Period balances (P7 as a CASE pick per month) joined to the account dimension."""
    picks = []
    for y, m in months:
        fy = y - 1900
        pick = "CASE " + " ".join(f"WHEN {m} = {p} THEN COALESCE(GBAN{p:02d}, 0)" for p in range(1, 15)) + " ELSE 0 END"
        day = max(_dt.date(y, m, 1), start or _dt.date.min)
        picks.append(f"SELECT GBAID, DATE '{day.isoformat()}' AS DATA_LANCAMENTO, {pick} AS VALOR_PERIODO "
                     f"FROM f0902 WHERE rtrim(GBLT) = {_q(cfg.ledger_type)} AND GBFY = {fy}")
    return f"""bal AS (
    {chr(10).join(("UNION ALL " if i else "") + p for i, p in enumerate(picks))}),
glbase AS (
    SELECT c.DATA_LANCAMENTO, {_q(cfg.balance_doc_type)} AS TIPO_DOCUMENTO,
           {_q(cfg.balance_doc_number)} AS NUM_DOCUMENTO, {_amt('c.VALOR_PERIODO')} AS VALOR_TRANSACAO,
           {_otrim('a.GMANI')} AS CONTA_II, substring({_q(cfg.balance_explanation)}, 1, 30) AS EXPLICACAO,
           c.GBAID AS CHAVE_CONTA, a.GMSUB AS ORDEM_CONTA, {DIM_COLS}, {GL_CONST},
           {cfg.gl_query_info} AS QUERY_INFO
    FROM acct a JOIN bal c ON a.GMAID = c.GBAID
    WHERE abs(c.VALOR_PERIODO) > 0)"""


def gl_detail_cte(since: _dt.date, cfg=DEFAULT_CONFIG) -> str:
    return f"""glbase AS (
    SELECT {_decode('c.GLDGJ')} AS DATA_LANCAMENTO, c.GLDCT AS TIPO_DOCUMENTO,
           CAST(c.GLDOC AS VARCHAR) AS NUM_DOCUMENTO, {_amt('c.GLAA')} AS VALOR_TRANSACAO,
           {_otrim('c.GLANI')} AS CONTA_II, substring(c.GLEXA, 1, 30) AS EXPLICACAO,
           c.GLAID AS CHAVE_CONTA, a.GMSUB AS ORDEM_CONTA, {DIM_COLS}, {GL_CONST},
           {cfg.gl_query_info} AS QUERY_INFO
    FROM acct a JOIN f0911 c ON a.GMAID = c.GLAID
    WHERE rtrim(c.GLLT) = {_q(cfg.ledger_type)} AND rtrim(c.GLPOST) = {_q(cfg.posted_flag)}
      AND c.GLDGJ >= {encode_date(since)})"""


LEDGER_COLS = ["DATA_LANCAMENTO", "TIPO_DOCUMENTO", "NUM_DOCUMENTO", "VALOR_TRANSACAO", "CONTA_II",
               "CONTA_ESTRUTURA", "DESCRICAO_CONTA_II", "EXPLICACAO", "CHAVE_CONTA", "CONTA", "CONTA_I",
               "ORDEM_CONTA", "CONTA_COMPLETA", "CENTRO_CUSTO", "PERCENTUAL", "EMPRESA", "FILIAL", "CFOP",
               "NOTA", "ITEM", "LINHA", "TAMANHO", "TIPO", "COR", "EMBALAGEM", "QUERY_INFO", "BRANCH"]


def allocation_cte(cfg=DEFAULT_CONFIG) -> str:
    """C3 as the naive three-branch union."""
    plain, balloons, multi = cfg.allocation_labels
    rest = ("DATA_LANCAMENTO, TIPO_DOCUMENTO, NUM_DOCUMENTO, CONTA_II, CONTA_ESTRUTURA, DESCRICAO_CONTA_II, "
            "EXPLICACAO, CHAVE_CONTA, CONTA, CONTA_I, ORDEM_CONTA, CONTA_COMPLETA, CENTRO_CUSTO, EMPRESA, "
            "FILIAL, CFOP, NOTA, ITEM, TAMANHO, TIPO, COR, EMBALAGEM, QUERY_INFO")
    return f"""glalloc AS (
    SELECT {rest}, CAST(VALOR_TRANSACAO AS DECIMAL(38,4)) AS VALOR_TRANSACAO,
           CAST(NULL AS DECIMAL(10,4)) AS PERCENTUAL, {_q(plain)} AS LINHA, 'GL' AS BRANCH
    FROM glbase WHERE RATEIO_BALAO IS NULL
    UNION ALL
    SELECT {rest}, CAST(round(VALOR_TRANSACAO * RATEIO_BALAO * 0.01, 4) AS DECIMAL(38,4)),
           TRY_CAST(RATEIO_BALAO AS DECIMAL(10,4)), {_q(balloons)}, 'GL_BALOES'
    FROM glbase WHERE RATEIO_BALAO IS NOT NULL
    UNION ALL
    SELECT {rest}, CAST(round(VALOR_TRANSACAO * RATEIO_MULTIUSO * 0.01, 4) AS DECIMAL(38,4)),
           TRY_CAST(RATEIO_MULTIUSO AS DECIMAL(10,4)), {_q(multi)}, 'GL_MULTIUSO'
    FROM glbase WHERE RATEIO_BALAO IS NOT NULL AND RATEIO_MULTIUSO IS NOT NULL)"""


# ---------------------------------------------------------------- document side

def doc_cte(issue_from: int, issue_to: int | None, cfg=DEFAULT_CONFIG) -> str:
    upper = f"AND h.FHISSU <= {issue_to}" if issue_to is not None else ""
    return f"""doc AS (
    SELECT a.*, h.FHISSU, n.DPBRNOP AS CFOP, it.IMSRP1, it.ITEM, it.LINHA, it.TAMANHO, it.TIPO, it.COR,
           it.EMBALAGEM, e.CCNAME, concat(u.MCMCU, ' ', u.MCDL01) AS CENTRO_CUSTO
    FROM f7611b a
    JOIN f7601b h ON rtrim(h.FHFCO) = rtrim(a.FDFCO) AND h.FHBNNF = a.FDBNNF
                 AND rtrim(a.FDDCT) = rtrim(h.FHDCT) AND a.FDN001 = h.FHN001
    JOIN f76b200 n ON rtrim(n.DPBNOP) = rtrim(a.FDBNOP) AND rtrim(n.DPBSOP) = rtrim(a.FDBSOP)
                  AND rtrim(n.DPFCO) = rtrim(a.FDFCO)
    JOIN dim_item it ON rtrim(it.IMLITM) = rtrim(a.FDLITM)
    LEFT JOIN f0006 u ON rtrim(u.MCMCU) = rtrim(a.FDMCU)
    JOIN f0010 e ON rtrim(e.CCCO) = rtrim(a.FDCO)
    WHERE h.FHISSU >= {issue_from} {upper})"""


def _doc_common(cfg=DEFAULT_CONFIG) -> str:
    plant = (f"CASE WHEN rtrim(IMSRP1) = {_q(cfg.plant_item_line)} THEN {_q(cfg.plant_label_special)} "
             f"ELSE {_q(cfg.plant_label_default)} END")
    return (f"{_decode('FHISSU')} AS DATA_LANCAMENTO, FDPDCT AS TIPO_DOCUMENTO, FDDCT AS NUM_DOCUMENTO, "
            f"CAST(NULL AS VARCHAR) AS CHAVE_CONTA, CAST(NULL AS VARCHAR) AS ORDEM_CONTA, CENTRO_CUSTO, "
            f"CAST(0 AS DECIMAL(10,4)) AS PERCENTUAL, NULLIF(concat(FDCO, ' - ', CCNAME), '') AS EMPRESA, "
            f"{_otrim(plant)} AS FILIAL, CFOP, FDBNNF AS NOTA, ITEM, LINHA, TAMANHO, TIPO, COR, EMBALAGEM")


def _sales_where(cfg=DEFAULT_CONFIG) -> str:
    return (f"rtrim(FDPDCT) IN {_in(cfg.sales_types)} AND rtrim(FDNXTR) NOT IN {_in(cfg.sales_excluded_next_status)} "
            f"AND FDLTTR >= {_q(cfg.sales_min_last_status)}")


def _returns_where(cfg=DEFAULT_CONFIG) -> str:
    return (f"rtrim(FDPDCT) IN {_in(cfg.return_types)} AND rtrim(FDNXTR) IN {_in(cfg.return_next_status)} "
            f"AND CFOP NOT IN {_in(cfg.excluded_cfop)}")


def _labels(c2, est, desc, conta, conta_i, full, expl="CAST(NULL AS VARCHAR)") -> str:
    return (f"{c2} AS CONTA_II, {est} AS CONTA_ESTRUTURA, {desc} AS DESCRICAO_CONTA_II, {conta} AS CONTA, "
            f"{conta_i} AS CONTA_I, {full} AS CONTA_COMPLETA, {expl} AS EXPLICACAO")


_AEXP, _BIPI, _BVIS, _BDIZ, _BICM = (_amt(c) for c in ("FDAEXP", "FDBIPI", "FDBVIS", "FDBDIZ", "FDBICM"))
_TOTAL = f"({_AEXP} + {_BIPI} + {_BVIS} - {_BDIZ})"
_FORMULAS = {"neg_total": f"-{_TOTAL}", "pos_total": _TOTAL, "ipi": _BIPI, "neg_ipi": f"-{_BIPI}",
             "st": _BVIS, "neg_st": f"-{_BVIS}", "icms": _BICM, "neg_icms": f"-{_BICM}"}


def sales_branches_sql(cfg=DEFAULT_CONFIG) -> list[str]:
    out = []
    sx = f"rtrim(FDPDCT) = {_q(cfg.export_type)}"
    for branch, qi, formula, nonzero_st, labels in R.SALES_RULES:
        if labels is None:
            labs = [f"CASE WHEN {sx} THEN {_q(e)} ELSE {_q(d)} END"
                    for d, e in zip(R.GROSS_REVENUE_DOMESTIC, R.GROSS_REVENUE_EXPORT)]
        else:
            labs = [_q(x) for x in labels]
        extra = " AND FDBVIS <> 0" if nonzero_st else ""
        out.append(f"""SELECT {_doc_common(cfg)}, CAST({_FORMULAS[formula]} AS DECIMAL(38,4)) AS VALOR_TRANSACAO,
           {_labels(*labs)}, {qi} AS QUERY_INFO, {_q(branch)} AS BRANCH
    FROM doc WHERE {_sales_where(cfg)}{extra}""")
    return out


def returns_branches_sql(cfg=DEFAULT_CONFIG) -> list[str]:
    out = []
    for branch, qi, formula, c2, est, desc, full in R.RETURN_RULES:
        labs = [_q(c2), _q(est), _q(desc), _q(R.ABATEMENTS), _q(cfg.returns_subgroup_label), _q(full)]
        out.append(f"""SELECT {_doc_common(cfg)}, CAST({_FORMULAS[formula]} AS DECIMAL(38,4)) AS VALOR_TRANSACAO,
           {_labels(*labs)}, {qi} AS QUERY_INFO, {_q(branch)} AS BRANCH
    FROM doc WHERE {_returns_where(cfg)}""")
    return out


def difal_sql(cfg=DEFAULT_CONFIG) -> str:
    branch, qi, c2, est, desc, conta, conta_i, full, expl = R.DIFAL_RULE
    labs = [_q(c2), _q(est), _q(desc), _q(conta), _q(conta_i), _q(full),
            f"substring(concat({_q(expl)}, CAST(d.FDBNNF AS VARCHAR)), 1, 30)"]
    common = _doc_common(cfg).replace("FDBNNF AS NOTA", "d.FDBNNF AS NOTA")
    return f"""SELECT {common}, CAST({_amt('f.DFBICM')} AS DECIMAL(38,4)) AS VALOR_TRANSACAO,
           {_labels(*labs)}, {qi} AS QUERY_INFO, {_q(branch)} AS BRANCH
    FROM doc d LEFT JOIN f5576007 f ON f.DFBNNF = d.FDBNNF AND rtrim(d.FDDCT) = rtrim(f.DFDCT)
        AND d.FDN001 = f.DFN001 AND rtrim(d.FDBSER) = rtrim(f.DFBSER) AND f.DFUKID = d.FDUKID
    WHERE {_sales_where(cfg)}"""


def tax_code_sql(cfg=DEFAULT_CONFIG) -> list[str]:
    out = []
    codes = {"05": cfg.tax_code_pis, "06": cfg.tax_code_cofins}
    for branch, cls, code, qi, sign, c2, est, desc, conta_i, full, expl in R.TAX_CODE_RULES:
        if cls == "returns":
            where = _returns_where(cfg)
        else:
            where = (f"rtrim(FDPDCT) IN {_in(cfg.sales_types)} AND rtrim(FDNXTR) IN {_in(cfg.return_next_status)} "
                     f"AND CFOP NOT IN {_in(cfg.excluded_cfop)}")
        ex = ("CAST(NULL AS VARCHAR)" if expl is None else
              f"substring(concat({_q(expl)}, CAST(FDBNNF AS VARCHAR), FDGLC), 1, 30)")
        labs = [_q(c2), _q(est), _q(desc), _q(R.ABATEMENTS),
                _q(conta_i if conta_i is not None else cfg.returns_subgroup_label), _q(full), ex]
        amount = _amt("t.TDBRTXA") if sign > 0 else f"-{_amt('t.TDBRTXA')}"
        out.append(f"""SELECT {_doc_common(cfg)}, CAST({amount} AS DECIMAL(38,4)) AS VALOR_TRANSACAO,
           {_labels(*labs)}, {qi} AS QUERY_INFO, {_q(branch)} AS BRANCH
    FROM doc JOIN f76b011 t ON t.TDBNNF = FDBNNF AND rtrim(t.TDBSER) = rtrim(FDBSER)
        AND rtrim(t.TDDCT) = rtrim(FDDCT) AND t.TDN001 = FDN001 AND t.TDUKID = FDUKID
    WHERE rtrim(t.TDBRTX) = {_q(codes[code])} AND {where}""")
    return out


def _select_ledger(src: str) -> str:
    return f"SELECT {', '.join(LEDGER_COLS)} FROM {src}"


def union_sql(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT {', '.join(LEDGER_COLS)} FROM ({s})" for s in selects)


# ---------------------------------------------------------------- invoices (XML)

def _zpad(x: str, width: int) -> str:
    s = f"CAST({x} AS VARCHAR)"
    return f"concat(repeat('0', greatest(0, {width} - length({s}))), {s})"


def _money_txt(x: str) -> str:
    return f"CAST(CAST(round({x}, 2) AS DECIMAL(18,2)) AS VARCHAR)"


def invoice_ctes() -> str:
    """Documents (order x chunk) and their text fields, as the XML would carry them."""
    from .sources import invoice_standins as X
    states = ", ".join(_q(s) for s in X.STATES)
    tp = "CAST(o_totalprice AS DECIMAL(18,2))"
    return f"""li_rn AS (
    SELECT *, CAST((l_linenumber - 1) // {X.MAX_ITEMS_PER_DOCUMENT} AS INTEGER) AS chunk
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                 l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag) AS rn FROM lineitem)),
inv_docs AS (
    SELECT o.*, COALESCE(c.chunk, 0) AS chunk
    FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey, chunk FROM li_rn) c ON o.o_orderkey = c.l_orderkey),
inv_hdr AS (
    SELECT o_orderkey, chunk, (o_orderkey % 29 = 0 OR o_orderkey % 41 = 0) AS is_foreign,
           (o_orderkey % 23 = 0 OR o_orderkey % 43 = 0 OR o_orderkey % 47 = 0
            OR (o_orderkey % 79 = 0 AND o_orderkey % 17 <> 5 AND o_orderkey % 29 <> 0)) AS is_cut,
           'nfe_' || CAST(o_orderkey AS VARCHAR) || '_' || CAST(chunk AS VARCHAR) || '.xml' AS source_file,
           CASE WHEN o_orderkey % 6 = 4 AND o_orderkey % 10 <> 4 THEN '9' || substr({_zpad('o_orderkey', X.KEY_WIDTH)}, 2)
                ELSE {_zpad('o_orderkey', X.KEY_WIDTH)} END AS chNFe,
           CAST(o_orderkey AS VARCHAR) AS nNF,
           CASE WHEN o_orderkey % 83 = 0 AND o_orderkey % 17 <> 5 THEN {_q(X.SERIE_CDATA)} ELSE '1' END AS serie,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-03:00' AS dhEmi,
           CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS tpNF,
           CASE WHEN o_orderstatus = 'P' THEN 'REMESSA' ELSE 'VENDA DE MERCADORIA' END AS natOp,
           '35' AS cUF, '3550308' AS cMunFG,
           {_q(X.ISSUER['CNPJ'])} AS emit_CNPJ, '' AS emit_CPF, {_q(X.ISSUER['xNome'])} AS emit_xNome,
           {_q(X.ISSUER['IE'])} AS emit_IE, {_q(X.ISSUER['UF'])} AS emit_UF, {_q(X.ISSUER['xMun'])} AS emit_xMun,
           CASE WHEN o_orderkey % 13 = 0 OR o_custkey % 3 = 0 THEN '' ELSE {_zpad('o_custkey', 14)} END AS dest_CNPJ,
           CASE WHEN o_orderkey % 13 = 0 OR o_custkey % 3 <> 0 THEN '' ELSE {_zpad('o_custkey', 11)} END AS dest_CPF,
           CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'CLIENTE ' || CAST(o_custkey AS VARCHAR) END AS dest_xNome,
           '' AS dest_IE,
           CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE [{states}][CAST(o_custkey % 5 + 1 AS INTEGER)] END AS dest_UF,
           CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'CIDADE ' || CAST(o_custkey % 100 AS VARCHAR) END AS dest_xMun,
           {_money_txt(f'{tp} * 0.9')} AS vProd, CAST({tp} AS VARCHAR) AS vNF,
           {_money_txt(f'{tp} * 0.18')} AS vICMS, {_money_txt(f'{tp} * 0.9')} AS vBC,
           {_money_txt(f'{tp} * 0.0165')} AS vPIS, {_money_txt(f'{tp} * 0.076')} AS vCOFINS
    FROM inv_docs),
inv_items AS (
    SELECT l_orderkey, chunk, rn, CAST(l_linenumber AS VARCHAR) AS nItem, {_zpad('l_partkey', 6)} AS cProd,
           'PRODUTO ' || CAST(l_partkey AS VARCHAR)
               || CASE WHEN l_partkey % 50 = 0 THEN '; "ESPECIAL" & CIA' ELSE '' END AS xProd,
           {_q(X.NCM)} AS NCM, CASE WHEN l_returnflag = 'R' THEN '1202' ELSE '5102' END AS CFOP, 'UN' AS uCom,
           CAST(CAST(l_quantity AS DECIMAL(12,4)) AS VARCHAR) AS qCom,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS vUnCom,
           {_money_txt('CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))')} AS vProd_item,
           CASE WHEN l_tax > 0 THEN {_money_txt('CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))')}
                ELSE '' END AS vTotTrib_item
    FROM li_rn)"""


NOTAS_FIELDS = ["chNFe", "nNF", "serie", "dhEmi", "tpNF", "natOp", "cUF", "cMunFG",
                "emit_CNPJ", "emit_CPF", "emit_xNome", "emit_IE", "emit_UF", "emit_xMun",
                "dest_CNPJ", "dest_CPF", "dest_xNome", "dest_IE", "dest_UF", "dest_xMun",
                "vProd", "vNF", "vICMS", "vBC", "vPIS", "vCOFINS"]
ITEM_FIELDS = ["nItem", "cProd", "xProd", "NCM", "CFOP", "uCom", "qCom", "vUnCom", "vProd_item",
               "vTotTrib_item"]


def notas_sql() -> str:
    cols = ", ".join(f"CASE WHEN is_foreign THEN '' ELSE {c} END AS {c}" for c in NOTAS_FIELDS)
    return _with(invoice_ctes()) + f"\nSELECT {cols} FROM inv_hdr WHERE NOT is_cut"


def customer_notas_sql() -> str:
    """One document per customer, whatever case its key's synthesised envelope would be."""
    from .sources import invoice_standins as X
    own = {"chNFe": _zpad("o_orderkey", X.KEY_WIDTH), "serie": "'1'", "natOp": _q(X.ACCENTED_NATURE)}
    cols = ", ".join(f"{own.get(c, c)} AS {c}" for c in NOTAS_FIELDS)
    customers = """customer_orders AS (
    SELECT o_custkey, min(o_orderkey) AS o_orderkey, max(o_orderdate) AS o_orderdate, max(o_orderstatus) AS o_orderstatus,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS o_totalprice
    FROM orders GROUP BY o_custkey)"""
    ctes = invoice_ctes().replace("FROM orders o", "FROM customer_orders o")
    return _with(f"{customers},\n{ctes}") + f"\nSELECT {cols} FROM (SELECT DISTINCT ON (o_orderkey) * FROM inv_hdr)"


def itens_order_sql() -> str:
    return _with(invoice_ctes()) + """
SELECT h.source_file, i.nItem, row_number() OVER (ORDER BY h.source_file, i.rn) AS position
FROM inv_hdr h JOIN inv_items i ON i.l_orderkey = h.o_orderkey AND i.chunk = h.chunk
WHERE NOT h.is_cut AND NOT h.is_foreign"""


def itens_sql(product: str = "xProd") -> str:
    hcols = ", ".join(f"h.{c}" for c in NOTAS_FIELDS)
    icols = ", ".join(f"{product} AS xProd" if c == "xProd" else f"i.{c}" for c in ITEM_FIELDS)
    return _with(invoice_ctes()) + f"""
SELECT {hcols}, {icols}, h.source_file
FROM inv_hdr h JOIN inv_items i ON i.l_orderkey = h.o_orderkey AND i.chunk = h.chunk
WHERE NOT h.is_cut AND NOT h.is_foreign"""


def quarantine_sql() -> str:
    return _with(invoice_ctes()) + """
SELECT source_file FROM inv_hdr WHERE is_cut
UNION ALL
SELECT 'page_' || CAST(page_id AS VARCHAR) || '.html' AS source_file FROM pages"""
