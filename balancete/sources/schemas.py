"""Explicit schemas for the ERP tables, the common ledger and the reports.

Types are deduced from use (FIXTURES.md §1): money is integer cents,
dates are CYYDDD integers, codes are blank-padded strings whose padding is
kept at load (SURVEY B8).
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, IntegerType, LongType,
                               StringType, StructField, StructType)

S, I, L = StringType(), IntegerType(), LongType()
CENTS = DecimalType(20, 0)


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


ERP_SCHEMAS: dict[str, StructType] = {
    # GL account master
    "F0901": _schema(("GMAID", S), ("GMANI", S), ("GMOBJ", S), ("GMSUB", S), ("GMDL01", S),
                     ("GMCO", S), ("GMMCU", S), ("GMR009", S), ("GMR010", S)),
    # account balances, one column per fiscal period
    "F0902": _schema(("GBAID", S), ("GBLT", S), ("GBFY", I),
                     *[(f"GBAN{p:02d}", CENTS) for p in range(1, 15)]),
    # journal detail
    "F0911": _schema(("GLAID", S), ("GLDGJ", I), ("GLDCT", S), ("GLDOC", L), ("GLAA", CENTS),
                     ("GLANI", S), ("GLEXA", S), ("GLLT", S), ("GLPOST", S)),
    # code lookup
    "F0005": _schema(("DRSY", S), ("DRRT", S), ("DRKY", S), ("DRDL01", S), ("DRSPHD", S)),
    # business units
    "F0006": _schema(("MCMCU", S), ("MCDL01", S), ("MCRP04", S), ("MCRP49", S), ("MCRP50", S)),
    # companies
    "F0010": _schema(("CCCO", S), ("CCNAME", S)),
    # item master
    "F4101": _schema(("IMLITM", S), *[(f"IMSRP{k}", S) for k in range(1, 6)]),
    # fiscal document header
    "F7601B": _schema(("FHFCO", S), ("FHBNNF", L), ("FHDCT", S), ("FHN001", L), ("FHISSU", I)),
    # fiscal document line (the large fact)
    "F7611B": _schema(("FDFCO", S), ("FDBNNF", L), ("FDDCT", S), ("FDN001", L), ("FDBSER", S),
                      ("FDUKID", L), ("FDPDCT", S), ("FDNXTR", S), ("FDLTTR", S), ("FDBNOP", S),
                      ("FDBSOP", S), ("FDLITM", S), ("FDMCU", S), ("FDCO", S), ("FDGLC", S),
                      ("FDAEXP", CENTS), ("FDBIPI", CENTS), ("FDBVIS", CENTS), ("FDBDIZ", CENTS),
                      ("FDBICM", CENTS)),
    # operation nature -> CFOP
    "F76B200": _schema(("DPBNOP", S), ("DPBSOP", S), ("DPFCO", S), ("DPBRNOP", I)),
    # per-line tax detail
    "F76B011": _schema(("TDBNNF", L), ("TDBSER", S), ("TDDCT", S), ("TDN001", L), ("TDUKID", L),
                       ("TDBRTX", S), ("TDBRTXA", CENTS)),
    # DIFAL detail
    "F5576007": _schema(("DFBNNF", L), ("DFDCT", S), ("DFN001", L), ("DFBSER", S), ("DFUKID", L),
                        ("DFBICM", CENTS)),
}

# The common 26-column ledger (order matters only for positional unions in
# the source dialect; we union by name) plus our own BRANCH tag, because
# QUERY_INFO is not unique per branch.
LEDGER_SCHEMA = _schema(
    ("DATA_LANCAMENTO", DateType()), ("TIPO_DOCUMENTO", S), ("NUM_DOCUMENTO", S),
    ("VALOR_TRANSACAO", DecimalType(38, 4)), ("CONTA_II", S), ("CONTA_ESTRUTURA", S),
    ("DESCRICAO_CONTA_II", S), ("EXPLICACAO", S), ("CHAVE_CONTA", S), ("CONTA", S),
    ("CONTA_I", S), ("ORDEM_CONTA", S), ("CONTA_COMPLETA", S), ("CENTRO_CUSTO", S),
    ("PERCENTUAL", DecimalType(10, 4)), ("EMPRESA", S), ("FILIAL", S), ("CFOP", I),
    ("NOTA", L), ("ITEM", S), ("LINHA", S), ("TAMANHO", S), ("TIPO", S), ("COR", S),
    ("EMBALAGEM", S), ("QUERY_INFO", I), ("BRANCH", S),
)
LEDGER_COLUMNS = [f.name for f in LEDGER_SCHEMA.fields]

INCOME_STATEMENT_SCHEMA = _schema(
    ("COMPETENCIA", S), ("CONTA", S), ("CONTA_I", S), ("CONTA_ESTRUTURA", S),
    ("DESCRICAO_CONTA_II", S), ("CONTA_COMPLETA", S), ("VALOR_DRE", DecimalType(38, 4)),
)
