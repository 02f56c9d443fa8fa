"""Branch rule table of the document side of the ledger.

Each rule is one ledger line emitted per qualifying document line: which
document class it applies to, which amount formula, and the account labels.
The labels are FIXED VALUES that must equal the source queries; they are
listed here in the source's branch order, as data rather than code, so the
document job scans the fact once and emits all branches with one explode.

Amount formulas (cents / 100, sign is part of the contract):
  neg_total  -(aexp + bipi + bvis - bdiz)     pos_total  +(aexp + bipi + bvis - bdiz)
  ipi        +bipi        neg_ipi   -bipi
  st         +bvis        neg_st    -bvis
  icms       +bicm        neg_icms  -bicm
"""

from __future__ import annotations

ABATEMENTS = "(-) ABATIMENTOS DA RECEITA    "   # 30 wide, padding is part of the label
INVOICED_TAXES = "(-) IMPOSTOS FATURADO"
INVOICED_TAXES_SUB = "(-) Impostos s/ Faturamento"
SALES_TAXES_SUB = "Impostos s/ Vendas"

# --- FIXED VALUES: sales branches (one document scan) -------------------------
# (branch, query_info, class, amount, only_nonzero_st, CONTA_II, CONTA_ESTRUTURA,
#  DESCRICAO_CONTA_II, CONTA, CONTA_I, CONTA_COMPLETA)
# Gross revenue has a domestic and an export variant (document type 'SX').
GROSS_REVENUE_DOMESTIC = ("100.310110.001", "310110001", "FAT.BRUTO MERC.INTERNO",
                          "Faturamento Bruto", "Receita Mercado Interno",
                          "310110001 FAT.BRUTO MERC.INTERNO")
GROSS_REVENUE_EXPORT = ("100.310110.005", "310110005", "FAT.BRUTO MERC.EXTERNO",
                        "Faturamento Bruto", "Receita Mercado Externo",
                        "310110005 FAT. BRUTO MERC.EXTERNO")

SALES_RULES = [
    ("GROSS_REVENUE", 7, "neg_total", False, None),  # labels from the two tuples above
    ("IPI", 8, "ipi", False,
     ("100.310110.002", "310110002", "IPI S/FAT.BRUTO M.INTERNO", INVOICED_TAXES,
      INVOICED_TAXES_SUB, "310110002      IPI S/FAT.BRUTO M.INTERNO")),
    ("ICMS_ST", 9, "st", True,
     ("100.310110.003", "310110003", "ICMS ST.FAT.BRUTO M.INTERNO", INVOICED_TAXES,
      INVOICED_TAXES_SUB, "310110003      ICMS ST.FAT.BRUTO M.INTERNO")),
    ("ICMS", 10, "icms", False,
     ("100.311210.001", "311210001", "ICMS", ABATEMENTS, SALES_TAXES_SUB,
      "311210001      ICMS")),
]

# --- FIXED VALUES: return branches (same document scan) -----------------------
# (branch, query_info, amount, CONTA_II, CONTA_ESTRUTURA, DESCRICAO_CONTA_II, CONTA_COMPLETA)
# CONTA is ABATEMENTS and CONTA_I is the configured returns label.
RETURN_RULES = [
    ("RETURN_TOTAL", 11, "pos_total", "100.311220.001", "311220001", "ICMS",
     "311220001 DEV.VENDA MERC.INTERNO"),
    ("RETURN_IPI", 12, "neg_ipi", "100.311220.002", "311220002", "ICMS",
     "311220002 IPI DEV.VENDA M.INTERNO"),
    ("RETURN_ICMS", 13, "neg_icms", "100.311220.003", "311220003", "ICMS",
     "311220003 ICMS DEV.VENDA M.INTERNO"),
    ("RETURN_ICMS_ST", 14, "neg_st", "100.311220.006", "311220006", "ICMS",
     "311220006 ICMS ST DEV.VENDA M.INTERNO"),
]

# --- FIXED VALUES: DIFAL branch (left join to the DIFAL detail) ---------------
DIFAL_RULE = ("DIFAL", 8, "100.310110.006", "310110006", "DIFAL - ICMS", INVOICED_TAXES,
              INVOICED_TAXES_SUB, "310110006      DIFAL - ICMS                  ", "DIFAL DOC")

# --- FIXED VALUES: PIS / COFINS branches (join to the per-line tax detail) -----
# (branch, class, tax code, query_info, sign, CONTA_II, CONTA_ESTRUTURA,
#  DESCRICAO_CONTA_II, CONTA_I or None for the returns label, CONTA_COMPLETA,
#  explanation prefix or None)
TAX_CODE_RULES = [
    ("RETURN_PIS", "returns", "05", 15, -1, "100.311220.004", "311220004", "PIS", None,
     "311220004 PIS DEV.VENDA M.INTERNO", None),
    ("RETURN_COFINS", "returns", "06", 16, -1, "100.311220.005", "311220005", "COFINS", None,
     "311220005 COFINS DEV.VENDA M.INTERNO", None),
    ("SALES_PIS", "sales", "05", 15, 1, "100.311210.003", "311210003", "PIS S/ RECEITA BRUTA",
     SALES_TAXES_SUB, "311210003      PIS S/ RECEITA BRUTA          ", "PIS NF"),
    ("SALES_COFINS", "sales", "06", 16, 1, "100.311210.004", "311210004", "COFINS",
     SALES_TAXES_SUB, "311210004      COFINS                        ", "COFINS NF"),
]
# --- end of fixed values ------------------------------------------------------

LABEL_FIELDS = ("CONTA_II", "CONTA_ESTRUTURA", "DESCRICAO_CONTA_II", "CONTA", "CONTA_I",
                "CONTA_COMPLETA")
