"""The ledger rows of every branch, typed in from the source queries (not from ``rules``)."""

from decimal import Decimal

from balancete.plans.config import DEFAULT_CONFIG
from balancete.plans.ledger import document_ledger

from .test_documents import _difal, _docs, _line, _tax

NO = None
ABAT = "(-) ABATIMENTOS DA RECEITA" + " " * 4
# branch: (CONTA_II, CONTA_ESTRUTURA, DESCRICAO_CONTA_II, CONTA, CONTA_I, CONTA_COMPLETA, EXPLICACAO, QUERY_INFO, amount)
EXPECTED = {
    ("SA", "GROSS_REVENUE"): ("100.310110.001", "310110001", "FAT.BRUTO MERC.INTERNO", "Faturamento Bruto", "Receita Mercado Interno",
                              "310110001 FAT.BRUTO MERC.INTERNO", NO, 7, "-106.0000"),
    ("SX", "GROSS_REVENUE"): ("100.310110.005", "310110005", "FAT.BRUTO MERC.EXTERNO", "Faturamento Bruto", "Receita Mercado Externo",
                              "310110005 FAT. BRUTO MERC.EXTERNO", NO, 7, "-106.0000"),
    ("SA", "IPI"): ("100.310110.002", "310110002", "IPI S/FAT.BRUTO M.INTERNO", "(-) IMPOSTOS FATURADO", "(-) Impostos s/ Faturamento",
                    "310110002      IPI S/FAT.BRUTO M.INTERNO", NO, 8, "5.0000"),
    ("SA", "ICMS_ST"): ("100.310110.003", "310110003", "ICMS ST.FAT.BRUTO M.INTERNO", "(-) IMPOSTOS FATURADO", "(-) Impostos s/ Faturamento",
                        "310110003      ICMS ST.FAT.BRUTO M.INTERNO", NO, 9, "2.0000"),
    ("SA", "ICMS"): ("100.311210.001", "311210001", "ICMS", ABAT, "Impostos s/ Vendas", "311210001      ICMS", NO, 10, "18.0000"),
    ("SA", "DIFAL"): ("100.310110.006", "310110006", "DIFAL - ICMS", "(-) IMPOSTOS FATURADO", "(-) Impostos s/ Faturamento",
                      "310110006      DIFAL - ICMS" + " " * 18, "DIFAL DOC1", 8, "3.0000"),
    ("SA", "SALES_PIS"): ("100.311210.003", "311210003", "PIS S/ RECEITA BRUTA", ABAT, "Impostos s/ Vendas",
                          "311210003      PIS S/ RECEITA BRUTA" + " " * 10, "PIS NF1GL", 15, "0.0700"),
    ("SA", "SALES_COFINS"): ("100.311210.004", "311210004", "COFINS", ABAT, "Impostos s/ Vendas",
                             "311210004      COFINS" + " " * 24, "COFINS NF1GL", 16, "0.0900"),
    ("VR", "RETURN_TOTAL"): ("100.311220.001", "311220001", "ICMS", ABAT, "Devolucoes", "311220001 DEV.VENDA MERC.INTERNO", NO, 11, "106.0000"),
    ("VR", "RETURN_IPI"): ("100.311220.002", "311220002", "ICMS", ABAT, "Devolucoes", "311220002 IPI DEV.VENDA M.INTERNO", NO, 12, "-5.0000"),
    ("VR", "RETURN_ICMS"): ("100.311220.003", "311220003", "ICMS", ABAT, "Devolucoes", "311220003 ICMS DEV.VENDA M.INTERNO", NO, 13, "-18.0000"),
    ("VR", "RETURN_ICMS_ST"): ("100.311220.006", "311220006", "ICMS", ABAT, "Devolucoes", "311220006 ICMS ST DEV.VENDA M.INTERNO", NO, 14, "-2.0000"),
    ("VR", "RETURN_PIS"): ("100.311220.004", "311220004", "PIS", ABAT, "Devolucoes", "311220004 PIS DEV.VENDA M.INTERNO", NO, 15, "-0.0700"),
    ("VR", "RETURN_COFINS"): ("100.311220.005", "311220005", "COFINS", ABAT, "Devolucoes", "311220005 COFINS DEV.VENDA M.INTERNO", NO, 16, "-0.0900"),
}
LABELS = ("CONTA_II", "CONTA_ESTRUTURA", "DESCRICAO_CONTA_II", "CONTA", "CONTA_I", "CONTA_COMPLETA", "EXPLICACAO", "QUERY_INFO")


def test_every_branch_row(spark):
    t = _docs(spark, [_line(1, 1, "SA", FDNXTR="999"), _line(1, 2, "SX", FDNXTR="999"), _line(2, 3, "VR", FDBNOP="R", FDLITM="IT2")],
              F76B011=[_tax(n, u, c, v) for n, u in ((1, 1), (2, 3)) for c, v in (("05", 7), ("06", 9))], F5576007=[_difal(1, 1)])
    got = {(r.TIPO_DOCUMENTO, r.BRANCH): r for r in document_ledger(t, 116001, 116031).collect()}
    for key, want in EXPECTED.items():
        r = got[key]
        assert tuple(r[c] for c in LABELS) == want[:-1], key
        assert r.VALOR_TRANSACAO == Decimal(want[-1]), key
    export = {b for d, b in got if d == "SX"}
    assert export == {"GROSS_REVENUE", "IPI", "ICMS_ST", "ICMS", "DIFAL"} and len(got) == len(EXPECTED) - 1 + 5


def test_filter_lists():
    c = DEFAULT_CONFIG
    assert c.sales_types == ("AV", "S1", "S6", "S7", "SA", "SJ", "SM", "SO", "SX") and c.export_type == "SX"
    assert c.return_types == ("VR", "VX") and c.return_next_status == ("615", "610", "617", "620", "999")
    assert c.sales_excluded_next_status == ("996", "994") and c.sales_min_last_status == "615" and c.excluded_cfop == (1949,)
    assert c.item_line_codes == ("0", "1", "2", "3", "4", "L") and (c.tax_code_pis, c.tax_code_cofins) == ("05", "06")
    assert (c.account_group_lookup, c.account_subgroup_lookup) == (("09", "09"), ("09", "10"))
    assert (c.rate_balloons_lookup, c.rate_multiuse_lookup) == (("00", "49"), ("00", "50"))
    assert (c.item_category_system, c.item_category_types) == ("41", ("S1", "S2", "S3", "S4", "S5"))
    assert (c.ledger_type, c.posted_flag) == ("AA", "P") and c.allocation_labels == (" ", "BALOES", "LUVAS MULTIUSO")
    assert c.gl_excluded_groups == ("Faturamento Bruto", "(-) IMPOSTOS FATURADO")
    assert c.gl_excluded_structures == ("311210001", "311210004", "311210003")
    assert (c.balance_doc_type, c.balance_doc_number, c.balance_explanation) == ("SM", "SALDO_MENSAL", "SALDO F0902")
