import datetime as dt
import re
from decimal import Decimal

from balancete.operators.documents import (difal_lines, document_branches, document_lines,
                                           tax_code_lines)
from balancete.plans.ledger import document_ledger

from .helpers import code, erp


def _docs(spark, lines, **extra):
    base = dict(
        F7601B=[{"FHFCO": "00001", "FHBNNF": 1, "FHDCT": "NS", "FHN001": 1, "FHISSU": 116010},
                {"FHFCO": "00001", "FHBNNF": 2, "FHDCT": "NS", "FHN001": 1, "FHISSU": 116020}],
        F76B200=[{"DPBNOP": "A", "DPBSOP": "F", "DPFCO": "00001", "DPBRNOP": 5101},
                 {"DPBNOP": "R", "DPBSOP": "F", "DPFCO": "00001", "DPBRNOP": 1202}],
        F4101=[{"IMLITM": "IT1", "IMSRP1": "3  "}, {"IMLITM": "IT2", "IMSRP1": "0"},
               {"IMLITM": "IT5", "IMSRP1": "5"}],
        F0010=[{"CCCO": "00001", "CCNAME": "CO"}],
        F0005=[code("41", "S1", "3", "LINHA TRES")],
        F7611B=lines)
    base.update(extra)
    return erp(spark, **base)


def _line(nnf, ukid, pdct, **kw):
    d = {"FDFCO": "00001", "FDBNNF": nnf, "FDDCT": "NS", "FDN001": 1, "FDBSER": "1", "FDUKID": ukid,
         "FDPDCT": pdct, "FDNXTR": "615", "FDLTTR": "620", "FDBNOP": "A", "FDBSOP": "F", "FDLITM": "IT1",
         "FDMCU": "          10", "FDCO": "00001", "FDGLC": "GL", "FDAEXP": 10000, "FDBIPI": 500,
         "FDBVIS": 200, "FDBDIZ": 100, "FDBICM": 1800}
    d.update(kw)
    return d


def test_sales_branches_and_signs(spark):
    t = _docs(spark, [_line(1, 1, "SA"), _line(1, 2, "SX", FDBVIS=0), _line(1, 3, "SA", FDBVIS=None),
                      _line(1, 4, "SA", FDLITM="IT5"), _line(1, 5, "SA", FDNXTR="996")])
    doc = document_lines(t, 116001, 116031)
    rows = document_branches(doc).collect()
    by = {}
    for r in rows:
        by.setdefault(r.BRANCH, []).append(r)
    assert len(by["GROSS_REVENUE"]) == 3 and len(by["ICMS"]) == 3 and len(by["IPI"]) == 3
    assert len(by["ICMS_ST"]) == 1                       # only the non-zero, non-NULL ST line
    gross = {r.NOTA * 10 + (1 if r.CONTA_II.endswith("005") else 0): r for r in by["GROSS_REVENUE"]}
    assert gross[11].CONTA_COMPLETA == "310110005 FAT. BRUTO MERC.EXTERNO"
    domestic = [r for r in by["GROSS_REVENUE"] if r.CONTA_II.endswith("001")]
    assert Decimal("-106.0000") in [r.VALOR_TRANSACAO for r in domestic]   # -(100+5+2-1)
    r = by["ICMS"][0]
    assert r.FILIAL == "200 LATEX SAO ROQUE - FABRICA II" and r.LINHA == "LINHA TRES"
    assert r.CENTRO_CUSTO == " " and r.PERCENTUAL == Decimal("0.0000") and r.EMPRESA == "00001 - CO"
    assert r.DATA_LANCAMENTO == dt.date(2016, 1, 10) and r.CFOP == 5101


def test_returns_emit_st_even_when_zero(spark):
    t = _docs(spark, [_line(2, 1, "VR", FDBNOP="R", FDBVIS=0, FDLITM="IT2")])
    rows = document_branches(document_lines(t, 116001, 116031)).collect()
    assert sorted(r.BRANCH for r in rows) == ["RETURN_ICMS", "RETURN_ICMS_ST", "RETURN_IPI", "RETURN_TOTAL"]
    vals = {r.BRANCH: r.VALOR_TRANSACAO for r in rows}
    assert vals["RETURN_TOTAL"] == Decimal("104.0000") and vals["RETURN_ICMS_ST"] == Decimal("0.0000")
    assert vals["RETURN_IPI"] == Decimal("-5.0000")
    assert all(r.CONTA_I == "Devolucoes" and r.FILIAL == "100 LATEX SAO ROQUE - 3 MAIO" for r in rows)


def test_difal_left_join_keeps_unmatched_and_multiplies(spark):
    t = _docs(spark, [_line(1, 1, "SA"), _line(1, 2, "SA")],
              F5576007=[{"DFBNNF": 1, "DFDCT": "NS", "DFN001": 1, "DFBSER": "1", "DFUKID": 1, "DFBICM": 300},
                        {"DFBNNF": 1, "DFDCT": "NS", "DFN001": 1, "DFBSER": "1", "DFUKID": 1, "DFBICM": 400}])
    doc = document_lines(t, 116001, 116031)
    vals = sorted((r.VALOR_TRANSACAO is None, r.VALOR_TRANSACAO) for r in difal_lines(doc, t).collect())
    assert [v for _, v in vals] == [Decimal("3.0000"), Decimal("4.0000"), None]
    # the duplicate only multiplies the DIFAL branch
    assert document_branches(doc).where("BRANCH = 'ICMS'").count() == 2


def test_tax_code_lines_classes(spark):
    td = lambda nnf, uk, c, v: {"TDBNNF": nnf, "TDBSER": "1", "TDDCT": "NS", "TDN001": 1, "TDUKID": uk,  # noqa
                                "TDBRTX": c, "TDBRTXA": v}
    t = _docs(spark, [_line(1, 1, "SA", FDNXTR="999"), _line(2, 1, "VR", FDBNOP="R", FDLITM="IT2")],
              F76B011=[td(1, 1, "05", 165), td(1, 1, "06", 760), td(1, 1, "99", 1),
                       td(2, 1, "05", 100), td(2, 1, "06", 200)])
    rows = {r.BRANCH: r for r in tax_code_lines(document_lines(t, 116001, 116031), t).collect()}
    assert set(rows) == {"SALES_PIS", "SALES_COFINS", "RETURN_PIS", "RETURN_COFINS"}
    assert rows["SALES_PIS"].VALOR_TRANSACAO == Decimal("1.6500") and rows["SALES_PIS"].QUERY_INFO == 15
    assert rows["SALES_PIS"].EXPLICACAO == "PIS NF1GL"
    assert rows["RETURN_COFINS"].VALOR_TRANSACAO == Decimal("-2.0000")
    assert rows["RETURN_COFINS"].CONTA_I == "Devolucoes" and rows["RETURN_COFINS"].EXPLICACAO is None


def test_issue_date_range_inclusive(spark):
    t = _docs(spark, [_line(1, 1, "SA"), _line(2, 1, "SA")])
    doc = document_lines(t, 116010, 116010)
    assert {r.FDBNNF for r in doc.collect()} == {1}


def _bundle(spark, folder, lines, **extra):
    from balancete.sources.erp import read_erp, write_erp
    write_erp(_docs(spark, lines, **extra), folder)
    return read_erp(spark, folder)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tax(nnf, ukid, code="05", value=7):
    return {"TDBNNF": nnf, "TDBSER": "1", "TDDCT": "NS", "TDN001": 1, "TDUKID": ukid, "TDBRTX": code, "TDBRTXA": value}


def _difal(nnf, ukid, value=300):
    return {"DFBNNF": nnf, "DFDCT": "NS", "DFN001": 1, "DFBSER": "1", "DFUKID": ukid, "DFBICM": value}


def test_ledger_reads_the_fact_once_and_removes_its_folder(spark, tmp_dir):
    import os

    from balancete.plans.ledger import release_documents
    t = _bundle(spark, tmp_dir, [_line(1, 1, "SA", FDNXTR="999"), _line(2, 1, "VR", FDBNOP="R", FDLITM="IT2")],
                F76B011=[_tax(1, 1), _tax(2, 1)], F5576007=[_difal(1, 1)])
    led = document_ledger(t, 116001, 116031)
    assert sorted(r.BRANCH for r in led.collect()) == sorted(
        ["GROSS_REVENUE", "IPI", "ICMS_ST", "ICMS", "DIFAL", "SALES_PIS", "RETURN_TOTAL", "RETURN_IPI",
         "RETURN_ICMS", "RETURN_ICMS_ST", "RETURN_PIS"])
    plan = _plan(led)
    (_, path), = t.derived["_document_folders"]
    assert f"{tmp_dir}/F7611B" not in plan and plan.count("document_lines-") >= 3   # three reads of the written lines
    assert os.path.isdir(path)
    release_documents(t)
    assert not os.path.isdir(path)


def test_only_used_rows_are_kept(spark):
    t = _docs(spark, [_line(1, 1, "SA"), _line(1, 2, "SA", FDNXTR="996"), _line(1, 3, "SA", FDLTTR="100", FDNXTR="100"),
                      _line(2, 1, "VR", FDNXTR="100"), _line(2, 2, "ZZ"), _line(2, 3, "VR", FDBNOP="R")])
    assert {(r.FDBNNF, r.FDUKID) for r in document_lines(t, 116001, 116031).collect()} == {(1, 1), (2, 3)}


def test_statement_columns_prune_the_lines(spark, tmp_dir):
    from balancete.plans.ledger import STATEMENT_COLUMNS
    t = _bundle(spark, tmp_dir, [_line(1, 1, "SA")])
    lines = document_lines(t, 116001, 116031, columns=STATEMENT_COLUMNS)
    assert not {"CENTRO_CUSTO", "CCNAME", "ITEM", "FILIAL"} & set(lines.columns)
    assert f"{tmp_dir}/F0006" not in _plan(lines)                          # no unit join
    assert document_ledger(t, 116001, 116031, columns=STATEMENT_COLUMNS).columns == [
        c for c in document_ledger(t, 116001, 116031).columns if c in STATEMENT_COLUMNS]


def test_filters_reach_the_scans_of_the_document_plan(spark, tmp_dir):
    t = _bundle(spark, tmp_dir, [_line(1, 1, "SA")], F76B011=[_tax(1, 1)])
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    lines = document_lines(t, 116001, 116031)
    scans = [x for x in _plan(tax_code_lines(lines, t)).splitlines() if "FileScan" in x or "PushedFilters" in x]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    text = " ".join(scans)
    assert "GreaterThanOrEqual(FHISSU,116001), LessThanOrEqual(FHISSU,116031)" in text
    assert "StringStartsWith(FDPDCT,SA)" in text and "StringStartsWith(TDBRTX,05)" in text


def test_hot_document_is_split_by_aqe(spark, tmp_dir):
    """A document with a third of the lines: the header join splits it, with AQE as it runs."""
    n = 6000
    lines = [_line(1 if i < n // 3 else 100 + i, i, "SA", FDNXTR="999") for i in range(n)]
    headers = [{"FHFCO": "00001", "FHBNNF": b, "FHDCT": "NS", "FHN001": 1, "FHISSU": 116010}
               for b in [1] + [100 + i for i in range(n // 3, n)]]
    t = _bundle(spark, tmp_dir, lines, F7601B=headers, F76B011=[_tax(x["FDBNNF"], x["FDUKID"]) for x in lines],
                F5576007=[_difal(x["FDBNNF"], x["FDUKID"]) for x in lines[::2]])
    small = {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.files.maxPartitionBytes": "64k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
        doc = document_lines(t, 116001, 116031)
        assert len(doc.collect()) == n
        assert "skew=true" in _plan(doc)
        led = document_ledger(t, 116001, 116031)
        rows = led.collect()
        assert sum(r.BRANCH == "DIFAL" for r in rows) == n and sum(r.BRANCH == "SALES_PIS" for r in rows) == n
        for df in (doc, led):
            # But for the bounds of the key range: a row per task, pre-aggregated.
            bounds = r"Exchange SinglePartition[^\n]*\n[^\n]*HashAggregate\(keys=\[\], functions=\[partial_(min|max)"
            assert "SinglePartition" not in re.sub(bounds, "", _plan(df))
            assert "REPARTITION" not in _plan(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_building_document_lines_runs_no_job_over_the_facts(spark, tmp_dir):
    t = _bundle(spark, tmp_dir, [_line(1, 1, "SA")])
    document_lines(t, 116001, 116031)                # dimension checks of the bundle run here, once
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "build-only")
    try:
        document_lines(t, 116001, 116031)
        assert list(tracker.getJobIdsForGroup("build-only")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def _history(spark, folder, n=4000):
    """Headers over 400 days, one line each; ten documents are of the first month's first day."""
    lines = [_line(i, i, "SA", FDNXTR="999") for i in range(n)]
    headers = [{"FHFCO": "00001", "FHBNNF": i, "FHDCT": "NS", "FHN001": 1, "FHISSU": 116001 + i // 10 % 360} for i in range(n)]
    return _bundle(spark, folder, lines, F7601B=headers, F76B011=[_tax(i, i) for i in range(n)],
                   F5576007=[_difal(i, i) for i in range(0, n, 2)])


def test_a_months_headers_filter_the_fact_before_its_exchange(spark, tmp_dir):
    """Runtime Bloom filter (its size bound lowered for the test), and the same rows without it."""
    t = _history(spark, tmp_dir)
    key = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    assert spark.conf.get(key) == "1GB"
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plain = sorted(document_lines(t, 116001, 116003).collect())
        spark.conf.set(key, "0")
        doc = document_lines(t, 116001, 116003)
        assert sorted(doc.collect()) == plain and len(plain) == 60
        plan = _plan(doc)
        assert "might_contain" in plan
        exchanged = [m for m in _exchange_rows(doc) if m]
        assert max(exchanged) < 400, exchanged                 # of 4,000 lines, 60 wanted
    finally:
        spark.conf.set(key, "1GB")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")


def _exchange_rows(df):
    """Rows written by every shuffle of the plan that ran."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name == "Exchange":
                out.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return out


def test_the_key_range_of_the_wanted_documents_reaches_the_scans(spark, tmp_dir):
    t = _history(spark, tmp_dir)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        scan, = [x for x in _plan(document_lines(t, 116001, 116003)).splitlines() if "FileScan" in x and "/F7611B" in x]
        assert "(FDBNNF" in scan.split("DataFilters")[1] and "Subquery" in scan.split("DataFilters")[1]
        led = document_ledger(t, 116001, 116003)
        assert sum(r.BRANCH == "SALES_PIS" for r in led.collect()) == 60
        scans = [x for x in _plan(led).splitlines() if "FileScan" in x and ("/F76B011" in x or "/F5576007" in x)]
        assert {"F76B011" in x for x in scans} == {True, False} and all("Subquery" in x.split("DataFilters")[1] for x in scans)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def _summed(df, amount):
    """The same rows as the result of an aggregate, as where lines are summed from finer ones."""
    from pyspark.sql import functions as F
    return df.groupBy(*[c for c in df.columns if c != amount]).agg(F.max(amount).alias(amount)).select(df.columns)


def test_only_a_months_documents_are_summed_and_exchanged(spark, tmp_dir, monkeypatch):
    """Lines and details that come out of an aggregate are cut to the month's documents below it."""
    from dataclasses import replace

    from balancete.plans import ledger
    from balancete.plans.config import DEFAULT_CONFIG
    t = _history(spark, tmp_dir)
    t = t.with_tables(F7611B=_summed(t["F7611B"], "FDAEXP"), F76B011=_summed(t["F76B011"], "TDBRTXA"),
                      F5576007=_summed(t["F5576007"], "DFBICM"))
    seen, build = [], ledger.document_lines
    monkeypatch.setattr(ledger, "document_lines", lambda *a, **k: seen.append(build(*a, **k)) or seen[-1])
    led = document_ledger(t, 116001, 116003)
    rows = sorted(map(str, led.collect()))
    assert len(seen[0].collect()) == 60
    for df in (seen[0], led):
        assert max(_exchange_rows(df)) <= 60                    # of 4,000 rows of each fact
    # Too many documents for a broadcast: the same rows without the cut.
    many = document_ledger(t, 116001, 116003, replace(DEFAULT_CONFIG, broadcast_max_bytes=0))
    assert sorted(map(str, many.collect())) == rows and max(_exchange_rows(many)) > 1000


def test_documents_without_a_number_or_with_two_headers(spark, tmp_dir):
    """A null document number matches nothing and a header that stands twice doubles its lines, with the cut as without."""
    from balancete.operators.documents import few_documents, headers
    head = {"FHFCO": "00001", "FHBNNF": 1, "FHDCT": "NS", "FHN001": 1, "FHISSU": 116010}
    t = _bundle(spark, tmp_dir, [_line(1, 1, "SA"), _line(None, 2, "SA"), _line(3, 1, "SA")],
                F7601B=[head, head, head | {"FHBNNF": None}], F76B011=[_tax(1, 1), _tax(None, 2)], F5576007=[_difal(None, 2)])
    keys = few_documents(headers(t["F7601B"], 116001, None), "FHBNNF")
    found = {}
    for documents in (None, keys):
        doc = document_lines(t, 116001, None, documents=documents)
        found[documents is None] = [sorted(map(str, x.collect())) for x in (
            doc, difal_lines(doc, t, documents=documents), tax_code_lines(doc, t, documents=documents))]
    assert found[True] == found[False] and len(found[True][0]) == 2
