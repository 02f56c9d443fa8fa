"""Facts bucketed on the document key, and the check of stored schemas."""

import pytest
from pyspark.sql import functions as F

from balancete.operators.documents import difal_lines, document_branches, document_lines, tax_code_lines
from balancete.plans.ledger import document_ledger, release_documents
from balancete.sources.erp import SchemaMismatch, read_erp, write_erp
from balancete.sources.schemas import ERP_SCHEMAS

from .test_documents import _difal, _docs, _line, _plan, _tax

N = 3000


@pytest.fixture(scope="module")
def bundles(spark, tmp_path_factory):
    """The same rows plain and laid out; a third of the lines on one document."""
    lines = [_line(1 if i < N // 3 else 100 + i // 3, i, "SA" if i % 5 else "VR", FDNXTR="999" if i % 5 else "615",
                   FDBNOP="A" if i % 5 else "R", FDFCO="00001  " if i % 2 else "00001") for i in range(N)]
    # The same number and type under another series sequence and company: other documents.
    lines += [_line(1, 7, "SA", FDN001=2, FDNXTR="999"), _line(1, 8, "SA", FDFCO="00002", FDNXTR="999"), _line(1, None, "SA", FDNXTR="999"),
              _line(None, 9, "SA", FDNXTR="999")]
    numbers = sorted({x["FDBNNF"] for x in lines if x["FDBNNF"]})
    headers = [{"FHFCO": "00001", "FHBNNF": b, "FHDCT": "NS ", "FHN001": 1, "FHISSU": 116001 + b % 60} for b in numbers]
    extra = dict(F7601B=headers + headers[5:7], F76B011=[_tax(x["FDBNNF"], x["FDUKID"], c) for x in lines for c in ("05", "06")],
                 F5576007=[_difal(x["FDBNNF"], x["FDUKID"]) for x in lines[::2]])
    made = _docs(spark, lines, **extra)
    out = []
    for name, options in (("plain", {}), ("laid", {"buckets": 8})):
        root = str(tmp_path_factory.mktemp(name))
        write_erp(made, root, **options)
        out.append((root, read_erp(spark, root)))
    return out


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_same_rows_as_the_plain_tables(bundles):
    (_, a), (_, b) = bundles
    assert set(b.layouts) == {"F7601B", "F7611B", "F76B011", "F5576007"} and not a.layouts
    for name in b.layouts:
        assert b[name].columns == a[name].columns and _rows(b[name]) == _rows(a[name])
    first = {r.FDBNNF for r in document_lines(b, 116001, 116060).collect()}
    assert len(first) > 600
    led = [_rows(document_ledger(t, 116001, 116031)) for t in (a, b)]
    assert led[0] == led[1] and len(led[0]) > N
    for make in (document_branches, lambda d: difal_lines(d, a), lambda d: tax_code_lines(d, a)):
        assert _rows(make(document_lines(a, 116001, 116031))) == _rows(make(document_lines(b, 116001, 116031)))
    lazy = [_rows(tax_code_lines(document_lines(t, 116001, 116031), t)) for t in (a, b)]
    assert lazy[0] == lazy[1] and lazy[0]
    for t in (a, b):
        release_documents(t)


def _exchanged_above(plan, path):
    """Whether a row scanned from ``path`` goes through an exchange: of the lines above the scan
    the ancestors are those further left."""
    lines = [x for x in plan.split("== Initial Plan ==")[0].splitlines() if x.strip()]
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    at, = [i for i, x in enumerate(lines) if "FileScan" in x and path in x]
    here = depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < here:
            here = depth(x)
            if "Exchange" in x or "SinglePartition" in x:
                return True
            if "SortMergeJoin" in x:
                return False
    return False


def test_no_fact_side_is_exchanged(spark, bundles):
    (_, a), (root, b) = bundles
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")  # its subqueries scan too
    try:
        doc = document_lines(b, 116001, 116031)
        plan = _plan(doc)
        assert not _exchanged_above(plan, "/F7611B") and not _exchanged_above(plan, "/F7601B")
        assert "Bucketed: true" in plan and "SelectedBucketsCount: 8 out of 8" in plan
        for df, name in ((tax_code_lines(doc, b), "F76B011"), (difal_lines(doc, b), "F5576007")):
            plan = _plan(df)
            assert not _exchanged_above(plan, f"/{name}") and not _exchanged_above(plan, "/F7611B"), plan
        assert "hashpartitioning" not in plan
        led = document_ledger(b, 116001, 116031)            # written lines are exchanged, the details are not
        plan = _plan(led)
        assert not _exchanged_above(plan, "/F76B011") and not _exchanged_above(plan, "/F5576007")
        assert _exchanged_above(_plan(document_lines(a, 116001, 116031)), "/F7611B")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
        release_documents(b)


def test_a_hot_document_is_spread_over_the_buckets(bundles):
    _, (_, b) = bundles
    per_key = b.layouts["F7611B"].where("FDBNNF = 1 AND FDN001 = 1").groupBy("_K").count().collect()
    assert len(per_key) >= 7 and max(r["count"] for r in per_key) < 250
    buckets = b.layouts["F7611B"].groupBy(F.pmod(F.hash("_K"), F.lit(8))).count().collect()
    assert len(buckets) == 8 and max(r["count"] for r in buckets) < N / 3
    assert b.layouts["F7601B"].where("FHBNNF = 1").count() == len(per_key)


def test_a_renamed_or_retyped_column_raises(spark, tmp_dir):
    write_erp(_docs(spark, [_line(1, 1, "SA")]), tmp_dir)
    read_erp(spark, tmp_dir)
    path = f"{tmp_dir}/F0010"
    good = spark.createDataFrame([("1", "CO")], "CCCO string, CCNAME string")
    for change, message in ((good.withColumnRenamed("CCNAME", "CCNAM"), "CCNAME is missing"),
                            (good.withColumn("CCNAME", F.lit(1)), "CCNAME is int, not string")):
        change.write.mode("overwrite").parquet(path)
        with pytest.raises(SchemaMismatch, match=message):
            read_erp(spark, tmp_dir)
    assert read_erp(spark, tmp_dir, check=False)["F0010"].columns == ERP_SCHEMAS["F0010"].fieldNames()
    good.withColumn("MORE", F.lit(1)).write.mode("overwrite").parquet(path)
    assert read_erp(spark, tmp_dir)["F0010"].count() == 1
    # One part of several with another type of a column.
    good.withColumn("CCNAME", F.lit(1)).write.mode("append").parquet(path)
    with pytest.raises(Exception, match="CCNAME"):
        read_erp(spark, tmp_dir)


def test_an_open_ledger_owns_what_it_writes(spark, bundles):
    import gc
    import os

    from balancete.plans.ledger import ledger, open_ledger
    from balancete.plans.params import PeriodParams
    (_, a), _ = bundles
    p = PeriodParams.month(2016, 1)
    want = _rows(ledger(a, "balance", p))
    shared = a.derived["_document_folders"][-1][1]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("open", "open")
    with open_ledger(a, "balance", p) as led, open_ledger(a, "balance", p) as other:
        assert list(jobs.getJobIdsForGroup("open")) == [] and not led._folders
        assert _rows(led.rows) == want
        (_, own), = led._folders
        _ = other.rows
        other.close()                                     # its lines only
        assert os.path.isdir(own) and os.path.isdir(shared) and led.income_statement().count() > 0
        release_documents(a)
        assert os.path.isdir(own) and not os.path.isdir(shared)
    assert not os.path.isdir(own)
    with pytest.raises(ValueError, match="closed"):
        led.rows
    lost = open_ledger(a, "balance", p)
    _ = lost.rows
    (_, path), = lost._folders
    del lost
    gc.collect()
    assert not os.path.isdir(path)
    spark.sparkContext._jsc.clearJobGroup()
    with pytest.raises(ValueError, match="unknown"):
        open_ledger(a, "x", p)
