"""Benchmark of the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (default 3).

The ERP stand-ins and the synthetic invoice documents are derived from the
driver tables and written once as Parquet in the shared scratch folder
(reported as ``prepare_*``, not part of the total): the timed queries then
read ERP-shaped Parquet tables, as they would on a cluster. Each query runs
to completion into the ``noop`` sink (no driver collection); the figure is
the median of BENCH_REPS warm runs. ``hot_document_ledger`` is the document
ledger of the whole history with a third of all lines moved to one document.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["dre_monthly", "dre_range", "ledger_union", "ledger_detail", "document_tax_lines",
            "returns_reversal", "tax_code_lines", "allocation_split", "gl_detail", "xml_notas",
            "xml_itens", "julian_codec"]


def hot_document_tables(tables):
    """The bundle with a third of the document lines moved to the first document."""
    from pyspark.sql import functions as F
    head = tables["F7601B"].orderBy("FHBNNF").first()
    third = F.pmod(F.xxhash64("FDBNNF", "FDUKID"), F.lit(3)) == 0
    moved = {"FDFCO": head.FHFCO, "FDBNNF": head.FHBNNF, "FDDCT": head.FHDCT, "FDN001": head.FHN001}
    lines = tables["F7611B"]
    return tables.with_tables(F7611B=lines.withColumns(
        {c: F.when(third, F.lit(v).cast(lines.schema[c].dataType)).otherwise(F.col(c)) for c, v in moved.items()}))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from balancete import registry
    from balancete.session import get_spark, shared_scratch_path
    from balancete.sources.erp import read_erp, write_erp
    from balancete.sources.invoice_standins import invoice_documents
    from balancete.sources.standins import build_standins

    spark = get_spark(f"local[{cpus}]", cpus * 2, app_name="balancete-bench",
                      extra={"spark.driver.memory": "16g",
                             # at least two input splits per core for the file scans
                             "spark.sql.files.minPartitionNum": str(cpus * 2)})
    prep = {}
    t0 = time.time()
    erp_dir = shared_scratch_path(spark, "erp")
    write_erp(build_standins(spark, sf_dir), erp_dir)
    prep["prepare_erp_standins"] = round(time.time() - t0, 3)
    t0 = time.time()
    docs_dir = shared_scratch_path(spark, "nfe_docs")
    invoice_documents(spark, sf_dir).write.parquet(docs_dir)
    prep["prepare_invoice_documents"] = round(time.time() - t0, 3)

    tables = read_erp(spark, erp_dir)
    registry.use_tables(spark, sf_dir, tables)
    registry.use_invoice_documents(spark, sf_dir, spark.read.parquet(docs_dir))

    times = {}
    t0 = time.time()
    registry.q_dre_monthly(spark, sf_dir)  # builds the plan, runs the one-off lookup checks
    times["first_call_setup"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        fn = registry.QUERIES[name]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
        runs = []
        for _ in range(reps):
            t0 = time.time()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - t0)
        times[name] = round(statistics.median(runs), 3)
    from balancete.plans.ledger import document_ledger, release_documents
    hot = hot_document_tables(tables)
    runs = []
    for _ in range(reps + 1):
        t0 = time.time()
        document_ledger(hot, registry.DETAIL.jul_from, None).write.format("noop").mode("overwrite").save()
        runs.append(time.time() - t0)
        release_documents(hot)
    times["hot_document_ledger"] = round(statistics.median(runs[1:]), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "prepare": prep, "sf": sf, "cpus": cpus, "reps": reps,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
