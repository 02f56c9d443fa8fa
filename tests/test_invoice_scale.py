"""What keeps the invoice queries in proportion: one shuffle of the lines, one parse of a document,
sorted rows and CSV parts that are small on disk; with the same rows."""
import glob
import re

import pytest

from balancete import registry
from balancete.operators.invoices import ITENS_COLUMNS, itens
from balancete.plans.positions import with_position
from balancete.sources.csv_sink import read_csv_strings, write_csv
from balancete.sources.invoice_standins import invoice_documents
from balancete.sources.invoices import parse_invoices

ORDER = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
LINE = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string")
# Line numbers of each order: blocks of 990, none in the first block, without a number, before the first block, none.
LINES = {1: [1, 2, 3], 2: [1, 990, 991, 1981, 991], 3: [995], 4: [None, 1], 6: [None], 7: [0, -989, -990], 8: [1, 1500], 9: [], 10: [5, 2, 2], None: [1]}


def _tables(spark, folder):
    orders = [(k, 1, "O", 10.0, None) for k in [*LINES, 8, None]]
    lines = [(k, n, 50 * i, 1, 2.0, 10.0, 0.1, 0.05 * (i % 2), "R") for k, numbers in LINES.items() for i, n in enumerate(numbers)]
    spark.createDataFrame(orders, ORDER).write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(lines, LINE).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, "u", "<p>x<br></p>")], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")


def test_documents_of_every_block_of_lines(spark, tmp_dir):
    _tables(spark, tmp_dir)
    want = []
    for k in [*LINES, 8]:
        blocks = {}
        for n in LINES[k] if k is not None else []:
            block = None if n is None else (n - 1) // 990
            blocks[block] = blocks.get(block, 0) + 1
        want += [(f"nfe_{k}_{b or 0}.xml", n) for b, n in (blocks or {None: 0}).items() if k is not None]
    docs = invoice_documents(spark, tmp_dir, with_pages=False)
    rows = docs.collect()
    got = [(r.source_file, len(re.findall("<(n:)?det ", r.value))) for r in rows if r.source_file is not None]
    key = lambda x: (x[0] or "", x[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert len(rows) - len(got) == 2  # the orders without a key


def test_the_lines_are_shuffled_once(spark, tmp_dir):
    _tables(spark, tmp_dir)
    plan = invoice_documents(spark, tmp_dir, with_pages=False)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Sort \[l_orderkey[^\n]*chunk[^\n]*\n[^\n]*ObjectHashAggregate\([^\n]*collect_list", plan)


def test_items_parse_a_document_once(spark):
    raw = spark.createDataFrame([("a", "a", "<a/>")], "source_path string, source_file string, value string")
    for columns in (["source_file", "nItem"], ITENS_COLUMNS):
        plan = itens(parse_invoices(raw)).select(*columns)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [") == 1


def test_item_order_reads_written_rows(spark, tmp_dir):
    _tables(spark, tmp_dir)
    got = registry.q_xml_itens_order(spark, tmp_dir)
    parsed = parse_invoices(invoice_documents(spark, tmp_dir))
    want = [(r.source_file, r.nItem, i) for i, r in enumerate(itens(parsed, ordered=True).collect(), 1)]
    rows = sorted(map(tuple, got.collect()), key=lambda r: r[2])
    assert [r[2] for r in rows] == list(range(1, len(want) + 1)) and len(want) > 15
    assert [r[0] for r in rows] == [r[0] for r in want] and sorted(rows[:3]) == sorted(want[:3])
    alone = {"nfe_1_0.xml", "nfe_2_0.xml", "nfe_2_1.xml", "nfe_3_1.xml", "nfe_10_0.xml"}  # names of one document
    assert [r for r in rows if r[0] in alone] == [r for r in want if r[0] in alone]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "FileScan parquet" in plan


@pytest.mark.parametrize("written", [False, True])
def test_positions_of_ties_and_nulls(spark, tmp_dir, written):
    rows = [(None if i % 7 == 0 else i % 5, i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(3).orderBy("a")
    got = sorted(with_position(df, "position", f"{tmp_dir}/sorted" if written else None).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1, 201)) and {r.b for r in got} == set(range(200))
    assert [r.a for r in got] == sorted((a for a, _ in rows), key=lambda a: (a is not None, a))


def test_compressed_parts_read_back(spark, tmp_dir):
    df = spark.range(500).selectExpr("CAST(id AS STRING) AS i", "concat('a;', id, '\\n\"\\r') AS t").repartition(3)
    write_csv(df, f"{tmp_dir}/gz", compression="gzip")
    assert len(glob.glob(f"{tmp_dir}/gz/part-*.gz")) == 3
    assert sorted(map(tuple, read_csv_strings(spark, f"{tmp_dir}/gz", ["i", "t"]).collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(ValueError):
        write_csv(df, f"{tmp_dir}/one", single_file=True, compression="gzip")
    write_csv(df.limit(0), f"{tmp_dir}/none", compression="gzip")
    assert read_csv_strings(spark, f"{tmp_dir}/none", ["i", "t"]).count() == 0


def test_round_trip_keeps_compressed_parts(spark, tmp_dir):
    _tables(spark, tmp_dir)
    got = registry.q_csv_roundtrip(spark, tmp_dir)
    want = itens(parse_invoices(invoice_documents(spark, tmp_dir))).collect()
    assert sorted(map(tuple, got.collect())) == sorted((*r[:28], f'{r.xProd}\n"{r.cProd}', *r[29:]) for r in want)
    folder = registry._SCRATCH["csv_roundtrip"][1]
    parts = glob.glob(f"{folder}/part-*")
    assert parts and all(p.endswith(".gz") for p in parts)
