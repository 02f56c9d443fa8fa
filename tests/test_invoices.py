import os

from balancete.operators.invoices import ITENS_COLUMNS, NOTAS_COLUMNS, itens, notas, quarantine
from balancete.sources.invoice_standins import FILE_PER_ROW, invoice_documents, write_invoice_files
from balancete.sources.invoices import parse_invoices, read_invoice_files, read_invoices

NS = 'xmlns="http://www.portalfiscal.inf.br/nfe"'
INF = ('<infNFe Id="NFe{key}"><ide><nNF>{n}</nNF><serie>1</serie></ide>'
       '<emit><CNPJ>111</CNPJ><enderEmit><UF>SP</UF></enderEmit></emit>{dest}{dets}'
       '<total><ICMSTot><vNF>10.00</vNF></ICMSTot></total></infNFe>')
DET = '<det nItem=" {i} "><prod><cProd> 00{i} </cProd><vProd>1E3</vProd></prod><imposto><vTotTrib>1</vTotTrib></imposto></det>'
DEST = '<dest><CPF>999</CPF><enderDest><UF>RJ</UF><xMun>RIO</xMun></enderDest></dest>'


def _write(root, rel, text, enc="utf-8"):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "wb") as f:
        f.write(text.encode(enc))


def _inf(key, n, dets=2, dest=True):
    return INF.format(key=key, n=n, dest=DEST if dest else "", dets="".join(DET.format(i=i) for i in range(1, dets + 1)))


def _folder(root):
    _write(root, "a/proc.xml", f'<nfeProc {NS}><NFe>{_inf("K1", 1)}</NFe><protNFe><infProt><chNFe> CH1 </chNFe></infProt></protNFe></nfeProc>')
    _write(root, "a/b/bare.xml", f'<NFe {NS}>{_inf("K2", 2, dets=1, dest=False)}</NFe>')
    _write(root, "prefixed.xml", f'<n:NFe xmlns:n="http://www.portalfiscal.inf.br/nfe">'
           + _inf("K3", 3, dets=0).replace("<", "<n:").replace("<n:/", "</n:") + "</n:NFe>")
    _write(root, "blankch.xml", f'<nfeProc {NS}><NFe>{_inf("K4", 4, dets=1)}</NFe><protNFe><infProt><chNFe>  </chNFe></infProt></protNFe></nfeProc>')
    _write(root, "two.xml", f'<NFe {NS}>{_inf("K5", 5, dets=1)}{_inf("K6", 6, dets=3)}</NFe>')
    _write(root, "trunc.xml", f'<NFe {NS}>{_inf("K7", 7)}'[:80])
    _write(root, "empty.xml", "")
    _write(root, "foreign.xml", "<foo><bar>1</bar></foo>")
    _write(root, "page.xml", "<!DOCTYPE html><html><head><meta charset='utf-8'></head><body><p>x<br></body></html>")
    _write(root, "upper.XML", f'<NFe {NS}>{_inf("K8", 8)}</NFe>')
    _write(root, "notes.txt", "not xml")


def test_folder_scan_notas_itens_quarantine(spark, tmp_dir):
    _folder(tmp_dir)
    parsed = parse_invoices(read_invoice_files(spark, tmp_dir))
    n = {r.nNF: r for r in notas(parsed).collect()}
    assert notas(parsed).columns == NOTAS_COLUMNS
    # upper-case extension and .txt are not scanned; zero-byte file yields no row;
    # truncated and HTML go to quarantine; foreign root gives one blank row
    assert set(n) == {"1", "2", "3", "4", "5", ""}
    assert n["1"].chNFe == "CH1" and n["2"].chNFe == "K2" and n["4"].chNFe == "K4"
    assert n["2"].dest_UF == "" and n["1"].dest_xMun == "RIO" and n["1"].emit_UF == "SP"
    assert n[""].chNFe == "" and n[""].vNF == ""
    it = itens(parsed, ordered=True)
    assert it.columns == ITENS_COLUMNS and len(ITENS_COLUMNS) == 37
    rows = it.collect()
    # path order part by part: a/b/bare.xml < a/proc.xml < blankch.xml < two.xml
    assert [(r.nNF, r.nItem) for r in rows] == [("2", "1"), ("1", "1"), ("1", "2"), ("4", "1"), ("5", "1")]
    assert rows[1].cProd == "001" and rows[1].vProd_item == "1E3" and rows[1].source_file == "proc.xml"
    q = {r.source_file for r in quarantine(parsed).collect()}
    assert q == {"trunc.xml", "page.xml"}


def test_single_file_any_extension(spark, tmp_dir):
    _write(tmp_dir, "one.txt", f'<NFe {NS}>{_inf("K9", 9, dets=1)}</NFe>')
    parsed = parse_invoices(read_invoice_files(spark, os.path.join(tmp_dir, "one.txt")))
    assert [r.nNF for r in notas(parsed).collect()] == ["9"]


def test_latin1_with_declaration(spark, tmp_dir):
    doc = ('<?xml version="1.0" encoding="ISO-8859-1"?>'
           f'<NFe {NS}><infNFe Id="NFeL"><ide><nNF>10</nNF><natOp>DEVOLUÇÃO</natOp></ide></infNFe></NFe>')
    _write(tmp_dir, "latin.xml", doc, enc="latin-1")
    parsed = parse_invoices(read_invoice_files(spark, tmp_dir, encoding="auto"))
    assert [r.natOp for r in notas(parsed).collect()] == ["DEVOLUÇÃO"]


NFE = "http://www.portalfiscal.inf.br/nfe"
ONE = '<infNFe Id="NFeX{n}"><ide><nNF>{n}</nNF></ide><det nItem="1"><prod><cProd>c{n}</cProd></prod></det></infNFe>'

# name -> (document, nNF of the notas row or None if malformed, number of items)
SHAPES = {
    "deep": (f'<a xmlns="{NFE}"><b><nfeProc><NFe>{ONE.format(n=1)}</NFe></nfeProc></b></a>', "1", 1),
    "deeper_protocol": (f'<e xmlns="{NFE}"><x><NFe>{ONE.format(n=2)}</NFe><protNFe><infProt><chNFe>CH</chNFe></infProt></protNFe></x></e>', "2", 1),
    "first_leaf": (f'<NFe xmlns="{NFE}">{ONE.format(n=3).replace("<nNF>3</nNF>", "<nNF>3</nNF><nNF>LAST</nNF>")}</NFe>', "3", 1),
    "first_leaf_empty": (f'<NFe xmlns="{NFE}">{ONE.format(n=4).replace("<nNF>4</nNF>", "<nNF/><nNF>LAST</nNF>")}</NFe>', "", 1),
    "other_namespace": (f'<NFe xmlns="urn:other">{ONE.format(n=5)}</NFe>', "", 0),
    "no_namespace": (f'<NFe>{ONE.format(n=6)}</NFe>', "", 0),
    "prefix_of_other": (f'<n:NFe xmlns:n="urn:other" xmlns="{NFE}">' + ONE.format(n=7).replace("<", "<n:").replace("<n:/", "</n:") + "</n:NFe>", "", 0),
    "inner_namespace": (f'<env><NFe xmlns="{NFE}">{ONE.format(n=8)}</NFe></env>', "8", 1),
    "trailing_text": (f'<NFe xmlns="{NFE}">{ONE.format(n=9)}</NFe>junk', None, 0),
    "trailing_comment": (f'<?xml version="1.0"?><!-- a --><NFe xmlns="{NFE}">{ONE.format(n=10)}</NFe><!-- <b> --><?pi x?>\n', "10", 1),
    "second_root": (f'<NFe xmlns="{NFE}">{ONE.format(n=11)}</NFe><x/>', None, 0),
    "second_same_root": (f'<NFe xmlns="{NFE}">{ONE.format(n=12)}</NFe><NFe xmlns="{NFE}"/>', None, 0),
    "nested_same_name": ("<a><a><b/></a><c/></a>", "", 0),
    "self_closed_root": (f'<NFe xmlns="{NFE}"/>', "", 0),
    "leading_text": (f'junk<NFe xmlns="{NFE}">{ONE.format(n=13)}</NFe>', None, 0),
    "commented_out": (f'<NFe xmlns="{NFE}"><!-- {ONE.format(n=14)} -->{ONE.format(n=15)}</NFe>', "15", 1),
    "signed": (f'<nfeProc xmlns="{NFE}"><NFe>{ONE.format(n=16)}<Signature xmlns="http://www.w3.org/2000/09/xmldsig#"><a/></Signature></NFe>'
               '<protNFe><infProt><chNFe>222</chNFe></infProt></protNFe></nfeProc>', "16", 1),
    "closed_sibling": (f'<NFe xmlns="{NFE}"><x xmlns="urn:other"><y/></x>{ONE.format(n=17)}</NFe>', "17", 1),
    "foreign_first": (f'<NFe xmlns="{NFE}"><infNFe xmlns="urn:other"><ide><nNF>9</nNF></ide></infNFe>{ONE.format(n=18)}</NFe>', "18", 1),
    "foreign_protocol_first": (f'<p xmlns="{NFE}">{ONE.format(n=19)}<protNFe xmlns="urn:o"><infProt><chNFe>9</chNFe></infProt></protNFe>'
                               '<protNFe><infProt/></protNFe><protNFe><infProt><chNFe>7</chNFe><chNFe>8</chNFe></infProt></protNFe></p>', "19", 1),
    "quoted_invoice": (f'<NFe xmlns="{NFE}"><![CDATA[{ONE.format(n=9)}]]>{ONE.format(n=20)}</NFe>', "20", 1),
    "nested_leaf": (f'<NFe xmlns="{NFE}">{ONE.format(n=21).replace("<nNF>21", "<nNF>7<b>x</b>8")}</NFe>', "7", 1),
    "leaf_of_markup": (f'<NFe xmlns="{NFE}">{ONE.format(n=22).replace("<nNF>22", "<nNF><b>x</b>8")}</NFe>', "", 1),
    "cdata_leaf": (f'<NFe xmlns="{NFE}">{ONE.format(n=23).replace("<nNF>23", "<nNF><![CDATA[7<!--x-->]]>8")}</NFe>', "7<!--x-->8", 1),
    "comment_in_leaf": (f'<NFe xmlns="{NFE}">{ONE.format(n=24).replace("<nNF>24", "<nNF>2<!--x-->4<?pi?>")}</NFe>', "24", 1),
    "foreign_leaf": (f'<NFe xmlns="{NFE}">{ONE.format(n=25).replace("<nNF>", "<nNF xmlns='urn:o'>9</nNF><nNF>")}</NFe>', "25", 1),
    "undeclared_prefix": (f'<NFe xmlns="{NFE}"><q:z/>{ONE.format(n=26)}</NFe>', None, 0),
    "undeclared_attribute_prefix": (f'<NFe xmlns="{NFE}" q:a="1">{ONE.format(n=27)}</NFe>', None, 0),
    "repeated_attribute": (f'<NFe xmlns="{NFE}" a="1" a="2">{ONE.format(n=28)}</NFe>', None, 0),
    "entities": (f'<!DOCTYPE NFe [<!ENTITY e "29">]><NFe xmlns="{NFE}">{ONE.format(n="&e;")}</NFe>', "29", 1),
    "unknown_entity": (f'<NFe xmlns="{NFE}">{ONE.format(n="&e;")}</NFe>', None, 0),
    "root_invoice": (f'<infNFe xmlns="{NFE}" Id="NFeR"><ide><nNF>30</nNF></ide></infNFe>', "", 0),
    "markup_in_attribute": (f'<NFe xmlns="{NFE}" a="&lt;infNFe> xmlns=\'urn:o\'">{ONE.format(n=31)}</NFe>', "31", 1),
    "prefix_rebound": (f'<n:a xmlns:n="urn:o"><n:infNFe/><n:NFe xmlns:n="{NFE}">' + ONE.format(n=32).replace("<", "<n:").replace("<n:/", "</n:") + "</n:NFe></n:a>", "32", 1),
    "empty_invoice": (f'<NFe xmlns="{NFE}"><infNFe Id="NFeE"/></NFe>', "", 0),
}


def test_answers_of_a_tree_parser(spark):
    """Each shape against Python's own tree parser, with the lookups of the source."""
    import xml.etree.ElementTree as ET
    ns = {"n": NFE}
    df = spark.createDataFrame([(f"d/{k}.xml", f"{k}.xml", v[0]) for k, v in SHAPES.items()], "source_path string, source_file string, value string")
    parsed = parse_invoices(df)
    got = {r.source_file: r for r in parsed.selectExpr("source_file", "malformed", "header.ide.nNF AS n", "size(inf.det) AS items", "key AS ch").collect()}
    for name, (doc, nnf, items) in SHAPES.items():
        r = got[f"{name}.xml"]
        try:
            root = ET.fromstring(doc)
        except ET.ParseError:
            assert nnf is None and r.malformed, name
            continue
        inf = root.find(".//n:infNFe", ns)
        text = inf.findtext("n:ide/n:nNF", "", ns) if inf is not None else ""
        assert not r.malformed and (r.n or "") == (text or "") == nnf, name
        assert max(r["items"] or 0, 0) == (len(inf.findall("n:det", ns)) if inf is not None else 0) == items, name
        assert (r.ch or "") == root.findtext(".//n:protNFe/n:infProt/n:chNFe", "", ns), name
    assert {r.source_file for r in quarantine(parsed).collect()} == {f"{k}.xml" for k, v in SHAPES.items() if v[1] is None}
    assert notas(parsed).count() == sum(v[1] is not None for v in SHAPES.values())
    assert itens(parsed).count() == sum(v[2] for v in SHAPES.values())


def test_values_are_stripped_as_str_strip_does(spark):
    doc = f'<NFe xmlns="{NFE}"><infNFe Id=" NFeK1\u00a0"><ide><nNF>\u00a0\u2003 7 8\u3000</nNF></ide><det nItem="\u00a01 "/></infNFe></NFe>'
    parsed = parse_invoices(spark.createDataFrame([("a.xml", "a.xml", doc)], "source_path string, source_file string, value string"))
    row = itens(parsed).first()
    assert (row.chNFe, row.nNF, row.nItem) == ("K1", "7 8", "1")


def test_character_sets_and_file_names(spark, tmp_dir):
    """Every file by its own bytes, with default options; one bad file is one quarantined file."""
    doc = f'<NFe xmlns="{NFE}"><infNFe Id="NFe{{n}}"><ide><nNF>{{n}}</nNF><natOp>DEVOLUÇÃO</natOp></ide><det/></infNFe></NFe>'
    declared = lambda enc, n: f'<?xml version="1.0" encoding="{enc}"?>' + doc.format(n=n)
    _write(tmp_dir, "1 a.xml", doc.format(n=1))
    _write(tmp_dir, "sub dir/b%20c+d.xml", declared("UTF-16", 2), "utf-16")
    _write(tmp_dir, "sub dir/ç.xml", declared("ISO-8859-1", 3), "latin-1")
    _write(tmp_dir, "bom.xml", declared("UTF-8", 4), "utf-8-sig")
    _write(tmp_dir, "cp.xml", declared("windows-1252", 5), "cp1252")
    _write(tmp_dir, "le.xml", doc.format(n=6), "utf-16")  # a byte-order mark and no declaration
    _write(tmp_dir, "bad byte.xml", doc.format(n=7), "latin-1")
    _write(tmp_dir, "unknown.xml", declared("no-such-set", 8))
    _write(tmp_dir, "wide.xml", declared("shift_jis", 9).replace("ÇÃ", ""), "shift_jis")
    parsed = read_invoices(spark, tmp_dir)
    got = {r.source_file: (r.nNF, r.natOp) for r in itens(parsed).collect()}
    name = "DEVOLUÇÃO"
    assert got == {"1 a.xml": ("1", name), "b%20c+d.xml": ("2", name), "ç.xml": ("3", name), "bom.xml": ("4", name),
                   "cp.xml": ("5", name), "le.xml": ("6", name)}
    assert {r.source_file for r in quarantine(parsed).collect()} == {"bad byte.xml", "unknown.xml", "wide.xml"}
    assert [r.natOp for r in notas(read_invoices(spark, os.path.join(tmp_dir, "bad byte.xml"), encoding="latin-1")).collect()] == [name]


def test_one_ordered_file_equals_the_csv_module(spark, tmp_dir):
    """Folder conversion into one file each, byte by byte, without a single-task shuffle."""
    import csv
    import io
    from pathlib import Path
    from balancete.plans.invoices import convert_folder
    src = os.path.join(tmp_dir, "in")
    _folder(src)
    for i in range(40):
        name = f"d{i % 7}/x {i % 3}/nota;{i}.xml" if i % 2 else f"d{i % 7}-{i}.xml"
        _write(src, name, f'<NFe {NS}>{_inf(f"k{i}", i, dets=i % 4).replace("RIO", f"R;I{chr(34)}O{chr(10)}{i}")}</NFe>')
    convert_folder(spark, src, os.path.join(tmp_dir, "out"), single_file=True)
    places = {str(p): k for k, p in enumerate(sorted(Path(src).rglob("*.xml")))}
    parsed = read_invoices(spark, src)
    paths = parsed.select("source_path", "source_file", "header.ide.nNF").collect()
    assert {r.source_path.replace("file:", "") for r in paths} <= set(places)
    for name, df, columns in (("itens", itens(parsed, ordered=True), ITENS_COLUMNS), ("notas", notas(parsed, ordered=True), NOTAS_COLUMNS)):
        f = io.StringIO(newline="")
        w = csv.writer(f, delimiter=";", quoting=csv.QUOTE_MINIMAL)
        rows = df.collect()
        w.writerow(columns)
        w.writerows(rows)
        assert open(os.path.join(tmp_dir, "out", f"{name}.csv"), "rb").read() == f.getvalue().encode("utf-8")
    order = [r.chNFe for r in notas(parsed, ordered=True).collect()]
    by_path = {r.source_path.replace("file:", ""): r for r in paths}
    well = [p for p in sorted(by_path, key=places.get) if os.path.basename(p) not in ("trunc.xml", "page.xml")]
    assert [x[1:] for x in order if x.startswith("k")] == [by_path[p].nNF for p in well if "nota;" in p or "-" in os.path.basename(p)]
    plan = notas(parsed, ordered=True)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "rangepartitioning" in plan


def test_single_file_by_uri_and_folder_by_uri(spark, tmp_dir):
    _write(tmp_dir, "one.txt", f'<NFe {NS}>{_inf("K9", 9, dets=1)}</NFe>')
    _write(tmp_dir, "two.xml", f'<NFe {NS}>{_inf("K8", 8, dets=1)}</NFe>')
    for encoding in ("UTF-8", "auto"):
        one = parse_invoices(read_invoice_files(spark, f"file://{tmp_dir}/one.txt", encoding=encoding))
        assert [r.nNF for r in notas(one).collect()] == ["9"]
        folder = parse_invoices(read_invoice_files(spark, f"file://{tmp_dir}", encoding=encoding))
        assert [r.nNF for r in notas(folder).collect()] == ["8"]


def test_notas_does_not_parse_items(spark, tmp_dir):
    _write(tmp_dir, "one.xml", f'<NFe {NS}>{_inf("K9", 9, dets=1)}</NFe>')
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    plan = notas(parse_invoices(read_invoice_files(spark, tmp_dir)))._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "StructField(det" not in plan and "cProd" not in plan


def test_convert_folder_writes_the_three_outputs(spark, tmp_dir):
    from balancete.plans.invoices import convert_folder
    from balancete.sources.csv_sink import read_csv_strings
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    _folder(src)
    convert_folder(spark, src, out)
    parsed = parse_invoices(read_invoice_files(spark, src))
    for name, df in (("itens", itens(parsed)), ("notas", notas(parsed)), ("quarantine", quarantine(parsed))):
        back = read_csv_strings(spark, os.path.join(out, name), df.columns).collect()
        assert sorted(map(tuple, back)) == sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


def test_shuffles_of_the_documents_carry_no_text(spark):
    docs = invoice_documents(spark, "/root/testdata/sf0.001", with_pages=False)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join", 1)
    assert "<det nItem=" in above and "<det nItem=" not in below


def test_malformed_needs_no_tree(spark):
    docs = ["<a/>", "<a>", "", None, "<a/>x", "<!DOCTYPE a><a>&b;</a>", '<!DOCTYPE a SYSTEM "b"><a>&c;</a>',
            '<!DOCTYPE a [<!ENTITY c "d">]><a>&c;</a>', "<q:a/>", "<a b='1' b='2'/>", '<?xml version="1.0" encoding="none"?><a/>',
            "<a>ç&lt;<!--x--><?y z?><![CDATA[<]]></a>"]
    parsed = parse_invoices(spark.createDataFrame([(str(i), str(i), d) for i, d in enumerate(docs)],
                                                  "source_path string, source_file string, value string").coalesce(1))
    rows = parsed.select("source_file", "malformed", "readable").collect()
    assert [r.malformed for r in rows] == [not r.readable for r in rows]
    assert {r.source_file for r in rows if not r.malformed} == {"0", "7", "10", "11"}
    plan = quarantine(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert "check(" in plan and "parse(" not in plan


def test_missing_containers_and_repeats(spark):
    ns = 'xmlns="http://www.portalfiscal.inf.br/nfe"'
    docs = [f"<NFe {ns}><infNFe/></NFe>", f"<NFe {ns}><infNFe Id=' 7 '><ide><nNF> 1 </nNF><nNF>2</nNF></ide><ide><serie>3</serie></ide>"
            "<det nItem=' 1 '><prod/></det><det/></infNFe></NFe>", "<a/>", "<a>"]
    parsed = parse_invoices(spark.createDataFrame([(str(i), str(i), d) for i, d in enumerate(docs)],
                                                  "source_path string, source_file string, value string").coalesce(1))
    bare, full, foreign, bad = [r.inf for r in parsed.select("inf").collect()]
    assert foreign is None and bad is None
    assert bare["_Id"] == "" and bare["ide"] is None and bare["det"] is None
    assert full["_Id"] == "7" and full["ide"]["nNF"] == "1" and full["ide"]["serie"] is None and full["total"] is None
    assert [(d["_nItem"], d["prod"] is None) for d in full["det"]] == [("1", False), ("", True)]


def test_small_files_share_a_task(spark, tmp_dir):
    for i in range(1100):
        with open(f"{tmp_dir}/{i}.xml", "w") as f:
            f.write("<a/>")
    files = read_invoice_files(spark, tmp_dir)
    assert files.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert files.count() == 1100


def test_one_file_per_row_without_check_sums(spark, tmp_dir):
    spark.range(0, 20, 1, 2).selectExpr("cast(id as string) AS value").write.options(**FILE_PER_ROW).text(f"{tmp_dir}/out")
    names = [n for n in os.listdir(f"{tmp_dir}/out") if "part-" in n]
    assert len(names) == 20 and not [n for n in names if n.endswith(".crc")]


def test_customer_files_are_written_by_many_tasks(spark, tmp_dir):
    rows = [(i, i, "O", 10.0, None) for i in range(1, 61)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
                          ).write.parquet(f"{tmp_dir}/orders.parquet")
    write_invoice_files(spark, tmp_dir, f"{tmp_dir}/out")
    files = [n for _, _, names in os.walk(f"{tmp_dir}/out") for n in names if n.startswith("part-")]
    assert len(files) == 60 and len({n[:10] for n in files}) > 1


def test_a_null_customer_key_leaves_no_null_document(spark, tmp_dir):
    order = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    line = ("l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string")
    spark.createDataFrame([(1, None, None, None, None), (None,) * 5], order).write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame([(1,) + (None,) * 8], line).write.parquet(f"{tmp_dir}/lineitem.parquet")
    docs = invoice_documents(spark, tmp_dir, with_pages=False)
    assert parse_invoices(docs).where("malformed").count() == 0  # the text is built in the filter
    assert sorted(r.dest_UF for r in notas(parse_invoices(docs)).collect()) == ["RS", "RS"]
