import os

from balancete.operators.invoices import ITENS_COLUMNS
from balancete.sources.csv_sink import read_csv_strings
from balancete.streaming import start_invoice_stream

NS = 'xmlns="http://www.portalfiscal.inf.br/nfe"'


def _doc(n, items):
    dets = "".join(f'<det nItem="{i}"><prod><cProd>{n}{i}</cProd></prod></det>' for i in range(1, items + 1))
    return f'<NFe {NS}><infNFe Id="NFe{n}"><ide><nNF>{n}</nNF></ide>{dets}</infNFe></NFe>'


def _put(d, name, text):
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_folder_stream_processes_each_file_once(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    _put(src, "a.xml", _doc(1, 2))
    _put(src, "b.xml", _doc(2, 1))
    _put(src, "bad.xml", "<NFe><infNFe>")
    q = start_invoice_stream(spark, src, out, ck, available_now=True)
    q.awaitTermination(120)
    _put(src, "c.xml", _doc(3, 3))
    q = start_invoice_stream(spark, src, out, ck, available_now=True)
    q.awaitTermination(120)
    items = read_csv_strings(spark, os.path.join(out, "itens"), ITENS_COLUMNS).collect()
    assert sorted((r.nNF, r.nItem) for r in items) == [
        ("1", "1"), ("1", "2"), ("2", "1"), ("3", "1"), ("3", "2"), ("3", "3")]
    bad = read_csv_strings(spark, os.path.join(out, "quarantine"), ["source_file", "n_chars"]).collect()
    assert [r.source_file for r in bad] == ["bad.xml"]
