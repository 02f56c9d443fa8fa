import csv
import glob
import io
import os

from balancete.sources.csv_sink import read_csv_strings, write_csv

ROWS = [("a;b", 'say "hi"', "line1\nline2"), (" lead", "", "plain "), (None, "cr\rlf\r\n", "é;"), ('"', ";", "\n")]


def _reference_bytes(columns, rows):
    """What the csv module writes with minimal quoting."""
    f = io.StringIO(newline="")
    w = csv.writer(f, delimiter=";", quoting=csv.QUOTE_MINIMAL)
    w.writerow(columns)
    w.writerows([["" if v is None else v for v in r] for r in rows])
    return f.getvalue().encode("utf-8")


def test_bytes_equal_the_csv_module(spark, tmp_dir):
    df = spark.createDataFrame(ROWS, "x string, y string, `z;q` string").coalesce(1)
    out = os.path.join(tmp_dir, "out")
    write_csv(df, out, single_file=True)
    part, = glob.glob(os.path.join(out, "part-*"))
    got = open(part, "rb").read()
    want = _reference_bytes(["x", "y", "z;q"], ROWS)
    split = lambda b: sorted(b.replace(b"\r\nlead", b"").split(b"\r\n"))  # noqa: E731  (one task: any row order)
    assert got.split(b"\r\n")[0] == want.split(b"\r\n")[0] and split(got) == split(want)


def test_one_column_with_an_empty_value(spark, tmp_dir):
    out = os.path.join(tmp_dir, "one")
    write_csv(spark.createDataFrame([("",)], "x string"), out, single_file=True)
    part, = glob.glob(os.path.join(out, "part-*"))
    assert open(part, "rb").read() == _reference_bytes(["x"], [("",)])


def test_every_part_has_the_header_and_reads_back(spark, tmp_dir):
    out = os.path.join(tmp_dir, "parts")
    df = spark.range(40).selectExpr("CAST(id AS STRING) AS i", "concat('a;', id, '\\n\"') AS t").repartition(4)
    write_csv(df, out)
    parts = glob.glob(os.path.join(out, "part-*"))
    assert len(parts) == 4 and all(open(p, "rb").read().startswith(b"i;t\r\n") for p in parts)
    back = {(r.i, r.t) for r in read_csv_strings(spark, out, ["i", "t"]).collect()}
    assert back == {(str(i), f'a;{i}\n"') for i in range(40)}


def test_zero_rows_give_blank_output(spark, tmp_dir):
    out = os.path.join(tmp_dir, "empty")
    write_csv(spark.createDataFrame([], "x string"), out)
    assert [p for p in glob.glob(os.path.join(out, "part-*")) if os.path.getsize(p) > 0] == []
    assert read_csv_strings(spark, out, ["x"]).count() == 0
