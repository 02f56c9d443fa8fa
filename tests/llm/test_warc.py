"""Content-addressed archive: exact round trips, SQL on awkward pages, defined cases."""

import glob
import hashlib
import os
import shutil

import duckdb
import pytest

from balancete.llm import oracle, queries
from balancete.llm.warc import read_archive, warc, write_archive, write_warc

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, id string, digest string, seq int"


def page(i, html, url="http://a/b"):
    return (i, url, html, "clash", "clash", 1)


def awkward(spark):
    big = "é" * 60  # 120 bytes in 60 characters
    rows = [page(7, big), page(3, big), page(5, big), page(9, "short"), page(2, "short"), page(11, None), page(12, ""),
            page(13, "x" * 99), page(14, "x" * 99), page(16, "y" * 100), page(15, "y" * 100, None),
            page(17, "line\r\n\r\nWARC/1.1\r\nWARC-Type: fake\r\n\r\n" * 9, "http://a/ b\r\nWARC-Type: revisit"),
            page(18, "long " * 400_000), page(1, "long " * 400_000)]
    return spark.createDataFrame(rows + [page(100 + i, "hot page " * 40) for i in range(200)], SCHEMA)


def test_query_equals_sql(spark, tmp_dir):
    base = spark.read.parquet(f"{SF}/pages.parquet")
    awkward(spark).select(*base.columns).unionByName(base.withColumn("page_id", base.page_id + 1000)).write.parquet(f"{tmp_dir}/pages.parquet")
    got = queries.QUERIES["op13_warc"](spark, tmp_dir)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_dir}/pages.parquet/*.parquet'")
    cur = con.execute(oracle.SQL["op13_warc"])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == sorted(cur.fetchall(), key=repr)


def parse_warc(data):
    """Records of a WARC file by their Content-Length: (fields, block)."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        fields = dict(x.decode().split(": ", 1) for x in lines[1:])
        n = int(fields["Content-Length"])
        assert rest[n:n + 4] == b"\r\n\r\n"
        out.append((fields, rest[:n]))
        data = rest[n + 4:]
    return out


def test_records_are_rebuilt_byte_by_byte(spark, tmp_dir):
    df = awkward(spark)
    write_archive(df, f"{tmp_dir}/a")
    stored = spark.read.parquet(f"{tmp_dir}/a/payloads")
    texts = {r.page_id: (r.html or "").encode() for r in df.collect()}
    assert stored.count() == len(set(texts.values()))
    got = read_archive(spark, f"{tmp_dir}/a").collect()
    ids = {r.record_id: r.id for r in got}
    assert len(ids) == len(got) == len(texts)
    for r in got:
        assert r.record == bytes(r.header) + texts[r.id] + b"\r\n\r\n"
        assert r.payload_digest == hashlib.sha256(texts[r.id]).hexdigest() and r.payload_bytes == len(texts[r.id])
        assert r.refers_to == ids.get(r.refers_to_record)
    write_warc(read_archive(spark, f"{tmp_dir}/a"), f"{tmp_dir}/files")
    seen = {}
    for f in glob.glob(f"{tmp_dir}/files/part-*"):
        for fields, block in parse_warc(open(f, "rb").read()):
            http, _, body = block.partition(b"\r\n\r\n")
            i = ids[fields["WARC-Record-ID"]]
            seen[i] = fields
            assert body == (b"" if fields["WARC-Type"] == "revisit" else texts[i])
            assert f"Content-Length: {len(texts[i])}".encode() in http
    assert seen.keys() == texts.keys()
    assert seen[7]["WARC-Type"] == "revisit" and ids[seen[7]["WARC-Refers-To"]] == 3
    assert seen[17]["WARC-Target-URI"] == "http://a/%20b%0D%0AWARC-Type:%20revisit"
    assert "WARC-Target-URI" not in seen[15]


def test_a_damaged_payload_fails_the_read(spark, tmp_dir):
    write_archive(awkward(spark), f"{tmp_dir}/a")
    bad = spark.read.parquet(f"{tmp_dir}/a/payloads").selectExpr("digest", "payload || binary('!') AS payload")
    bad.write.parquet(f"{tmp_dir}/b/payloads")
    shutil.copytree(f"{tmp_dir}/a/headers", f"{tmp_dir}/b/headers")
    with pytest.raises(Exception, match="does not match its digest"):
        read_archive(spark, f"{tmp_dir}/b").select("payload_digest").collect()


def test_nulls_repeats_and_empty_tables(spark):
    same = "z" * 200
    df = spark.createDataFrame([page(4, same), page(4, same), page(None, same), page(None, "w" * 200), page(None, "w" * 200)], SCHEMA)
    got = sorted(((r.id, r.record_type, r.refers_to) for r in warc(df).collect()), key=repr)
    assert got == sorted([(4, "response", None), (4, "revisit", 4), (None, "revisit", 4), (None, "response", None),
                          (None, "revisit", None)], key=repr)
    assert warc(df.where("false")).count() == 0
    assert os.path.isdir(SF)
