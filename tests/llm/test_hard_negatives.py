"""Hard negatives: table scores against matrix products, SQL over whole awkward tables, defined cases."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from balancete.llm import hard_negatives as H
from balancete.llm import oracle, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, score long, q string"
NAN, INF = float("nan"), float("inf")


def run_sql(path):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet/*.parquet'")
    cur = con.execute(oracle.SQL["op12_hard_negatives"])
    return [c[0] for c in cur.description], sorted(cur.fetchall(), key=repr)


def same_as_sql(spark, df, path):
    df.write.parquet(f"{path}/embeddings.parquet")
    got = queries.QUERIES["op12_hard_negatives"](spark, path)
    cols, want = run_sql(path)
    assert sorted(cols) == sorted(got.columns)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == want
    return want


@pytest.mark.parametrize("dims,most", [(1, 1), (7, 200), (64, 256), (20, 1 << 20), (9, 1 << 27)])
def test_scores_are_exact(dims, most):
    rng = np.random.default_rng(dims)
    y = rng.integers(-most, most + 1, (1500, dims))
    y[0], y[1] = most, -most
    q = rng.integers(-most, most + 1, (5, dims))
    assert (H._score(H._planes(y), q) == q @ y.T).all()


def test_scores_beyond_a_long_are_an_error():
    big = np.full((2, 4), 1 << 33)
    with pytest.raises(OverflowError):
        H._score(H._planes(big), big)


def test_query_equals_sql(spark, tmp_dir):
    base = spark.read.parquet(f"{SF}/embeddings.parquet")
    v = [r.embedding for r in base.orderBy("vec_id").limit(9).collect()]
    rows = [(9001, None, 1), (9002, [None] * 64, 1), (9003, [NAN] + [0.1] * 63, 1), (9004, [INF] * 64, 1), (9005, [], 1),
            (9006, v[1], None), (None, v[0], 4), (None, v[0], 5), (100, v[2], 3), (200, [0.0] * 64, 2), (9007, [0.0] * 64, 2),
            (9008, [0.0] * 64, 3), (300, [-x for x in v[3]], 8), (9010, [3.0] * 64, 7), (9100, [3.0] * 64, 7)]
    rows += [(9200 + i, v[4], i % 3) for i in range(260)]
    want = same_as_sql(spark, base.unionByName(spark.createDataFrame(rows, base.schema)), tmp_dir)
    assert len(want) > 50


def test_repeated_anchors_and_clashing_columns(spark, tmp_dir):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=3)], i % 2, 0, "x") for i in range(40)]
    rows += [rows[0]] * 7 + [(0, [1.0, 0.0, 0.0], 1, 0, "x")] * 2
    want = same_as_sql(spark, spark.createDataFrame(rows, SCHEMA), tmp_dir)
    assert len({r[0] for r in want}) == 1


def test_blocks_are_cut_anywhere(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(H, "ANCHORS", 2)
    monkeypatch.setattr(H, "CANDIDATES", 16)
    base = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 3 = 0 OR vec_id % 100 = 0")
    same_as_sql(spark, base, tmp_dir)


def test_empty_tables_and_no_anchors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0, 0, "")], SCHEMA)
    run = lambda d: H.hard_negatives(d, F.col("vec_id") % 100 == 0, F.col("label"))
    assert run(df).count() == run(df.where("false")).count() == 0
    alone = spark.createDataFrame([(100, [1.0, 2.0], 0, 0, "")], SCHEMA)
    assert run(alone).count() == 0
    with pytest.raises(Exception, match="several lengths"):
        run(alone.union(df.select("vec_id", F.array(F.lit(1.0).cast("float")).alias("embedding"), "label", "score", "q"))).collect()
