"""Quality, line dedup, mixing, decontamination: oracle SQL on the test tables, and edge cases."""

import os
import random

import duckdb
import pytest

import corpus_pipeline
from balancete.llm import oracle, queries
from balancete.llm.common import prefix_sum
from balancete.llm.decontaminate import decontaminate
from balancete.llm.line_dedup import line_dedup, line_dedup_documents
from balancete.llm.mixing import mix
from balancete.llm.quality import quality, quality_documents

SF = "/root/testdata/sf0.001"


def run_sql(sql, documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{documents}'")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    cur = con.execute(sql)
    return [c[0] for c in cur.description], cur.fetchall()


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """The test documents and awkward ones: nulls, ties, hot lines, odd white space, a long text."""
    rng = random.Random(4)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(300)) for _ in range(n))
    hot = "This very line stands in many documents of one host"
    rows = [(10_000 + i, "\n".join([hot, prose(12 if i % 4 else 2), "  " + hot.upper() + "\t"]), "en", "hot" if i % 3 else None, 1) for i in range(90)]
    rows += [(20_001, None, None, None, None), (20_002, "", "en", "src1", 0), (20_003, "\n\n \x0b\n", "en", "src1", 4),
             (20_004, "one two three four five " * 30, "en", "src1", 9), (20_005, "É" * 12 + "\n" + "é" * 12 + "\nÀ b", "fr", "ÿ", 9),
             (20_006, "é" * 12 + "\r\nAAAAAAAAAAAA", "fr", "ÿ", 9), (20_007, "\n".join(prose(9) for _ in range(4000)), "en", "src1", 9)]
    base = spark.read.parquet(f"{SF}/documents.parquet")
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    base.unionByName(spark.createDataFrame(rows, base.schema)).coalesce(3).write.parquet(path)
    return path


# The other two have tests over tables of their own.
@pytest.mark.parametrize("name", sorted(set(oracle.SQL) - {"op12_hard_negatives", "op13_warc"}))
def test_query_equals_sql(spark, awkward, name):
    folder = os.path.dirname(awkward)
    if not os.path.exists(f"{folder}/benchmark.parquet"):
        os.symlink(f"{SF}/benchmark.parquet", f"{folder}/benchmark.parquet")
    got = queries.QUERIES[name](spark, folder)
    cols, want = run_sql(oracle.SQL[name], f"{awkward}/*.parquet")
    assert sorted(cols) == sorted(got.columns)
    rows = [tuple(r) for r in got.select(*cols).collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_clashing_columns_nulls_and_repeats(spark):
    df = spark.createDataFrame(
        [(1, "shared line of text\nown words here", "a", "p", 1, 2), (2, "Shared LINE of text\nother words here", "a", "q", 3, 4),
         (2, "Shared LINE of text\nother words here", "a", "q", 3, 4), (None, "shared line of text", None, "r", 5, 6), (4, None, None, None, None, None)],
        "doc_id long, text string, source string, kept string, n_lines long, _pos long")
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup(df).collect()), key=repr)
    assert got == sorted([(1, 2, 0, "shared line of text\nown words here"), (2, 2, 1, "other words here"), (2, 2, 1, "other words here"),
                          (None, 1, 1, ""), (4, 1, 0, "")], key=repr)
    assert line_dedup_documents(df).columns == df.columns
    assert quality_documents(df).columns == df.columns
    assert quality(df).count() == 5 and mix(df).count() == 5
    for empty in (df.where("false"),):
        assert quality(empty).count() == line_dedup(empty).count() == mix(empty).count() == 0
        assert quality_documents(empty).count() == line_dedup_documents(empty).count() == 0


def test_boilerplate_lines_go_and_depleted_documents_are_rejected(spark):
    hot = "read more about our cookie policy and terms of use on this page now"
    own = [f"document {i} says something of its own in line {i} with words enough to stay here" for i in range(60)]
    rows = [(i, f"{hot}\n{own[i]}", "h") for i in range(40)] + [(100 + i, f"{hot}\n{own[40 + i]}", "other") for i in range(3)]
    rows += [(200 + i, f"{hot}\nonly few words {i}", "h") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.text for r in quality_documents(df).collect()}
    # A line that all three documents of a small host hold is above the share there as well.
    assert kept == {**{i: own[i] for i in range(40)}, **{100 + i: own[40 + i] for i in range(3)}}


def test_short_lines_and_small_hosts_count(spark):
    menu = "Home\nLog in\nShare\nMenu"
    own = lambda i: f"text {i} of one host with more than ten words of its very own in number {i}"
    rows = [(i, f"{menu}\n{own(i)}", "h") for i in range(100)] + [(100 + i, f"{menu}\n{menu}\nonly {i}\n{menu}", "h") for i in range(20)]
    rows += [(200 + i, f"OK\n{own(200 + i)}", "two") for i in range(2)] + [(300, own(300), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality(df).collect()}
    assert all(got[i].n_boilerplate_words == 5 and got[i].kept for i in range(100))
    assert all(got[100 + i].depleted and not got[100 + i].kept for i in range(20))
    assert all(got[200 + i].n_boilerplate_words == 0 and got[200 + i].kept for i in range(2))
    kept = {r.doc_id: r.text for r in quality_documents(df).collect()}
    assert kept == {**{i: own(i) for i in range(100)}, **{200 + i: f"OK\n{own(200 + i)}" for i in range(2)}, 300: own(300)}


def test_copies_of_a_text_do_not_make_its_lines_frequent(spark):
    text = "the same article copied by very many pages of one host\nwith a second line that is long enough to count as one"
    df = spark.createDataFrame([(i, text, "h") for i in range(200)], "doc_id long, text string, source string")
    assert quality(df).where("kept").count() == 200


def test_mix_reaches_targets_and_is_stable(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), "abcd"[min(3, rng.randrange(9) // 2)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mix(df).collect()
    again = mix(df.repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in first} == {(r.doc_id, r.taken) for r in again}
    assert sum(r.taken for r in first) <= sum(r.size for r in first)
    for s in "abcd":
        mine = [r for r, row in ((r, rows[r.doc_id]) for r in first) if row[2] == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 41
        assert all(r.taken <= 3 * r.size for r in mine)


def test_prefix_sum_over_hot_key(spark):
    df = spark.range(1000).selectExpr("id", "if(id < 700, 0, id) AS k", "id % 7 AS v")
    got = {r.id: r.c for r in prefix_sum(df.repartition(5), ["k", "id"], "v", "c").collect()}
    total = 0
    for i in range(1000):
        total += i % 7
        assert got[i] == total


def test_decontaminate_shards_offsets_and_edges(spark):
    items = spark.createDataFrame([("a", "Alpha beta-gamma, delta! epsilon zeta eta theta iota kappa lambda"), ("b", "short one"), ("b", "short one"),
                                   ("c", None), (None, "null item words"), ("d", " ... ")], "item_id string, text string")
    docs = spark.createDataFrame(
        [(1, "É! ALPHA beta gamma delta epsilon zeta eta theta iota KAPPA x", 0), (2, "a Short\n\tONE b short two", 0), (3, None, 0),
         (4, "null item words", 0), (None, "beta gamma delta epsilon zeta eta theta iota kappa lambda", 0), (6, "shorter one", 0), (7, "pad " * 50000 + "short one", 0)],
        "doc_id long, text string, n_hit int")
    want = {(1, 12, 10, ("a",), ((3, 59),)), (2, 6, 2, ("b",), ((2, 12),)), (3, 0, 0, (), ()), (4, 3, 3, (), ((0, 15),)),
            (None, 10, 10, ("a",), ((0, 57),)), (6, 2, 0, (), ()), (7, 50002, 2, ("b",), ((200000, 200009),))}
    for size in (1 << 20, 60):
        got = {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple((s.start, s.end) for s in r.spans))
               for r in decontaminate(docs, items, max_shard_bytes=size).collect()}
        assert got == want
    clean = decontaminate(docs, items, keep_row=True)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {3, 6}
    assert decontaminate(docs, items.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate(docs.where("false"), items).count() == 0


def test_pipeline_runs_every_stage(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash", "decontaminate", "mixing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes, now = [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, SF).collect(), docs.schema)
        sizes.append(now.count())
        assert now.columns == docs.columns
    assert docs.count() >= sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    ran = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, ran.collect()))
