import pytest
from pyspark.sql import functions as F

from balancete.operators.lookups import (DuplicateLookupKey, center_hierarchy, checked_lookup,
                                         code_lookup, item_dimension)
from balancete.plans.config import LedgerConfig

from .helpers import code, erp


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blank_key_never_matches(spark):
    t = erp(spark, F4101=[{"IMLITM": "1", "IMSRP1": "0", "IMSRP2": "   "}],
            F0005=[code("41", "S2", "  ", "BLANK")])
    dim = item_dimension(t).collect()
    assert len(dim) == 1 and dim[0].TAMANHO is None


def test_trimmed_key_and_padded_coordinates(spark):
    t = erp(spark, F0005=[code("09  ", "09", "  7       ", "Despesas" + " " * 22)])
    df = spark.createDataFrame([("a", " 7 ")], "id string, k string")
    r = code_lookup(df, F.col("k"), "09", "09", "CONTA", tables=t).first()
    assert r.CONTA == "Despesas" + " " * 22  # padding of the label is kept


def test_duplicate_lookup_key_raises(spark):
    t = erp(spark, F0005=[code("09", "09", "1", "A"), code("09", "09", " 1 ", "B")])
    df = spark.createDataFrame([("a", "1")], "id string, k string")
    with pytest.raises(DuplicateLookupKey):
        code_lookup(df, F.col("k"), "09", "09", "CONTA", tables=t)


def test_broadcast_only_when_checked_small(spark):
    big = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    fact = spark.range(1000).select((F.col("id") % 100).alias("k2"))
    small = checked_lookup(big, ["k"], max_bytes=1 << 20)
    assert "BroadcastHashJoin" in _plan(fact.join(small, F.col("k2") == F.col("k")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = checked_lookup(big, ["k"], max_bytes=400)
        plan = _plan(fact.join(large, F.col("k2") == F.col("k")))
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unmatched_unit(spark):
    t = erp(spark, F0006=[{"MCMCU": "         100", "MCDL01": "UNIT", "MCRP04": "200"},
                          {"MCMCU": "         200", "MCDL01": "PARENT"}])
    df = spark.createDataFrame([("a", "         100"), ("b", "         999")], "id string, u string")
    rows = {r.id: r for r in center_hierarchy(df, t, "u").collect()}
    assert rows["a"].CENTRO_CUSTO == "         100 UNIT" and rows["a"].FILIAL == "200 PARENT"
    assert rows["b"].CENTRO_CUSTO == " " and rows["b"].FILIAL is None


def test_unused_unique_lookup_is_removed_from_plan(spark):
    t = erp(spark, F0005=[code("09", "09", "1", "A")])
    df = spark.createDataFrame([("a", "1")], "id string, k string")
    out = code_lookup(df, F.col("k"), "09", "09", "CONTA", tables=t).select("id")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_only_the_slices_in_use_are_checked(spark):
    t = erp(spark, F0005=[code("09", "09", "1", "A"), code("77", "XX", "1", "B"), code("77", "XX", "1", "C")])
    df = spark.createDataFrame([("a", "1")], "id string, k string")
    assert code_lookup(df, F.col("k"), "09", "09", "CONTA", tables=t).first().CONTA.strip() == "A"
    assert ("77", "XX") not in t.stats["F0005 slices"] and t.stats["F0005 slices"]["09", "09"] == (1, 1)
    with pytest.raises(DuplicateLookupKey):
        code_lookup(df, F.col("k"), "77", "XX", "CONTA", tables=t)


def test_refresh_forgets_checks(spark):
    t = erp(spark, F0005=[code("09", "09", "1", "A")])
    df = spark.createDataFrame([("a", "1")], "id string, k string")
    code_lookup(df, F.col("k"), "09", "09", "CONTA", tables=t)
    t.tables["F0005"] = erp(spark, F0005=[code("09", "09", "1", "A"), code("09", "09", "1 ", "B")])["F0005"]
    t.refresh()
    with pytest.raises(DuplicateLookupKey):
        code_lookup(df, F.col("k"), "09", "09", "CONTA", tables=t)
