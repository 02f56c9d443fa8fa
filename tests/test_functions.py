import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from balancete.functions import (code_eq, decode_cyyddd, encode_cyyddd, encode_date, fit,
                                 not_in_or_null, ocat, otrim, parse_percent, trimmed_not_in)
from balancete.plans.params import DetailParams, PeriodParams


def test_decode_known_codes(spark):
    codes = [116001, 116031, 116366, 99365, 124060]
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    got = {r.c: r.d for r in df.select("c", decode_cyyddd("c").alias("d")).collect()}
    assert got == {116001: dt.date(2016, 1, 1), 116031: dt.date(2016, 1, 31),
                   116366: dt.date(2016, 12, 31), 99365: dt.date(1999, 12, 31),
                   124060: dt.date(2024, 2, 29)}


def test_encode_decode_roundtrip(spark):
    df = spark.range(0, 3000).select(F.date_add(F.lit(dt.date(1998, 1, 1)), F.col("id").cast("int")).alias("d"))
    bad = df.where(decode_cyyddd(encode_cyyddd("d")) != F.col("d")).count()
    assert bad == 0
    assert encode_date(dt.date(2016, 1, 31)) == 116031


def test_period_params_derive_everything():
    p = PeriodParams.month(2016, 1)
    assert (p.jul_from, p.jul_to, p.fiscal_year, p.period) == (116001, 116031, 116, 1)
    assert p.months() == [(2016, 1)]
    q = PeriodParams(dt.date(2015, 11, 1), dt.date(2016, 3, 1))
    assert q.months() == [(2015, 11), (2015, 12), (2016, 1), (2016, 2)]
    assert PeriodParams.month(2000, 12).date_to == dt.date(2001, 1, 1)
    assert DetailParams(dt.date(2021, 1, 1)).jul_from == 121001


def test_percent_formats(spark):
    vals = ["20", "20,5", "20%", " 7.25% ", "", "  ", "x", "1.2.3", None, "-5"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = [r.p for r in df.orderBy("i").select(parse_percent("s").alias("p")).collect()]
    assert got == [Decimal("20"), Decimal("20.5"), Decimal("20"), Decimal("7.25")] + [None] * 6


def test_blank_and_null_rules(spark):
    df = spark.createDataFrame([("   ", None, "a" * 40, "AA  ")], "b string, n string, long string, c string")
    r = df.select(
        otrim("b").alias("t"),
        ocat(F.col("n"), " ", F.col("n")).alias("sp"),
        ocat(F.col("n"), F.col("n")).alias("empty"),
        fit("long", 30).alias("fit"),
        code_eq("c", "AA").alias("eq"),
        not_in_or_null("n", ["x"]).alias("null_passes"),
        trimmed_not_in("b", ["x"]).alias("blank_fails"),
    ).first()
    assert r.t is None and r.sp == " " and r.empty is None
    assert r.fit == "a" * 30 and r.eq is True
    assert r.null_passes is True and r.blank_fails is None


def test_rates_keep_their_digits(spark):
    from balancete.functions import apply_rate
    df = spark.createDataFrame([(1, "33,3333333333", Decimal("100000000.00")), (2, "1234567", Decimal("2.50")), (3, "12345678901234.123456789012%", Decimal("-1.00")),
                                (4, "0,00005", Decimal("1.00")), (5, "99.99995", Decimal("0.01"))], "i int, s string, a decimal(20,2)")
    got = {r.i: (r.p, r.v) for r in df.select("i", parse_percent("s").alias("p"), apply_rate("a", parse_percent("s")).alias("v")).collect()}
    import decimal
    ctx = decimal.Context(prec=80, rounding=decimal.ROUND_HALF_UP)
    for i, text, a in [(r.i, r.s, r.a) for r in df.collect()]:
        rate = Decimal(text.strip("%").replace(",", "."))
        assert got[i][0] == rate
        assert got[i][1] == ctx.multiply(ctx.multiply(a, rate), Decimal("0.01")).quantize(Decimal("0.0001"), context=ctx)


def test_a_range_that_starts_mid_month_holds_that_month():
    assert PeriodParams(dt.date(2016, 1, 15), dt.date(2016, 3, 1)).months() == [(2016, 1), (2016, 2)]
    assert PeriodParams(dt.date(2016, 12, 31), dt.date(2017, 1, 2)).months() == [(2016, 12), (2017, 1)]


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    import pytest

    from balancete import session

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_remove_shared(spark):
    import os

    from balancete.session import remove_shared, shared_scratch_path
    path = shared_scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    remove_shared(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_rates_out_of_range_raise(spark):
    for text in ("123456789012345%", "0,1234567890123"):
        with pytest.raises(Exception, match="percentage out of range"):
            spark.createDataFrame([(text,)], "s string").select(parse_percent("s")).collect()
    held = ["00012345678901234", "1,1234567890120000%", "99999999999999.999999999999"]
    got = [r.p for r in spark.createDataFrame([(x,) for x in held], "s string").select(parse_percent("s").alias("p")).collect()]
    assert got == [Decimal("12345678901234"), Decimal("1.123456789012"), Decimal("99999999999999.999999999999")]
