import datetime as dt
from decimal import Decimal

from balancete.plans.ledger import conform, income_statement
from balancete.plans.params import PeriodParams
from balancete.sources.schemas import LEDGER_COLUMNS


def _ledger(spark, rows):
    cols = ["DATA_LANCAMENTO", "VALOR_TRANSACAO", "CONTA", "CONTA_I", "CONTA_ESTRUTURA",
            "DESCRICAO_CONTA_II", "CONTA_COMPLETA"]
    df = spark.createDataFrame(rows, "d date, v decimal(38,4), c string, ci string, ce string, dc string, cc string")
    df = df.toDF(*cols)
    for c in LEDGER_COLUMNS:
        if c not in cols:
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit(None))
    return conform(df)


def test_groups_nulls_and_order(spark):
    d = dt.date(2016, 1, 5)
    led = _ledger(spark, [
        (d, Decimal("1.5"), "B", "x", "1", "d", "c"),
        (d, Decimal("2.5"), "B", "x", "1", "d", "c"),
        (d, None, "A", None, "2", "d", "c"),
        (d, Decimal("9"), None, "y", "3", "d", "c"),
        (dt.date(2016, 2, 1), Decimal("100"), "A", "z", "4", "d", "c"),   # outside the month
        (d, Decimal("1"), "A  ", "z", "5", "d", "c"),                        # padding keeps groups apart
    ])
    rows = income_statement(led, PeriodParams.month(2016, 1)).collect()
    assert [(r.CONTA, r.VALOR_DRE) for r in rows] == [
        ("A", None), ("A  ", Decimal("1.0000")), ("B", Decimal("4.0000")), (None, Decimal("9.0000"))]
    assert {r.COMPETENCIA for r in rows} == {"2016-01"}
    trimmed = income_statement(led, PeriodParams.month(2016, 1), trim_labels=True).collect()
    assert [r.CONTA for r in trimmed] == ["A", "A", "B", None]


def test_ledger_dispatch_rejects_unknown_source():
    import pytest

    from balancete.plans.ledger import ledger
    with pytest.raises(ValueError):
        ledger(None, "weekly", None)


def test_statement_total_equals_ledger_total(spark):
    import os

    import pytest
    from pyspark.sql import functions as F

    from balancete import registry
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    t = registry.tables_for(spark, sf)
    from balancete.plans.ledger import ledger_for_period
    led = ledger_for_period(t, registry.PERIOD)
    dre = income_statement(led, registry.PERIOD, sort=False)
    d = F.col("DATA_LANCAMENTO")
    in_month = led.where((d >= F.lit(registry.PERIOD.date_from)) & (d < F.lit(registry.PERIOD.date_to)))
    assert dre.select(F.sum("VALOR_DRE")).first()[0] == in_month.select(F.sum("VALOR_TRANSACAO")).first()[0]
    # every ledger row of the month lands in exactly one statement group
    assert in_month.count() > dre.count() > 0
