"""Hand-made ERP fixtures: rows by column name, everything else NULL."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from balancete.sources.erp import ErpTables
from balancete.sources.schemas import ERP_SCHEMAS


def erp_df(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = ERP_SCHEMAS[name]
    data = []
    for r in rows:
        unknown = set(r) - set(schema.fieldNames())
        assert not unknown, f"{name}: unknown columns {unknown}"
        vals = []
        for f in schema.fields:
            v = r.get(f.name)
            if v is not None and f.dataType.typeName() == "decimal":
                v = Decimal(v)
            vals.append(v)
        data.append(tuple(vals))
    return spark.createDataFrame(data, schema)


def erp(spark: SparkSession, **tables: list[dict]) -> ErpTables:
    out = {n: erp_df(spark, n, []) for n in ERP_SCHEMAS}
    for n, rows in tables.items():
        out[n] = erp_df(spark, n, rows)
    return ErpTables(out)


def code(sy, rt, ky, dl="", sp=None):
    return {"DRSY": sy, "DRRT": rt, "DRKY": ky, "DRDL01": dl, "DRSPHD": sp}
