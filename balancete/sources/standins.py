"""ERP-shaped stand-in tables built from the driver's TPC-H-like tables.

The ledger jobs read twelve ERP tables that the test data does not contain.
Each stand-in is a deterministic Spark derivation of a driver table
(FIXTURES.md §4), so its size grows with the scale factor, and the same
mapping is written once more in DuckDB SQL for the oracle
(``balancete.oracle``). Blank keys, NULL amounts, unmatched lookups, padded
codes and excluded accounts are planted on purpose so the blank/NULL rules
of SURVEY §1.5 are exercised by the real queries.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import encode_cyyddd
from .erp import ErpTables
from .schemas import ERP_SCHEMAS

CENTS = "decimal(20,0)"

# Fixed values of the stand-in data (not reference values): company and
# document-type constants shared by header, lines and detail tables.
FISCAL_COMPANY = "00001"
DOC_TYPE = "NS"
DOC_SUFFIX = 1
DOC_SERIES = "1  "

# Sales / return document types planted in the line stand-in, by order key mod 9.
_SALES_TYPE_BY_MOD9 = ["AV", "S1", "S6", "S7", "SA", "SJ", "SM", "SO", "ZZ"]
# Next-status codes by order key mod 7, last-status codes by line number mod 4.
_NEXT_STATUS_BY_MOD7 = ["615", "610", "617", "620", "999", "994", "996"]
_LAST_STATUS_BY_MOD4 = ["600", "615", "620", "999"]

# Operation nature (return flag, line status, company) -> CFOP. One CFOP is
# 1949, which the returns and PIS/COFINS branches exclude.
NATURE_ROWS = [
    ("A", "F", FISCAL_COMPANY, 5101), ("A", "O", FISCAL_COMPANY, 5102),
    ("N", "F", FISCAL_COMPANY, 6101), ("N", "O", FISCAL_COMPANY, 6102),
    ("R", "F", FISCAL_COMPANY, 1202), ("R", "O", FISCAL_COMPANY, 1949),
    ("A", "F", "00002", 9999),
]

# Code-table rows of the stand-in (keys are right-padded to 10 at build time,
# descriptions to 30). ('09','09') -> CONTA, ('09','10') -> CONTA_I,
# ('00','49') / ('00','50') -> allocation percentages as text.
ACCOUNT_GROUP_ROWS = [
    ("09", "09", "0", "Faturamento Bruto", None),
    ("09", "09", "1", "(-) IMPOSTOS FATURADO", None),
    ("09", "09", "2", "DESPESAS OPERACIONAIS", None),
    ("09", "09", "3", "CUSTO DOS PRODUTOS VENDIDOS", None),
    ("09", "09", "4", "(-) ABATIMENTOS DA RECEITA", None),
    ("09", "10", "0", "Devoluções", None),
    ("09", "10", "1", "Receita Mercado Interno", None),
    ("09", "10", "2", "Despesas Gerais", None),
    ("09", "10", "3", "Impostos s/ Vendas", None),
    ("00", "49", "1", "RATEIO BALOES 1", "20"),
    ("00", "49", "2", "RATEIO BALOES 2", "20,5"),
    ("00", "49", "3", "RATEIO BALOES 3", "20%"),
    ("00", "49", "4", "RATEIO BALOES 4", " 7.25% "),
    ("00", "49", "5", "RATEIO BALOES 5", "x"),
    ("00", "49", "6", "RATEIO BALOES 6", "  "),
    ("00", "49", "7", "RATEIO BALOES 7", "1.2.3"),
    ("00", "49", "8", "RATEIO BALOES 8", "33,3333333333"),
    ("00", "49", "9", "RATEIO BALOES 9", "1234567"),
    ("00", "50", "1", "RATEIO MULTIUSO 1", "30"),
    ("00", "50", "2", "RATEIO MULTIUSO 2", "12,5%"),
    ("00", "50", "3", "RATEIO MULTIUSO 3", "-5"),
    ("41", "S2", " ", "SEM TAMANHO", None),
]
ITEM_CATEGORY_TYPES = ["S1", "S2", "S3", "S4", "S5"]
ITEM_CATEGORY_NAMES = ["LINHA", "TAMANHO", "TIPO", "COR", "EMBALAGEM"]

# Tax codes in the per-line tax detail and their share of the line value.
TAX_CODE_SHARES = [("05", Decimal("0.0165")), ("06", Decimal("0.0760")), ("99", Decimal("0.0100"))]
DIFAL_SHARE = Decimal("0.02")


def _case(expr: Column, values: list) -> Column:
    """CASE expr WHEN 0 THEN values[0] WHEN 1 ... (values indexed by expr)."""
    out = None
    for i, v in enumerate(values):
        out = F.when(expr == i, F.lit(v)) if out is None else out.when(expr == i, F.lit(v))
    return out


def _cents(c: Column) -> Column:
    """Exact cents of a 2-decimal double column."""
    return (c.cast("decimal(18,2)") * 100).cast(CENTS)


def _conform(df: DataFrame, name: str) -> DataFrame:
    schema = ERP_SCHEMAS[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _signed_order_cents() -> Column:
    c = _cents(F.col("o_totalprice"))
    return F.when(F.col("o_orderstatus") == "F", -c).otherwise(c)


def build_standins(spark: SparkSession, sf_dir: str) -> ErpTables:
    """Derive all twelve ERP tables from ``{sf_dir}/*.parquet`` (lazy plans)."""
    rd = lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet")
    region, nation, customer = rd("region"), rd("nation"), rd("customer")
    supplier, part, orders, lineitem = rd("supplier"), rd("part"), rd("orders"), rd("lineitem")

    t: dict[str, DataFrame] = {}

    t["F0010"] = _conform(region.select(
        F.concat(F.lit("0000"), F.col("r_regionkey").cast("string")).alias("CCCO"),
        F.col("r_name").alias("CCNAME")), "F0010")

    sk = F.col("s_suppkey")
    t["F0006"] = _conform(supplier.select(
        F.lpad(sk.cast("string"), 12, " ").alias("MCMCU"),
        F.col("s_name").alias("MCDL01"),
        F.when(sk % 10 == 0, F.lit("   ")).otherwise((sk - sk % 10).cast("string")).alias("MCRP04"),
        F.rpad((F.col("s_nationkey") % 10).cast("string"), 3, " ").alias("MCRP49"),
        F.rpad((F.col("s_nationkey") % 5).cast("string"), 3, " ").alias("MCRP50"),
    ), "F0006")

    literal_codes = spark.createDataFrame(ACCOUNT_GROUP_ROWS, "DRSY string, DRRT string, k string, d string, DRSPHD string")
    literal_codes = literal_codes.select(
        "DRSY", "DRRT", F.rpad("k", 10, " ").alias("DRKY"), F.rpad("d", 30, " ").alias("DRDL01"), "DRSPHD")
    item_types = F.array(*[F.struct(F.lit(rt).alias("rt"), F.lit(nm).alias("nm"))
                           for rt, nm in zip(ITEM_CATEGORY_TYPES, ITEM_CATEGORY_NAMES)])
    item_codes = (nation.select("n_nationkey", "n_name", F.explode(item_types).alias("t"))
                  .select(F.lit("41").alias("DRSY"), F.col("t.rt").alias("DRRT"),
                          F.rpad(F.col("n_nationkey").cast("string"), 10, " ").alias("DRKY"),
                          F.rpad(F.concat_ws(" ", F.col("t.nm"), F.col("n_name")), 30, " ").alias("DRDL01"),
                          F.lit(None).cast("string").alias("DRSPHD")))
    t["F0005"] = _conform(literal_codes.unionByName(item_codes), "F0005")

    pk, psz = F.col("p_partkey"), F.col("p_size")
    t["F4101"] = _conform(part.select(
        pk.cast("string").alias("IMLITM"),
        F.rpad(F.when(psz % 7 == 6, F.lit("L")).otherwise((psz % 7).cast("string")), 3, " ").alias("IMSRP1"),
        F.when(psz % 9 == 0, F.lit("   ")).otherwise(F.rpad((psz % 30).cast("string"), 3, " ")).alias("IMSRP2"),
        (F.length("p_type") % 25).cast("string").alias("IMSRP3"),
        (F.length("p_name") % 27).cast("string").alias("IMSRP4"),
        F.when(pk % 11 == 0, F.lit(None)).otherwise((F.length("p_brand") * 3 % 25).cast("string")).alias("IMSRP5"),
    ), "F4101")

    ck, seg = F.col("c_custkey"), F.col("c_mktsegment")
    blank_acct = ck % 50 == 7
    obj = (F.when(seg == "AUTOMOBILE", "311210").when(seg == "BUILDING", "410100")
           .when(seg == "FURNITURE", "510120").when(seg == "HOUSEHOLD", "320100").otherwise("610300"))
    sub = F.lpad((F.col("c_nationkey") % 5).cast("string"), 3, "0")
    t["F0901"] = _conform(customer.select(
        ck.cast("string").alias("GMAID"),
        F.when(blank_acct, F.lit("   ")).otherwise(F.concat(F.lit("100."), obj, F.lit("."), sub)).alias("GMANI"),
        F.when(blank_acct, F.lit(" " * 6)).otherwise(F.rpad(obj, 6, " ")).alias("GMOBJ"),
        F.when(blank_acct, F.lit(" " * 8)).otherwise(F.rpad(sub, 8, " ")).alias("GMSUB"),
        F.rpad("c_name", 30, " ").alias("GMDL01"),
        F.concat(F.lit("0000"), (F.col("c_nationkey") % 6).cast("string")).alias("GMCO"),
        F.lpad((ck % 120).cast("string"), 12, " ").alias("GMMCU"),
        (F.col("c_nationkey") % 6).cast("string").alias("GMR009"),
        (ck % 5).cast("string").alias("GMR010"),
    ), "F0901")

    od = F.col("o_orderdate")
    ledger_type = F.when(F.col("o_orderstatus") == "P", F.lit("BA  ")).otherwise(F.lit("AA  "))
    month_sums = [F.sum(F.when(F.month(od) == m, _signed_order_cents())).cast(CENTS).alias(f"GBAN{m:02d}")
                  for m in range(1, 13)]
    t["F0902"] = _conform(
        orders.groupBy(F.col("o_custkey").cast("string").alias("GBAID"), ledger_type.alias("GBLT"),
                       (F.year(od) - 1900).alias("GBFY"))
        .agg(*month_sums)
        .withColumn("GBAN13", F.lit(None).cast(CENTS)).withColumn("GBAN14", F.lit(None).cast(CENTS)),
        "F0902")

    t["F0911"] = _conform(orders.select(
        F.col("o_custkey").cast("string").alias("GLAID"),
        encode_cyyddd(od).alias("GLDGJ"),
        F.lit("JE").alias("GLDCT"),
        F.col("o_orderkey").alias("GLDOC"),
        _signed_order_cents().alias("GLAA"),
        F.concat(F.lit("100."), F.col("o_custkey").cast("string")).alias("GLANI"),
        F.concat_ws(" ", F.lit("PEDIDO"), F.col("o_orderpriority"), F.lit("NUM"),
                    F.col("o_orderkey").cast("string")).alias("GLEXA"),
        F.lit("AA  ").alias("GLLT"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" ")).otherwise(F.lit("P")).alias("GLPOST"),
    ), "F0911")

    t["F7601B"] = _conform(orders.select(
        F.lit(FISCAL_COMPANY).alias("FHFCO"), F.col("o_orderkey").alias("FHBNNF"),
        F.lit(DOC_TYPE).alias("FHDCT"), F.lit(DOC_SUFFIX).alias("FHN001"),
        encode_cyyddd(od).alias("FHISSU")), "F7601B")

    t["F7611B"] = _conform(_document_lines(lineitem), "F7611B")
    lines = t["F7611B"]

    codes = F.array(*[F.struct(F.lit(code).alias("code"), F.lit(share).alias("share"))
                      for code, share in TAX_CODE_SHARES])
    t["F76B011"] = _conform(
        lines.select("FDBNNF", "FDBSER", "FDDCT", "FDN001", "FDUKID", "FDAEXP", F.explode(codes).alias("c"))
        .select(F.col("FDBNNF").alias("TDBNNF"), F.col("FDBSER").alias("TDBSER"),
                F.col("FDDCT").alias("TDDCT"), F.col("FDN001").alias("TDN001"),
                F.col("FDUKID").alias("TDUKID"), F.col("c.code").alias("TDBRTX"),
                F.round(F.col("FDAEXP") * F.col("c.share"), 0).alias("TDBRTXA")),
        "F76B011")

    t["F5576007"] = _conform(
        lines.where(F.col("FDUKID") % 2 == 0)
        .select(F.col("FDBNNF").alias("DFBNNF"), F.col("FDDCT").alias("DFDCT"),
                F.col("FDN001").alias("DFN001"), F.col("FDBSER").alias("DFBSER"),
                F.col("FDUKID").alias("DFUKID"),
                F.round(F.col("FDAEXP") * F.lit(DIFAL_SHARE), 0).alias("DFBICM")),
        "F5576007")

    t["F76B200"] = _conform(
        spark.createDataFrame(NATURE_ROWS, "DPBNOP string, DPBSOP string, DPFCO string, DPBRNOP int"),
        "F76B200")
    return ErpTables(t)


def _document_lines(lineitem: DataFrame) -> DataFrame:
    """One fiscal-document line per (order, line number).

    The raw pair is not unique, so lines are summed first (partial aggregation
    happens before the shuffle). Amounts are exact decimal cents.
    """
    ext = F.col("l_extendedprice").cast("decimal(18,2)") * 100
    tax = F.col("l_tax").cast("decimal(4,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    st_amount = (F.when(tax >= F.lit(Decimal("0.06")), F.round(ext * tax * F.lit(Decimal("0.25")), 0))
                 .when(tax >= F.lit(Decimal("0.02")), F.lit(Decimal("0"))))
    g = (lineitem.groupBy(ok.alias("FDBNNF"), ln.cast("long").alias("FDUKID"))
         .agg(F.max("l_returnflag").alias("rf"), F.max("l_linestatus").alias("ls"),
              F.min("l_partkey").alias("partkey"), F.min("l_suppkey").alias("suppkey"),
              F.sum(ext).alias("FDAEXP"),
              F.sum(F.round(ext * tax * F.lit(Decimal("0.5")), 0)).alias("FDBIPI"),
              F.sum(st_amount).alias("FDBVIS"),
              F.sum(F.round(ext * disc, 0)).alias("FDBDIZ"),
              F.sum(F.round(ext * tax, 0)).alias("FDBICM")))
    rf, ls, key = F.col("rf"), F.col("ls"), F.col("FDBNNF")
    doc_type = (F.when(rf == "R", F.when(ls == "F", F.lit("VX")).otherwise(F.lit("VR")))
                .when((rf == "A") & (ls == "F"), F.lit("SX"))
                .otherwise(_case(key % 9, _SALES_TYPE_BY_MOD9)))
    return g.select(
        F.lit(FISCAL_COMPANY).alias("FDFCO"), "FDBNNF", F.lit(DOC_TYPE).alias("FDDCT"),
        F.lit(DOC_SUFFIX).alias("FDN001"), F.lit(DOC_SERIES).alias("FDBSER"), "FDUKID",
        doc_type.alias("FDPDCT"),
        _case(key % 7, _NEXT_STATUS_BY_MOD7).alias("FDNXTR"),
        _case(F.col("FDUKID") % 4, _LAST_STATUS_BY_MOD4).alias("FDLTTR"),
        rf.alias("FDBNOP"), ls.alias("FDBSOP"),
        F.col("partkey").cast("string").alias("FDLITM"),
        F.lpad(F.col("suppkey").cast("string"), 12, " ").alias("FDMCU"),
        F.concat(F.lit("0000"), (key % 6).cast("string")).alias("FDCO"),
        F.rpad(F.concat(F.lit("C"), rf), 4, " ").alias("FDGLC"),
        "FDAEXP", "FDBIPI", "FDBVIS", "FDBDIZ", "FDBICM")
