"""General-ledger side of the ledger.

Shape of the job: every lookup is applied to the *account dimension* first
(accounts x code table x units x rates x company, all dimension-sized and
checked before broadcast), the anti-double-count exclusion F7 is applied
there too, and only then is the fact (balances or journal lines) joined once
on the account id. The fact side never passes through more than one join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (MONEY, PERCENT, cents_to_amount, code_eq, decode_cyyddd, fit,
                         not_in_or_null, ocat, otrim, parse_percent, trimmed_not_in)
from ..plans.config import DEFAULT_CONFIG, LedgerConfig
from ..plans.params import DetailParams, PeriodParams
from .lookups import (cached_stats, center_hierarchy, checked, code_lookup, companies,
                      materialized)


def account_dimension(tables, cfg: LedgerConfig = DEFAULT_CONFIG, *, dedupe: bool = True) -> DataFrame:
    """One row per GL account with every label the ledger needs.

    Output: GMAID, GMANI, GMSUB, CONTA_ESTRUTURA, DESCRICAO_CONTA_II, CONTA,
    CONTA_I, CONTA_COMPLETA, CENTRO_CUSTO, FILIAL, EMPRESA,
    RATEIO_BALAO_STR, RATEIO_MULTIUSO_STR, RATEIO_BALAO, RATEIO_MULTIUSO.
    Labels keep the source's padding where the source does (B8): CONTA is the
    untrimmed description, CONTA_COMPLETA is ``GMOBJ || GMSUB || ' ' || GMDL01``.
    """
    a = tables["F0901"]
    a = code_lookup(a, F.col("GMR009"), *cfg.account_group_lookup, "CONTA",
                    tables=tables, cfg=cfg, dedupe=dedupe)
    a = code_lookup(a, F.col("GMR010"), *cfg.account_subgroup_lookup, "_CONTA_I",
                    tables=tables, cfg=cfg, dedupe=dedupe)
    a = center_hierarchy(a, tables, "GMMCU", cfg)
    a = code_lookup(a, F.col("MCRP49"), *cfg.rate_balloons_lookup, "RATEIO_BALAO_STR",
                    tables=tables, value_col="DRSPHD", cfg=cfg, dedupe=dedupe)
    a = code_lookup(a, F.col("MCRP50"), *cfg.rate_multiuse_lookup, "RATEIO_MULTIUSO_STR",
                    tables=tables, value_col="DRSPHD", cfg=cfg, dedupe=dedupe)
    a = a.join(companies(tables, cfg), F.rtrim("GMCO") == F.col("_C_CCCO"), "inner")
    return a.select(
        "GMAID", "GMANI", "GMSUB",
        otrim(ocat(F.col("GMOBJ"), F.col("GMSUB"))).alias("CONTA_ESTRUTURA"),
        otrim("GMDL01").alias("DESCRICAO_CONTA_II"),
        F.col("CONTA").cast("string").alias("CONTA"),
        otrim("_CONTA_I").alias("CONTA_I"),
        ocat(F.col("GMOBJ"), F.col("GMSUB"), " ", F.col("GMDL01")).alias("CONTA_COMPLETA"),
        "CENTRO_CUSTO", "FILIAL",
        ocat(F.col("GMCO"), " - ", F.col("CCNAME")).alias("EMPRESA"),
        "RATEIO_BALAO_STR", "RATEIO_MULTIUSO_STR",
        parse_percent("RATEIO_BALAO_STR").alias("RATEIO_BALAO"),
        parse_percent("RATEIO_MULTIUSO_STR").alias("RATEIO_MULTIUSO"),
    )


def gl_exclusion(cfg: LedgerConfig = DEFAULT_CONFIG) -> Column:
    """drop GL rows that the document branches rebuild.

    A NULL or blank group/sub-group *passes* (NVL sentinel, B4); a blank
    account structure is NULL and therefore *fails* the NOT IN (B2).
    """
    return (not_in_or_null("CONTA", cfg.gl_excluded_groups, cfg.exclusion_sentinel)
            & not_in_or_null("CONTA_I", cfg.gl_excluded_subgroups, cfg.exclusion_sentinel)
            & trimmed_not_in("CONTA_ESTRUTURA", cfg.gl_excluded_structures))


def _checked_accounts(tables, cfg: LedgerConfig) -> DataFrame:
    # The dimension has at most one row per account (every lookup in it is
    # unique), so checking the account master itself bounds it.
    stat = cached_stats(tables, "F0901").get((), (0, 0))
    build = lambda: account_dimension(
        tables, cfg, dedupe=not cfg.materialize_dimensions).where(gl_exclusion(cfg))
    dim = materialized(tables, ("accounts", cfg), build) if cfg.materialize_dimensions else build()
    return checked(dim, ["GMAID"], stat, max_bytes=cfg.broadcast_max_bytes,
                   unique=cfg.require_unique_masters, name="account dimension",
                   dedupe=not cfg.materialize_dimensions)


def period_balances(tables, params: PeriodParams, cfg: LedgerConfig = DEFAULT_CONFIG) -> DataFrame:
    """P7 + F8 + F6: the balance of each account for each month of the range.

    Only the needed period columns are read: for one month that is a single
    GBANnn column (column pruning reaches the Parquet scan); for a longer
    range the needed columns are unpivoted. The fiscal-year predicate is a
    plain integer filter and is pushed to the scan.
    Output: GBAID, DATA_LANCAMENTO, VALOR_PERIODO (cents). A balance is dated at the first
    day of its period, and at the start date in the month where the range starts.
    """
    months = params.months()
    off = params.fiscal_year_offset
    fys = sorted({y - off for y, _ in months})
    periods = sorted({m for _, m in months})
    b = tables["F0902"].where(F.col("GBFY").isin(fys) & code_eq("GBLT", cfg.ledger_type))
    long = b.unpivot(["GBAID", "GBFY"], [f"GBAN{p:02d}" for p in periods], "_PCOL", "_CENTS")
    period = F.substring("_PCOL", 5, 2).cast("int")
    keep = None
    for y, m in months:
        c = (F.col("GBFY") == y - off) & (period == m)
        keep = c if keep is None else keep | c
    val = F.coalesce(F.col("_CENTS"), F.lit(Decimal(0)).cast("decimal(20,0)"))
    return (long.where(keep)
            .select("GBAID",
                    F.greatest(F.make_date(F.col("GBFY") + off, period, F.lit(1)),
                               F.lit(params.date_from)).alias("DATA_LANCAMENTO"),
                    val.alias("VALOR_PERIODO"))
            .where(F.abs("VALOR_PERIODO") > 0))


def _gl_constants(cfg: LedgerConfig) -> list[Column]:
    return [
        F.lit(None).cast("int").alias("CFOP"), F.lit(None).cast("long").alias("NOTA"),
        fit(F.lit(" "), 25).alias("ITEM"), F.lit(" ").alias("TAMANHO"), F.lit(" ").alias("TIPO"),
        F.lit(" ").alias("COR"), F.lit(" ").alias("EMBALAGEM"),
        F.lit(cfg.gl_query_info).alias("QUERY_INFO"),
    ]


_DIM_COLS = ["CONTA_ESTRUTURA", "DESCRICAO_CONTA_II", "CONTA", "CONTA_I", "CONTA_COMPLETA",
             "CENTRO_CUSTO", "RATEIO_BALAO", "RATEIO_MULTIUSO", "EMPRESA", "FILIAL"]


def gl_balance(tables, params: PeriodParams, cfg: LedgerConfig = DEFAULT_CONFIG) -> DataFrame:
    """Monthly balances as ledger base rows (before allocation)."""
    bal = period_balances(tables, params, cfg)
    dim = _checked_accounts(tables, cfg)
    j = bal.join(dim, F.col("GBAID") == F.col("GMAID"), "inner")
    return j.select(
        "DATA_LANCAMENTO",
        F.lit(cfg.balance_doc_type).alias("TIPO_DOCUMENTO"),
        F.lit(cfg.balance_doc_number).alias("NUM_DOCUMENTO"),
        cents_to_amount("VALOR_PERIODO").alias("VALOR_TRANSACAO"),
        otrim("GMANI").alias("CONTA_II"),
        fit(F.lit(cfg.balance_explanation), 30).alias("EXPLICACAO"),
        F.col("GBAID").alias("CHAVE_CONTA"),
        F.col("GMSUB").alias("ORDEM_CONTA"),
        *_DIM_COLS, *_gl_constants(cfg))


def gl_detail(tables, params: DetailParams, cfg: LedgerConfig = DEFAULT_CONFIG) -> DataFrame:
    """Posted journal lines as ledger base rows (the older query's source)."""
    j = tables["F0911"].where(F.col("GLDGJ") >= params.jul_from)
    if params.jul_to is not None:
        j = j.where(F.col("GLDGJ") <= params.jul_to)
    j = j.where(code_eq("GLLT", cfg.ledger_type) & code_eq("GLPOST", cfg.posted_flag))
    dim = _checked_accounts(tables, cfg)
    j = j.join(dim, F.col("GLAID") == F.col("GMAID"), "inner")
    return j.select(
        decode_cyyddd("GLDGJ").alias("DATA_LANCAMENTO"),
        F.col("GLDCT").alias("TIPO_DOCUMENTO"),
        F.col("GLDOC").cast("string").alias("NUM_DOCUMENTO"),
        cents_to_amount("GLAA").alias("VALOR_TRANSACAO"),
        otrim("GLANI").alias("CONTA_II"),
        fit("GLEXA", 30).alias("EXPLICACAO"),
        F.col("GLAID").alias("CHAVE_CONTA"),
        F.col("GMSUB").alias("ORDEM_CONTA"),
        *_DIM_COLS, *_gl_constants(cfg))


def allocate(base: DataFrame, cfg: LedgerConfig = DEFAULT_CONFIG) -> DataFrame:
    """Split each GL row by its two allocation rates in one pass.

    r49 NULL            -> 1 row: original amount, LINHA ' ', PERCENTUAL NULL
    r49 set             -> 1 row: amount * r49 / 100, LINHA 'BALOES'
    r49 and r50 set     -> 1 more row: amount * r50 / 100, LINHA 'LUVAS MULTIUSO'
    r50 without r49 is ignored; rates need not total 100 (a residue is dropped).
    A rate above the PERCENTUAL column's range is applied in full and shown as NULL.
    One explode of a filtered array replaces a three-branch union, so the
    base is computed once instead of three times.
    """
    from ..functions import apply_rate
    r49, r50, v = F.col("RATEIO_BALAO"), F.col("RATEIO_MULTIUSO"), F.col("VALOR_TRANSACAO")
    plain, balloons, multi = cfg.allocation_labels

    def opt(keep, amount, pct, linha, branch):
        return F.struct(keep.alias("keep"), amount.cast(MONEY).alias("v"),
                        pct.try_cast(PERCENT).alias("p"), F.lit(linha).alias("l"),
                        F.lit(branch).alias("b"))

    options = F.array(
        opt(r49.isNull(), v, F.lit(None), plain, "GL"),
        opt(r49.isNotNull(), apply_rate(v, r49), r49, balloons, "GL_BALOES"),
        opt(r49.isNotNull() & r50.isNotNull(), apply_rate(v, r50), r50, multi, "GL_MULTIUSO"),
    )
    out = base.withColumn("_opt", F.explode(F.filter(options, lambda o: o["keep"])))
    return (out.withColumn("VALOR_TRANSACAO", F.col("_opt.v"))
            .withColumn("PERCENTUAL", F.col("_opt.p"))
            .withColumn("LINHA", F.col("_opt.l"))
            .withColumn("BRANCH", F.col("_opt.b"))
            .drop("_opt", "RATEIO_BALAO", "RATEIO_MULTIUSO"))
