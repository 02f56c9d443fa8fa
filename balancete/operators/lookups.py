"""Dimension lookups: code table, item dimension, cost-centre hierarchy.

Every lookup side is *checked* before it is broadcast: one small aggregate
action counts its rows and its largest key multiplicity. A side above
``max_bytes`` (rows times the width of a row) is left to the planner (sort-merge
join); a duplicate key of a code lookup raises,
because the older query form (a scalar subquery) fails on duplicates while
a plain left join would silently multiply ledger rows (SURVEY J2/J12).
After the check the side is de-duplicated on its key, which is a no-op on
the data but tells Catalyst the key is unique, so a left join whose columns
the final query never reads is removed from the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructType

from ..session import checkpoint

from ..functions import blank_key, code_eq, code_in, fit, ocat, otrim
from ..plans.config import DEFAULT_CONFIG, LedgerConfig


class DuplicateLookupKey(ValueError):
    pass


def _stats_frame(df: DataFrame, keys: Sequence[Column], group: Sequence[Column] = ()) -> DataFrame:
    """(g: array<string>, rows, maxdup) per group: size and largest key multiplicity.

    Rows whose key holds a NULL are not counted: they can never match an
    equi-join. Both aggregations are partial before their shuffle.
    """
    gnames = [f"_g{i}" for i in range(len(group))]
    knames = [f"_k{i}" for i in range(len(keys))]
    d = df.select(*[g.cast("string").alias(n) for g, n in zip(group, gnames)],
                  *[k.alias(n) for k, n in zip(keys, knames)])
    for n in knames:
        d = d.where(F.col(n).isNotNull())
    per_key = d.groupBy(*gnames, *knames).agg(F.count(F.lit(1)).alias("_n"))
    agg = per_key.groupBy(*gnames).agg(F.sum("_n").alias("rows"), F.max("_n").alias("maxdup"))
    garr = F.array(*[F.col(n) for n in gnames]) if gnames else F.array().cast("array<string>")
    return agg.select(garr.alias("g"), "rows", "maxdup")


def _collect_stats(rows) -> dict:
    return {tuple(r["g"]): (int(r["rows"] or 0), int(r["maxdup"] or 0)) for r in rows}


def key_stats(df: DataFrame, keys: Sequence[Column], group: Sequence[Column] = ()) -> dict:
    """``{group tuple: (rows, max rows per key)}`` of one lookup side, one small job."""
    return _collect_stats(_stats_frame(df, keys, group).collect())


# Checks on the base tables behind every lookup, by name: (table, key columns,
# group columns). They are all computed together, in one job, the first time
# any of them is needed for a table bundle.
CHECKS = {
    "F0006 unit": ("F0006", lambda: [F.rtrim("MCMCU")], lambda: []),
    "F0006 parent": ("F0006", lambda: [blank_key("MCMCU")], lambda: []),
    "F0010": ("F0010", lambda: [F.rtrim("CCCO")], lambda: []),
    "F76B200": ("F76B200", lambda: [F.rtrim("DPBNOP"), F.rtrim("DPBSOP"), F.rtrim("DPFCO")], lambda: []),
    "F4101": ("F4101", lambda: [F.rtrim("IMLITM")], lambda: []),
    "F0901": ("F0901", lambda: [F.col("GMAID")], lambda: []),
}


def cached_stats(tables, check: str) -> dict:
    """Result of a named check for this bundle; all pending checks run in one job."""
    stats = tables.stats
    if check not in stats:
        pending = [c for c in CHECKS if c not in stats and CHECKS[c][0] in tables]
        frames = [_stats_frame(tables[CHECKS[c][0]], CHECKS[c][1](), CHECKS[c][2]())
                  .select(F.lit(c).alias("check"), "*") for c in pending]
        rows = reduce(lambda a, b: a.unionByName(b), frames).collect()
        for c in pending:
            stats[c] = _collect_stats([r for r in rows if r["check"] == c])
    return stats[check]


def materialized(tables, key, build) -> DataFrame:
    """A dimension built once per table bundle and checkpointed.

    Dimensions (accounts with their labels, items with their categories) are
    small and read by every query of a run; building them once turns about a
    dozen lookup joins per query into one scan of the checkpoint, and the
    checkpoint in the shared folder survives executor loss.
    """
    if key not in tables.derived:
        tables.derived[key] = checkpoint(build())
    return tables.derived[key]


def row_width(schema: StructType) -> int:
    """Bytes of a row in a broadcast relation; text counts as 64 bytes a column."""
    return 32 + sum(64 if isinstance(f.dataType, StringType) else 24 if isinstance(f.dataType, DecimalType) else 8
                    for f in schema.fields)


def checked(df: DataFrame, keys: Sequence[str], stat: tuple, *, max_bytes: int,
            unique: bool, name: str, dedupe: bool = True) -> DataFrame:
    """Apply a size/uniqueness verdict to a lookup side.

    A duplicate key raises if ``unique`` asks for it (code lookups: the older
    form is a scalar subquery) and otherwise multiplies rows, as the source's
    joins do; a side whose keys are unique is de-duplicated on its key (a
    no-op on the data that lets Catalyst drop unused left joins); a side of
    at most ``max_bytes`` bytes is broadcast, a larger one is left to the
    planner (sort-merge join).
    """
    rows, maxdup = stat
    if unique and maxdup > 1:
        raise DuplicateLookupKey(f"{name}: key {list(keys)} is not unique "
                                 f"(up to {maxdup} rows per key)")
    not_null = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        not_null = not_null & F.col(k).isNotNull()
    df = df.where(not_null)
    if maxdup <= 1 and dedupe:
        df = df.dropDuplicates(list(keys))
    return F.broadcast(df) if rows * row_width(df.schema) <= max_bytes else df


def checked_lookup(df: DataFrame, keys: Sequence[str], *, max_bytes: int,
                   unique: bool = True, name: str = "lookup") -> DataFrame:
    """Check a lookup side with its own small job, then apply ``checked``."""
    stat = key_stats(df, [F.col(k) for k in keys]).get((), (0, 0))
    return checked(df, keys, stat, max_bytes=max_bytes, unique=unique, name=name)


def code_lookup(df: DataFrame, key: Column, system: str, rec_type: str, out: str, *,
                tables, value_col: str = "DRDL01", cfg: LedgerConfig = DEFAULT_CONFIG,
                how: str = "left", dedupe: bool = True) -> DataFrame:
    """Left-join one code-table slice on a trimmed key.

    ``TRIM(key) = TRIM(DRKY)`` with blank never matching blank (B1); the code
    coordinates are compared ignoring trailing padding (B6).
    """
    kname = f"_k_{out}"
    codes = tables["F0005"]
    lk = (codes.where(code_eq("DRSY", system) & code_eq("DRRT", rec_type))
          .select(blank_key("DRKY").alias(kname), F.col(value_col).alias(out)))
    stat = code_table_stats(tables, system, rec_type, cfg)
    lk = checked(lk, [kname], stat, max_bytes=cfg.broadcast_max_bytes,
                 unique=cfg.require_unique_lookups, name=f"F0005[{system},{rec_type}]", dedupe=dedupe)
    return df.join(lk, blank_key(key) == F.col(kname), how).drop(kname)


def _used_slices(cfg: LedgerConfig) -> set[tuple[str, str]]:
    return {cfg.account_group_lookup, cfg.account_subgroup_lookup, cfg.rate_balloons_lookup, cfg.rate_multiuse_lookup,
            *((cfg.item_category_system, rt) for rt in cfg.item_category_types)}


def code_table_stats(tables, system: str, rec_type: str, cfg: LedgerConfig = DEFAULT_CONFIG) -> tuple:
    """(rows, largest key multiplicity) of one (system, record type) slice of F0005.

    The configured slices are checked together in one job, with the wanted one; the driver
    gets a row per slice that is asked for, not per slice of the table.
    """
    found = tables.stats.setdefault("F0005 slices", {})
    if (system, rec_type) not in found:
        wanted = sorted((_used_slices(cfg) | {(system, rec_type)}) - set(found))
        test = reduce(lambda a, b: a | b, [code_eq("DRSY", sy) & code_eq("DRRT", rt) for sy, rt in wanted])
        got = key_stats(tables["F0005"].where(test), [blank_key("DRKY")], [F.rtrim("DRSY"), F.rtrim("DRRT")])
        found.update({k: got.get(k, (0, 0)) for k in wanted})
    return found[system, rec_type]


def item_dimension(tables, cfg: LedgerConfig = DEFAULT_CONFIG, *, filter_lines: bool = True,
                   dedupe: bool = True) -> DataFrame:
    """Item master with its five category descriptions.

    Output: IMLITM, IMSRP1, ITEM, LINHA, TAMANHO, TIPO, COR, EMBALAGEM; the
    descriptions are trimmed (blank -> NULL) and cut to 30 characters. With
    ``filter_lines`` only items whose line code is accepted are kept (the
    filter the document branches put inside their inner join).
    """
    items = tables["F4101"]
    if filter_lines:
        items = items.where(code_in("IMSRP1", cfg.item_line_codes))
    names = ["LINHA", "TAMANHO", "TIPO", "COR", "EMBALAGEM"]
    for k, (rt, nm) in enumerate(zip(cfg.item_category_types, names), start=1):
        items = code_lookup(items, F.col(f"IMSRP{k}"), cfg.item_category_system, rt, f"_{nm}",
                            tables=tables, cfg=cfg, dedupe=dedupe)
    return items.select(
        "IMLITM", "IMSRP1", fit("IMLITM", 25).alias("ITEM"),
        *[fit(otrim(f"_{nm}"), 30).alias(nm) for nm in names])


def units(tables) -> DataFrame:
    """Business units with their display label ``MCMCU || ' ' || MCDL01``."""
    return tables["F0006"].select(
        "MCMCU", "MCRP04", "MCRP49", "MCRP50",
        ocat(F.col("MCMCU"), " ", F.col("MCDL01")).alias("CENTRO_CUSTO"))


def center_hierarchy(df: DataFrame, tables, unit_key: str, cfg: LedgerConfig = DEFAULT_CONFIG,
                     *, with_parent: bool = True) -> DataFrame:
    """Attach cost centre (J3, untrimmed key) and its parent branch.

    CENTRO_CUSTO is ``' '`` when the unit is unknown (NULL || ' ' || NULL);
    FILIAL is ``TRIM(parent || ' ' || name)``, hence NULL when unknown.
    """
    u = units(tables).select(F.rtrim("MCMCU").alias("_U_MCMCU"), "*").drop("MCMCU")
    stat = cached_stats(tables, "F0006 unit").get((), (0, 0))
    u = checked(u, ["_U_MCMCU"], stat, max_bytes=cfg.broadcast_max_bytes,
                unique=cfg.require_unique_masters, name="F0006", dedupe=False)
    # Untrimmed key: leading blanks matter, trailing padding does not.
    out = df.join(u, F.rtrim(unit_key) == F.col("_U_MCMCU"), "left").drop("_U_MCMCU")
    out = out.withColumn("CENTRO_CUSTO", F.coalesce(F.col("CENTRO_CUSTO"), F.lit(" ")))
    if with_parent:
        parent = tables["F0006"].select(blank_key("MCMCU").alias("_P_KEY"),
                                        ocat(F.col("MCMCU"), " ", F.col("MCDL01")).alias("_P_LABEL"))
        pstat = cached_stats(tables, "F0006 parent").get((), (0, 0))
        parent = checked(parent, ["_P_KEY"], pstat, max_bytes=cfg.broadcast_max_bytes,
                         unique=cfg.require_unique_masters, name="F0006 parent")
        out = (out.join(parent, blank_key("MCRP04") == F.col("_P_KEY"), "left")
               .withColumn("FILIAL", otrim(F.coalesce(F.col("_P_LABEL"), F.lit(" "))))
               .drop("_P_KEY", "_P_LABEL"))
    return out


def companies(tables, cfg: LedgerConfig = DEFAULT_CONFIG) -> DataFrame:
    c = tables["F0010"].select(F.rtrim("CCCO").alias("_C_CCCO"), "CCNAME")
    stat = cached_stats(tables, "F0010").get((), (0, 0))
    return checked(c, ["_C_CCCO"], stat, max_bytes=cfg.broadcast_max_bytes,
                   unique=cfg.require_unique_masters, name="F0010", dedupe=False)
