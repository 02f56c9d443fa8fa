"""Mixing sources to target weights (5): weighted fair queueing. Native.

Each source's documents are shuffled (by a hash of their id) and repeated for up to
``max_epochs`` passes. A document's virtual finish time in a pass is the source's
cumulative size, this document included, divided by the source's target. All (document,
pass) items are put into one global order of finish times and cut off where their sizes
would exceed the total budget.

Both running sums (within a source, and global) are ``prefix_sum``: range partitions with a
small table of partition totals, so neither a hot source nor the whole list is one task.
What reaches the driver is one row (the last item taken) and one row per step of the
targets' water filling.

Defined results:
* null text: size 0; an empty document is never taken; a null source is a source of its
  own, ordered last; repeated ids are separate rows; ties go by id, then by text hash;
* empty table: empty result; a table without words has target 0 and takes nothing;
* a document larger than what is left of its source's target is taken only if the global
  order reaches it within the budget (documents are not cut).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, prefix_sum, split_words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(_src, _isnull, source_size, target) per source.

    Sources weigh ``weights`` in turn, by code point order with null last. Targets share the
    sum of all sizes by weight; a target stops at ``max_epochs`` times its source's size and
    the excess is shared again by weight until none is above.
    """
    totals = sizes.groupBy("_src").agg(F.sum("_size").alias("source_size")) \
        .withColumn("_isnull", F.col("_src").isNull()).withColumn("_one", F.lit(1))
    w = F.array(*[F.lit(x) for x in weights])
    ranked = checkpoint(prefix_sum(totals, ["_isnull", "_src"], "_one", "_rank").withColumn(
        "_w", F.get(w, ((F.col("_rank") - 1) % len(weights)).cast("int"))))
    cap = F.col("source_size") * max_epochs
    budget = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # the target of a source of weight 1 below its cap; rises at each step
    while True:
        capped = cap <= F.col("_w") * F.lit(level)
        full, free = ranked.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("_w")))).first()
        if not free:
            break
        new = (budget - (full or 0)) / free
        if new <= level:
            break
        level = new
    target = F.least(cap.cast("double"), F.col("_w") * F.lit(level))
    return ranked.select("_src", "_isnull", "source_size", target.alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Per row: id, _th (hash of the text), size, source_size, target, finish (virtual finish
    time of the first pass), epochs (passes taken), taken (words)."""
    ident = F.col(id_col)
    sizes = checkpoint(df.select(
        ident.alias("_id"), F.xxhash64(F.col(text_col)).alias("_th"), F.col(source_col).alias("_src"),
        F.size(split_words(F.col(text_col))).cast("long").alias("_size"),
        F.md5(F.concat_ws(":", F.lit(seed), ident.cast("string"))).alias("_shuffle")))
    targets = source_targets(sizes, weights, max_epochs)
    summed = prefix_sum(sizes.withColumn("_isnull", F.col("_src").isNull()),
                        ["_isnull", "_src", "_shuffle", "_id", "_th"], "_size", "_cum")
    # The global running sum less all earlier sources is the sum within the source.
    starts = prefix_sum(targets, ["_isnull", "_src"], "source_size", "_end").select(
        F.col("_src").alias("_s"), "source_size", "target", (F.col("_end") - F.col("source_size")).alias("_start"))
    queued = checkpoint(summed.join(starts, F.col("_src").eqNullSafe(F.col("_s")))
                        .withColumn("_cum", F.col("_cum") - F.col("_start")).drop("_s", "_start"))
    passes = [F.struct(((F.col("_cum") + F.col("source_size") * e) / F.col("target")).alias("_finish"),
                       F.lit(e).alias("_epoch")) for e in range(max_epochs)]
    key = ["_finish", "_shuffle", "_id", "_th", "_epoch"]
    worth = queued.where((F.col("_size") > 0) & (F.col("target") > 0))
    items = worth.select("_shuffle", "_id", "_th", "_size", F.explode(F.array(*passes)).alias("_p")) \
        .select("_shuffle", "_id", "_th", "_size", "_p.*")
    budget = sizes.agg(F.sum("_size")).first()[0] or 0
    cut = prefix_sum(items, key, "_size", "_total").where(F.col("_total") <= budget) \
        .agg(F.max(F.struct(*key)).alias("k"), F.max("_total").alias("t")).first()
    if cut["k"] is None:
        epochs = F.lit(0)
    else:
        last = cut["k"]
        types = dict(items.dtypes)
        bound = F.struct(*[F.lit(last[c]).cast(types[c]).alias(c) for c in key])
        epochs = sum((F.when(F.struct(p["_finish"].alias("_finish"), F.col("_shuffle"), F.col("_id"), F.col("_th"),
                                      p["_epoch"].alias("_epoch")) <= bound, 1).otherwise(0)
                      for p in passes), F.lit(0))
    taken = F.when((F.col("_size") > 0) & (F.col("target") > 0), epochs).otherwise(0)
    return queued.select(F.col("_id").alias(id_col), "_th", F.col("_size").alias("size"), "source_size", "target",
                         (F.col("_cum") / F.nullif(F.col("target"), F.lit(0.0))).alias("finish"),
                         taken.cast("int").alias("epochs"), (taken * F.col("_size")).cast("long").alias("taken"))
