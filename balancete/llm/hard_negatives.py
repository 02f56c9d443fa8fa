"""Hard-negative mining (12): Four-Russians scoring of anchors against all rows.

Vectors become integers (``floor(scale * c)``). Candidates are packed by the block: the bits of
their components, in two's complement, as planes of one byte per eight dimensions. For a block
of anchors a table per eight-dimension group holds the sums of all 256 subsets of the anchors'
components. A score is exact: per plane the entries that the candidates' bytes index are added
over the groups, shifted by the plane's weight and added up (the sign plane is taken off).

Anchors are a stated query set: every anchor block meets every candidate block once, in two
passes, of its own label for the positives and of the others for the negatives. The blocks are
dealt over a grid of (anchor block, fragment of the candidates) and joined on that key, so
neither side passes through the driver or is broadcast. A task holds one pair of blocks and
emits the best few rows per anchor; a ranked window, limited before its shuffle too, takes the
best of all. Blocks are cut by position, never by label or vector, so a hot label or a vector
that a third of the rows hold does not make a task larger.

Defined results:
* a null label or vector, an empty vector, or a null, NaN or infinite component: the row takes
  no part; vectors of several lengths, or scores beyond a long, are an error;
* equal scores: the smaller id first, null ids last; rows that share id and score are alike;
* a repeated anchor row is an anchor of its own each time, and its copies are other rows;
  a null id is a candidate, never an anchor;
* an anchor without positives, or a positive without negatives: no rows;
* empty table, no anchors: empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, checkpoint

SCALE = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # percent of the positive's score
ANCHORS = 256        # anchors per block, about
CANDIDATES = 4096    # candidates per block
FRAGMENT = 4         # candidate blocks per fragment
CHUNK = 1024         # candidates scored at a time
MAX_TASKS = 20_000
NONE = -(1 << 63)    # stands for no positive among an anchor's scores

BLOCK = "n int, dims int, bits int, ids binary, none binary, labels binary, planes binary"
ANCHOR_BLOCK = "s int, a binary, anchor_ids binary, anchor_labels binary, anchors binary, scores binary, largest long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _rows(df: DataFrame, id_col: str, vec_col: str, label: Column, anchor: Column, scale: int) -> DataFrame:
    v = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.where(label.isNotNull() & F.coalesce(finite & (F.size(v) > 0), F.lit(False))).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
        F.transform(v, lambda c: F.floor(c * scale)).alias("q"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))


def _vectors(column: pa.Array) -> np.ndarray:
    lengths = np.unique(np.diff(column.offsets.to_numpy()))
    if len(lengths) > 1:
        raise ValueError(f"vectors of several lengths: {lengths.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, int(lengths[0]))


def _planes(q: np.ndarray) -> np.ndarray:
    """Bits (planes, groups of eight dimensions, vectors) of the vectors, two's complement."""
    bits = max(int(q.max()).bit_length(), int(~q.min()).bit_length()) + 1
    return np.stack([np.packbits(((q >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(bits)])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block per batch, its candidates in the order of their labels."""
    for b in batches:
        label = b.column("label").to_numpy()
        order = np.argsort(label, kind="stable")
        q = _vectors(b.column("q"))[order]
        planes, ids = _planes(q), b.column("id")
        none = ids.is_null().to_numpy(zero_copy_only=False)[order]
        yield pa.RecordBatch.from_pylist([{
            "n": len(q), "dims": q.shape[1], "bits": len(planes), "ids": ids.fill_null(0).to_numpy()[order].tobytes(),
            "none": none.tobytes(), "labels": label[order].tobytes(), "planes": planes.tobytes()}],
            schema=pa.schema([("n", pa.int32()), ("dims", pa.int32()), ("bits", pa.int32()), ("ids", pa.binary()),
                              ("none", pa.binary()), ("labels", pa.binary()), ("planes", pa.binary())]))


def _pack_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of a partition as one block, with the scores of their positives (null ends)."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    t = pa.Table.from_batches(batches).combine_chunks()
    q = _vectors(t.column("q").chunk(0))
    yield pa.RecordBatch.from_pylist([{
        "s": TaskContext.get().partitionId(), "a": t.column("a").to_numpy().tobytes(),
        "anchor_ids": t.column("id").to_numpy().tobytes(), "anchor_labels": t.column("label").to_numpy().tobytes(),
        "anchors": q.tobytes(), "scores": _vectors(t.column("scores").chunk(0)).tobytes() if "scores" in t.column_names else b"",
        "largest": int(np.abs(q).sum(axis=1).max())}],
        schema=pa.schema([("s", pa.int32()), *[(c, pa.binary()) for c in ("a", "anchor_ids", "anchor_labels", "anchors", "scores")],
                          ("largest", pa.int64())]))


def _tables(q: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): sums of the anchors' components over every subset of eight."""
    count, dims = q.shape
    padded = np.zeros((-(-dims // 8) * 8, count), q.dtype)
    padded[:dims] = q.T
    out = np.zeros((len(padded) // 8, 256, count), q.dtype)
    for g, group in enumerate(padded.reshape(-1, 8, count)):
        for k in range(8):  # the subsets with dimension k are those without it, plus its component
            out[g, 1 << k:2 << k] = out[g, :1 << k] + group[k]
    return out


def _score(planes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products (anchors, candidates) by table look-ups, shifts and additions."""
    bits, groups, n = planes.shape
    bound = int(np.abs(q).sum(axis=1).max()) << bits
    if bound >= 1 << 63:
        raise OverflowError("scores do not fit a long")
    tables = _tables(q.astype(np.int32 if bound < 1 << 31 else np.int64))
    out = np.zeros((n, len(q)), tables.dtype)
    for at in range(0, n, CHUNK):
        part = out[at:at + CHUNK]
        look = np.empty_like(part)
        for p in range(bits):
            total = tables[0].take(planes[p, 0, at:at + CHUNK], axis=0)
            for g in range(1, groups):
                tables[g].take(planes[p, g, at:at + CHUNK], axis=0, out=look, mode="clip")
                total += look
            total <<= p
            if p == bits - 1:
                part -= total
            else:
                part += total
    return np.ascontiguousarray(out.T)


def _unpack(row: dict) -> tuple:
    longs = lambda name: np.frombuffer(row[name], np.int64)
    planes = np.frombuffer(row["planes"], np.uint8).reshape(row["bits"], -1, row["n"])
    return (longs("ids"), np.frombuffer(row["none"], bool), longs("labels"), planes,
            longs("a"), longs("anchor_ids"), longs("anchor_labels"), longs("anchors").reshape(-1, row["dims"]), longs("scores"))


def _positives(keep: int):
    """Per pair of blocks and anchor the best ``keep`` rows of its label, itself included."""
    schema = pa.schema([("a", pa.int64()), ("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("own", pa.bool_())])

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids, none, labels, planes, a, anchor_ids, anchor_labels, q, _ = _unpack(row)
                out = []
                for label in np.intersect1d(labels, anchor_labels):
                    lo, hi = np.searchsorted(labels, [label, label + 1])
                    who = np.flatnonzero(anchor_labels == label)
                    scores = _score(planes[:, :, lo:hi], q[who])
                    least = np.partition(scores, max(0, hi - lo - keep), axis=1)[:, max(0, hi - lo - keep)]
                    for k, i in enumerate(who):
                        best = np.flatnonzero(scores[k] >= least[k])
                        s = scores[k, best].astype(np.int64)
                        top = np.lexsort((ids[lo + best], none[lo + best], -s))[:keep]
                        j, s = lo + best[top], s[top]
                        own = (ids[j] == anchor_ids[i]) & ~none[j] & (s == int(q[i] @ q[i]))
                        out.append((a[i], anchor_ids[i], j, s, own))
                if out:
                    j = np.concatenate([x[2] for x in out])
                    size = [len(x[2]) for x in out]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat([x[0] for x in out], size)), pa.array(np.repeat([x[1] for x in out], size)),
                        pa.array(ids[j], mask=none[j]), pa.array(np.concatenate([x[3] for x in out])),
                        pa.array(np.concatenate([x[4] for x in out]))], schema=schema)
    return mine


def _negatives(positives: int, keep: int, low: int, high: int):
    """Per pair of blocks, anchor and positive the best ``keep`` rows of other labels in its range."""
    schema = pa.schema([("a", pa.int64()), ("k", pa.int32()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids, none, labels, planes, a, _, anchor_labels, q, scores = _unpack(row)
                scores, found, out = _score(planes, q), scores.reshape(len(a), positives), []
                for i in range(len(a)):
                    ranges = [(-(-low * p // 100), high * p // 100) for p in map(int, found[i]) if p != NONE]
                    s = scores[i]
                    some = np.flatnonzero((s >= min(x for x, _ in ranges)) & (s <= max(y for _, y in ranges)) & (labels != anchor_labels[i]))
                    if not len(some):
                        continue
                    down = -s[some].astype(np.int64)
                    order = np.lexsort((ids[some], none[some], down))
                    some, down = some[order], down[order]
                    for k, (least, most) in enumerate(ranges):
                        start = np.searchsorted(down, -most, "left")
                        end = min(start + keep, np.searchsorted(down, -least, "right"))
                        if end > start:
                            out.append((a[i], k, some[start:end], -down[start:end]))
                if out:
                    j = np.concatenate([x[2] for x in out])
                    size = [len(x[2]) for x in out]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat([x[0] for x in out], size)), pa.array(np.repeat([x[1] for x in out], size).astype(np.int32)),
                        pa.array(ids[j], mask=none[j]), pa.array(np.concatenate([x[3] for x in out]))], schema=schema)
    return mine


def _blocks(anchors: DataFrame, count: int) -> DataFrame:
    return checkpoint(anchors.repartition(max(1, -(-count // ANCHORS))).mapInArrow(_pack_anchors, ANCHOR_BLOCK))


def _pairs(blocks: DataFrame, n_blocks: int, anchors: DataFrame, stripes: int) -> DataFrame:
    """Every candidate block with every anchor block, dealt over the grid."""
    fragments = max(1, -(-n_blocks // FRAGMENT))
    tasks = min(MAX_TASKS, stripes * fragments)
    grid = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = blocks.withColumn("r", F.pmod("block", F.lit(fragments)).cast("int")).withColumn("s", grid(stripes))
    right = anchors.withColumn("r", grid(fragments))
    return left.repartition(tasks, "s", "r").join(right.repartition(tasks, "s", "r"), ["s", "r"])


def _best(rows: DataFrame, group: list[str], score: str, row_id: str, keep: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(F.desc(score), F.asc_nulls_last(row_id))
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def hard_negatives(df: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """One row per anchor, positive and negative (see the module). ``label`` is an integer
    expression over ``df``, ``anchor`` a boolean one."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], RESULT)
    rows = _rows(df, id_col, vec_col, label, anchor, scale)
    asked = checkpoint(rows.where("is_anchor AND id IS NOT NULL").select("id", "label", "q").withColumn("a", F.monotonically_increasing_id()))
    count = asked.count()
    if not count:
        return empty
    with arrow_batches(spark, CANDIDATES):
        packed = checkpoint(rows.select("id", "label", "q").mapInArrow(_pack, BLOCK)
                            .withColumn("block", F.xxhash64(F.monotonically_increasing_id())))
    n_blocks, least, most = packed.agg(F.count("*"), F.min("dims"), F.max("dims")).first()
    if least != most:
        raise ValueError(f"vectors of several lengths: {least} to {most}")
    stripes = max(1, -(-count // ANCHORS))
    # A pair of blocks per Arrow batch, about half a MB.
    with arrow_batches(spark, 1):
        near = _pairs(packed, n_blocks, _blocks(asked, count), stripes).mapInArrow(
            _positives(positives + 1), "a long, anchor_id long, id long, score long, own boolean")
        near = checkpoint(_best(near, ["a"], "score", "id", positives + 1))
    # The anchor itself, or a row that cannot be told from it, is taken out once.
    own = Window.partitionBy("a").orderBy(F.desc("own"), "rank")
    others = near.withColumn("_n", F.row_number().over(own)).where(~(F.col("own") & (F.col("_n") == 1)))
    others = _best(others, ["a"], "score", "id", positives)
    found = checkpoint(others.groupBy("a", "anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p")))
    if not found.limit(1).count():
        return empty
    scores = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda k: F.coalesce(F.get("p", k)["score"], F.lit(NONE)))
    with_scores = asked.join(found.select("a", scores.alias("scores")), "a").select("id", "label", "q", "a", "scores")
    with arrow_batches(spark, 1):
        far = _pairs(packed, n_blocks, _blocks(with_scores, count), stripes).mapInArrow(
            _negatives(positives, negatives, low, high), "a long, k int, negative_id long, negative_score long")
        far = checkpoint(_best(far, ["a", "k"], "negative_score", "negative_id", negatives))
    j = far.join(found, "a").withColumn("_p", F.get("p", "k"))
    return j.select("anchor_id", F.col("_p.id").alias("positive_id"), "rank", "negative_id",
                    F.col("_p.score").alias("positive_score"), "negative_score")
