"""SimHash near-dedup (3): 64-bit fingerprints of word shingles, linked at a Hamming distance
of ``radius`` or less, with connected components.

Candidates (exact, by the pigeonhole rule): the 64 bits are five parts; two fingerprints at
distance 3 or less agree in at least two of them. Every distinct fingerprint goes to the
ten groups of its pairs of parts (26-bit keys), so copies of a text cost nothing further.
A group above ``max_group`` is divided exactly: its members agree in two parts, so on the
other 38 bits, cut into four, they agree in at least one piece; a piece that is still above
is compared in pairs of blocks of at most ``max_group`` members. No group is cut off and no
task gets more than two blocks.

Comparison (bit-sliced): 64 members form a block, stored as 64 bit planes. One query
fingerprint updates the distances to all members of a block with a carry-save counter of
two bits and an overflow mask per plane; blocks whose members all exceed the radius are
abandoned every eight planes. A task returns a spanning star per local component, at most
one edge per member, never all pairs.

Defined results:
* null and blank text: no words, fingerprint zero, linked like any other;
* fewer words than a shingle: the whole sequence is the one shingle;
* repeated ids are separate rows; a null id never names a component unless all are null;
* empty table: empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import arrow_batches, checkpoint, text_hash
from .components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
MAX_GROUP = 4096
TEXTS_AT_ONCE = 500
PARTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # (first bit, bits)
_STEP = 1 << 13
_LANES = 1 << 12  # compared at once; bounds the pairs held by a task to 64 times as many


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bit b is one if it is set in over half of the shingle hashes (repeats included)."""
    words = text.lower().split() if text else []  # of bytes: A-Z only, and \x20\x09-\x0D
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for s in range(0, n, _STEP):
        part = words[s:min(s + _STEP, n) + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle))) if len(part) >= shingle else [part]
        h = np.array([xxh64_intdigest(b" ".join(g), SEED) for g in grams], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(_id, _th, fp) per row; fp as a signed long."""
    src = df.select(F.col(id_col).alias("_id"), text_hash(F.col(text_col)).alias("_th"),
                    F.col(text_col).cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), fps], names=["_id", "_th", "fp"])

    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"_id {kind}, _th bigint, fp bigint")


# --- bit-sliced comparison -------------------------------------------------------------

def _planes(members: np.ndarray) -> np.ndarray:
    """(64, n) planes of n blocks of 64 members: bit j of planes[b, k] is bit b of member j of block k."""
    bits = np.unpackbits(members.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    sliced = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    whole = np.ascontiguousarray(sliced).reshape(-1, 64, 8)
    return np.ascontiguousarray(whole.view("<u8")[:, :, 0].T)


def within(planes: np.ndarray, block: np.ndarray, query: np.ndarray, valid: np.ndarray, radius: int) -> np.ndarray:
    """Per lane (a block and a query fingerprint) the mask of members at distance <= radius."""
    out = np.zeros(len(block), dtype=np.uint64)
    at = np.arange(len(block))
    alive = valid.copy()
    zero, one = np.uint64(0), np.uint64(1)
    # Distance as a vertical counter: c0 + 2 c1, and over once it passes 3.
    c0, c1 = np.zeros(len(block), np.uint64), np.zeros(len(block), np.uint64)
    over = ~alive
    for b in range(64):
        differs = planes[b][block] ^ (zero - ((query >> np.uint64(b)) & one))
        carry = c0 & differs
        c0 ^= differs
        over |= c1 & carry
        c1 ^= carry
        if b % 8 == 7:
            far = over if radius >= 3 else over | _beyond(c0, c1, radius)
            live = far != ~zero
            if not live.all():  # abandon the blocks in which every member is too far
                at, block, query, c0, c1, over = at[live], block[live], query[live], c0[live], c1[live], over[live]
                if not len(at):
                    return out
    out[at] = ~(over if radius >= 3 else over | _beyond(c0, c1, radius))
    return out


def _beyond(c0: np.ndarray, c1: np.ndarray, radius: int) -> np.ndarray:
    """Members whose two-bit count is above a radius of 0, 1 or 2."""
    return c0 | c1 if radius == 0 else c1 if radius == 1 else c0 & c1


def link(groups: list[np.ndarray], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Spanning stars (member, root) of the components within each group."""
    sizes = np.array([len(g) for g in groups])
    blocks = -(-sizes // 64)
    first = np.concatenate([[0], np.cumsum(blocks)])
    members = np.zeros(first[-1] * 64, dtype="<u8")
    filled = np.zeros(first[-1] * 64, dtype=np.uint8)
    for g, f in zip(groups, first):
        members[f * 64:f * 64 + len(g)] = g
        filled[f * 64:f * 64 + len(g)] = 1
    planes = _planes(members)
    valid = np.packbits(filled.reshape(-1, 64), axis=1, bitorder="little").view("<u8")[:, 0]
    parent = np.arange(len(members))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    # A lane for each member and each block from its own on; later members only.
    pos = np.flatnonzero(filled)
    own = pos // 64
    last = np.repeat(first[1:], sizes)
    for s in range(0, len(pos), 1024):
        p, o, e = pos[s:s + 1024], own[s:s + 1024], last[s:s + 1024]
        n = e - o
        lane = np.repeat(np.arange(len(p)), n)
        block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(o, n)
        later = np.where(block == o[lane], ~np.uint64(0) << (p[lane] % 64).astype(np.uint64) << np.uint64(1), ~np.uint64(0))
        for t in range(0, len(lane), _LANES):
            k = slice(t, t + _LANES)
            mask = valid[block[k]] & later[k]
            some = mask != 0
            q, bl = p[lane[k]][some], block[k][some]
            hits = within(planes, bl, members[q], mask[some], radius)
            got = np.flatnonzero(hits)
            if not len(got):
                continue
            r, c = np.nonzero(np.unpackbits(hits[got].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            a, b = q[got[r]], bl[got[r]] * 64 + c
            while True:  # labels as they stand; most pairs of a dense group are then joined already
                flat = parent[parent]
                if (flat == parent).all():
                    break
                parent = flat
            ra, rb = parent[a], parent[b]
            for x, y in np.unique(np.stack([ra, rb], 1)[ra != rb], axis=0):
                x, y = find(int(x)), find(int(y))
                if x != y:
                    parent[max(x, y)] = min(x, y)
    roots = np.array([find(int(x)) for x in pos], dtype=np.int64)
    apart = roots != pos
    signed = members.view("<i8")
    return list(zip(signed[pos[apart]].tolist(), signed[roots[apart]].tolist()))


def _link_partition(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    def flush(groups):
        edges = link(groups, radius) if groups else []
        return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.int64()),
                                           pa.array([e[1] for e in edges], pa.int64())], names=["a", "b"])
    for b in batches:
        groups, n = [], 0
        for fps in b.column(0):
            g = np.asarray(fps.values.to_numpy(zero_copy_only=False), dtype="<i8").view("<u8")
            groups.append(g)
            n += 64 * -(-len(g) // 64)
            if n >= 1 << 16:
                yield flush(groups)
                groups, n = [], 0
        yield flush(groups)


# --- candidate groups ------------------------------------------------------------------

def _bits(c: Column, first: int, n: int) -> Column:
    return F.shiftrightunsigned(c, first).bitwiseAND(F.lit((1 << n) - 1).cast("long"))


def _groups(fps: DataFrame, max_group: int) -> DataFrame:
    """(key, sub, blk, fp): every pair at distance <= 3 shares one (key, sub, blk)."""
    fp = F.col("fp")
    pairs = list(combinations(range(len(PARTS)), 2))
    keyed = fps.select("fp", F.explode(F.array(*[
        (F.lit(t).cast("long") * (1 << 26)) + _bits(fp, *PARTS[i]) * (1 << 13) + _bits(fp, *PARTS[j])
        for t, (i, j) in enumerate(pairs)])).alias("key"))
    sizes = keyed.groupBy("key").count()
    hot = checkpoint(sizes.where(F.col("count") > max_group).select(F.col("key").alias("_k")))
    plain = keyed.withColumn("sub", F.lit(0).cast("long")).withColumn("blk", F.lit(0).cast("long"))
    if hot.isEmpty():
        return plain
    cold = plain.join(hot, F.col("key") == F.col("_k"), "left_anti")
    table = (F.col("key") / (1 << 26)).cast("int")
    rest = None  # the bits outside the two parts, side by side
    for t, pair in enumerate(pairs):
        value, at = F.lit(0).cast("long"), 0
        for i in [i for i in range(len(PARTS)) if i not in pair]:
            value, at = value + F.shiftleft(_bits(fp, *PARTS[i]), at), at + PARTS[i][1]
        rest = F.when(table == t, value) if rest is None else rest.when(table == t, value)
    pieces = keyed.join(hot, F.col("key") == F.col("_k"), "left_semi").select("fp", "key", rest.alias("_rest")) \
        .select("fp", "key", F.explode(F.array(*[F.lit(s + 1).cast("long") * (1 << 10) + _bits(F.col("_rest"), 10 * s, 10)
                                                 for s in range(4)])).alias("sub"))
    counts = pieces.groupBy(F.col("key").alias("_k"), F.col("sub").alias("_s")).count()
    n = F.ceil(F.col("count") / max_group).cast("int")
    sized = pieces.join(counts, (F.col("key") == F.col("_k")) & (F.col("sub") == F.col("_s"))) \
        .select("fp", "key", "sub", n.alias("_n"), F.pmod(F.xxhash64("fp"), n).cast("int").alias("_b"))
    # blocks (i, j) with i <= j; a member of block b is in all that name b
    both = F.transform(F.sequence(F.lit(0), F.col("_n") - 1),
                       lambda x: F.least(x, F.col("_b")).cast("long") * (1 << 31) + F.greatest(x, F.col("_b")))
    return cold.unionByName(sized.select("fp", "key", "sub", F.explode(both).alias("blk")))


def near_links(fps: DataFrame, radius: int = RADIUS, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b): edges that join exactly the components of the distinct fingerprints ``fp``."""
    if not 0 <= radius <= 3:
        raise ValueError("the five parts cover a radius of 3 at most")
    groups = _groups(fps, max_group).groupBy("key", "sub", "blk").agg(F.collect_list("fp").alias("g")) \
        .where(F.size("g") > 1).select("g")
    return groups.mapInArrow(lambda b: _link_partition(b, radius), "a bigint, b bigint").distinct()


def _clustered(df: DataFrame, id_col: str, text_col: str, shingle: int, radius: int,
               max_group: int) -> tuple[DataFrame, DataFrame]:
    """(_id, _th, fp) per row, and (_f, root, component_id, first) per distinct fingerprint."""
    with arrow_batches(df.sparkSession, TEXTS_AT_ONCE):
        rows = checkpoint(fingerprints(df, id_col, text_col, shingle))
    first = F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_th")))
    nodes = checkpoint(rows.groupBy("fp").agg(first.alias("_first"), F.min("_th").alias("_any")))
    roots = components(near_links(nodes.select("fp"), radius, max_group))
    labelled = nodes.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", "_first", "_any", F.coalesce("root", "fp").alias("root"))
    # Written out, so that AQE can split a component that holds a large part of all rows.
    least = checkpoint(labelled.groupBy(F.col("root").alias("_root"))
                       .agg(F.min("_first").alias("_best"), F.min("_any").alias("_least")))
    classes = labelled.join(least, F.col("root") == F.col("_root")).select(
        F.col("fp").alias("_f"), F.col("_best._id").alias("component_id"),
        F.coalesce(F.col("_best._th"), F.col("_least")).alias("_keep"))
    return rows, classes


def simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS, max_group: int = MAX_GROUP) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    rows, classes = _clustered(df, id_col, text_col, shingle, radius, max_group)
    return rows.join(classes, F.col("fp") == F.col("_f")).select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                      radius: int = RADIUS, max_group: int = MAX_GROUP) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    rows, classes = _clustered(df, id_col, text_col, shingle, radius, max_group)
    keep = rows.join(classes, F.col("fp") == F.col("_f")) \
        .where(F.col("_id").eqNullSafe(F.col("component_id")) & (F.col("_th") == F.col("_keep"))) \
        .select(F.col("_id").alias("_kid"), F.col("_th").alias("_kth")).distinct()
    src = df.select(F.struct("*").alias("row"), F.col(id_col).alias("_id"), text_hash(F.col(text_col)).alias("_th"))
    kept = src.join(keep, F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")), "left_semi")
    return kept.dropDuplicates(["_id", "_th"]).select("row.*")
