"""Substring dedup (10): paragraph MinHash banding, exact Jaccard, removal by components.

Two kinds of repeats are found over the distinct texts (a copied text counts once, with the
smallest of its ids; texts are numbered in the order of that id):

* **Paragraphs.** The lines of a text that hold a 5-word shingle. Seven bands of two MinHash
  values; lines that collide in a band are verified by exact Jaccard of their shingles (0.8
  or more), in blocks of bounded members and words (a larger key is dealt out as pairs of
  blocks; no pair is left out). Connected components of the links are the repeated
  paragraphs; equal lines are always one.
* **Passages across paragraph borders.** Seeds of 8 words, the least hash of every 13
  consecutive places (winnowing), are exchanged; every 20-word window around a seed that two
  texts hold is then compared, so that a hit grows left and right to its whole length. Equal
  windows hold equal seeds: every passage of 20 words or more that two texts share is found
  whole, wherever it stands.

A repeat found in two or more texts stays in the first and is removed from the others. Of a
text held under several ids the first keeps what the text keeps and the others lose all.

Bands: a pair of lines at similarity 0.8 meets with probability 1 - (1 - 0.8^2)^7 = 0.9992.

Defined results: one row per row of the input; null, empty and blank texts have no words and
nothing repeated; texts of less than five words repeat as whole texts only; a null id stands
before all others and its texts stay apart; rows equal in id and text are one document and
get equal results; one id with several texts: the texts are told apart by their hash; very
long texts are read whole; empty table: empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..session import remove_shared, shared_scratch_path
from .common import checkpoint
from .components import components

SIZE = 20  # words of a window
SEED, WINDOW = 8, 13  # SEED + WINDOW - 1 = SIZE: every window holds a seed
SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 7, 2
MAX_GROUP = 512
GROUP_WORDS = 200_000
_NULL_ID = -(2**63)
_BATCH_WORDS = 200_000
_CELLS = 1 << 24
_P = np.uint64(0x9E3779B97F4A7C15)
_SALT = np.array([xxh64_intdigest(f"minhash {i}") | 1 for i in range(2 * BANDS * ROWS)], dtype=np.uint64)
_KEYS = [f"k{b}" for b in range(BANDS)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def _fold(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive values."""
    out = h[:max(len(h) - n + 1, 0)].copy()
    for k in range(1, n):
        out = _mix(out * _P + h[k:len(h) - n + 1 + k])
    return out


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 19:
            self.clear()
        self[word] = h = xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def split(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def _lines(text: bytes | None) -> list[list[bytes]]:
    return [w for x in text.lower().split(b"\n") if (w := x.split())] if text else []


def paragraphs(lines: list[list[bytes]], h: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(index, words, content hash, keys[bands]) of the lines that hold a shingle."""
    h = _hashed([w for x in lines for w in x]) if h is None else h
    n = np.array([len(x) for x in lines], dtype=np.int64)
    starts = np.cumsum(n) - n
    which = np.flatnonzero(n >= SHINGLE)
    if not len(which):
        return which, n[which], np.zeros(0, np.uint64), np.zeros((0, BANDS), np.uint64)
    content = np.array([xxh64_intdigest(b" ".join(lines[i])) for i in which], dtype=np.uint64)
    many = n[which] - SHINGLE + 1
    first = np.cumsum(many) - many
    shingles = _fold(h, SHINGLE)[np.arange(many.sum()) + np.repeat(starts[which] - first, many)]
    low = [np.minimum.reduceat(_mix(shingles * _SALT[2 * j] + _SALT[2 * j + 1]), first) for j in range(BANDS * ROWS)]
    keys = []
    for b in range(BANDS):
        key = np.full(len(which), b, dtype=np.uint64)
        for r in range(ROWS):
            key = _mix(key * _P + low[b * ROWS + r])
        keys.append(key)
    return which, n[which], content, np.stack(keys, axis=1)


def seeds(h: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in h, hash) of the seeds of consecutive texts of these lengths."""
    if len(h) < SIZE:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = _fold(h, SEED)
    least = np.lib.stride_tricks.sliding_window_view(grams, WINDOW).argmin(axis=1)
    ends = np.cumsum(lengths)
    at = np.arange(len(least))  # a window of SIZE words from here, within one text
    at = at[at + SIZE <= ends[np.searchsorted(ends, at, side="right")]]
    at = np.unique(at + least[at])
    return at, grams[at]


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """kind 0: lines (u, t, p, n, keys); 1: seeds (u, t, p); 2: texts (t, n)."""
    def flush(ids: list[int], texts: list[list[list[bytes]]]) -> pa.RecordBatch:
        ids = np.array(ids, dtype=np.int64)
        lines = [x for t in texts for x in t]
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        n = np.array([len(x) for x in lines], dtype=np.int64)
        lengths = np.bincount(owner, weights=n, minlength=len(texts)).astype(np.int64)
        begin = np.cumsum(lengths) - lengths
        h = _hashed([w for x in lines for w in x])
        which, words, content, keys = paragraphs(lines, h)
        at, grams = seeds(h, lengths)
        holder = np.searchsorted(begin + lengths, at, side="right")
        kinds = np.repeat(np.array([0, 1, 2], dtype=np.int8), [len(which), len(at), len(ids)])
        place = (np.cumsum(n) - n - begin[owner])[which] if len(lines) else which
        blank = np.zeros(len(at) + len(ids), dtype=np.int64)
        columns = [kinds, np.concatenate([content.view(np.int64), grams.view(np.int64), ids * 0]),
                   np.concatenate([ids[owner[which]], ids[holder], ids]),
                   np.concatenate([place, at - begin[holder], ids * 0]).astype(np.int32),
                   np.concatenate([words, at * 0, lengths]).astype(np.int32),
                   *[np.concatenate([keys[:, b].view(np.int64), blank]) for b in range(BANDS)]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["kind", "u", "t", "p", "n", *_KEYS])

    for batch in batches:
        ids, texts, size = [], [], 0
        for t, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(t)
            texts.append(_lines(text.as_py()))
            size += sum(map(len, texts[-1]))
            if size >= _BATCH_WORDS:
                yield flush(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield flush(ids, texts)


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, t, p): every window of a text (t, text, places of shared seeds) that holds one of them."""
    def flush(us: list, ts: list, ps: list) -> pa.RecordBatch:
        t = np.repeat(np.array(ts, dtype=np.int64), [len(p) for p in ps])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us).view(np.int64)), pa.array(t),
                                           pa.array(np.concatenate(ps).astype(np.int32))], names=["u", "t", "p"])

    for batch in batches:
        ends, places = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(zero_copy_only=False).astype(np.int64)
        us, ts, ps, size = [], [], [], 0
        for i, (t, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
            h = _hashed(split(text.as_py()))
            at = places[ends[i]:ends[i + 1]]
            near = np.zeros(len(h) + 1, dtype=np.int64)
            np.add.at(near, np.maximum(at + SEED - SIZE, 0), 1)
            np.add.at(near, at + 1, -1)
            p = np.flatnonzero(np.cumsum(near)[:len(h) - SIZE + 1] > 0)
            us.append(_fold(h, SIZE)[p])
            ts.append(t)
            ps.append(p)
            size += len(p)
            if size >= _BATCH_WORDS:
                yield flush(us, ts, ps)
                us, ts, ps, size = [], [], [], 0
        if us:
            yield flush(us, ts, ps)


def _content_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, s): the distinct shingles (as hashes) of the wanted lines of a text."""
    def flush(us: list, sets: list) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        s = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), s], names=["u", "s"])

    for batch in batches:
        wanted = batch.column(1)
        ends = wanted.offsets.to_numpy()
        u, p, n = (wanted.values.field(k).to_numpy(zero_copy_only=False).tolist() for k in ("u", "p", "n"))
        us, sets, size = [], [], 0
        for i, text in enumerate(batch.column(0)):
            grams = _fold(_hashed(split(text.as_py())), SHINGLE)
            for j in range(ends[i], ends[i + 1]):
                us.append(u[j])
                sets.append(np.unique(grams[p[j]:p[j] + n[j] - SHINGLE + 1]))
                size += n[j]
            if size >= _BATCH_WORDS:
                yield flush(us, sets)
                us, sets, size = [], [], 0
        if us:
            yield flush(us, sets)


def _verify(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Spanning forest of the pairs with Jaccard >= similarity in each group of (u, shingles)."""
    for batch in batches:
        edges: list[tuple[int, int]] = []
        for group in batch.column(0):
            members = group.values
            us = members.field("u").to_numpy()
            lists = members.field("s")
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            edges += jaccard_forest(us.tolist(), [values[at[i]:at[i + 1]] for i in range(len(us))], similarity)
        yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])


def jaccard_forest(ids: list[int], sets: list, similarity: float) -> list[tuple[int, int]]:
    cols = [np.unique(np.asarray(s, dtype=np.int64)) for s in sets]
    n = np.array([len(c) for c in cols], dtype=np.float32)
    vocab, col = np.unique(np.concatenate(cols), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), n.astype(np.int64))
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = max(_CELLS // len(sets), 1)  # a slice of the vocabulary at a time
    for start in range(0, len(vocab), width):
        lo, hi = np.searchsorted(col, [start, start + width])
        m = np.zeros((len(sets), min(width, len(vocab) - start)), dtype=np.float32)
        m[row[lo:hi], col[lo:hi] - start] = 1
        both += m @ m.T
    a, b = np.nonzero(np.triu(both >= similarity * (n[:, None] + n[None, :] - both) - 1e-4, 1))
    parent = np.arange(len(sets))
    edges = []
    for s in range(0, len(a), 4096):
        while not (parent[parent] == parent).all():
            parent = parent[parent]
        x, y = parent[a[s:s + 4096]], parent[b[s:s + 4096]]
        for i, j in np.unique(np.stack([x, y], 1)[x != y], axis=0):
            while parent[i] != i:
                i = parent[i]
            while parent[j] != j:
                j = parent[j]
            if i != j:
                i, j = sorted((i, j))
                parent[j] = i
                edges.append((ids[i], ids[j]))
    return edges


def _span_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows (2 p, and 1 if it goes) and lines (p, n, gone) of each text as figures and the spans that go."""
    def covered(p: np.ndarray, n) -> np.ndarray:
        edge = np.zeros(int((p + n).max(initial=0)) + 2, dtype=np.int64)
        np.add.at(edge, p + 1, 1)
        np.add.at(edge, p + n + 1, -1)
        return np.cumsum(edge) > 0  # one place further on, so that a span has an edge on either side

    def parts(column: pa.ListArray, names: tuple[str, ...]) -> tuple:
        flat = [column.values.field(k) for k in names] if names else [column.values]
        return column.offsets.to_numpy(), [f.to_numpy(zero_copy_only=False).astype(np.int64) for f in flat]

    for batch in batches:
        w_at, (coded,) = parts(batch.column(1), ())
        l_at, (lp, ln, lg) = parts(batch.column(2), ("p", "n", "gone"))
        rows = []
        for i, t in enumerate(batch.column(0).to_pylist()):
            w, of = coded[w_at[i]:w_at[i + 1]], slice(l_at[i], l_at[i + 1])
            p, n = np.concatenate([w >> 1, lp[of]]), np.concatenate([np.full(len(w), SIZE), ln[of]])
            gone = np.concatenate([w & 1, lg[of]]) > 0
            out = covered(p[gone], n[gone]).astype(np.int8)
            start, end = np.flatnonzero(np.diff(out) == 1), np.flatnonzero(np.diff(out) == -1)
            rows.append((t, int(covered(p, n).sum()), int(covered(w >> 1, SIZE).sum()),
                         [{"start": int(a), "end": int(b)} for a, b in zip(start, end)]))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                         names=["t", "n_repeated", "n_passage", "removed"])


@contextmanager
def _no_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of an action go when it ends: everything a later action reads is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _in_two(at: DataFrame) -> DataFrame:
    """(u, first) of what two or more texts hold. It is written out before it is joined back:
    the join then has an exchange of its own on either side, and AQE can split a hot u."""
    both = at.groupBy("u").agg(F.min("t").alias("first"), F.max("t").alias("last"))
    return checkpoint(both.where(F.col("first") != F.col("last")).select(F.col("u").alias("_u"), "first"))


def _line_links(lines: DataFrame, texts: DataFrame, each: DataFrame, similarity: float, max_group: int) -> DataFrame:
    """Edges (a, b) of the distinct lines ``each`` whose shingles are similar."""
    keyed = each.select(F.explode(F.array(*_KEYS)).alias("key"), "u", "n")
    sizes = checkpoint(keyed.groupBy(F.col("key").alias("_k")).agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("words"))
                       .where(F.col("many") > 1))
    blocks = keyed.join(sizes, F.col("key") == F.col("_k")) \
        .withColumn("_n", F.greatest(F.ceil(F.col("many") / max_group), F.ceil(F.col("words") / GROUP_WORDS)).cast("int")) \
        .withColumn("_b", F.pmod(F.xxhash64("u"), F.col("_n")).cast("int"))
    blocks = blocks.select("key", "u", F.explode(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda x: F.struct(
        F.least(x, F.col("_b")).alias("i"), F.greatest(x, F.col("_b")).alias("j")))).alias("blk"))
    # Lines that meet in several bands are compared once: equal groups are one.
    groups = checkpoint(blocks.groupBy("key", "blk").agg(F.array_sort(F.collect_set("u")).alias("us"))
                        .where(F.size("us") > 1).select("us").distinct())
    members = groups.select(F.xxhash64("us").alias("g"), F.explode("us").alias("u"))
    wanted = members.select(F.col("u").alias("_w")).distinct()
    places = each.join(wanted, F.col("u") == F.col("_w"), "left_semi").select(F.col("u").alias("_u"), F.col("lo").alias("_t"))
    places = lines.join(places, (F.col("u") == F.col("_u")) & (F.col("t") == F.col("_t"))).groupBy("u", "t").agg(
        F.min("p").alias("p"), F.min("n").alias("n"))
    lists = places.groupBy(F.col("t").alias("_wt")).agg(F.collect_list(F.struct("u", "p", "n")).alias("w"))
    content = checkpoint(texts.join(lists, F.col("t") == F.col("_wt")).select("text", "w")
                         .mapInArrow(_content_batches, "u bigint, s array<bigint>"))
    filled = members.join(content.select(F.col("u").alias("_u"), "s"), F.col("u") == F.col("_u"))
    return filled.groupBy("g").agg(F.collect_list(F.struct("u", "s")).alias("m")).select("m") \
        .mapInArrow(lambda b: _verify(b, similarity), "a bigint, b bigint").distinct()


def _repeated_lines(lines: DataFrame, texts: DataFrame, similarity: float, max_group: int) -> DataFrame:
    """(t, p, n, first): every line whose component two or more texts hold."""
    each = checkpoint(lines.groupBy("u").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.max("n").alias("n"),
                                             *[F.max(k).alias(k) for k in _KEYS]))
    roots = components(_line_links(lines, texts, each, similarity, max_group))
    classes = checkpoint(each.join(roots, F.col("u") == F.col("node"), "left")
                         .select("u", F.coalesce("root", "u").alias("c"), "lo", "hi"))
    spread = checkpoint(classes.groupBy(F.col("c").alias("_c")).agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
                        .where(F.col("first") != F.col("last")))
    shared = checkpoint(classes.join(spread, F.col("c") == F.col("_c")).select(F.col("u").alias("_u"), "first"))
    return lines.join(shared, F.col("u") == F.col("_u")).select("t", "p", "n", "first")


def _write_windows(seeded: DataFrame, texts: DataFrame, path: str) -> None:
    # The rows are dealt by text before they are collected: partial lists would be larger than they are.
    at = checkpoint(seeded.join(_in_two(seeded), F.col("u") == F.col("_u")).select(F.col("t").alias("_wt"), "p")
                    .repartition("_wt").groupBy("_wt").agg(F.collect_list("p").alias("ps")))
    texts.join(at, F.col("t") == F.col("_wt")).select("t", "text", "ps") \
        .mapInArrow(_window_batches, "u bigint, t bigint, p int").write.parquet(path)


def _runs(windows: DataFrame) -> DataFrame:
    """(t, first, w): the shared windows of each text, as 2 p and 1 if the window goes."""
    found = windows.join(_in_two(windows), F.col("u") == F.col("_u")).select(
        "t", (F.col("p").cast("long") * 2 + (F.col("first") != F.col("t")).cast("long")).alias("w"), "first")
    return found.repartition("t").groupBy("t").agg(F.min("first").alias("first"), F.collect_list("w").alias("w"))


def repeated(texts: DataFrame, similarity: float = SIMILARITY, max_group: int = MAX_GROUP) -> tuple[DataFrame, DataFrame]:
    """For distinct texts (t, text), numbered so that the least t keeps a repeat: the repeats
    of each text as (t, comp, n_repeated, n_passage, removed), and (t, n) its words."""
    spark = texts.sparkSession
    # The large tables are written as Parquet, a third of the size of a checkpoint's rows,
    # and removed as soon as nothing reads them any more.
    units_at, lines_at, windows_at = (shared_scratch_path(spark, x) for x in ("units", "lines", "windows"))
    texts.mapInArrow(_unit_batches, "kind tinyint, u bigint, t bigint, p int, n int, "
                     + ", ".join(f"{k} bigint" for k in _KEYS)).write.parquet(units_at)
    units = spark.read.parquet(units_at)
    sizes = checkpoint(units.where("kind = 2").select("t", "n"))
    _write_windows(units.where("kind = 1").select("u", "t", "p"), texts, windows_at)
    units.where("kind = 0").select("u", "t", "p", "n", *_KEYS).write.parquet(lines_at)
    remove_shared(spark, units_at)
    runs = checkpoint(_runs(spark.read.parquet(windows_at)))
    remove_shared(spark, windows_at)
    lines = _repeated_lines(spark.read.parquet(lines_at), texts, similarity, max_group).groupBy(F.col("t").alias("_t")).agg(
        F.min("first").alias("_first"), F.collect_list(F.struct("p", "n", (F.col("first") != F.col("t")).cast("int").alias("gone"))).alias("l"))
    every = checkpoint(runs.join(lines, F.col("t") == F.col("_t"), "full").select(
        F.coalesce("t", "_t").alias("t"), F.least("first", "_first").alias("comp"),
        F.coalesce("w", F.array().cast("array<bigint>")).alias("w"),
        F.coalesce("l", F.array().cast("array<struct<p:int,n:int,gone:int>>")).alias("l")))
    spans = every.select("t", "w", "l").mapInArrow(
        _span_batches, "t bigint, n_repeated bigint, n_passage bigint, removed array<struct<start:int,end:int>>")
    found = checkpoint(every.select("t", "comp").join(spans, "t"))
    remove_shared(spark, lines_at)
    return found, sizes


def passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
             max_group: int = MAX_GROUP) -> DataFrame:
    """One row per row: component_id (the smallest id that keeps a repeat of it, its own if it
    has none), n_repeated_words, n_passage_words (of them in shared runs of 20 or more),
    n_removed_words, removed (array of word spans)."""
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("d"), text.alias("text"),
                     F.xxhash64(text).alias("h"), F.hash(text).alias("g"))
    texts_at = shared_scratch_path(spark, "texts")
    with _no_old_shuffles(spark):
        # Numbered in the order of the least id, then of the hash: the number stands for both.
        numbers = checkpoint(docs.groupBy("h", "g").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
                             .repartitionByRange("lo", "h", "g").sortWithinPartitions("lo", "h", "g")
                             .withColumn("t", F.monotonically_increasing_id()))
        named = numbers.select(F.col("h").alias("_h"), F.col("g").alias("_g"), "t")
        docs.groupBy("h", "g").agg(F.min("text").alias("text")).join(named, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g"))) \
            .select("t", F.col("text").cast("binary").alias("text")).write.parquet(texts_at)
        found, sizes = repeated(spark.read.parquet(texts_at), similarity, max_group)
        remove_shared(spark, texts_at)
        ids = numbers.select(F.col("t").alias("comp"), F.col("lo").alias("comp_id"))
        info = numbers.join(sizes, "t").join(found.join(ids, "comp"), "t", "left")
        info = checkpoint(info.select("h", "g", "lo", "hi", "n", "comp_id", "n_repeated", "n_passage", "removed"))

    none = F.array().cast(info.schema["removed"].dataType)
    copied = (F.col("lo") != F.col("hi")) & (F.col("n") > 0)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n").alias("end")))
    removed = F.when(copied & (F.col("d") != F.col("lo")), whole).otherwise(F.coalesce("removed", none))
    own = F.when(copied, F.col("lo")).otherwise(F.col("d"))

    def words(column: str):
        return F.when(copied, F.col("n")).otherwise(F.coalesce(column, F.lit(0))).cast("long")

    rows = docs.select("d", F.col("h").alias("_h"), F.col("g").alias("_g"))
    rows = rows.join(info, (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")))
    return rows.select("d", "comp_id", own.alias("own"), words("n_repeated").alias("n_repeated_words"),
                       F.when(copied & (F.col("n") >= SIZE), F.col("n")).otherwise(F.coalesce("n_passage", F.lit(0)))
                       .cast("long").alias("n_passage_words"), removed.alias("removed")).select(
        F.nullif(F.col("d"), F.lit(_NULL_ID)).alias(id_col),
        F.nullif(F.coalesce("comp_id", "own"), F.lit(_NULL_ID)).alias("component_id"), "n_repeated_words", "n_passage_words",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed_words"), "removed")
