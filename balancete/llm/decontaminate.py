"""Benchmark decontamination (6): one Aho-Corasick automaton over the normalised windows of
all test items, scanning each text once; hits are mapped back to offsets of the original.

The automaton works on word numbers, not characters: a text becomes the sequence of its
words' numbers in the benchmark's vocabulary (0: no benchmark word), so matches begin and
end at word borders and a window of ten words costs ten nodes.

No shuffle: the benchmark is sent to the tasks in shards of at most ``max_shard_bytes`` of
text (measured first), one automaton per shard and Python worker. A benchmark beyond one
shard adds a pass over the words in the same task, not a join.

Defined results:
* null text or item: no words; an item without words matches nothing;
* an item of fewer than ``window`` words is one window; repeated item ids count once,
  the words of an item with a null id are hit like any other's, but it is not among ``items``;
  repeated documents give a row each;
* empty tables: no rows, or no hits; other columns of ``df`` are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
MAX_SHARD_BYTES = 16 << 20

# A-Z to a-z; what no word holds ([\x00-\x2F\x3A-\x60\x7B-\x7F] after lowering) to a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def build(items: list[tuple[str | None, bytes | None]], window: int):
    """(vocabulary, automaton or None, items of each window) of one shard."""
    vocab: dict[bytes, int] = {}
    windows: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = [vocab.setdefault(w, len(vocab) + 1) for w in words_of(text)]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            owners_ = windows.setdefault(tuple(ids[i:i + window]), set())
            if item is not None:
                owners_.add(item)
    if not windows:
        return vocab, None, []
    auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    owners = []
    for n, (key, items_) in enumerate(windows.items()):
        auto.add_word(key, (n, len(key)))
        owners.append(items_)
    auto.make_automaton()
    return vocab, auto, owners


_BUILT: dict = {}  # of this Python worker: the automaton of each broadcast shard


def _built(shard, window: int):
    key = (id(shard), window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = (shard, build(shard.value, window))
    return _BUILT[key][1]


def _spans(marks: bytearray) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(rb"\x01+", marks)]


def scan(text: bytes | None, built: list) -> tuple[int, int, list[str], list[dict]]:
    """(n_words, n_hit, item ids, hit spans as code points of the original text)."""
    words = words_of(text)
    marks, found = bytearray(len(words)), set()
    for vocab, auto, owners in built:
        if auto is None or not words:
            continue
        get = vocab.get
        seen = set()
        for end, (n, length) in auto.iter(tuple([get(w, 0) for w in words])):
            seen.add(n)
            marks[end + 1 - length:end + 1] = b"\x01" * length
        for n in seen:
            found |= owners[n]
    n_hit = marks.count(1)
    if not n_hit:
        return len(words), 0, [], []
    at = [m.span() for m in _WORD.finditer(text.decode("utf-8", "replace"))]
    spans = [{"start": at[a][0], "end": at[b - 1][1]} for a, b in _spans(marks)]
    return len(words), n_hit, sorted(found), spans


def benchmark_shards(bench: DataFrame, item_col: str, text_col: str, max_shard_bytes: int):
    """Broadcasts of the items, each with at most about ``max_shard_bytes`` of text."""
    spark = bench.sparkSession
    rows = bench.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("binary").alias("t")) \
        .where(F.col("t").isNotNull())
    total = rows.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    n = max(1, -(-total // max_shard_bytes))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k) if n > 1 else rows
        yield spark.sparkContext.broadcast([(r["i"], bytes(r["t"])) for r in part.toLocalIterator()])


def decontaminate(df: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", bench_text_col: str = "text", window: int = WINDOW,
                  max_shard_bytes: int = MAX_SHARD_BYTES, keep_row: bool = False) -> DataFrame:
    """Per row: id, n_words, n_hit, items (sorted ids), spans (of the original text).

    ``keep_row``: return the rows of ``df`` without a hit instead.
    """
    shards = list(benchmark_shards(bench, item_col, bench_text_col, max_shard_bytes))
    spark = df.sparkSession

    if keep_row:
        at = df.columns.index(text_col)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            built = [_built(s, window) if len(shards) == 1 else build(s.value, window) for s in shards]
            for b in batches:
                texts = b.column(at).cast(pa.binary())
                yield b.filter(pa.array([scan(t.as_py(), built)[1] == 0 for t in texts], pa.bool_()))

        return df.mapInArrow(clean, df.schema)

    src = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("binary").alias("_text"))
    schema = spark.createDataFrame([], f"`{id_col}` {src.schema[0].dataType.simpleString()}, n_words long, n_hit long, "
                                       "items array<string>, spans array<struct<start:int,end:int>>").schema
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = [_built(s, window) if len(shards) == 1 else build(s.value, window) for s in shards]
        for b in batches:
            got = [scan(t.as_py(), built) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([g[2] for g in got], pa.list_(pa.string())), pa.array([g[3] for g in got], arrow)],
                names=[id_col, "n_words", "n_hit", "items", "spans"])

    return src.mapInArrow(run, schema)
