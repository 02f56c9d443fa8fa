"""Secret scans (4): fixed rules, and two character Markov models compared by log-likelihood.

The models are bigram models over the base64 and identifier characters, one of random
strings and one of ordinary identifiers. Labelled samples: random are seeded random strings
and the values that the fixed rules find; ordinary are the words of the sampled texts and
identifiers joined from them, the numbers of those texts, seeded numbers and dates, and
rules drawn with one sign. The sample is the documents whose id hash falls below
``sample_docs`` / (number of documents): a bounded number of labelled rows, counted on the
executors; the driver receives at most one number per pair of characters and class.

A token, a longest run of ``[A-Za-z0-9+/_=-]`` of any length, is a span of kind ``random``
if its log-likelihood ratio is at least ``min_llr`` (the log of the prior odds against a
token being a secret), unless it overlaps a fixed rule's span. The ratio alone decides:
a short token cannot gather as much as a long one.

Whole texts are scanned in one map-only pass; the ratios of all tokens of a text are summed
at once over its code points.

Defined results: null and empty texts have no spans; null and repeated ids give a row
each; empty table: empty result; other columns are not read.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCS = 2000
MIN_LLR = math.log(1e6)
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_NAMES = ("password", "passwd", "secret", "token", "api")
_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]{2,}")
_NUMBER = re.compile(r"(?<![A-Za-z0-9+/_=-])[0-9]{3,}(?![A-Za-z0-9+/_=-])")
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_CODE = {c: i + 1 for i, c in enumerate(_CHARS)}  # 0: the start of a string, or another character
_N = len(_CHARS) + 1
_IN_TOKEN = np.array([0 if chr(c) == "." else _CODE.get(chr(c), 0) for c in range(128)] + [0], dtype=np.int64)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed rules, by start, then kind."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def pairs_of(s: str) -> Iterator[int]:
    last = 0
    for c in s:
        code = _CODE.get(c, 0)
        yield last * _N + code
        last = code


def _identifiers(words: list[str]) -> Iterator[str]:
    """Words as they are, and joined in the usual ways."""
    yield from words
    for i, (a, b) in enumerate(zip(words, words[1:])):
        yield (f"{a}_{b}", a + b.capitalize(), f"{a}-{b}", f"{a}{i % 100}", f"{a}.{b}", f"{a}/{b}", f"{a}-{i % 1000}",
               f"{a}_{b}".upper(), f"{a.upper()}-{i % 10000}", f"{a[0]}{i % 100}_{i % 64}")[i % 10]


def _numbers(n: int = 3000, seed: int = 12) -> Iterator[str]:
    """Numbers, dates, fractions, ranges and dotted or dashed groups of digits."""
    rng = random.Random(seed)
    for i in range(n):
        yield "".join(rng.choices("0123456789", k=rng.randint(4, 20)))
        groups = [str(rng.randrange(10 ** rng.randint(1, 4))) for _ in range(rng.randint(2, 4))]
        yield "-/_"[i % 3].join(groups)
        yield f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 31):02}"


def _random_strings(n: int = 3000, seed: int = 11) -> Iterator[str]:
    rng = random.Random(seed)
    alphabets = (_CHARS[52:62] + "abcdef", _CHARS[:62], _CHARS[:64], _CHARS[26:62], _CHARS[:26] + _CHARS[52:62],
                 _CHARS[:52], _CHARS[26:52])
    for i in range(n):
        yield "".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(16, 64)))


def train(df: DataFrame, id_col: str, text_col: str, sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Log ratio log(P(random) / P(ordinary)) of each pair of characters."""
    n = df.count()
    share = min(1.0, sample_docs / max(1, n))
    cut = int(-2**63 + share * 2**64) - 1 if share < 1 else 2**63 - 1
    sample = df.where(F.xxhash64(F.col(id_col)) <= F.lit(cut).cast("long")).select(F.col(text_col).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for b in batches:
            for t in b.column(0):
                text = t.as_py() or ""
                spans = base_spans(text)
                for s, _, e in spans:
                    seen[0].update(pairs_of(re.split(r"[\x20:='\"]+", text[s:e].rstrip("'\""))[-1]))
                plain = [w.group() for w in _WORD.finditer(text) if not any(s < w.end() and w.start() < e for s, _, e in spans)]
                numbers = [m.group() for m in _NUMBER.finditer(text) if not any(s < m.end() and m.start() < e for s, _, e in spans)]
                for w in (*_identifiers(plain), *numbers):
                    seen[1].update(pairs_of(w))
        rows = [(k, p, c) for k in (0, 1) for p, c in seen[k].items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in
                                          enumerate((pa.int32(), pa.int32(), pa.int64()))], names=["k", "p", "c"])

    counts = np.ones((2, _N, _N))
    for s in _random_strings():
        for p in pairs_of(s):
            counts[0, p // _N, p % _N] += 1
    for x in [*_numbers(), *(c * k for c in "-=_+/" for k in range(2, 80))]:
        for p in pairs_of(x):
            counts[1, p // _N, p % _N] += 1
    for r in sample.mapInArrow(count, "k int, p int, c long").groupBy("k", "p").agg(F.sum("c").alias("c")).collect():
        counts[r.k, r.p // _N, r.p % _N] += r.c
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    return (logs[0] - logs[1]).reshape(-1)


def random_spans(text: str, ratio: np.ndarray, base: list[tuple[int, int, int]],
                 min_llr: float = MIN_LLR) -> list[tuple[int, int, int]]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.zeros(len(points) + 2, dtype=np.int64)  # nothing before and after
    code[1:-1] = _IN_TOKEN[np.minimum(points, 128)]
    inside = (code > 0).astype(np.int8)
    start, end = np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1)
    if not len(start):
        return []
    value = np.where(inside[1:-1] > 0, ratio[code[:-2] * _N + code[1:-1]], 0.0)
    found = np.flatnonzero(np.add.reduceat(value, start) >= min_llr)
    return [(s, 3, e) for s, e in zip(start[found].tolist(), end[found].tolist())
            if not any(b < e and s < c for b, _, c in base)]


def secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
            min_llr: float = MIN_LLR) -> DataFrame:
    """Per row: id, spans array<struct<kind, start, end>> in code points, by start, then kind."""
    ratio = train(df, id_col, text_col, sample_docs)  # some 5,000 numbers
    src = df.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for t in b.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + random_spans(text, ratio, base, min_llr))
                got.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, kind)], names=[id_col, "spans"])

    return src.mapInArrow(scan, f"`{id_col}` {src.schema[0].dataType.simpleString()}, "
                                "spans array<struct<kind:string,start:int,end:int>>")
