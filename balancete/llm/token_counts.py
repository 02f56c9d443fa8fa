"""Token counts (8): edit-aware counting with a segment tree of pre-tokens per document.

A document's pre-tokens are kept in leaves of ``LEAF`` pre-tokens; inner nodes hold the sums
of characters and of tokens below them. An edit (place, characters removed, text inserted)
finds its leaf by descending the sums, re-splits the text from a pre-token before the edit
(the context that the pattern can look at) up to the first old border after the edit at
which the new split meets the old one, encodes only those pre-tokens, and updates the sums
on the paths of the touched leaves. The pattern has no look-behind: from a common border on,
both splits agree.

``token_trees`` returns the trees as columns (lengths and counts of the pre-tokens) to be
written, ``edit_trees`` reads such columns, applies edits and returns them again: a later batch
of edits encodes only what it touches. ``token_counts`` builds a tree, applies the edits and
keeps only the figures. All are one map-only pass. The
vocabulary (a file of about 1 MB; its size is checked) is sent to the tasks; each worker
keeps a bounded memo of the token counts of pre-tokens.

Defined results: null text counts as empty; edits beyond the ends are clipped; null edits
and null fields do nothing; edits apply in order; null and repeated ids give a row each;
empty table: empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY_BYTES = 64 << 20
# Fixed value: the pattern that goes with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 64
MEMO = 1 << 18


class Counter:
    """Tokens of a pre-token, with a bounded memo."""

    def __init__(self, ranks: bytes) -> None:
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={},
                                          mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs})
        self.split = regex.compile(PATTERN)
        self.memo: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.memo.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 32:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[piece] = n
        return n


class Tree:
    """Leaves of [lengths, counts] of pre-tokens under a binary tree of (characters, tokens)."""

    def __init__(self, text: str, counter: Counter, lengths: list[int] | None = None,
                 counts: list[int] | None = None) -> None:
        """With the ``lengths`` and ``counts`` of a kept tree nothing is split or encoded."""
        self.text, self.counter = text, counter
        if lengths is None or counts is None:
            pieces = counter.split.findall(text)
            lengths, counts = [len(p) for p in pieces], [counter.count(p) for p in pieces]
        self._build(lengths, counts)
        self.encoded = 0  # pre-tokens encoded by edits

    def parts(self) -> tuple[list[int], list[int]]:
        """Lengths and counts of all pre-tokens: what is kept of the tree."""
        return [x for a, _ in self.leaves for x in a], [x for _, b in self.leaves for x in b]

    def apply(self, edits: list | None) -> None:
        for x in edits or []:
            if x and x["at"] is not None:
                self.edit(x["at"], x["remove"] or 0, x["insert"] or "")

    def _build(self, lengths: list[int], counts: list[int]) -> None:
        self.leaves = [(lengths[i:i + LEAF], counts[i:i + LEAF]) for i in range(0, len(lengths), LEAF)] or [([], [])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for i, (a, b) in enumerate(self.leaves):
            self.chars[self.size + i], self.tokens[self.size + i] = sum(a), sum(b)
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the leaf that holds the character at ``place``."""
        i, first = 1, 0
        while i < self.size:
            i *= 2
            if place >= first + self.chars[i] and self.chars[i + 1]:
                first += self.chars[i]
                i += 1
        return i - self.size, first

    def _set(self, leaf: int, lengths: list[int], counts: list[int]) -> None:
        self.leaves[leaf] = (lengths, counts)
        i = self.size + leaf
        self.chars[i], self.tokens[i] = sum(lengths), sum(counts)
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def edit(self, at: int, remove: int, insert: str) -> None:
        n = len(self.text)
        at = min(max(at, 0), n)
        end = min(at + max(remove, 0), n)
        if end == at and not insert:
            return
        # A match looks at most one character past the one after its end (a contraction that
        # fails, white space before a word): pre-tokens that end two or more before the edit stay.
        back = max(at - 2, 0)
        leaf, first = self._leaf_at(back)
        lengths = self.leaves[leaf][0]
        k, start = 0, first
        while k < len(lengths) and start + lengths[k] <= back:
            start += lengths[k]
            k += 1
        text = self.text[:at] + insert + self.text[end:]
        shift = len(text) - n
        # Old borders from the end of the edit on, walked together with the new split.
        new_lengths: list[int] = []
        new_counts: list[int] = []
        old_leaf, old_k, old_at = leaf, k, start
        place = start
        match = self.counter.split.match
        while True:
            while old_at < end or old_at + shift < place:
                if old_k < len(self.leaves[old_leaf][0]):
                    old_at += self.leaves[old_leaf][0][old_k]
                    old_k += 1
                elif old_leaf + 1 < len(self.leaves):
                    old_leaf, old_k = old_leaf + 1, 0
                else:
                    break
            if place >= len(text) or (old_at >= end and old_at + shift == place and place >= at + len(insert)):
                break
            m = match(text, place)
            piece = m.group()
            new_lengths.append(len(piece))
            new_counts.append(self.counter.count(piece))
            self.encoded += 1
            place = m.end()
        if place >= len(text):  # the rest of the old split is used up
            old_leaf, old_k = len(self.leaves) - 1, len(self.leaves[-1][0])
        head, tail = self.leaves[leaf], self.leaves[old_leaf]
        lengths = head[0][:k] + new_lengths
        counts = head[1][:k] + new_counts
        rest = (tail[0][old_k:], tail[1][old_k:])
        if old_leaf == leaf:
            self._set(leaf, lengths + rest[0], counts + rest[1])
        else:
            self._set(leaf, lengths, counts)
            for j in range(leaf + 1, old_leaf):
                self._set(j, [], [])
            self._set(old_leaf, *rest)
        self.text = text
        if len(self.leaves[leaf][0]) > 8 * LEAF:  # a long insertion: deal out the leaves anew
            self._build(*self.parts())


_COUNTERS: dict = {}


def _counter(shared) -> Counter:
    key = id(shared)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = (shared, Counter(shared.value))
    return _COUNTERS[key][1]


def _shared(df: DataFrame, vocabulary: str):
    if os.path.getsize(vocabulary) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is larger than {MAX_VOCABULARY_BYTES} bytes")
    with open(vocabulary, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def token_counts(df: DataFrame, edits: Column, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row: id, n_tokens (of the text), n_tokens_after (all edits), n_pretokens, n_reencoded.

    ``edits``: array<struct<at: int, remove: int, insert: string>>, places in code points of
    the text as the edits before have left it. Nothing is kept; see ``token_trees``.
    """
    shared = _shared(df, vocabulary)
    src = df.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"), edits.alias("_edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared)
        for b in batches:
            rows = []
            for t, e in zip(b.column(1), b.column(2)):
                tree = Tree(t.as_py() or "", counter)
                before, pieces = tree.n_tokens, sum(len(a) for a, _ in tree.leaves)
                tree.apply(e.as_py())
                rows.append((before, tree.n_tokens, pieces, tree.encoded))
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in rows], pa.int64()) for i in range(4)]],
                                             names=[id_col, "n_tokens", "n_tokens_after", "n_pretokens", "n_reencoded"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, n_tokens long, n_tokens_after long, "
                               "n_pretokens long, n_reencoded long")


TREE = "text string, lengths array<int>, counts array<int>, n_tokens long, n_reencoded long"


def _trees(src: DataFrame, id_col: str, vocabulary: str, kept: bool) -> DataFrame:
    """``src``: id, text, then the kept lengths, counts and the edits if ``kept``."""
    shared = _shared(src, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared)
        for b in batches:
            out = []
            for row in zip(*b.columns[1:]):
                text, *more = [v.as_py() for v in row]
                tree = Tree(text or "", counter, *more[:2])
                if kept:
                    tree.apply(more[2])
                out.append((tree.text, *tree.parts(), tree.n_tokens, tree.encoded))
            kinds = (pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]],
                                             names=[id_col, "text", "lengths", "counts", "n_tokens", "n_reencoded"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, {TREE}")


def token_trees(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                vocabulary: str = VOCABULARY) -> DataFrame:
    """The trees of all rows, to be written and kept: id, text, lengths and counts of the
    pre-tokens, n_tokens, n_reencoded (0). Inner sums follow from these without an encoding."""
    return _trees(df.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text")), id_col, vocabulary, False)


def edit_trees(trees: DataFrame, edits: Column, id_col: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """Kept trees after their ``edits`` (an expression over ``trees``), as trees again: only the
    pre-tokens that the edits touch are encoded (``n_reencoded``)."""
    return _trees(trees.select(id_col, "text", "lengths", "counts", edits.alias("_edits")), id_col, vocabulary, True)
