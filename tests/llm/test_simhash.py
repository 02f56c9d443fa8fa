"""SimHash against a brute force over all pairs, and its edge cases."""

import random

import numpy as np
from xxhash import xxh64_intdigest

from balancete.llm import simhash as S
from balancete.llm.components import components


def plain_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(fps):
    """{doc_id: smallest id reachable} from {doc_id: fingerprint}."""
    parent = {d: d for d in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: find(d) for d in ids}


def near(rng, base, flips):
    for _ in range(flips):
        base ^= 1 << rng.randrange(64)
    return base


def test_bit_sliced_link_equals_all_pairs():
    rng = random.Random(1)
    fps = list({near(rng, b, rng.randint(0, 4)) for b in [rng.getrandbits(64) for _ in range(30)] for _ in range(9)})
    for radius in range(4):
        parent = {x: x for x in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        edges = S.link([np.array(fps, dtype="<u8")], radius)
        for a, b in edges:
            parent[find(a % 2**64)] = find(b % 2**64)
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= radius:
                    assert find(a) == find(b)
        assert all(find(a % 2**64) == find(b % 2**64) for a, b in edges)
        assert len(edges) == len(fps) - len({find(x) for x in fps})


def test_documents_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    fps = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    want = plain_components(fps)
    got = S.simhash(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (d, f"{fps[d]:016x}", want[d]) for d in fps}


def test_hot_groups_are_divided_without_losing_links(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = list({near(rng, centre, rng.randint(0, 5)) for _ in range(150)} | {rng.getrandbits(64) for _ in range(40)})
    want = plain_components(dict(enumerate(fps)))
    df = spark.createDataFrame([((f + 2**63) % 2**64 - 2**63,) for f in fps], "fp bigint")
    for max_group in (4096, 16, 3):
        edges = S.near_links(df, max_group=max_group)
        roots = {r.node: r.root for r in components(edges).collect()}
        signed = [r.fp for r in df.collect()]
        classes = {}
        for i, f in enumerate(signed):
            classes.setdefault(roots.get(f, f), []).append(i)
        assert {i: min(c) for c in classes.values() for i in c} == want


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (5, "One two", "a"), (4, "one TWO", "b"),
            (4, "one TWO", "b"), (None, "solo text of its own", "c"), (9, "solo text of its own", "c"),
            (None, "another lonely text here", "d"), (7, "lang " * 20000, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumnRenamed("fp", "_id")
    got = {(r.doc_id, r.component_id) for r in S.simhash(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (5, 4), (4, 4), (None, 9), (9, 9), (None, None), (7, 7)}
    kept = S.simhash_documents(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect() if r.doc_id) == [
        (False, 1), (False, 4), (False, 7), (False, 9)]
    assert kept.where("doc_id is null").count() == 1
    assert S.simhash(df.where("false")).count() == 0 and S.simhash_documents(df.where("false")).count() == 0
