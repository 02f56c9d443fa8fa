"""Licences, token counts, passages against plain versions, and edge cases."""

import random

from pyspark.sql import functions as F

from balancete.llm import passages as P
from balancete.llm import queries
from balancete.llm.licenses import Matcher, TEMPLATES, fit, licenses, terms
from balancete.llm.token_counts import VOCABULARY, Counter, Tree, token_counts

SF = "/root/testdata/sf0.001"


def test_every_segment_against_all_templates(spark):
    """The anchor filter loses nothing: cosines of all lines with all templates, computed plainly."""
    import math
    from collections import Counter as Bag
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    idf, other = fit(docs, "text")
    m = Matcher(idf, other, 0.5)

    def cosine(a, b):
        w = lambda bag: {t: n * idf.get(t, other) for t, n in bag.items()}
        x, y = w(Bag(a)), w(Bag(b))
        return sum(v * y.get(t, 0) for t, v in x.items()) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    lines = [terms(x) for r in docs.collect() for x in (r.text or "").split("\n")] + [terms("released under the license"), terms("the of under")]
    for words in lines:
        best = max((cosine(words, terms(t)) for texts in TEMPLATES.values() for t in texts), default=0) if words else 0
        got = m.best(words)
        assert (got is not None) == (best >= 0.5) and (got is None or abs(got[0] - best) < 1e-9)


def test_cosines_use_the_true_weight_of_every_term(spark):
    """A line whose other words are common is found; one whose other words are rare is not."""
    import math
    from collections import Counter as Bag
    line = "This work is licensed under the GNU General Public License, version 3."
    rare = "zyx wvu is licensed under the GNU General Public License, version 3."
    texts = ["this work is what we do"] * 2000 + [f"code\n{line}\ncode", f"code\n{rare}\ncode"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    count = Bag(t for x in texts for t in set(terms(x)))
    idf = lambda t: math.log((1 + len(texts)) / (1 + count[t])) + 1

    def cosine(a, b):
        x, y = ({t: n * idf(t) for t, n in Bag(terms(w)).items()} for w in (a, b))
        return sum(v * y.get(t, 0) for t, v in x.items()) / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    want = {x: max(cosine(x, t) for t in TEMPLATES["GPL-3.0"]) for x in (line, rare)}
    assert want[line] >= 0.8 > want[rare]
    got = {r.doc_id: r for r in licenses(df, F.lit(None).cast("string")).collect()}
    assert [(h["start"], h["end"], h["license"]) for h in got[2000].headers] == [(5, 5 + len(line), "GPL-3.0")]
    assert abs(got[2000].header_score - want[line]) < 1e-9
    assert got[2001].license is None and got[0].license is None


def test_wrapped_notices_whole_licences_and_short_headers(spark):
    """Notices wrapped over comment lines, licence texts with other lines around, short headers."""
    from balancete.llm.licenses import FILES
    mit = """# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction"""
    bsd = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met"""
    rows = {0: (f"import os\n{mit}\nx = 1", "MIT"), 1: (f"int a;\n{bsd}\nint b;", "BSD-3-Clause"), 2: ("MIT License\n\nplain", "MIT"),
            3: ("Apache License", "Apache-2.0"), 4: ("# Copyright 2020 Acme Inc. All rights reserved.\ncode", "Proprietary"),
            5: ("This code is licensed under the MIT License.", "MIT"), 6: ("plain words about nothing", None)}
    for i, name in enumerate(sorted(FILES)):
        rows[10 + i] = (f"Copyright (c) 2020 Some One\n{FILES[name]}", name)
        rows[20 + i] = ("first line of code\n" * 3 + FILES[name] + "\nlast line of code" * 3, name)
    prose = [(1000 + i, f"plain words number{i} of other things\nand this is the next of them") for i in range(200)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in rows.items()] + prose, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses(df, F.lit(None).cast("string")).collect()}
    assert {i: got[i].license for i in rows} == {i: want for i, (_, want) in rows.items()}
    assert all(got[i].license is None for i, _ in prose)
    assert [got[10 + i].file_license for i in range(len(FILES))] == sorted(FILES)
    assert [rows[0][0][h.start:h.end] for h in got[0].headers] == [mit]
    assert [rows[1][0][h.start:h.end] for h in got[1].headers] == [bsd]


def plain_licenses(docs, templates, threshold=0.8):
    """doc -> (headers, licence of the whole text): the cosine of every line, run of lines and text
    with every template, with weights counted over all documents."""
    import math
    from collections import Counter as Bag
    count = Bag(t for text in docs.values() for t in set(terms(text or "")))

    def vector(words):
        return {t: n * (math.log((1 + len(docs)) / (1 + count[t])) + 1) for t, n in Bag(words).items()}

    def norm(v):
        return math.sqrt(sum(x * x for x in v.values()))

    known = [(name, file, len(terms(text)), vector(terms(text))) for name, text, file in templates]
    out = {}
    for d, text in docs.items():
        lines = (text or "").split("\n")
        words, starts = [terms(x) for x in lines], [0]
        for x in lines:
            starts.append(starts[-1] + len(x) + 1)
        spans, whole, made = {}, [], {}
        whole_words = terms(text or "")

        def score(key, bag, u):
            if key not in made:
                made[key] = vector(bag)
                made[key] = (made[key], norm(made[key]))
            v, size = made[key]
            return round(sum(x * v[t] for t, x in u.items() if t in v) / size / norm(u), 12) if size else 0.0

        for name, file, n, u in known:
            runs = set() if file else {(i, i + 1) for i in range(len(lines))}
            for i in (i for i in range(len(lines)) if words[i]):
                end = i
                while end < len(lines) and sum(map(len, words[i:end])) < n:
                    end += 1
                runs |= {(i, e) for e in ((end, end - 1) if words[end - 1] else (end,)) if e - i >= (1 if file else 2)}
            for i, e in runs:
                s = score((i, e), [w for x in words[i:e] for w in x], u)
                if s >= threshold:
                    spans.setdefault((starts[i], starts[e] - 1), []).append((-s, name))
            s = score("whole", whole_words, u)
            if s >= threshold:
                whole.append((-s, name))
        kept = []
        for s, start, end, name in sorted((*min(found)[:1], *span, min(found)[1]) for span, found in spans.items()):
            if all(end <= a or b <= start for a, b, _, _ in kept):
                kept.append((start, end, name, round(-s, 6)))
        out[d] = sorted(kept), min(whole)[1] if whole else None
    return out


def test_whole_scan_against_brute_force(spark):
    """Lines, runs, whole texts, their scores and what is kept of overlapping headers."""
    from balancete.llm.licenses import FILES
    files = {k: FILES[k] for k in ("BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "Unlicense")}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 2500").limit(150).collect()}
    notices = sorted(x for texts in TEMPLATES.values() for x in texts)
    for i, x in enumerate(notices):
        w = x.split()
        docs[10_000 + i] = f"code here\n# {' '.join(w[:len(w) // 2])}\n# {' '.join(w[len(w) // 2:])}\n\nmore code\n{notices[i - 1]}\nend"
    for i, (name, x) in enumerate(files.items()):
        docs[20_000 + i], docs[21_000 + i] = x, f"some code\n\n{x}\n\nand more of it\n" + "words of prose " * 40
    docs |= {30_000: None, 30_001: "", 30_002: "\n\n", 30_003: "MIT License\nMIT License\n\nMIT License"}
    templates = [(k, x, False) for k in sorted(TEMPLATES) for x in TEMPLATES[k]] + [(k, FILES[k], True) for k in sorted(FILES)]
    want = plain_licenses(docs, templates)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.doc_id: ([(h.start, h.end, h.license, h.score) for h in r.headers], r.file_license)
           for r in licenses(df, F.lit(None).cast("string")).collect()}
    assert {d for d in docs if got[d] != want[d]} == set()
    assert sum(bool(h) for h, _ in got.values()) > len(notices)


def test_inheritance_from_the_nearest_directory(spark):
    rows = [("r/LICENSE", "Released under the MIT License."), ("r/a/COPYING", "Licensed under the Apache License, Version 2.0."),
            ("r/a/b/x.py", "plain words only"), ("r/y.py", "plain words"), ("r/a/z.py", "code\n# Licensed under CC BY-NC 4.0.\ncode"),
            ("s/q.py", "nothing"), ("top.py", None), (None, ""), ("r//a/w.py", "plain"), ("r/LICENSE", "Released under the MIT License.")]
    df = spark.createDataFrame([(i, p, t, 0) for i, (p, t) in enumerate(rows)], "doc_id long, where string, text string, license int")
    got = {r.doc_id: (r.license, r.inherited_from) for r in licenses(df, F.col("where")).collect()}
    assert got == {0: ("MIT", None), 1: ("Apache-2.0", None), 2: ("Apache-2.0", "r/a"), 3: ("MIT", "r"), 4: ("CC-BY-NC-4.0", None),
                   5: (None, None), 6: (None, None), 7: (None, None), 8: ("Apache-2.0", "r/a"), 9: ("MIT", None)}
    assert licenses(df.where("false"), F.col("where")).count() == 0


def test_license_query_against_plain_inheritance(spark):
    rows = [r.asDict() for r in queries.q_licenses(spark, SF).collect()]
    declared = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        if r["file_license"]:
            declared.setdefault(r["path"].rsplit("/", 1)[0], set()).add(r["file_license"])
    for r in rows:
        want = r["header_license"] or r["file_license"]
        at = r["path"].rsplit("/", 1)[0]
        while not want and at:
            if at in declared:
                assert r["inherited_from"] == at and r["license"] in declared[at]
                break
            at = at.rsplit("/", 1)[0] if "/" in at else ""
        else:
            assert r["license"] == want


def test_tree_equals_full_encoding():
    counter = Counter(open(VOCABULARY, "rb").read())
    rng = random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "1", "23", ".", "!!", "'s", "'ll", "the ", " word", "’", "日本"]
    for _ in range(400):
        text = "".join(rng.choices(parts, k=rng.choice([0, 1, 5, 40, 400, 1500])))
        tree = Tree(text, counter)
        for _ in range(4):
            at, remove, insert = rng.randint(0, len(text) + 2), rng.choice([0, 1, 7, 60]), "".join(rng.choices(parts, k=rng.choice([0, 1, 30, 900])))
            tree.edit(at, remove, insert)
            at = min(at, len(text))
            text = text[:at] + insert + text[at + remove:]
            assert tree.text == text and tree.n_tokens == len(counter.encoding.encode_ordinary(text))


def test_token_query_against_full_encoding(spark):
    counter = Counter(open(VOCABULARY, "rb").read())
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("e", queries.corpus_edits(F.col("doc_id"), F.col("text")))
    want = {}
    for r in docs.collect():
        text = r.text
        for x in r.e:
            text = text[:x.at] + x.insert + text[x.at + x.remove:]
        want[r.doc_id] = (len(counter.encoding.encode_ordinary(r.text)), len(counter.encoding.encode_ordinary(text)))
    got = queries.q_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.n_tokens_after) for r in got} == want
    long = [r for r in got if r.n_pretokens > 500]
    assert long and all(r.n_reencoded < 0.2 * r.n_pretokens for r in long)


def test_token_edges(spark):
    df = spark.createDataFrame([(1, None, 0), (None, "a b", 0), (3, "", 1), (3, "", 1), (5, "x" * 300000, 2)], "doc_id long, text string, n_tokens int")
    edits = F.array(F.lit(None).cast("struct<at:int,remove:int,insert:string>"),
                    F.struct(F.lit(99).alias("at"), F.lit(None).cast("int").alias("remove"), F.lit(" end").alias("insert")))
    got = {(r.doc_id, r.n_tokens) for r in token_counts(df, edits).collect()}
    assert {(1, 0), (None, 2), (3, 0)} <= got
    assert all(r.n_tokens_after > r.n_tokens for r in token_counts(df, edits).where("doc_id = 1 OR doc_id IS NULL").collect())
    assert token_counts(df.where("false"), edits).count() == 0


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def test_planted_passages_are_found_and_clean_text_is_left(spark):
    rng = random.Random(12)
    shared = [words(rng, 51) for _ in range(6)]
    rows, holders = [], {}
    for d in range(120):
        text = words(rng, rng.randint(60, 400))
        if d % 4 == 0:
            k = (d // 4) % 6
            at = rng.randrange(len(text))
            text = text[:at] + shared[k] + text[at:]
            holders.setdefault(k, []).append(d)
        rows.append((d, " ".join(text) if d % 3 else "\n".join(" ".join(text[i:i + 9]) for i in range(0, len(text), 9))))
    got = {r.doc_id: r for r in P.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == 120
    for k, ds in holders.items():
        for d in ds:
            assert got[d].component_id == ds[0] and got[d].n_repeated_words >= P.SIZE
            assert (got[d].n_removed_words > 0) == (d != ds[0])
    for d in set(range(120)) - {d for ds in holders.values() for d in ds}:
        assert got[d].component_id == d and got[d].n_repeated_words == 0


def test_near_passages_link_by_exact_jaccard(spark):
    rng = random.Random(2)
    base = words(rng, 400)
    copy = list(base)
    for i in range(13, 400, 40):
        copy[i] = "changed"
    rows = [(1, " ".join(base)), (2, " ".join(copy)), (3, " ".join(words(rng, 400)))]
    got = {r.doc_id: r for r in P.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].component_id == 1 and got[2].n_removed_words > 100 and got[3].component_id == 3


def test_bands_find_nearly_every_pair_at_the_threshold():
    """20-word paragraphs that share 14 or 15 of 16 shingles (Jaccard 0.78 and 0.88) meet in a band."""
    rng = random.Random(8)
    met = 0
    for i in range(400):
        words = [f"w{rng.randrange(10**6)}".encode() for _ in range(P.SIZE)]
        other = words[:P.SIZE - 1] + [b"other"] if i % 2 else words[:P.SIZE - 2] + [b"two", b"others"]
        keys = P.paragraphs([words, other])[3]
        met += bool((keys[0] == keys[1]).any())
    assert met >= 0.985 * 400


def test_jaccard_forest_equals_all_pairs():
    rng = random.Random(7)
    sets = []
    for _ in range(40):
        s = rng.sample(range(1000), 16)
        sets.append(s)
        for _ in range(3):
            t = list(s)
            t[rng.randrange(16)] = rng.randrange(5000)
            sets.append(t)
    edges = P.jaccard_forest(list(range(len(sets))), sets, 0.8)

    def classes(pairs):
        parent = list(range(len(sets)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(sets))]

    plain = [(i, j) for i in range(len(sets)) for j in range(i) if len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))]
    assert classes(edges) == classes(plain)


def test_hot_keys_are_dealt_as_blocks(spark):
    rng = random.Random(9)
    base = words(rng, 60)
    rows = []
    for d in range(80):
        t = list(base)
        t[rng.randrange(60)] = f"v{d}"
        rows.append((d, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = sorted(map(str, P.passages(df).collect()))
    assert a == sorted(map(str, P.passages(df, max_group=4).collect()))


def test_passage_edges(spark):
    text = " ".join(words(random.Random(1), 60))
    df = spark.createDataFrame([(None, text, 0), (7, text, 1), (7, text, 1), (8, None, 2), (9, "few words", 3), (10, "", 4)], "doc_id long, text string, p int")
    got = {r.doc_id: (r.component_id, r.n_repeated_words > 0, r.n_removed_words > 0) for r in P.passages(df).collect()}
    assert got == {None: (None, True, False), 7: (None, True, True), 8: (8, False, False), 9: (9, False, False), 10: (10, False, False)}
    assert P.passages(df.where("false")).count() == 0


def test_short_texts_and_contractions_against_full_encoding():
    with open(VOCABULARY, "rb") as f:
        counter = Counter(f.read())
    full = lambda t: len(counter.encoding.encode_ordinary(t))
    tree = Tree("'r", counter)
    tree.edit(2, 0, "e")
    assert tree.n_tokens == full("'re") == 1
    rng = random.Random(8)
    for chars in ("'slrev ", "'lv1 \n.", " \t'a"):
        for _ in range(12_000):
            text = "".join(rng.choice(chars) for _ in range(rng.randrange(10)))
            tree = Tree(text, counter)
            for _ in range(rng.randrange(1, 4)):
                at, remove = rng.randrange(len(text) + 1), rng.randrange(4)
                insert = "".join(rng.choice(chars) for _ in range(rng.randrange(4)))
                tree.edit(at, remove, insert)
                text = text[:at] + insert + text[at + remove:]
                assert tree.text == text
                assert tree.parts()[0] == [len(p) for p in counter.split.findall(text)], (text, at, remove, insert)
            assert tree.n_tokens == full(text)


def test_kept_trees_encode_only_what_later_edits_touch(spark, tmp_path):
    from balancete.llm.token_counts import edit_trees, token_trees
    with open(VOCABULARY, "rb") as f:
        counter = Counter(f.read())
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(
        spark.createDataFrame([(None, None), (7, ""), (7, "it'")], "doc_id long, text string"))
    token_trees(df).write.parquet(f"{tmp_path}/0")
    one = lambda at, remove, insert: F.array(F.struct(F.lit(at).alias("at"), F.lit(remove).alias("remove"), F.lit(insert).alias("insert")))
    for k, e in enumerate([one(3, 1, "'ll be"), one(60, 0, " two words"), one(0, 9, "")]):
        trees = spark.read.parquet(f"{tmp_path}/{k}")
        assert set(trees.columns) == {"doc_id", "text", "lengths", "counts", "n_tokens", "n_reencoded"}
        edit_trees(trees, e).write.parquet(f"{tmp_path}/{k + 1}")
        got = spark.read.parquet(f"{tmp_path}/{k + 1}").collect()
        assert len(got) == df.count() and max(r.n_reencoded for r in got) <= 12
        assert all(r.n_tokens == len(counter.encoding.encode_ordinary(r.text)) == sum(r.counts) for r in got)
        assert all(r.lengths == [len(p) for p in counter.split.findall(r.text)] for r in got)
