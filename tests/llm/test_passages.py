"""op10: the whole result against a plain version, recall by length, edge cases."""

import random

from balancete.llm import passages as P


def vocabulary(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def plain(rows):
    """Every line with a shingle against every other, every window of 20 words against all others."""
    ids = {}
    for d, text in rows:
        ids.setdefault(text or "", set()).add(d)
    texts = sorted(ids, key=lambda x: min(ids[x]))
    words = [x.lower().split() for x in texts]
    lines, windows = {}, {}
    for t, text in enumerate(texts):
        at = 0
        for line in text.lower().split("\n"):
            w = line.split()
            if len(w) >= 5:
                lines.setdefault(tuple(w), []).append((t, at))
            at += len(w)
        for i in range(len(words[t]) - 19):
            windows.setdefault(tuple(words[t][i:i + 20]), []).append((t, i))
    kinds = list(lines)
    sets = [{k[i:i + 5] for i in range(len(k) - 4)} for k in kinds]
    root = list(range(len(kinds)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(kinds)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    classes = {}
    for i, k in enumerate(kinds):
        classes.setdefault(find(i), []).extend((t, p, len(k), True) for t, p in lines[k])
    groups = list(classes.values()) + [[(t, p, 20, False) for t, p in at] for at in windows.values()]
    repeated, passage, removed, comp = ({t: set() for t in range(len(texts))} for _ in range(4))
    for g in groups:
        first = min(m[0] for m in g)
        if any(m[0] != first for m in g):
            for t, p, n, line in g:
                comp[t].add(first)
                repeated[t].update(range(p, p + n))
                if not line:
                    passage[t].update(range(p, p + n))
                if t != first:
                    removed[t].update(range(p, p + n))
    out = []
    for d, text in rows:
        t = texts.index(text or "")
        own, n = min(ids[text or ""]), len(words[t])
        copied = len(ids[text or ""]) > 1 and n > 0
        gone = set(range(n)) if copied and d != own else removed[t]
        start = min(comp[t]) if comp[t] else None
        out.append((d, min(ids[texts[start]]) if comp[t] else own if copied else d, n if copied else len(repeated[t]),
                    (n if n >= 20 else 0) if copied and n >= 20 else len(passage[t]), sorted(gone)))
    return sorted(out, key=str)


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.component_id, r.n_repeated_words, r.n_passage_words, [w for s in r.removed for w in range(s.start, s.end)])
                   for r in P.passages(df, **options).collect()), key=str)


def test_whole_result_against_a_plain_version(spark):
    for seed in range(2):
        rng = random.Random(seed)
        shared = [vocabulary(rng, n) for n in (5, 6, 9, 14, 20, 21, 25, 33, 47, 60, 120)]
        rows = []
        for d in range(90):
            words = []
            for _ in range(rng.randint(0, 4)):
                words += vocabulary(rng, rng.randint(0, 60))
                if rng.random() < 0.5:
                    part = list(rng.choice(shared))
                    if rng.random() < 0.2:
                        part[-1] = "edited"
                    own = rng.random() < 0.5
                    words += ["\n", *part, "\n"] if own else part
                if rng.random() < 0.3:
                    words.append("\n")
            rows.append((d * 3, " ".join(words)))
        rows += [(1000 + i, rows[i * 7][1]) for i in range(8)] + [(2000, ""), (2001, None), (2002, " \n\t"), (2003, "two words"), (2004, "two words")]
        rng.shuffle(rows)
        assert got(spark, rows) == plain(rows)
        assert got(spark, rows, max_group=3) == plain(rows)


def test_recall_by_length(spark):
    """Own lines of 5 words or more, and runs of 20 or more inside lines, are all found whole."""
    rng = random.Random(5)
    rows, want = [], {}
    for n in range(5, 61):
        for own in (True, False):
            passage = vocabulary(rng, n)
            for second in (False, True):
                before, after = vocabulary(rng, rng.randint(5, 60)), vocabulary(rng, rng.randint(5, 60))
                d = len(rows)
                rows.append((d, " ".join([*before, "\n", *passage, "\n", *after] if own else [*before, *passage, *after])))
                if second:
                    want[d] = list(range(len(before), len(before) + n)) if own or n >= 20 else []
    found = {r[0]: r[4] for r in got(spark, rows)}
    assert all(found[d] == w for d, w in want.items())
    assert all(not found[d] for d in range(0, len(rows), 2))


def test_repeated_ids_null_ids_ties_and_clashing_columns(spark):
    a, b = (" ".join(vocabulary(random.Random(s), 30)) for s in (1, 2))
    df = spark.createDataFrame([(None, a, 1, "x"), (None, b, 2, "x"), (4, a, 3, "x"), (4, a, 3, "x"), (4, b, 4, "x"), (5, "alone", 5, None)],
                               "doc_id long, text string, n int, removed string")
    rows = sorted((str(r.doc_id), r.component_id, r.n_repeated_words, r.n_removed_words) for r in P.passages(df).collect())
    assert rows == [("4", None, 30, 30)] * 3 + [("5", 5, 0, 0)] + [("None", None, 30, 0)] * 2
    same_id = spark.createDataFrame([(7, a), (7, a + " more"), (7, b)], "doc_id long, text string")
    assert sorted(r.n_removed_words for r in P.passages(same_id).collect()) in ([0, 0, 30], [0, 0, 31])
    assert {r.component_id for r in P.passages(same_id).collect()} == {7}


def test_very_long_lines_in_one_group(spark):
    """Two lines of 60,000 words that differ in one: linked, and compared in slices of the vocabulary."""
    rng = random.Random(3)
    line = [f"v{rng.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(line)), (2, " ".join([*line[:-1], "other"])), (3, " ".join(vocabulary(rng, 300)))]
    found = got(spark, rows)
    assert [(r[0], r[1], r[2], len(r[4])) for r in found] == [(1, 1, 60_000, 0), (2, 1, 60_000, 60_000), (3, 3, 0, 0)]


def test_forest_in_slices_of_the_vocabulary(monkeypatch):
    rng = random.Random(4)
    sets = [rng.sample(range(60), 30) for _ in range(12)]
    whole = P.jaccard_forest(list(range(12)), sets, 0.4)
    monkeypatch.setattr(P, "_CELLS", 60)
    assert P.jaccard_forest(list(range(12)), sets, 0.4) == whole and whole
