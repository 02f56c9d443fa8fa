"""The five stages as a chain against a plain version of the whole chain, and their edge cases."""

import hashlib
import os
import random
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from balancete.llm.mixing import SEED

from .test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def key_of(line):
    return lower(line.strip(SPACES))


def plain_quality(rows):
    texts = defaultdict(set)
    holders = defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text)
        for k in {key_of(x) for x in (text or "").split("\n")} - {""}:
            holders[host, k].add(text)
    out = []
    for d, text, host in rows:
        words = words_of(text)
        seen = defaultdict(list)
        for i in range(len(words) - 4):
            seen[tuple(words[i:i + 5])].append(i)
        repeated = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(5)}
        frequent = lambda x: key_of(x) and len(holders[host, key_of(x)]) >= 3 and \
            len(holders[host, key_of(x)]) > 0.05 * len(texts[host])
        lines = (text or "").split("\n")
        lost = sum(len(words_of(x)) for x in lines if frequent(x))
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        if not failed and not (lost and (len(words) - lost < 10 or lost > 0.8 * len(words))):
            out.append((d, "\n".join(x for x in lines if not frequent(x)), host))
    return out


def order(d):
    return (d is None, d or 0)


def plain_line_dedup(rows):
    holders = defaultdict(set)
    for d, text, _ in rows:
        for x in text.split("\n"):
            if len(key_of(x)) >= 10:
                holders[key_of(x)].add(d)
    stays = lambda x, d: len(holders[key_of(x)]) < 2 or d == min(holders[key_of(x)], key=order)
    return [(d, "\n".join(x for x in text.split("\n") if stays(x, d)), host) for d, text, host in rows]


def plain_simhash(rows):
    docs = {d: (d, text, host) for d, text, host in rows}
    ids = sorted(docs, key=order)
    got = plain_components({i: plain_fingerprint(docs[d][1]) for i, d in enumerate(ids)})
    return [docs[ids[i]] for i in sorted(set(got.values()))]


def plain_decontaminate(rows, items):
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    windows = defaultdict(set)
    for w in map(split, items):
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[len(w[i:i + 10])].add(tuple(w[i:i + 10]))
    clean = lambda w: not any(tuple(w[i:i + n]) in some for n, some in windows.items() for i in range(len(w)))
    return [r for r in rows if clean(split(r[1]))]


def plain_mix(rows):
    size = {d: len(words_of(text)) for d, text, _ in rows}
    sources = defaultdict(list)
    for d, _, host in rows:
        sources[host].append(d)
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(size[d] for d in sources[s]) for s in names}
    budget, capped = sum(total.values()), set()
    while True:
        rest = budget - sum(3 * total[s] for s in capped)
        share = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * total[s] if s in capped else rest * weight[s] / share for s in names}
        above = {s for s in names if s not in capped and target[s] > 3 * total[s]}
        if not above:
            break
        capped |= above
    queue = []
    for s in names:
        at = 0
        shuffled = lambda d: hashlib.md5(":".join([SEED] + [str(d)] * (d is not None)).encode()).hexdigest()
        for d in sorted(sources[s], key=lambda d: (shuffled(d), order(d))):
            at += size[d]
            queue += [((at + total[s] * e) / target[s], shuffled(d), order(d), e, d) for e in range(3)]
    taken, used = defaultdict(int), 0
    for *_, d in sorted(queue):
        used += size[d]
        if used > budget:
            break
        taken[d] += 1
    return {d: (size[d], total[s], target[s], taken[d], taken[d] * size[d]) for s in names for d in sources[s]
            if taken[d] and size[d]}


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    """Null, empty and very long texts, null hosts, a null id, repeated rows, copies, near copies, benchmark passages."""
    rng = random.Random(21)
    vocabulary = [f"{a}{b}" for a in "ka lo mi nu pe ra su te".split() for b in "dar fen gol hit jun".split()]
    prose = lambda n: " ".join(rng.choice(vocabulary) + str(rng.randrange(90)) for _ in range(n))
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leak = max((x for x in items if x), key=len)
    hot, shared = "Home / Log in", "This line of some length stands in two texts only"
    rows = [(100 + i, f"{prose(60)}\n{hot}\n{prose(30)}", "de", "big") for i in range(60)]
    rows += [(200 + i, f"{hot}\n{prose(4)}", "de", "big") for i in range(5)]
    rows += [(300, f"{shared}\n{prose(80)}", "de", "a"), (299, f"{prose(80)}\n  {shared.upper()}\t", "de", None)]
    copy = prose(300)
    rows += [(400 + i, copy, "de", ("a", "big", None)[i % 3]) for i in range(6)] + [(410, copy.upper(), "de", "a")]
    rows += [(500, f"{prose(40)} {leak.upper()} {prose(40)}", "de", "a"), (501, prose(90), "de", None)]
    rows += [(600, None, "de", "a"), (601, "", "de", "a"), (602, "\n \t\n", None, None), (None, f"{prose(70)}\n{shared}", "de", "a"),
             (603, "\n".join(prose(9) for _ in range(3000)), "de", "ÿ"), (604, "same words here again now " * 20, "de", "a")]
    rows += [(700, prose(66), "de", "a")] * 2
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    made = [{"doc_id": d, "text": t, "lang": lang, "source": s, "n_chars": len(t or "")} for d, t, lang, s in rows]
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([tuple(m[c] for c in schema.names) for m in made], schema).write.parquet(f"{folder}/documents.parquet")
    os.symlink(f"{SF}/benchmark.parquet", f"{folder}/benchmark.parquet")
    return folder, [(d, t, s) for d, t, _, s in rows], items


def test_chain_against_plain_chain(spark, awkward):
    folder, rows, items = awkward
    now = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    plain = {"quality": plain_quality, "line_dedup": plain_line_dedup, "simhash": plain_simhash,
             "decontaminate": lambda rows: plain_decontaminate(rows, items)}
    for name, version in plain.items():
        before, rows = len(rows), version(rows)
        got = stages[name](spark, now, folder)
        assert got.columns == now.columns
        found = got.collect()
        assert sorted([(r.doc_id, r.text, r.source) for r in found], key=repr) == sorted(rows, key=repr), name
        assert all(r.n_chars == len(r.text) for r in found)
        assert name == "line_dedup" or len(rows) < before  # something goes in the other three
        now = spark.createDataFrame(found, now.schema)
    want = plain_mix(rows)
    for last in (stages["mixing"](spark, now, folder), corpus_pipeline.run(spark, folder)):
        got = {r.doc_id: (r["size"], r.source_size, pytest.approx(r.target), r.epochs, r.taken) for r in last.collect()}
        assert got == want


def test_stages_of_empty_and_wider_tables(spark, awkward):
    folder = awkward[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id between 100 and 130")
    wide = docs.selectExpr("*", "1 AS kept", "'x' AS row", "2 AS _pos", "3 AS size", "'y' AS component_id", "0 AS taken")
    for name, stage in corpus_pipeline.STAGES:
        empty, got = stage(spark, docs.where("false"), folder), stage(spark, wide, folder)
        assert empty.count() == 0
        if name != "mixing":
            assert empty.columns == docs.columns and got.columns == wide.columns
            assert got.where("kept = 1 AND row = 'x' AND _pos = 2 AND size = 3 AND component_id = 'y'").count() == 31
