"""License scans (1): sparse TF-IDF cosine of headers and licence files to templates, then
inheritance from the nearest ancestor directory by path joins.

* Vectors. Terms are lower-cased words; the weight is the count times
  ln((1 + N) / (1 + df)) + 1 with df counted over all N documents, for every term. The
  counts stay on the executors (the driver receives those of the templates' terms, a few
  hundred rows): the other terms of the candidates are joined to them for the norms.
* Templates. Notices, and the whole texts of licences (``license_texts``; those of the
  CC BY licences are not there). Holder and years of a copyright statement are no terms.
* Candidates. Every line of every text (a header), every run of lines about as long as a
  template (a notice wrapped over lines, a licence within a file), and the whole text (a
  licence file). Of headers that overlap the one with the highest score stays. A text is
  compared in runs if the templates' terms that it holds can reach the threshold. A
  segment without an anchor term is skipped without loss: anchors are chosen so that the
  other terms of a template cannot reach the threshold together. Nor is one lost that stays
  below the threshold even if its other terms had the least weight there is (1, df = N).
* Inheritance. A licence file (a name such as LICENSE, or a whole text that matches) declares
  its licence for its directory; each directory takes that of its nearest ancestor, itself
  first. Directories, not documents, are exploded into ancestors and joined; the documents
  then join the directories (AQE splits a hot directory).

Defined results: null and empty texts match nothing; a null path is in no directory and
inherits nothing; among equal scores the first name in code point order wins; null and
repeated ids give a row each; empty table: empty result; other columns are not read.
"""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint

# Licence notices and the opening words of licence files.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": (
        "Released under the GNU Affero General Public License version 3.",
        "GNU Affero General Public License version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Apache License",
        "This software is licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "BSD 2-Clause License"),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "Licensed under the Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",
                     "Licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",
                     "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": (
        "Licensed under CC0 1.0.",
        "CC0 1.0 Universal",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights "
        "to this software to the public domain worldwide. This software is distributed without any warranty."),
    "GPL-2.0": (
        "Released under the GNU General Public License version 2.",
        "GNU General Public License version 2",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "GPL-3.0": (
        "Released under the GNU General Public License version 3.",
        "GNU General Public License version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "ISC": (
        "Released under the ISC License.",
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-2.1": (
        "Released under the GNU Lesser General Public License version 2.1.",
        "GNU Lesser General Public License version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version."),
    "LGPL-3.0": (
        "Released under the GNU Lesser General Public License version 3.",
        "GNU Lesser General Public License version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "MIT": (
        "Released under the MIT License.",
        "MIT License",
        "This code is licensed under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "Proprietary": ("All rights reserved.", "Copyright. All rights reserved. Confidential and proprietary."),
    "Unlicense": ("Released under the Unlicense.", "This is free and unencumbered software released into the public domain."),
}
THRESHOLD = 0.8
MAX_TERMS = 1 << 17  # that a task counts before it hands them on
LICENSE_FILE_RE = r"(?i)^(un)?licen[sc]e|^copying|^notice"
_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_HOLDER = re.compile(r"\bcopyright\b[^\n]{0,200}?\ball rights reserved\b")
# Whole licence texts.
FILES: dict[str, str] = {name: pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode()
                         for name in ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0",
                                      "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")}


def terms(text: str) -> list[str]:
    low = text.lower()
    if "all rights reserved" in low:
        low = _HOLDER.sub("copyright all rights reserved", low)
    return _TERM.findall(low)


class Template:
    """A template's unit vector, its length, and the terms one of which any match must hold."""

    def __init__(self, name: str, text: str, idf: dict[str, float], threshold: float, file: bool) -> None:
        words = terms(text)
        v = {t: n * idf[t] for t, n in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        self.name, self.n, self.file = name, len(words), file
        self.vector = {t: x / norm for t, x in v.items()}
        self.anchors: set[str] = set()
        rest = 0.0  # the commonest terms that cannot reach the threshold together
        for t in sorted(v, key=lambda t: (idf[t], t)):
            rest += self.vector[t] ** 2
            if rest >= threshold ** 2 - 1e-9:
                self.anchors.add(t)

    def reachable(self, have: set[str], threshold: float) -> bool:
        """No segment of a text with these terms can reach the threshold unless their part of the vector does."""
        if self.anchors.isdisjoint(have):
            return False
        return sum(self.vector[t] ** 2 for t in self.vector.keys() & have) >= threshold ** 2 - 1e-9


class Matcher:
    """Cosine of a segment with every template; idf: term -> weight, other: that of any other term."""

    def __init__(self, idf: dict[str, float], other: float, threshold: float = THRESHOLD) -> None:
        self.idf, self.other, self.threshold = idf, other, threshold
        self.vectors: list[tuple[str, dict[str, float]]] = []
        anchors: set[str] = set()
        for name in sorted(TEMPLATES):
            for text in TEMPLATES[name]:
                v = {t: n * idf[t] for t, n in Counter(terms(text)).items()}
                norm = math.sqrt(sum(x * x for x in v.values()))
                v = {t: x / norm for t, x in v.items()}
                self.vectors.append((name, v))
                rest = 0.0  # the lightest terms that cannot reach the threshold together
                for t in sorted(v, key=lambda t: (v[t], t)):
                    rest += v[t] ** 2
                    if rest >= threshold ** 2 - 1e-9:
                        anchors.add(t)
        self.anchors = anchors
        self.templates = [Template(name, text, idf, threshold, False) for name in sorted(TEMPLATES) for text in TEMPLATES[name]] \
            + [Template(name, FILES[name], idf, threshold, True) for name in sorted(FILES)]

    def best(self, words: list[str]) -> tuple[float, str] | None:
        if self.anchors.isdisjoint(words):
            return None
        v = {t: n * self.idf.get(t, self.other) for t, n in Counter(words).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        found = None
        for name, u in self.vectors:
            score = sum(x * v[t] for t, x in u.items() if t in v) / norm
            if score >= self.threshold and (found is None or score > found[0] + 1e-12):
                found = (score, name)
        return found

    def candidate(self, words: list[str], name: str, vector: dict[str, float]) -> dict:
        """What the cosine needs of a segment: the template and its product, the templates' part
        of the squared norm, and the other terms."""
        bag = Counter(words)
        v = {t: n * self.idf[t] for t, n in bag.items() if t in self.idf}
        rest = [t for t in bag if t not in self.idf]
        return {"license": name, "dot": sum(x * v[t] for t, x in vector.items() if t in v), "known": sum(x * x for x in v.values()),
                "terms": rest, "counts": [bag[t] for t in rest]}

    def nearest(self, words: list[str]) -> dict | None:
        """The candidate of a segment that can reach the threshold; whatever the norm is, the
        nearest notice is the one with the largest product."""
        got = self.best(words)
        return max((self.candidate(words, got[1], u) for name, u in self.vectors if name == got[1]),
                   key=lambda c: c["dot"]) if got else None

    def runs(self, lines: list[list[str]], template: Template) -> Iterator[tuple[int, int]]:
        """(first, last + 1) of the runs of lines about as long as the template (just as long or
        longer, and a line shorter) that can reach the threshold."""
        u, idf, limit = template.vector, self.idf, self.threshold - 1e-9
        least = 1 if template.file else 2
        held = [0]  # lines with an anchor, summed up
        for x in lines:
            held.append(held[-1] + (not template.anchors.isdisjoint(x)))
        bag: Counter = Counter()
        dot = square = 0.0
        n = last = 0

        def put(words: list[str], sign: int) -> None:
            nonlocal dot, square, n
            for t in words:
                w, c = idf.get(t, self.other), bag[t]
                bag[t] = c + sign
                square += ((c + sign) ** 2 - c * c) * w * w
                dot += sign * w * u.get(t, 0.0)
            n += sign * len(words)

        def fits(first: int, end: int) -> bool:
            return end - first >= least and held[end] > held[first] and square > 0 and dot >= limit * math.sqrt(square)

        for first, words in enumerate(lines):
            while last < len(lines) and n < template.n:
                put(lines[last], 1)
                last += 1
            if words:
                if fits(first, last):
                    yield first, last
                if last - first > 1 and lines[last - 1]:
                    put(lines[last - 1], -1)
                    if fits(first, last - 1):
                        yield first, last - 1
                    put(lines[last - 1], 1)
            if last > first:
                put(words, -1)
            else:
                last = first + 1

    def scan(self, text: str) -> list[dict]:
        """The candidates among the lines and runs of lines, as code point spans, and the whole text."""
        words = terms(text)
        have = set(words)
        near = [t for t in self.templates if t.reachable(have, self.threshold)]
        if not near and self.anchors.isdisjoint(have):
            return []
        found: dict[tuple[int, int, bool], dict] = {}

        def add(start: int, end: int, whole: bool, got: dict | None) -> None:
            if got and ((start, end, whole) not in found or got["dot"] > found[start, end, whole]["dot"] + 1e-12):
                found[start, end, whole] = got

        lines, starts, at = [], [], 0
        for line in text.split("\n"):
            lines.append(terms(line))
            starts.append(at)
            at += len(line) + 1
            add(starts[-1], at - 1, False, self.nearest(lines[-1]))
        starts.append(at)
        add(0, len(text), True, self.nearest(words))
        for t in near:
            for first, end in self.runs(lines, t):
                run = [w for x in lines[first:end] for w in x]
                add(starts[first], starts[end] - 1, False, self.candidate(run, t.name, t.vector))
            if t.file:
                add(0, len(text), True, self.candidate(words, t.name, t.vector))
        return [got | {"start": s, "end": e, "whole": w} for (s, e, w), got in found.items()]


def document_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(term, n): the documents that hold each term; under "" all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                              names=["term", "n"])
        seen: Counter = Counter()
        for b in batches:
            for t in b.column(0):
                seen[""] += 1
                seen.update(set(terms(t.as_py() or "")))
                if len(seen) > MAX_TERMS:
                    yield flush()
                    seen.clear()
        yield flush()

    return checkpoint(df.select(F.col(text_col).alias("t")).mapInArrow(count, "term string, n long")
                      .groupBy("term").agg(F.sum("n").alias("n")))


def weights(counts: DataFrame) -> tuple[dict[str, float], float, int]:
    """Weights of the templates' terms, that of a term in no document, number of documents."""
    vocab = sorted({t for texts in (*TEMPLATES.values(), FILES.values()) for x in texts for t in terms(x)})
    got = {r.term: r.n for r in counts.where(F.col("term").isin(["", *vocab])).collect()}
    n = got.get("", 0)
    return {t: math.log((1 + n) / (1 + got.get(t, 0))) + 1 for t in vocab}, math.log(1 + n) + 1, n


def fit(df: DataFrame, text_col: str) -> tuple[dict[str, float], float]:
    """idf of the templates' terms over all documents."""
    return weights(document_counts(df, text_col))[:2]


def _scored(rows: DataFrame, counts: DataFrame, n: int, threshold: float) -> DataFrame:
    """(_r, headers, header, whole) of the rows with a segment at the threshold or above."""
    segments = rows.select(F.col("_rid").alias("_r"), F.inline("segments"))
    segment = ["_r", "start", "end", "whole", "license", "dot", "known"]
    other = segments.select(*segment, F.explode_outer(F.arrays_zip("terms", "counts")).alias("x")) \
        .select(*segment, F.col("x.terms").alias("_t"), F.col("x.counts").alias("_c"))
    weight = F.log(F.lit(1.0 + n) / (F.col("n") + 1)) + 1
    idf = counts.where(F.col("term") != "").select("term", weight.alias("idf"))
    square = F.pow(F.col("_c") * F.col("idf"), F.lit(2))
    found = other.join(idf, F.col("_t") == F.col("term"), "left").groupBy(*segment).agg(F.sum(square).alias("rest"))
    score = F.round(F.col("dot") / F.sqrt(F.col("known") + F.coalesce("rest", F.lit(0.0))), 12)
    found = found.withColumn("b", F.struct((-score).alias("s"), F.col("license").alias("l"))).where(F.col("b.s") <= -threshold)
    line = F.when(~F.col("whole"), F.struct(F.col("b.s").alias("s"), "start", "end", F.col("b.l").alias("l")))
    found = found.groupBy("_r").agg(F.array_sort(F.collect_list(line)).alias("lines"), F.min(F.when(F.col("whole"), F.col("b"))).alias("whole"))
    # The best first, without those that overlap one before.
    kept = F.aggregate("lines", F.filter("lines", lambda x: F.lit(False)), lambda got, x: F.when(
        F.exists(got, lambda g: (g["start"] < x["end"]) & (x["start"] < g["end"])), got).otherwise(F.concat(got, F.array(x))))
    return found.withColumn("kept", kept).select("_r", "whole", F.get("kept", F.lit(0)).alias("header"), F.array_sort(F.transform(
        "kept", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["l"].alias("license"),
                                   F.round(-x["s"], 6).alias("score")))).alias("headers"))


def ancestors(path: Column) -> Column:
    """array<struct<dir, depth>>: a directory and all above it, the root ("", 0) included."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(
        F.array_join(F.slice(parts, F.lit(1), k), "/").alias("dir"), k.alias("depth")))


def licenses(df: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, path, header_license, header_score, headers (spans), file_license,
    license (own header, else inherited), inherited_from (the declaring directory)."""
    counts = document_counts(df, text_col)
    idf, _, n = weights(counts)
    src = df.select(F.col(id_col).alias("_id"), path.alias("path"), F.col(text_col).alias("_text"))
    kind = pa.list_(pa.struct([
        ("start", pa.int32()), ("end", pa.int32()), ("whole", pa.bool_()), ("license", pa.string()), ("dot", pa.float64()),
        ("known", pa.float64()), ("terms", pa.list_(pa.string())), ("counts", pa.list_(pa.int32()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(idf, 1.0, threshold)  # at the least weight of all other terms nothing is lost
        for whole in batches:
            for at in range(0, len(whole), 500):
                b = whole.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([m.scan(t.as_py() or "") for t in b.column(2)], kind)],
                    names=["_id", "path", "segments"])

    base = checkpoint(src.mapInArrow(scan, f"_id {src.schema[0].dataType.simpleString()}, path string, segments array<struct<"
                                     "start:int,end:int,whole:boolean,license:string,dot:double,known:double,"
                                     "terms:array<string>,counts:array<int>>>").withColumn("_rid", F.monotonically_increasing_id()))
    found = _scored(base, counts, n, threshold)
    none = F.array().cast(found.schema["headers"].dataType)
    rows = checkpoint(base.drop("segments").join(found, F.col("_rid") == F.col("_r"), "left").select(
        "_id", "path", F.col("header.l").alias("header_license"), (-F.col("header.s")).alias("header_score"),
        F.coalesce("headers", none).alias("headers"), F.col("whole.l").alias("whole_license"), (-F.col("whole.s")).alias("whole_score")))
    clean = F.array_join(F.filter(F.split("path", "/"), lambda p: p != ""), "/")
    rows = rows.withColumn("_clean", clean).withColumn("_dir", F.regexp_replace("_clean", "(^|/)[^/]*$", ""))
    named = F.regexp_extract("_clean", "[^/]*$", 0).rlike(LICENSE_FILE_RE)
    rows = rows.withColumn("file_license", F.coalesce("whole_license", F.when(named, F.col("header_license")))) \
        .withColumn("_score", F.coalesce("whole_score", "header_score"))
    declared = rows.where(F.col("file_license").isNotNull() & F.col("_dir").isNotNull()).groupBy(F.col("_dir").alias("_at")) \
        .agg(F.max("_score").alias("_s"), F.min(F.struct((-F.col("_score")).alias("s"), F.col("file_license").alias("l"))).alias("_b")) \
        .select("_at", F.col("_b.l").alias("_license"))
    dirs = rows.where(F.col("_dir").isNotNull()).select("_dir").distinct()
    above = dirs.select(F.col("_dir").alias("_d"), F.inline(ancestors(F.col("_dir"))))
    nearest = checkpoint(above.join(declared, F.col("dir") == F.col("_at")).groupBy("_d")
                         .agg(F.max(F.struct("depth", "dir", "_license")).alias("n"))
                         .select("_d", F.col("n.dir").alias("_from"), F.col("n._license").alias("_inherited")))
    own = F.col("header_license").isNotNull() | F.col("file_license").isNotNull()
    return rows.join(nearest, F.col("_dir") == F.col("_d"), "left").select(
        F.col("_id").alias(id_col), "path", "header_license", "header_score", "headers", "file_license",
        F.coalesce("header_license", "file_license", "_inherited").alias("license"),
        F.when(~own, F.col("_from")).alias("inherited_from"))
