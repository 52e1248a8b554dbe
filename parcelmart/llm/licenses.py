"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest ancestor directory.

Every line of every text, and every stretch of a line as long as a template, is held against the templates, and so is every
whole text, which tells licence files. Weights
come from document frequencies over the whole corpus, for the terms of the templates only. A file without a licence of
its own takes that of the nearest directory above it with a licence file, found by joining directories with their
ancestors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from parcelmart.llm.common import stored, table, text_batches

LINE_COSINE = 0.6
FILE_COSINE = 0.75
BROADCAST_BYTES = 16 << 20
TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
# Lines longer than this many terms are matched in overlapping windows instead of whole.
WINDOW = 24
# Most a term outside the templates weighs: like one in a thousand texts, however many there are.
UNKNOWN_WEIGHT = math.log(1000) + 1
# Wordings of licence notices.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License.",
        "Apache License Version 2.0, January 2004",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
    ],
    "BSD-3-Clause": [
        "Use of this source code is governed by a BSD-style license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "GNU General Public License, version 2, June 1991",
    ],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "Licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0-1.0": ["CC0 1.0 Universal public domain dedication.", "Dedicated to the public domain under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
HITS = "doc_id bigint, path string, directory string, license string, cosine double, file_license string, file_cosine double"


def terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


class Matcher:
    """Template vectors under given term weights."""

    def __init__(self, templates: Mapping[str, list[str]], weights: Mapping[str, float], least: float) -> None:
        self.weights, self.least = weights, least
        self.unknown = min(UNKNOWN_WEIGHT, max(weights.values()))
        self.vectors = []
        for name, texts in templates.items():
            for text in texts:
                vector = {t: n * weights[t] for t, n in Counter(terms(text)).items()}
                norm = math.sqrt(sum(v * v for v in vector.values()))
                self.vectors.append((name, {t: v / norm for t, v in vector.items()}))
        lengths = [len(terms(text)) for texts in templates.values() for text in texts]
        # A vector without any of a template's anchors has a cosine below ``least``: the rest of it is too short.
        self.anchors: set[str] = set()
        self.stretches: list[tuple[str, dict[str, float], int, set[str]]] = []
        for (name, vector), length in zip(self.vectors, lengths):
            rest, own = 1.0, set()
            self.stretches.append((name, vector, length, own))
            for t in sorted(vector, key=lambda t: (-vector[t], t)):
                if rest < least * least * 0.999:
                    break
                own.add(t)
                rest -= vector[t] ** 2
            self.anchors |= own

    def best(self, found: list[str]) -> tuple[float, str | None]:
        """Highest cosine of a template; a term outside the templates counts like a rare one."""
        counts = Counter(found)
        vector = {t: n * self.weights.get(t, self.unknown) for t, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        best, name = 0.0, None
        for template, weights in self.vectors:
            dot = sum(v * vector[t] for t, v in weights.items() if t in vector)
            if dot / norm > best + 1e-12:
                best, name = dot / norm, template
        return best, name

    def line(self, line: str) -> tuple[float, str | None]:
        """Best match of a line or, if it is long, of its windows around anchors, and of its stretches."""
        found = terms(line)
        if self.anchors.isdisjoint(found):
            return 0.0, None
        if len(found) <= WINDOW:
            best = self.best(found)
        else:
            spots = {max(0, i - k) for i, t in enumerate(found) if t in self.anchors for k in range(0, WINDOW, 2)}
            best = max((self.best(found[s : s + n]) for s in spots for n in (6, 11, WINDOW)), key=lambda b: b[0])
        return self.stretch(found, best)

    def stretch(self, found: list[str], best: tuple[float, str | None]) -> tuple[float, str | None]:
        """The better of ``best`` and any stretch as long as a template, at every start that holds an anchor of it."""
        weights = [self.weights.get(t, self.unknown) for t in found]
        for name, vector, length, anchors in self.stretches:
            if length >= len(found) or anchors.isdisjoint(found):
                continue
            last = len(found) - length
            spots = [i for i, t in enumerate(found) if t in anchors]
            for s in sorted({s for i in spots for s in range(max(0, i - length + 1), min(i, last) + 1)}):
                counts: dict[str, float] = {}
                for t, w in zip(found[s : s + length], weights[s : s + length]):
                    counts[t] = counts.get(t, 0.0) + w
                dot = sum(v * counts[t] for t, v in vector.items() if t in counts)
                cosine = dot / math.sqrt(sum(v * v for v in counts.values()))
                if cosine > best[0] + 1e-12:
                    best = cosine, name
        return best

    def text(self, text: str) -> tuple[tuple[float, str | None], tuple[float, str | None]]:
        """Best match of any line, and of the text as a whole."""
        lower = text.lower()
        if not any(a in lower for a in self.anchors):
            return (0.0, None), (0.0, None)
        line = max((self.line(x) for x in lower.split("\n")), key=lambda b: b[0])
        # The whole can only match if one of its lines comes near.
        return line, self.best(terms(lower)) if line[0] >= self.least / 2 else (0.0, None)


def template_terms(templates: Mapping[str, list[str]]) -> set[str]:
    return {t for texts in templates.values() for text in texts for t in terms(text)}


def term_weights(texts: DataFrame, templates: Mapping[str, list[str]]) -> dict[str, float]:
    """Inverse document frequencies of the templates' terms over all texts."""
    vocabulary = template_terms(templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = Counter(), 0
        for batch in text_batches(batches):
            for text in batch.column(0).to_pylist():
                n += 1
                seen.update(vocabulary.intersection(terms(text or "")))
        rows = [("", n), *seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows]), pa.array([k for _, k in rows], pa.int64())], names=["term", "n"])

    found = texts.select("text").mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    df = {r["term"]: r["n"] for r in found.collect()}  # at most one row per term of the templates
    total = df.get("", 0)
    return {t: math.log((total + 1) / (df.get(t, 0) + 1)) + 1 for t in vocabulary}


def directory_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def directory_licenses(files: DataFrame) -> DataFrame:
    """The licence of each directory that has a licence file: highest cosine, then name, decide between several."""
    best = F.max_by("file_license", F.struct("file_cosine", "file_license")).alias("directory_license")
    return files.filter("file_license IS NOT NULL").groupBy("directory").agg(best)


def inherited(directories: DataFrame, licensed: DataFrame) -> DataFrame:
    """For each directory the nearest licensed one among itself and its ancestors."""
    parts = F.split("directory", "/")
    steps = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    above = directories.select("directory", F.posexplode(F.array_distinct(steps)).alias("depth", "ancestor"))
    named = licensed.select(F.col("directory").alias("ancestor"), "directory_license")
    nearest = F.max_by(F.struct("ancestor", "directory_license"), "depth").alias("nearest")
    return above.join(named, "ancestor").groupBy("directory").agg(nearest)


def scan_licenses(
    docs: DataFrame,
    path: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    templates: Mapping[str, list[str]] = TEMPLATES,
    line_cosine: float = LINE_COSINE,
    file_cosine: float = FILE_COSINE,
) -> DataFrame:
    """One row per input row: its licence, how it was found (``header``, ``inherited`` or ``none``), the best cosine of a
    line and of the whole text, and the directory it was inherited from.

    A text that as a whole matches a template is a licence file and speaks for its directory. NULL and empty texts
    match nothing but inherit; a NULL path counts as empty, so the file lies in the root. Ties go to the template listed
    first. Ids may be NULL or repeat; other columns are not read.
    """
    place = F.coalesce(path.cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), place.alias("path"), F.col(text).cast("string").alias("text"))
    weights = term_weights(rows, templates)
    schema = to_arrow_schema(_parse_datatype_string(HITS))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(templates, weights, min(line_cosine, file_cosine))
        for batch in text_batches(batches):
            found = [matcher.text(t or "") for t in batch.column(3).to_pylist()]
            columns = [
                [line[1] if line[0] >= line_cosine else None for line, _ in found],
                [line[0] for line, _ in found],
                [whole[1] if whole[0] >= file_cosine else None for _, whole in found],
                [whole[0] for _, whole in found],
            ]
            arrays = [*batch.columns[:3], *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[3:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    hits = stored(rows.select("doc_id", "path", directory_of(F.col("path")).alias("directory"), "text").mapInArrow(scan, HITS), "licenses")
    near = stored(inherited(hits.select("directory").distinct(), directory_licenses(hits)), "inherited")
    size = near.agg(F.sum(2 * F.octet_length("directory") + 96).alias("bytes")).first()["bytes"] or 0
    joined = hits.join(F.broadcast(near) if size <= BROADCAST_BYTES else near, "directory", "left")
    own = F.col("license").isNotNull()
    above = F.col("nearest.directory_license")
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("license", above).alias("license"),
        F.when(own, "header").when(above.isNotNull(), "inherited").otherwise("none").alias("found_in"),
        "cosine",
        "file_cosine",
        F.when(~own, F.col("nearest.ancestor")).alias("inherited_from"),
    )


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Documents as files below ``source/lang/``."""
    docs = table(spark, sf_dir, "documents")
    return scan_licenses(docs, F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")))
