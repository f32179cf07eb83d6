"""Operator 7: licence scan by sparse TF-IDF cosine and directory inheritance.

Headers are the lines of a text that hold a licence word; licence files are recognised by name, or because
their whole text is a licence notice (cosine of at least ``WHOLE``). Both are compared with templates as sparse TF-IDF vectors; document
frequencies of the templates' terms are counted over all texts (a term that no template has weighs as one that no
document has). A header at or above the threshold gives the file its licence. A licence file gives its licence to its
directory, and a file without a licence of its own takes that of the nearest ancestor directory that has one:
directories, not files, are joined with their ancestors' paths.

Bounds: the templates' vocabulary is a parameter of some hundred terms; only its counts reach the driver.

Defined results: null and empty texts have no header; a null path has no directory and inherits nothing; a path without a
slash lies in the root directory ``""``; of several licences of a file or directory the most similar wins, then the first
by name; repeated rows are scanned each; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Notices of common licences, words of a header, names of licence files.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
HEADER_WORDS = ("licens", "licenc", "copyright", "spdx")
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|unlicense)([._\-][^/]*)?$"
THRESHOLD, WHOLE = 0.6, 0.8
_TERM_BYTES = bytes(b if chr(b).isalnum() and b < 128 or b > 127 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().translate(_TERM_BYTES).split()


def document_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and in how many each term of the vocabulary occurs."""
    names = sorted(vocabulary)

    def run(batches):
        n = Counter()
        for batch in batches:
            n[-1] += batch.num_rows
            for value in batch.column("_text"):
                n.update(names.index(t) for t in vocabulary.intersection(terms(value.as_py() or "")))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64())], names=["term", "n"])

    found = docs.select(F.col("_text")).mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row a term
    counts = {r.term: r.n for r in found}
    return counts.get(-1, 0), {t: counts.get(i, 0) for i, t in enumerate(names)}


class Matcher:
    def __init__(self, templates: dict[str, list[str]], n: int, counts: dict[bytes, int]):
        self.idf = {t: math.log((1 + n) / (1 + c)) + 1 for t, c in counts.items()}
        self.rare = math.log(1 + n) + 1
        self.templates = [(name, self.vector(form)) for name in sorted(templates) for form in templates[name]]

    def vector(self, text: str) -> dict[bytes, float]:
        v = {t: n * self.idf.get(t, self.rare) for t, n in Counter(terms(text)).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()}

    def best(self, text: str) -> tuple[float, str | None]:
        """Highest cosine of the text with a template, and its licence."""
        v = self.vector(text)
        scored = [(sum(x * v.get(t, 0.0) for t, x in w.items()), name) for name, w in self.templates]
        return max(scored, key=lambda s: s[0]) if scored else (0.0, None)


def scan(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, path, own (licence of its header), similarity, inherited, inherited_from, license."""
    kind = docs.schema[doc_id].dataType.simpleString()
    own = docs.select(F.col(doc_id).alias("_doc"), F.col(path).cast("string").alias("_path"), F.col(text).alias("_text"))
    vocabulary = frozenset(t for forms in templates.values() for form in forms for t in terms(form))
    n, counts = document_counts(own, vocabulary)
    matcher = Matcher(templates, n, counts)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        header, whole = [], []
        for value in batch.column("_text"):
            text = value.as_py() or ""
            low = text.lower()
            best = (0.0, None)
            if any(w in low for w in HEADER_WORDS):
                for line in text.split("\n"):
                    if any(w in line.lower() for w in HEADER_WORDS):
                        best = max(best, matcher.best(line), key=lambda s: s[0])
                whole.append(matcher.best(text))
            else:
                whole.append(best)
            header.append(best)
        columns = [pa.array(np.round([s for s, _ in found], 6)) for found in (header, whole)] + [pa.array([k for _, k in found], pa.string()) for found in (header, whole)]
        return pa.RecordBatch.from_arrays([batch.column("_doc"), batch.column("_path"), *columns], names=["_doc", "_path", "header", "whole", "header_license", "whole_license"])

    found = map_batches(own, run, f"_doc {kind}, _path string, header double, whole double, header_license string, whole_license string")
    folder = F.when(F.col("_path").contains("/"), F.regexp_replace("_path", "/[^/]*$", "")).when(F.col("_path").isNotNull(), F.lit(""))
    found = found.withColumn("_dir", folder)
    is_file = (F.col("whole") >= WHOLE) | (F.col("_path").rlike(LICENCE_FILE) & (F.col("header") >= threshold))
    licence, how = F.when(F.col("whole") >= F.col("header"), F.col("whole_license")).otherwise(F.col("header_license")), F.greatest("whole", "header")
    by_dir = (found.where(is_file & F.col("_dir").isNotNull()).groupBy("_dir")
              .agg(F.min(F.struct((-how).alias("s"), licence.alias("license"))).alias("best")).select(F.col("_dir").alias("ancestor"), F.col("best.license").alias("inherited")))
    inherited = nearest_ancestor(found.select("_dir").where("_dir IS NOT NULL").distinct(), by_dir)
    mine = F.when(F.col("header") >= threshold, F.col("header_license"))
    return (found.join(inherited, "_dir", "left").select(
        F.col("_doc").alias(doc_id), F.col("_path").alias("path"), mine.alias("own"), F.col("header").alias("similarity"),
        F.when(mine.isNull(), F.col("inherited")).alias("inherited"), F.when(mine.isNull(), F.col("inherited_from")).alias("inherited_from"),
        F.coalesce(mine, F.col("inherited")).alias("license")))


def nearest_ancestor(dirs: DataFrame, by_dir: DataFrame) -> DataFrame:
    """_dir, inherited, inherited_from: of the directory itself or its nearest ancestor with a licence.

    Joins every directory's ancestor paths, at most as many as the path has parts.
    """
    parts = F.split("_dir", "/")
    paths = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")))
    up = dirs.select("_dir", F.explode(F.array_distinct(paths)).alias("ancestor"))
    return up.join(by_dir, "ancestor").groupBy("_dir").agg(
        F.max_by("inherited", F.length("ancestor")).alias("inherited"), F.max_by("ancestor", F.length("ancestor")).alias("inherited_from"))
