"""Operator 13: spelling variants by a trie-node pair dictionary.

Every word is a path in a forward trie (its prefixes) and in a reversed trie (its suffixes). Both tries have their nodes numbered, and
a word of n code points is written into a dictionary of integer pairs (prefix node, suffix node): n pairs that skip
a position and n + 1 that split the word between positions. Two words that differ by one replaced code point share exactly
one skipping pair; a word and the same word with one code point inserted share a skipping pair of the longer with a splitting
pair of the shorter. Of a run of equal code points only the first may be skipped for that, so this pair is found once,
too. So equal pairs are the neighbours, all of them and nothing else, and no two words are ever compared.

A pair is shared by at most one word that splits there and by as many words that skip there as the alphabet has
letters, so a group is bounded by the alphabet however many words share a prefix, and counts and best neighbours are added up without
writing word pairs.

Nodes are numbered where the sorted words lie: words are dealt by range and sorted, a task keeps the path of the word before
and numbers what is new behind the common prefix. A prefix that reaches over a border between partitions has a number of that
border, worked out from the first and last words of the partitions (two words a partition reach the driver).

Defined results: null and empty texts have no words; a null id reads as an empty one where a draw names it; rows repeated
count each; ties go to the smaller word in code-point order; a word of any length is handled in time linear in it; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, pieces

MIN_CHARS, MIN_COUNT, RATIO = 7, 2, 10
LETTERS = "[A-Za-zÀ-ÿ]"
#: Distinct words a task holds before it hands their counts on, and rows of the pair dictionary it looks at together.
HELD, CHUNK = 200_000, 200_000


def slipped(word: str, doc_prefix: int, every: int) -> str:
    """The word, or where ``every`` divides its draw in this document, the word less the drawn code point."""
    draw = zlib.crc32(word.encode(), doc_prefix)
    at = draw % len(word)
    return word if draw % every else word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, slip_every: int | None = None) -> DataFrame:
    """word, n: the maximal runs of letters of all texts, A-Z lower-cased. ``slip_every`` drops a code point of one (document, run) in so many."""
    find = re.compile(f"{LETTERS}{{{min_chars},}}").findall  # a run is matched from its first letter, so maximal

    def emit(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for part in pieces(batch, "_text"):
                for doc, value in zip(part.column("_doc"), part.column("_text"), strict=True):
                    own = Counter(find(value.as_py().encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))) if value.is_valid else {}
                    if slip_every:
                        start = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                        for word, n in own.items():
                            if len(word := slipped(word, start, slip_every)) >= min_chars:
                                counts[word] += n
                    else:
                        counts.update(own)
                if len(counts) > HELD:
                    yield emit(counts)
                    counts = Counter()
        if counts:
            yield emit(counts)

    own = docs.select(F.col(doc_id).cast("string").alias("_doc"), F.col(text).alias("_text"))
    return own.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


def borders(parts: list[tuple[int, str, str]]) -> list[list[int]]:
    """Node numbers of the prefixes that partition i shares with the one before it, for its (number, first, last) words.

    A prefix held by all of the partition before and shared with the one before that keeps its number.
    """
    names: list[list[int]] = [[]]
    for i in range(1, len(parts)):
        (_, first, last), (p, own, _) = parts[i - 1], parts[i]
        through = min(common(first, last), len(names[-1]))
        names.append([names[-1][d] if d < through else -(p << 40) - d - 1 for d in range(common(last, own))])
    return names


def paths(words: Iterator[str], part: int, first: list[int], following: str | None, tail: list[int]) -> Iterator[list[int]]:
    """Node numbers of depth 0 (the root, 0) to n of each of the sorted words of a partition."""
    before, path, fresh = "", [0, *first], (part << 40) + 1
    for i, word in enumerate(words):
        if i:
            path = path[:common(before, word) + 1]
        outer = min(common(word, following), len(tail)) if tail else 0
        while len(path) <= outer:
            path.append(tail[len(path) - 1])
        more = len(word) + 1 - len(path)
        path = path + list(range(fresh, fresh + more))
        fresh += more
        before = word
        yield path


def numbered(words: DataFrame, reverse: bool) -> DataFrame:
    """rank, path: node numbers of the prefixes of every word, or with ``reverse`` of the words read backwards."""
    key = F.reverse("word") if reverse else F.col("word")
    spread = words.select("rank", key.alias("_w")).repartitionByRange("_w").sortWithinPartitions("_w")
    spread = durable(spread.select("rank", "_w", F.spark_partition_id().alias("_p")))
    ends = sorted((r._p, r.low, r.high) for r in spread.groupBy("_p").agg(F.min("_w").alias("low"), F.max("_w").alias("high")).collect())
    names = borders(ends)
    place = {p: i for i, (p, _, _) in enumerate(ends)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            for part in pieces(batch, "_w"):
                if walk is None:
                    i = place[part.column("_p")[0].as_py()]
                    source: list[str] = []
                    after = i + 1 < len(ends)
                    walk = paths(iter(source.pop, None), ends[i][0], names[i], ends[i + 1][1] if after else None, names[i + 1] if after else [])
                source.extend(reversed(part.column("_w").to_pylist()))
                found = [next(walk) for _ in range(part.num_rows)]
                offsets = np.zeros(part.num_rows + 1, np.int32)
                np.cumsum([len(f) for f in found], out=offsets[1:])
                flat = np.fromiter((x for f in found for x in f), np.int64, offsets[-1])
                yield pa.RecordBatch.from_arrays([part.column("rank"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["rank", "path"])

    return spread.mapInArrow(run, "rank bigint, path array<bigint>")


SPLIT, SKIP, FIRST = 0, 1, 2  # what a word does at a pair: split; skip; skip the first of a run of equal code points


def pair_dictionary(words: DataFrame) -> DataFrame:
    """p, s, x: node pairs of every word, with 4 * rank + what the word does there."""
    both = numbered(words, False).withColumnRenamed("path", "f").join(numbered(words, True).select("rank", F.reverse("path").alias("b")), "rank").join(words.select("rank", "word"), "rank")
    letters = F.split("word", "")
    both = both.select("rank", "f", "b", F.slice(letters, 1, F.size("f") - 1).alias("c"))
    n = F.size("f") - 1
    changes = F.zip_with(F.concat(F.array(F.lit("")), F.slice("c", 1, n - 1)), "c", lambda x, y: F.when(x == y, SKIP).otherwise(FIRST))
    zipped = lambda p, s, kind: F.inline(F.arrays_zip(p.alias("p"), s.alias("s"), kind.alias("kind")))
    skips = both.select("rank", zipped(F.slice("f", 1, n), F.slice("b", 2, n), changes))
    splits = both.select("rank", zipped(F.col("f"), F.col("b"), F.array_repeat(F.lit(SPLIT), n + 1)))
    return skips.union(splits).select("p", "s", (F.col("rank") * 4 + F.col("kind")).alias("x"))


def neighbours(p: np.ndarray, s: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """rank, count and least rank of the neighbours found in whole groups of equal pairs (rows sorted by pair)."""
    new = np.r_[True, (p[1:] != p[:-1]) | (s[1:] != s[:-1])]
    sizes = np.diff(np.r_[np.flatnonzero(new), len(p)])
    shared = np.repeat(sizes > 1, sizes)
    group, x = (np.cumsum(new) - 1)[shared], x[shared]
    if not len(x):
        return x, x, x
    order = np.lexsort((x, group))
    group, rank, kind = group[order], x[order] >> 2, x[order] & 3
    skip = kind != SPLIT
    out = []
    g, r = group[skip], rank[skip]  # replaced: all others that skip here; the best is the first, and for the first the second
    if len(g):
        starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        size = np.diff(np.r_[starts, len(g)])
        best = np.repeat(r[starts], size)
        second = starts[size > 1]
        best[second] = r[second + 1]
        many = np.repeat(size, size) > 1
        out.append((r[many], np.repeat(size - 1, size)[many], best[many]))
    split, first = np.flatnonzero(kind == SPLIT), kind == FIRST  # one splits at most
    g, r = group[first], rank[first]
    low, high = np.searchsorted(g, group[split], "left"), np.searchsorted(g, group[split], "right")
    some = high > low
    split, low, high = split[some], low[some], high[some]
    if len(split):
        out.append((rank[split], high - low, r[low]))
        inside = np.repeat(low, high - low) + np.arange((high - low).sum()) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        out.append((r[inside], np.ones(len(inside), np.int64), np.repeat(rank[split], high - low)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (x[:0], x[:0], x[:0])


def near_words(words: DataFrame) -> DataFrame:
    """rank, n_near, best: of every word with neighbours their number and the least rank. ``words``: rank, word (distinct)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def emit(last: bool):
            nonlocal held, rows
            p, s, x = (np.concatenate(c) for c in zip(*held, strict=True))
            end = len(p) if last else int(np.flatnonzero((p != p[-1]) | (s != s[-1]))[-1] + 1) if (p[0], s[0]) != (p[-1], s[-1]) else 0
            held, rows = [(p[end:], s[end:], x[end:])], len(p) - end
            if end:
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in neighbours(p[:end], s[:end], x[:end])], names=["rank", "n_near", "best"])

        for batch in batches:
            held.append(tuple(c.to_numpy() for c in batch.columns))
            rows += batch.num_rows
            if rows >= CHUNK and (out := emit(False)) is not None:
                yield out
        if rows and (out := emit(True)) is not None:
            yield out

    rows = pair_dictionary(words).repartition("p", "s").sortWithinPartitions("p", "s")
    return rows.mapInArrow(run, "rank bigint, n_near bigint, best bigint").groupBy("rank").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """rank, root: the end of the chain from every word with a form. Steps double each round, and a chain's counts grow tenfold a step."""
    now = durable(links.select("rank", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("rank").alias("root"), F.col("root").alias("ahead"))
        step = now.join(ahead, "root", "left")
        if step.where("ahead IS NOT NULL").isEmpty():
            return now
        now = durable(step.select("rank", F.coalesce("ahead", "root").alias("root")))


def variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root for the distinct words of ``counts`` (word, n)."""
    ordered = counts.select("word", "n").repartitionByRange(F.desc("n"), F.asc("word")).sortWithinPartitions(F.desc("n"), F.asc("word"))
    words = durable(ordered.select(F.monotonically_increasing_id().alias("rank"), "word", "n"))
    near = near_words(words).join(words.select("rank", "n"), "rank")
    best = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    near = durable(near.join(best, "best").withColumn("is_form", F.col("form_n") >= ratio * F.col("n")))
    formed = near.where("is_form")
    ends = roots(formed.select("rank", F.col("best").alias("form")))
    ends = ends.join(words.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root").select("rank", "root_word")
    out = words.join(near.select("rank", "n_near", "is_form", "form", "form_n"), "rank", "left").join(ends, "rank", "left")
    return out.select("word", F.when(F.col("is_form"), F.col("form")).alias("form"), F.coalesce("root_word", "word").alias("root"),
                      "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("is_form"), F.col("form_n")).alias("form_n"))
