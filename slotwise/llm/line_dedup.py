"""Operator 6: substring dedup by hashing lines and their sentences.

A text is cut into lines, and a line of several sentences also into these, because a shared passage often
stands within a line. A unit is normalised (lower case, blanks folded), hashed to 128 bits and grouped with
all equal units of the corpus. The earliest occurrence, by (doc_id, offset), stays; every later one
is removed, with its offsets in the original text kept. A group is never gathered: its first occurrence
is a map-side combined minimum, joined back on the digest.

A unit's span takes in the blanks or the line end behind it, so that what is left is the text without the spans.
Short units are no evidence of copying and stay: lines under ``min_words`` words, sentences under ``min_sentence``.
A line that goes has an earlier copy, and so have its sentences: the first copy of a unit always stays.

Defined results: a null text has no units and stays null; an empty text stays empty; rows with
a null id rank after all others; equally ranked occurrences (rows repeated with id and text) all
stay or all go, so that repeated rows are treated alike; a text all of whose units are removed
becomes empty; empty tables give no rows; other columns are carried through under any name but
``removed``.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

MIN_WORDS, MIN_SENTENCE = 5, 8
SENTENCE_END = r"[.!?]+[ \t]+"


def cut(text: str, separator: str = "\n", min_words: int = MIN_WORDS, min_sentence: int = MIN_SENTENCE):
    """(start, end, words) of the units of a text that are long enough."""
    ends, at = re.compile(SENTENCE_END), 0
    lines = text.split(separator)
    for i, line in enumerate(lines):
        stop = at + len(line) + (len(separator) if i < len(lines) - 1 else 0)
        words = line.lower().split()
        if len(words) >= min_words:
            yield at, stop, words
        if len(words) > min_sentence:
            begin = 0
            places = [m.end() for m in ends.finditer(line)]
            for end in [*places, len(line)] if places else []:
                words = line[begin:end].lower().split()
                if len(words) >= min_sentence:
                    yield at + begin, stop if end == len(line) else at + end, words
                begin = end
        at = stop


def units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", separator: str = "\n", min_words: int = MIN_WORDS,
          min_sentence: int = MIN_SENTENCE) -> DataFrame:
    """_doc, _text_hash, start, end (code points of the original), digest."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, starts, ends, digests = [], [], [], []
        for row, value in enumerate(batch.column("_text")):
            for start, end, words in cut(value.as_py() or "", separator, min_words, min_sentence):
                rows.append(row)
                starts.append(start)
                ends.append(end)
                digests.append(blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest())
        of = pa.array(rows, pa.int32())
        return pa.RecordBatch.from_arrays(
            [batch.column("_doc").take(of), batch.column("_text_hash").take(of), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()), pa.array(digests, pa.binary())],
            names=["_doc", "_text_hash", "start", "end", "digest"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_batches(docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_text_hash"), F.col(text).alias("_text")), run,
                       f"_doc {kind}, _text_hash bigint, start bigint, end bigint, digest binary", "_text")


def repeats(found: DataFrame) -> DataFrame:
    """Units that are not the earliest of their digest, with the document and place of the earliest."""
    place = F.struct(F.col("_doc").isNull().alias("none"), F.col("_doc").alias("doc"), F.col("_text_hash").alias("hash"), F.col("start").alias("start"))
    first = found.groupBy("digest").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    return (found.join(first, "digest").where(place > F.col("_first"))
            .select("_doc", "_text_hash", "start", "end", F.col("_first.doc").alias("first_doc"), F.col("_first.start").alias("first_start")))


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    return repeats(units(docs, doc_id, text, **limits))


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The documents without repeated units; column ``removed`` lists their spans in the original text."""
    gone = find_repeats(docs, doc_id, text, **limits)
    # Bounded by the units of one text. Repeated rows find the same spans, once each.
    spans = gone.groupBy("_doc", "_text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "end", "first_doc", "first_start"))).alias("_spans"))
    rest = [c for c in docs.columns if c != text]
    own = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("_text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    both = own.join(spans, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text_hash")), "left")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for value, spans in zip(batch.column("_text"), batch.column("_spans"), strict=True):
            value, parts, at = value.as_py(), [], 0
            for span in spans.as_py() or []:  # sorted; a sentence may lie within its line
                parts.append(value[at:max(at, span["start"])])
                at = max(at, span["end"])
            out.append("".join(parts) + value[at:] if parts else value)
        other = [n for n in batch.schema.names if n not in ("_text", "_spans")]
        return pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *map(batch.column, other)], names=["_text", *other])

    removed = F.coalesce("_spans", F.array())
    kept = both.select("_text", "_spans", *[f"c{i}" for i in range(len(rest))], removed.alias(f"c{len(rest)}"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields if f.name not in ("_text", "_spans"))
    out = map_batches(kept, run, f"_text string, {kinds}", "_text")
    back = {c: F.col(f"c{i}").alias(c) for i, c in enumerate(rest)} | {text: F.col("_text").alias(text)}
    return out.select(*[back[c] for c in docs.columns], F.col(f"c{len(rest)}").alias("removed"))
