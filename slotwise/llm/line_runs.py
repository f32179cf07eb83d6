"""Operator 12 (native): line dedup over levelled sorted runs of line hashes.

The index of lines seen is a set of runs, each a table of (hash, documents, keeper) that is bucketed and sorted by the
128-bit hash. A batch is reduced to one row a key, merge-anti-joined with the rows of the runs that are
already settled (held by ``min_docs`` documents: nothing that comes later can change them), and what is left becomes
a run of level 0. When a level has ``fanout`` runs they are merged into one of the next level, so the number of runs
grows with the logarithm of the batches. Batch and runs share their buckets, so an anti-join does not shuffle a run; a merge
adds up rows before it shuffles them.

The keeper of a line is the greatest id of the earliest batch that holds it. ``drop_repeats`` deals a table into batches of
descending ids, so that the greatest id of the whole table keeps the line; the lines of a key that ``min_docs`` documents
hold go from all others. A settled key never enters a run again: a line that stands in a third of all documents costs
a row a run, and its occurrences only meet map-side combined counts and a join that AQE splits.

Defined results: a key is a line without ``BLANKS`` at its ends, A-Z in lower case; null and empty texts are one empty
line; documents are told apart by id, rows that repeat an id are one document (and keep their lines together); a null id
is one document that ranks below all others; lines of fewer than ``min_chars`` code points always stay; a text all of
whose lines go becomes empty; an empty table gives no rows; other columns are carried through under any name but
``n_lines`` and ``n_dropped``.
"""

from __future__ import annotations

import string
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .common import durable

BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
KEY = ["k1", "k2"]


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z lower-cased, other letters as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def lines_of(text: str | Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keyed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """_doc, _text_hash, line (from 0) and the hash (k1, k2) of the key of every line that is long enough."""
    own = docs.select(F.col(doc_id).alias("_doc"), F.xxhash64(text).alias("_text_hash"), F.posexplode(lines_of(F.col(text))).alias("line", "_line"))
    own = own.where(F.char_length("_line") >= min_chars).select("_doc", "_text_hash", "line", line_key(F.col("_line")).alias("_key"))
    return own.where(F.char_length("_key") >= min_chars).select("_doc", "_text_hash", "line", F.xxhash64("_key").alias("k1"), F.xxhash64(F.lit(12), "_key").alias("k2"))


class LineRuns:
    """Runs of line hashes as bucketed, sorted tables of the session's warehouse. ``close`` drops them."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = 4, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.batches = 0

    def absorb(self, batch: DataFrame) -> None:
        """Add the keys of a batch of (_doc, k1, k2) rows. Ids of a batch may not come back in a later one."""
        own = batch.select("_doc", *KEY).distinct().groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max(F.struct(F.lit(-self.batches).alias("batch"), F.col("_doc").alias("doc"))).alias("keeper"))
        for run in self.runs():
            own = own.join(self.spark.table(run).where(F.col("docs") >= self.min_docs), KEY, "left_anti")
        self._add(own, 0)
        self.batches += 1

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def held(self) -> DataFrame:
        """One row a key: the number of its documents (``min_docs`` or more once settled) and its keeper."""
        return self._merged(self.runs())

    def close(self) -> None:
        self._drop(self.runs())
        self.levels = []

    def _merged(self, runs: list[str]) -> DataFrame:
        # One scan of plain files: Spark 4.1 takes the union of bucketed tables for partitioned by the key and then reads it unbucketed.
        catalog = self.spark.catalog
        folder = catalog.getDatabase(catalog.currentDatabase()).locationUri
        rows = self.spark.read.schema(self.spark.table(runs[0]).schema).parquet(*[f"{folder}/{r}" for r in runs])
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def _add(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid4().hex}"
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._add(self._merged(old), level + 1)
            self._drop(old)

    def _drop(self, runs: list[str]) -> None:
        for run in runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")


def descending(rows: DataFrame, batches: int) -> list[DataFrame]:
    """Batches of about equal size whose ids descend from batch to batch; null ids come last. Ids that are no numbers make one."""
    if batches < 2 or not isinstance(rows.schema["_doc"].dataType, NumericType):
        return [rows]
    cuts = rows.agg(F.percentile_approx("_doc", [i / batches for i in range(1, batches)])).first()[0] or []
    id_ = F.col("_doc")
    cuts = sorted(set(cuts), reverse=True)
    parts = [rows.where((id_ > low) & (id_ <= high) if high is not None else id_ > low) for high, low in zip([None, *cuts], cuts, strict=False)]
    return [*parts, rows.where((id_ <= cuts[-1]) | id_.isNull())] if cuts else [rows]


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = 4, fanout: int = 4) -> DataFrame:
    """_doc, _text_hash and the sorted numbers of the lines that go (bounded by the lines of one text)."""
    keyed = durable(keyed_lines(docs, doc_id, text, min_chars))
    index = LineRuns(docs.sparkSession, min_docs, fanout)
    try:
        for batch in descending(keyed, batches):
            index.absorb(batch)
        # Written, so that both sides of the join are plain shuffles, which AQE may split where one line is very common.
        settled = durable(index.held().where(F.col("docs") >= min_docs).select(*KEY, F.col("keeper.doc").alias("_keeper")))
        gone = keyed.join(settled, KEY).where(~F.col("_doc").eqNullSafe(F.col("_keeper")))
        return durable(gone.groupBy("_doc", "_text_hash").agg(F.sort_array(F.collect_set("line")).alias("_gone")))
    finally:
        index.close()


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents without repeated lines, with ``n_lines`` before and ``n_dropped``."""
    gone = repeats(docs, doc_id, text, **how)
    rest = [c for c in docs.columns if c != text]
    own = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_hash"), lines_of(F.col(text)).alias("_lines"), F.col(text).isNull().alias("_null"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    both = own.join(gone, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_text_hash")), "left")
    # What stays lies between the lines that go: slices of these gaps are read once each, so the work is linear in the lines.
    after = lambda j: F.coalesce(F.get("_gone", j - 1), F.lit(-1)) + 1
    gaps = F.transform(F.sequence(F.lit(0), F.size("_gone")), lambda j: F.slice("_lines", after(j) + 1, F.coalesce(F.get("_gone", j), F.size("_lines")) - after(j)))
    kept = F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(F.flatten(gaps))
    value = F.when(~F.col("_null"), F.concat_ws("\n", kept))
    back = {c: F.col(f"c{i}").alias(c) for i, c in enumerate(rest)} | {text: value.alias(text)}
    return both.select(*[back[c] for c in docs.columns], F.size("_lines").cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))
