"""What the operators of this package share: table access, durable frames, row keys, Arrow mapping."""

from __future__ import annotations

import sys
import tempfile
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Functions of this package travel to the executors with the task, so these need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: Space, tab, line feed, vertical tab, form feed, carriage return: what ``bytes.split()`` splits at.
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's setting to remove a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder of ``spark.checkpoint.dir`` and read it from there.

    Cuts the lineage and survives lost executors. A folder is set here only where the
    session has none (local tests). The shuffle files of the write go with it: nothing reads them again, and Spark would keep
    them until the driver happens to collect its garbage, so that a stage of many steps held the shuffles of all.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="spark-"))
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a frame of its own, made under the setting; df itself may run again
    finally:
        conf.set(CLEANUP, before)


def text_hash(text: str | Column = "text") -> Column:
    return F.xxhash64(text)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, sliced_by: str | None = None) -> DataFrame:
    """Apply ``fn`` to each Arrow batch of the frame, in place (no shuffle).

    With ``sliced_by``, to slices of a batch with about two megabytes of that column, so that no more is held at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, sliced_by, 2_000_000) if sliced_by else [batch]:
                if part.num_rows and (out := fn(part)) is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, column: str, budget: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``budget`` bytes of a string or binary column each, so work arrays stay small."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + budget, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def worker_state(name: str) -> dict:
    """A dictionary that stays in a Python worker from task to task (for caches only)."""
    state = sys.modules.setdefault("slotwise_worker_state", ModuleType("slotwise_worker_state"))
    return state.__dict__.setdefault(name, {})
