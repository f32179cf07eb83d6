"""Range join: points in intervals, without comparing every point with every interval of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 62


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits.cast("int"))


def dyadic_cover(start: Column, end: Column) -> Column:
    """The fewest aligned blocks [node * 2**level, (node + 1) * 2**level) that make up start..end: at most two a level."""
    low, high = start.cast("long"), end.cast("long") + 1
    top = F.least(F.ceil(F.log2((high - low).cast("double"))), F.lit(LEVELS)).cast("int")

    def at(level: Column) -> Column:
        first, stop = -_shift(-low, level), _shift(high, level)  # the blocks of this level that lie inside
        odd = lambda x: x.bitwiseAND(F.lit(1).cast("long")) == 1
        node = lambda x: F.struct(level.alias("level"), x.alias("node"))
        return F.array(F.when((first < stop) & odd(first), node(first)), F.when((first < stop) & odd(stop), node(stop - 1)))

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), top), at)), lambda x: x.isNotNull())


def interval_join(points: DataFrame, intervals: DataFrame, on, value: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Every point with the intervals of its key that hold its value (both ends included), as an equi-join.

    An interval is written as its dyadic blocks and a point as the one block of each level that holds it, so
    a point meets an interval exactly once if it lies in it and never otherwise: nothing is compared in vain, however many intervals
    of a key overlap. Rows made: two a level of an interval, one a level in use of a distinct (key, value), and the
    result. Values are whole numbers (dates and times as such). Interval columns must not clash with
    point columns, apart from the keys; a null key or value and an interval with a null or crossed end meet nothing.
    """
    on = list(on)
    extra = [c for c in intervals.columns if c not in on]
    blocks = intervals.where(F.col(start) <= F.col(end)).select(*on, F.struct(*extra).alias("_e"), F.explode(dyadic_cover(F.col(start), F.col(end))).alias("_n"))
    blocks = blocks.select(*on, "_e", F.col("_n.level").alias("_level"), F.col("_n.node").alias("_node"))
    levels = blocks.agg(F.sort_array(F.collect_set("_level"))).scalar()  # at most one a bit
    known = points.select(*on, F.col(value).cast("long").alias("_v")).dropna().distinct()
    at = known.withColumn("_level", F.explode(levels)).withColumn("_node", _shift(F.col("_v"), F.col("_level")))
    held = at.join(blocks, [*on, "_level", "_node"]).select(*on, "_v", *[F.col("_e")[c].alias(c) for c in extra])
    return points.withColumn("_v", F.col(value).cast("long")).join(held, [*on, "_v"], how).select(*points.columns, *extra)
