"""Quantiles of windows from sketches that are kept per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches, and the error of a rank that 99 of 100 quantiles keep at it (published bound of the sketch).
SIZE, RANK_ERROR = 400, 0.0075


def daily_sketches(df: DataFrame, keys, day: Column, value: str, size: int = SIZE) -> DataFrame:
    """keys, day, sketch: a mergeable quantile sketch of the day's values, a few kilobytes whatever the number of rows.

    Sketches are filled map-side and merged in the shuffle. Stored by day, they are all that later windows read.
    """
    return df.where(F.col(value).isNotNull()).groupBy(*keys, day.alias("day")).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("sketch"))


def window_sketches(sketches: DataFrame, keys, days: int) -> DataFrame:
    """keys, day, sketch: the sketch of the last ``days`` days up to every stored day of a key, merged from daily ones."""
    keys = list(keys)
    ends = sketches.select(*keys, "day")
    spread = sketches.withColumn("day", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_add("day", i))))
    return spread.join(ends, [*keys, "day"], "left_semi").groupBy(*keys, "day").agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile(sketch: str | Column, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(share)))


def count(sketch: str | Column) -> Column:
    """Number of values in the sketch."""
    return F.kll_sketch_get_n_double(sketch)
