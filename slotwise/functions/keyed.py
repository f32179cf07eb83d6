"""Keyed building blocks that stay balanced when one key holds a large share of the rows.

* ``top_n_per_key`` filters ``row_number() <= n`` with a literal n, so Catalyst plans a
  WindowGroupLimit: every task keeps at most n rows per key before the shuffle.
* group totals are plain aggregates (map-side combined) joined back, never an unbounded window.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a list that may still go to every task.
SMALL = 200_000


def shared(df: DataFrame) -> DataFrame:
    """Keep a frame that several branches of one plan read, on executor memory and disk.

    The lineage stays, so blocks of a lost executor are recomputed.
    """
    return df if df.is_cached else df.persist(StorageLevel.MEMORY_AND_DISK)


def top_n_per_key(df: DataFrame, keys, order, n: int, rank: str = "rn") -> DataFrame:
    """First n rows of each key in the given order, with their rank."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key, the first in the given order."""
    return top_n_per_key(df, keys, order, 1, "_rn").drop("_rn")


def latest_by(value: Column, order: Column, when: Column | None = None) -> Column:
    """Aggregate expression: value of the row with the greatest order, map-side combined."""
    if when is not None:
        order = F.when(when, order)
    return F.max_by(value, order)


def with_group_total(df: DataFrame, keys, **aggs: Column) -> DataFrame:
    """Add group aggregates to each row (aggregate, then join back on the keys)."""
    if not keys:
        out = df
        for name, agg in aggs.items():
            out = out.withColumn(name, df.agg(agg).scalar())
        return out
    totals = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return df.join(totals, list(keys), "left")


def share_of_group(df: DataFrame, keys, value: str, out: str = "share") -> DataFrame:
    """Value divided by the total of its group."""
    t = with_group_total(df, keys, _total=F.sum(value))
    return t.withColumn(out, F.try_divide(F.col(value).cast("double"), F.col("_total").cast("double"))).drop("_total")


def global_top(df: DataFrame, order, n: int, rank: str = "rank") -> DataFrame:
    """First n rows overall, ranked. Each task keeps n rows; only those meet."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*order)))


def two_level(df: DataFrame, inner, inner_aggs, outer, outer_aggs) -> DataFrame:
    """A10: aggregate per inner key, then those rows per outer key."""
    return df.groupBy(*inner).agg(*inner_aggs).groupBy(*outer).agg(*outer_aggs)


def metric_rows(row: DataFrame, metrics) -> DataFrame:
    """A one-row aggregate turned into (metric, value) rows, no extra pass."""
    items = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])
    return row.select(F.inline(items))


def is_member(df: DataFrame, keys: DataFrame, on, flag: str) -> DataFrame:
    """Flag rows whose key occurs in the other table."""
    known = keys.select(*on).distinct().withColumn(flag, F.lit(True))
    return df.join(known, list(on), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def not_in(df: DataFrame, other: DataFrame, left_on, right_on) -> DataFrame:
    """NOT IN with the NULL keys of both sides ignored."""
    left_on, right_on = list(left_on), list(right_on)
    keys = other.select(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(right_on)]).dropna().distinct()
    cond = None
    for i, c in enumerate(left_on):
        term = df[c] == keys[f"_k{i}"]
        cond = term if cond is None else cond & term
    return df.join(keys, cond, "left_anti")
