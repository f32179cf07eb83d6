"""Scans, order import, lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..functions.keyed import first_per_key
from ..params import RecParams


def scan_range(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows whose day lies in [start, end].

    Written as a half-open range on the stored column (no cast around it), so the filter
    reaches the parquet scan and prunes row groups and partitions.
    """
    kind = df.schema[ts].dataType
    last = dt.date.fromisoformat(end) + dt.timedelta(days=1)
    return df.where((F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(last.isoformat()).cast(kind)))


def import_orders(feed: DataFrame, p: RecParams) -> DataFrame:
    """Text-date orders to typed rows with popularity and exclusion flags.

    The cheap year test runs before the date parse; rows outside both windows, service
    skus and unparseable dates are dropped.
    """
    rows = feed.where(F.col("item").isNotNull() & ~X.is_service_sku("item"))
    rows = rows.where(X.order_year("order_date", p.min_year, p.max_year).between(p.min_year, p.max_year))
    day = X.parse_long_date("order_date")
    rows = rows.select(
        X.normalize_variant(X.norm_upper("item")).alias("sku"), X.norm_lower("ship_to_email").alias("email"),
        day.alias("order_date"))
    pop = F.col("order_date").between(F.lit(p.pop_start), F.lit(p.pop_end))
    exc = F.col("order_date").between(F.lit(p.excl_start), F.lit(p.excl_end))
    return rows.where(F.col("order_date").isNotNull() & (pop | exc)).withColumns({
        "is_popularity": pop.cast("int"), "is_exclusion": exc.cast("int")})


def literal_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Inline table of fixed values."""
    return spark.createDataFrame(rows, schema)


def csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV lookup list with a declared schema."""
    return spark.read.csv(path, header=True, schema=schema)


def jdbc_lookup(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """Result of a query that another database runs."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def jdbc_table(spark: SparkSession, url: str, table: str, by: str | None = None, parts: int = 8, **options) -> DataFrame:
    """Table of another database as a federated source.

    Filters and columns are pushed down to it. With ``by``, a numeric column, it is
    read over ``parts`` connections in ranges between the column's least and greatest value, which the database
    is asked for, so no single task reads a large table.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    if by:
        low, high = jdbc_lookup(spark, url, f'SELECT MIN("{by}") AS LOW, MAX("{by}") AS HIGH FROM {table}', **options).first()
        if low is not None and low < high:
            reader = reader.options(partitionColumn=by, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return reader.option("dbtable", table).load()


def as_of_cutoff(df: DataFrame, ingest_ts: str, cutoff: str) -> DataFrame:
    """The table as it was known at the cutoff."""
    kind = df.schema[ingest_ts].dataType
    return df.where(F.col(ingest_ts) <= F.lit(cutoff).cast(kind))


def read_keyed(spark: SparkSession, path: str, keys, order=None) -> DataFrame:
    """Table with one row per key (the first in ``order``, else any of equal rows)."""
    df = spark.read.parquet(path)
    return first_per_key(df, keys, order) if order else df.dropDuplicates(list(keys))


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Table that may not exist; an absent one is empty, with its schema."""
    conf = spark._jsc.hadoopConfiguration()
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hpath.getFileSystem(conf).exists(hpath):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
