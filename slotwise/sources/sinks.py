"""Writers. Nothing passes through the driver but row counts and metric rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.indexing import durable

#: File of a published table that names its current version. Spark's readers skip names that begin with a dot or underscore.
POINTER = "_CURRENT"
MODES = {"truncate": "overwrite", "append": "append", "fail": "errorifexists"}


def replace_partitioned(df: DataFrame, path: str, date_from: str, cluster=(), partition: str = "event_date") -> None:
    """Replace a table laid out by day, rows of a file ordered by the cluster keys.

    Rows are spread by (day, hash of the cluster keys), so a day that holds much of the
    data is written by many tasks instead of one.
    """
    out = df.withColumn(partition, F.to_date(date_from))
    if cluster:
        out = out.repartition(partition, *cluster).sortWithinPartitions(partition, *cluster)
    out.write.mode("overwrite").partitionBy(partition).parquet(path)


def save_bucketed(df: DataFrame, table: str, keys, buckets: int) -> None:
    """Bucketed and sorted table, so later joins on the keys need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def _paths(spark: SparkSession, path: str):
    """The path, its file system's context with an atomic rename, and the JVM."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.getFileSystem(conf).getUri(), conf), jvm


def _write_pointer(spark: SparkSession, target: str, version: str) -> None:
    """Name the current version in a small file that replaces the one before by an atomic rename."""
    own, files, jvm = _paths(spark, f"{target}/{POINTER}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{target}/{POINTER}.{version}")
    out = draft.getFileSystem(spark._jsc.hadoopConfiguration()).create(draft, True)
    out.write(bytearray(version.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(draft, own, options)


def current_version(spark: SparkSession, target: str) -> str | None:
    """Folder of the published version, or None where nothing is published."""
    target = target.rstrip("/")
    own, files, jvm = _paths(spark, f"{target}/{POINTER}")
    if not files.util().exists(own):
        return None
    stream = files.open(own)
    try:
        return f"{target}/{jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
    finally:
        stream.close()


def published(spark: SparkSession, target: str) -> DataFrame:
    """The published table. A reader sees one version whole, whatever is being written meanwhile."""
    version = current_version(spark, target)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {target}")
    return spark.read.parquet(version)


def publish(df: DataFrame, target: str, enabled: bool = True, now: dt.datetime | None = None) -> DataFrame | None:
    """Publish a new version of the target and keep the time-stamped earlier ones, then read back and count.

    A version is a folder of its own, written whole before the pointer to it is swapped by one atomic rename. So a failed or
    half-done write leaves the target as it was, readers never see a mixture, each version is the
    time-stamped copy of what was published, and the plan behind ``df`` runs once.
    """
    if not enabled:
        return None
    spark, target = df.sparkSession, target.rstrip("/")
    version = f"version_{(now or dt.datetime.now(dt.UTC)):%Y%m%d_%H%M%S_%f}"
    df.write.mode("errorifexists").parquet(f"{target}/{version}")
    _write_pointer(spark, target, version)

    def count(rows, path):
        return rows.agg(F.lit(path).alias("path"), F.count(F.lit(1)).alias("rows"))

    copy = f"{target}/{version}"
    return count(published(spark, target), target).unionByName(count(spark.read.parquet(copy), copy))


def write_shadow(df: DataFrame, path: str, disposition: str = "truncate") -> None:
    """Write with disposition truncate, append or fail."""
    df.write.mode(MODES[disposition]).parquet(path)


def metrics_report(metrics: DataFrame, config: dict[str, str], model: dict[str, str], now: dt.datetime | None = None) -> DataFrame:
    """One-row metrics frame with time, configuration and model information."""
    def as_map(d):
        return F.create_map(*[F.lit(x) for kv in d.items() for x in kv]) if d else F.create_map().cast("map<string,string>")

    return metrics.select(F.lit((now or dt.datetime.now(dt.UTC)).isoformat()).alias("timestamp"), F.struct(*metrics.columns).alias("metrics"),
                          as_map(config).alias("config"), as_map(model).alias("model"))


def write_report(report: DataFrame, path: str) -> None:
    """The report as JSON."""
    report.write.mode("overwrite").json(path)


def append_checks(checks: list[DataFrame]) -> DataFrame:
    """Check results as one table."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def update_column(target: DataFrame, changes: DataFrame, key, column: str) -> DataFrame:
    """New frame whose column takes the changed value where one exists."""
    new = changes.select(*key, F.col(column).alias("_new"))
    return target.join(new, list(key), "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def update_partitioned(spark: SparkSession, path: str, changes: DataFrame, key, column: str, partition: str) -> DataFrame:
    """K06 in place: rewrite the changed partitions of a stored table only; returns the values of those partitions.

    ``changes`` has the key, the column and the partition of its rows. The partitions that hold a row whose value
    really changes are found first; only these are read in full (partition pruning) and overwritten by Spark's dynamic partition
    overwrite, which stages the new files and swaps them in when all are written. Other partitions keep their files.
    """
    key = list(key)
    table = spark.read.parquet(path)
    new = durable(changes.select(*key, partition, F.col(column).alias("_new")))
    old = table.join(new.select(F.col(partition).alias("_p")).distinct(), F.col(partition) == F.col("_p"), "left_semi")
    touched = durable(old.join(new, [*key, partition]).where(~F.col(column).eqNullSafe(F.coalesce("_new", column))).select(partition).distinct())
    own = table.join(touched, partition, "left_semi").join(new, [*key, partition], "left")
    rows = durable(own.withColumn(column, F.coalesce("_new", column)).select(*table.columns))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    return touched


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """E16 input: a written report as (metric, value) rows."""
    r = spark.read.json(path)
    names = [f.name for f in r.schema["metrics"].dataType.fields]
    return r.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"metrics.{n}").cast("double").alias("value")) for n in names])))
