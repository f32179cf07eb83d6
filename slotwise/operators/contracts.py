"""Q01-Q06: table contracts. Every finding is a row; one aggregate job per table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUPPORTED_MAJOR = 1
FINDING = "table string, check string, column string, n bigint"


class ContractError(ValueError):
    """Raised with every finding once all checks have run."""


@dataclass(frozen=True)
class TableContract:
    """Columns by name with their type family; which may not be null, negative, or repeat."""

    columns: dict[str, str]
    required: bool = True
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    refers: tuple[tuple[str, str, str], ...] = field(default=())


# ---- fixed values: engine tables, version 1.0 ----
ENGINE_TABLES = {
    "users": TableContract({"user_id": "string"}, not_null=("user_id",), unique=("user_id",)),
    "products": TableContract({"product_id": "string", "price": "number"}, not_null=("product_id",), unique=("product_id",), non_negative=("price",)),
    "interactions": TableContract(
        {"user_id": "string", "product_id": "string", "interaction_type": "string", "weight": "number"},
        not_null=("user_id", "product_id", "interaction_type"), non_negative=("weight",),
        refers=(("user_id", "users", "user_id"), ("product_id", "products", "product_id"))),
    "entities": TableContract({"entity_id": "string"}, required=False, not_null=("entity_id",), unique=("entity_id",)),
    "fitment": TableContract({"product_id": "string", "entity_id": "string"}, required=False, not_null=("product_id", "entity_id"),
                             refers=(("product_id", "products", "product_id"), ("entity_id", "entities", "entity_id"))),
    "ownership": TableContract({"user_id": "string", "entity_id": "string"}, required=False, not_null=("user_id", "entity_id"),
                               refers=(("user_id", "users", "user_id"), ("entity_id", "entities", "entity_id"))),
}


def _is_kind(dtype: T.DataType, kind: str) -> bool:
    return {"string": isinstance(dtype, T.StringType), "number": isinstance(dtype, T.NumericType),
            "boolean": isinstance(dtype, T.BooleanType), "timestamp": isinstance(dtype, (T.TimestampType, T.TimestampNTZType))}[kind]


def version_supported(version: str) -> bool:
    """Q01: major.minor text with the supported major number."""
    parts = version.split(".")
    return len(parts) == 2 and all(p.isdigit() for p in parts) and int(parts[0]) == SUPPORTED_MAJOR


def shape_findings(tables: dict[str, DataFrame], contract=ENGINE_TABLES) -> list[tuple]:
    """Q01: missing tables, missing columns and wrong types, from the schemas alone."""
    out = []
    for name, c in contract.items():
        if name not in tables:
            if c.required:
                out.append((name, "missing_table", None, 1))
            continue
        schema = {f.name: f.dataType for f in tables[name].schema}
        for column, kind in c.columns.items():
            if column not in schema:
                out.append((name, "missing_column", column, 1))
            elif not _is_kind(schema[column], kind):
                out.append((name, "wrong_type", column, 1))
    return out


def null_counts(df: DataFrame, columns) -> DataFrame:
    """Q02: nulls per column, one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns])))


def bad_numbers(df: DataFrame, columns) -> DataFrame:
    """Negative, NaN or infinite values per column, one pass."""
    def bad(c):
        v = F.col(c).try_cast("double")
        return F.count_if((v < 0) | F.isnan(v) | (F.abs(v) == float("inf")))

    row = df.agg(*[bad(c).alias(c) for c in columns])
    return row.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns])))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Q04: number of key values that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").agg(F.count(F.lit(1)).alias("n"))


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Distinct ids of the child that the parent does not know."""
    ids = child.select(F.col(column).alias("id")).dropna().distinct()
    return ids.join(parent.select(F.col(key).alias("id")).distinct(), "id", "left_anti")


def value_findings(tables: dict[str, DataFrame], contract=ENGINE_TABLES) -> DataFrame:
    """Q02, Q04-Q06 over all tables as (table, check, column, n) rows, failing checks only."""
    parts = []
    for name, c in contract.items():
        df = tables.get(name)
        if df is None:
            continue

        def rows(found, check, column=None):
            col = F.col("column") if column is None else F.lit(column)
            return found.select(F.lit(name).alias("table"), F.lit(check).alias("check"), col.alias("column"), F.col("n").cast("long"))

        have = [x for x in c.not_null if x in df.columns]
        if have:
            parts.append(rows(null_counts(df, have), "null"))
        have = [x for x in c.non_negative if x in df.columns]
        if have:
            parts.append(rows(bad_numbers(df, have), "bad_number"))
        for key in c.unique:
            if key in df.columns:
                parts.append(rows(duplicate_keys(df, key), "duplicate", key))
        for column, parent, key in c.refers:
            if parent in tables and column in df.columns and key in tables[parent].columns:
                n = orphans(df, column, tables[parent], key).agg(F.count(F.lit(1)).alias("n"))
                parts.append(rows(n, "orphan", column))
    return reduce(DataFrame.unionByName, parts).where("n > 0")


def validate(tables: dict[str, DataFrame], version: str = "1.0", contract=ENGINE_TABLES) -> None:
    """Q01: run every check, then fail with all findings. The driver only sees finding rows."""
    found = [] if version_supported(version) else [("*", "contract_version", version, 1)]
    found += shape_findings(tables, contract)
    found += [tuple(r) for r in value_findings(tables, contract).collect()]
    if found:
        raise ContractError("; ".join(f"{t}.{c or '*'}: {k} ({n})" for t, k, c, n in found))
