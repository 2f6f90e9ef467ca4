"""Bring incoming frames to the names and types the operators expect."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthlift.schemas import OLD_NAMES


def canonical_names(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rename columns that differ from a wanted name only in case, in one projection."""
    present = set(df.columns)
    by_lower = {column.lower(): column for column in df.columns}
    renames = {
        by_lower[name.lower()]: name
        for name in names
        if name not in present and name.lower() in by_lower
    }
    return df.withColumnsRenamed(renames) if renames else df


def current_names(df: DataFrame, renames: Mapping[str, str] = OLD_NAMES) -> DataFrame:
    """Replace older column names where the current name is absent."""
    present = set(df.columns)
    due = {old: new for old, new in renames.items() if old in present and new not in present}
    return df.withColumnsRenamed(due) if due else df


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(
            f"{what} lacks the columns {', '.join(missing)}; it has {', '.join(df.columns[:40])}"
        )


def require_any_column(df: DataFrame, names: Iterable[str], what: str) -> None:
    if not set(names) & set(df.columns):
        raise ValueError(f"{what} needs one of the columns {', '.join(names)}")


def column_or(df: DataFrame, name: str, default: Any, kind: str) -> Column:
    """The column cast to a type, or a typed constant if the frame does not have it."""
    return (F.col(name) if name in df.columns else F.lit(default)).cast(kind).alias(name)


def filled(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Replace nulls by the defaults and add absent columns."""
    absent = {name: F.lit(default) for name, default in defaults.items() if name not in df.columns}
    present = {name: default for name, default in defaults.items() if name in df.columns}
    return df.fillna(present).withColumns(absent) if present else df.withColumns(absent)


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in its order and types; absent columns become typed nulls."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        ]
    )


def conform(df: DataFrame, schema: StructType, required: Iterable[str] = (), what: str = "table") -> DataFrame:
    """Canonical and current names, then a check of the required columns."""
    df = canonical_names(df, [*schema.fieldNames(), *OLD_NAMES])
    df = current_names(df)
    require_columns(df, required, what)
    return df


def with_baseline_flag(df: DataFrame, never_days: int = 366) -> DataFrame:
    """Derive has_baseline_purchase from recency where a table does not carry it."""
    if "has_baseline_purchase" in df.columns:
        return df
    bought = F.col("days_since_last_baseline_purchase") < never_days
    return df.withColumn("has_baseline_purchase", F.when(bought, 1).otherwise(0))
