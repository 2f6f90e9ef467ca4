"""Reading, publishing and saving tables; run parameters; column names per table."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthlift.functions.calendar import DAY, date_of

RESULT_VIEW = "result"
_PLACEHOLDER = re.compile(r"@(\w+)")


def register_parquet(spark: SparkSession, folder: str, names: Mapping[str, str] | list[str]) -> None:
    """Make `folder/<file>.parquet` readable by name, one view per table."""
    pairs = names.items() if isinstance(names, Mapping) else [(name, name) for name in names]
    for view, file in pairs:
        spark.read.parquet(f"{folder}/{file}.parquet").createOrReplaceTempView(view)


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, str | DataFrame] | None = None, **args: Any) -> DataFrame:
    """Run SQL that names its tables as `@table` and its parameters as `:name`.

    `tables` gives a table name or a frame per placeholder; other placeholders keep their own name.
    """
    frames: dict[str, DataFrame] = {}

    def target(match: re.Match) -> str:
        name = match.group(1)
        table = (tables or {}).get(name, name)
        if isinstance(table, DataFrame):
            frames[name] = table
            return "{" + name + "}"
        return table

    return spark.sql(_PLACEHOLDER.sub(target, text), args=args or None, **frames)


def save(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write parquet, csv with header, or json, as the path's ending says; executors write it."""
    writer = df.write.mode(mode)
    if path.endswith(".parquet"):
        writer.parquet(path)
    elif path.endswith(".csv"):
        writer.option("header", True).csv(path)
    elif path.endswith(".json"):
        writer.json(path)
    else:
        raise ValueError(f"unsupported file type: {path}")


def load(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read what :func:`save` writes. Without a schema csv columns are strings."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.endswith(".parquet"):
        return reader.parquet(path)
    if path.endswith(".csv"):
        return reader.option("header", True).csv(path)
    if path.endswith(".json"):
        return reader.json(path)
    raise ValueError(f"unsupported file type: {path}")


def save_by_day(df: DataFrame, path: str, epoch: str, order: Sequence[str], mode: str = "errorifexists") -> None:
    """Write parquet in a folder per day (UTC) of the epoch column, each file sorted by `order`.

    Rows are dealt by ranges of day and order, so that a day of many rows has several files, each with its own range
    of the first order column, and few days share a task. A reader of a period lists its days' folders only, and
    a reader of some identities skips the row groups of others."""
    laid = df.withColumn(DAY, date_of(F.col(epoch)))
    laid = laid.repartitionByRange(DAY, *order).sortWithinPartitions(DAY, *order)
    laid.write.mode(mode).partitionBy(DAY).parquet(path)


def load_days(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What `save_by_day` has written, with the day as a column. `schema` is that of the saved frame."""
    fields = [f for f in schema.fields if f.name != DAY]
    return spark.read.schema(StructType(fields).add(DAY, "date")).parquet(path)


@dataclass
class TableAccess:
    """Named tables, extra outputs and parameters of one run.

    columns: table -> {column placeholder -> physical column}.
    parameters: name -> (value, type name).
    output_folders: table -> folder of its extra outputs; save_folder: where new ones go.
    """

    spark: SparkSession
    columns: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    parameters: Mapping[str, tuple[Any, str]] = field(default_factory=dict)
    output_folders: Mapping[str, str] = field(default_factory=dict)
    save_folder: str | None = None
    extra_outputs: bool = False

    def read(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def read_mapped(self, name: str) -> DataFrame:
        """The table with its physical columns renamed to their placeholders."""
        renames = {physical: placeholder for placeholder, physical in self.columns.get(name, {}).items()}
        return self.read(name).withColumnsRenamed(renames)

    def publish(self, df: DataFrame, name: str = RESULT_VIEW) -> None:
        df.createOrReplaceTempView(name)

    def column(self, table: str, placeholder: str) -> str:
        return self.columns.get(table, {}).get(placeholder, placeholder)

    def parameter(self, name: str) -> Any:
        return self._parameter(name)[0]

    def parameter_type(self, name: str) -> str:
        return self._parameter(name)[1]

    def _parameter(self, name: str) -> tuple[Any, str]:
        if name not in self.parameters:
            raise KeyError(f"run parameter not found: {name}")
        return self.parameters[name]

    def save_output(self, df: DataFrame, file_name: str) -> str:
        self._require_extra_outputs()
        if not self.save_folder:
            raise RuntimeError("no folder for extra outputs")
        path = f"{self.save_folder.rstrip('/')}/{file_name}"
        save(df, path)
        return path

    def save_output_by_day(self, df: DataFrame, name: str, epoch: str, order: Sequence[str]) -> str:
        """An extra output laid out by day, to be read by `read_days`."""
        self._require_extra_outputs()
        if not self.save_folder:
            raise RuntimeError("no folder for extra outputs")
        path = f"{self.save_folder.rstrip('/')}/{name}"
        save_by_day(df, path, epoch, order)
        return path

    def read_days(self, table: str, name: str, schema: StructType) -> DataFrame:
        self._require_extra_outputs()
        folder = self.output_folders.get(table)
        if not folder:
            raise RuntimeError(f"no extra outputs known for {table}")
        return load_days(self.spark, f"{folder.rstrip('/')}/{name}", schema)

    def read_output(self, table: str, file_name: str, schema: StructType | None = None) -> DataFrame:
        self._require_extra_outputs()
        folder = self.output_folders.get(table)
        if not folder:
            raise RuntimeError(f"no extra outputs known for {table}")
        return load(self.spark, f"{folder.rstrip('/')}/{file_name}", schema)

    def _require_extra_outputs(self) -> None:
        if not self.extra_outputs:
            raise RuntimeError("extra outputs are not allowed in this run")
