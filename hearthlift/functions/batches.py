"""Arrow batches of a table through numpy, where sums of products have no column expression."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def workers_can_import(spark: SparkSession) -> None:
    """Put the folder of this package on the Python path of the workers, where it exists there."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow, with this package importable on the workers."""
    workers_can_import(df.sparkSession)
    return df.mapInArrow(function, schema)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of arrays of one length as rows of numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
