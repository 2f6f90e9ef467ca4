"""Written intermediate tables: they cut lineage and survive the loss of executors."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_root: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """This run's sub-folder of the shared folder that the cluster names in spark.checkpoint.dir.

    It carries the id of the Spark application, so whoever clears the folder can tell runs apart.
    Only a local or local[*] session, one process on one machine, may do without the setting.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return f"{configured.rstrip('/')}/{spark.sparkContext.applicationId}"
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"{_SETTING} must name a folder that all executors share")
    if not _local_root:
        _local_root.append(tempfile.mkdtemp(prefix="hearthlift-"))
    return _local_root[0]


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write the frame to the shared folder and return the written table."""
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
