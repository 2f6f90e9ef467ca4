"""From online identities to households."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthlift.operators.ranking import latest_per_key
from hearthlift.operators.skew import hot_keys, join_kind, spread_join
from hearthlift.schemas import HOUSEHOLD


def current_mapping(mapping: DataFrame) -> DataFrame:
    """Every combination of the three ids once. With all ids in the key, the newest row per
    combination is the combination itself, so no window is needed."""
    return mapping.select("rampid_dpm", "rampid_meta", "rampid_rmn").distinct()


def current_demographics(demographics: DataFrame) -> DataFrame:
    """Household and person ids of the newest demographic record of every online identity."""
    carried = [HOUSEHOLD, "Grouping_Indicator", "hhpel"]
    records = demographics.where(F.col("rampid").isNotNull()).select("rampid", "install_date", *carried)
    return latest_per_key(records, "rampid", "install_date", carried).drop("install_date")


def identity_households(mapping: DataFrame, demographics: DataFrame) -> DataFrame:
    """Distinct (lr_id, online_identity_id, household, hhpel, person) rows.

    lr_id is the identity in purchases and online_identity_id the one in exposures; either may
    be null where a mapping row does not have it.
    """
    people = current_demographics(demographics).where(
        F.col(HOUSEHOLD).isNotNull() & (F.col(HOUSEHOLD) != "")
    )
    links = current_mapping(mapping.where(F.col("rampid_dpm").isNotNull()))
    joined = spread_join(
        links,
        people,
        "rampid_dpm",
        "rampid",
        "inner",
        hot_keys(mapping, "rampid_dpm"),
        F.struct("rampid_meta", "rampid_rmn"),
    )
    return joined.select(
        F.col("rampid_rmn").alias("lr_id"),
        F.col("rampid_meta").alias("online_identity_id"),
        HOUSEHOLD,
        "hhpel",
        "Grouping_Indicator",
    ).distinct()


@dataclass(frozen=True)
class BridgedTable:
    """A table to bring in through the identity map: `column` holds ids of the kind `map_column`."""

    df: DataFrame
    column: str
    map_column: str
    how: str = "inner"


def bridge_join(
    base: DataFrame, column: str, map_column: str, mapping: DataFrame, tables: Sequence[BridgedTable]
) -> DataFrame:
    """Join tables keyed by different kinds of identity, by way of the identity map.

    Base rows keep their place if every table is brought in by a left or full join; an id without
    mapping then matches nothing. Hot ids of the base and of the map are spread over many tasks in
    joins of every type; counting them runs Spark jobs at once.
    """
    kinds = list(dict.fromkeys([map_column, *[t.map_column for t in tables]]))
    keep_unmapped = all(join_kind(t.how) in ("left", "full") for t in tables)
    links = mapping.select(*[F.col(k).alias(f"_map_{k}") for k in kinds]).distinct()
    joined = spread_join(
        base,
        links,
        column,
        f"_map_{map_column}",
        "left" if keep_unmapped else "inner",
        hot_keys(base, column),
        F.struct(*base.columns),
    )
    for table in tables:
        key = f"_map_{table.map_column}"
        hot, row = hot_keys(mapping, table.map_column), F.struct(*[joined[c] for c in base.columns])
        joined = spread_join(joined, table.df, key, table.column, table.how, hot, row)
    return joined.drop(*[f"_map_{k}" for k in kinds])
