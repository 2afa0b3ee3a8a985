"""Global positions without a global window: ranges are sorted side by side, then shifted by what lies before them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.storage import checkpointed

_PART, _ROW, _SHIFT = "clm__part", "clm__row", "clm__shift"


def with_position(df: DataFrame, order: list[str], name: str, total: str | None = None) -> DataFrame:
    """Adds ``name``: the row's position, from 0 on, in the order of the named columns (which should tell rows apart).
    Adds the number of rows too, if ``total`` names a column for it.

    The range-partitioned rows are checkpointed once, so positions and ranges belong to the same sort; what comes to
    the driver is one count per partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = checkpointed(ranged.select("*", F.spark_partition_id().alias(_PART), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(_ROW)))
    sizes = dict(held.groupBy(_PART).count().collect())
    shifts, so_far = [], 0
    for part in sorted(sizes):
        shifts.append((part, so_far))
        so_far += sizes[part]
    table = df.sparkSession.createDataFrame(shifts, f"{_PART} int, {_SHIFT} bigint")
    out = held.join(F.broadcast(table), _PART).withColumn(name, F.col(_ROW) + F.col(_SHIFT)).drop(_PART, _ROW, _SHIFT)
    return out.withColumn(total, F.lit(so_far).cast("bigint")) if total else out


def with_position_in(df: DataFrame, groups: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name``: the position, from 0 on, inside the row's group; a group may be of any size. Adds ``<name>_of`` too, the group's size."""
    placed = with_position(df, [*groups, *order], name)
    first = placed.groupBy(*groups).agg(F.min(name).alias(_SHIFT), F.count("*").alias(name + "_of"))
    return placed.join(first, groups).withColumn(name, F.col(name) - F.col(_SHIFT)).drop(_SHIFT)
