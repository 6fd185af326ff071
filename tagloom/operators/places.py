"""Running sums in a given order within groups of any size, by prefix sums over ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.session import is_small, materialize


def with_place(rows: DataFrame, *order: str, group: tuple[str, ...] = (), name: str = "place") -> DataFrame:
    """Add each row's place, from 0 on, in ascending order (nulls first), within its group or the whole table."""
    placed = running_sums(rows, list(group), [F.col(c).asc_nulls_first() for c in order])
    return placed.select(*rows.columns, F.col("before__").alias(name))


def running_sums(rows: DataFrame, group: list[str], order: list[Column], weight: str | None = None) -> DataFrame:
    """Add `before__`, the rows (or the sum of `weight`) that stand before a row in its group, and `total__`, those of the whole group.

    Rows are dealt by ranges of group and order, so a hot group reaches over many tasks. A window sees the rows of one
    group in one of these ranges, then one row for each range that a group reaches into. A null group is a group.
    """
    by = [*[F.col(c).asc_nulls_first() for c in group], *order]
    local = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    local = materialize(local.withColumns({"range__": F.spark_partition_id(), "at__": F.monotonically_increasing_id()}), "ranges")
    amount = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    sums = local.groupBy(*group, "range__").agg(F.sum(amount).alias("sum__"), F.min("at__").alias("first__"))
    sums = materialize(sums, "range-sums")
    whole = Window.partitionBy(*[F.col(c) for c in group])
    earlier = whole.orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(c).alias(f"{c}__") for c in group],
        F.col("range__").alias("own__"),
        "first__",
        F.coalesce(F.sum("sum__").over(earlier), F.lit(0)).alias("earlier__"),
        F.sum("sum__").over(whole).alias("total__"),
    )
    if weight is None:
        inside = F.col("at__") - F.col("first__")
    else:
        here = Window.partitionBy("range__", *group).orderBy("at__").rowsBetween(Window.unboundedPreceding, -1)
        local = local.withColumn("inside__", F.coalesce(F.sum(weight).over(here), F.lit(0)))
        inside = F.col("inside__")
    offsets = materialize(offsets, "range-offsets")
    same = [F.col(c).eqNullSafe(F.col(f"{c}__")) for c in group] + [F.col("range__") == F.col("own__")]
    joined = local.join(F.broadcast(offsets) if is_small(offsets) else offsets, same)
    return joined.select(*rows.columns, (F.col("earlier__") + inside).alias("before__"), "total__")
