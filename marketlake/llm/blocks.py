"""Places and running totals along an order, where one group may hold most rows.

Rows are range-sorted over all groups, so a large group lies across many partitions, its
blocks. A block computes its own part; what earlier blocks of the group add is one small row
per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import stored


def numbered(df: DataFrame, group: list[str], order: list[Column], purpose: str) -> DataFrame:
    """Rows with ``block``, ``rank`` (from 0 in ``order`` within ``group``) and ``n``, the group's rows.

    Null groups are one group. Rows that ``order`` ties are told apart by their place in the
    input, which also keeps many equal rows from meeting in one task.
    """
    keys = [*(F.col(c).asc_nulls_first() for c in group), *order]
    sorted_rows = (df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys, "tie")
                   .sortWithinPartitions(*keys, "tie").drop("tie"))
    placed = stored(sorted_rows.withColumns({"block": F.spark_partition_id(), "place": F.monotonically_increasing_id()}),
                    purpose)
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (placed.groupBy("block", *group).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
              .withColumns({"start": F.coalesce(F.sum("rows").over(earlier), F.lit(0)), "n": F.sum("rows").over(whole)}))
    return (on(placed, blocks.drop("rows"), ["block", *group])
            .withColumn("rank", F.col("place") - F.col("first") + F.col("start")).drop("place", "first", "start"))


def running(df: DataFrame, group: list[str], order: str, sums: dict[str, tuple], purpose: str) -> DataFrame:
    """Rows with, for ``name: (aggregate, column, how to join two)``, the total up to and with the row (``name``)
    and that of the whole group (``name_all``). ``df`` has a ``block`` that grows along ``order`` within a group.
    """
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("block", *group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    totals = stored(df.groupBy("block", *group).agg(*(agg(c).alias(k) for k, (agg, c, _) in sums.items())), purpose)
    totals = totals.select("block", *group, *(agg(k).over(earlier).alias(f"{k}_before") for k, (agg, _, _) in sums.items()),
                           *(agg(k).over(whole).alias(f"{k}_all") for k, (agg, _, _) in sums.items()))
    rows = df.select("*", *(agg(c).over(inside).alias(k) for k, (agg, c, _) in sums.items()))
    rows = on(rows, totals, ["block", *group])
    return rows.withColumns({k: join(F.col(k), F.coalesce(f"{k}_before", F.lit(0))) for k, (_, _, join) in sums.items()}
                            ).drop(*(f"{k}_before" for k in sums))


def on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null equal to null, with the left side's keys kept."""
    names = {k: f"{k}_right" for k in keys}
    right = right.withColumnsRenamed(names)
    same = [left[k].eqNullSafe(right[names[k]]) for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return left.join(right, condition, how).drop(*names.values())
