"""Order-dependent computations that stay distributed when one key is hot.

A plain ``Window.partitionBy(key).orderBy(seq)`` sends a whole key to one task.
The helpers here cut every key into blocks of the ordering column, work inside
blocks in parallel, and carry one summary row per block across.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.timeutil import idiv


def _first(c: str, order: Column) -> Column:
    return F.min_by(c, order)


def adjacent_decreases(df: DataFrame, keys: Sequence[str], value: str, file: str | Column | None, row: str,
                       block_rows: int = 1 << 20, block: Column | None = None) -> DataFrame:
    """Per key: how often ``value`` drops from one row to the next in (file, row) order.

    ``file`` is a column or a struct of columns that order whatever the rows are numbered in. ``block`` cuts the
    rows of a file where ``row`` is no number; it must not fall along ``row``.
    """
    order_file = (F.col(file) if isinstance(file, str) else file) if file is not None else F.lit("")
    base = df.select(*keys, F.col(value).alias("_v"), order_file.alias("_f"), F.col(row).alias("_r"),
                     (idiv(F.col(row), block_rows) if block is None else block).alias("_b"))
    inside = Window.partitionBy(*keys, "_f", "_b").orderBy("_r")
    blocks = (base.withColumn("_p", F.lag("_v").over(inside))
              .groupBy(*keys, "_f", "_b")
              .agg(F.count_if(F.col("_v") < F.col("_p")).alias("_n"),
                   _first("_v", F.col("_r")).alias("_head"),
                   F.max_by("_v", F.col("_r")).alias("_tail")))
    across = Window.partitionBy(*keys).orderBy("_f", "_b")
    return (blocks.withColumn("_p", F.lag("_tail").over(across))
            .groupBy(*keys)
            .agg((F.sum("_n") + F.count_if(F.col("_head") < F.col("_p"))).alias("n_decreases")))


def sorted_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Rows range-sorted by ``keys`` and ``order`` with ``block``, the partition they fell into, and their ``place`` in it.

    A large key lies across many blocks. Rows that ``order`` ties are told apart by their place in the input. The
    result has to be stored before its block and place are used, so that they stay what they are.
    """
    by = [*(F.col(c).asc_nulls_first() for c in keys), *(F.col(c) if isinstance(c, str) else c for c in order), F.col("_tie")]
    return (df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
            .drop("_tie").withColumns({"block": F.spark_partition_id(), "place": F.monotonically_increasing_id()}))


def ranked(placed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored ``sorted_blocks`` with ``rank``, from 0 within ``keys``, and ``n``, the rows of the key: counts per block and
    the sum of the blocks before."""
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (placed.groupBy("block", *keys).agg(F.min("place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
              .withColumns({"_start": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "n": F.sum("_rows").over(whole)}))
    names = {c: f"_{c}_of" for c in ("block", *keys)}
    same = [placed[c].eqNullSafe(F.col(names[c])) for c in names]
    return (placed.join(blocks.withColumnsRenamed(names), same)
            .withColumn("rank", F.col("place") - F.col("_first") + F.col("_start"))
            .drop("place", "_first", "_rows", "_start", *names.values()))


def weighted_medians(rows: DataFrame, keys: Sequence[str], value: str, weight: str,
                     store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keys, median`` of values that each stand for ``weight`` equal ones, however many values a key has.

    Rows are range-sorted, so a large key lies across blocks; weights before a block are summed from one row per block,
    and the values at the two middle ranks are picked where they lie. ``store`` keeps the sorted rows.
    """
    cut = store(sorted_blocks(rows.select(*keys, F.col(value).alias("_v"), F.col(weight).alias("_w")), keys, ["_v"]))
    whole = Window.partitionBy(*keys)
    sums = (cut.groupBy("block", *keys).agg(F.sum("_w").alias("_part")).withColumns({
        "_before": F.coalesce(F.sum("_part").over(whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_all": F.sum("_part").over(whole)}))
    inside = Window.partitionBy("block", *keys).orderBy("_v", "place").rowsBetween(Window.unboundedPreceding, 0)
    ends = (_same(cut, sums.drop("_part"), ["block", *keys]).withColumn("_end", F.col("_before") + F.sum("_w").over(inside))
            .withColumn("_start", F.col("_end") - F.col("_w")))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v")))

    low, high = idiv(F.col("_all") - 1, 2), idiv(F.col("_all"), 2)
    return ends.groupBy(*keys).agg(((at(low) + at(high)) / 2).alias("median"))


def running_best(df: DataFrame, keys: Sequence[str], order: Sequence[str], best: dict[str, Column],
                 block: Column) -> DataFrame:
    """Running maximum of each ``best`` expression per key in ``order``, current row included.

    ``block`` must not decrease along ``order``; it decides how the key is cut.
    """
    names = list(best)
    base = df.select("*", block.alias("_b"), *[best[n].alias(n) for n in names])
    per_block = base.groupBy(*keys, "_b").agg(*[F.max(n).alias(f"_m_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_block.select(*keys, "_b", *[F.max(f"_m_{n}").over(before).alias(f"_c_{n}") for n in names])
    inside = (Window.partitionBy(*keys, "_b").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (base.join(carried, [*keys, "_b"])
            .select(*df.columns,
                    *[F.greatest(F.col(f"_c_{n}"), F.max(n).over(inside)).alias(n) for n in names]))


def as_of(rows: DataFrame, states: DataFrame, keys: Sequence[str], at: str, since: str, columns: Sequence[str],
          cell: int) -> DataFrame:
    """``rows`` with ``columns`` of the state of their keys that holds at ``at``: the latest with ``since`` not after it,
    null where there is none. ``at`` and ``since`` are long.

    Rows meet states within cells of ``cell`` units, so one key may hold any share of the rows; what a cell starts with
    comes from one small row per cell that has rows. ``rows`` are shuffled once.
    """
    def cell_of(t: Column) -> Column:
        return idiv(t - F.pmod(t, F.lit(cell)), cell)

    known = states.select(*keys, F.col(since).alias("_at"), F.struct(*columns).alias("_state"))
    none = F.lit(None).cast(known.schema["_state"].dataType)
    cells = (rows.select(*keys, cell_of(F.col(at)).alias("_cell")).distinct()
             .select(*keys, (F.col("_cell") * cell).alias("_at"), "_cell", none.alias("_state")))
    # a state of the very start belongs to the cell itself: markers come first
    before = Window.partitionBy(*keys).orderBy("_at", F.col("_cell").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    carried = (cells.unionByName(known.withColumn("_cell", F.lit(None).cast("long")))
               .withColumn("_state", F.last("_state", ignorenulls=True).over(before))
               .where(F.col("_cell").isNotNull() & F.col("_state").isNotNull()).withColumn("_kind", F.lit(0)))
    inside = known.withColumns({"_cell": cell_of(F.col("_at")), "_kind": F.lit(1)})
    mine = rows.select(*keys, F.col(at).alias("_at"), none.alias("_state"), cell_of(F.col(at)).alias("_cell"),
                       F.lit(2).alias("_kind"), F.struct(*rows.columns).alias("_row"))
    here = Window.partitionBy(*keys, "_cell").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    return (mine.unionByName(carried, allowMissingColumns=True).unionByName(inside, allowMissingColumns=True)
            .withColumn("_state", F.last("_state", ignorenulls=True).over(here)).where(F.col("_row").isNotNull())
            .select("_row.*", *(F.col(f"_state.{c}").alias(c) for c in columns)))


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float],
                      accuracy: int = 1000) -> DataFrame:
    """Linear-interpolated percentiles per key, exact, for values with unbounded variety. Nulls do not count.

    ``wanted`` maps output names to fractions. A sketch per key, merged map-side, bounds each percentile from both sides by
    a few thousandths of the rows; rows below a band are counted, and only values inside one are merged and ranked.
    The counts prove the bounds; a key whose sketch missed is ranked between its extremes instead. Outliers
    move neither the bands nor their size, and a key that holds most rows meets nowhere but in its bands.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    slack = 4.0 / accuracy
    edges = [e for p in wanted.values() for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
    sketch = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", edges, accuracy).alias("_e"), F.count(F.lit(1)).alias("_n"),
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    bounds = sketch.select(*keys, "_n", "_lo", "_hi", F.array(*(F.struct(
        F.lit(i).alias("i"),
        (F.lit(p) * (F.col("_n") - 1)).alias("pos"),
        # the outermost bands reach to the extremes, which a sketch need not hold
        (F.col("_lo") if edges[2 * i] == 0 else F.col("_e")[2 * i]).alias("lo"),
        (F.col("_hi") if edges[2 * i + 1] == 1 else F.col("_e")[2 * i + 1]).alias("hi"))
        for i, p in enumerate(wanted.values()))).alias("_bands"))

    def ranked_in(bounds: DataFrame) -> DataFrame:
        placed = _same(rows, bounds, keys)
        low = placed.groupBy(*keys).agg(*(F.count_if(F.col("_v") < F.col("_bands")[i]["lo"]).alias(f"_b{i}")
                                          for i in range(len(wanted))))
        band = (placed.select(*keys, "_v", F.explode(F.filter("_bands", lambda b: F.col("_v").between(b["lo"], b["hi"]))).alias("b"))
                .groupBy(*keys, F.col("b.i").alias("i"), F.col("b.pos").alias("pos"), "_v").agg(F.count(F.lit(1)).alias("_c")))
        upto = Window.partitionBy(*keys, "i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        below = F.element_at(F.array(*(F.col(f"_b{i}") for i in range(len(wanted)))), F.col("i") + 1)
        ranks = (_same(band, low, keys).withColumn("_end", below + F.sum("_c").over(upto))
                 .withColumn("_start", F.col("_end") - F.col("_c")))

        def at(rank: Column) -> Column:
            return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v"))).cast("double")

        return ranks.groupBy(*keys, "i", "pos").agg(at(F.floor("pos")).alias("_a"), at(F.ceil("pos")).alias("_z"))

    found = ranked_in(bounds)
    held = found.groupBy(*keys).agg(F.count_if(F.col("_a").isNotNull() & F.col("_z").isNotNull()).alias("_ok"))
    missed = (_same(bounds, held, keys, "left").where(F.coalesce("_ok", F.lit(0)) < len(wanted))
              .withColumn("_bands", F.transform("_bands", lambda b: F.struct(
                  b["i"].alias("i"), b["pos"].alias("pos"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi")))).drop("_ok"))
    whole = _same(found, missed.select(*keys), keys, "left_anti").unionByName(ranked_in(missed))
    return whole.groupBy(*keys).agg(*(
        F.max(F.when(F.col("i") == i, F.col("_a") + (F.col("_z") - F.col("_a")) * (F.col("pos") - F.floor("pos")))).alias(name)
        for i, name in enumerate(wanted)))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null equal to null."""
    names = {k: f"_{k}_of" for k in keys}
    right = right.withColumnsRenamed(names)
    return left.join(right, [left[k].eqNullSafe(F.col(names[k])) for k in keys], how).drop(*names.values())
