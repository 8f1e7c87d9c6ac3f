"""Ordered computations over groups of any size.

A plain window sends each group to one task, so a session or rollout holding a
third of all rows would stall the job. The operators here cut every group into
*blocks*: ranges of the leading order column, given as a column. Windows run
inside a block; one small row per block, partially aggregated before its
shuffle, carries the state from block to block; both meet again on
(keys, block), which spreads a hot group over as many tasks as it has blocks.

Blocks are ranges of consecutive integers where the order is one, or of equal
numbers of rows (`equal_blocks`), cut only in groups that need it.

Rules for callers: keys are never NULL, ``order`` is a total order within the
group, and ``block`` never decreases along it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEFORE = (Window.unboundedPreceding, -1)
BLOCK_ROWS = 1 << 18
SIDE = 16
CUTS = SIDE * SIDE
POINTS = 16


def number_block(column: str | Column, bits: int = 12) -> Column:
    """Blocks of 2**bits consecutive integers."""
    return F.shiftright(F.col(column) if isinstance(column, str) else column, bits)


def _block_of(place: Column, cuts: Column) -> Column:
    """Number of cut points up to ``place``. They come as ``SIDE`` rows of ``SIDE``
    ascending points, so two short scans find the place."""
    row = F.size(F.filter(cuts, lambda points: F.element_at(points, -1) <= place))
    inside = F.size(F.filter(F.get(cuts, row), lambda point: point <= place))
    found = row * SIDE + F.when(F.get(cuts, row).isNull(), 0).otherwise(inside)
    return F.when(cuts.isNull(), 0).otherwise(found).cast("bigint")


def equal_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``_block``: ranges of about ``rows`` rows of the group's order (at most
    ``CUTS`` of them) in larger groups, 0 in all others.

    The rows that a hash of their place picks, one in ``rows`` / ``POINTS``, are a
    quantile summary of every group at once: few in all, none in most small
    groups. Every so many of a group's picked places is a cut point. As a place
    is the whole ``order``, rows that share its first columns are cut as well.
    """
    place, picked = F.struct(*order), max(1, rows // POINTS)
    group = Window.partitionBy(*keys)
    points = df.filter(F.xxhash64(*keys, *order) % picked == 0).select(*keys, place.alias("_place"))
    nth = points.withColumns({"_nth": F.row_number().over(group.orderBy("_place")), "_of": F.count("*").over(group)})
    step = F.greatest(F.lit(POINTS), F.ceil(F.col("_of") / CUTS))
    cuts = (nth.filter(F.col("_nth") % step == 0).groupBy(*keys)
            .agg(F.sort_array(F.collect_list("_place")).alias("_points")))
    table = F.filter(F.transform(F.sequence(F.lit(0), F.lit(SIDE - 1)), lambda i: F.slice(F.col("_points"), i * SIDE + 1, F.lit(SIDE))),
                     lambda part: F.size(part) > 0)
    return (df.join(cuts.select(*keys, table.alias("_cuts")), list(keys), "left")
            .select(*df.columns, _block_of(place, F.col("_cuts")).alias("_block")))


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                block: Column, **values: Column) -> DataFrame:
    """Add, per named value, its sum over the *earlier* rows of the group."""
    cut = [*keys, "_block"]
    work = df.withColumns({"_block": block,
                           **{f"_v_{n}": c for n, c in values.items()}})
    inside = Window.partitionBy(*cut).orderBy(*order).rowsBetween(*BEFORE)
    across = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*BEFORE)

    totals = work.groupBy(*cut).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    # A group's first block carries nothing, so ordinary small groups leave this
    # side empty and AQE turns the join into a broadcast of what remains.
    carried = (totals.select(*cut, F.lag("_block").over(
                   Window.partitionBy(*keys).orderBy("_block")).alias("_earlier"),
                   *[F.sum(f"_t_{n}").over(across).alias(f"_c_{n}") for n in values])
               .filter("_earlier IS NOT NULL").drop("_earlier"))
    local = work.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(inside) for n in values})
    zero = F.lit(0)
    return (local.join(carried, cut, "left")
            .withColumns({n: F.coalesce(F.col(f"_l_{n}"), zero)
                          + F.coalesce(F.col(f"_c_{n}"), zero) for n in values})
            .select(*df.columns, *values))


def segmented_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column,
                   restart: Column, **values: Column) -> DataFrame:
    """Add, per named value, its sum over the *earlier* rows of the group back to
    the last row where ``restart`` holds, that row included; at such a row 0.

    Inside a block the marks number its segments. A block hands on the sum behind
    its last mark; a run of blocks without marks adds up until the next one with.
    """
    cut = [*keys, "_block"]
    work = df.withColumns({"_block": block, "_mark": F.coalesce(restart, F.lit(False)).cast("int"),
                           **{f"_v_{n}": c for n, c in values.items()}})
    numbered = work.withColumn("_segment", F.sum("_mark").over(
        Window.partitionBy(*cut).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    inside = Window.partitionBy(*cut, "_segment").orderBy(*order).rowsBetween(*BEFORE)
    local = numbered.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(inside) for n in values})

    last = F.struct(*[F.sum(f"_v_{n}").alias(n) for n in values])
    tails = (numbered.groupBy(*cut, "_segment").agg(last.alias("_sums"))
             .groupBy(*cut).agg(F.max("_segment").alias("_marks"), F.max_by("_sums", "_segment").alias("_sums")))
    along = Window.partitionBy(*keys).orderBy("_block")
    stretch = Window.partitionBy(*keys, "_stretch").orderBy("_block")
    handed = (tails.withColumn("_stretch", F.count_if(F.col("_marks") > 0).over(along))
              .withColumns({f"_s_{n}": F.sum(F.col("_sums")[n]).over(stretch) for n in values})
              .select(*cut, F.lag("_block").over(along).alias("_earlier"),
                      *[F.lag(f"_s_{n}").over(along).alias(f"_c_{n}") for n in values])
              .filter("_earlier IS NOT NULL").drop("_earlier"))
    zero = F.lit(0)
    carried = {n: F.when(F.col("_segment") == 0, F.coalesce(F.col(f"_c_{n}"), zero)).otherwise(zero) for n in values}
    return (local.join(handed, cut, "left")
            .withColumns({n: F.coalesce(F.col(f"_l_{n}"), zero) + carried[n] for n in values})
            .select(*df.columns, *values))


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              block: Column, out: str) -> DataFrame:
    """Add the dense position of each row in its group, from 0."""
    return prefix_sums(df, keys, order, block, **{out: F.lit(1).cast("bigint")})


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               block: Column, value: Column, out: str) -> DataFrame:
    """Add the last non-NULL ``value`` among the *earlier* rows of the group."""
    cut = [*keys, "_block"]
    work = df.withColumns({"_block": block, "_value": value})
    inside = Window.partitionBy(*cut).orderBy(*order).rowsBetween(*BEFORE)
    across = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*BEFORE)

    place = F.when(F.col("_value").isNotNull(), F.struct(*order))
    lasts = work.groupBy(*cut).agg(F.max_by("_value", place).alias("_last"))
    carried = (lasts.select(*cut, F.last("_last", ignorenulls=True).over(across).alias("_carried"))
               .filter("_carried IS NOT NULL"))
    local = work.withColumn("_near", F.last("_value", ignorenulls=True).over(inside))
    return (local.join(carried, cut, "left")
            .withColumn(out, F.coalesce("_near", "_carried"))
            .select(*df.columns, out))
