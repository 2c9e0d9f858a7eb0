"""Ordered computations inside groups that may be very large.

A plain window puts a whole group into one task. ``ordered`` counts the groups first (a column-pruned scan with
map-side combine) and uses the plain window only while no group exceeds ``limit`` rows. Larger groups are cut
into ordered slices, each slice is windowed on its own, and the slices' totals are carried over.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.plans.stable import stable

HOT_GROUP_ROWS = 1_000_000


def large_groups(df: DataFrame, keys: Sequence[str], limit: int) -> tuple[DataFrame, int] | None:
    """Keys (as ``_g_*``) of groups above ``limit`` rows and their total row count; None if there are none."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    total = counts.agg(F.sum("_n").alias("rows")).first()["rows"]
    return None if total is None else (counts.select(*[F.col(k).alias(f"_g_{k}") for k in keys]), int(total))


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of the keys with their prefixed copies."""
    return functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    *,
    number: str | None = None,
    sums: Mapping[str, Column | str] | None = None,
    maxes: Mapping[str, Column | str] | None = None,
    lag: Mapping[str, Column | str] | None = None,
    lead: Mapping[str, Column | str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Add running values per group of ``keys`` in ``order``.

    ``number``: 1-based row number; ``sums`` / ``maxes``: running value including the row itself;
    ``lag`` / ``lead``: value of the row before / after.
    """
    sums, maxes, lag, lead = dict(sums or {}), dict(maxes or {}), dict(lag or {}), dict(lead or {})
    limit = HOT_GROUP_ROWS if limit is None else limit
    large = large_groups(df, keys, limit)
    if large is None:
        return _windowed(df, keys, order, number, sums, maxes, lag, lead)
    names, rows = large
    large_rows = df.join(names, _same(keys, "_g_"), "left_semi")
    small_rows = df.join(names, _same(keys, "_g_"), "left_anti")
    small = _windowed(small_rows, keys, order, number, sums, maxes, lag, lead)
    return small.unionByName(_sliced(large_rows, keys, order, number, sums, maxes, lag, lead, rows // limit + 1))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _windowed(df, keys, order, number, sums, maxes, lag, lead) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = {}
    if number:
        new[number] = F.row_number().over(w).cast("long")
    new.update({out: F.sum(_col(c)).over(running) for out, c in sums.items()})
    new.update({out: F.max(_col(c)).over(running) for out, c in maxes.items()})
    new.update({out: F.lag(_col(c)).over(w) for out, c in lag.items()})
    new.update({out: F.lead(_col(c)).over(w) for out, c in lead.items()})
    return df.withColumns(new)


def _sliced(df, keys, order, number, sums, maxes, lag, lead, slices) -> DataFrame:
    inputs = {f"_v_{out}": _col(c) for part in (sums, maxes, lag, lead) for out, c in part.items()}
    rows = df.withColumns({**inputs, "_tie": F.monotonically_increasing_id()})
    rows = rows.repartitionByRange(slices, *keys, *order, "_tie").withColumn("_slice", F.spark_partition_id())
    # the slice of a row must not change any more: both the totals and the rows are read from here
    rows = stable(rows)

    totals = rows.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_t_n"),
        *[F.sum(f"_v_{o}").alias(f"_t_{o}") for o in sums],
        *[F.max(f"_v_{o}").alias(f"_t_{o}") for o in maxes],
    )
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_slice").alias("_k_slice"),
        F.coalesce(F.sum("_t_n").over(before), F.lit(0)).alias("_c_n"),
        *[F.sum(f"_t_{o}").over(before).alias(f"_c_{o}") for o in sums],
        *[F.max(f"_t_{o}").over(before).alias(f"_c_{o}") for o in maxes],
    )
    w = Window.partitionBy(*keys, "_slice").orderBy(*order, "_tie")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns(
        {
            "_p_n": F.row_number().over(w),
            **{f"_p_{o}": F.sum(f"_v_{o}").over(running) for o in sums},
            **{f"_p_{o}": F.max(f"_v_{o}").over(running) for o in maxes},
        }
    )
    rows = rows.join(carried, (F.col("_slice") == F.col("_k_slice")) & _same(keys, "_k_"))
    rows = rows.withColumn("_number", (F.col("_p_n") + F.col("_c_n")).cast("long"))
    new = {number: F.col("_number")} if number else {}
    for o in sums:
        both = F.coalesce(F.col(f"_p_{o}") + F.col(f"_c_{o}"), F.col(f"_p_{o}"), F.col(f"_c_{o}"))
        new[o] = both.cast(rows.schema[f"_p_{o}"].dataType)
    for o in maxes:
        new[o] = F.greatest(f"_p_{o}", f"_c_{o}")
    rows = rows.withColumns(new)
    for moved, step in ((lag, 1), (lead, -1)):
        for o in moved:
            # the neighbour is found by its number, so no slice border matters
            other = rows.select(
                *[F.col(k).alias(f"_o_{k}") for k in keys],
                (F.col("_number") + step).alias("_o_number"),
                F.col(f"_v_{o}").alias(o),
            )
            near = (F.col("_number") == F.col("_o_number")) & _same(keys, "_o_")
            rows = rows.join(other, near, "left").drop("_o_number", *[f"_o_{k}" for k in keys])
    wanted = [*df.columns, *([number] if number else []), *sums, *maxes, *lag, *lead]
    return rows.select(*wanted)


_BLOCK_BITS = 10  # 1,024 positions per block


def running_max(
    df: DataFrame, keys: Sequence[str], position: str, values: Mapping[str, Column], inclusive: bool = True
) -> DataFrame:
    """Running maxima per group by an integer ``position`` that is unique in its group.

    Positions are cut into blocks of fixed length; blocks are windowed on their own and the maxima of the earlier
    blocks are carried over, so a large group is spread over many tasks whatever its size.
    """
    inputs = {f"_v_{o}": c for o, c in values.items()}
    rows = df.withColumns({**inputs, "_block": F.shiftright(position, _BLOCK_BITS)})
    by_block = rows.groupBy(*keys, "_block").agg(*[F.max(f"_v_{o}").alias(f"_t_{o}") for o in values])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_block.select(*keys, "_block", *[F.max(f"_t_{o}").over(earlier).alias(f"_c_{o}") for o in values])
    end = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, end)
    rows = rows.withColumns({f"_p_{o}": F.max(f"_v_{o}").over(inside) for o in values})
    rows = rows.join(carried, [*keys, "_block"])
    return rows.withColumns({o: F.greatest(f"_p_{o}", f"_c_{o}") for o in values}).select(*df.columns, *values)
