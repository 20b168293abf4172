"""Shares, running totals, ranks, lags and group peaks.

No table goes through one task: running totals and ranks over a whole table are
computed per range partition and shifted by the totals of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import as_decimal, exact_sum, flag, known
from ..session import materialize


def share_of_total(df: DataFrame, value: str, output: str, digits: int = 1) -> DataFrame:
    """Percent of the column's grand total, which is a scalar subquery over that one column."""
    total = df.agg(exact_sum(value)).scalar()
    return df.withColumn(output, F.round(F.col(value) / F.nullif(total, F.lit(0.0)) * 100, digits))


def running_total(df: DataFrame, value: str, output: str, *order: Column) -> DataFrame:
    """Sum of the known ``value`` over all rows up to and including this one in ``order``.

    ``order`` must be total (end it with a unique key). The rows are cut into
    ordered ranges and written once; each range is summed on its own and the
    totals of the ranges before it, one row per range, are added. Sums are of
    decimals as in ``exact_sum``, and of doubles from the first row on that is no such decimal.
    """
    number = known(value)
    sums = {
        "__exact": F.coalesce(as_decimal(number), F.lit(0).cast("decimal(38,12)")), "__plain": F.coalesce(number, F.lit(0.0)),
        "__other": F.when(number.isNotNull() & as_decimal(number).isNull(), 1).otherwise(0),
    }
    ranges = materialize(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()).withColumns(sums))
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ranges.groupBy("__range").agg(*(F.try_sum(c).alias(c) for c in sums))
    # One row per range, so at most spark.sql.shuffle.partitions rows: bounded by the settings, not by the data.
    by_range = Window.orderBy("__range")
    earlier = by_range.rowsBetween(Window.unboundedPreceding, -1)
    first = F.row_number().over(by_range) == 1
    before = {f"{c}_before": F.when(first, F.lit(0)).otherwise(F.try_sum(c).over(earlier)) for c in sums}
    offsets = totals.select("__range", *(total.alias(name) for name, total in before.items()))
    upto = {c: F.try_add(F.try_sum(c).over(inside), F.col(f"{c}_before")) for c in sums}
    exact = F.when(upto["__other"] == 0, upto["__exact"].cast("double"))
    return (
        ranges.join(offsets, "__range").withColumn(output, F.coalesce(exact, upto["__plain"]))
        .drop("__range", *sums, *before)
    )


def rank_descending(df: DataFrame, value: str, output: str) -> DataFrame:
    """Rank by ``value`` from high to low over the whole frame; ties share a rank and leave a gap.

    A rank is one plus the number of rows with a higher value. Equal values are
    counted together first, so many ties cost one row, and the count of higher
    rows is a distributed running total. NULLs rank last.
    """
    rows = materialize(df)
    per_value = rows.groupBy(value).agg(F.count("*").alias("__rows"))
    counted = running_total(per_value, "__rows", "__upto", F.col(value).desc_nulls_last())
    ranks = counted.select(
        F.col(value).alias("__value"), (F.col("__upto") - F.col("__rows") + 1).cast("long").alias(output)
    )
    return rows.join(ranks, F.col(value).eqNullSafe(F.col("__value")), "left").drop("__value")


def number_rows(df: DataFrame, partition: Sequence[str], order: Sequence[str], output: str) -> DataFrame:
    """Row number within each group. A group may be spread over many ranges, so no task holds all of a large one.

    Rows are cut into ranges of (group, order); a range counts its own rows of a
    group and adds the group's rows in earlier ranges. The result is written, so
    rows that tie in ``order`` keep their number.
    """
    ranges = materialize(df.repartitionByRange(*partition, *order).withColumn("__range", F.spark_partition_id()))
    inside = Window.partitionBy("__range", *partition).orderBy(*order)
    counts = ranges.groupBy("__range", *partition).agg(F.count("*").alias("__rows"))
    # At most one row per range in a group.
    earlier = Window.partitionBy(*partition).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    keys = {name: f"__key_{i}" for i, name in enumerate(["__range", *partition])}
    offsets = counts.select(
        *[F.col(name).alias(key) for name, key in keys.items()],
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"),
    )
    same = [F.col(name).eqNullSafe(F.col(key)) for name, key in keys.items()]
    return materialize(
        ranges.withColumn("__inside", F.row_number().over(inside))
        .join(offsets, same)
        .withColumn(output, F.col("__inside") + F.col("__before"))
        .drop("__range", "__inside", "__before", *keys.values())
    )


def lag_changes(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], changes: Mapping[str, tuple[str, int]]
) -> DataFrame:
    """Differences to earlier rows of the same group: output name -> (value, how many rows earlier).

    Rows are counted, not calendar periods. ``order`` must be total within a group: end it with a unique column where
    rows may tie. Rows of a group that are equal in it are an error, since either could be the earlier one.

    Rows are sorted into ranges of (group, order) once and written. Within a range the earlier row is found by a
    local window, so no task holds a large group. The first rows of a group in a range look further back, into the last
    rows that the ranges before have of the group: these few rows of either kind of all ranges are lined up on their own.
    """
    most, keys = max(rows for _, rows in changes.values()), ["__range", *partition]
    ranges = materialize(df.repartitionByRange(*partition, *order).withColumn("__range", F.spark_partition_id()))
    inside, backwards = (Window.partitionBy(*keys).orderBy(*columns) for columns in (order, [F.col(c).desc() for c in order]))
    place = F.row_number().over(inside)
    # Equal rows are in one range, so a range sees all ties.
    rank = F.row_number().over(inside) == F.rank().over(inside)
    known = ranges.withColumns({"__place": place, "__single": rank})
    tie = F.raise_error(F.concat(F.lit("several rows of a group are equal in "), F.lit(", ".join(order)))).cast("int")
    known = known.withColumn("__place", F.when(F.col("__single"), F.col("__place")).otherwise(tie)).drop("__single")
    values = {value: f"__value_{i}" for i, value in enumerate(dict.fromkeys(value for value, _ in changes.values()))}
    few = [*keys, *order, *(F.col(value).alias(name) for value, name in values.items())]
    first = ranges.select(*few, place.alias("__place")).filter(F.col("__place") <= most)
    last = ranges.select(*few, F.row_number().over(backwards).alias("__back")).filter(F.col("__back") <= most).drop("__back")
    marks = first.unionByName(last.withColumn("__place", F.lit(None).cast("int"))).groupBy(*keys, *order).agg(
        F.min("__place").alias("__place"), *(F.first(name).alias(name) for name in values.values())
    )
    # At most twice ``most`` rows of a group per range.
    lined = Window.partitionBy(*partition).orderBy("__range", *order)
    wanted = {out: F.when(F.col("__place") <= rows, F.lag(values[value], rows).over(lined)) for out, (value, rows) in changes.items()}
    found = marks.select(
        *[F.col(c).alias(f"__key_{i}") for i, c in enumerate([*keys, "__place"])], *[w.alias(f"__far_{out}") for out, w in wanted.items()]
    ).filter(F.col(f"__key_{len(keys)}").isNotNull())
    near = known.withColumns({f"__near_{out}": F.lag(value, rows).over(inside) for out, (value, rows) in changes.items()})
    same = [F.col(c).eqNullSafe(F.col(f"__key_{i}")) for i, c in enumerate([*keys, "__place"])]
    joined = near.join(found, same, "left")
    earlier = {
        out: F.when(F.col("__place") <= rows, F.col(f"__far_{out}")).otherwise(F.col(f"__near_{out}")) for out, (_, rows) in changes.items()
    }
    return joined.withColumns({out: F.col(value) - earlier[out] for out, (value, _) in changes.items()}).select(*df.columns, *changes)


def lag_change(df: DataFrame, value: str, output: str, partition: Sequence[str], order: str, rows: int = 1) -> DataFrame:
    return lag_changes(df, partition, [order], {output: (value, rows)})


def group_peak_flag(df: DataFrame, value: str, output: str, partition: Sequence[str]) -> DataFrame:
    """1 where the value equals the maximum of its group. All tied rows get 1, a NULL value gets 0.

    The maximum is pre-aggregated and joined back, so a large group is never held
    by one task. The frame is read twice: pass a materialized one if it is costly.
    """
    names = [f"__group_{i}" for i, _ in enumerate(partition)]
    peaks = df.groupBy(*[F.col(c).alias(n) for c, n in zip(partition, names)]).agg(F.max(value).alias("__peak"))
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(partition, names)]
    return df.join(peaks, same, "left").withColumn(output, flag(F.col(value) == F.col("__peak"))).drop("__peak", *names)
