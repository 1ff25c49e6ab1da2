"""Previous row, running sums and runs, the base of all ordered operators.

Every function takes ``keys`` (the columns that name a stream) and ``order`` (its row order, a number without gaps of
meaning).  ``slice_rows`` cuts each stream into stretches of so many order values, so that one stream with a third of all
rows is worked on by many tasks: rows meet within a stretch only, and a table with one row per stretch carries the last row
or the sum over.  Results are the same with or without it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _slice(order: str, rows: int) -> Column:
    return F.floor(F.col(order) / rows)


def previous(df: DataFrame, keys: list[str], order: str, columns: list[str], slice_rows: int | None = None, prefix: str = "prev_") -> DataFrame:
    """``df`` with ``prev_<column>`` of the row before in the stream; null on its first row."""
    if slice_rows is None:
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumns({prefix + c: F.lag(c).over(w) for c in columns})
    cut = df.withColumn("_t_slice", _slice(order, slice_rows))
    last = cut.groupBy(*keys, "_t_slice").agg(F.max_by(F.struct(*columns), order).alias("_t_last"))
    carried = last.withColumn("_t_carry", F.lag("_t_last").over(Window.partitionBy(*keys).orderBy("_t_slice"))).drop("_t_last")
    on = [cut[k].eqNullSafe(carried[k]) for k in [*keys, "_t_slice"]]
    joined = cut.join(carried, on, "left").drop(*(carried[k] for k in [*keys, "_t_slice"]))
    w = Window.partitionBy(*keys, "_t_slice").orderBy(order)
    first = F.row_number().over(w) == 1
    return joined.withColumns({prefix + c: F.when(first, F.col(f"_t_carry.{c}")).otherwise(F.lag(c).over(w)) for c in columns}).drop("_t_slice", "_t_carry")


def running_sum(df: DataFrame, keys: list[str], order: str, value: Column, name: str, slice_rows: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` over the stream's rows so far, the own row included."""
    upto = lambda *by: Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    if slice_rows is None:
        return df.withColumn(name, F.sum(value).over(upto(*keys)))
    cut = df.withColumns({"_t_slice": _slice(order, slice_rows), "_t_value": value})
    sums = cut.groupBy(*keys, "_t_slice").agg(F.sum("_t_value").alias("_t_sum"))
    before = Window.partitionBy(*keys).orderBy("_t_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.withColumn("_t_carry", F.coalesce(F.sum("_t_sum").over(before), F.lit(0))).drop("_t_sum")
    on = [cut[k].eqNullSafe(carried[k]) for k in [*keys, "_t_slice"]]
    joined = cut.join(carried, on, "left").drop(*(carried[k] for k in [*keys, "_t_slice"]))
    return joined.withColumn(name, F.sum("_t_value").over(upto(*keys, "_t_slice")) + F.col("_t_carry")).drop("_t_slice", "_t_value", "_t_carry")


def same(a: str, b: str) -> Column:
    """Equal as NumPy has it: null and NaN equal nothing."""
    x, y = F.col(a), F.col(b)
    return F.coalesce((x == y) & ~F.isnan(x.cast("double")), F.lit(False))


def runs(df: DataFrame, keys: list[str], order: str, starts: Column, needs: list[str] = (), name: str = "run_id", slice_rows: int | None = None) -> DataFrame:
    """``df`` with a run number: rows of a stream share it up to the next row where ``starts`` holds.

    ``starts`` may use ``prev_<column>`` of the columns in ``needs``; the first row's are null.
    """
    seen = previous(df, keys, order, list(needs), slice_rows) if needs else df
    marked = seen.withColumn("_t_start", F.when(F.coalesce(starts, F.lit(True)), 1).otherwise(0))
    return running_sum(marked, keys, order, F.col("_t_start"), name, slice_rows).drop("_t_start", *(f"prev_{c}" for c in needs))


def true_runs(df: DataFrame, keys: list[str], order: str, flag: str, slice_rows: int | None = None) -> DataFrame:
    """Rows where ``flag`` holds, with the number of their run of consecutive true rows; null counts as false."""
    held = df.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    marked = runs(held, keys, order, F.col(flag) & ~F.coalesce(F.col(f"prev_{flag}"), F.lit(False)), [flag], slice_rows=slice_rows)
    return marked.where(F.col(flag))
