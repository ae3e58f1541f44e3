"""Order-dependent building blocks that stay parallel inside one huge group."""

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 1_000_000


def _cols(names):
    return [names] if isinstance(names, str) else list(names)


def keep_first(df: DataFrame, keys, order, where=None) -> DataFrame:
    """One row per key set, the first in source order. Aggregates map-side, so hot keys are cheap.

    ``where`` restricts the rows inside the aggregate: a filter below it would make Spark copy the
    expressions behind a computed column into the filter.
    """
    keys, order = _cols(keys), _cols(order)
    row, at = F.struct(*[c for c in df.columns if c not in keys]), F.struct(*order)
    if where is not None:
        row, at = F.when(where, row), F.when(where, at)
    firsts = df.groupBy(*keys).agg(F.min_by(row, at).alias("_first")).filter("_first IS NOT NULL")
    return firsts.select(*keys, "_first.*").select(*df.columns)


def top_n(df: DataFrame, keys, order, n, rank="rank") -> DataFrame:
    """First n rows per key set; Spark cuts every partition to n rows before the shuffle."""
    window = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def _chunked(df, order, chunk_rows):
    return df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk_rows)))


def running_total(df: DataFrame, keys, order, values, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Running sums of ``{output: expression}`` per key in order of a numeric column.

    A group is cut into ranges of the order column; each range is summed on its own and starts from
    the total of the ranges before it, so one huge group still spreads over many tasks.
    """
    keys = _cols(keys)
    work = _chunked(df, order, chunk_rows)
    for name, value in values.items():
        work = work.withColumn(f"_v_{name}", value)
    sums = work.groupBy(*keys, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *keys, "_chunk", *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in values]
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    for name in values:
        work = work.withColumn(name, F.sum(f"_v_{name}").over(inside))
    joined = work.join(starts, keys + ["_chunk"], "left")
    for name in values:
        joined = joined.withColumn(name, F.col(name) + F.col(f"_o_{name}"))
    return joined.select(*df.columns, *values)


def numbered(df: DataFrame, keys, order, name="number", chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Row number per key in order of a numeric column."""
    return running_total(df, keys, order, {name: F.lit(1)}, chunk_rows)


def carry_forward(df: DataFrame, keys, order, values, chunk_rows=CHUNK_ROWS) -> DataFrame:
    """Last non-null of ``{output: expression}`` at or before each row, per key, range by range."""
    keys = _cols(keys)
    work = _chunked(df, order, chunk_rows)
    for name, value in values.items():
        work = work.withColumn(f"_v_{name}", value)
    ends = work.groupBy(*keys, "_chunk").agg(
        *[
            F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(order))).alias(f"_s_{n}")
            for n in values
        ]
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(
        *keys, "_chunk", *[F.last(f"_s_{n}", ignorenulls=True).over(before).alias(f"_o_{n}") for n in values]
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    for name in values:
        work = work.withColumn(name, F.last(f"_v_{name}", ignorenulls=True).over(inside))
    joined = work.join(starts, keys + ["_chunk"], "left")
    for name in values:
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.col(f"_o_{name}")))
    return joined.select(*df.columns, *values)


def salted_join(left: DataFrame, right: DataFrame, on, left_id, rows_per_task=200_000) -> DataFrame:
    """Equi-join whose hot keys are split over several tasks, whichever side they are hot on.

    A key with more than ``rows_per_task`` rows on a side has that side's rows dealt to as many salts and the
    other side's repeated for each. So the table of hot keys has at most rows / rows_per_task entries of
    each side, and Spark may broadcast it after measuring it.
    """
    on = _cols(on)

    def salts(df, name):
        hot = df.groupBy(*on).count().filter(F.col("count") > rows_per_task)
        return hot.select(*on, F.ceil(F.col("count") / rows_per_task).cast("int").alias(name))

    hot = salts(left, "_lefts").join(salts(right, "_rights"), on, "full_outer")
    number = lambda n: F.coalesce(F.col(n), F.lit(1))
    dealt = lambda columns, n: F.pmod(F.xxhash64(*columns), number(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), number(n) - 1))
    spread = left.join(hot, on, "left").withColumn("_salt", dealt(_cols(left_id), "_lefts")).withColumn("_other", every("_rights")).drop("_lefts", "_rights")
    copies = right.join(hot, on, "left").withColumn("_other", dealt(right.columns, "_rights")).withColumn("_salt", every("_lefts")).drop("_lefts", "_rights")
    return spread.join(copies, on + ["_salt", "_other"]).drop("_salt", "_other")


def union_all(frames) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
