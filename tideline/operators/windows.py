"""Ordered window columns whose partitions may be larger than one task.

``window_columns`` uses Spark windows while every group fits a task. A group that is too
large for one is cut into chunks that follow the window's order: by value, and
inside a value that alone is too frequent, by the row key. A window then runs inside
each chunk, and what precedes a chunk (row counts, sums, neighbouring values) is
added from a summary with one row per chunk. Rows are shuffled once, no sort is
global, and the result does not depend on where the cuts fall: running sums of doubles
are summed as decimals and cast once at the end, in either way of computing them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.columns import exact_double, exact_parts
from tideline.operators.groups import (
    FEW_GROUPS,
    GROUP_ROWS,
    group_sizes,
    split_hot,
    union_parts,
)

ROWS_PER_CUT = 1000
# Into how many chunks a window over all rows is cut at least, unless they get too small.
ALL_CHUNKS, LEAST_CHUNK = 64, 10_000
# Whole numbers up to this are told apart as doubles.
EXACT_WHOLE = 1 << 53


@dataclass(frozen=True)
class Measure:
    """A window column: what to compute, and of which column where one is needed."""

    kind: str
    source: str | None = None


ROW_NUMBER = Measure("row_number")
RANK = Measure("rank")
DENSE_RANK = Measure("dense_rank")
PERCENT_RANK = Measure("percent_rank")

RANKS = ("rank", "dense_rank", "percent_rank")
NEIGHBOURS = ("lag", "lead", "centred_avg")


def running_sum(source: str) -> Measure:
    return Measure("running_sum", source)


def centred_avg(source: str) -> Measure:
    """Average over the previous, the current and the next row."""
    return Measure("centred_avg", source)


def lag(source: str) -> Measure:
    return Measure("lag", source)


def lead(source: str) -> Measure:
    return Measure("lead", source)


@dataclass(frozen=True)
class Order:
    """Order by a numeric column, equal values by a numeric row key that is unique.

    Ascending puts NULL first and descending puts it last, as Spark does by default.
    """

    value: str
    key: str
    descending: bool = False

    def columns(self) -> list[Column]:
        names = [self.value, self.key]
        return [F.col(c).desc() if self.descending else F.col(c).asc() for c in names]


@dataclass(frozen=True)
class Step:
    """Window columns of one partitioning and order."""

    by: tuple[str, ...]
    order: Order
    measures: dict[str, Measure]


def window_columns(
    df: DataFrame,
    by: list[str],
    order: Order,
    measures: dict[str, Measure],
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add window columns; groups above ``group_rows`` rows are computed in chunks."""
    return window_steps(df, [Step(tuple(by), order, measures)], group_rows)


def window_steps(df: DataFrame, steps: list[Step], group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add the window columns of several steps.

    Sizes and cuts are read from ``df`` itself, not from the growing chain above it: one scan
    for all sizes, and one set of cuts for all steps of equal order.
    """
    sizes = group_sizes(df, *[list(step.by) for step in steps])
    cuts: dict[Order, Callable[[DataFrame], DataFrame]] = {}
    result = df
    for step, (groups, largest) in zip(steps, sizes):
        by = list(step.by)
        if not by:
            # One window over all rows would be one task, however few the rows.
            rows = min(group_rows, max(LEAST_CHUNK, largest // ALL_CHUNKS))
            place = cuts.setdefault(step.order, plan_cuts(df, step.order, rows))
            result = chunked_windows(result, by, step.order, step.measures, rows, df, place)
        elif largest <= group_rows:
            result = plain_windows(result, by, step.order, step.measures)
        elif groups <= FEW_GROUPS:
            if step.order not in cuts:
                cuts[step.order] = plan_cuts(df, step.order, group_rows)
            result = chunked_windows(
                result, by, step.order, step.measures, group_rows, df, cuts[step.order]
            )
        else:
            rest, hot = split_hot(result, by, group_rows)
            parts = [
                rest if rest is None else plain_windows(rest, by, step.order, step.measures),
                hot
                if hot is None
                else chunked_windows(hot, by, step.order, step.measures, group_rows),
            ]
            result = union_parts(parts)
    return result


def plain_windows(
    df: DataFrame, by: list[str], order: Order, measures: dict[str, Measure]
) -> DataFrame:
    """Spark windows, the row-ordered ones first so that the ranks reuse their sort."""
    by_row = Window.partitionBy(*by).orderBy(*order.columns())
    by_value = Window.partitionBy(*by).orderBy(order.columns()[0])
    ranks = {name: m for name, m in measures.items() if m.kind in RANKS}
    others = {name: m for name, m in measures.items() if m.kind not in RANKS}
    result = df.withColumns({name: _plain(m, by_row, df) for name, m in others.items()})
    result = result.withColumns({name: _plain(m, by_value, df) for name, m in ranks.items()})
    return result.select(*df.columns, *measures)


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))


def _plain(measure: Measure, window: WindowSpec, df: DataFrame) -> Column:
    kind, source = measure.kind, measure.source
    if kind == "row_number":
        return F.row_number().over(window).cast("bigint")
    if kind == "rank":
        return F.rank().over(window).cast("bigint")
    if kind == "dense_rank":
        return F.dense_rank().over(window).cast("bigint")
    if kind == "percent_rank":
        return F.percent_rank().over(window)
    if kind == "running_sum":
        upto = window.rowsBetween(Window.unboundedPreceding, 0)
        if is_float(df, source):
            return exact_double([F.sum(part).over(upto) for part in exact_parts(F.col(source))])
        return F.sum(source).over(upto)
    if kind == "centred_avg":
        return F.avg(F.col(source).cast("double")).over(window.rowsBetween(-1, 1))
    if kind == "lag":
        return F.lag(source, 1).over(window)
    if kind == "lead":
        return F.lead(source, 1).over(window)
    raise ValueError(f"unknown measure {kind!r}")


def chunked_windows(
    df: DataFrame,
    by: list[str],
    order: Order,
    measures: dict[str, Measure],
    chunk_rows: int = GROUP_ROWS,
    base: DataFrame | None = None,
    place: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The same columns, computed chunk by chunk.

    Cuts and chunk summaries come from ``base`` (``df`` itself by default), which is read
    several times. ``place`` is what ``plan_cuts`` returned for the same order, if it is known.
    """
    chunk = ["_group", "_vb", "_kb"]
    # A struct compares equal to another with the same NULL fields, so groups with a
    # NULL key join like the rest and the join shares its shuffle with the windows.
    group = F.struct(*[F.col(c) for c in by]) if by else F.lit(0)
    base = df if base is None else base
    place = place or plan_cuts(base, order, chunk_rows)
    before = _before_each_chunk(place(base.withColumn("_group", group)), order, measures)
    joined = place(df.withColumn("_group", group)).join(before, chunk)

    inside = Window.partitionBy(*chunk).orderBy(*order.columns())
    inside_by_value = Window.partitionBy(*chunk).orderBy(order.columns()[0])
    kinds = {m.kind for m in measures.values()}
    working = {"_position": F.row_number().over(inside)}
    for source in sorted({m.source for m in measures.values() if m.kind == "running_sum"}):
        window = inside.rowsBetween(Window.unboundedPreceding, 0)
        parts = exact_parts(F.col(source)) if is_float(df, source) else [F.col(source)]
        working[f"_sum_{source}"] = F.array(*[F.sum(part).over(window) for part in parts])
    for source in sorted({m.source for m in measures.values() if m.kind in NEIGHBOURS}):
        working[f"_lag_{source}"] = F.lag(source, 1).over(inside)
        working[f"_lead_{source}"] = F.lead(source, 1).over(inside)
    result = joined.withColumns(working)
    if kinds & {"rank", "percent_rank"}:
        result = result.withColumn("_rank", F.rank().over(inside_by_value))
    if "dense_rank" in kinds:
        result = result.withColumn("_dense", F.dense_rank().over(inside_by_value))
    return result.select(*df.columns, *[_chunked(m, df).alias(name) for name, m in measures.items()])


def _chunked(measure: Measure, df: DataFrame) -> Column:
    """A measure from the value inside the chunk and what the summary says came before."""
    kind, source = measure.kind, measure.source
    rank = F.col("_rows_of_less") + F.when(F.col("_single"), 1).otherwise(F.col("_rank"))
    if kind == "row_number":
        return F.col("_rows_before") + F.col("_position")
    if kind == "rank":
        return rank
    if kind == "dense_rank":
        inside = F.when(F.col("_single"), 1).otherwise(F.col("_dense"))
        return F.col("_values_of_less") + inside
    if kind == "percent_rank":
        return F.when(
            F.col("_rows_total") > 1,
            (rank - 1).cast("double") / (F.col("_rows_total") - 1).cast("double"),
        ).otherwise(F.lit(0.0))
    if kind == "running_sum":
        here, before = F.col(f"_sum_{source}"), F.col(f"_sum_before_{source}")

        def both(i: int) -> Column:
            return F.coalesce(before[i] + here[i], here[i], before[i])

        if is_float(df, source):
            return exact_double([both(i) for i in range(len(exact_parts(F.col(source))))])
        return both(0).cast(df.select(F.sum(source)).schema[0].dataType)
    previous = F.when(F.col("_position") == 1, F.col(f"_last_before_{source}")).otherwise(
        F.col(f"_lag_{source}")
    )
    following = F.when(
        F.col("_position") == F.col("_rows"), F.col(f"_first_after_{source}")
    ).otherwise(F.col(f"_lead_{source}"))
    if kind == "lag":
        return previous
    if kind == "lead":
        return following
    if kind == "centred_avg":
        near = [previous, F.col(source), following]
        total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in near), F.lit(0.0))
        present = sum((c.isNotNull().cast("int") for c in near), F.lit(0))
        return F.try_divide(total, present.cast("double"))
    raise ValueError(f"unknown measure {kind!r}")


def plan_cuts(
    base: DataFrame, order: Order, chunk_rows: int
) -> Callable[[DataFrame], DataFrame]:
    """Decide where to cut, and return what adds the chunk of each row to a DataFrame.

    It adds chunk numbers ``_vb`` (by value) and ``_kb`` (by row key), and ``_single`` for
    chunks that hold one value only. Chunks follow the order and rows of equal value share
    ``_vb``. The cuts are constants and the chunk is a function of the row alone, so a task
    that runs again gives the same ones.
    """
    numbered = _numbered(base, order)
    rows, numberless = numbered.agg(F.count(F.lit(1)), F.count(F.when(_no_number(), 1))).first()
    parts = max(1, math.ceil(rows / chunk_rows))
    value_cuts, key_cuts = quantiles(numbered, ["_v", "_k"], parts, rows)

    # A quantile that repeats is a value too frequent for one chunk: it gets a bucket to
    # itself, which closes at the next larger double.
    # Not so where other values of the column are the same double: these must stay together.
    frequent = sorted(v for v, times in Counter(value_cuts).items() if times > 1 and _told_apart(base, order, v))
    bounds = sorted({*value_cuts, *(math.nextafter(v, math.inf) for v in frequent)})
    own_buckets = [bounds.index(v) + 1 for v in frequent]
    last = len(bounds) + 1
    null_bucket, nan_bucket = (last + 1, -1) if order.descending else (-1, last)

    def by_value(df: DataFrame) -> DataFrame:
        return bucketed(_numbered(df, order), "_v", "_bucket", bounds).withColumns(
            {
                "_vb": F.when(F.col("_v").isNull(), null_bucket)
                .when(F.isnan("_v"), nan_bucket)
                .otherwise(F.col("_bucket").cast("int")),
                "_single": _no_number()
                | F.coalesce(F.col("_bucket").cast("int").isin(own_buckets), F.lit(False)),
            }
        )

    if not frequent and numberless <= chunk_rows:
        return lambda df: (
            by_value(df).withColumn("_kb", F.lit(0)).select(*df.columns, "_vb", "_kb", "_single")
        )

    # Number the (value bucket, key bucket) cells of frequent values in order, and cut the
    # numbers so that each chunk takes about as many rows as the others.
    key_bounds = sorted(set(key_cuts))
    keys = len(key_bounds) + 3
    null_key = keys - 1 if order.descending else 0

    def by_cell(df: DataFrame) -> DataFrame:
        placed = bucketed(by_value(df), "_k", "_key_bucket", key_bounds)
        cell = F.col("_vb") * keys + F.coalesce(F.col("_key_bucket") + 1, F.lit(null_key))
        return placed.withColumn("_cell", F.when(F.col("_single"), cell.cast("double")))

    (cell_cuts,) = quantiles(by_cell(base).filter("_single"), ["_cell"], parts, rows)
    cell_bounds = sorted(set(cell_cuts))

    def by_value_and_key(df: DataFrame) -> DataFrame:
        placed = bucketed(by_cell(df), "_cell", "_cell_bucket", cell_bounds)
        cut = F.coalesce(F.col("_cell_bucket").cast("int"), F.lit(0))
        return placed.withColumn("_kb", cut).select(*df.columns, "_vb", "_kb", "_single")

    return by_value_and_key


def _told_apart(df: DataFrame, order: Order, value: float) -> bool:
    """Whether no other value of the order's column becomes the same double."""
    kind = df.schema[order.value].dataType
    if isinstance(kind, T.LongType):
        return abs(value) < EXACT_WHOLE
    return not isinstance(kind, T.DecimalType) or kind.precision <= 15


def _numbered(df: DataFrame, order: Order) -> DataFrame:
    """Value and key as doubles that ascend in the wanted order.

    Adding zero turns -0.0 into 0.0: Spark sorts them as equal, a search among cuts does not.
    """
    sign = -1.0 if order.descending else 1.0
    return df.withColumns(
        {
            "_v": F.col(order.value).cast("double") * sign + F.lit(0.0),
            "_k": F.col(order.key).cast("double") * sign + F.lit(0.0),
        }
    )


def _no_number() -> Column:
    return F.col("_v").isNull() | F.isnan("_v")


def quantiles(df: DataFrame, names: list[str], parts: int, rows: int) -> list[list[float]]:
    """Values that cut each column into ``parts`` parts of about equal size.

    They only balance the work, every row still lands in exactly one part, so a sample
    large enough for even parts is all that is read of a big table.
    """
    if parts < 2:
        return [[] for _ in names]
    wanted = parts * ROWS_PER_CUT
    if rows > 4 * wanted:
        df = df.sample(fraction=wanted / rows, seed=7)
    shares = [i / parts for i in range(1, parts)]
    found = df.approxQuantile(names, shares, 1 / (4 * parts))
    return [[cut for cut in cuts if math.isfinite(cut)] for cuts in found]


def bucketed(df: DataFrame, source: str, target: str, bounds: list[float]) -> DataFrame:
    """Number of the interval between bounds a value lies in, by binary search; NULL stays NULL."""
    if not bounds:
        return df.withColumn(target, F.when(F.col(source).isNotNull(), F.lit(0.0)))
    splits = [-math.inf, *bounds, math.inf]
    buckets = Bucketizer(splits=splits, inputCol=source, outputCol=target, handleInvalid="keep")
    return buckets.transform(df).withColumn(
        target, F.when(F.col(source).isNotNull(), F.col(target))
    )


def _before_each_chunk(
    rows: DataFrame, order: Order, measures: dict[str, Measure]
) -> DataFrame:
    """One row per chunk: its own size and what the chunks before it amount to."""
    kinds = {m.kind for m in measures.values()}
    sums = sorted({m.source for m in measures.values() if m.kind == "running_sum"})
    neighbours = sorted({m.source for m in measures.values() if m.kind in NEIGHBOURS})

    place = F.struct(F.col(order.value), F.col(order.key))
    first, last = (F.max_by, F.min_by) if order.descending else (F.min_by, F.max_by)
    wanted = [F.count(F.lit(1)).alias("_rows")]
    for c in sums:
        parts = exact_parts(F.col(c)) if is_float(rows, c) else [F.col(c)]
        wanted += [F.sum(part).alias(f"_sum_of_{c}_{i}") for i, part in enumerate(parts)]
    for c in neighbours:
        wanted += [first(c, place).alias(f"_first_{c}"), last(c, place).alias(f"_last_{c}")]
    if "dense_rank" in kinds:
        wanted += [
            F.count_distinct(order.value).alias("_distinct"),
            F.any_value("_single").alias("_one_value"),
        ]
    chunks = rows.groupBy("_group", "_vb", "_kb").agg(*wanted)

    in_order = Window.partitionBy("_group").orderBy("_vb", "_kb")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    of_less = Window.partitionBy("_group").orderBy("_vb").rangeBetween(Window.unboundedPreceding, -1)
    before = {"_rows_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0))}
    for c in sums:
        parts = [name for name in chunks.columns if name.rpartition("_")[0] == f"_sum_of_{c}"]
        before[f"_sum_before_{c}"] = F.array(*[F.sum(part).over(earlier) for part in parts])
    for c in neighbours:
        before[f"_last_before_{c}"] = F.lag(f"_last_{c}").over(in_order)
        before[f"_first_after_{c}"] = F.lead(f"_first_{c}").over(in_order)
    if "dense_rank" in kinds:
        # A value spread over several chunks counts in the first of them only.
        repeated = F.lag("_vb").over(in_order) == F.col("_vb")
        before["_new_values"] = (
            F.when(~F.col("_one_value"), F.col("_distinct")).when(repeated, 0).otherwise(1)
        )
    chunks = chunks.withColumns(before)
    if kinds & {"rank", "percent_rank"}:
        chunks = chunks.withColumn(
            "_rows_of_less", F.coalesce(F.sum("_rows").over(of_less), F.lit(0))
        )
    if "dense_rank" in kinds:
        chunks = chunks.withColumn(
            "_values_of_less", F.coalesce(F.sum("_new_values").over(of_less), F.lit(0))
        )
    if "percent_rank" in kinds:
        chunks = chunks.withColumn(
            "_rows_total", F.sum("_rows").over(Window.partitionBy("_group"))
        )
    kept = ["_rows", "_rows_before", "_rows_of_less", "_values_of_less", "_rows_total"]
    kept += [f"_sum_before_{c}" for c in sums]
    kept += [f"{side}_{c}" for c in neighbours for side in ("_last_before", "_first_after")]
    return chunks.select("_group", "_vb", "_kb", *[c for c in kept if c in chunks.columns])
