"""Sums over a range of positions around each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tideline.operators.groups import FRAME_ROWS, GROUP_ROWS, split_hot, stored, union_parts
from tideline.operators.windows import Order, chunked_windows, running_sum


def range_sums(
    df: DataFrame,
    by: list[str],
    position: str,
    low: int,
    high: int,
    sums: dict[str, str],
    group_rows: int = FRAME_ROWS,
    chunk_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add sums over the rows of the group with position in [own + low, own + high].

    ``position`` is an integer column and the summed columns are integers or decimals,
    so sums are exact in any order. Rows with no position see only one another.
    """
    rest, hot = split_hot(df, by, group_rows)
    return union_parts(
        [
            rest if rest is None else plain_range_sums(rest, by, position, low, high, sums),
            hot
            if hot is None
            else collapsed_range_sums(hot, by, position, low, high, sums, group_rows, chunk_rows),
        ]
    )


def plain_range_sums(
    df: DataFrame, by: list[str], position: str, low: int, high: int, sums: dict[str, str]
) -> DataFrame:
    """One sort of each group: a range is the difference of two running frames.

    Spark adds up a sliding frame anew for each row; a frame without a lower end only grows.
    """
    order = Window.partitionBy(*by).orderBy(position)
    return df.withColumns({name: difference(df, source, position, order, low, high) for name, source in sums.items()})


def difference(
    df: DataFrame, source: str, position: str, order: WindowSpec, low: int, high: int, descending: bool = False
) -> Column:
    """Sum of ``source`` over positions in [own + low, own + high], NULL if there is nothing to sum.

    ``order`` sorts by ``position``, NULL where Spark puts it by default. Rows with no position
    see only one another: what stands before them in a descending order is taken off.
    """
    near, far = (-low, -high - 1) if descending else (high, low - 1)
    upto = order.rangeBetween(Window.unboundedPreceding, near)
    below = order.rangeBetween(Window.unboundedPreceding, far)
    everything = order.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = F.when(F.col(position).isNotNull(), F.col(source))

    def outside(measure):
        before_nulls = measure(placed).over(everything) if descending else F.lit(None)
        return F.when(F.col(position).isNull(), before_nulls).otherwise(measure(F.col(source)).over(below))

    taken = F.coalesce(outside(F.sum), F.lit(0))
    seen = F.count(source).over(upto) - F.coalesce(outside(F.count), F.lit(0))
    kind = df.select(F.sum(source)).schema[0].dataType
    return F.when(seen > 0, F.sum(source).over(upto) - taken).cast(kind)


def collapsed_range_sums(
    df: DataFrame,
    by: list[str],
    position: str,
    low: int,
    high: int,
    sums: dict[str, str],
    group_rows: int = FRAME_ROWS,
    chunk_rows: int = GROUP_ROWS,
    base: DataFrame | None = None,
) -> DataFrame:
    """Sum rows of equal position first, range over the positions, and join back.

    A group has far fewer positions than rows (days, say), so one window usually does;
    a group with too many positions is swept instead. The sums are read from ``base``
    (``df`` itself by default).
    """
    source = df if base is None else base
    points = source.groupBy(*by, position).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    own = {f"_range_{name}": name for name in sums}
    ranged = point_range_sums(points, by, position, low, high, own, group_rows, chunk_rows)
    place = F.struct(*by, position)
    looked_up = ranged.select(
        place.alias("_place"), *[F.col(f"_range_{name}").alias(name) for name in sums]
    )
    # Each place occurs once on the right; a crowded place on the left is split by AQE.
    return (
        df.withColumn("_place", place)
        .join(looked_up, "_place")
        .select(*df.columns, *sums)
    )


def point_range_sums(
    points: DataFrame,
    by: list[str],
    position: str,
    low: int,
    high: int,
    sums: dict[str, str],
    group_rows: int = FRAME_ROWS,
    chunk_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Range sums over rows that are already one per group and position.

    The points are stored first: they are few beside the rows they sum up, and finding the
    groups with many of them must not sum the rows twice.
    """
    rest, hot = split_hot(stored(points), by, group_rows)
    return union_parts(
        [
            rest if rest is None else plain_range_sums(rest, by, position, low, high, sums),
            hot
            if hot is None
            else swept_range_sums(hot, by, position, low, high, sums, chunk_rows),
        ]
    )


def swept_range_sums(
    points: DataFrame,
    by: list[str],
    position: str,
    low: int,
    high: int,
    sums: dict[str, str],
    chunk_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Range sums as the difference of two running sums, which can be cut into chunks.

    ``points`` has one row per group and position. Each contributes its values where it
    stands, and asks for the running sum just below its lower and up to its upper end.
    """
    values = sorted(set(sums.values()))
    placed = points.filter(F.col(position).isNotNull())

    def events(shift: int, kind: int) -> DataFrame:
        # At one position: lower ends (0) come before values (1), upper ends (2) after.
        return placed.select(
            *by,
            (F.col(position) + shift).alias("_at"),
            F.lit(kind).alias("_kind"),
            F.col(position).alias("_origin"),
            *[
                (F.col(c) if kind == 1 else F.lit(None).cast(points.schema[c].dataType)).alias(c)
                for c in values
            ],
            *[
                (F.col(c).isNotNull() if kind == 1 else F.lit(False)).cast("bigint").alias(f"_n_{c}")
                for c in values
            ],
        )

    timeline = union_parts([events(low, 0), events(0, 1), events(high, 2)])
    running = {f"_run_{c}": running_sum(c) for c in values}
    running |= {f"_seen_{c}": running_sum(f"_n_{c}") for c in values}
    swept = chunked_windows(timeline, by, Order("_at", "_kind"), running, chunk_rows)

    def between(column: str):
        at_end = F.sum(F.when(F.col("_kind") == 2, F.col(column)))
        at_start = F.sum(F.when(F.col("_kind") == 0, F.col(column)))
        return F.coalesce(at_end, F.lit(0)) - F.coalesce(at_start, F.lit(0))

    ends = (
        swept.filter("_kind <> 1")
        .groupBy(*by, "_origin")
        .agg(
            *[
                F.when(between(f"_seen_{source}") > 0, between(f"_run_{source}")).alias(name)
                for name, source in sums.items()
            ]
        )
    )
    place = F.struct(*by, position)
    found = ends.select(F.struct(*by, F.col("_origin").alias(position)).alias("_place"), *sums)
    without = points.filter(F.col(position).isNull())
    return union_parts(
        [
            placed.withColumn("_place", place).join(found, "_place").select(*points.columns, *sums),
            without.withColumns({name: F.col(source) for name, source in sums.items()}),
        ]
    )
