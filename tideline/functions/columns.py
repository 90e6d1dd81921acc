"""Expressions and schema helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86_400


def money(name: str) -> Column:
    """A money column as decimal(15,2), so that sums are exact and order does not matter."""
    return F.col(name).cast("decimal(15,2)")


# Decimals that exact sums of doubles keep, and the size from which an amount has no room in them.
SUM_DIGITS = 12
SUM_LIMIT = 1e25


# What a double holds beyond those decimals is summed apart, in units of this.
SMALL = 1e-24


def exact_parts(number: Column) -> list[Column]:
    """What to sum of a column of doubles so that the sum does not hang on the order of the rows.

    The amount as decimal(38,12), counts of NaN, Infinity and -Infinity, and what the amount has
    beyond 12 decimals, scaled up. Amounts of 1e25 and more, which have no room in it, stop the
    query rather than change its result.
    """
    value = number.cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))
    fits = F.when(F.abs(value) < SUM_LIMIT, value).otherwise(
        F.raise_error(F.lit(f"amounts of {SUM_LIMIT} and more cannot be summed exactly")).cast("double")
    )
    counts = [F.isnan(value), value == float("inf"), value == float("-inf")]
    amount = F.when(finite, fits).cast(f"decimal(38,{SUM_DIGITS})")
    return [
        amount,
        *[F.when(value.isNotNull(), test.cast("bigint")) for test in counts],
        ((F.when(finite, value) - amount.cast("double")) / SMALL).cast(f"decimal(38,{SUM_DIGITS})"),
    ]


def exact_double(sums: list[Column]) -> Column:
    """The double that the sums of ``exact_parts`` make; NULL if there was nothing to sum."""
    total, nan, up, down, small = sums
    return (
        F.when((nan > 0) | ((up > 0) & (down > 0)), float("nan"))
        .when(up > 0, float("inf"))
        .when(down > 0, float("-inf"))
        .otherwise(total.cast("double") + small.cast("double") * SMALL)
    )


# Decimals that ``exact_sum`` keeps of an amount that has more than it is to have.
LONG_DIGITS = 9


def exact_sum(amount: Column, digits: int = 4) -> Column:
    """Exact sum of amounts of ``digits`` decimals, as decimal(28,digits).

    Whole units and fractions are summed as two integers: the order of rows does not
    matter, the sums stay in generated code (decimal sums do not), and they hold far more
    rows of one group than a single scaled integer would. Amounts are taken as doubles, so
    one amount is exact up to about 9e11 with four decimals. An amount with more decimals counts
    with nine of them, and only the sum is rounded. An amount that is no finite number (NaN or an
    infinity) has no decimal sum: it makes the sum of its group NULL, and touches no other group.
    """
    number = amount.cast("double")
    finite = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != float("inf"))
    value = F.when(finite, number)
    whole = F.floor(value)
    rest = value - whole
    short = F.rint(rest * float(10**digits))
    # Doubles of a few digits are off by parts of their last place only.
    allowed = F.greatest(F.lit(1e-6), F.abs(value) * float(10**digits) * 4e-16)
    few = F.abs(rest * float(10**digits) - short) <= allowed
    units = F.when(few, short * float(10 ** (LONG_DIGITS - digits))).otherwise(F.rint(rest * float(10**LONG_DIGITS)))
    unit = F.lit(Decimal(1).scaleb(-LONG_DIGITS))
    total = F.sum(whole).cast("decimal(28,0)") + F.sum(units.cast("bigint")).cast("decimal(28,0)") * unit
    odd = F.max(F.when(number.isNotNull(), ~finite))
    return F.when(~odd, total).cast(f"decimal(28,{digits})")


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Seconds since 1970-01-01 of a date or timestamp column.

    Dates and zone-free timestamps are read off their own calendar fields, so the
    session time zone does not move them.
    """
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(column)
    days = F.unix_date(column.cast("date")).cast("bigint")
    if isinstance(kind, T.DateType):
        return days * SECONDS_PER_DAY
    clock = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
    return days * SECONDS_PER_DAY + clock


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """The column when the table has it, else a typed NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def transform_elements(array: str, change: Callable[[Column], Column]) -> Column:
    """Apply an expression to every element of an array column."""
    return F.transform(F.col(array), change)


def dedupe_columns(df: DataFrame, mode: str = "rename") -> DataFrame:
    """Make column names unique.

    ``rename`` keeps the first of equal names and suffixes the later ones with
    ``_dedup_1``, ``_dedup_2`` and so on; ``drop`` keeps only the first.
    """
    if mode not in ("rename", "drop"):
        raise ValueError(f"unsupported mode {mode!r}; use 'rename' or 'drop'")
    taken = {name.lower() for name in df.columns}
    seen: dict[str, int] = {}
    unique: list[str] = []
    first_only: list[str] = []
    for name in df.columns:
        key = name.lower()
        if key not in seen:
            seen[key] = 0
            unique.append(name)
            first_only.append(name)
            continue
        seen[key] += 1
        while f"{key}_dedup_{seen[key]}" in taken:
            seen[key] += 1
        taken.add(f"{key}_dedup_{seen[key]}")
        unique.append(f"{name}_dedup_{seen[key]}")
    renamed = df.toDF(*unique)
    return renamed if mode == "rename" else renamed.select(*first_only)


# How narrow number types widen.
WIDENED = {
    T.ByteType(): T.LongType(),
    T.ShortType(): T.LongType(),
    T.IntegerType(): T.LongType(),
    T.FloatType(): T.DoubleType(),
}


def widen_types(df: DataFrame) -> DataFrame:
    """Widen byte, short and int columns to long and float columns to double."""
    return df.select(
        *[
            F.col(f"`{field.name}`").cast(WIDENED[field.dataType]).alias(field.name)
            if field.dataType in WIDENED
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )
