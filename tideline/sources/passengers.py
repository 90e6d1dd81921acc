"""Passenger records.

The supplied tables hold no passengers, so one is derived from each customer row.
The text below is also the first part of every passenger check in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSENGER_SQL = """
select c_custkey as passenger_id,
 cast(case when (c_custkey * 31) % 100 < 38 then 1 else 0 end as int) as survived,
 cast(1 + c_custkey % 3 as int) as pclass,
 case when c_custkey % 97 = 1 then null when (c_custkey * 17) % 10 < 6 then 'MALE' else 'FEMALE' end as sex,
 case when c_custkey % 5 = 0 then null else cast((c_custkey * 37) % 80 as double) + cast(0.5 as double) end as age,
 cast((c_custkey * 3) % 5 as int) as sibsp,
 cast((c_custkey * 11) % 4 as int) as parch,
 case when c_custkey % 101 = 0 then null else floor(abs(c_acctbal) / cast(50 as double)) + cast(0.25 as double) end as fare,
 case when c_nationkey % 8 < 5 then 'S' when c_nationkey % 8 = 5 then 'C' when c_nationkey % 8 = 6 then 'Q' else null end as embarked,
 case when (c_custkey * 3) % 5 + (c_custkey * 11) % 4 = 0 then 'TRUE' else 'FALSE' end as alone
from {customer}
"""

NUMERIC_TYPES = {
    "age": "double",
    "fare": "double",
    "survived": "int",
    "pclass": "int",
    "sibsp": "int",
    "parch": "int",
}


def passengers(customer: DataFrame) -> DataFrame:
    """One passenger per customer row; a projection, so it runs inside the scan stage."""
    return customer.sparkSession.sql(PASSENGER_SQL, customer=customer)


def cast_passengers(raw: DataFrame) -> DataFrame:
    """Cast the six numeric columns by name; text that is no number becomes NULL.

    Whole numbers are read as lenient casts do: "3.0" and "1e1" count, fractions are cut off,
    and what an int cannot hold is NULL.
    """

    def lenient(name: str, kind: str):
        return F.col(name).try_cast("double").try_cast(kind) if kind == "int" else F.col(name).try_cast(kind)

    return raw.withColumns({name: lenient(name, kind) for name, kind in NUMERIC_TYPES.items()})


def passengers_as_text(typed: DataFrame) -> DataFrame:
    """The numeric columns as text, as a file would hold them.

    Here and there an age is malformed, a class is written as "3.0", a number of siblings has
    spaces around it, and one of parents has more digits than an int.
    """
    text = typed.withColumns({name: F.col(name).cast("string") for name in NUMERIC_TYPES})

    def every(n: int, name: str, other) -> Column:
        return F.when(F.col("passenger_id") % n == 0, other).otherwise(F.col(name))

    return text.withColumns(
        {
            "age": every(211, "age", F.lit("n/a")),
            "pclass": every(7, "pclass", F.concat("pclass", F.lit(".0"))),
            "sibsp": every(11, "sibsp", F.concat(F.lit(" "), "sibsp", F.lit(" "))),
            "parch": every(223, "parch", F.lit("99999999999")),
        }
    )
