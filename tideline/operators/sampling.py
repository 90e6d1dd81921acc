"""Random-looking draws that depend on the row key alone, not on partitions or task order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_DIGITS = 32
STEP_DIGITS = 3
LAST_STEP_ROWS = 50_000
DRAW_DIGITS = 13


def key_hash(key: str, salt: str) -> Column:
    """MD5 of ``salt:key`` in hex; equal for equal keys on every run."""
    return F.md5(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def key_number(key: str, salt: str) -> Column:
    """An integer below 16^13 drawn from the key."""
    digits = F.substring(key_hash(key, salt), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")


def key_uniform(key: str, salt: str) -> Column:
    """A double in [0, 1) drawn from the key."""
    return key_number(key, salt) / F.lit(float(16**DRAW_DIGITS))


def hash_sample(df: DataFrame, key: str, size: int, salt: str) -> DataFrame:
    """Exactly ``size`` rows, those with the smallest key hashes (all rows if there are fewer).

    The hash of the last row taken is found first, by counting rows per hash prefix and
    looking closer at the one prefix in which the size is reached: each count is a partial
    aggregate over the key column that leaves a few thousand rows. The sample itself is then a
    plain filter. Nothing is sorted, and no task or driver holds the sample, whatever its size.
    """
    if size <= 0:
        return df.limit(0)
    hashed = df.select(key_hash(key, salt).alias("hash"))
    prefix, digits, left = "", STEP_DIGITS, size
    while True:
        counts = (
            hashed.filter(F.col("hash").startswith(prefix))
            .groupBy(F.substring("hash", 1, digits).alias("prefix"))
            .count()
            .collect()
        )
        for prefix, rows in sorted((row["prefix"], row["count"]) for row in counts):
            if rows >= left:
                break
            left -= rows
        else:
            return df
        if digits == HASH_DIGITS:
            break
        digits = HASH_DIGITS if rows <= LAST_STEP_ROWS else min(digits + STEP_DIGITS, HASH_DIGITS)
    drawn = key_hash(key, salt)
    if rows == left:
        return df.filter(drawn <= prefix)
    # Only when the last key occurs more often than rows are still wanted.
    return df.filter(drawn < prefix).unionByName(df.filter(drawn == prefix).limit(left))
