"""Exact counts of different keys by bitmaps: a set bit for each key, and no row per key in the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the digits of a 14-digit key weigh in its two check digits.
FIRST_WEIGHTS = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
SECOND_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
#: Digits of the company, of the establishment's number in it, and of a key of company, number and check digits.
COMPANY, FULL = 8, 14
#: Establishments with a number below this are counted in bitmaps. With 8 digits for the company there are then at most
#: 3,052 bitmaps of 4 KB for each number, 1.2 GB in all were every key there; in a register nearly all have the number 1.
NUMBERS = 100


def _digit(key: Column, i: int) -> Column:
    return F.substring(key, i + 1, 1).try_cast("int")


def _check_digit(digits: list[Column], weights: tuple[int, ...]) -> Column:
    total = sum((d * w for d, w in zip(digits, weights)), F.lit(0))
    rest = total % 11
    return F.when(rest < 2, F.lit(0)).otherwise(F.lit(11) - rest)


def dense_position(key: Column) -> Column:
    """A number for keys that lie close together in a register, NULL for others; different keys have different numbers.

    Keys of up to eight digits count as they are, each length for itself. A full key counts by its establishment's number
    and then its company, which needs no check digits where they are right; the others are left to be counted as rows."""
    digits = [_digit(key, i) for i in range(FULL)]
    first = _check_digit(digits[:12], FIRST_WEIGHTS)
    second = _check_digit([*digits[:12], first], SECOND_WEIGHTS)
    right = (digits[12] == first) & (digits[13] == second)
    number = F.substring(key, COMPANY + 1, 4).try_cast("long")
    company = F.substring(key, 1, COMPANY).try_cast("long")
    # Room for a key of each shorter length before the full ones.
    short = F.lit(10).cast("long")
    below = F.length(key)
    return (
        F.when(key.rlike(rf"^[0-9]{{1,{COMPANY}}}\z"), key.try_cast("long") + F.pow(short, below).cast("long"))
        .when(key.rlike(rf"^[0-9]{{{FULL}}}\z") & right & (number < NUMBERS), (number + 10) * 10**COMPANY + company)
        .cast("long")
    )


def count_keys(df: DataFrame, key: str) -> DataFrame:
    """``qt``: how many different values the column has. NULL is none.

    Tasks set a bit for each dense key and hand on a bitmap per 32,768 numbers; only keys of another form are shuffled one
    by one."""
    value = F.col(key).cast("string")
    keys = df.select(value.alias("key"), dense_position(value).alias("position")).where(F.col("key").isNotNull())
    bitmaps = keys.where(F.col("position").isNotNull()).groupBy(F.bitmap_bucket_number("position").alias("bucket"))
    bitmaps = bitmaps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bits"))
    others = keys.where(F.col("position").isNull()).select("key").distinct()
    counts = bitmaps.select(F.bitmap_count("bits").alias("n")).unionAll(others.select(F.lit(1).cast("long").alias("n")))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("qt"))
