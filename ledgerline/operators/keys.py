"""Distinct rows, one row per key, and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: How many rows the one that was kept stands for.
COPIES = "_copies"
#: Whether a table may have the row's key.
MAYBE = "_maybe"
_HASH = "_hash"
#: Rows of a bitmap of keys, 64 bits each: 8 million bits, a few MB in memory.
BITMAP_WORDS = 1 << 17


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def one_per_key(df: DataFrame, key: str, copies: bool = False) -> DataFrame:
    """One row per key: the smallest by all other columns (NULLs first), with ``copies`` also how many rows it came from.

    Which row survives is open in the original, so this fixes one choice. Rows are ordered by the key alone; the
    other columns are compared only between rows of one key. Each task keeps one row per key before the shuffle, so a
    key with very many copies costs its task one row per input partition.
    """
    others = [c for c in df.columns if c != key]
    if not others and not copies:
        return df.distinct()
    counted = [F.count(F.lit(1)).alias(COPIES)] if copies else []
    found = [F.min(F.struct(*others)).alias("_smallest")] if others else []
    smallest = df.groupBy(key).agg(*found, *counted)
    columns = (key if c == key else F.col(f"_smallest.{c}").alias(c) for c in df.columns)
    return smallest.select(*columns, *([COPIES] if copies else []))


def one_per_key_of_few(df: DataFrame, key: str, copies: bool = False, words: int = BITMAP_WORDS) -> DataFrame:
    """:func:`one_per_key` of a stored table in which few keys repeat: only rows whose key may repeat are shuffled.

    Hashes of all keys are counted first, which reads one column; a bitmap of those that come more than once tells the rows whose
    key is surely alone, and they stay where they are. Where many keys repeat the bitmap fills up and all rows are shuffled."""
    hashed = F.xxhash64(F.col(key))
    names = [F.col(f"`{c}`") for c in df.columns]
    repeated = df.select(hashed.alias(_HASH)).groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    told = maybe_in(df.withColumn(_HASH, hashed), _HASH, repeated, words)
    alone = told.where(~F.col(MAYBE)).select(*names, *([F.lit(1).cast("long").alias(COPIES)] if copies else []))
    return alone.unionByName(one_per_key(told.where(MAYBE).select(*names), key, copies))


def maybe_in(df: DataFrame, key: str, held: DataFrame, words: int = BITMAP_WORDS) -> DataFrame:
    """``df`` with a column :data:`MAYBE`: whether ``held`` may have the row's ``key``. It is false only for keys that
    ``held`` does not have, NULL among them.

    ``held`` becomes a bitmap of hashes, at most ``words`` rows of 64 bits whatever its size, and is broadcast as that. A bitmap
    that fills up calls every key possible and saves nothing; no answer changes.
    """

    def place(column: Column) -> Column:
        return F.pmod(F.xxhash64(column.cast("string")), F.lit(words * 64))

    def mask(at: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int"))

    keys = held.where(F.col(key).isNotNull()).select(place(F.col(key)).alias("at"))
    bitmap = keys.groupBy(F.shiftright("at", 6).alias("_word")).agg(F.bit_or(mask(F.col("at"))).alias("_bits"))
    at = place(F.col(key))
    found = df.join(F.broadcast(bitmap), F.col(key).isNotNull() & (F.shiftright(at, 6) == F.col("_word")), "left")
    set_ = F.coalesce(F.col("_bits").bitwiseAND(mask(at)) != 0, F.lit(False))
    return found.withColumn(MAYBE, set_).drop("_word", "_bits")


def insert_if_absent(target: DataFrame, new: DataFrame, key: str, words: int = BITMAP_WORDS) -> DataFrame:
    """``target`` plus one row for each key of ``new`` it does not have. Rows already there stay as they are.

    Most new keys are told from a bitmap of the target's, without a join; only rows whose key the target may have are
    shuffled to the anti join with it."""
    told = maybe_in(one_per_key(new, key), key, target, words)
    columns = [F.col(f"`{c}`") for c in target.columns]
    surely = told.where(~F.col(MAYBE)).select(*columns)
    maybe = told.where(MAYBE).select(*columns)
    held = maybe_in(target.select(key), key, maybe, words).where(MAYBE).select(key).distinct()
    return target.unionAll(surely).unionAll(maybe.join(held, key, "left_anti").select(*columns))
