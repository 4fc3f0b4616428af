"""Count checks between the steps of a refresh: as queries over finished tables, or on counts observed while they are written."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.operators.distinct import count_keys


class GateError(RuntimeError):
    """A table does not have the rows it should have."""


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("qt"))


def count_distinct(df: DataFrame, key: str) -> DataFrame:
    """Number of different keys. NULL is none."""
    return count_keys(df, key)


def row_count_gate(staged: DataFrame, source: DataFrame) -> DataFrame:
    """``(loaded, expected, passed)``: staging has at least the source's rows; header lines may add some."""
    return _compared(count_rows(staged), count_rows(source)).withColumn("passed", F.col("loaded") >= F.col("expected"))


def distinct_key_gate(typed: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``(loaded, expected, passed)``: the typed table has one row per different key of the source."""
    compared = _compared(count_rows(typed), count_distinct(source, key))
    return compared.withColumn("passed", F.col("loaded") == F.col("expected"))


def require(gate: DataFrame) -> tuple[int, int]:
    """Both counts of a passed gate; :class:`GateError` for one that did not pass."""
    result = gate.first()
    if not result["passed"]:
        raise GateError(f"loaded {result['loaded']} rows, expected {result['expected']}")
    return result["loaded"], result["expected"]


@dataclass(frozen=True)
class Counted:
    """Rows of a table, those with a key, and a sum over hashes of their keys that any change of a key changes."""

    rows: int
    keyed: int
    keys: int


class Counting:
    """Counts rows on their way into a table: ``rows`` is to be written as it is, and ``found()`` then has the counts.

    Nothing is read again for them. They are exact because the observed rows are written by the same tasks, of which Spark
    counts one run each; an observation before a shuffle could count a task that is run again twice. ``copies`` is a
    column with how many rows of its source a row stands for, and ``data`` says which rows are data.
    """

    def __init__(self, df: DataFrame, key: str, copies: str | None = None, data: Column | None = None):
        self._observed = Observation(f"rows_{uuid.uuid4().hex}")
        data = F.lit(True) if data is None else F.coalesce(data, F.lit(False))
        n = (F.col(copies) if copies else F.lit(1)).cast("long")
        keyed = data & F.col(key).isNotNull()
        # Hashes of 31 bits, so that the sum is exact for more rows than a decimal can count.
        hashes = F.xxhash64(F.col(key).cast("string")).bitwiseAND(F.lit((1 << 31) - 1)).cast("decimal(38,0)") * n.cast("decimal(19,0)")
        self.rows = df.observe(
            self._observed,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.when(keyed, n)), F.lit(0)).alias("keyed"),
            F.coalesce(F.sum(F.when(keyed, hashes.cast("decimal(38,0)"))), F.lit(0)).cast("decimal(38,0)").alias("keys"),
        )

    def found(self) -> Counted:
        """The counts, once ``rows`` was written."""
        found = self._observed.get
        return Counted(int(found["rows"]), int(found["keyed"]), int(found["keys"]))


def require_staged(staged: Counted, source: Counted) -> None:
    """The row count gate on observed counts: staging has at least the source's rows."""
    if staged.rows < source.rows:
        raise GateError(f"loaded {staged.rows} rows, expected {source.rows}")


def require_typed(typed: Counted, source: Counted) -> None:
    """The distinct key gate on observed counts.

    ``typed`` has one row per key and stands for as many rows, with the same keys, as the source has: then it has as
    many rows as the source has different keys. A row lost on the way shows, and so does a key that has changed."""
    if typed.keyed != source.keyed:
        raise GateError(f"loaded {typed.keyed} rows with a key, expected {source.keyed}")
    if typed.keys != source.keys:
        raise GateError(f"loaded {typed.rows} keys, not all of them the source's")


def _compared(loaded: DataFrame, expected: DataFrame) -> DataFrame:
    both = loaded.select(F.col("qt").alias("loaded"), F.lit(0).alias("expected")).unionAll(
        expected.select(F.lit(0).alias("loaded"), F.col("qt").alias("expected"))
    )
    return both.agg(F.sum("loaded").alias("loaded"), F.sum("expected").alias("expected"))
