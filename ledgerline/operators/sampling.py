"""Uniform samples of exact size, and the filtered sample query."""

from __future__ import annotations

import random
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators.filters import where_equal

SAMPLE_ROWS = 100
# The parameters the sample query knows.
PARAMETERS = ("cnae", "uf")
# Tasks that the partitions' smallest draws meet in before the last one.
MEETINGS = 64


def random_sample(df: DataFrame, n: int = SAMPLE_ROWS, seed: int | None = None) -> DataFrame:
    """``min(n, rows)`` rows, every subset equally likely."""
    seed = random.getrandbits(31) if seed is None else seed
    return _smallest(df.withColumn("_draw", F.rand(seed)), n)


def seeded_sample(df: DataFrame, key: str, seed: str, n: int = SAMPLE_ROWS) -> DataFrame:
    """A random sample that the seed and the keys determine: the ``min(n, rows)`` smallest ``md5(seed ‖ key)``.

    A row without a key draws by its whole content instead, so such rows are picked like all others.
    """
    named = F.coalesce(F.col(key).cast("string"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))
    return _smallest(df.withColumn("_draw", F.md5(F.concat(F.lit(seed), named))), n)


def _smallest(drawn: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows with the smallest ``_draw``, in one pass: every partition hands on ``n`` rows at most, groups of
    partitions do the same, and what they hand on meets in one task. Equal draws go by the rows' content."""
    order = [F.col("_draw"), F.xxhash64(*drawn.columns)]
    meeting = F.pmod(F.spark_partition_id(), F.lit(MEETINGS))
    rank = F.row_number().over(Window.partitionBy("_meeting").orderBy(*order))
    few = drawn.withColumn("_meeting", meeting).withColumn("_rank", rank).where(F.col("_rank") <= n)
    return few.drop("_meeting", "_rank").orderBy(*order).limit(n).drop("_draw")


def sample_registry(
    registry: DataFrame,
    parameters: Mapping[str, str] | None = None,
    n: int = SAMPLE_ROWS,
    key: str = "cnpj",
    seed: str | None = None,
) -> DataFrame:
    """Up to ``n`` random rows, filtered by activity code and state where given.

    Without parameters the whole table is sampled; with none of the known ones it is an error. Any table with the
    columns ``cnae``, ``uf`` and the key can be sampled, so wide rows need to be built only for the rows picked.
    """
    parameters = dict(parameters or {})
    wanted = {name: parameters.get(name) for name in PARAMETERS}
    if parameters and not any(value is not None for value in wanted.values()):
        raise ValueError(f"expected one of {', '.join(PARAMETERS)}, got {', '.join(parameters)}")
    rows = where_equal(registry, **wanted)
    return random_sample(rows, n) if seed is None else seeded_sample(rows, key, seed, n)


def as_records(df: DataFrame) -> DataFrame:
    """One JSON object per row under ``data``."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("data"))
