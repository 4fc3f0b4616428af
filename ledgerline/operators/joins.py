"""Left equi-joins that hold at any size: broadcast what is measured to be small, salt what is measured to be hot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A table is broadcast only if it was measured to take at most this much memory on an executor.
BROADCAST_BYTES = 64 << 20
# In-memory cost of a row and of a field beside its characters, which count twice because the join keeps its
# key once more beside the row.
ROW_OVERHEAD = 96
FIELD_OVERHEAD = 16

# A key with more rows than this gets split over several tasks.
HOT_ROWS = 250_000
# At most this many keys are split, the hottest first; a key left out has fewer rows than any of them,
# so less than 1 / MAX_HOT_KEYS of the table.
MAX_HOT_KEYS = 10_000
# At most this many pieces per key, which is also how often the other side's row is repeated.
MAX_PIECES = 4_000


@dataclass(frozen=True)
class Measure:
    """Rows and text bytes of a table, the most of either that one value of its first column has, and of one row."""

    rows: int = 0
    text: int = 0
    key_rows: int = 0
    key_text: int = 0
    row_text: int = 0
    columns: int = 0

    @property
    def memory(self) -> int:
        """Upper bound of what the table takes in memory."""
        return 2 * self.text + self.rows * (ROW_OVERHEAD + FIELD_OVERHEAD * self.columns)


def measure(*tables: DataFrame) -> list[Measure]:
    """Measures of all tables from one aggregate over them. Sums go before the shuffle; a row per table comes back."""

    def rows(i: int, table: DataFrame) -> DataFrame:
        lengths = (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns)
        text = reduce(Column.__add__, lengths).cast("long")
        return table.select(F.lit(i).alias("i"), F.col(table.columns[0]).cast("string").alias("key"), text.alias("text"))

    by_key = reduce(DataFrame.unionAll, (rows(i, t) for i, t in enumerate(tables))).groupBy("i", "key")
    by_key = by_key.agg(F.count(F.lit(1)).alias("n"), F.sum("text").alias("text"), F.max("text").alias("longest"))
    found = by_key.groupBy("i").agg(F.sum("n"), F.sum("text"), F.max("n"), F.max("text"), F.max("longest")).collect()
    measures = {i: Measure(*values, len(tables[i].columns)) for i, *values in map(tuple, found)}
    return [measures.get(i, Measure(columns=len(t.columns))) for i, t in enumerate(tables)]


class Measures:
    """Measures of tables, each table measured once however many joins ask for it."""

    def __init__(self, *tables: DataFrame):
        self._known: dict[int, tuple[DataFrame, Measure]] = {}
        self.of(*tables)

    def of(self, *tables: DataFrame) -> list[Measure]:
        """The measure of each table; those not measured yet are, together."""
        new = list({id(t): t for t in tables if id(t) not in self._known}.values())
        if new:
            self._known |= {id(t): (t, m) for t, m in zip(new, measure(*new))}
        return [self._known[id(t)][1] for t in tables]


def hot_keys(fact: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> list[tuple[str | None, int]]:
    """The keys of ``fact`` (NULL included) with more than ``hot_rows`` rows, and how many pieces to cut each into.

    Reads one column, counts before it shuffles, and brings at most ``MAX_HOT_KEYS`` rows to the driver.
    """
    counts = fact.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("n"))
    hottest = counts.where(F.col("n") > hot_rows).orderBy(F.desc("n")).limit(MAX_HOT_KEYS)
    return [(r["hot_key"], min(MAX_PIECES, -(-r["n"] // hot_rows))) for r in hottest.collect()]


def left_join(
    fact: DataFrame,
    key: str,
    *others: tuple[DataFrame, str],
    hot_rows: int = HOT_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``fact`` left-joined on ``key`` with each ``(table, column)``, keeping all columns.

    All joins share one shuffle of ``fact``. A hot key would put its rows into one task. If there is one, tables
    measured to be small are broadcast; for the others its rows are dealt out over pieces and the few matching
    rows of the table are repeated once per piece. NULL keys are dealt out too and match nothing. Column names
    must differ between the tables.
    """
    hot = hot_keys(fact, key, hot_rows)
    if not hot:
        for table, column in others:
            fact = fact.join(table, F.col(key) == F.col(column), "left")
        return fact

    columns = fact.columns + [c for table, _ in others for c in table.columns]
    sizes = [m.memory for m in measure(*(table for table, _ in others))]
    small = [other for other, size in zip(others, sizes) if size <= max_bytes]
    large = [other for other, size in zip(others, sizes) if size > max_bytes]
    if large:
        fact = _left_join_in_pieces(fact, key, large, hot)
    for table, column in small:
        fact = fact.join(F.broadcast(table), F.col(key) == F.col(column), "left")
    return fact.select(*columns)


def _left_join_in_pieces(
    fact: DataFrame, key: str, others: Sequence[tuple[DataFrame, str]], hot: list[tuple[str | None, int]]
) -> DataFrame:
    # At most MAX_HOT_KEYS short rows.
    schema = f"hot_key {dict(fact.dtypes)[key]}, pieces int"
    pieces = F.broadcast(fact.sparkSession.createDataFrame(hot, schema))
    # The same whenever a task is run again, and different for copies of a row read by different tasks.
    piece = F.pmod(F.xxhash64(F.spark_partition_id(), *fact.columns), F.col("pieces")).cast("int")
    fact = (
        fact.join(pieces, F.col(key).eqNullSafe(F.col("hot_key")), "left")
        .withColumn("piece", F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(piece))
        .drop("hot_key", "pieces")
    )
    for table, column in others:
        last = F.coalesce("pieces", F.lit(1)) - 1
        repeated = (
            table.join(pieces, F.col(column) == F.col("hot_key"), "left")
            .withColumn("other_piece", F.explode(F.sequence(F.lit(0), last)))
            .drop("hot_key", "pieces")
        )
        same = (F.col(key) == F.col(column)) & (F.col("piece") == F.col("other_piece"))
        fact = fact.join(repeated, same, "left").drop("other_piece")
    return fact.drop("piece")


def code_table(table: DataFrame, prefix: str) -> DataFrame:
    """A ``(codigo, descricao)`` table under column names of its own."""
    return table.select(F.col("codigo").alias(f"{prefix}_codigo"), F.col("descricao").alias(f"{prefix}_descricao"))


@dataclass(frozen=True, eq=False)
class Role:
    """A column of codes, the table that describes them, and a prefix for the columns it adds."""

    column: str
    table: DataFrame
    prefix: str


def split_by_size(
    roles: Sequence[Role], max_bytes: int = BROADCAST_BYTES, measures: Measures | None = None
) -> tuple[list[Role], list[Role]]:
    """Roles whose table was measured to fit ``max_bytes``, and the others."""
    measured = (measures or Measures()).of(*(r.table for r in roles))
    small = [r for r, m in zip(roles, measured) if m.memory <= max_bytes]
    return small, [r for r in roles if r not in small]


def lookup_small(fact: DataFrame, roles: Sequence[Role]) -> DataFrame:
    """Left-join with tables that are known to be small, without moving ``fact``."""
    for r in roles:
        table = F.broadcast(code_table(r.table, r.prefix))
        fact = fact.join(table, F.col(r.column) == F.col(f"{r.prefix}_codigo"), "left")
    return fact


def lookup_large(fact: DataFrame, roles: Sequence[Role], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left-join with tables of any size, by shuffle, hot codes split."""
    for r in roles:
        table = code_table(r.table, r.prefix)
        # Known not to be small, so there is nothing to measure again.
        fact = left_join(fact, r.column, (table, f"{r.prefix}_codigo"), hot_rows=hot_rows, max_bytes=0)
    return fact


def lookup(
    fact: DataFrame,
    *roles: tuple[str, DataFrame, str],
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    measures: Measures | None = None,
) -> DataFrame:
    """Left-join ``fact`` with code tables: each role is ``(fact column, code table, prefix)``.

    Adds ``<prefix>_codigo`` and ``<prefix>_descricao``. Several roles may use the same table. A repeated code
    repeats the row, as any left join does.
    """
    small, large = split_by_size([Role(*r) for r in roles], max_bytes, measures)
    return lookup_small(lookup_large(fact, large, hot_rows), small)
