"""Mixing sources to target weights by hash thresholds.

Every document has a fixed 60-bit hash. A source that gives part of its words gives the documents whose hash is at most
its threshold; a larger budget has a larger threshold, so mixes are nested. Thresholds are found without sorting
documents: words are summed by source and the first 12 bits, the bucket in which the budget runs out is cut by the next
12 bits, and so on until it holds a single hash. Only sums travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.text import free_name, narrow, word_count
from ledgerline.workspace import Workspace

WEIGHTS = (1, 2, 3)
#: A document is taken at most this often.
MAX_COPIES = 3
BITS, STEP = 60, 12
#: Up to this many sources the table of thresholds, under 100 bytes a row beside the name, is broadcast.
BROADCAST_SOURCES = 10_000


def _hash(doc_id: F.Column, text: F.Column) -> F.Column:
    """60 bits of the document's MD5."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.0, max_copies: int = MAX_COPIES
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``.

    Sources in order of code points, null last, get the weights in turn, and share ``share`` of all words by weight. A
    target stops at ``max_copies`` times its source's words; what is over goes to the others by weight, until none is
    above. One row per source: the windows here order sources, not documents.
    """
    named = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place - 1, len(weights)) + 1).cast("int"))
    named = named.withColumn("weight", turn.cast("long"))
    # Sources reach their limit in the order of words for each unit of weight.
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.col("source_size") * max_copies
    budget = F.floor(F.sum("source_size").over(every) * F.lit(share)).cast("long")
    named = named.withColumns(
        {
            "limit": limit,
            "left": budget - F.coalesce(F.sum(limit).over(before), F.lit(0)),
            "others": F.sum("weight").over(rest),
        }
    )
    wide = "decimal(38,0)"
    full = F.col("limit").cast(wide) * F.col("others") <= F.col("left").cast(wide) * F.col("weight")
    # All sources from the first that stays under its limit share by weight what is left there.
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = named.withColumn("full", full)
    named = named.withColumns(
        {c: F.first(F.when(~F.col("full"), F.col(c)), ignorenulls=True).over(whole) for c in ("left", "others")}
    )
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        (F.col("left") * F.col("weight")).cast("double") / F.col("others")
    )
    return named.select("source", "source_size", target.alias("target"))


def _thresholds(space: Workspace, sizes: DataFrame, targets: DataFrame, name: str) -> DataFrame:
    """``(source, source_size, target, copies, threshold)``: every document is taken ``copies`` times, and once more
    if its hash is at most ``threshold``.

    The document at which the rest runs out is taken if that comes nearer to the target; documents of one hash (copies
    of a row) are taken together.
    """
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("copies", copies.cast("long"))
    targets = targets.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    targets = space.keep(targets, f"{name}_targets")

    open_ends = targets.where("rest > 0").select("source", "rest", F.lit(0).alias("start"), F.lit(0).alias("taken"))
    open_ends = open_ends.select("source", "rest", F.col("start").cast("long"), F.col("taken").cast("long"))
    found = None
    for level in range(1, BITS // STEP + 1):
        shift = BITS - STEP * level
        inside = sizes.join(
            open_ends.withColumnRenamed("source", "s"),
            F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("h", shift + STEP) == F.col("start")),
        )
        sums = inside.groupBy("source", "rest", "taken", F.shiftright("h", shift).alias("start")).agg(
            F.sum("size").alias("size"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        # At most 2**STEP buckets of one source meet in a task here.
        running = F.sum("size").over(Window.partitionBy("source").orderBy("start"))
        sums = sums.withColumn("upto", F.col("taken") + running).where("upto >= rest")
        one = F.row_number().over(Window.partitionBy("source").orderBy("start"))
        ends = space.keep(sums.withColumn("n", one).where("n = 1"), f"{name}_level{level}")
        single = ends.where("low = high").select(
            "source",
            F.when(F.col("upto") - F.col("rest") <= F.col("rest") - (F.col("upto") - F.col("size")), F.col("high"))
            .otherwise(F.col("low") - 1)
            .alias("threshold"),
        )
        found = single if found is None else found.unionAll(single)
        open_ends = ends.where("low < high").select(
            "source", "rest", "start", (F.col("upto") - F.col("size")).alias("taken")
        )
        if open_ends.isEmpty():
            break
    found = found.withColumnRenamed("source", "s")
    joined = targets.join(found, F.col("source").eqNullSafe(F.col("s")), "left")
    return space.keep(
        joined.select("source", "source_size", "target", "copies", F.coalesce("threshold", F.lit(-1)).alias("threshold")),
        f"{name}_thresholds",
    )


def _join_thresholds(rows: DataFrame, thresholds: DataFrame, source: str) -> tuple[DataFrame, str]:
    """The thresholds beside each row, in a struct column of the name returned. Few sources are broadcast, so that a
    hot one moves no rows."""
    name = free_name(rows.columns, "mix")
    table = thresholds.select(F.struct("*").alias(name))
    table = F.broadcast(table) if thresholds.count() <= BROADCAST_SOURCES else table
    return rows.join(table, F.col(f"`{source}`").eqNullSafe(F.col(f"{name}.source"))), name


def mix_counts(
    space: Workspace,
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.0,
    max_copies: int = MAX_COPIES,
    name: str = "mix",
) -> DataFrame:
    """Per document ``doc_id, source, size, source_size, target, copies, taken``.

    ``docs`` needs ``doc_id``, ``source`` and ``text``; other columns are ignored. Null and empty texts have no words and
    are taken as their hash says. A null source is a source of its own, a null id a value like any other. Rows that
    agree in id and text have one hash and share their decision. A source without words has target 0. An empty table
    gives none.
    """
    sizes = _sizes(space, docs, name)
    thresholds = _thresholds(space, sizes, source_targets(sizes, weights, share, max_copies), name)
    chosen, mixed = _join_thresholds(sizes, thresholds, "source")
    copies = F.col(f"{mixed}.copies") + F.when(F.col("h") <= F.col(f"{mixed}.threshold"), 1).otherwise(0)
    return chosen.select(
        "doc_id",
        "source",
        "size",
        f"{mixed}.source_size",
        f"{mixed}.target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def _sizes(space: Workspace, docs: DataFrame, name: str) -> DataFrame:
    rows = narrow(docs, "doc_id", "source", "text")
    return space.keep(
        rows.select("doc_id", "source", word_count(F.col("text")).alias("size"), _hash(F.col("doc_id"), F.col("text")).alias("h")),
        f"{name}_sizes",
    )


def mix(
    space: Workspace,
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = 1.0,
    max_copies: int = MAX_COPIES,
    name: str = "mix",
) -> DataFrame:
    """``docs`` as the mix has it: each row as often as it is taken, rows that are not taken left out."""
    sizes = _sizes(space, docs, name)
    thresholds = _thresholds(space, sizes, source_targets(sizes, weights, share, max_copies), name)
    chosen, mixed = _join_thresholds(docs, thresholds, "source")
    more = F.when(_hash(F.col("doc_id"), F.col("text")) <= F.col(f"{mixed}.threshold"), 1).otherwise(0)
    copies = (F.col(f"{mixed}.copies") + more).cast("int")
    taken = F.explode(F.array_repeat(F.lit(0), copies))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return chosen.select(*names, taken.alias(free_name(docs.columns, "copy"))).select(*names)
