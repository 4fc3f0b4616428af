"""Sharding by a hierarchical weighted hash tree.

A tree has regions, regions have racks, racks have shards, and every shard has a weight; racks and regions weigh what
their shards weigh. A row descends: on each level every child draws -ln(u) / weight from the row's key and the child's
name, and the smallest draw wins. A child whose weight grows only ever wins rows, one whose weight shrinks only loses
them, and draws between other children stay as they are, so movement is confined to the subtrees whose weights change.
A new shard opens a region of its own: all rows that move, move into it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.text import narrow
from ledgerline.workspace import Workspace

#: Regions of racks of shard weights.
Tree = Sequence[Sequence[Sequence[float]]]

SHARDS = 16
RACKS, PER_RACK = 2, 4
#: Rows of one shard are numbered in buckets of about so many.
BUCKET_ROWS = 10_000


def layout(shards: int, racks: int = RACKS, per_rack: int = PER_RACK) -> list[list[list[float]]]:
    """``shards`` shards of weight 1 in full racks and regions; the last may be smaller."""
    filled = [[1.0] * min(per_rack, shards - i) for i in range(0, shards, per_rack)]
    return [filled[i : i + racks] for i in range(0, len(filled), racks)]


def grown(tree: Tree, weight: float = 1.0) -> list[list[list[float]]]:
    """``tree`` with one more shard, in a region of its own."""
    return [*[[list(rack) for rack in region] for region in tree], [[weight]]]


def _draw(key: Column, name: str, weight: float) -> Column:
    # 52 bits between 0 and 1, never either.
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 12) + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(float(weight))


def _least(key: Column, names: Sequence[str], weights: Sequence[float], results: Sequence[Column]) -> Column:
    """The result of the child with the smallest draw; the first on a tie. Children of weight 0 never win."""
    drawn = [(i, _draw(key, n, w)) for i, (n, w) in enumerate(zip(names, weights)) if w > 0]
    winner = F.array_min(F.array(*(F.struct(d.alias("draw"), F.lit(i).alias("i")) for i, d in drawn))).getField("i")
    if len(drawn) == 1:
        return results[drawn[0][0]]
    cases = [(winner == i, results[i]) for i, _ in drawn]
    return reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), reversed(cases[:-1]), cases[-1][1])


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard (numbered through the tree from 0) that a row with this key descends to. A null key is a key."""
    number, regions, weights = 0, [], []
    for r, region in enumerate(tree):
        racks, rack_weights = [], []
        for k, rack in enumerate(region):
            names = [f"{r}/{k}/{s}" for s in range(len(rack))]
            shards = [F.lit(number + s) for s in range(len(rack))]
            number += len(rack)
            if sum(rack) > 0:
                racks.append((f"{r}/{k}", sum(rack), _least(key, names, rack, shards)))
        if racks:
            names, rack_weights, results = zip(*racks)
            regions.append((f"{r}", sum(rack_weights), _least(key, names, rack_weights, results)))
    if not regions:
        raise ValueError("no shard has a weight")
    names, weights, results = zip(*regions)
    return _least(key, names, weights, results)


def shard(docs: DataFrame, tree: Tree, key: str = "doc_id", column: str = "shard") -> DataFrame:
    """``docs`` with the shard of each row."""
    return docs.withColumn(column, shard_of(F.col(f"`{key}`"), tree))


def write_shards(docs: DataFrame, path: str, tree: Tree, key: str = "doc_id", files: int = 8) -> None:
    """One folder ``shard=N`` per shard, each in ``files`` files at most."""
    deal = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(files))
    placed = shard(docs, tree, key).repartition("shard", deal)
    placed.write.mode("overwrite").partitionBy("shard").parquet(path)


def manifest(space: Workspace, docs: DataFrame, tree: Tree | None = None, name: str = "shards") -> DataFrame:
    """Per row ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. The size is the text's bytes plus one (null
    text: one, with the checksum of no bytes). Slots number a shard's rows without gaps, by a hash of the row. Rows
    that repeat get slots of their own; rows with one id, null included, share a shard. An empty table gives none.
    """
    tree = layout(SHARDS) if tree is None else tree
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b"").cast("binary"))
    rows = narrow(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    # Equal rows are counted, not gathered.
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("rows"))
    key = F.col("doc_id")
    counted = counted.withColumns({"shard": shard_of(key, tree), "grown_shard": shard_of(key, grown(tree))})
    counted = space.keep(counted, f"{name}_counted")

    n = counted.count()
    shards = sum(len(rack) for region in tree for rack in region)
    buckets = max(1, -(-n // (shards * BUCKET_ROWS)))
    bucket = F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit("slot")), F.lit(buckets))
    counted = counted.withColumn("bucket", bucket)
    sums = counted.groupBy("shard", "bucket").agg(F.sum("rows").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("offset", F.coalesce(F.sum("rows").over(inside), F.lit(0)))
    placed = placed.join(starts, ["shard", "bucket"])
    first = F.col("start") + F.col("offset")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(first, first + F.col("rows") - 1)).alias("slot"),
        "grown_shard",
    )
