import math
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import sharding
from ledgerline.llm.sharding import grown, layout, manifest, shard_of
from ledgerline.workspace import Workspace


def brute(key, tree):
    """The shard a key descends to, drawn in plain Python."""

    def draw(name, weight):
        h = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        h = xxhash.xxh64_intdigest(name.encode(), h)
        return -math.log(((h >> 12) + 0.5) / 2**52) / weight

    r = min((draw(f"{i}", sum(map(sum, x))), i) for i, x in enumerate(tree))[1]
    k = min((draw(f"{r}/{i}", sum(x)), i) for i, x in enumerate(tree[r]))[1]
    s = min((draw(f"{r}/{k}/{i}", x), i) for i, x in enumerate(tree[r][k]))[1]
    before = [len(rack) for region in tree[:r] for rack in region] + [len(rack) for rack in tree[r][:k]]
    return sum(before) + s


def test_draws_like_brute_force(spark):
    tree = [[[1.0, 2.0], [0.5]], [[3.0]], [[1.0, 1.0, 1.0]]]
    got = spark.range(300).select("id", shard_of(F.col("id"), tree).alias("s")).collect()
    assert {r.id: r.s for r in got} == {i: brute(i, tree) for i in range(300)}


def test_weights_and_movement(spark):
    tree = [[[1.0, 2.0], [1.0]], [[4.0]]]
    heavier = [[[1.0, 2.0], [1.0]], [[8.0]]]
    rows = spark.range(20_000).select(*(shard_of(F.col("id"), t).alias(n) for t, n in ((tree, "a"), (heavier, "b"))))
    counts = {r.a: r["count"] for r in rows.groupBy("a").count().collect()}
    for shard, weight in enumerate((1, 2, 1, 4)):
        assert abs(counts[shard] - 2500 * weight) < 300
    assert rows.where("a <> b AND b <> 3").count() == 0
    assert 3_000 < rows.where("a <> b").count() < 3_700


def test_the_manifest(docs, spark):
    rows = [(i, f"text {i % 7}" if i % 11 else None) for i in range(700)] + [(3, "twice"), (3, "twice"), (None, "é"), (None, "")]
    given = docs(rows).selectExpr("*", "1 AS shard", "2 AS size", "3 AS bucket")
    got = manifest(Workspace(spark, "s"), given).collect()
    want = Counter()
    for i, t in rows:
        data = (t or "").encode()
        want[(i, len(data) + 1, zlib.crc32(data), "key", brute(i, layout(16)), brute(i, grown(layout(16))))] += 1
    assert Counter((r.doc_id, r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    moved = [r for r in got if r.shard != r.grown_shard]
    assert moved and all(r.grown_shard == 16 for r in moved)
    assert manifest(Workspace(spark, "s"), docs([], 1)).count() == 0


def test_written_shards(docs, spark, tmp_path):
    path = str(tmp_path / "shards")
    sharding.write_shards(docs([(i, f"t{i}") for i in range(200)]), path, layout(16))
    back = spark.read.parquet(path)
    assert back.count() == 200
    assert back.where(shard_of(F.col("doc_id"), layout(16)) != F.col("shard")).count() == 0
    assert layout(10) == [[[1.0] * 4, [1.0] * 4], [[1.0] * 2]]
