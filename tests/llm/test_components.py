import random

from pyspark.sql import functions as F

from ledgerline.llm.components import components, link_by_keys, none_of, only_maybe
from ledgerline.workspace import Workspace


def test_components_of_random_graphs(spark):
    random.seed(1)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    links += [(500, i) for i in range(501, 700)] + [(7, 7)]
    parent = list(range(800))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    want = {n: root(n) for a, b in links if a != b for n in (a, b)}
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r.node: r.component for r in components(Workspace(spark, "c"), df, "t").collect()}
    assert got == want
    assert components(Workspace(spark, "c"), df.where("a < 0"), "t").count() == 0


def test_the_bitmap_keeps_all_that_are_wanted(spark):
    df = spark.range(20_000).selectExpr("id AS k", "id % 3 AS v")
    wanted = spark.range(0, 20_000, 40).selectExpr("id AS k")
    kept = only_maybe(df, "k", wanted, words=1 << 10)
    assert kept.columns == ["k", "v"]
    assert kept.join(wanted, "k").count() == 500
    assert kept.count() < 1_500
    assert only_maybe(df, "k", wanted.where("k < 0")).count() == 0


def linked(spark, keys, true, hot_members):
    """Groups over ``keys`` rows, and how many pairs were verified, if exactly the pairs in ``true`` are links."""
    space, seen = Workspace(spark, "k"), []
    links = spark.createDataFrame(sorted(true) or [(-1, -1)], "a long, b long")

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.join(links, ["a", "b"], "left_semi")

    df = spark.createDataFrame(keys, "key long, node long, part int, sure int").repartition(4)
    nodes = df.select("node").distinct()
    groups = link_by_keys(space, df, verify, "t", nodes, lambda x, y: F.lit(True), hot_members)
    return {r.node: r.component for r in groups.collect() if r.node != r.component}, sum(seen)


def test_a_key_of_many_nodes_without_links_makes_few_pairs(spark):
    # Node n has the key that all have, one that ten have, and one of its own; nodes 10 k and 10 k + 1 are linked.
    keys = [row for n in range(2000) for row in ((1, n, 0, 2), (100 + n // 10, n, 1, 2), (10_000 + n, n, 2, 2))]
    true = {(n, n + 1) for n in range(0, 2000, 10)}
    groups, pairs = linked(spark, keys, true, 64)
    assert groups == {b: a for a, b in true}
    assert pairs < 2000 * 8


def test_random_keys_miss_no_link_whatever_is_hot(spark):
    random.seed(12)
    # A pair of similar nodes shares as many keys as the surer one says; unsure nodes may share one.
    keys, true = [], set()
    sure = {n: random.choice([1, 2, 3]) for n in range(120)}
    for n in range(120):
        keys += [(part * 10 + random.randrange(2), n, part, sure[n]) for part in range(5)]
    held = {n: {k for k, m, _, _ in keys if m == n} for n in range(120)}
    for a in range(120):
        for b in range(a + 1, 120):
            if len(held[a] & held[b]) >= max(sure[a], sure[b]) and random.random() < 0.02:
                true.add((a, b))
    expected, _ = linked(spark, keys, true, 10_000)
    for hot_members in (2, 5):
        assert linked(spark, keys, true, hot_members)[0] == expected


def test_a_dense_group_is_not_verified_pair_by_pair(spark):
    # Nodes of one key are linked when their numbers are close, so that the first centre links few of them.
    keys = [(1, n, 0, 1) for n in range(400)]
    true = {(a, b) for a in range(400) for b in range(a + 1, min(400, a + 60))}
    groups, pairs = linked(spark, keys, true, 10_000)
    assert groups == {n: 0 for n in range(1, 400)}
    assert pairs < 20_000


def test_none_of_leaves_out_exactly_the_named_rows(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    unwanted = spark.range(0, 4000, 7).select(F.col("id").alias("k"))
    # A bitmap of two words is full, so that every row is in doubt.
    for words in (2, 1 << 10):
        left = none_of(df, "k", unwanted, words=words)
        assert left.columns == df.columns
        assert sorted(r.k for r in left.collect()) == [i for i in range(2000) if i % 7]
    assert none_of(df, "k", unwanted.where("k < 0")).count() == 2000


def test_members_of_a_large_group_are_not_all_paired(spark, monkeypatch):
    """Half of all pairs are links, so half of the nodes are not linked to the first centre of their keys."""
    paired = []
    keep = Workspace.keep

    def watched(self, df, name, *more):
        out = keep(self, df, name, *more)
        if "_met_" in name or "_crowd_1" in name:
            paired.append((name, out.count()))
        return out

    monkeypatch.setattr(Workspace, "keep", watched)
    random.seed(3)
    n = 400
    true = {(a, b) for a in range(n) for b in range(a + 1, n) if random.random() < 0.5}
    keys = [(k, node, k, 1) for node in range(n) for k in range(8)]
    groups, _ = linked(spark, keys, true, 1500)
    assert groups == {node: 0 for node in range(1, n)}
    assert any("crowd" in name for name, _ in paired)
    assert sum(rows for _, rows in paired) < 10 * n
