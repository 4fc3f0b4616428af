import math
import random

import numpy as np
import pytest

from ledgerline.llm import topk_search
from ledgerline.llm.topk_search import BallTree, bounds, search
from ledgerline.workspace import Workspace


def brute(rows, k=5, every=50):
    fine = [
        (i, [math.floor(256 * c) for c in v])
        for i, v in rows
        if v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = []
    for a, (i, v) in enumerate(fine):
        if i is None or i % every:
            continue
        others = [(-sum(x * y for x, y in zip(v, w)), j is None, j or 0) for b, (j, w) in enumerate(fine) if b != a and len(v) == len(w)]
        for rank, (score, none, j) in enumerate(sorted(others)[:k], 1):
            out.append((i, rank, None if none else j, -score))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()), key=str)


def table(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)


def clustered(n=700):
    random.seed(3)
    centres = [[random.gauss(0, 1) for _ in range(4)] for _ in range(6)]
    return [(i, [c + random.gauss(0, 0.1) for c in random.choice(centres)]) for i in range(n)]


ODD = [(50, [1.0, 2.0, 3.0, 4.0]), (None, [0.4] * 4), (1000, []), (1001, []), (1050, None), (1100, [1.0, None])]
ODD += [(1150, [math.nan, 1.0]), (1151, [math.inf, 1.0]), (1200, [1.0]), (1201, [-2.0]), (1250, [-0.0, 1e-30]), (1251, [0.0, -3.0])]


@pytest.mark.parametrize("parameters", [{}, {"shard_bytes": 3000, "leaf_rows": 8}, {"shard_bytes": 500, "leaf_rows": 1, "rounds": (1, 2, 1 << 30)}])
def test_like_brute_force(spark, parameters):
    rows = clustered()
    # A third of the rows is one vector; some rows come three times.
    rows += [(i, [0.5] * 4) for i in range(700, 1050)] + rows[50:52] * 2 + ODD
    got = result(topk_search.top_inner(Workspace(spark, "t"), table(spark, rows), **parameters))
    assert got == brute(rows)


def test_few_rows_and_no_rows(spark):
    rows = [(0, [1.0]), (50, [2.0]), (1, [3.0])]
    assert result(topk_search.top_inner(Workspace(spark, "t"), table(spark, rows, "float"))) == brute(rows)
    assert result(topk_search.top_inner(Workspace(spark, "t"), table(spark, []))) == []
    rows = [(7, [1.0]), (8, None)]
    clashing = table(spark, rows).selectExpr("*", "1 AS node", "2 AS h", "3 AS cell", "4 AS kth", "5 AS score")
    assert result(topk_search.top_inner(Workspace(spark, "t"), clashing)) == []


def test_scores_beyond_double_precision(spark):
    rows = [(0, [2.0**22 + 1, 1.0]), (1, [2.0**22 + 3, 5.0]), (2, [2.0**22 + 3, 5.25]), (3, [2.0**22 + 3, 4.75])] * 2
    assert result(topk_search.top_inner(Workspace(spark, "t"), table(spark, rows))) == brute(rows)
    with pytest.raises(Exception, match="does not fit a long"):
        topk_search.top_inner(Workspace(spark, "t"), table(spark, [(0, [1e30]), (1, [1e30])])).collect()


def test_no_vector_scores_above_its_balls():
    x = np.random.default_rng(1).integers(-300, 300, (500, 7)).astype(float)
    tree = BallTree(x, 16)
    assert sorted(tree.order) == list(range(500))
    scores = x @ x.T
    for centres, radii in tree.levels:
        most = bounds(x, centres, radii)
        size = len(tree.leaves) // len(centres)
        for node in range(len(centres)):
            own = tree.order[tree.leaves[node * size][0] : tree.leaves[(node + 1) * size - 1][1]]
            assert (scores[:, own] <= most[:, [node]]).all()


def test_clusters_are_cut_off():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(64, 16)) * 256
    x = np.floor(np.repeat(centres, 64, axis=0) + rng.normal(size=(64 * 64, 16)) * 8)
    q, v, scores = search(x[::64], x, 6, np.full(64, -np.inf), 64)
    assert len(q) < 64 * 64 * 4
    best = np.sort(x[::64] @ x.T, axis=1)[:, -6:]
    for i in range(64):
        assert sorted(scores[q == i])[-6:] == list(best[i])
    # With the k-th score of the whole, almost nothing else is looked at.
    again, _, _ = search(x[::64], x, 6, best[:, 0], 64)
    assert len(again) <= len(q)
