"""Exact top-k search by inner product: ball trees, branch and bound, a shared k-th score.

Vectors lie in cells around pivots, and cells are cut into shards of bounded size. A shard is one ball tree: every node
has a centre c and a radius r, so no vector below it scores more than q.c + |q| r with a query q. A query asks cells in the order
of that bound. After each round its k-th score so far goes with it to the next cells: those that cannot reach it
are left out, and the others start their search from it. In a tree, levels are cut off by the bound, and leaves are visited from
the best bound on, in steps that double, until the next one cannot reach the k-th score.

Pivots are fitted on a bounded sample. They decide which vectors lie together and nothing else: the result is exact
whatever they are. Scores are integers; a bound is given a margin for rounding, and equal scores are never cut off.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.text import narrow
from ledgerline.workspace import Workspace

#: Scores for each query, and which rows are queries.
TOP, EVERY = 5, 50
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Bytes of vectors in a shard, and queries that search one together.
SHARD_BYTES, BLOCK_QUERIES = 4 << 20, 2_048
#: Vectors of a leaf.
LEAF_ROWS = 128
#: Pivots are fitted on about so many bytes of vectors, with a hash that all vectors have; there are so many at most.
SAMPLE_BYTES, MAX_CELLS = 2 << 20, 256
#: Cells that a query asks up to the end of each round.
ROUNDS = (1, 8, 64, 1 << 30)
#: Whole numbers up to here are exact in double precision, in any order of summing up.
EXACT = float(1 << 53)


class BallTree:
    """A balanced tree over vectors: level ``l`` has ``2 ** l`` nodes, each half of the one above by a plane between two
    vectors far apart."""

    def __init__(self, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        n = len(vectors)
        depth = max(0, math.ceil(math.log2(max(1, n / leaf_rows))))
        self.order, cuts = np.arange(n), [0, n]
        self.levels = []
        for level in range(depth + 1):
            if level:
                halves = []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    own = self.order[a:b]
                    middle = (b - a) // 2
                    if middle:
                        x = vectors[own]
                        one = x[np.argmax(((x - x[0]) ** 2).sum(1))]
                        two = x[np.argmax(((x - one) ** 2).sum(1))]
                        self.order[a:b] = own[np.argpartition(x @ (two - one), middle)]
                    halves += [a, a + middle]
                cuts = [*halves, n]
            centres = np.zeros((len(cuts) - 1, vectors.shape[1]))
            radii = np.full(len(cuts) - 1, -np.inf)
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                if a < b:
                    x = vectors[self.order[a:b]]
                    centres[i] = x.mean(0)
                    radii[i] = np.sqrt(((x - centres[i]) ** 2).sum(1).max())
            self.levels.append((centres, radii))
        self.leaves = list(zip(cuts[:-1], cuts[1:]))


def bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """The largest scores that vectors in each ball can have with each query, with a margin for rounding."""
    lengths = np.sqrt((queries**2).sum(1))[:, None]
    far = lengths * np.where(radii >= 0, radii, 0)
    most = queries @ centres.T + far + 1e-9 * (lengths * np.sqrt((centres**2).sum(1)) + far) + 1e-6
    return np.where(radii >= 0, most, -np.inf)


def search(
    queries: np.ndarray, vectors: np.ndarray, k: int, least: np.ndarray, leaf_rows: int = LEAF_ROWS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``(query, vector, score)`` that include each query's ``k`` best scores from ``least`` on, and all equal to the last."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * vectors.shape[1]
    exact = largest < EXACT
    whole = None if exact else ([[int(c) for c in v] for v in m] for m in (queries, vectors))
    if whole is not None:
        # Beyond double precision: Python's whole numbers, which numpy multiplies as objects.
        whole = [np.array(m, dtype=object).reshape(x.shape) for m, x in zip(whole, (queries, vectors))]
    tree = BallTree(vectors, leaf_rows)
    kth = least.copy()
    best = np.full((len(queries), k), -np.inf)
    live = np.ones((len(queries), 1), bool)
    for level, (centres, radii) in enumerate(tree.levels):
        most = bounds(queries, centres, radii)
        live = (np.repeat(live, 2, axis=1) if level else live) & (most >= kth[:, None])
    most = np.where(live, most, -np.inf)
    order = np.argsort(-most, axis=1, kind="stable")
    sorted_most = np.take_along_axis(most, order, axis=1)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    start, step = 0, 1
    while start < most.shape[1]:
        upto = slice(start, start + step)
        q, i = np.nonzero((sorted_most[:, upto] >= kth[:, None]) & np.isfinite(sorted_most[:, upto]))
        if not len(q):
            break  # later leaves of every query have smaller bounds
        leaf = order[:, upto][q, i]
        by_leaf = np.argsort(leaf, kind="stable")
        q, leaf = q[by_leaf], leaf[by_leaf]
        for own in np.split(np.arange(len(q)), np.flatnonzero(np.diff(leaf)) + 1):
            a, b = tree.leaves[leaf[own[0]]]
            rows, asked = tree.order[a:b], q[own]
            scores = queries[asked] @ vectors[rows].T if exact else whole[0][asked] @ whole[1][rows].T
            seen = np.concatenate([best[asked], scores.astype(float)], axis=1)
            best[asked] = -np.partition(-seen, k - 1, axis=1)[:, :k]
            # A whole number above 2**53 may round up; less a margin it is a bound still.
            last = best[asked].min(1)
            kth[asked] = np.maximum(kth[asked], last if exact else last - 1e-15 * np.abs(last))
            x, y = np.nonzero(scores.astype(float) >= kth[asked][:, None])
            found.append((asked[x], rows[y], scores[x, y]))
        start, step = start + step, step * 2
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    q, v, scores = (np.concatenate(c) for c in zip(*found))
    still = scores.astype(float) >= kth[q]
    return q[still], v[still], scores[still]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _search_shard(k: int, leaf_rows: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64())})
        ids = held.column("ids").combine_chunks()
        nodes = asked.column("node").to_numpy()
        q, v, scores = search(_matrix(asked.column("v")), _matrix(held.column("v")), k, asked.column("kth").to_numpy(), leaf_rows)
        # Each of a vector's ids is a row; the k first of a query stay, by score and id, those without an id last.
        starts, flat = ids.offsets.to_numpy(), ids.values
        n = (starts[1:] - starts[:-1])[v]
        place = np.repeat(starts[:-1][v] + n - np.cumsum(n), n) + np.arange(n.sum())
        q, scores = np.repeat(q, n), np.repeat(scores, n)
        none = flat.is_null().to_numpy(zero_copy_only=False)[place]
        number = flat.fill_null(0).to_numpy(zero_copy_only=False)[place]
        by = np.lexsort((number, none, -scores, q))
        first = np.r_[True, np.diff(q[by]) > 0]
        rank = np.arange(len(by)) - np.maximum.accumulate(np.where(first, np.arange(len(by)), 0)) if len(by) else by
        by = by[rank < k]
        score = [int(s) for s in scores[by]]
        if any(not -(1 << 63) <= s < 1 << 63 for s in score):
            raise ValueError("an inner product does not fit a long")
        rows = {"node": pa.array(nodes[q[by]]), "score": pa.array(score, pa.int64()), "vec_id": pa.array(number[by], mask=none[by])}
        return pa.table(rows)

    return run


def fit_pivots(sample: dict[int, np.ndarray], cells: dict[int, int]) -> dict[int, np.ndarray]:
    """Pivots for each length: means of the sample's vectors after a few rounds of nearest pivots, starting from vectors
    evenly apart in it."""
    found = {}
    for n, x in sample.items():
        pivots = x[np.linspace(0, len(x) - 1, min(cells[n], len(x))).astype(int)].copy()
        for _ in range(5):
            nearest = np.argmin((pivots**2).sum(1) - 2 * x @ pivots.T, axis=1)
            for i in np.unique(nearest):
                pivots[i] = x[nearest == i].mean(0)
        found[n] = pivots
    return found


def _cells(pivots):
    """Each vector's cell, and its distance from the cell's pivot. A length without pivots is one cell around zero."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = table.column("length").to_numpy()
            cell, far = np.zeros(len(sizes), np.int32), np.zeros(len(sizes))
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                x = _matrix(table.column("v").take(pa.array(at)))
                centres = pivots.value.get(int(n), np.zeros((1, n)))
                nearest = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
                cell[at], far[at] = nearest, np.sqrt(((x - centres[nearest]) ** 2).sum(1))
            table = table.append_column("cell", pa.array(cell)).append_column("far", pa.array(far))
            yield from table.to_batches()

    return run


def _asks(balls, start: int, end: int):
    """The cells that each query asks in this round: those from place ``start`` to ``end`` that may reach its k-th score."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes, kth = table.column("length").to_numpy(), table.column("kth").to_numpy()
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                number, centres, radii = balls.value[int(n)]
                most = bounds(_matrix(table.column("v").take(pa.array(at))), centres, radii)
                order = np.argsort(-most, axis=1, kind="stable")[:, start:end]
                q, i = np.nonzero(np.take_along_axis(most, order, axis=1) >= kth[at][:, None])
                rows = table.take(pa.array(at[q]))
                yield from rows.append_column("cell", pa.array(number[order[q, i]])).to_batches()

    return run


def top_inner(
    space: Workspace,
    vectors: DataFrame,
    k: int = TOP,
    every: int = EVERY,
    id_column: str = "vec_id",
    column: str = "embedding",
    shard_bytes: int = SHARD_BYTES,
    leaf_rows: int = LEAF_ROWS,
    rounds: tuple[int, ...] = ROUNDS,
    name: str = "search",
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best other rows of every row whose id ``every`` divides.

    Components x count as ``floor(256 x)``, the score is the inner product, ties go to the smaller id, and to rows without an id
    last. Vectors that are null or hold a null or non-finite component take no part; a query is answered among the vectors of
    its own length, the empty ones included. A row is left out of its own answer only: rows that repeat its id, or all of it,
    are candidates, and a query that comes several times is answered as often. Other columns are ignored. An empty table
    gives no rows. Scores are exact, and one beyond a long stops the job.
    """
    spark, top = space.spark, k + 1  # a row that repeats the query's own takes its place
    x = narrow(vectors, id_column, column).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("x")
    )
    infinite = float("inf")
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < infinite))
    # From 2**52 on every double is whole; zero is added so that -0 is 0.
    whole = F.transform(
        F.transform("x", lambda c: c * SCALE),
        lambda c: F.when(F.abs(c) < float(1 << 52), F.floor(c).cast("double")).otherwise(c) + F.lit(0.0),
    )
    rows = x.where(F.coalesce(fine, F.lit(False))).select("vec_id", whole.alias("v"))
    rows = space.keep(rows.withColumn("h", F.xxhash64("v")), f"{name}_rows")
    asks = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))

    # Equal vectors are one node. More than ``top`` of them never come in one answer, so the smallest ids do.
    smallest = Window.partitionBy("h", "v").orderBy(F.col("vec_id").asc_nulls_last())
    first = rows.withColumn("i", F.row_number().over(smallest)).where(F.col("i") <= top)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("i", "vec_id"))), lambda s: s.vec_id)
    nodes = first.groupBy("h", "v").agg(ids.alias("ids"))
    wanted = rows.where(asks).select("h", "v").distinct().withColumn("asked", F.lit(True))
    nodes = nodes.join(wanted, ["h", "v"], "left").withColumn("node", F.monotonically_increasing_id())
    nodes = space.keep(nodes.withColumn("length", F.size("v")), f"{name}_nodes")

    lengths = {r["length"]: r["n"] for r in nodes.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    bytes_all = sum(8 * (n + 1) * count for n, count in lengths.items())
    cells = {
        n: max(1, min(math.ceil(8 * n * count / shard_bytes), MAX_CELLS * 8 * (n + 1) * count // bytes_all))
        for n, count in lengths.items()
    }
    share = math.ceil(bytes_all / SAMPLE_BYTES)
    drawn = nodes.where(F.pmod(F.col("h"), F.lit(share)) == 0).where("length > 0")
    sample: dict[int, list] = {}
    if max(cells.values()) > 1:
        for r in drawn.select("length", "v").collect():
            sample.setdefault(r["length"], []).append(r["v"])
    pivots = fit_pivots({n: np.array(v) for n, v in sample.items() if cells[n] > 1}, cells)
    fitted = spark.sparkContext.broadcast(pivots)
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in nodes.schema)}, cell int, far double"
    nodes = space.keep(nodes.mapInArrow(_cells(fitted), schema), f"{name}_cells")

    stats = nodes.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()
    balls, pieces = {}, []
    for n in lengths:
        own = sorted((r["cell"], r["n"], r["far"]) for r in stats if r["length"] == n)
        centres = pivots.get(n, np.zeros((1, n)))
        number = np.array([c for c, _, _ in own], np.int32)
        balls[n] = number, centres[number], np.array([far for _, _, far in own])
        pieces += [(n, c, math.ceil(8 * (n + 1) * count / shard_bytes)) for c, count, _ in own]
    balls = spark.sparkContext.broadcast(balls)
    pieces = F.broadcast(spark.createDataFrame(pieces, "length int, cell int, pieces int"))
    held = nodes.join(pieces, ["length", "cell"])
    held = held.select("length", "cell", F.pmod(F.col("node"), F.col("pieces")).cast("int").alias("piece"), "v", "ids")

    queries = nodes.where("asked").select("node", "length", "v")
    empty = F.array().cast("array<struct<score:long,vec_id:long>>")
    state = queries.select("node", F.lit(-infinite).alias("kth"), empty.alias("best"))
    most_cells, start = max(len(b[0]) for b in balls.value.values()), 0
    for i, end in enumerate(rounds):
        if start >= most_cells:
            break
        asking = queries.join(state.select("node", "kth"), "node")
        schema = "node long, length int, v array<double>, kth double, cell int"
        asking = asking.select("node", "length", "v", "kth").mapInArrow(_asks(balls, start, end), schema)
        asking = space.keep(asking, f"{name}_asking_{i}")
        start = end
        counts = asking.groupBy("length", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("blocks"))
        if not (counts := counts.collect()):
            continue
        counts = F.broadcast(spark.createDataFrame(counts, "length int, cell int, blocks int"))
        block = F.pmod(F.col("node"), F.col("blocks")).cast("int").alias("block")
        key = ["length", "cell", "piece", "block"]
        asked = asking.join(counts, ["length", "cell"]).join(pieces, ["length", "cell"]).select(
            "length", "cell", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), block, "node", "v", "kth"
        )
        searched = held.join(counts, ["length", "cell"]).select(
            "length", "cell", "piece", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "v", "ids"
        )
        pairs = asked.groupBy(*key).cogroup(searched.groupBy(*key))
        found = pairs.applyInArrow(_search_shard(top, leaf_rows), "node long, score long, vec_id long")
        before = state.select("node", F.inline("best"))
        both = before.unionAll(found)
        best = Window.partitionBy("node").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
        both = both.withColumn("i", F.row_number().over(best)).where(F.col("i") <= top)
        answers = F.transform(F.array_sort(F.collect_list(F.struct("i", "score", "vec_id"))), lambda s: F.struct(s.score, s.vec_id))
        both = both.groupBy("node").agg(answers.alias("best"))
        full = F.when(F.size("best") >= top, F.element_at("best", -1)["score"].cast("double"))
        state = space.keep(both.select("node", F.coalesce(full, F.lit(-infinite)).alias("kth"), "best"), f"{name}_best_{i}")

    answers = nodes.where("asked").select("node", "h", "v").join(state, "node").select("h", "v", "best")
    own = F.aggregate(F.transform("v", lambda c: c.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"), lambda s, c: (s + c * c).cast("decimal(38,0)"))
    found = rows.where(asks).join(answers.withColumn("own", own.cast("long")), ["h", "v"])
    # One row that is like the query's own, or the last, makes way.
    place = F.array_position("best", F.struct(F.col("own").alias("score"), F.col("vec_id")))
    place = F.when(place > 0, place).otherwise(F.lit(top)).cast("int")
    others = F.concat(F.slice("best", F.lit(1), place - 1), F.slice("best", place + 1, F.lit(top)))
    found = found.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("at", "other"))
    return found.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "other.vec_id", "other.score")
