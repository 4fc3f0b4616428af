"""Near-copies of vectors by spherical-cap filters with structured random product codes.

Vectors are turned by one random rotation, so that no direction of the table's own matters to what follows; their cosines
are taken without it. The vector's components are cut into blocks, and each block has a small book of random unit directions. A filter is a
choice of one direction per block; a vector passes all filters whose direction it exceeds by a threshold, which is lowered
for each vector in equal steps until it passes enough. Passing filters
are decoded from the blocks' sorted scores without looking at the others, so there can be very many filters. Similar
vectors pass many filters together; vectors that share one meet there and are compared exactly.

Filters are compared in tiles: those with one direction of the first block and some of the last. A vector goes to a tile
once, whatever the number of its filters there. A pair is counted only in the first tile in which it meets, so links are
counted without ever listing pairs, and each tile hands on one link per vector, enough for the groups. Tiles that very
many vectors come to are cut into blocks of rows; a block is compared with every other, and none holds more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.text import narrow
from ledgerline.workspace import Workspace

SIMILARITY = 0.9
#: How many unrelated vectors pass a filter, and how many rows a tile is to have.
STRANGERS, TILE_ROWS = 32, 2_000
#: Rows of one tile that are compared with as many others at a time; larger tiles are cut.
BLOCK_ROWS = 4_000
SEED = 20_240_817
#: A vector's threshold is lowered by steps until it passes this share of the wanted filters.
STEP, LEAST_SHARE = 0.01, 0.5


@dataclass(frozen=True)
class Code:
    """Books of directions, one per block of components, and the threshold of a filter."""

    books: tuple[np.ndarray, ...]
    threshold: float

    @property
    def last(self) -> int:
        """Directions of the last block; a filter's number is that of its earlier blocks times this, and its last."""
        return len(self.books[-1])

    def filters(
        self, unit: np.ndarray, most: int | None = None, lower: np.ndarray | None = None
    ) -> list[np.ndarray]:
        """The sorted numbers of the filters that each row passes; not all if there are more than ``most``. Thresholds are
        by ``lower`` steps lower."""
        thresholds = np.full(len(unit), self.threshold) if lower is None else self.threshold - STEP * lower
        scores, at = [], 0
        for book in self.books:
            scores.append(unit[:, at : at + book.shape[1]] @ book.T)
            at += book.shape[1]
        best_left = [sum(s.max(axis=1) for s in scores[i + 1 :]) for i in range(len(scores))]
        found = []
        for row in range(len(unit)):
            # Partial sums that the best of the remaining blocks cannot lift to the threshold are dropped.
            sums, numbers = np.zeros(1), np.zeros(1, np.int64)
            for i, s in enumerate(scores):
                order = np.argsort(-s[row])
                ranked = s[row][order]
                need = thresholds[row] - sums - (best_left[i][row] if i + 1 < len(scores) else 0.0)
                counts = np.searchsorted(-ranked, -need, "right")
                if most and counts.sum() > most:
                    counts = np.minimum(counts, np.maximum(0, most - (np.cumsum(counts) - counts)))
                which = np.repeat(np.arange(len(sums)), counts)
                rank = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
                sums = sums[which] + ranked[rank]
                numbers = numbers[which] * len(ranked) + order[rank]
            found.append(np.sort(numbers))
        return found

    def levels(self, unit: np.ndarray, least: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Filters of each row, and the steps by which its threshold is lowered so that there are ``least``."""
        least = min(least, math.prod(map(len, self.books)))
        lower = np.zeros(len(unit), np.int64)
        found = self.filters(unit)
        while len(few := np.flatnonzero(np.fromiter(map(len, found), np.int64, len(found)) < least)):
            lower[few] += 1
            for i, x in zip(few, self.filters(unit[few], lower=lower[few])):
                found[i] = x
        return found, lower

    def passing(self, unit: np.ndarray, prefix: int, start: int, end: int, lower: np.ndarray | int = 0) -> np.ndarray:
        """Whether each row passes the filters with directions ``prefix`` of the earlier blocks and ``start`` to ``end``
        of the last."""
        at, score = unit.shape[1] - self.books[-1].shape[1], np.zeros(len(unit))
        last = unit[:, at:] @ self.books[-1][start:end].T
        for book in reversed(self.books[:-1]):
            prefix, direction = divmod(prefix, len(book))
            at -= book.shape[1]
            score += unit[:, at : at + book.shape[1]] @ book[direction]
        thresholds = self.threshold - STEP * np.broadcast_to(lower, len(unit))
        return score[:, None] + last >= thresholds[:, None]


def wanted_filters(rows: int) -> float:
    """Filters that a vector is to pass: the more selective filters are, the more are needed for the same recall."""
    return max(40.0, 6 * math.log2(max(rows, 2)) - 20)


@dataclass(frozen=True)
class Plan:
    """How vectors of one length are compared: their code, the directions of a tile, and the least filters of a vector."""

    code: Code
    width: int
    least: int
    turn: np.ndarray


def make_plan(dimensions: int, rows: int, code: Code | None = None) -> Plan:
    """Vectors that fit in one tile are all compared, by a code of one filter that all pass."""
    if code is None and rows <= TILE_ROWS // 10:
        code = Code((np.zeros((1, dimensions)),), -1.0)
    code = code or make_code(dimensions, rows)
    firsts = math.prod(len(b) for b in code.books[:-1])
    # So many directions of the last block that random vectors fill a tile about as wanted.
    width = max(1, min(code.last, round(TILE_ROWS * firsts * code.last / (rows * wanted_filters(rows)))))
    return Plan(code, width, math.ceil(LEAST_SHARE * wanted_filters(rows)), rotation(dimensions))


def make_code(dimensions: int, rows: int, seed: int = SEED) -> Code:
    """A code for so many vectors. The share of vectors that pass a filter falls as their number grows, and the number
    of filters rises, so that the strangers that a vector meets in a filter stay as many."""
    share = min(0.02, STRANGERS / max(rows, 1))
    wanted = wanted_filters(rows) / share
    blocks = 1 if dimensions < 4 else 2 if wanted <= 16_000_000 or dimensions < 8 else 3
    size = max(2, round(wanted ** (1 / blocks)))
    random = np.random.default_rng(seed)
    widths = [dimensions // blocks + (i < dimensions % blocks) for i in range(blocks)]
    books = []
    for width in widths:
        book = random.standard_normal((size, width))
        books.append(book / np.linalg.norm(book, axis=1, keepdims=True) * math.sqrt(width / dimensions))
    # The threshold is the one at which random vectors pass the wanted share of filters.
    probe = random.standard_normal((300, dimensions))
    probe /= np.linalg.norm(probe, axis=1, keepdims=True)
    low, high = 0.0, 1.0
    for _ in range(14):
        middle = (low + high) / 2
        most = 4 * wanted_filters(rows) * len(probe)
        passed = 0
        for i in range(0, len(probe), 20):
            passed += sum(map(len, Code(tuple(books), middle).filters(probe[i : i + 20], 100_000)))
            if passed > most:
                break
        low, high = (middle, high) if passed > wanted_filters(rows) * len(probe) else (low, middle)
    return Code(tuple(books), high)


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, upper = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(upper))


def _units(vectors: pd.Series) -> np.ndarray:
    """Vectors of length 1 as rows, scaled first so that no square is lost or too large."""
    rows = np.array(vectors.tolist(), np.float64).reshape(len(vectors), -1)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _assign(plans):
    """Rows ``(node, tiles, lower)``: numbers of the tiles, each some directions of the last block, with filters in them, and
    the steps of the threshold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby("length"):
                plan = plans.value[length]
                last, per = plan.code.last, -(-plan.code.last // plan.width)
                found, lower = plan.code.levels(_units(part["vector"]) @ plan.turn, plan.least)
                tiles = [np.unique(f // last * per + f % last // plan.width) for f in found]
                yield part[["node"]].assign(tiles=tiles, lower=lower)

    return run


def _tiles(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal keys, from batches sorted by them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        pieces = np.split(np.arange(len(batch)), cuts)
        for i, piece in enumerate(pieces):
            part = batch.iloc[piece[0] : piece[-1] + 1]
            if held and (i > 0 or (held[-1][keys].iloc[-1].to_numpy() != values[0]).any()):
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _earlier(lists: list[np.ndarray], number: int) -> np.ndarray:
    """Which pairs of rows share a filter below ``number``."""
    lists = [x[: np.searchsorted(x, number)] for x in lists]
    values, place = np.unique(np.concatenate(lists), return_inverse=True)
    rows = np.repeat(np.arange(len(lists)), np.fromiter(map(len, lists), np.int64, len(lists)))
    # Only filters that more than one row has can be shared.
    common = np.bincount(place, minlength=len(values)) > 1
    keep = common[place]
    column = (np.cumsum(common) - 1)[place[keep]]
    shared = np.zeros((len(lists), len(lists)), bool)
    for at in range(0, int(common.sum()), 4_096):
        part = (column >= at) & (column < at + 4_096)
        table = np.zeros((len(lists), min(4_096, int(common.sum()) - at)), np.float32)
        table[rows[keep][part], column[part] - at] = 1
        shared |= table @ table.T > 0
    return shared


def _compare(plans, similarity: float):
    """Per tile rows ``(node, node, links)`` with the links that meet there first, and the forest of all its links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for tile in _tiles(batches, ["length", "tile", "one", "two"]):
            if len(tile) < 2:
                continue
            plan = plans.value[int(tile["length"].iloc[0])]
            code, width, turn = plan.code, plan.width, plan.turn
            per = -(-code.last // width)
            number, i, j = (int(tile[c].iloc[0]) for c in ("tile", "one", "two"))
            prefix, start = number // per, number % per * width
            unit = _units(tile["vector"])
            turned, lower = unit @ turn, tile["lower"].to_numpy()
            own = tile["block"].to_numpy()
            passing = code.passing(turned, prefix, start, min(start + width, code.last), lower)
            filters, rows = np.nonzero(passing.T)
            near = np.zeros((len(tile), len(tile)), bool)
            for group in np.split(rows, np.flatnonzero(np.diff(filters)) + 1):
                a, b = group[own[group] == i], group[own[group] == j]
                if len(a) and len(b):
                    near[np.ix_(a, b)] |= unit[a] @ unit[b].T >= similarity
            near |= near.T
            np.fill_diagonal(near, False)
            some = np.flatnonzero(near.any(axis=1))
            if not len(some):
                continue
            near, nodes, weights = near[np.ix_(some, some)], tile["node"].to_numpy()[some], tile["weight"].to_numpy()[some]
            # Pairs that share a filter of an earlier tile are counted there.
            links = (near & ~_earlier(code.filters(turned[some], lower=lower[some]), prefix * code.last + start)) @ weights
            yield pd.DataFrame({"node": nodes, "other": nodes, "links": links})
            yield _forest(nodes, near)

    return run


def _forest(nodes: np.ndarray, near: np.ndarray) -> pd.DataFrame:
    """Links that join what all links of a tile join: each node to the smallest it reaches, without counting."""
    order = np.argsort(nodes, kind="stable")
    x, y = np.nonzero(near[np.ix_(order, order)])
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    ends = nodes[order]
    return pd.DataFrame({"node": ends[moved], "other": ends[root[moved]], "links": np.zeros(len(moved), np.int64)})


def vector_groups(
    space: Workspace,
    vectors: DataFrame,
    similarity: float = SIMILARITY,
    id_column: str = "vec_id",
    column: str = "embedding",
    code: Code | None = None,
    name: str = "vectors",
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row.

    Links join vectors with cosine at least ``similarity`` in double precision. Null and zero vectors and those with null
    or non-finite components link with nothing; vectors link with those of their own length. ``code`` is for the commonest
    length (the longer on a tie). Equal vectors are one node, linked with each other; each row counts, also if an id comes
    with several vectors. A null id stays null and names no group. Other columns are ignored. An empty table gives none.
    """
    rows = narrow(vectors, id_column, column).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(column).alias("vector")
    )
    if dict(rows.dtypes)["vector"] not in ("array<float>", "array<double>"):
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    finite = (largest > 0) & (largest < float("inf")) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x))
    fine = F.coalesce(finite, F.lit(False))
    rows = space.keep(rows.select("vec_id", F.when(fine, F.col("vector")).alias("vector")), f"{name}_rows")
    lengths = rows.where("vector IS NOT NULL").groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    lengths = sorted(((r["rows"], r["n"]) for r in lengths.collect()), reverse=True)
    alone = rows.select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    if not lengths:
        return alone
    plans = {n: make_plan(n, count, code if i == 0 else None) for i, (count, n) in enumerate(lengths)}
    plans = vectors.sparkSession.sparkContext.broadcast(plans)
    used = rows.where("vector IS NOT NULL")
    hashes = [F.xxhash64(F.lit(i), "vector").alias(f"v{i}") for i in (1, 2)]
    same = used.select("vec_id", "vector", *hashes).groupBy("v1", "v2")
    # Equal hashes are equal vectors, so any of them stands for all.
    same = same.agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector"))
    same = same.withColumn("length", F.size("vector")).withColumn("node", F.monotonically_increasing_id())
    same = space.keep(same, f"{name}_same")
    nodes = same.select("node", "weight", "length", "vector")

    found = nodes.select("node", "length", "vector").mapInPandas(_assign(plans), "node long, tiles array<long>, lower long")
    listed = space.keep(nodes.join(found, "node"), f"{name}_listed")
    entries = listed.select("node", "length", F.explode("tiles").alias("tile"))
    sizes = entries.groupBy("length", "tile").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pieces = F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
    several = entries.join(sizes, ["length", "tile"]).select("node", "tile", pieces.alias("pieces"))
    block = F.pmod(F.xxhash64("node", "tile"), F.col("pieces")).cast("int")
    others = F.sequence(F.lit(0), F.col("pieces") - 1)
    meets = several.withColumn("block", block).withColumn("other_block", F.explode(others))
    meets = meets.select(
        "node",
        "tile",
        "block",
        F.least("block", "other_block").alias("one"),
        F.greatest("block", "other_block").alias("two"),
    )
    tiles = meets.join(listed.drop("tiles"), "node").repartition("length", "tile", "one", "two")
    tiles = tiles.sortWithinPartitions("length", "tile", "one", "two")
    tiles = tiles.select("length", "tile", "one", "two", "block", "node", "weight", "vector", "lower")
    compared = tiles.mapInPandas(_compare(plans, similarity), "node long, other long, links long")
    counts = space.keep(compared, f"{name}_counts")

    links = counts.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(space, counts.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")), name)
    known = same.drop("vector").join(links, "node", "left").join(groups, "node", "left")
    known = known.withColumn("group", F.coalesce("component", "node"))
    # A group is named by its smallest id.
    names = known.groupBy("group").agg(F.min("first").alias("named"))
    known = known.join(names, "group").select("v1", "v2", "weight", "links", "named")
    with_keys = rows.select("vec_id", *(F.when(F.col("vector").isNotNull(), h).alias(f"v{i}") for i, h in zip((1, 2), hashes)))
    found = with_keys.join(known, ["v1", "v2"], "left")
    n = F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))
    group = F.coalesce("named", "vec_id")
    return found.select(
        "vec_id",
        n.cast("long").alias("n_links"),
        group.alias("component_id"),
        F.coalesce(F.col("vec_id") == group, F.lit(True)).alias("kept"),
    )
