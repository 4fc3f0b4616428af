"""Groups of linked nodes, and links found through shared keys, both as joins over stored tables.

Nothing here is collected: links, labels and members stay DataFrames, every round is written to the shared folder,
so a lost executor costs the tasks it ran and no more.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.workspace import Workspace

#: Rounds of :func:`components`; a star takes one, a chain of n nodes about log2(n).
MAX_ROUNDS = 60
#: Members of a key in different groups that are paired with each other. Telling them apart by further keys costs rows, about
#: half the square of the keys that a node shares; the cheap test of a pair costs far less than a row.
HOT_MEMBERS = 1_500
#: Pairs for each node from which on some are verified before the rest, and rounds of verifying, the last of which takes all.
DENSE, TURNS = 3, 3
#: A key of more members that are still apart, a quarter of which are in some group, pairs them with a member by hash first, so often
#: at most, and no further if a turn brings fewer than a tenth of them together.
CROWD, CROWD_TURNS = 50, 3
#: Rows of a bitmap of :func:`only_maybe`, 64 bits each: 8 million bits, a few MB in memory.
BITMAP_WORDS = 1 << 17


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def components(space: Workspace, links: DataFrame, name: str) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the smallest node that links reach.

    Alternates large stars (a node's larger neighbours move to its smallest) and small stars (a node and its smaller
    neighbours move to the smallest of them) until nothing moves. A node of any degree is only ever summed up by
    ``min`` and joined, never gathered.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges = space.keep(edges, f"{name}_0")
    state = _state(edges)
    for i in range(1, MAX_ROUNDS):
        if state[0] == 0:
            break
        both = edges.unionAll(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        smallest = both.groupBy("hi").agg(F.min("lo").alias("m")).select("hi", F.least("hi", "m").alias("m"))
        # Links that come twice here are as many as came in at most; they go at the end of the round.
        large = both.join(smallest, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = F.inline(F.array(F.struct(F.col("hi").alias("n")), F.struct(F.col("lo").alias("n"))))
        small = large.join(smallest, "hi").select("m", moved).where("n <> m")
        edges = space.keep(small.select(F.col("n").alias("hi"), F.col("m").alias("lo")).distinct(), f"{name}_{i}")
        done(space, f"{name}_{i - 1}")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"{name}: groups did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)


def _bitmap(df: DataFrame, column: str, wanted: DataFrame, words: int) -> tuple[DataFrame, Column]:
    """``wanted`` as a bitmap to broadcast, and whether a row of ``df`` meets a set bit of it."""

    def bit(of: DataFrame) -> Column:
        return F.pmod(F.xxhash64(of[column]), F.lit(words * 64))

    one = F.lit(1).cast("long")
    at = bit(wanted)
    word, mask = F.shiftright(at, 6), F.call_function("shiftleft", one, F.pmod(at, F.lit(64)).cast("int"))
    bitmap = wanted.select(word.alias("bitmap_word"), mask.alias("mask")).groupBy("bitmap_word")
    bitmap = F.broadcast(bitmap.agg(F.bit_or("mask").alias("bitmap_bits")))
    at = bit(df)
    mask = F.call_function("shiftleft", one, F.pmod(at, F.lit(64)).cast("int"))
    same = (F.shiftright(at, 6) == F.col("bitmap_word")) & (F.col("bitmap_bits").bitwiseAND(mask) != 0)
    return bitmap, same


def only_maybe(df: DataFrame, column: str, wanted: DataFrame, words: int = BITMAP_WORDS) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among that column of ``wanted``: all that are, and few others.

    ``wanted`` becomes a bitmap of at most ``words`` rows of 64 bits, broadcast whatever the data's size, so that rows
    without a partner need not be shuffled to the join that follows. A very large ``wanted`` fills it and nothing is saved.
    """
    bitmap, same = _bitmap(df, column, wanted, words)
    return df.join(bitmap, same).drop("bitmap_word", "bitmap_bits")


def none_of(df: DataFrame, column: str, unwanted: DataFrame, words: int = BITMAP_WORDS) -> DataFrame:
    """Rows of ``df`` whose ``column`` is not among that column of ``unwanted``; as in :func:`only_maybe`, only rows for which
    that is in doubt are shuffled."""
    bitmap, same = _bitmap(df, column, unwanted, words)
    sure = df.join(bitmap, same, "left_anti")
    # An anti join would be done below the bitmap's join, that is over all rows.
    told = only_maybe(df, column, unwanted, words).join(unwanted.select(column, F.lit(True).alias("unwanted_")), column, "left")
    return sure.unionByName(told.where("unwanted_ IS NULL").drop("unwanted_"))


def done(space: Workspace, *names: str) -> None:
    """Delete kept tables that nothing reads any more."""
    for name in names:
        space.discard("kept", name)


def _pairs(members: DataFrame, nodes: DataFrame, near: Callable[[str, str], Column]) -> DataFrame:
    """``(a, b)`` with ``a < b``: members of one key in different groups that the cheap test does not refuse."""
    held = members.select("key", "node", "component").join(nodes, "node")
    x, y = held.alias("x"), held.alias("y")
    apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & apart & near("x", "y"))
    return met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def _open(members: DataFrame) -> DataFrame:
    """Members of keys that are in more than one group, with the members of the key as ``n``, and whether the key is ``crowded``."""
    sizes = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("component").alias("least"),
        F.max("component").alias("most"),
        F.sum((F.col("node") != F.col("component")).cast("int")).alias("grouped"),
    )
    crowded = (F.col("n") > CROWD) & (F.col("grouped") * 4 >= F.col("n"))
    return members.join(sizes.where("least <> most").select("key", "n", crowded.alias("crowded")), "key")


def _centred(crowd: DataFrame, turn: int) -> DataFrame:
    """``(a, b)`` of members of a key and one of them, another one each turn, that is in another group."""
    chosen = F.min_by(F.struct("node", "component"), F.xxhash64(F.lit(turn), "key", "node"))
    met = crowd.join(crowd.groupBy("key").agg(chosen.alias("centre")), "key").where("component <> centre.component")
    return met.select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b")).distinct()


def link_by_keys(
    space: Workspace,
    keys: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    name: str,
    nodes: DataFrame,
    near: Callable[[str, str], Column],
    hot_members: int = HOT_MEMBERS,
    spent: Sequence[str] = (),
) -> DataFrame:
    """``(node, component)`` over all true links between nodes that share a key; nodes without a link may be missing.

    ``keys`` has ``(key, node)``. ``verify`` takes pairs ``(a, b)`` and returns the linked ones. ``nodes`` has what
    the cheap test ``near`` needs, which compares two aliases and may only refuse pairs that ``verify`` would refuse.

    Every shared key first pairs its members with one of them, the member that shares most keys in all: a pair per
    member. Groups follow from those links. Only members of one key that are still in different groups are then
    paired with each other, so that no link that could join two groups is missed, and a group of copies never
    yields all its pairs. Keys with many members of which some are in groups by then pair the members that are not with another
    one of them first, since these may well be like it, and again with a third one. Where many of those pairs are left for each node, a few of each node's are verified first, and pairs
    whose nodes are in one group by then are not verified any more.

    A key that still has more than ``hot_members`` such members does not pair them. ``keys`` may say more: ``part``, by
    which a node's keys are in the same order as any other node's, and ``sure``, a number of keys that a node shares at least
    with each node that it links to and that has no smaller one. The members are then told apart by a further key,
    of a later part, and again by a third one, until keys are shared by few. Only nodes whose ``sure`` is too small for that are
    paired with each other where they are. ``spent`` names kept tables that nothing but ``keys`` reads; they go when it was read.
    """
    for column, unknown in (("part", 0), ("sure", 1)):
        if column not in keys.columns:
            keys = keys.withColumn(column, F.lit(unknown))
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = space.keep(counts, f"{name}_counts")
    space.release()
    shared = space.keep(only_maybe(keys, "key", counts).join(counts, "key"), f"{name}_shared")
    done(space, f"{name}_counts", *spent)
    space.release()
    central = shared.groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = shared.join(central, "node").select("key", "node", "weight")
    centre = weighed.groupBy("key").agg(F.max(F.struct("weight", -F.col("node"))).alias("top"))
    centre = centre.select("key", (-F.col("top").col2).alias("centre"))
    pairs = (
        shared.join(centre, "key")
        .where("node <> centre")
        .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
        .distinct()
    )
    tried = space.keep(pairs, f"{name}_tried")
    space.release()
    links = space.keep(verify(tried), f"{name}_links")
    groups = components(space, links, f"{name}_star")

    label = F.coalesce("component", "node").alias("component")
    labelled = shared.join(groups, "node", "left").select("key", "node", "part", "sure", label)
    members = space.keep(_open(labelled), f"{name}_open_1")
    space.release()
    crowds, apart = [], None
    for turn in range(1, CROWD_TURNS + 1):
        crowd = members.where("crowded")
        apart, before = crowd.count(), apart
        if apart == 0 or before is not None and apart * 10 > before * 9:
            break
        crowds.append(space.keep(_centred(crowd, turn), f"{name}_crowd_{turn}"))
        spans = groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        every = space.keep(spans.unionAll(verify(crowds[-1])), f"{name}_crowd_all_{turn}")
        groups = components(space, every, f"{name}_crowd_star_{turn}")
        told = crowd.select("key", "node", "part", "sure").join(groups, "node", "left").select("key", "node", "part", "sure", label)
        told = space.keep(_open(told), f"{name}_crowd_open_{turn}")
        members = members.where("NOT crowded").unionByName(told)
        done(space, f"{name}_crowd_all_{turn}")
        space.release()
    depth, found = 1, []
    while not members.isEmpty():
        hot = F.col("n") > hot_members
        met = _pairs(members.where(~hot), nodes, near)
        # Who need not share a further key is compared here; the others meet in one.
        unsure = members.where(hot & (F.col("sure") <= depth)).drop("n", "crowded")
        met = met.unionAll(_pairs(_open(unsure), nodes, near))
        found.append(space.keep(met.distinct(), f"{name}_met_{depth}"))
        more = shared.select("node", F.col("key").alias("more"), F.col("part").alias("later"))
        further = members.where(hot).join(more, "node").where("later > part")
        further = further.select(F.xxhash64("key", "more").alias("key"), "node", F.col("later").alias("part"), "sure", "component")
        depth += 1
        members = space.keep(_open(further), f"{name}_open_{depth}")
        done(space, f"{name}_open_{depth - 1}", *(f"{name}_crowd_open_{i}" for i in range(1, len(crowds) + 1) if depth == 2))
        space.release()
    done(space, f"{name}_shared", f"{name}_open_{depth}")
    spent = [f"{name}_tried", *(f"{name}_crowd_{i}" for i in range(1, len(crowds) + 1))]
    if not found:
        done(space, f"{name}_links", *spent)
        return groups
    tried = reduce(DataFrame.unionAll, crowds, tried)
    rest = reduce(DataFrame.unionAll, found).distinct().join(tried, ["a", "b"], "left_anti")
    rest = space.keep(rest, f"{name}_rest")
    done(space, *spent, *(f"{name}_met_{i}" for i in range(1, depth)))
    spans = groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    spans = space.keep(spans, f"{name}_spans_0")
    done(space, f"{name}_links")
    stars = [f"{name}_star", *(f"{name}_crowd_star_{i}" for i in range(1, len(crowds) + 1))]
    done(space, *(f"{star}_{i}" for star in stars for i in range(MAX_ROUNDS)))
    for turn in range(1, TURNS + 1):
        some = rest if turn == TURNS else _some(rest, turn)
        last = some is rest
        if not last:
            some = space.keep(some, f"{name}_some_{turn}")
        # Nodes of a group and its smallest member say as much as the links that made it.
        every = space.keep(spans.unionAll(verify(some)), f"{name}_all_{turn}")
        groups = components(space, every, f"{name}_full_{turn}")
        done(space, f"{name}_all_{turn}", f"{name}_spans_{turn - 1}")
        if last:
            break
        spans = groups.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
        spans = space.keep(spans, f"{name}_spans_{turn}")
        done(space, *(f"{name}_full_{turn}_{i}" for i in range(MAX_ROUNDS)))
        left = space.keep(_apart(rest, spans).join(some, ["a", "b"], "left_anti"), f"{name}_rest_{turn}")
        done(space, f"{name}_some_{turn}", f"{name}_rest" if turn == 1 else f"{name}_rest_{turn - 1}")
        rest = left
    done(space, f"{name}_rest", *(f"{name}_rest_{i}" for i in range(1, TURNS)))
    return groups


def _some(pairs: DataFrame, turn: int) -> DataFrame:
    """A pair of each node by hash, as its smaller and as its larger one; ``pairs`` itself if it has few for each node."""
    one = pairs.select("a", "b", F.xxhash64(F.lit(turn), "a", "b").alias("h"))
    n, a, b = pairs.agg(F.count(F.lit(1)), F.approx_count_distinct("a"), F.approx_count_distinct("b")).first()
    if n <= DENSE * (a + b):
        return pairs
    firsts = one.groupBy("a").agg(F.min_by("b", "h").alias("b"))
    seconds = one.groupBy("b").agg(F.min_by("a", "h").alias("a")).select("a", "b")
    return firsts.unionAll(seconds).distinct()


def _apart(pairs: DataFrame, spans: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different groups by ``spans``, each node's ``a`` and its group's smallest ``b``."""
    one = spans.select(F.col("a"), F.col("b").alias("of_a"))
    two = spans.select(F.col("a").alias("b"), F.col("b").alias("of_b"))
    told = pairs.join(one, "a", "left").join(two, "b", "left")
    return told.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
