"""Near-copies by Jaccard similarity of word n-grams, joined on PartEnum signatures.

Sets whose Jaccard similarity is at least g differ in at most (a + b) (1 - g) / (1 + g) elements. Sizes are cut into
bands of ratio 1 / g, so similar sets lie in one band or in two adjacent ones; each pair of adjacent bands is a group
with one bound k on the difference. A group deals its elements into k + 1 + spare parts by hash. At most k parts can
differ, so similar sets agree in ``spare + 1`` parts at least, and share a signature for every subset of so many parts or
fewer. Subsets of one part are enumerated for all sets. Where many sets share one and are not linked, as with a popular
passage, subsets of two parts that begin with it are enumerated for those sets, then of three, and so on
(:func:`ledgerline.llm.components.link_by_keys`): large signatures are paid for only where small ones do not tell sets apart.
Signatures of empty parts would be shared by unrelated sets; they are left out unless a set has more than ``spare`` empty
parts, so that one signature of the shared ones is always there. No link is missed, and every candidate is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import done, link_by_keys, only_maybe
from ledgerline.llm.text import narrow
from ledgerline.workspace import Workspace

WORDS = 4
#: Similarity in hundredths.
PERCENT = 85
#: Words of 64 bits of the smallest sketch that refuses candidates without their texts, and bits of a sketch for each
#: element in which a set and its like may differ.
SKETCH_WORDS, SKETCH_BITS = 4, 4
#: Spare parts at least, and parts for one more: as many parts again may make a signature.
SPARE, SPARE_EVERY = 2, 32
#: Texts are worked on in runs of about so many bytes.
RUN_BYTES = 2_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit integers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES)
#: A random number for each byte, letters A-Z like a-z; white space is told by its zero.
_VALUES = np.where((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)), 0, _mix(_LOWER.astype(np.uint64) + np.uint64(977)))
_VALUES = _VALUES.astype(np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = np.array([0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words before each text and after the last."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    values = _VALUES[data]
    inside = values != 0
    place = np.flatnonzero(inside)
    if not len(place):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-2) > 1)
    lengths = np.diff(first, append=len(place))
    powers = np.cumprod(np.full(int(lengths.max()), _STEP), dtype=np.uint64)
    hashed = np.add.reduceat(values[place] * powers[np.arange(len(place)) - np.repeat(first, lengths)], first)
    return _mix(hashed), np.concatenate([[0], np.searchsorted(place[first], ends)])


def shingle_sets(texts: list[str | None], n_words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct n-grams as sorted 64-bit hashes, one text after the other, and where each starts.

    Letters A-Z are lower-cased; a text of fewer words is one n-gram."""
    words, at = _word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    long = np.full(max(0, len(words) - n_words + 1), n_words, np.uint64)
    for i in range(n_words):
        # Mixing after each word keeps n-grams apart that have the same words in another order.
        long = _mix(long + words[i : i + len(long)] * _MULTIPLIERS[i % 4])
    sets = []
    for start, end in zip(at[:-1], at[1:]):
        if end - start >= n_words:
            sets.append(np.unique(long[start : end - n_words + 1]))
        else:
            short = np.full(min(1, end - start), end - start, np.uint64)
            for i in range(end - start):
                short = _mix(short + words[start + i : start + i + 1] * _MULTIPLIERS[i % 4])
            sets.append(short)
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, sets), np.int64, len(sets)))])
    return np.concatenate([np.empty(0, np.uint64), *sets]), starts


class Bands:
    """Size bands, and how many parts the group of two adjacent bands deals its elements into."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.starts = [1]

    def reach(self, size: int) -> np.ndarray:
        """First sizes of the bands, until one is above ``size`` and two more."""
        while len(self.starts) < 4 or self.starts[-3] <= size:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        return np.array(self.starts)

    def parts(self, group: int) -> tuple[int, int]:
        """Parts and spare parts of the group that joins band ``group - 1`` with itself and with band ``group``."""
        small = self.starts[group] - 1
        large = min(self.starts[group + 1] - 1, small * 100 // self.percent)
        k = (small + large) * (100 - self.percent) // (100 + self.percent)
        spare = SPARE + (k + 1) // SPARE_EVERY
        return k + 1 + spare, spare


def signatures(elements: np.ndarray, starts: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of each set in the two groups its size belongs to, by group and part; the index of its set; and for each set
    how many of them it shares at least with any like it."""
    sizes = np.diff(starts)
    owners = np.flatnonzero(sizes)
    sure = np.full(len(sizes), 127, np.int64)
    if not len(owners):
        return np.empty(0, np.uint64), np.empty(0, np.int64), sure
    band = np.searchsorted(bands.reach(int(sizes.max())), sizes[owners], "right") - 1
    place = _mix(elements ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)
    halves = (elements & np.uint64(0xFFFFFFFF)).astype(np.float64), (elements >> np.uint64(32)).astype(np.float64)
    keys, sets = [], []
    for group in (band, band + 1):
        shape = np.array([bands.parts(g) if g else (1, 0) for g in range(int(group.max()) + 1)])
        parts, spare = shape[group].T
        slots = np.concatenate([[0], np.cumsum(parts)])
        part = (place * np.repeat(parts.astype(np.uint64), sizes[owners])) >> np.uint64(32)
        slot = part.astype(np.int64) + np.repeat(slots[:-1], sizes[owners])
        # Sums of 32-bit halves stay exact in a double for up to 2**21 elements of one part.
        low, high = (np.bincount(slot, half, slots[-1]).astype(np.uint64) for half in halves)
        full = np.bincount(slot, minlength=slots[-1]) > 0
        empty = parts - np.add.reduceat(full.astype(np.int64), slots[:-1])
        agree = np.where(empty > spare, 1, spare + 1 - empty)
        sure[owners] = np.where(group > 0, np.minimum(sure[owners], agree), sure[owners])
        chosen = (full | np.repeat(empty > spare, parts)) & np.repeat(group > 0, parts)
        number = (np.arange(slots[-1]) - np.repeat(slots[:-1], parts)).astype(np.uint64)
        salt = _mix((np.repeat(group, parts).astype(np.uint64) << np.uint64(40)) + number)
        keys.append(_mix(_mix(low ^ _mix(high)) + salt)[chosen])
        sets.append(np.repeat(owners, parts)[chosen])
    keys, sets = np.concatenate(keys), np.concatenate(sets)
    order = np.argsort(sets, kind="stable")
    return keys[order], sets[order], sure


def sketches(elements: np.ndarray, starts: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """For each set the parities of its elements by hash, as 64-bit words, one set after the other, and where each starts.

    Two sketches of one length differ in no more bits than their sets in elements. Lengths are powers of two that grow with
    the set; the halves of a sketch, one xor the other, are the sketch of half its length."""
    sizes = np.diff(starts)
    differ = sizes * (2 * (100 - percent)) // (100 + percent) + 1
    words = np.maximum(SKETCH_WORDS, 2 ** np.ceil(np.log2(np.maximum(1, differ * SKETCH_BITS / 64))).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(words)])
    place = _mix(elements + np.uint64(0xE7037ED1A0B428DB)) & np.repeat((words * 64 - 1).astype(np.uint64), sizes)
    odd = np.bincount(place.astype(np.int64) + np.repeat(at[:-1] * 64, sizes), minlength=at[-1] * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64), at


def small_sketches(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sketches folded to the smallest length, a row for each set."""
    n = len(at) - 1
    folded = np.zeros((n, SKETCH_WORDS), np.int64)
    words = np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))
    np.bitwise_xor.at(folded, (np.repeat(np.arange(n), np.diff(at)), words % SKETCH_WORDS), bits)
    return folded


def sketch_differs(one: Column, two: Column) -> Column:
    """In how many bits two sketches differ, the longer one folded to the length of the other. Lengths of similar sets differ
    by a factor of two at most; others are told apart by their sizes."""

    def folded(x: Column, other: Column) -> Column:
        half = F.floor(F.size(x) / 2).cast("int")
        both = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(x) > F.size(other), both).otherwise(x)

    bits = F.zip_with(folded(one, two), folded(two, one), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(bits, F.lit(0), lambda s, n: s + F.coalesce(n, F.lit(0)))


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of about ``RUN_BYTES``."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size > RUN_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _sets(n_words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in _runs(texts):
                elements, starts = shingle_sets(texts[a:b], n_words)
                sizes = np.diff(starts)
                sums, xors = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                if len(elements):
                    some = sizes > 0
                    sums[some] = np.add.reduceat(elements, starts[:-1][some])
                    xors[some] = np.bitwise_xor.reduceat(_mix(elements), starts[:-1][some])
                keys, owners, sure = signatures(elements, starts, bands)
                offsets = np.searchsorted(owners, np.arange(b - a + 1)).astype(np.int32)
                bits, words = sketches(elements, starts, percent)
                columns = {
                    "doc_id": batch.column("doc_id").slice(a, b - a),
                    "n_shingles": pa.array(sizes),
                    "s1": _ints(sums),
                    "s2": _ints(xors),
                    **{f"w{i}": pa.array(w) for i, w in enumerate(small_sketches(bits, words).T)},
                    "sketch": pa.ListArray.from_arrays(pa.array(words.astype(np.int32)), pa.array(bits)),
                    "sure": pa.array(sure.astype(np.int32)),
                    "keys": pa.ListArray.from_arrays(pa.array(offsets), _ints(keys)),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _check(n_words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ones, twos = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            linked = []
            for i, j in _runs([(x or "") + (y or "") for x, y in zip(ones, twos)]):
                # Sorted by a, so that a text compared with many others is cut into n-grams once.
                new = [k for k in range(i, j) if k == i or a[k] != a[k - 1] or ones[k] != ones[k - 1]]
                left, at = shingle_sets([ones[k] for k in new], n_words)
                right, bt = shingle_sets(twos[i:j], n_words)
                side = np.searchsorted(new, np.arange(i, j), "right") - 1
                for k in range(i, j):
                    s = left[at[side[k - i]] : at[side[k - i] + 1]]
                    t = right[bt[k - i] : bt[k - i + 1]]
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    if 100 * both >= percent * (len(s) + len(t) - both):
                        linked.append((a[k], b[k]))
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([x for x, _ in linked], pa.int64()), "b": pa.array([y for _, y in linked], pa.int64())}
            )

    return run


def ngram_groups(
    space: Workspace, docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT, name: str = "ngram"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every document: the smallest id that links reach.

    ``docs`` needs ``doc_id`` (an integer) and ``text``; other columns are ignored. Null and empty texts have an empty
    set and no link. Documents with equal sets are linked and share one node, the smallest id. Rows that repeat an id
    are given back as often as they come; a null id gets the group of its set, and never names one. An empty table gives
    none. Texts are read whole.
    """
    docs = narrow(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    small = [f"w{i}" for i in range(SKETCH_WORDS)]
    schema = f"doc_id long, n_shingles long, s1 long, s2 long, {', '.join(f'{w} long' for w in small)}"
    schema += ", sketch array<long>, sure int, keys array<long>"
    sets = space.keep(docs.mapInArrow(_sets(n_words, percent), schema), f"{name}_sets")
    same = ["n_shingles", "s1", "s2"]
    some = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    nodes = some.groupBy(*same).agg(F.min("doc_id").alias("node"))
    members = space.keep(
        sets.select("doc_id", *same).join(nodes, same, "left").select("doc_id", "n_shingles", "node"), f"{name}_members"
    )
    first = members.where("node = doc_id").select("node").distinct()
    # The signatures of one document for each set. Joins of signatures and texts are sort-merge joins at every size.
    once = some.join(first.hint("merge"), some.doc_id == first.node, "left_semi").drop(*same[1:])
    once = space.keep(once.withColumnRenamed("doc_id", "node"), f"{name}_once")
    done(space, f"{name}_sets")
    # A set's signatures are in the order of their parts.
    keys = once.select("node", "sure", F.posexplode("keys").alias("part", "key"))
    shapes = once.select("node", "n_shingles", *small, "sketch")

    def near(x: str, y: str) -> Column:
        one, two = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        most = F.floor((one + two) * (100 - percent) / (100 + percent))
        sizes = F.least(one, two) * 100 >= F.greatest(one, two) * percent
        # The smallest sketches, which are compared within generated code, refuse most pairs of sets that are not large.
        first = reduce(Column.__add__, (F.bit_count(F.col(f"{x}.{w}").bitwiseXOR(F.col(f"{y}.{w}"))) for w in small))
        return sizes & (first <= most) & (sketch_differs(F.col(f"{x}.sketch"), F.col(f"{y}.sketch")) <= most)

    texts = docs.where("doc_id IS NOT NULL")

    def verify(pairs: DataFrame) -> DataFrame:
        one, two = (shapes.select(F.struct("*").alias(x), F.col("node").alias(c)) for x, c in (("x", "a"), ("y", "b")))
        pairs = space.keep(pairs.join(one, "a").join(two, "b").where(near("x", "y")).select("a", "b"), f"{name}_close")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        # Repeated rows would repeat their pairs.
        held = only_maybe(texts, "doc_id", wanted).join(wanted.hint("merge"), "doc_id", "left_semi").distinct()
        one = held.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        two = held.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a")
        return both.mapInArrow(_check(n_words, percent), "a long, b long").distinct()

    groups = link_by_keys(space, keys, verify, name, shapes, near)
    done(space, f"{name}_once", f"{name}_close")
    return members.join(groups, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "node", "doc_id").alias("component_id"),
    )


def keep_first(space: Workspace, docs: DataFrame, n_words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group of near-copies, the one with the smallest id; a null id stays only
    if no document with an id is like it. Rows that repeat a kept id all stay."""
    groups = ngram_groups(space, docs, n_words, percent)
    dropped = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")
