"""Collocations from sorted count streams: left, right and extension counts by merging them in lockstep.

Counting goes up by length. A phrase that comes ``min_count`` times has parts that do, so pairs are counted only where
both words may be frequent, and triples only where both pairs may; a bitmap of fixed size says where. It lets some rare
phrases through, which their exact counts then drop, and never a frequent one away.

Counts of one, two and three words then make one stream, kept in prefix order (first word, second, third) and once more in
suffix order (last word, the one before, the first). In either order a phrase follows the shorter phrases that its counts
are wanted of, so one walk over a sorted partition carries them along; nothing is looked up or hashed. The stream is cut by
ranges of the first two words in the order, so a word before very many others is split over partitions. What a
partition needs of the ones before it is one number, the count of the word that it begins within.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.llm.text import narrow
from ledgerline.workspace import Workspace

#: Phrases that come less often are no candidates.
MIN_COUNT = 10
#: A candidate goes if a longer one around it has so many hundredths of its count.
COVERED_PERCENT = 50
#: Phrases returned for each language.
TOP = 2_000
#: Words of 64 bits of the bitmap that tells which phrases may be frequent: 4 MB, whatever the corpus.
BITMAP_WORDS = 1 << 19
#: Words that a task counts together, and distinct ones among them, before it hands its counts on.
RUN_WORDS, RUN_DISTINCT = 600_000, 120_000
#: Documents that are taken from a batch together, bytes of text that are split together, and rows of counts in a batch.
DOCUMENTS, SLICE_BYTES, BATCH_ROWS = 500, 1_000_000, 1 << 15
#: Language of documents that name none.
NO_LANG = "und"

_BREAK = b"."
#: Letters A-Z lower-cased, every separator a full stop, tabs spaces.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + _BREAK * 9 + b" ")

_COUNTS = "lang string, w1 string, w2 string, w3 string, f long"


class _Numbers(dict):
    """Numbers words in the order in which they come; the break between pieces is 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(first) + second)


def _marked(hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether the bitmap has each hash."""
    place = hashes % np.uint64(len(bitmap) * 64)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


class _Run:
    """The words of one language that are counted together."""

    def __init__(self, lang: str):
        self.lang, self.numbers, self.parts, self.size = lang, _Numbers({_BREAK: 0}), [], 0

    def add(self, text: bytes) -> None:
        words = text.translate(_PLAIN).replace(_BREAK, b" . ").split(b" ")
        # Empty strings between spaces are no words; filter() is quicker than split() is with other white space.
        ids = np.fromiter(map(self.numbers.__getitem__, filter(None, words)), np.int32)
        self.parts += [ids, np.zeros(1, np.int32)]
        self.size += len(ids) + 1

    def counts(self, n: int, bitmap: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        ids, words = np.concatenate(self.parts or [np.zeros(1, np.int32)]).astype(np.int64), list(self.numbers)
        self.parts = []
        if n == 1:
            f = np.bincount(ids, minlength=len(words))
            f[0] = 0
            found = [np.flatnonzero(f)]
            f = f[found[0]]
        else:
            hashes = _word_hashes(self.lang, words)
            if n == 2:
                ids = np.where(_marked(hashes, bitmap)[ids], ids, 0)
            at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            pairs, which, f = np.unique(ids[at] * len(words) + ids[at + 1], return_inverse=True, return_counts=True)
            found = [pairs // len(words), pairs % len(words)]
            if n == 3:
                fine = _marked(_pair_hashes(hashes[found[0]], hashes[found[1]]), bitmap)[which]
                at, which = at[fine], which[fine]
                next_to = np.flatnonzero(np.diff(at) == 1)
                triples, f = np.unique(which[next_to] * len(words) + ids[at[next_to] + 2], return_counts=True)
                pair = triples // len(words)
                found = [found[0][pair], found[1][pair], triples % len(words)]
        texts = pa.array([w.decode("utf-8", "surrogatepass") for w in words])
        for start in range(0, len(f), BATCH_ROWS):
            some = slice(start, start + BATCH_ROWS)
            size = len(f[some])
            columns = [texts.take(pa.array(x[some])) for x in found] + [pa.nulls(size, pa.string())] * (3 - n)
            lang = pa.repeat(pa.scalar(self.lang), size)
            yield pa.RecordBatch.from_arrays([lang, *columns, pa.array(f[some])], ["lang", "w1", "w2", "w3", "f"])


def _slices(texts: list[bytes]) -> Iterator[bytes]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= SLICE_BYTES:
            yield _BREAK.join(held)
            held, size = [], 0
    yield _BREAK.join(held)


def _count(n: int, bitmap=None):
    """Each task's counts of phrases of ``n`` words, in runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = None if bitmap is None else bitmap.value
        runs: dict[str, _Run] = {}
        for batch in (b.slice(at, DOCUMENTS) for b in batches for at in range(0, b.num_rows, DOCUMENTS)):
            langs, texts = batch.column("lang"), batch.column("text").cast(pa.large_binary())
            for lang in pc.unique(langs).to_pylist():
                own = runs.setdefault(lang, _Run(lang))
                for text in _slices(texts.filter(pc.equal(langs, lang)).to_pylist()):
                    own.add(text)
                    if own.size >= RUN_WORDS or len(own.numbers) >= RUN_DISTINCT:
                        yield from own.counts(n, marks)
                        own = runs[lang] = _Run(lang)
            # Very many languages: together they hold no more than two runs.
            if sum(r.size for r in runs.values()) >= 2 * RUN_WORDS:
                for own in runs.values():
                    yield from own.counts(n, marks)
                runs = {}
        for own in runs.values():
            yield from own.counts(n, marks)

    return run


def _bits(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(words, np.uint64)
        for batch in batches:
            langs = batch.column("lang")
            for lang in pc.unique(langs).to_pylist():
                own = batch.filter(pc.equal(langs, lang))
                first, second = (own.column(c).cast(pa.binary()).to_pylist() for c in ("w1", "w2"))
                hashes = _word_hashes(lang, first)
                if second[0] is not None:
                    hashes = _pair_hashes(hashes, _word_hashes(lang, second))
                place = hashes % np.uint64(words * 64)
                np.bitwise_or.at(bitmap, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        some = np.flatnonzero(bitmap)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(bitmap[some].view(np.int64))], ["place", "bits"])

    return run


def _bitmap(frequent: DataFrame, words: int):
    """The bitmap of all phrases in ``frequent``, broadcast: ``words`` long, however many there are."""
    rows = frequent.select("lang", "w1", "w2").mapInArrow(_bits(words), "place long, bits long")
    table = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(words, np.uint64)
    bitmap[table.column("place").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(bitmap)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sorted partition: beside each phrase the counts of its first word and of its first two, and whether a longer
    phrase that begins with it covers it. ``one`` is null before the partition's first word."""
    one, two, held = None, None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        f = batch.column("f").to_numpy()
        single = batch.column("k2").is_null().to_numpy(zero_copy_only=False)
        triple = batch.column("k3").is_valid().to_numpy(zero_copy_only=False)
        number = np.arange(n)
        last_one = np.maximum.accumulate(np.where(single, number, -1))
        last_two = np.maximum.accumulate(np.where(~single & ~triple, number, -1))
        ones, known = np.where(last_one >= 0, f[last_one], one or 0), (last_one >= 0) | (one is not None)
        twos = np.where(last_two >= 0, f[last_two], two or 0)
        covers = triple & (100 * f >= COVERED_PERCENT * twos)
        covered = np.zeros(n, bool)
        covered[last_two[covers & (last_two >= 0)]] = True
        if held is not None and (covers & (last_two < 0)).any():
            held = held.set_column(held.schema.get_field_index("covered"), "covered", pa.array([True]))
        out = batch.append_column("one", pa.array(ones, mask=~known))
        out = out.append_column("two", pa.array(twos, mask=~triple)).append_column("covered", pa.array(covered))
        if last_two[-1] < 0:
            yield out
        else:
            # The last pair waits until all that begins with it has come by.
            if held is not None:
                yield held
            end = last_two[-1]
            held = out.slice(end, 1)
            yield out.slice(0, end)
            yield out.slice(end + 1)
            two = int(f[end])
        if last_one[-1] >= 0:
            one = int(f[last_one[-1]])
    if held is not None:
        yield held


def lockstep(space: Workspace, stream: DataFrame, name: str) -> DataFrame:
    """``stream(lang, k1, k2, k3, f, ...)`` with ``one``, the count of ``k1``; ``two``, that of ``k1 k2`` (triples only);
    and ``covered``, whether some ``k1 k2 x`` has ``COVERED_PERCENT`` hundredths of the pair's own count.

    Every phrase needs its first word and first two in the stream. Rows go to ranges of ``(lang, k1, k2)``, a
    partition each. Where one begins within a word, the word's count is that of the last word of the partitions before:
    a row for every partition is all that is compared between them."""
    parts = int(space.spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["lang", "k1", F.col("k2").asc_nulls_first()]
    ranged = stream.repartitionByRange(parts, *order).sortWithinPartitions(*order, F.col("k3").asc_nulls_first())
    ranged = ranged.withColumn("part", F.spark_partition_id())
    found = [("one", T.LongType()), ("two", T.LongType()), ("covered", T.BooleanType())]
    schema = T.StructType([*ranged.schema.fields, *(T.StructField(c, kind) for c, kind in found)])
    walked = space.keep(ranged.mapInArrow(_walk, schema), f"{name}_walked")
    heads = walked.where("k2 IS NULL").groupBy("part").agg(F.max(F.struct("lang", "k1", "f")).alias("head")).collect()
    carried, last = [], None
    heads = {r["part"]: r["head"]["f"] for r in heads}
    for part in range(parts):
        if last is not None:
            carried.append((part, last))
        last = heads.get(part, last)
    carried = space.spark.createDataFrame(carried, "part int, carried long")
    joined = walked.join(F.broadcast(carried), "part", "left")
    return joined.withColumn("one", F.coalesce("one", "carried")).drop("part", "carried")


def score_of(count: str, left: str | Column, right: str | Column) -> Column:
    """``floor(1000000 a a / (l r))`` by whole numbers of up to 38 digits, for counts up to 10**16."""
    a, left, right = ((F.col(c) if isinstance(c, str) else c).cast("decimal(16,0)") for c in (count, left, right))
    million = F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", (million * (a * a)).cast("decimal(38,0)"), (left * right).cast("decimal(38,0)"))


def collocations(
    space: Workspace,
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    bitmap_words: int = BITMAP_WORDS,
    name: str = "phrases",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's best phrases of two and three words.

    ``docs`` needs ``text`` and ``lang``; other columns are ignored. Texts are read whole: A-Z lower-cased, cut at
    ``[.,;:!?]`` and line ends into pieces and those at spaces and tabs into words. A null text is empty, a null language
    is ``und``, and documents that name ``und`` are of it, too. Rows that repeat count as often as they come. ``a`` is the
    phrase's count; ``l`` and ``r`` those of its halves at the cut with the lowest ``1000000 a a / (l r)``, the earlier on
    a tie; ``n`` all words of the language. A pair is left out if a triple around it has half its count. Languages
    without a candidate, and an empty table, give no row.
    """
    own = narrow(docs, "lang", "text").select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    words = ["w1", "w2", "w3"]

    def counted(n: int, bitmap=None) -> DataFrame:
        return own.mapInArrow(_count(n, bitmap), _COUNTS).groupBy("lang", *words).agg(F.sum("f").alias("f"))

    ones = space.keep(counted(1), f"{name}_1")
    sizes = ones.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = F.col("f") >= min_count
    stream = ones.where(frequent)
    for n in (2, 3):
        shorter = stream.where(F.col(words[n - 2]).isNotNull())
        marked = _bitmap(shorter, bitmap_words)
        stream = stream.unionAll(space.keep(counted(n, marked).where(frequent), f"{name}_{n}"))
        marked.unpersist()

    forward = stream.select("lang", F.col("w1").alias("k1"), F.col("w2").alias("k2"), F.col("w3").alias("k3"), "f")
    forward = lockstep(space, forward, f"{name}_prefix")
    # The same rows, read from their last word; what the first walk found comes along.
    third = F.col("k3").isNotNull()
    backward = forward.select(
        "lang",
        F.coalesce("k3", "k2", "k1").alias("k1"),
        F.when(third, F.col("k2")).when(F.col("k2").isNotNull(), F.col("k1")).alias("k2"),
        F.when(third, F.col("k1")).alias("k3"),
        "f",
        F.col("one").alias("first"),
        F.col("two").alias("first_two"),
        F.col("covered").alias("covered_before"),
    )
    backward = lockstep(space, backward, f"{name}_suffix")

    long = F.col("k2").isNotNull() & ~F.col("covered") & ~F.col("covered_before")
    phrases = backward.where(long).select(
        "lang", F.concat_ws(" ", "k3", "k2", "k1").alias("phrase"), F.col("f").alias("a"), "first", "first_two", "one", "two"
    )

    def cut(k: int, left: Column, right: Column) -> Column:
        return F.struct(score_of("a", left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    first, second = cut(1, F.col("first"), F.coalesce("two", "one")), cut(2, F.col("first_two"), F.col("one"))
    lowest = F.when(F.col("first_two").isNull(), first).otherwise(F.least(first, second))
    phrases = phrases.select("lang", "phrase", "a", lowest.alias("cut")).select("lang", "phrase", "a", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
