"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

Of two words one edit apart the shorter one gives two disjoint chunks, each half its length; the edit can spoil one of them
only. The other word gives its positional grams of that length. The chunk that is left lies in it at the same place if
the edit comes after, or shifted by the difference of the lengths, one at most, if it comes before; grams at other places meet
no chunk and are not written. A chunk that is left also means that all on its far side is equal, and that what lies on the
side of the edit, its *rest*, is one edit from the other word's rest. So a key that too many words share is cut again: the two
rests give chunks and grams by the same rule, until no key is shared by many or rests are too short to cut.
Every pair that meets is verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import narrow
from ledgerline.workspace import Workspace

#: Letters of a run: ASCII, and Latin-1 from U+00C0 on.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One run of a document in so many loses a letter, chosen by its checksum.
TYPO_EVERY = 199
#: Words of fewer letters or occurrences are not compared.
MIN_LETTERS, MIN_COUNT = 6, 5
#: A word's form has so many times its count at least.
FORM_TIMES = 5
#: A key whose chunks and grams make more pairs is cut again.
KEY_PAIRS = 2_000
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 300_000


def with_typo(doc_id: int | None, run: str) -> str:
    """The lower-cased run, without one of its letters if its document's checksum says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % TYPO_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def handed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(counts, pa.string()), "n": pa.array(counts.values(), pa.int64())})

    total: Counter = Counter()
    for batch in batches:
        for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
            # Bytes lower-case A-Z only.
            runs = Counter(RUN.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
            for run, n in runs.items():
                total[with_typo(doc_id, run)] += n
            if len(total) >= HELD_WORDS:
                yield handed(total)
                total = Counter()
    yield handed(total)


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: the words of all documents that have enough letters and occurrences."""
    counted = narrow(docs, "doc_id", "text").mapInArrow(_count, "word string, n long")
    counted = counted.where(F.length("word") >= min_letters)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _left(text: str, n: Column) -> Column:
    return F.col(text).substr(F.lit(1), n)


def _from(text: str, n: Column) -> Column:
    """All but the first ``n`` letters."""
    return F.col(text).substr(n + 1, F.length(text))


def _chunks(words: DataFrame) -> DataFrame:
    """``(key, word, rest)``: the two chunks of each rest. The second is told with all that follows it."""
    half = F.floor(F.length("rest") / 2).cast("int")
    first, second = _left("rest", half), _from("rest", half)
    return _keyed(words, [(F.length("rest"), F.lit(0), first, second), (F.length("rest"), F.lit(1), second, first)])


def _grams(words: DataFrame) -> DataFrame:
    """``(key, word, rest)``: the grams of each rest that a chunk of a rest as long, or one letter shorter, may equal."""
    keys = []
    for shift in (0, 1):
        size = F.length("rest") - shift
        half = F.floor(size / 2).cast("int")
        keys.append((size, F.lit(0), _left("rest", half), _from("rest", half)))
        keys.append((size, F.lit(1), _from("rest", half + shift), _left("rest", half + shift)))
    return _keyed(words, keys)


def _keyed(words: DataFrame, keys: list[tuple[Column, Column, Column, Column]]) -> DataFrame:
    # The key before and the place keep apart what is equal by chance; verification does the rest.
    structs = [
        F.struct(F.xxhash64("key", size, side, chunk).alias("key"), "word", rest.alias("rest")) for size, side, chunk, rest in keys
    ]
    return words.select(F.inline(F.array(*structs)))


def near_words(space: Workspace, words: DataFrame, key_pairs: int = KEY_PAIRS, name: str = "spelling") -> DataFrame:
    """``(a, b)``: all pairs of different words that one inserted, deleted or replaced code point makes equal, once each,
    ``a`` the shorter one, or the smaller of two as long. ``words`` has distinct ``word`` of two code points or more."""
    whole = words.select(F.lit(0).cast("long").alias("key"), "word", F.col("word").alias("rest"))
    chunks, grams = whole, whole
    found = None
    while True:
        level = 0 if found is None else level + 1
        chunks = space.keep(_chunks(chunks), f"{name}_chunks_{level}")
        grams = space.keep(_grams(grams), f"{name}_grams_{level}")
        one = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("x"), F.max(F.length("rest")).alias("longest"))
        two = grams.groupBy("key").agg(F.count(F.lit(1)).alias("y"))
        # Rests of one letter are not cut: as many words share their key as there are letters.
        many = (F.col("x") * F.col("y") > key_pairs) & (F.col("longest") > 2)
        keys = space.keep(one.join(two, "key").select("key", many.alias("many")), f"{name}_keys_{level}")
        few = keys.where(~F.col("many")).select("key")
        a = chunks.join(few, "key").select("key", F.col("word").alias("a"))
        b = grams.join(few, "key").select("key", F.col("word").alias("b"))
        shorter = F.length("a") < F.length("b")
        same = (F.length("a") == F.length("b")) & (F.col("a") < F.col("b"))
        near = a.join(b, "key").where((shorter | same) & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")
        near = space.keep(near, f"{name}_near_{level}")
        found = near if found is None else found.unionAll(near)
        hot = keys.where("many").select("key")
        if hot.isEmpty():
            return found.distinct()
        chunks, grams = chunks.join(hot, "key"), grams.join(hot, "key")


def spelling_forms(space: Workspace, docs: DataFrame, name: str = "spelling", key_pairs: int = KEY_PAIRS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of ``docs`` with ``MIN_LETTERS`` and ``MIN_COUNT``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Texts are read whole, null ones have no words, and a
    null ``doc_id`` is written as nothing in the checksum. Rows that repeat count as often as they come. A word's form is the
    near word of the largest count, the smallest in code-point order on a tie, if that is ``FORM_TIMES`` its own; its root
    is where the forms end. Counts grow along forms, so they never come back. An empty table gives no rows.
    """
    words = space.keep(word_counts(docs), f"{name}_words")
    pairs = space.keep(near_words(space, words, key_pairs, name), f"{name}_pairs")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    near = counted.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("b").alias("form"))).alias("best")
    )
    near = near.select(F.col("a").alias("word"), "n_near", "best.form", (-F.col("best.col1")).alias("form_n"))
    enough = F.col("form_n") >= FORM_TIMES * F.col("n")
    known = words.join(near, "word", "left").select(
        "word",
        F.when(enough, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("form_n")).alias("form_n"),
    )
    known = space.keep(known, f"{name}_known")
    return known.join(_roots(space, known, name), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(space: Workspace, known: DataFrame, name: str) -> DataFrame:
    """``(word, root)`` of the words that have a form. Each round doubles how far a word has come."""
    step = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    at = 0
    while True:
        step = space.keep(step, f"{name}_roots_{at}")
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = step.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        if ahead.where("further IS NOT NULL").isEmpty():
            return step
        step, at = ahead.drop("further"), at + 1
