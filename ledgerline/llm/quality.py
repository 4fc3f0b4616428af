"""Line-first cleaning: rules throw out single lines, and a document that loses too much text goes as a whole.

All in one projection over the text: no shuffle and no Python.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import WORD, free_name

WHITE = " \t\n\x0b\x0c\r"
#: Fixed phrases of legal notes, cookie banners and site furniture, matched in lower case.
BOILERPLATE = (
    "accept all cookies",
    "all rights reserved",
    "by continuing to use this site",
    "click here",
    "cookie policy",
    "creative commons",
    "enable javascript",
    "forgot your password",
    "licensed under",
    "log in to",
    "lorem ipsum",
    "privacy policy",
    "sign up for",
    "skip to content",
    "subscribe to our",
    "terms of service",
    "terms of use",
    "this site uses cookies",
    "use of cookies",
    "we use cookies",
)
#: A line ends like a sentence if this matches its last characters, white space aside.
SENTENCE_END = r"[.!?…。！？:;][\"'”’»)\]]*$"
LAST = 8
#: Marks between the entries of a menu, alone as a word.
MENU_MARK = r"(^|[\x20\x09-\x0D])[|>»›·•/]+($|[\x20\x09-\x0D])"
SYMBOL = r"[#*$%&|<>]"
#: Without any of these a text has neither symbols nor menu marks nor runs of exclamation marks.
ANY_MARK = r"[#*$%&|<>»›·•/]|!!"
#: Lines of fewer words need no sentence end: headings are not broken sentences.
SHORT_LINE = 4
#: Hundredths: symbols and exclamation runs a line may have for each word, menu marks likewise.
MAX_MARKS = 30
#: Hundredths of a document's words that removed lines may take with them.
MAX_LOST = 60
#: Words a document needs, and hundredths of them that may lie in repeated five-word windows.
MIN_WORDS, WINDOW, MAX_REPEATED = 10, 5, 20


def _words(text: Column) -> Column:
    spaced = text
    for c in WHITE[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(spaced, " "), "")


def _has_phrase(text: Column) -> Column:
    low = F.lower(text)
    return reduce(Column.__or__, (F.contains(low, F.lit(p)) for p in BOILERPLATE))


def line_fails(line: Column, marked: Column | None = None, phrased: Column | None = None) -> Column:
    """Whether a line goes. A line without words stays; it has nothing to lose.

    ``marked`` and ``phrased`` say whether the whole text has any mark or phrase; where it has none, its lines are not
    searched for them.
    """
    marked = F.lit(True) if marked is None else marked
    phrased = F.lit(True) if phrased is None else phrased
    words = F.regexp_count(line, F.lit(WORD))
    ended = F.right(F.rtrim(line, F.lit(WHITE)), F.lit(LAST)).rlike(SENTENCE_END)
    cluttered = F.regexp_count(line, F.lit(SYMBOL + "|!!+")) * 100 > words * MAX_MARKS
    menu = F.regexp_count(line, F.lit(MENU_MARK))
    navigation = (menu >= 2) & (menu * 100 > words * MAX_MARKS)
    return (~ended & (words >= SHORT_LINE)) | (marked & (cluttered | navigation)) | (phrased & _has_phrase(line))


def _repeated(grams: str, packed: str) -> Column:
    """Words inside windows that are found twice or more. ``packed`` holds hash and place of each window, sorted by
    hash, so equal windows are neighbours; they are compared by their full hashes."""
    place = F.lit((1 << 28) - 1)
    p, g = F.col(packed), F.col(grams)

    def gram(x: Column) -> Column:
        return F.get(g, x.bitwiseAND(place).cast("int"))

    def like(x: Column, y: Column) -> Column:
        return F.coalesce(gram(x) == gram(y), F.lit(False))

    found = F.filter(p, lambda x, i: like(x, F.get(p, i - 1)) | like(x, F.get(p, i + 1)))
    places = F.sort_array(F.transform(found, lambda x: x.bitwiseAND(place)))
    rest = F.greatest(F.size(places) - 1, F.lit(0))
    gaps = F.zip_with(F.slice(places, F.lit(2), rest), F.slice(places, F.lit(1), rest), lambda x, y: x - y)
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda n, x: n + F.least(x, F.lit(WINDOW)))
    return F.when(F.size(places) > 0, covered + WINDOW).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one struct column ``quality``: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and
    ``lost_words`` (longs), ``base_failed, kept`` and ``cleaned``, the text without the lines that fail.

    A null or empty text has no words, fails and is cleaned to an empty text. A document is kept if it passes the base
    and its failing lines hold at most ``MAX_LOST`` hundredths of its words. Rows are judged alone, so ties and
    repeated rows do not matter; other columns stay as they are. An empty table gives none.
    """
    names = docs.columns
    taken = list(names)

    def own(name: str) -> str:
        taken.append(free_name(taken, name))
        return taken[-1]

    t, w, h, g, p, ls, worded, lost, marked, phrased = (
        own(f"q_{x}") for x in "text words hashes grams packed lines worded fails marked phrased".split()
    )
    df = docs.withColumn(t, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    df = df.withColumns({marked: F.col(t).rlike(ANY_MARK), phrased: _has_phrase(F.col(t))})
    df = df.withColumns({w: _words(F.col(t)), ls: F.split(F.col(t), "\n", -1)})
    fails = F.transform(ls, lambda x: line_fails(x, F.col(marked), F.col(phrased)))
    df = df.withColumns({h: F.transform(w, lambda x: F.xxhash64(x)), lost: fails})
    window = F.lit(WINDOW - 1)
    grams = F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - window, F.lit(0))),
        lambda x, i: F.xxhash64(x, *(F.get(F.col(h), i + k) for k in range(1, WINDOW))),
    )
    df = df.withColumn(g, grams)
    some = F.size(F.array_distinct(g)) < F.size(g)
    pack = F.transform(g, lambda x, i: F.shiftleft(x, 28).bitwiseOR(i.cast("long")))
    df = df.withColumn(p, F.when(some, F.sort_array(pack)).otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn(worded, F.filter(ls, lambda x: x.rlike(WORD)))
    flags = F.arrays_zip(F.col(ls).alias("line"), F.col(lost).alias("fails"))
    gone = F.filter(flags, lambda x: x["fails"])
    stays = F.filter(flags, lambda x: ~x["fails"])
    words = F.size(w).cast("long")
    values = {
        "n_words": words,
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.when(F.col(marked), F.regexp_count(F.col(t), F.lit(SYMBOL))).otherwise(0).cast("long"),
        "n_dup_lines": (F.size(worded) - F.size(F.array_distinct(worded))).cast("long"),
        "n_repeat_words": _repeated(g, p),
        "lost_words": F.aggregate(
            gone, F.lit(0).cast("long"), lambda n, x: n + F.regexp_count(x["line"], F.lit(WORD))
        ),
        "cleaned": F.when(
            F.exists(lost, lambda x: x), F.array_join(F.transform(stays, lambda x: x["line"]), "\n")
        ).otherwise(F.col(t)),
    }
    q = own("q")
    df = df.select(*(F.col(f"`{c}`") for c in names), F.struct(*(v.alias(k) for k, v in values.items())).alias(q))
    base = (F.col(f"{q}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{q}.n_repeat_words") > MAX_REPEATED * F.col(f"{q}.n_words")
    )
    good = ~base & (100 * F.col(f"{q}.lost_words") <= MAX_LOST * F.col(f"{q}.n_words"))
    verdict = F.struct(F.col(f"{q}.*"), base.alias("base_failed"), good.alias("kept"))
    return df.select(*(F.col(f"`{c}`") for c in names), verdict.alias(free_name(names, "quality")))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents, their failing lines removed, with the columns of ``docs``."""
    measured = measure(docs, text)
    quality = measured.columns[-1]
    kept = measured.where(F.col(f"{quality}.kept"))
    return kept.select(*((F.col(f"{quality}.cleaned") if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns))
