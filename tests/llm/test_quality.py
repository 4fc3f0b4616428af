import random
import re
from collections import Counter

from pyspark.sql import functions as F

from ledgerline.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(inside) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside), failed


def test_base_like_brute_force(docs):
    random.seed(1)
    rows = [(i, " ".join(random.choices("abc", k=random.randint(0, 60))).replace("a b", random.choice("\n\t "))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "a\x0bb\x85c é#*$%&|<>"), (203, "x y z v w " * 9_000), (204, "same line\n" * 40), (None, "\n\n")]
    rows += [(205, "one two three four five six seven one two three four five"), (205, "twice")]
    got = quality.measure(docs(rows).selectExpr("*", "1 AS quality", "2 AS q_words")).select("doc_id", "text", "_quality.*").collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r.doc_id), *(r[f] for f in fields)) for r in got) == sorted((str(i), *base(t)) for i, t in rows)
    assert not any(r.kept for r in got if r.base_failed)


def test_line_rules(spark):
    lines = {
        "A plain sentence ends like this.": False,
        "«Une phrase !»": False,
        "Heading of three": False,
        "": False,
        "this line just breaks off and": True,
        "Home | News | Sport | Weather | More.": True,
        "We use cookies to make this site better.": True,
        "word### word*** word$$$ word%%%.": True,
        "Licensed under the Apache License, Version 2.0.": True,
    }
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert {r.line: r.f for r in df.select("line", quality.line_fails(F.col("line")).alias("f")).collect()} == lines


def test_clean_removes_lines_then_documents(docs):
    good = "The first line of this text is a sentence of some words.\nThe second one is a sentence, too."
    rows = [(1, good + "\nHome | News | Sport"), (2, "menu one | menu two | menu three | menu four | and many more |\n" * 4), (3, None)]
    kept = quality.clean(docs(rows))
    assert [(r.doc_id, r.text) for r in kept.collect()] == [(1, good)]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert quality.measure(docs([], 1)).count() == 0


def test_only_one_projection(docs):
    plan = quality.measure(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Window" not in plan and "Aggregate" not in plan
