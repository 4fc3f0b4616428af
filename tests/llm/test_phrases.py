import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import phrases
from ledgerline.llm.oracles import ORACLES
from ledgerline.workspace import Workspace

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, min_count=10, top=2000):
    texts, out = defaultdict(list), []
    for lang, text in rows:
        texts["und" if lang is None else lang].append(text or "")
    for lang, own in texts.items():
        f, n = Counter(), 0
        for text in own:
            text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            for piece in re.split("[.,;:!?\x0a-\x0d]", text):
                words = re.findall("[^\x20\x09]+", piece)
                n += len(words)
                for k in (1, 2, 3):
                    f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        around = Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    around[part] = max(around[part], a)
        found = []
        for p, a in candidates.items():
            if 100 * around[p] < 50 * a:
                score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def table(spark, rows, partitions=3):
    return spark.createDataFrame(rows, "lang string, text string").repartition(partitions)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


CORPUS = np.random.default_rng(4)


def corpus(n=400):
    # A word that begins a third of all pairs, copies, and words that only come together.
    words = ["the"] * 40 + [f"w{i}" for i in range(30)] + ["New York", "São Paulo", "rio de janeiro", "É", "x\x1cy", "_", "あ"]
    rows = []
    for i in range(n):
        text = "".join(CORPUS.choice(words) + CORPUS.choice([" ", " ", "\t ", ". ", "\n", "?"], p=[0.4, 0.3, 0.1, 0.1, 0.05, 0.05]) for _ in range(60))
        rows.append((["en", "fr", None, "und"][i % 4], text))
    return rows + rows[:40] * 3 + [("en", None), (None, ""), ("xx", "a b"), ("en", "the w1 " * 30_000)]


@pytest.mark.parametrize("min_count,top", [(10, 2000), (2, 7)])
def test_like_brute_force(spark, min_count, top):
    rows = corpus()
    got = phrases.collocations(Workspace(spark, "p"), table(spark, rows), min_count, top, bitmap_words=4)
    expected = brute(rows, min_count, top)
    assert rows_of(got) == expected
    assert len(expected) > 20


def test_runs_and_partitions_do_not_matter(spark, monkeypatch):
    rows = corpus(60)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 500)
    monkeypatch.setattr(phrases, "BATCH_ROWS", 7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")  # ranges end within words
        got = phrases.collocations(Workspace(spark, "p"), table(spark, rows, 7), 2)
        assert rows_of(got) == brute(rows, 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbÉ .,\t\n\r\x0b\x0c\xa0;", max_size=40), min_size=1, max_size=5))
def test_runs_count_like_brute_force(texts):
    every = np.full(4, (1 << 64) - 1, np.uint64)
    expected = Counter()
    for text in texts:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                expected.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    got = Counter()
    for k in (1, 2, 3):
        run = phrases._Run("en")
        for text in phrases._slices([t.encode() for t in texts]):
            run.add(text)
        for row in (row for counted in run.counts(k, every) for row in counted.to_pylist()):
            got[tuple(row[w] for w in ("w1", "w2", "w3") if row[w] is not None)] += row["f"]
    assert got == expected


def test_no_candidate_no_table_and_clashing_columns(spark):
    rows = [("en", "a b c"), ("fr", None)]
    assert rows_of(phrases.collocations(Workspace(spark, "p"), table(spark, rows))) == []
    assert rows_of(phrases.collocations(Workspace(spark, "p"), table(spark, []))) == []
    rows = [("en", "a b c. a b d")] * 12
    clashing = table(spark, rows).selectExpr("lang", "text", "1 AS f", "2 AS part", "'x' AS k1", "3 AS carried", "4 AS one")
    assert rows_of(phrases.collocations(Workspace(spark, "p"), clashing)) == brute(rows)


def test_scores_beyond_64_bits(spark):
    f = 3_000_000_000_000
    stream = [("en", "a", None, f), ("en", "b", None, f + 1), ("en", "a", "b", f - 7)]
    a = f - 7
    assert 10**6 * a * a > 1 << 64
    df = spark.createDataFrame(stream, "lang string, k1 string, k2 string, f long").selectExpr("*", "CAST(null AS string) AS k3")
    walked = phrases.lockstep(Workspace(spark, "p"), df.select("lang", "k1", "k2", "k3", "f"), "walk")
    assert [(r.one, r.covered) for r in walked.where("k2 IS NOT NULL").collect()] == [(f, False)]
    score = spark.createDataFrame([(a, f, f + 1)], "a long, l long, r long")
    assert score.select(phrases.score_of("a", "l", "r")).first()[0] == 10**6 * a * a // (f * (f + 1))


def test_sql_is_there():
    assert "op11_phrase_collocations" in ORACLES
