"""Every stage of the pipeline on planted documents, against plain Python on the stage's own input."""

import random
from collections import Counter

import pytest
from test_line_dedup import distance, words
from test_mixing import brute as brute_mix
from test_ngram_join import shingles
from test_packing import check
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import packing

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, toxic ones, exact and near copies, and a passage that many share."""
    random.seed(7)
    words = [f"{a}{b}" for a in ("mar", "sol", "ter", "vin", "lum") for b in ("a", "en", "is", "or", "um", "at")]

    def line():
        return " ".join(random.choices(words, k=random.randint(8, 40))) + "."

    passage = " ".join(random.choices(words, k=60)) + "."
    rows, labels = [], []
    for i in range(160):
        lines = [line() for _ in range(random.randint(2, 8))]
        toxic = i % 8 == 0
        if toxic:
            lines[0] = "You blorghead, " + lines[0]
        if i % 10 == 3:
            changed = passage.split(" ")
            changed[i % 60] = changed[-1 - i % 60] = "other"
            lines.insert(1, passage if i % 20 == 3 else " ".join(changed))
        if i % 10 == 6:
            lines += ["Read more", "READ MORE!"]
        rows.append((i, "\n".join(lines), "en", "ab"[i % 3 == 0], None))
        labels.append((i, 1, int(toxic)))
    rows += [(200 + i, rows[i][1], "en", "b", None) for i in (1, 2, 4)]
    rows += [(300 + i, rows[i][1].replace(words[0], words[1]), "en", "a", None) for i in (5, 6, 7)]
    rows += [(400, None, "en", "a", None), (401, "", "en", None, None)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def brute_lines(rows):
    """Texts that stay, by the edit distance of the words of all pairs of lines; short lines by equal words."""
    lines = [(i, k, words(x)) for i, t in sorted(rows) for k, x in enumerate(t.split("\n"))]
    lines = [(i, k, w, Counter(w)) for i, k, w in lines if w]
    root = list(range(len(lines)))
    for a, (*_, u, p) in enumerate(lines):
        for b, (*_, v, q) in enumerate(lines[:a]):
            longer = max(len(u), len(v))
            most = longer * 20 // 100 if min(len(u), len(v)) >= 5 else 0
            # Each word that the other line lacks takes an edit.
            if longer - sum((p & q).values()) <= most and distance(u, v) <= most:
                x, y = sorted((root[a], root[b]))
                root = [x if r == y else r for r in root]
    gone = {lines[n][:2] for n in range(len(lines)) if root[n] != n}
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}


def test_stages_like_brute_force(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    stages = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, corpus)
        out.write.parquet(f"{tmp_path}/{name}")
        before = [(r.doc_id, r.text, r.source) for r in docs.collect()]
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        stages.append((name, before, docs))
    assert [s[0] for s in stages] == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]
    assert all(after.columns == COLUMNS for _, _, after in stages[:-1])
    (_, given, clean), (_, _, lines), (_, _, unlike), (_, _, mixed), (_, _, packed) = stages

    assert {r.doc_id for r in clean.collect()} == {i for i, t, _ in given if "blorghead" not in (t or "")}

    texts = brute_lines([(i, t) for i, t, _ in stages[1][1] if t])
    kept = {r.doc_id: r.text for r in lines.collect()}
    emptied = {i for i, t, _ in stages[1][1] if t and not texts[i].strip()}
    assert emptied >= {201, 202, 204}
    assert kept == {i: texts[i] if t else t for i, t, _ in stages[1][1] if i not in emptied}
    assert all(r.n_chars == len(r.text) for r in lines.where("text IS NOT NULL").collect())

    sets = {i: shingles(t, 5) for i, t, _ in stages[2][1]}
    left = {r.doc_id for r in unlike.collect()}
    for i in sets:
        near = [j for j in sets if j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        assert i in left or any(j < i for j in near)
        assert i not in left or not any(j in left for j in near)

    _, _, _, copies = brute_mix(stages[3][1])
    want = Counter({(i, t): c for (i, t, _), c in zip(stages[3][1], copies) if c})
    assert Counter((r.doc_id, r.text) for r in mixed.collect()) == want

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    check(packed.collect(), [(i, t) for i, t, _ in stages[4][1]], tokenizer)


def test_run_gives_the_last_stage(spark, corpus):
    from __spark_entry__ import queries

    rows = queries()["pipeline"](spark, corpus).collect()
    assert rows and {r.doc_id for r in rows} <= set(range(500))


def test_an_empty_corpus(spark, corpus, tmp_path):
    folder = str(tmp_path / "empty")
    for table in ("documents", "labels"):
        spark.read.parquet(f"{corpus}/{table}.parquet").where("doc_id < 0").write.parquet(f"{folder}/{table}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_copies_go_from_a_similarity_of_four_fifths(spark):
    """Two words of a hundred replaced leave 86 of 106 shingles of five words."""
    words = [f"w{i}" for i in range(100)]
    other = ["x" if i in (30, 70) else w for i, w in enumerate(words)]
    one, two = (shingles(" ".join(x), 5) for x in (words, other))
    assert (len(one & two), len(one | two)) == (86, 106)
    rows = [(1, " ".join(words), "en", "a", None), (2, " ".join(other), "en", "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, "").collect()] == [1]
