import random
import re
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ngram_join
from ledgerline.llm.ngram_join import Bands, shingle_sets, signatures, sketch_differs, sketches
from ledgerline.workspace import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=4):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def corpus(seed, n=120):
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        text = [random.choice(words) for _ in range(random.choice([3, 8, 30, 90, 300]))]
        if rows and random.random() < 0.6:
            text = (random.choice(rows)[1] or "").split(" ")
            for _ in range(random.randint(0, max(1, len(text) // 40))):
                text[random.randrange(len(text))] = random.choice(words)
        rows.append((i, " ".join(text)))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_like_brute_force(docs, spark, seed):
    rows = corpus(seed) + [(900, None), (901, ""), (902, " \n\t "), (903, "One TWO"), (904, "one\x0btwo"), (905, "É"), (906, "é")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_groups(Workspace(spark, "n"), docs(rows)).collect()}
    assert got == brute(rows)


def test_a_chain_and_a_star_of_many_near_copies(docs, spark):
    random.seed(5)
    base = [f"b{i}" for i in range(200)]
    star = []
    for i in range(150):
        copy = list(base)
        copy[random.randrange(200)] = f"x{i}"
        copy[random.randrange(200)] = f"y{i}"
        star.append(copy)
    chain = [[f"c{i}" for i in range(4 * k, 4 * k + 150)] for k in range(12)]
    rows = [(i, " ".join(t)) for i, t in enumerate(star + chain)]
    random.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_groups(Workspace(spark, "n"), docs(rows)).collect()}
    assert got == brute(rows)


def test_similar_sets_share_a_signature():
    random.seed(3)
    bands = Bands()
    for size in (1, 2, 6, 7, 13, 20, 50, 99, 400, 1500):
        for _ in range(30):
            a = {random.getrandbits(64) for _ in range(size)}
            b = set(a)
            # Change as many elements as the threshold allows.
            while True:
                c = set(b)
                if random.random() < 0.5 and c:
                    c.pop()
                else:
                    c.add(random.getrandbits(64))
                if 100 * len(a & c) < 85 * len(a | c):
                    break
                b = c
            x, y = (np.array(sorted(s), np.uint64) for s in (a, b))
            (kx, _, sx), (ky, _, sy) = (signatures(s, np.array([0, len(s)]), bands) for s in (x, y))
            both = np.intersect1d(kx, ky)
            assert len(both) >= max(sx[0], sy[0]) >= 1, (size, len(b))
            # Signatures that two sets share are in the same order in both.
            assert [k for k in kx if k in both] == [k for k in ky if k in both]
            bits, at = sketches(np.concatenate([x, y]), np.array([0, len(x), len(x) + len(y)]))
            one, two = sorted((bits[at[0] : at[1]], bits[at[1] : at[2]]), key=len)
            if len(two) > len(one):
                two = two[: len(one)] ^ two[len(one) :]
            assert bin(int.from_bytes((one ^ two).tobytes(), "big")).count("1") <= len(a ^ b)


def test_sketches_are_compared_by_their_differing_bits(spark):
    random.seed(9)
    rows = []
    for n, m in ((4, 4), (4, 8), (16, 8), (2, 4)):
        x, y = ([random.getrandbits(64) - (1 << 63) for _ in range(k)] for k in (n, m))
        short, long = sorted((x, y), key=len)
        folded = long if len(long) == len(short) else [a ^ b for a, b in zip(long[: len(short)], long[len(short) :])]
        rows.append((x, y, sum(bin((a ^ b) & ((1 << 64) - 1)).count("1") for a, b in zip(short, folded))))
    df = spark.createDataFrame(rows, "x array<long>, y array<long>, n int")
    assert df.where(sketch_differs(F.col("x"), F.col("y")) != F.col("n")).count() == 0


def test_a_passage_in_many_documents_makes_few_pairs(docs, spark, monkeypatch):
    """Two thousand documents, a third of each a passage that all have, and near-copies of some of them."""
    random.seed(11)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([f"a{i}x{j}" for j in range(60)] + passage + [f"b{i}x{j}" for j in range(60)])) for i in range(2000)]
    rows += [(3000 + i, rows[i][1].replace(f"a{i}x7 ", "changed ")) for i in range(0, 2000, 50)]
    seen = []
    check = ngram_join._check
    monkeypatch.setattr(ngram_join, "_check", lambda *a: seen.append(1) or check(*a))
    space = Workspace(spark, "passage")
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_groups(space, docs(rows)).collect()}
    assert got == {i: i - 3000 if i >= 3000 else i for i, _ in rows}
    kept = sorted(p.name for p in Path(space.path("kept").removeprefix("file:")).iterdir())
    # Only what the result reads is left.
    assert len(kept) == 2 and kept[0].startswith("ngram_") and kept[1] == "ngram_members", kept


def test_sets_are_the_words_of_whole_texts():
    texts = [None, "", "a", "A b", "a B c d", "a b c d e", "x " * 50_000, "é É\x0bz\x85q"]
    found, starts = shingle_sets(texts)
    assert np.diff(starts).tolist() == [len(shingles(t)) for t in texts]
    one, _ = shingle_sets(["a b c d"])
    assert one[0] == found[starts[4]] and len(set(found.tolist())) < len(found)


def test_null_ids_repeated_rows_clashing_columns_and_nothing(docs, space, spark):
    text = "one two three four five six"
    rows = [(None, text), (5, text), (5, text), (3, text), (None, None), (8, "other words here")]
    got = ngram_join.ngram_groups(space, docs(rows).selectExpr("*", "1 AS node", "2 AS key", "3 AS n_shingles"))
    assert sorted(map(str, got.collect())) == sorted(
        f"Row(doc_id={i}, n_shingles={n}, component_id={c})" for i, n, c in [(None, 3, 3), (5, 3, 3), (5, 3, 3), (3, 3, 3), (None, 0, None), (8, 1, 8)]
    )
    kept = ngram_join.keep_first(Workspace(spark, "k"), docs(rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "8", "None", "None"]
    assert ngram_join.ngram_groups(Workspace(spark, "e"), docs([], 1)).count() == 0
