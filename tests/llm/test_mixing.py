import hashlib
import math
import re

import pytest

from ledgerline.llm import mixing
from ledgerline.workspace import Workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, weights=(1, 2, 3), cap=3):
    """Copies by row index, by sorting every source and pouring budgets round by round."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    hashed = [int(hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()[:15], 16) for i, t, _ in rows]
    sources = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in sources}
    target, budget, open_ = {}, sum(size), list(sources)
    while open_:
        level = budget / sum(weight[s] for s in open_)
        over = [s for s in open_ if cap * total[s] <= level * weight[s]]
        for s in over or open_:
            target[s] = cap * total[s] if over else level * weight[s]
        budget -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in over] if over else []
    copies = [0] * len(rows)
    for s in sources:
        if not total[s]:
            continue
        whole = math.floor(target[s] / total[s] + 1e-12)
        rest, taken = target[s] - whole * total[s], 0
        mine = sorted((hashed[i], i) for i, r in enumerate(rows) if r[2] == s)
        below = -1
        if rest > 1e-9:
            for h in sorted({h for h, _ in mine}):
                more = sum(size[i] for x, i in mine if x == h)
                if taken + more >= rest:
                    below = h if taken + more - rest <= rest - taken else h - 1
                    break
                taken += more
        for h, i in mine:
            copies[i] = whole + (h <= below)
    return size, total, target, copies


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_like_brute_force(docs, spark, seed):
    import random

    random.seed(seed)
    rows = [
        (i, " ".join("w" * random.randint(1, 4) for _ in range(random.randint(0, 30))), random.choice(["a", "a", "a", "b", "ä", None]))
        for i in range(300)
    ]
    rows += [(None, None, "b"), (None, "", "b"), (7, "again and again", "c"), (7, "again and again", "c"), (8, "", "empty")]
    size, total, target, copies = brute(rows)
    got = mixing.mix_counts(Workspace(spark, "mix"), docs(rows)).collect()
    want = sorted((str(r[0]), str(r[2]), n, total[r[2]], n * c) for r, n, c in zip(rows, size, copies))
    assert sorted((str(r.doc_id), str(r.source), r["size"], r.source_size, r.taken) for r in got) == want
    assert all(math.isclose(r.target, target[r.source]) for r in got)
    mixed = mixing.mix(Workspace(spark, "mix"), docs(rows))
    assert mixed.count() == sum(copies) and mixed.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_larger_budgets_keep_what_smaller_ones_took(docs, space):
    rows = [(i, "word " * (i % 7 + 1), "ab"[i % 2]) for i in range(200)]
    taken = []
    for n, share in enumerate((0.2, 0.5, 0.8)):
        got = mixing.mix_counts(space, docs(rows), share=share, name=f"share{n}").where("copies > 0")
        taken.append({r.doc_id for r in got.collect()})
    assert taken[0] < taken[1] < taken[2]


def test_an_empty_table_and_other_columns(docs, space, spark):
    assert mixing.mix_counts(space, docs([], 1)).count() == 0
    other = docs([(1, "a b", "x")]).selectExpr("*", "1 AS h", "2 AS mix", "3 AS target", "4 AS copy")
    assert mixing.mix(space, other, name="other").columns == other.columns
