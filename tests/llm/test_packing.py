import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing
from ledgerline.workspace import Workspace

ODD = [
    None,
    "",
    " ",
    "\n\n",
    "áb ́c",
    "tab\tsplit nbsp em \x1c\x1f\x85 x",
    "<|endoftext|> <|startoftext|>x<|endoftext|>",
    "don't we'll I'VE 's",
    "ΑΣ ΣΑΣ İstanbul ǅ ﬁ K",
    "日本語のテキスト👩‍👩‍👧 ȩ́",
    "x" * 5_000,
    "﻿word​‍word",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_tokenizer())


def test_ids_by_words_are_the_tokenizers(tokenizer, spark):
    texts = [t or "" for t in ODD]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    random.seed(1)
    texts += ["".join(chr(random.choice([32, 10, 97, 769, 931, 8217, 39, 115, 0x3000, 0x1F600])) for _ in range(40)) for _ in range(300)]
    ids, starts = packing.WordIds(packing.default_tokenizer()).encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_small_memory_gives_the_same_ids(monkeypatch):
    texts = pa.array([f"w{i} w{i % 7} x{i // 2}" for i in range(500)])
    words = packing.WordIds(packing.default_tokenizer())
    want = words.encode(texts)[0].tolist()
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 100)
    monkeypatch.setattr(packing, "CHUNK_WORDS", 7)
    words = packing.WordIds(packing.default_tokenizer())
    got = [words.encode(texts.slice(i, 50))[0].tolist() for i in range(0, 500, 50)]
    assert sum(got, []) == want


def check(pieces, rows, tokenizer):
    """Every id in one piece, no gap in a sequence, all sequences full or a power of two."""
    want = sorted(
        (str(i), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID])) for i, t in rows
    )
    assert sum(p.length for p in pieces) == sum(len(ids) for _, ids in want)
    left = {}
    for i, ids in want:
        left.setdefault(i, []).append(ids)
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(p.ids) == p.ids_crc32
        assert any(
            len(x) == p.doc_tokens and tuple(ids.tolist()) == x[p.start : p.start + p.length] for x in left[str(p.doc_id)]
        )
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((str(p.doc_id), p.doc_tokens), []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for (i, n), parts in by_doc.items():
        same = sum(len(x) == n for x in left[i])
        assert sum(length for _, length in parts) == n * same
        if same == 1:
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == packing.WINDOW or at < packing.WINDOW and at & (at - 1) == 0


def test_every_id_lies_in_one_piece(docs, spark, tokenizer):
    random.seed(2)
    vocabulary = [f"{a}{b}" for a in ("red", "blue", "sea", "hill", "rain") for b in ("fish", "stone", "s", "er", "light")]
    rows = [(i, " ".join(random.choices(vocabulary, k=random.choice([1, 5, 60, 300, 900, 2500])))) for i in range(120)]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (7, rows[7][1])]
    given = docs(rows).selectExpr("*", "1 AS start", "2 AS row", "3 AS shard")
    check(packing.pack(Workspace(spark, "p"), given, shard_tokens=20_000).collect(), rows, tokenizer)
    bare = packing.pack(Workspace(spark, "p"), given, with_ids=False)
    assert bare.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert packing.pack(Workspace(spark, "p"), docs([], 1)).count() == 0


def test_whole_windows_only(docs, spark, tokenizer):
    text = " ".join(["a"] * (packing.WINDOW - 1))
    pieces = packing.pack(Workspace(spark, "p"), docs([(1, text)])).collect()
    assert [(p.start, p.length, p.offset) for p in pieces] == [(0, packing.WINDOW, 0)]


def test_windows_are_filled_with_neighbours():
    """Documents of one topic land together, and the index ranks like BM25 worked out plainly."""
    random.seed(3)
    topics = [np.arange(1 + 100 * t, 101 + 100 * t) for t in range(6)]
    documents = [np.array(random.choices(topics[i % 6].tolist(), k=40) + [1] * 5) for i in range(90)]
    frequencies = np.bincount(np.concatenate([np.unique(d) for d in documents]), minlength=700)
    statistics = packing.Statistics(90, 45.0, frequencies)
    index = packing.Index(documents, statistics)
    idf = np.log(1 + (90 - frequencies + 0.5) / (frequencies + 0.5))

    def weight(term, d):
        tf = (documents[d] == term).sum()
        return idf[term] * tf * (packing.K1 + 1) / (tf + packing.K1)

    for seed in (0, 17, 53):
        terms = [t for t in np.unique(documents[seed]) if frequencies[t] > 1]
        terms = sorted(terms, key=lambda t: (-weight(t, seed), t))[: packing.QUERY_TERMS]
        got = index.scores(seed)
        for d in range(90):
            assert abs(got[d] - sum(weight(t, d) for t in terms)) < 1e-3
    sequences = packing.fill(documents, statistics, 256)
    assert sum(n for s in sequences for *_, n in s) == sum(map(len, documents))
    pure = [len({d % 6 for d, *_ in s}) for s in sequences if sum(n for *_, n in s) == 256]
    assert np.mean(pure) < 3


def test_near_copies_meet_in_one_shard(docs, spark):
    """Of near-copies among many documents most share a sequence, however many shards there are; copies that are too
    many for a shard are dealt out."""
    random.seed(5)
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    vocabulary = sorted({w for r in texts for w in (r.text or "").split()})
    rows = []
    for i in range(400):
        words = random.choices(vocabulary, k=60)
        rows.append((2 * i, " ".join(words)))
        words[random.randrange(60)] = random.choice(vocabulary)
        rows.append((2 * i + 1, " ".join(words)))
    rows += [(10_000 + i, "many the same words here " * 10) for i in range(400)]
    pieces = packing.pack(Workspace(spark, "p"), docs(rows), shard_tokens=8_000).collect()
    shards, held = {}, {}
    for p in pieces:
        shard = p.sequence_id >> 41
        held[shard] = held.get(shard, 0) + p.length
        shards.setdefault(p.doc_id, set()).add(shard)
    assert len(held) > 10 and max(held.values()) < 16_000
    assert np.mean([shards[2 * i] == shards[2 * i + 1] for i in range(400)]) > 0.8


def test_the_ranking_is_followed_until_the_window_is_full():
    """Forty short neighbours of a seed come before documents without a common term."""
    documents = [np.array([1, 2, 3])] + [np.array([50 + i] * 3) for i in range(60)] + [np.array([1, 2, 200 + i]) for i in range(40)]
    frequencies = np.bincount(np.concatenate([np.unique(d) for d in documents]), minlength=300)
    first = packing.fill(documents, packing.Statistics(len(documents), 3.0, frequencies), 128)[0]
    assert {d for d, *_ in first} >= set(range(61, 101))


def test_words_of_letters_and_marks_like_the_tokenizer(monkeypatch):
    """Known, new, marked and odd words, over several calls, also when nothing more can be remembered."""
    plain = Tokenizer.from_file(packing.default_tokenizer())
    rng = random.Random(3)
    words = ["Straße", "naïve", "µm", "ª", "don't", "it's", "a", "B", "é", "≠", "中文", "x1", "12", "a\tb", "", "''", "—", "ÿ"]
    marks = ["", "", ".", "!!", "'", "'s", "$$$", "̸", "...", "@[`{~", "é", "*,"]
    for limit in (packing.REMEMBERED_WORDS, 20):
        monkeypatch.setattr(packing, "REMEMBERED_WORDS", limit)
        known = packing.WordIds(packing.default_tokenizer())
        assert known.marks_apart
        for _ in range(6):
            texts = [
                "".join(rng.choice(words) + rng.choice(marks) + rng.choice(" \n") for _ in range(rng.randrange(30))) for _ in range(25)
            ]
            ids, starts = known.encode(pa.array(texts, pa.string()))
            for i, text in enumerate(texts):
                assert ids[starts[i] : starts[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, text
        known.marks_apart = False
        known.clear()
        ids, _ = known.encode(pa.array(texts, pa.string()))
        assert ids.tolist() == [x for text in texts for x in plain.encode(text, add_special_tokens=False).ids]
        assert len(known.encode(pa.array([], pa.string()))[0]) == 0
