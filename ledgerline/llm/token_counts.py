"""Token counts by greedy longest match, without building pieces.

The vocabulary is a trie. Where no child fits, a node's failure link leads to the node whose text is what remains after
the longest match has popped its pieces, and the link knows how many pieces that were. Each character of a word is
then looked at once, however long the pieces are that it tries.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import narrow

#: Words whose counts one Python worker remembers.
REMEMBERED_WORDS = 1_000_000
#: Texts that are cut into words together.
TEXTS = 1_000


class Automaton:
    """Longest-match counts for words as bytes. A word with a byte that no piece fits counts as one unknown piece."""

    def __init__(self, pieces: Iterable[bytes]):
        self.children: list[dict[int, int]] = [{}]
        final = {0: False}
        for piece in pieces:
            node = 0
            for byte in piece:
                child = self.children[node].get(byte)
                if child is None:
                    child = len(self.children)
                    self.children.append({})
                    self.children[node][byte] = child
                node = child
            final[node] = node != 0
        # fail[v]: the node to go on from, -1 if there is none; popped[v]: the pieces left behind on the way.
        self.fail, self.popped = [-1] * len(self.children), [0] * len(self.children)
        level = [0]
        while level:
            below = []
            for u in level:
                for byte, v in self.children[u].items():
                    below.append(v)
                    if final.get(v):
                        self.fail[v], self.popped[v] = 0, 1
                        continue
                    z, n = self.fail[u], self.popped[u]
                    while z >= 0 and byte not in self.children[z]:
                        n += self.popped[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.popped[v] = self.children[z][byte], n
            level = below

    def count(self, word: bytes) -> int:
        children, fail, popped = self.children, self.fail, self.popped
        node, n = 0, 0
        for byte in word:
            while byte not in children[node]:
                if fail[node] < 0:
                    return 1
                n += popped[node]
                node = fail[node]
            node = children[node][byte]
        while node:
            if fail[node] < 0:
                return 1
            n += popped[node]
            node = fail[node]
        return n


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


def vocabulary_pieces(path: str) -> set[bytes]:
    """The pieces of a byte-level tokenizer file as bytes, without the mark of a word's end, special tokens left out."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content["added_tokens"]}
    end, signs = content["model"].get("end_of_word_suffix") or "", _byte_of_sign()
    tokens = (t.removesuffix(end) if end else t for t in content["model"]["vocab"] if t not in special)
    return {bytes(signs[c] for c in t) for t in tokens if t}


def default_vocabulary() -> str:
    """Path of the vocabulary file, found where the task runs."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=1)
def _automaton(path: str) -> tuple[Automaton, dict[str, int]]:
    """One per Python worker, with the counts of words it has seen."""
    return Automaton(vocabulary_pieces(path)), {"": 0}


def _count(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = _automaton(path or default_vocabulary())
        for batch in batches:
            for at in range(0, len(batch), TEXTS):
                texts = batch.column("text").slice(at, TEXTS).fill_null("")
                lists = pc.ascii_split_whitespace(texts)
                bounds = lists.offsets.to_numpy()
                coded = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
                words = coded.dictionary.to_pylist()
                if len(known) + len(words) > REMEMBERED_WORDS:
                    known.clear()
                    known[""] = 0
                for word in words:
                    if word not in known:
                        known[word] = automaton.count(word.lower().encode("utf-8", "surrogatepass"))
                counts = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                real = np.fromiter((w != "" for w in words), np.int64, len(words))
                place = coded.indices.to_numpy(zero_copy_only=False)
                rows = {"doc_id": batch.column("doc_id").slice(at, TEXTS)}
                for column, values in (("n_words", real), ("n_tokens", counts)):
                    upto = np.concatenate([[0], np.cumsum(values[place] if len(words) else np.empty(0, np.int64))])
                    rows[column] = pa.array(np.diff(upto[bounds - bounds[0]]))
                yield pa.RecordBatch.from_pydict(rows)

    return run


def count_tokens(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``(doc_id, n_words, n_tokens)`` per row, without a shuffle.

    Words are runs of characters other than ASCII white space, lower-cased; a word's pieces are the longest piece that
    begins it, the longest that begins the rest, and so on. Null, empty and blank texts have none. Texts are read whole;
    repeated rows are counted each; other columns are ignored; an empty table gives none. ``vocabulary`` is a path that
    every executor can open.
    """
    rows = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_count(vocabulary), "doc_id long, n_words long, n_tokens long")
