"""Packing token ids into windows with lexically similar neighbours.

Documents are cut into whole windows and a rest. Rests with the same rare terms are brought together in shards of bounded
size, and each shard is one task: it builds a BM25 inverted index over token ids, with document frequencies and lengths counted
over all ids of all documents while they are cut, takes one unused document after the other as a seed, and fills its window with the unused neighbours that the index
returns, down to the last that shares a term with the seed. What does not fit is cut; the cut-off part seeds the next window. The last window of a shard is cut into
sequences of powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import narrow
from ledgerline.workspace import Workspace

WINDOW = 2048
END_ID = 1
#: Tokens of one shard, about: what one task holds.
SHARD_TOKENS = 1 << 19
#: BM25's saturation and length normalisation, terms of a first query, and neighbours looked at together.
K1, B, QUERY_TERMS, NEIGHBOURS = 1.2, 0.75, 12, 16
#: Words whose ids one Python worker remembers.
REMEMBERED_WORDS = 1_200_000
#: Words that are tokenized at once, and texts that are cut into words together.
CHUNK_WORDS, TEXTS = 20_000, 3_000
#: Latin letters of the first 256 characters and the marks of ASCII, as in a pattern's brackets.
LETTERS, MARKS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", r"!-/:-@\[-`{-~"


def default_tokenizer() -> str:
    """Path of the tokenizer file, found where the task runs."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Token ids of texts by way of their words, each tokenized once.

    Holds for tokenizers that never join characters across a space or a newline, as those that split at white space
    first. Words are what spaces and newlines separate; all other characters are left to the tokenizer. Where it also splits
    between letters and marks, a word of letters that ends in marks has the ids of the letters, then those of the marks.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        cut = self.tokenizer.pre_tokenizer
        self.marks_apart = cut is not None and any(at == 2 for _, (at, _) in cut.pre_tokenize_str("ab!?"))
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([""], pa.large_string())
        self.ends = np.zeros(1, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the known words at ``places``, one after the other, and where each word's end."""
        firsts = np.concatenate([[0], self.ends[:-1]])[places]
        sizes = self.ends[places] - firsts
        upto = np.cumsum(sizes)
        at = np.repeat(firsts - (upto - sizes), sizes)
        at += np.arange(len(at))
        return self.ids[at], upto

    def _add(self, words: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, words])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
        self.ids = np.concatenate([self.ids, ids])

    def _learn(self, words: pa.Array) -> None:
        """Add words that are not known; those of letters and marks come last."""
        marked = pc.match_substring_regex(words, f"^[{LETTERS}]+[{MARKS}]+$")
        if not self.marks_apart:
            marked = pc.and_(marked, False)
        whole = words.filter(marked)
        letters = pc.replace_substring_regex(whole, f"[{MARKS}]+$", "")
        marks = pc.replace_substring_regex(whole, f"^[{LETTERS}]+", "")
        atoms = pa.concat_arrays([words.filter(pc.invert(marked)), letters, marks]).unique()
        places = pc.index_in(atoms, self.known)
        first, fresh = len(self.known), atoms.filter(pc.is_null(places))
        # A word of Latin letters is one run of letters, so its last id alone closes a word; others go by offsets.
        plain = pc.match_substring_regex(fresh, f"^[{LETTERS}]+$")
        for group, simple in ((fresh.filter(plain), True), (fresh.filter(pc.invert(plain)), False)):
            tokens = [self._tokenize(group.slice(at, CHUNK_WORDS).to_pylist(), simple) for at in range(0, len(group), CHUNK_WORDS)]
            if tokens:
                ids, counts = map(np.concatenate, zip(*tokens))
                self._add(group, ids, np.cumsum(counts))
        if not len(whole):
            return
        # Fresh atoms were added in the order of the two groups.
        added = pc.index_in(fresh, self.known.slice(first))
        new = places.is_null().to_numpy(zero_copy_only=False)
        places = places.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        places[new] = first + added.to_numpy(zero_copy_only=False)
        both = np.stack([pc.index_in(x, atoms).to_numpy() for x in (letters, marks)], axis=1).ravel()
        ids, ends = self._ids(places[both])
        self._add(whole, ids, ends[1::2])

    def _tokenize(self, chunk: list[str], simple: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, and how many each word has."""
        text = " ".join(chunk)
        if simple:
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.closing[ids])
            if len(ends) == len(chunk):
                return ids, np.diff(ends, prepend=-1)
        found = self.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        starts = np.cumsum(np.fromiter(map(len, chunk), np.int64, len(chunk)) + 1)
        places = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
        return ids, np.bincount(np.searchsorted(starts, places, "right"), minlength=len(chunk))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.values.slice(lists.offsets[0].as_py(), lists.offsets[-1].as_py() - lists.offsets[0].as_py())
        coded = coded.dictionary_encode()
        words = coded.dictionary.cast(pa.large_string())
        place = pc.index_in(words, self.known)
        if len(self.known) + place.null_count > REMEMBERED_WORDS:
            self.clear()
            place = pc.index_in(words, self.known)
        new, first = place.is_null().to_numpy(zero_copy_only=False), len(self.known)
        place = place.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        if new.any():
            unknown = words.filter(new)
            self._learn(unknown)
            place[new] = first + pc.index_in(unknown, self.known.slice(first)).to_numpy()
        ids, upto = self._ids(place[coded.indices.to_numpy(zero_copy_only=False)])
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return ids, np.concatenate([[0], upto])[offsets]


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One per Python worker."""
    return WordIds(path)


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
_PIECE = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())]
)


def _table(rows: list[tuple]) -> dict[str, pa.Array]:
    columns = list(zip(*rows)) or [()] * len(_PIECE)
    return {f.name: pa.array(values, f.type) for f, values in zip(_PIECE, columns)}


def _cut(path: str | None, with_ids: bool):
    """Whole windows as pieces, and each document's rest with its ids and a number of its own under ``row``; and last, under
    number -1, how many of the task's documents have each token id, as 64-bit counts in place of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path or default_tokenizer())
        # Numbers start from the task's partition; a task that runs again gives the same ones.
        number = TaskContext.get().partitionId() << 40
        size = len(words.closing)
        frequencies, last, place = np.zeros(size, np.int64), np.zeros(size, np.int64), np.arange(1 << 16)
        documents = tokens = 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for at in range(0, len(doc_ids), TEXTS):
                texts = batch.column("text").slice(at, TEXTS).fill_null("")
                ids, starts = words.encode(texts)
                rows, numbers = [], []
                for i, doc_id in enumerate(doc_ids[at : at + TEXTS]):
                    own = np.append(ids[starts[i] : starts[i + 1]], np.uint32(END_ID))
                    if len(own) > len(place):
                        place = np.arange(2 * len(own))
                    # Of equal ids the last one's place stays, so each id counts once.
                    last[own] = place[: len(own)]
                    frequencies[own[last[own] == place[: len(own)]]] += 1
                    documents, tokens = documents + 1, tokens + len(own)
                    for start in range(0, len(own), WINDOW):
                        part = own[start : start + WINDOW]
                        number += 1
                        full = len(part) == WINDOW
                        keep = part.astype("<u4").tobytes() if with_ids or not full else None
                        sequence = 2 * number if full else None
                        crc = _crc(part) if full else None
                        rows.append((doc_id, start, len(part), crc, len(own), sequence, 0, keep))
                        numbers.append(number)
                yield pa.RecordBatch.from_pydict({**_table(rows), "row": pa.array(numbers, pa.int64())})
        counted = [(None, 0, documents, None, tokens, None, 0, frequencies.astype("<i8").tobytes())]
        yield pa.RecordBatch.from_pydict({**_table(counted), "row": pa.array([-1], pa.int64())})

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(id, n)`` of the counts that tasks have left."""
    for batch in batches:
        for counts in batch.column("ids").to_pylist():
            total = np.frombuffer(counts, "<i8")
            found = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"id": pa.array(found), "n": pa.array(total[found])})


@dataclass(frozen=True)
class Statistics:
    """Over all documents: how many there are, their mean length, and how many have each token id."""

    documents: int
    mean_length: float
    frequencies: np.ndarray

    def idf(self) -> np.ndarray:
        n = self.frequencies
        return np.log(1 + (self.documents - n + 0.5) / (n + 0.5)).astype(np.float32)


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, documents: list[np.ndarray], statistics: Statistics):
        lengths = np.fromiter(map(len, documents), np.int64, len(documents))
        size = len(statistics.frequencies)
        owner = np.repeat(np.arange(len(documents)), lengths)
        pairs, tf = np.unique(owner * size + np.concatenate(documents), return_counts=True)
        owner, term = np.divmod(pairs, size)
        norm = K1 * (1 - B + B * lengths[owner] / statistics.mean_length)
        weight = (statistics.idf()[term] * tf * (K1 + 1) / (tf + norm)).astype(np.float32)
        order = np.argsort(term, kind="stable")
        self.size = len(documents)
        self.owners, self.weights = owner[order], weight[order]
        self.starts = np.searchsorted(term[order], np.arange(size + 1))
        # A document's query: its heaviest terms that another document of the shard has, too.
        shared = np.flatnonzero(np.diff(self.starts)[term] > 1)
        shared = shared[np.lexsort((-weight[shared], owner[shared]))]
        self.terms, self.queries = term[shared], np.searchsorted(owner[shared], np.arange(len(documents) + 1))

    def scores(self, document: int, most: int | None = QUERY_TERMS) -> np.ndarray:
        """Scores by the ``most`` heaviest terms of a document, or by all."""
        score = np.zeros(self.size, np.float32)
        first, end = self.queries[document], self.queries[document + 1]
        for term in self.terms[first : end if most is None else min(first + most, end)]:
            a, b = self.starts[term], self.starts[term + 1]
            score[self.owners[a:b]] += self.weights[a:b]
        return score


def fill(documents: list[np.ndarray], statistics: Statistics, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces ``(document, start, length)``: every id in one piece, every sequence ``window`` ids, those
    of the last in powers of two."""
    index = Index(documents, statistics)
    lengths = [len(d) for d in documents]
    begin = [0] * len(documents)
    unused = np.ones(len(documents), bool)
    sequences: list[list[tuple[int, int, int]]] = []
    pieces: list[tuple[int, int, int]] = []
    room = window

    def take(document: int) -> None:
        nonlocal room
        n = min(room, lengths[document] - begin[document])
        pieces.append((document, begin[document], n))
        begin[document] += n
        room -= n
        if begin[document] == lengths[document]:
            unused[document] = False

    seed, after = None, 0
    while True:
        # What was cut off seeds the next window, then the next unused document does.
        if seed is None or not unused[seed]:
            while after < len(documents) and not unused[after]:
                after += 1
            if after == len(documents):
                break
            seed = after
        take(seed)
        query = seed
        for most in (QUERY_TERMS, None):
            score = index.scores(query, most) if room else None
            # Either the window is filled, or all that were looked at are used up and the next ones follow.
            while room:
                score[~unused] = 0
                best = np.argpartition(-score, min(NEIGHBOURS, len(score) - 1))[:NEIGHBOURS]
                best = best[np.lexsort((best, -score[best]))]
                best = [int(d) for d in best if score[d] > 0]
                if not best:
                    break
                for document in best:
                    if lengths[document] - begin[document] <= room and room:
                        take(document)
                for document in best:
                    if room and unused[document]:
                        take(document)
                        seed = document
        if not room:
            sequences.append(pieces)
            pieces, room = [], window
        elif seed is not None and not unused[seed]:
            seed = None
    size = 1
    while pieces:
        # The last window's ids are dealt into sequences of 1, 2, 4, ... as its length has them.
        if sum(n for *_, n in pieces) & size:
            part, left = [], size
            while left:
                document, start, n = pieces.pop()
                cut = min(left, n)
                part.insert(0, (document, start + n - cut, cut))
                if cut < n:
                    pieces.append((document, start, n - cut))
                left -= cut
            sequences.append(part)
        size *= 2
    return sequences


def _least_pair(ids: np.ndarray) -> int:
    """The least hash of two ids that follow each other, alike for most texts that are alike."""
    pairs = ids[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids[1:].astype(np.uint64)
    pairs = (pairs ^ (pairs >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return int((pairs ^ (pairs >> np.uint64(29))).min() >> np.uint64(1)) if len(pairs) else 0


def _keys(statistics):
    """Rows ``(row, length, k0, k1)``: a rest's rarest term that another document has, too, and the least hash of its pairs
    of ids, by which rests with a common rarest term are told apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequencies = statistics.value.frequencies
        # Terms in the order of their frequencies, those of one document alone after all others.
        rank = np.empty(len(frequencies), np.int64)
        rank[np.lexsort((np.arange(len(frequencies)), frequencies, frequencies < 2))] = np.arange(len(frequencies))
        end = int((frequencies > 1).sum())
        for batch in batches:
            first, rest = [], []
            for ids in batch.column("ids").to_pylist():
                own = np.frombuffer(ids, "<u4")
                least = int(rank[own].min())
                first.append(least if least < end else -1)
                rest.append(_least_pair(own))
            columns = {"row": batch.column("row"), "length": batch.column("length")}
            yield pa.RecordBatch.from_pydict({**columns, "k0": pa.array(first, pa.int64()), "k1": pa.array(rest, pa.int64())})

    return run


def _deal(space: Workspace, rests: DataFrame, statistics, shard_tokens: int, name: str) -> DataFrame:
    """``rests`` with a ``shard``: those with the same rarest terms together, and no shard of much over ``shard_tokens``.

    The driver sees the tokens of each rarest term, as many as the vocabulary has, and of each piece of the common ones, as
    many as there are shards.
    """
    spark = rests.sparkSession
    keyed = rests.select("row", "length", "ids").mapInArrow(_keys(statistics), "row long, length long, k0 long, k1 long")
    keyed = space.keep(keyed, f"{name}_keys")
    sums = {r["k0"]: r["n"] for r in keyed.groupBy("k0").agg(F.sum("length").alias("n")).collect()}
    cut = [(k, -(-n // shard_tokens)) for k, n in sums.items()]
    pieces = F.broadcast(spark.createDataFrame(cut, "k0 long, pieces long"))
    keyed = keyed.join(pieces, "k0").withColumn("k1", F.pmod(F.xxhash64("k1"), F.col("pieces"))).drop("pieces")
    sums = keyed.groupBy("k0", "k1").agg(F.sum("length").alias("n")).collect()
    shards, shard, held = [], 0, 0
    for k0, k1, n in sorted((r["k0"], r["k1"], r["n"]) for r in sums):
        if held and held + n > shard_tokens:
            shard, held = shard + 1, 0
        # Many rests with all the same terms are dealt out by their numbers.
        several = -(-n // shard_tokens)
        shards.append((k0, k1, shard, several))
        shard, held = (shard + several, 0) if several > 1 else (shard, held + n)
    known = F.broadcast(spark.createDataFrame(shards, "k0 long, k1 long, first long, several long"))
    at = (F.col("first") + F.pmod(F.xxhash64("row"), F.col("several"))).alias("shard")
    return rests.join(keyed.join(known, ["k0", "k1"]).select("row", at), "row")


def _fill(statistics, with_ids: bool):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        documents = [np.frombuffer(x, "<u4").astype(np.int64) for x in table.column("ids").to_pylist()]
        doc_ids, starts, tokens = (table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        rows = []
        for number, sequence in enumerate(fill(documents, statistics.value)):
            offset = 0
            for d, start, n in sequence:
                part = documents[d][start : start + n]
                ids = part.astype("<u4").tobytes() if with_ids else None
                sequence_id = 2 * (key[0].as_py() << 40 | number) + 1
                rows.append((doc_ids[d], starts[d] + start, n, _crc(part), tokens[d], sequence_id, offset, ids))
                offset += n
        return pa.table(_table(rows))

    return run


def pack(
    space: Workspace,
    docs: DataFrame,
    tokenizer: str | None = None,
    with_ids: bool = True,
    shard_tokens: int = SHARD_TOKENS,
    name: str = "pack",
) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and ``ids`` (little-endian unsigned
    32-bit, left out without ``with_ids``).

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text is the end id alone. Each row is
    a document of its own, also if an id or a text comes again. Sequences are 2048 ids long, or a smaller power of two at
    the end of a shard. An empty table gives none. ``tokenizer`` is a path that every executor can open.
    """
    rows = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = space.keep(rows.mapInArrow(_cut(tokenizer, with_ids), f"{PIECE}, row long"), f"{name}_cut")
    columns = [c for c in cut.columns if c not in ("row", "ids")] + ["ids"] * with_ids
    whole = cut.where("sequence_id IS NOT NULL")
    rests, counted = cut.where("sequence_id IS NULL AND row >= 0"), cut.where("row < 0")
    held = rests.agg(F.sum("length")).first()[0]
    if not held:
        return whole.select(*columns)
    # Over all ids of all documents. One row per token id: as many as the vocabulary has, whatever the corpus.
    size = counted.agg(F.sum("length").alias("n"), F.sum("doc_tokens").alias("tokens")).first()
    counts = counted.select("ids").mapInArrow(_frequencies, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.array([(r["id"], r["n"]) for r in counts.collect()], np.int64)
    frequencies = np.zeros(int(counts[:, 0].max()) + 1, np.int64)
    frequencies[counts[:, 0]] = counts[:, 1]
    context = docs.sparkSession.sparkContext
    statistics = context.broadcast(Statistics(size["n"], size["tokens"] / size["n"], frequencies))
    if held > shard_tokens:
        dealt = _deal(space, rests, statistics, shard_tokens, name)
    else:
        dealt = rests.withColumn("shard", F.lit(0).cast("long"))
    packed = dealt.groupBy("shard").applyInArrow(_fill(statistics, with_ids), PIECE)
    return whole.select(*columns).unionAll(packed.select(*columns))
