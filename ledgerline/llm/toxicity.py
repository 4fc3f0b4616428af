"""Toxicity by a chain of linear classifiers.

Each link of the chain predicts one category from the words of a text and the probabilities of the categories before it.
A later link is trained on out-of-fold probabilities, those of models that did not see the document, so it learns
how far to trust them. Fitting takes a bounded sample of labelled documents; scoring reads every text whole and is one
pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import free_name, narrow

#: Labelled documents used for fitting, about: more are thinned out by a hash of their id.
SAMPLE_ROWS = 20_000
#: Features kept for each category, the documents one must be in, and folds.
FEATURES, LEAST, FOLDS = 500, 3, 3
STEPS, RATE, RIDGE = 80, 0.5, 1e-5
THRESHOLD = 0.5
#: Texts whose features a worker holds at a time.
TEXTS = 500
#: Long words also count by how they begin.
STEMS = (4, 5)

#: The chain: first whether anything is wrong, then what.
CATEGORIES: tuple[tuple[str, Column | str], ...] = (
    ("objectionable", "toxic = 1 OR quality = 0"),
    ("low_quality", "quality = 0"),
    ("toxic", "toxic = 1"),
)

_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]{2,}|[|#*$%&<>]")


def features(text: str | None) -> set[str]:
    """Words in lower case, beginnings of longer ones, and runs of marks, each once."""
    words = set(_TOKEN.findall((text or "").lower()))
    for n in STEMS:
        words |= {w[:n] + "~" for w in words if len(w) > n and w[-1] != "~"}
    return words


@dataclass(frozen=True)
class Chain:
    """Feature numbers, and for each category its weights: features, earlier categories, constant."""

    names: tuple[str, ...]
    vocabulary: dict[str, int]
    weights: tuple[np.ndarray, ...]

    def rows(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the features of each text, one text after the other, and their counts."""
        known = self.vocabulary
        found = [np.array([known[f] for f in sorted(known.keys() & features(t))], np.int32) for t in texts]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.concatenate([np.empty(0, np.int32), *found]), counts

    def predict(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        known = np.empty((len(counts), 0))
        for weights in self.weights:
            known = np.column_stack([known, _probability(numbers, counts, known, weights)])
        return known


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    upto = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


def _probability(numbers: np.ndarray, counts: np.ndarray, known: np.ndarray, weights: np.ndarray) -> np.ndarray:
    n = len(weights) - known.shape[1] - 1
    score = _sums(weights[numbers], counts) + known @ weights[n:-1] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def _fit(numbers: np.ndarray, counts: np.ndarray, known: np.ndarray, truth: np.ndarray, size: int) -> np.ndarray:
    """Ridge logistic regression by gradient steps scaled for each weight."""
    weights = np.zeros(size + known.shape[1] + 1)
    positive = float(truth.sum())
    if not 0 < positive < len(truth):
        weights[-1] = 30.0 if len(truth) and positive else -30.0
        return weights
    weights[-1] = np.log(positive / (len(truth) - positive))
    scale = np.full(len(weights), 1e-12)
    for _ in range(STEPS):
        error = _probability(numbers, counts, known, weights) - truth
        gradient = np.empty(len(weights))
        gradient[:size] = np.bincount(numbers, np.repeat(error, counts), size)
        gradient[size:-1] = known.T @ error
        gradient[-1] = error.sum()
        gradient = gradient / len(truth) + RIDGE * weights
        scale += gradient**2
        weights -= RATE * gradient / np.sqrt(scale)
    return weights


def _take(numbers: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return numbers[np.repeat(rows, counts)], counts[rows]


def fit_chain(names: Sequence[str], vocabulary: dict[str, int], numbers, counts, truth: np.ndarray) -> Chain:
    """A chain from sparse rows. ``truth`` has a column per category; NaN leaves a row out of that link."""
    fold = np.arange(len(counts)) % FOLDS
    known, weights = np.empty((len(counts), 0)), []
    for k in range(len(names)):
        told = ~np.isnan(truth[:, k])
        weights.append(_fit(*_take(numbers, counts, told), known[told], truth[told, k], len(vocabulary)))
        unseen = np.empty(len(counts))
        for f in range(FOLDS):
            others = told & (fold != f)
            model = _fit(*_take(numbers, counts, others), known[others], truth[others, k], len(vocabulary))
            unseen[fold == f] = _probability(*_take(numbers, counts, fold == f), known[fold == f], model)
        known = np.column_stack([known, unseen])
    return Chain(tuple(names), vocabulary, tuple(weights))


def _explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in (b.iloc[i : i + TEXTS] for b in batches for i in range(0, len(b), TEXTS)):
        columns = {c: [] for c in ("feature", *batch.columns.drop("text"))}
        for row in batch.itertuples(index=False):
            found = features(row.text)
            columns["feature"].extend(found)
            for c in list(columns)[1:]:
                columns[c].extend([getattr(row, c)] * len(found))
        yield pd.DataFrame(columns)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[tuple[str, Column | str]] = CATEGORIES,
    sample_rows: int = SAMPLE_ROWS,
) -> Chain:
    """A chain for ``categories``, pairs of a name and a condition on the columns of ``labels``.

    Labels without a document, documents without a label and null ids are not used; a null condition leaves the row
    out of its link; a category that the sample has only one side of is predicted as that side. About ``sample_rows``
    labels are used, chosen by a hash of the id; their documents alone are read for fitting.
    """
    names = [n for n, _ in categories]
    sides = [(F.expr(c) if isinstance(c, str) else c).cast("double").alias(f"y{i}") for i, (_, c) in enumerate(categories)]
    told = labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), *sides)
    # One label for each id, the largest in each category.
    ys = [f"y{i}" for i in range(len(names))]
    told = told.groupBy("doc_id").agg(*(F.max(y).alias(y) for y in ys))
    total = told.count()
    if total > sample_rows:
        share = int(sample_rows / total * (1 << 32))
        told = told.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 32)) < share)
    texts = narrow(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # About sample_rows short rows.
    sample = texts.join(F.broadcast(told), "doc_id")
    exploded = sample.select("text", *ys).mapInPandas(_explode, "feature string, " + ", ".join(f"{y} double" for y in ys))
    counted = exploded.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(y).alias(y) for y in ys), *(F.count(y).alias(f"n{y}") for y in ys)
    )
    sums = sample.agg(*(F.sum(y).alias(y) for y in ys), *(F.count(y).alias(f"n{y}") for y in ys)).first()
    chosen: set[str] = set()
    common = counted.where(F.col("n") >= LEAST).persist()
    for y in ys:
        rows, positive = sums[f"n{y}"] or 0, sums[y] or 0.0
        if not 0 < positive < rows:
            continue
        # Chi-square of having the feature against the category.
        a, b = F.col(y), F.col(f"n{y}") - F.col(y)
        c, d = F.lit(positive) - a, F.lit(rows - positive) - b
        square = (a * d - b * c) ** 2 / ((a + b) * (c + d + 1))
        best = common.orderBy(F.desc(square), "feature").limit(FEATURES).select("feature")
        chosen.update(r["feature"] for r in best.collect())
    common.unpersist()
    vocabulary = {f: i for i, f in enumerate(sorted(chosen))}
    empty = Chain(tuple(names), vocabulary, ())

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            numbers, counts = empty.rows(batch["text"].tolist())
            yield batch.drop(columns="text").assign(numbers=np.split(numbers, np.cumsum(counts)[:-1]))

    schema = "doc_id long, " + ", ".join(f"{y} double" for y in ys) + ", numbers array<int>"
    rows = sample.select("doc_id", *ys, "text").mapInPandas(numbered, schema)
    # The bounded sample: a few numbers for each document.
    rows = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["numbers"]))
    counts = np.array([len(r["numbers"]) for r in rows], np.int64)
    numbers = np.concatenate([np.empty(0, np.int64), *(np.array(r["numbers"], np.int64) for r in rows)])
    truth = np.array([[r[y] for y in ys] for r in rows], float).reshape(len(rows), len(ys))
    return fit_chain(names, vocabulary, numbers, counts, truth)


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """``docs`` with one struct column ``toxicity``: the probability of each category.

    Null and empty texts get the probabilities of a text without known words. Rows are scored alone; other columns stay
    as they are. An empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    fields = ", ".join(f"`{n}`: double" for n in chain.names)

    @F.arrow_udf(f"struct<{fields}>")
    def probabilities(texts: pa.Array) -> pa.Array:
        model = shared.value
        # Few texts at a time become Python's; the others stay in the batch that came.
        parts = [model.rows(texts.slice(i, TEXTS).to_pylist()) for i in range(0, max(len(texts), 1), TEXTS)]
        found = model.predict(*(np.concatenate(x) for x in zip(*parts)))
        # Workers stay for the next step; what batches before this one took need not.
        pa.default_memory_pool().release_unused()
        return pa.StructArray.from_arrays([pa.array(p) for p in found.T], list(model.names))

    names = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(*names, probabilities(F.col(f"`{text}`")).alias(free_name(docs.columns, "toxicity")))


def keep_clean(docs: DataFrame, labels: DataFrame, category: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose probability of ``category`` stays below ``threshold``."""
    scored = score(docs, train(docs, labels))
    kept = scored.where(F.col(f"{scored.columns[-1]}.{category}") < threshold)
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
