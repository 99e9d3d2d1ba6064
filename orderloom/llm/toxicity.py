"""Toxicity by a factorization machine over hashed terms.

Next to a weight per term the machine learns a short factor per term, and the
product of two factors is the weight of the pair: an insult together with the
mention of a group may count for more than both alone.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import Scratch, settings

WORD = re.compile(r"[^\W_]+")
HASH_BITS = 24
PREFIXES = (3, 4, 5, 6)

# Words whose terms a worker remembers.
MOST_WORDS = 1 << 16
TEXTS_PER_BATCH = "1000"
TEXTS_AT_ONCE = 256


@dataclass(frozen=True)
class Fit:
    """How the model is fitted.

    ``rows`` bounds the labelled documents that are learned from (about that many,
    taken by a hash of doc_id). Terms in enough of these documents can get parameters:
    the ``tied`` ones that are most tied to the label by themselves, by ``least_tie``
    standard deviations at least, and the ``frequent`` ones that tell most documents
    apart, whatever their own tie, since a term may count only together with another.
    Those of the second kind alone are held back by ``untied_decay``.
    """

    rows: int = 20_000
    tied: int = 4096
    least_tie: float = 3.0
    frequent: int = 1024
    factors: int = 8
    steps: int = 2000
    batch: int = 256
    rate: float = 0.1
    decay: float = 1e-5
    untied_decay: float = 1e-3
    seed: int = 7

    def least_documents(self, rows: int) -> int:
        return max(3, min(10, rows // 500))


def _hash(term: str) -> int:
    return zlib.crc32(term.encode()) & ((1 << HASH_BITS) - 1)


def word_terms(word: str) -> list[int]:
    """The hashed terms of a word: itself, and how it begins."""
    return [_hash(word), *(_hash(f"<{word[:n]}") for n in PREFIXES if len(word) > n)]


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


@dataclass(frozen=True)
class Model:
    terms: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def scores(self, columns: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
        """``columns[i]`` is a term of document ``doc[i]``; each pair appears once."""
        return _sigmoid(_margin(self.bias, self.weights, self.factors, columns, doc, docs)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _margin(bias, weights, factors, columns, doc, docs):
    """Score before the sigmoid, and the sum of factors, for each document."""
    linear = np.bincount(doc, weights=weights[columns], minlength=docs)
    own = factors[columns]
    sums = np.stack([np.bincount(doc, weights=f, minlength=docs) for f in own.T], 1)
    squares = np.bincount(doc, weights=(own**2).sum(1), minlength=docs)
    return bias + linear + 0.5 * ((sums**2).sum(1) - squares), sums


def train(
    terms: np.ndarray, columns: np.ndarray, doc: np.ndarray, labels: np.ndarray, tied: np.ndarray, fit: Fit
) -> Model:
    """First the terms that are ``tied`` to the label alone, then all of them from there on,
    so that the others explain what is left."""
    rng = np.random.default_rng(fit.seed)
    docs, toxic = len(labels), float(labels.sum())
    bias = math.log((toxic + 0.5) / (docs - toxic + 0.5))
    if not 0 < toxic < docs or not len(terms):
        return Model(terms, np.zeros(len(terms)), np.zeros((len(terms), fit.factors)), bias)
    model = Model(terms, np.zeros(len(terms)), rng.normal(0, 0.01, (len(terms), fit.factors)), bias)
    decay = np.where(tied, fit.decay, fit.untied_decay)
    own = tied[columns]
    if own.any():
        model = _descend(model, columns[own], doc[own], labels, decay, fit.steps, fit, rng)
    if not own.all():
        model = _descend(model, columns, doc, labels, decay, fit.steps // 2, fit, rng)
    return model


def _descend(
    model: Model,
    columns: np.ndarray,
    doc: np.ndarray,
    labels: np.ndarray,
    decay: np.ndarray,
    steps: int,
    fit: Fit,
    rng: np.random.Generator,
) -> Model:
    """AdaGrad on the logistic loss, with a decay per term. ``doc`` is sorted."""
    docs, bias = len(labels), model.bias
    weights, factors = model.weights.copy(), model.factors.copy()
    seen_b, seen_w, seen_f = 1e-6, np.full(len(weights), 1e-6), np.full(factors.shape, 1e-6)
    first = np.searchsorted(doc, np.arange(docs + 1))
    order, at = rng.permutation(docs), 0
    for _ in range(steps):
        if at >= docs:
            order, at = rng.permutation(docs), 0
        some = order[at : at + fit.batch]
        at += fit.batch
        lengths = first[some + 1] - first[some]
        rows = np.repeat(first[some] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        col, row = columns[rows], np.repeat(np.arange(len(some)), lengths)
        margin, sums = _margin(bias, weights, factors, col, row, len(some))
        slope = (_sigmoid(margin) - labels[some]) / len(some)
        used, place = np.unique(col, return_inverse=True)
        pull = slope[row]
        step = np.bincount(place, weights=pull, minlength=len(used)) + decay[used] * weights[used]
        seen_w[used] += step**2
        weights[used] -= fit.rate * step / np.sqrt(seen_w[used])
        pull = pull[:, None] * (sums[row] - factors[col])
        step = np.stack([np.bincount(place, weights=p, minlength=len(used)) for p in pull.T], 1)
        step += 10 * decay[used, None] * factors[used]
        seen_f[used] += step**2
        factors[used] -= 0.2 * fit.rate * step / np.sqrt(seen_f[used])
        step = slope.sum()
        seen_b += step**2
        bias -= fit.rate * step / math.sqrt(seen_b)
    return Model(model.terms, weights, factors, float(bias))


def _terms(text: str | None) -> np.ndarray:
    """In four bytes each, as a batch has many."""
    return np.array(sorted({t for w in words(text) for t in word_terms(w)}), np.int32)


def _term_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            some = batch.slice(at, TEXTS_AT_ONCE)
            lists = [_terms(text) for text in some.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(lists, pa.list_(pa.int32()))], ["toxic", "terms"])


def _place_type(chosen: np.ndarray) -> tuple[type, str]:
    """The driver gets places of terms, so they are as short as their number allows."""
    return (np.int16, "smallint") if len(chosen) < 1 << 15 else (np.int32, "int")


def _places(chosen: np.ndarray):
    """The terms of each row that are among the chosen ones, by their places there, ascending."""
    kind, _ = _place_type(chosen)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("terms")
            terms = lists.flatten().to_numpy()
            place = np.searchsorted(chosen, terms)
            known = np.append(chosen, -1)[place] == terms
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())[known]
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(ends), pa.array(place[known].astype(kind)))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), places], ["toxic", "places"])

    return run


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Fit on labelled documents that are not held out.

    ``labels`` has doc_id and toxic; a document labelled more than once is toxic if
    any label says so, and null labels do not count. With labels of one kind only,
    or none, the model knows the prior alone.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    total = known.count()
    share = min(1.0, fit.rows / max(1, total))
    few = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    # About fit.rows narrow rows, whatever the number of documents.
    texts = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("toxic", "text")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        lists = scratch.write(texts.mapInArrow(_term_lists, "toxic int, terms array<int>"), "terms")

    size = lists.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    rows, prior = size["n"], size["toxic"] / max(1, size["n"])
    per_term = lists.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")
    )
    tie = F.abs(F.col("toxic") - F.col("n") * prior) / F.sqrt(F.col("n") * (prior * (1 - prior) + 1e-9))
    splits = F.col("n") * (rows - F.col("n"))
    able = scratch.write(per_term.where(F.col("n") >= fit.least_documents(rows)), "per-term")
    tied = {r["term"] for r in able.where(tie >= fit.least_tie).orderBy(tie.desc(), "term").limit(fit.tied).collect()}
    frequent = {r["term"] for r in able.orderBy(splits.desc(), "term").limit(fit.frequent).collect()}
    chosen = np.array(sorted(tied | frequent), np.int64)
    is_tied = np.isin(chosen, sorted(tied))

    kind, spark_kind = _place_type(chosen)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        table = lists.mapInArrow(_places(chosen), f"toxic int, places array<{spark_kind}>").toArrow()
    labels, lists = table["toxic"].to_numpy().astype(float), table["places"].combine_chunks()
    flat, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    ends = np.cumsum(lengths)
    each = [flat[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
    # The same order in every run, whatever the order of tasks.
    order = sorted(range(len(each)), key=lambda i: (labels[i], each[i].astype(">i4").tobytes()))
    order = np.array(order, np.int64)
    columns = np.concatenate([np.empty(0, kind), *(each[i] for i in order)])
    doc = np.repeat(np.arange(len(order), dtype=np.int32), lengths[order])
    del table, lists, flat, each
    return train(chosen, columns, doc, labels[order], is_tied, fit)


class Scorer:
    """Scores texts in batches; each task has its own."""

    def __init__(self, model: Model):
        self.model = model
        self.column = {int(t): i for i, t in enumerate(model.terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def _columns(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MOST_WORDS:
                self.known.clear()
            found = tuple(self.column[t] for t in word_terms(word) if t in self.column)
            self.known[word] = found
        return found

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Some texts at a time, as each has a set of its terms."""
        parts = [self._scores(texts[at : at + TEXTS_AT_ONCE]) for at in range(0, len(texts), TEXTS_AT_ONCE)]
        return np.concatenate([np.empty(0), *parts])

    def _scores(self, texts: list[str | None]) -> np.ndarray:
        found = [{c for w in words(text) for c in self._columns(w)} for text in texts]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        columns = np.fromiter((c for f in found for c in f), np.int64, int(lengths.sum()))
        return self.model.scores(columns, np.repeat(np.arange(len(found)), lengths), len(found))


def toxicity(model: Model) -> Column:
    """The score of a text column as a Spark expression, 0 to 1."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series(scorer(texts.tolist()), index=texts.index)

    return score(F.col("text"))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only the whole text is scored; null counts as empty, and an empty text, or one
    without known terms, has the score of the bias. Equal texts have equal scores,
    repeated rows are scored each, an empty table gives no rows, and other columns
    are ignored.
    """
    spark = docs.sparkSession
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(model).alias("score"))
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        scored = Scratch(spark, "toxicity").write(scored, "scores")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not find toxic, with all their columns.

    They are written, as the size of the batches that are scored must hold until then.
    """
    spark, columns = docs.sparkSession, docs.columns
    scored = docs.withColumn("_toxicity", toxicity(learn(docs, labels)))
    kept = scored.where(F.col("_toxicity") < 0.5).select(*(F.col(f"`{c}`") for c in columns))
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        return Scratch(spark, "toxicity").write(kept, "kept")
