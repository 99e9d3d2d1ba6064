"""Log-probability of whole documents by a recurrent model of the corpus.

Word counts of all training documents come first. The most frequent words become a
dictionary of bounded size, and of these the first become head words of the model. The other
words of the dictionary fall into bands by the kind of document that they are most often in,
where the kind is told by the most frequent words, as the articles of a language tell the
language; all rarer or unseen words make one more band. All training documents then train the
model, in rounds: every task trains a copy on its documents, and the copies are averaged.
Scoring takes each document from its first token to its end, with the state carried across
windows. Within a band a word has its share of the band's counts; for words outside the
dictionary these counts are joined, so that nothing that grows with the vocabulary is
broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.gru import Model, Shape, initial, train
from orderloom.llm.tables import Scratch, settings

# A document ends with this token, which no word can be.
END = b""
# Words that a task counts before it hands them on.
MOST_COUNTED = 500_000
# Tokens that a task holds. Long documents outlast the others that are scored with them,
# so it is better to score many together.
TRAINED_AT_ONCE = 1 << 21
SCORED_AT_ONCE = 1 << 22
TEXTS_PER_BATCH = "500"
# Averaging deals the parameters out in pieces of this many, counting bands the words.
PIECE = 4096
# A task that counts bands sends counts of all words on, so it takes many tokens.
BANDED_AT_ONCE = 50_000_000
# How the places of words in the dictionary are stored.
_WORD = "<u4"
LN10 = math.log(10)

Batches = Iterable[pa.RecordBatch]
Task = Callable[[Batches], Iterator[pa.RecordBatch]]


@dataclass(frozen=True)
class Plan:
    """Sizes of the model and how it is trained.

    ``dictionary`` bounds the words that tasks know by heart, each of at most
    ``longest`` bytes and seen at least twice. Training passes over all training
    documents once, in ``rounds`` parts; small corpora are passed over up to
    ``most_passes`` times, until ``least_tokens`` have been seen.
    """

    dictionary: int = 200_000
    longest: int = 64
    head_words: int = 512
    kinds: int = 16
    hidden: int = 16
    rounds: int = 6
    most_passes: int = 6
    least_tokens: int = 2_000_000
    rate: float = 0.01
    seed: int = 7

    def passes(self, tokens: int) -> int:
        return max(1, min(self.most_passes, -(-self.least_tokens // max(1, tokens))))


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words between white space, A-Z lower-cased, in UTF-8, and the end of the document."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _counted(batches: Batches) -> Iterator[pa.RecordBatch]:
    def batch() -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    counts: Counter[bytes] = Counter()
    for rows in batches:
        for text in _bytes(rows.column(0)):
            counts.update(tokens_of(text))
        if len(counts) >= MOST_COUNTED:
            yield batch()
            counts.clear()
    yield batch()


def count_tokens(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """word (UTF-8) and n, over all texts."""
    with settings(texts.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        counts = texts.mapInArrow(_counted, "word binary, n long")
        return scratch.write(counts.groupBy("word").agg(F.sum("n").alias("n")), "counts")


@dataclass(frozen=True)
class Vocabulary:
    """The words that tasks know. The first is the end of a document; the others follow by
    count. ``counts`` and ``base`` hold their counts and the log10 probability of the
    smoothed counts, and 0 for any other word in the last place. ``tokens`` and
    ``distinct`` are those of all training documents."""

    blob: bytes
    counts: np.ndarray
    base: np.ndarray
    tokens: int
    distinct: int

    @property
    def size(self) -> int:
        return len(self.counts) - 1

    def index(self) -> dict[bytes, int]:
        return {word: i for i, word in enumerate([END, *self.blob.split()])}


@dataclass(frozen=True)
class Symbols:
    """What the model sees of words: ``symbol`` by the word's place in the dictionary, and the
    log10 probability ``inside`` the symbol; the last place is for all other words, whose
    smoothed counts add up to ``outside``."""

    shape: Shape
    symbol: np.ndarray
    inside: np.ndarray
    counts: np.ndarray
    outside: int


def build_vocabulary(counts: DataFrame, plan: Plan) -> Vocabulary:
    """Choose the dictionary by a bound on counts that leaves few enough words."""
    total = counts.agg(F.sum("n"), F.count(F.lit(1)), F.max(F.when(F.col("word") == END, F.col("n")))).first()
    tokens, distinct, ends = (int(x or 0) for x in total)
    able = counts.where((F.col("n") >= 2) & (F.col("word") != END) & (F.octet_length("word") <= plan.longest))
    # Steps of 1/64 in the logarithm: exact for small counts, and never many.
    step = F.floor(F.ln("n") * 64)
    chosen, least = 0, None
    for row in able.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect():
        chosen += row["words"]
        if chosen >= plan.dictionary:
            break
        least = row["step"]
    few = able.where(step >= least) if least is not None else able.limit(0)
    table = few.toArrow()
    found = sorted(zip(_bytes(table["word"].combine_chunks()), table["n"].to_pylist(), strict=True), key=lambda e: (-e[1], e[0]))
    n = np.array([ends, *(count for _, count in found)], float)
    base = np.log10((n + 1) / (tokens + distinct + 1))
    return Vocabulary(b" ".join(word for word, _ in found), np.append(n, 0.0), np.append(base, 0.0), tokens, distinct)


def make_symbols(known: Vocabulary, kinds: np.ndarray, plan: Plan) -> Symbols:
    """Head words are symbols of their own; of the others those of one kind are one."""
    n, head = known.counts[:-1], min(plan.head_words, known.size)
    symbol = np.concatenate([np.arange(head), head + kinds[head:], [head + plan.kinds + 1]]).astype(np.int32)
    shape = Shape(head, plan.kinds + 2, hidden=plan.hidden, embedded=plan.hidden)
    counts = np.bincount(symbol[:-1], weights=n, minlength=shape.symbols)
    words = np.bincount(symbol[:-1], minlength=shape.symbols)
    counts[-1] = known.tokens - n.sum()
    inside = np.log10((n + 1) / (counts + words)[symbol[:-1]])
    inside[:head] = 0
    outside = int(counts[-1]) + known.distinct - known.size + int(n[0] == 0) + 1
    return Symbols(shape, symbol, np.append(inside, 0.0), counts, outside)


_ENCODED = "n_tokens long, known long, base double, kind int, ids binary, words array<binary>, times array<long>"


def _encoded(vocabulary, marks: int) -> Task:
    """Each document as places of its words in the dictionary, with the sums over those, its
    kind, and its other words. The kind is the one of the ``marks`` most frequent words that
    is there most often by its usual share, or one more where none is."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        index, other, is_known = known.index(), known.size, known.counts > 0
        usual = known.counts[1 : min(marks, other - 1) + 1]
        for rows in batches:
            columns: list[list] = [[] for _ in range(7)]
            for text in _bytes(rows.column(rows.num_columns - 1)):
                tokens = tokens_of(text)
                at = np.fromiter(map(index.get, tokens, repeat(other)), np.int64, len(tokens))
                rare = Counter(tokens[i] for i in np.flatnonzero(at == other))
                often = np.bincount(at[at <= len(usual)], minlength=len(usual) + 1)[1:]
                kind = int(np.argmax(often / usual)) if often.any() else marks
                values = (
                    len(at), int(is_known[at].sum()), float(known.base[at].sum()), kind,
                    at.astype(_WORD).tobytes(), list(rare), list(rare.values()),
                )
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            made = [pa.array(c, type_) for c, type_ in zip(columns, types, strict=True)]
            names = [f.split(" ")[0] for f in _ENCODED.split(", ")]
            own = rows.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in range(len(own))), *made], [*own, *names])

    return run


def _by_kind(words: int, kinds: int) -> Task:
    """How often each word of the dictionary is in documents of each kind, in pieces."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((words + 1, kinds), np.uint32)
        for rows in batches:
            for kind, ids in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                place, times = np.unique(np.frombuffer(ids, _WORD), return_counts=True)
                counts[place, kind] += times.astype(np.uint32)
        if counts.any():
            pieces = range(0, words, PIECE)
            values = [counts[i : min(i + PIECE, words)].tobytes() for i in pieces]
            yield pa.RecordBatch.from_arrays([pa.array([i // PIECE for i in pieces], pa.int32()), pa.array(values, pa.binary())], ["piece", "counts"])

    return run


def _most_often(kinds: int) -> Callable[[tuple, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The kind in which each word of a piece is most often, over all tasks."""

    def run(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | int = 0
        for rows in pieces:
            for counts in rows["counts"].to_pylist():
                total = total + np.frombuffer(counts, np.uint32).reshape(-1, kinds).astype(np.int64)
        best = total.argmax(1).astype("<u2").tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([best], pa.binary())], ["piece", "kinds"])

    return run


def kinds_of_words(encoded: DataFrame, known: Vocabulary, plan: Plan) -> np.ndarray:
    """The kind of document in which each word of the dictionary is most often, in training."""
    tasks = max(encoded.sparkSession.sparkContext.defaultParallelism, known.tokens // BANDED_AT_ONCE)
    kinds = plan.kinds + 1
    counted = encoded.where("part > 0").select("kind", "ids").coalesce(tasks).mapInArrow(
        _by_kind(known.size, kinds), "piece int, counts binary"
    )
    best = counted.groupBy("piece").applyInArrow(_most_often(kinds), "piece int, kinds binary").collect()
    found = np.zeros(known.size, np.int64)
    for row in best:
        own = np.frombuffer(row["kinds"], "<u2")
        found[row["piece"] * PIECE : row["piece"] * PIECE + len(own)] = own
    return found


def _documents(batches: Batches, place: int, most: int) -> Iterator[tuple[pa.Table, list[np.ndarray]]]:
    """Rows with their words, about ``most`` words at a time."""
    held, docs, tokens = [], [], 0
    for rows in batches:
        held.append(rows)
        new = [np.frombuffer(s, _WORD) for s in rows.column(place).to_pylist()]
        docs += new
        tokens += sum(map(len, new))
        if tokens >= most:
            yield pa.Table.from_batches(held), docs
            held, docs, tokens = [], [], 0
    if docs:
        yield pa.Table.from_batches(held), docs


def _trained(start, shared, rate: float) -> Task:
    """The parameters that a task's documents lead to, in pieces, with their tokens."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        shape, symbol = shared.value.shape, shared.value.symbol
        model, tokens = Model(shape, start.value.copy()), 0
        for _, docs in _documents(batches, 0, TRAINED_AT_ONCE):
            train(model, [symbol[ids] for ids in docs], rate)
            tokens += sum(map(len, docs))
        if tokens:
            pieces = [model.flat[i : i + PIECE] for i in range(0, shape.size, PIECE)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(pieces)), pa.int32()),
                    pa.array([tokens] * len(pieces), pa.int64()),
                    pa.array([p.astype("<f4").tobytes() for p in pieces], pa.binary()),
                ],
                ["piece", "tokens", "values"],
            )

    return run


def _averaged(key: tuple, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One piece of the parameters, averaged over the tasks by their tokens."""
    total, weight = 0.0, 0
    for rows in pieces:
        for tokens, values in zip(rows["tokens"].to_pylist(), rows["values"].to_pylist(), strict=True):
            total, weight = total + tokens * np.frombuffer(values, "<f4").astype(float), weight + tokens
    mean = (total / weight).astype("<f4").tobytes()
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([mean], pa.binary())], ["piece", "values"])


def fit(encoded: DataFrame, shared, tokens: int, plan: Plan) -> Model:
    """Train on all documents of the parts 1 to ``rounds``; only the parameters, whose
    number the plan bounds, come to the driver."""
    spark, shape = encoded.sparkSession, shared.value.shape
    model = Model(shape, initial(shape, shared.value.counts, plan.seed))
    passes = plan.passes(tokens)
    for turn in range(passes * plan.rounds):
        rate = plan.rate * (1.1 - turn / (passes * plan.rounds))
        start = spark.sparkContext.broadcast(model.flat)
        part = encoded.where(F.col("part") == 1 + turn % plan.rounds).select("ids")
        pieces = part.mapInArrow(_trained(start, shared, rate), "piece int, tokens long, values binary")
        means = pieces.groupBy("piece").applyInArrow(_averaged, "piece int, values binary").collect()
        if means:
            model = Model(shape, np.frombuffer(b"".join(r["values"] for r in sorted(means)), "<f4").copy())
        start.destroy()
    return model


def _scored(model, shared) -> Task:
    """The model's log10 probability of each document's symbols, and that of its words inside them."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        known = shared.value
        scorer = Model(known.shape, model.value)
        for table, docs in _documents(batches, 1, SCORED_AT_ONCE):
            scores = scorer.score([known.symbol[ids] for ids in docs]) / LN10
            inside = np.fromiter((known.inside[ids].sum() for ids in docs), float, len(docs))
            yield pa.RecordBatch.from_arrays([table["row"].combine_chunks(), pa.array(scores + inside)], ["row", "model"])

    return run


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """A null doc_id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def score_documents(docs: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score, both log10 of the probability of the whole text.

    A null or empty text is only its end. Repeated rows and rows that share an id are
    learned from and scored each. Without training documents all counts are 0, and the model
    is the initial one. A word never seen in training has the last band's share of
    one unseen word. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    docs = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    counts = count_tokens(docs.where(~F.col("held_out")).select("text"), scratch)
    vocabulary = build_vocabulary(counts, plan)

    vocabulary_there = spark.sparkContext.broadcast(vocabulary)
    # Which part a document trains in follows from its place, once its row is written.
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    part = F.when(F.col("held_out"), 0).otherwise(1 + F.pmod(F.xxhash64("row"), F.lit(plan.rounds))).cast("int")
    given = numbered.select("row", "doc_id", "held_out", part.alias("part"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, held_out boolean, part int, {_ENCODED}"
    path = scratch.path("encoded")
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        encode = _encoded(vocabulary_there, plan.kinds)
        given.mapInArrow(encode, schema).write.partitionBy("part").parquet(path)
        vocabulary_there.destroy()
        encoded = spark.read.schema(schema).parquet(path)
        symbols = make_symbols(vocabulary, kinds_of_words(encoded, vocabulary, plan), plan)
    shared = spark.sparkContext.broadcast(symbols)

    all_tokens = encoded.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    trained = spark.sparkContext.broadcast(fit(encoded, shared, vocabulary.tokens, plan).flat)
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        tasks = max(spark.sparkContext.defaultParallelism, all_tokens // SCORED_AT_ONCE)
        scores = encoded.select("row", "ids").coalesce(tasks).mapInArrow(_scored(trained, shared), "row long, model double")
        scores = scratch.write(scores, "scores")
    trained.destroy()
    shared.destroy()

    others = encoded.select("row", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times"))))
    weighed = others.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    smoothed = F.col("n") + 1

    def per_row(value: Column, name: str) -> Column:
        return F.sum(F.col("times") * value).alias(name)

    outside = weighed.groupBy("row").agg(
        per_row((F.col("n") > 0).cast("long"), "more_known"),
        per_row(F.log10(smoothed / F.lit(vocabulary.tokens + vocabulary.distinct + 1)), "more_base"),
        per_row(F.log10(smoothed / F.lit(symbols.outside)), "more_inside"),
    )
    rows = encoded.select("row", "doc_id", "held_out", "n_tokens", "known", "base")

    def added(name: str, more: str) -> Column:
        return F.col(name) + F.coalesce(more, F.lit(0))

    return (
        rows.join(scores, "row")
        .join(outside, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            added("known", "more_known").alias("n_known"),
            F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
            added("base", "more_base").alias("base_score"),
            added("model", "more_inside").alias("score"),
        )
    )
