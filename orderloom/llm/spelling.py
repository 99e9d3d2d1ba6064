"""Spelling variants grouped below the form that is written most.

Letters are hashed to a few symbols. Each reduced word gets its full neighbourhood of
one edit in that small alphabet, the neighbourhoods are joined with the reduced
vocabulary, and what meets there is verified on the original strings. Words one edit
apart reduce to words at most one edit apart, so no link is lost, and a neighbourhood
grows with the few symbols instead of the letters of all languages.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.tables import Scratch, settings

# The letters that words are made of, by code point.
LETTERS = "A-Za-zÀ-ÿ"
# Words that a task counts before it hands them on.
MOST_COUNTED = 500_000
# Neighbours that a task makes at once.
MOST_KEYS = 1 << 21
FEWEST_SYMBOLS = 4
TEXTS_PER_BATCH = "1000"

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _counted(least: int, damage_every: int | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # Shorter runs cannot become words, also not by losing a letter.
    runs = re.compile(f"[{LETTERS}]{{{least},}}")

    def batch(counts: dict[bytes, int]) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for rows in batches:
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{doc or ''}:".encode())
                for found, n in Counter(runs.findall(text or "")).items():
                    word = found.encode().lower()
                    if damage_every:
                        mark = zlib.crc32(word, start)
                        if mark % damage_every == 0:
                            letters = word.decode()
                            at = mark % len(letters)
                            word = (letters[:at] + letters[at + 1 :]).encode()
                    counts[word] = counts.get(word, 0) + n
                if len(counts) >= MOST_COUNTED:
                    yield batch(counts)
                    counts = {}
        yield batch(counts)

    return run


def count_words(
    docs: DataFrame, *, least_length: int = 6, least_count: int = 5, damage_every: int | None = None
) -> DataFrame:
    """word and n of the words in all texts: runs of letters, A-Z lower-cased, long and
    frequent enough.

    ``damage_every`` takes a letter out of one in so many (document, word) pairs, chosen
    by a checksum, which plants misspellings of a known rate. A null text has no words,
    a null doc_id counts as empty, repeated rows count each.
    """
    read = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        counts = read.mapInArrow(_counted(least_length, damage_every), "word string, n long")
        total = counts.groupBy("word").agg(F.sum("n").alias("n"))
        return Scratch(docs.sparkSession, "spelling").write(
            total.where((F.col("n") >= least_count) & (F.char_length("word") >= least_length)), "words"
        )


def symbol_table(symbols: int) -> np.ndarray:
    """The symbol, from 1, of each letter by its code point below 256."""
    letters = np.arange(256, dtype=np.uint64)
    return (1 + ((letters * _BASE) >> np.uint64(40)) % np.uint64(symbols)).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    powers = np.ones(n, np.uint64)
    powers[1:] = _BASE
    return np.multiply.accumulate(powers)


def word_key(reduced: np.ndarray) -> np.ndarray:
    """A number for each row of symbols. Equal words have equal numbers; different ones
    nearly never, and then only meet once more for verification."""
    return (reduced * _powers(reduced.shape[1])).sum(1, dtype=np.uint64)


def neighbour_keys(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """The numbers of all words one edit away from each row, and of the row itself;
    some of them repeatedly."""
    rows, length = reduced.shape
    power = _powers(length + 2)
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    whole = reduced * power[:length]
    before = np.zeros((rows, length + 1), np.uint64)
    np.cumsum(whole, axis=1, out=before[:, 1:])

    def after(shifted: np.ndarray) -> np.ndarray:
        """What the symbols from each place on add, moved by one place."""
        total = np.zeros((rows, length + 1), np.uint64)
        total[:, :length] = np.cumsum(shifted[:, ::-1], axis=1)[:, ::-1]
        return total

    nearer = reduced.copy()
    nearer[:, 1:] *= power[: length - 1]
    nearer[:, :1] = 0
    deleted = before[:, :length] + after(nearer)[:, 1:]
    replaced = (before[:, length :] - whole)[:, :, None] + power[:length, None] * every
    inserted = (before + after(reduced * power[1 : length + 1]))[:, :, None] + power[: length + 1, None] * every
    return np.concatenate([deleted, replaced.reshape(rows, -1), inserted.reshape(rows, -1)], axis=1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the words of one length, with their letters as bytes."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        letters = np.frombuffer("".join(words[i] for i in at).encode("latin-1"), np.uint8)
        yield at, letters.reshape(len(at), length)


def _reduced(symbols: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    table = symbol_table(symbols)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            words = rows.column(0).to_pylist()
            keys, shapes = np.zeros(len(words), np.uint64), [b""] * len(words)
            for at, letters in _by_length(words):
                reduced = table[letters]
                keys[at] = word_key(reduced)
                for i, shape in zip(at, reduced.astype(np.uint8), strict=True):
                    shapes[i] = shape.tobytes()
            columns = [rows.column(0), rows.column(1), pa.array(shapes, pa.binary()), pa.array(keys.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "shape", "key"])

    return run


def _neighbourhoods(symbols: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each reduced word with the numbers of its neighbourhood, each once. Being near
    is mutual, so of two words only that with the smaller number keeps the other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            shapes = rows.column(0).to_pylist()
            for at, letters in _by_length([s.decode("latin-1") for s in shapes]):
                step = max(1, MOST_KEYS // (2 * (letters.shape[1] + 1) * symbols))
                for first in range(0, len(at), step):
                    reduced = letters[first : first + step].astype(np.uint64)
                    keys = np.sort(neighbour_keys(reduced, symbols), axis=1)
                    new = keys >= word_key(reduced)[:, None]
                    new[:, 1:] &= keys[:, 1:] != keys[:, :-1]
                    ends = np.concatenate([[0], np.cumsum(new.sum(1))]).astype(np.int32)
                    near = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[new].view(np.int64)))
                    own = pa.array([shapes[i] for i in at[first : first + step]], pa.binary())
                    yield pa.RecordBatch.from_arrays([own, near], ["shape", "near"])

    return run


def near_words(words: DataFrame, scratch: Scratch, symbols: int) -> DataFrame:
    """Each pair of words (a, b) at one inserted, deleted or replaced letter, once, with
    their counts."""
    reduced = scratch.write(
        words.mapInArrow(_reduced(symbols), "word string, n long, shape binary, key long"), "reduced"
    )
    around = (
        reduced.select("shape")
        .distinct()
        .mapInArrow(_neighbourhoods(symbols), "shape binary, near array<long>")
        .select("shape", F.explode("near").alias("key"))
    )
    met = around.join(reduced.select("key", F.col("word").alias("b"), F.col("n").alias("b_n")), "key")
    own = reduced.select("shape", F.col("key").alias("own"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    # Words of one number meet in both orders; all others in one.
    once = (F.col("own") != F.col("key")) | (F.col("a") < F.col("b"))
    close = (F.levenshtein("a", "b", 1) == 1) & (F.abs(F.char_length("a") - F.char_length("b")) <= 1)
    return met.join(own, "shape").where(once & close).select("a", "a_n", "b", "b_n")


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word and root, for words that have a form. Each round doubles how far a word has
    followed its forms; counts grow along them, so there are few."""
    reached = scratch.write(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = reached.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        last, reached = reached, scratch.write(stepped, "roots")
        if reached.where("moved").isEmpty():
            return reached.drop("moved")
        moved = reached._scratch
        scratch.drop(last)
        reached = reached.drop("moved")
        reached._scratch = moved


def spelling_variants(words: DataFrame, *, ratio: int = 5, symbols: int | None = None) -> DataFrame:
    """Each word with the near word it is a variant of, and the end of that chain.

    ``words`` has word and n, each word once, in letters below code point 256. A word's
    form is its near word of largest n (then the smallest one) if that is at least
    ``ratio`` times as frequent, else null; ``root`` follows forms to the last. ``symbols``
    is the size of the reduced alphabet; by default it grows slowly with the vocabulary, so that
    few words share a reduced one. It changes the work, never the result. An
    empty vocabulary gives no rows; other columns are ignored.
    """
    spark = words.sparkSession
    scratch = Scratch(spark, "spelling")
    words = words.select("word", "n")
    symbols = symbols or max(FEWEST_SYMBOLS, math.ceil(words.count() ** 0.125))
    links = scratch.write(near_words(words, scratch, symbols), "links")
    ways = links.unionByName(
        links.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n"))
    )
    best = ways.groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("rank"), "b", "b_n")).alias("best")
    )
    is_form = F.col("best.b_n") >= ratio * F.col("n")
    described = scratch.write(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.b")).alias("form"),
            F.when(is_form, F.col("best.b_n")).alias("form_n"),
        ),
        "described",
    )
    roots = _roots(described.where("form IS NOT NULL"), scratch)
    return described.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
