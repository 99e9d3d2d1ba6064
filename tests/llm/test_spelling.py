"""Spelling variants against all pairs, and the reduced neighbourhoods against edits by hand."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.brute import damaged, one_edit, spelling, word_counts
from orderloom.llm.spelling import count_words, neighbour_keys, spelling_variants, symbol_table, word_key

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def grouped(spark, counts, **kw):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    result = spelling_variants(words, **kw)
    assert result.columns == COLUMNS
    return sorted(tuple(r) for r in result.collect())


@given(st.lists(st.integers(1, 3), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_the_neighbourhood_is_whole(word):
    made = set(neighbour_keys(np.array([word], np.uint64), 3)[0].tolist())

    def number(w):
        return int(word_key(np.array([w], np.uint64).reshape(1, len(w)))[0])

    edits = [word[:i] + word[i + 1 :] for i in range(len(word))]
    edits += [[*word[:i], s, *word[i + 1 :]] for i in range(len(word)) for s in (1, 2, 3)]
    edits += [[*word[:i], s, *word[i:]] for i in range(len(word) + 1) for s in (1, 2, 3)]
    assert made == {number(w) for w in edits}


def test_letters_become_few_symbols():
    assert set(symbol_table(4)[[ord(c) for c in "abcdefghijklmnopqrstuvwxyzàéßÿ"]].tolist()) == {1, 2, 3, 4}


@pytest.mark.parametrize("symbols", [1, 2, 5, None])
def test_equals_all_pairs_for_any_number_of_symbols(spark, symbols):
    rng = random.Random(3)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(250)}
    counts = {w: rng.choice([5, 6, 25, 26, 125, 700]) for w in sorted(words)}
    assert grouped(spark, counts, symbols=symbols) == spelling(counts)


def test_ties_and_chains(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaaac": 25, "aaaabb": 125, "aaabbb": 626, "zzzzzz": 9, "zzzzzzz": 44}
    rows = {r[0]: r[1:] for r in grouped(spark, counts)}
    assert rows["aaaaaa"] == ("aaaaab", "aaabbb", 5, 2, 25)
    assert rows["aaaaab"] == ("aaaabb", "aaabbb", 25, 3, 125)
    assert rows["aaabbb"] == (None, "aaabbb", 626, 1, None)
    assert rows["zzzzzz"] == (None, "zzzzzz", 9, 1, None)


def test_very_long_words(spark):
    long = "ab" * 3000
    counts = {long: 50, long[:2999] + long[3000:]: 5, long + "x": 6, long + "xx": 7}
    assert grouped(spark, counts) == spelling(counts)


def test_no_words(spark):
    assert grouped(spark, {}) == []
    assert grouped(spark, {"alone!"[:5]: 9}) == [("alone", None, "alone", 9, 0, None)]


def test_words_of_texts(spark):
    docs = [
        (1, "Straße straße ÉCOLE école École times×times÷times abcdef"),
        (1, "abcdef " * 4 + "abcdefg"),
        (None, "Abcdef, ABCDEF; abcdeF_abcdef"),
        (2, None),
        (3, ""),
        (4, "x" * 100_000),
        (5, ("Longer words follow here " * 40_000)),
    ]
    table = spark.createDataFrame([(*d, "word", 1) for d in docs], "doc_id long, text string, word string, n int")
    for every in (2, 199):
        for least_count in (1, 5):
            found = count_words(table, least_count=least_count, damage_every=every)
            assert {r.word: r.n for r in found.collect()} == word_counts(docs, every, least_count=least_count)
    undamaged = {r.word: r.n for r in count_words(table, least_count=1).collect()}
    assert undamaged["abcdef"] == 9 and undamaged["straße"] == 2
    assert count_words(table.limit(0)).collect() == []


def test_damage_takes_one_letter():
    marks = [damaged(doc, "Letters", 3) for doc in range(60)]
    assert {len(m) for m in marks} == {6, 7} and all(m == "letters" or one_edit(m, "letters") for m in marks)
