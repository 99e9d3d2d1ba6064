"""The recurrent model against plain loops and finite differences; the counts against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from orderloom.llm.gru import Model, Shape, initial, train, windows
from orderloom.llm.lm_scoring import Plan, build_vocabulary, count_tokens, make_symbols, score_documents
from orderloom.llm.tables import Scratch

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def some_model(seed=1, head=7, bands=3, width=3, hidden=4):
    shape = Shape(head, bands, width, hidden, hidden)
    model = Model(shape, initial(shape, np.arange(shape.symbols) + 1, seed))
    model.flat += np.random.default_rng(seed).normal(0, 0.2, shape.size).astype(np.float32)
    # The places after the last head word stand for no word.
    model.views["word_bias"][-1, head - (shape.heads - 1) * width :] = -30
    return model


def plain_score(model, doc):
    """One token after the other, and every symbol's probability."""
    v, shape, h, total = model.views, model.shape, np.zeros(model.shape.hidden), 0.0
    size, before = shape.hidden, shape.start
    for symbol in doc:
        gates, back = v["embed"][before] @ v["inward"] + v["gate_bias"], h @ v["onward"]
        z, r = (1 / (1 + np.exp(-(gates + back)[i * size : (i + 1) * size])) for i in (0, 1))
        new = np.tanh(gates[2 * size :] + r * back[2 * size :])
        h = (1 - z) * new + z * h
        classes = np.exp(h @ v["to_class"] + v["class_bias"])
        chance = np.zeros(shape.symbols)
        for s in range(shape.symbols):
            c = int(shape.class_of(np.array([s]))[0])
            chance[s] = classes[c] / classes.sum()
            if s < shape.head_words:
                words = np.exp(h @ v["to_word"][c] + v["word_bias"][c])
                chance[s] *= words[s - c * shape.width] / words.sum()
        assert math.isclose(chance.sum(), 1, rel_tol=1e-4)
        total, before = total + math.log(chance[symbol]), symbol
    return total


def documents(seed, model, lengths):
    rng = np.random.default_rng(seed)
    return [rng.integers(0, model.shape.symbols, n) for n in lengths]


@pytest.mark.parametrize("window", [1, 3, 64])
def test_state_is_carried_across_windows(window):
    model = some_model()
    docs = documents(2, model, [5, 1, 17, 0, 9, 17])
    assert np.allclose(model.score(docs, window), [plain_score(model, d) for d in docs], rtol=1e-4)
    assert model.score([], window).tolist() == []


def test_slopes_equal_finite_differences():
    model = some_model(3)
    docs = documents(4, model, [6, 3, 9, 6])
    inputs, targets, fresh = next(windows(docs, model.shape, 5, 4))
    state = np.random.default_rng(5).normal(0, 0.5, (4, 4)).astype(np.float32)
    _, slope, _ = model.slopes(inputs, targets, fresh, state)
    rng, step = np.random.default_rng(6), 1e-2
    for at in rng.permutation(model.shape.size)[:80]:
        losses = []
        for move in (step, -step):
            changed = Model(model.shape, model.flat.copy())
            changed.flat[at] += np.float32(move)
            losses.append(changed.slopes(inputs, targets, fresh, state)[0])
        assert abs((losses[0] - losses[1]) / (2 * step) - slope[at]) < 0.02 + 0.02 * abs(slope[at])


def test_large_outputs_keep_their_order():
    model = some_model(7)
    model.views["to_class"][...] *= 4000
    found = model.score(documents(8, model, [30]))
    assert np.isfinite(found).all() and found[0] < 0


def test_windows_hold_every_token_once_with_its_predecessor():
    shape = Shape(5, 2, 3)
    docs = [np.array(d) for d in ([1, 2, 3], [4], [5, 6, 0, 1, 2])]
    pairs = Counter()
    for inputs, targets, fresh in windows(docs, shape, 2, 3):
        assert ((inputs == shape.start) == fresh).all()
        pairs.update(zip(inputs.ravel().tolist(), targets.ravel().tolist(), strict=True))
    assert pairs == Counter(
        [(7, 1), (1, 2), (2, 3), (7, 4), (7, 5), (5, 6), (6, 0), (0, 1), (1, 2)]
    )


def test_training_learns_what_follows_what():
    shape = Shape(6, 2, 3, 8, 8)
    rng, docs = np.random.default_rng(9), []
    for _ in range(300):
        doc = [int(rng.integers(6))]
        for _ in range(30):
            doc.append((doc[-1] * 2 + 1) % 7 if rng.random() < 0.9 else int(rng.integers(7)))
        docs.append(np.array(doc))
    model = Model(shape, initial(shape, np.bincount(np.concatenate(docs), minlength=8)))
    before = model.score(docs[200:]).sum()
    for _ in range(8):
        train(model, docs[:200], 0.02)
    assert model.score(docs[200:]).sum() > 0.6 * before


def language(seed, n):
    """Texts in which a word depends on the one before."""
    rng = random.Random(seed)
    subjects, verbs, things = (
        [f"{kind}{i}" for i in range(8)] for kind in ("cat", "Runs", "hill")
    )
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(5, 40)):
            i = rng.randrange(8)
            words += [subjects[i], verbs[i], things[(i + rng.randrange(2)) % 8]]
        texts.append(" ".join(words) + rng.choice(["", " once", f" rare{rng.randrange(500)}"]))
    return texts


def brute(docs):
    tokens = [(i, (t or "").encode().lower().split() + [b""]) for i, t in docs]
    fold = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in docs}
    counts = Counter(w for i, ws in tokens if not fold[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [
        (i, fold[i], len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in tokens
    ]


ODD = [(9001, None), (9002, ""), (None, "cat1 runs1 hill1"), (9003, "  \t\n"), (9003, "CAT1 runs1\x0bhill2"), (9004, "unseen " * 50_000)]


def scored(spark, docs, plan):
    table = spark.createDataFrame([(*d, 1.0, "w") for d in docs], "doc_id long, text string, score double, word string")
    found = score_documents(table.repartition(3), plan)
    assert found.columns == COLUMNS
    return found.collect()


@pytest.mark.parametrize("dictionary", [0, 5, 20, 200_000])
def test_counts_and_base_equal_brute_force_for_any_dictionary(spark, dictionary):
    docs = [*enumerate(language(1, 40)), *ODD]
    rows = scored(spark, docs, Plan(dictionary=dictionary, head_words=4, rounds=2, most_passes=1))

    def key(row):
        return (row[0] is None, row[0] or 0, row[2], round(row[5], 6))

    expected = sorted(brute(docs), key=key)
    got = sorted(map(tuple, rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-9)
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)


def test_held_out_texts_are_likelier_than_by_counts_and_order_matters(spark):
    docs = [*enumerate(language(2, 1500))]
    shuffled = []
    for i, text in docs[:200]:
        words = text.split()
        random.Random(i).shuffle(words)
        shuffled.append((i + 10_000_000, " ".join(words)))
    rows = {r.doc_id: r for r in scored(spark, docs + shuffled, Plan(head_words=64))}
    held = [r for r in rows.values() if r.held_out and r.doc_id < 10_000_000]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)
    assert sum(rows[i].score > rows[i + 10_000_000].score for i, _ in docs[:200]) > 190


@pytest.mark.parametrize("kinds", [1, 5])
def test_chances_of_all_words_add_up_to_one(spark, kinds):
    """Within each band: the words of the dictionary, rarer ones, and one unseen word."""
    texts = spark.createDataFrame([(t,) for t in language(3, 60)], "text string")
    counts = count_tokens(texts, Scratch(spark, "test"))
    plan = Plan(dictionary=24, head_words=6, kinds=kinds)
    known = build_vocabulary(counts, plan)
    symbols = make_symbols(known, np.arange(known.size) % (kinds + 1), plan)
    inside = Counter()
    for at in known.index().values():
        if at >= 6:
            inside[int(symbols.symbol[at])] += 10 ** symbols.inside[at]
        else:
            assert symbols.symbol[at] == at and symbols.inside[at] == 0
    rare = [r["n"] for r in counts.collect() if r["word"] not in known.index()]
    inside[symbols.shape.symbols - 1] += sum((n + 1) / symbols.outside for n in rare) + 1 / symbols.outside
    assert all(math.isclose(chance, 1) for chance in inside.values()) and len(inside) == kinds + 2
    assert known.tokens == sum(r["n"] for r in counts.collect()) == symbols.counts.sum()


def test_bands_tell_languages_apart(spark):
    """Four languages, of which a single kind tells one from the others."""
    rng, docs = random.Random(6), []
    for i in range(600):
        tongue = "abcd"[i % 4]
        words = [f"{tongue}{rng.randrange(4)}" if rng.random() < 0.6 else f"{tongue}rare{rng.randrange(200)}" for _ in range(60)]
        docs.append((i, " ".join(words)))
    sums = []
    for kinds in (1, 16):
        rows = scored(spark, docs, Plan(head_words=17, kinds=kinds, rounds=2, most_passes=3))
        sums.append(sum(r.score for r in rows if r.held_out) / sum(r.n_tokens for r in rows if r.held_out))
    assert sums[1] > sums[0] + 0.03


def test_no_documents_and_none_to_learn_from(spark):
    assert scored(spark, [], Plan()) == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = scored(spark, [(held, "some words")], Plan())
    assert tuple(row)[:5] == (held, True, 3, 0, 0) and row.base_score == 0 and math.isfinite(row.score)
