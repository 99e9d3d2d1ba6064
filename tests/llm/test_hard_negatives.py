"""Hard negatives against all pairs, on vectors with ties, gaps and repeated rows."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import hard_negatives
from orderloom.llm.hard_negatives import Best, Mining, mine_negatives, products

SCHEMA = "vec_id long, embedding array<float>, label int, score long, slot string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor, scale, rule):
    sound = []
    for vec_id, vector, label, *_ in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        sound.append((vec_id, label, [math.floor(scale * float(np.float32(x))) for x in vector]))
    result = []
    for anchor, label, code in sound:
        if not is_anchor(anchor):
            continue
        scored = [(-sum(map(lambda x, y: x * y, code, c)), v, lab) for v, lab, c in sound]
        positives = sorted((s, v) for s, v, lab in scored if lab == label and v != anchor)[: rule.positives]
        for p, positive in positives:
            fit = sorted((s, v) for s, v, lab in scored if lab != label and rule.low * -p <= rule.of * -s <= rule.of * -p)
            result += [(anchor, positive, i + 1, v, -p, -s) for i, (s, v) in enumerate(fit[: rule.negatives])]
    return sorted(result)


def mined(spark, rows, parts=3, scale=256, rule=Mining()):
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(parts)
    found = mine_negatives(table, F.col("vec_id") % 5 == 0, scale=scale, rule=rule)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def vectors(seed, n, dims, spread, labels):
    rng = random.Random(seed)
    return [(i, [rng.randint(-spread, spread) / 256 + 0.001 for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed, dims, spread, labels", [(1, 2, 3, 3), (2, 4, 200, 2), (3, 1, 1, 4), (4, 6, 40, 30)])
def test_equals_all_pairs(spark, seed, dims, spread, labels):
    rows = vectors(seed, 150, dims, spread, labels)
    for rule in (Mining(), Mining(positives=3, negatives=2, low=50), Mining(positives=200, negatives=200, low=1)):
        expected = brute(rows, lambda i: i % 5 == 0, 256, rule)
        assert mined(spark, rows, rule=rule) == expected


def test_small_blocks_and_tiles_change_nothing(spark, monkeypatch):
    rows = vectors(5, 120, 3, 20, 3)
    expected = brute(rows, lambda i: i % 5 == 0, 256, Mining())
    monkeypatch.setattr(hard_negatives, "BLOCK", 5)
    assert mined(spark, rows) == expected and expected


def test_rows_that_take_no_part(spark):
    rows = vectors(6, 60, 2, 9, 2)
    odd = [
        (None, [0.1, 0.1], 1), (65, None, 1), (70, [0.1, None], 1), (75, [float("nan"), 0.1], 0),
        (80, [float("inf"), 0.1], 0), (85, [0.1, 0.1], None), (90, [], 1), (95, [0.2], 0), (100, [0.5, 0.5], 0),
        (100, [0.5, 0.5], 0), (100, [0.25, 0.5], 1),
    ]
    assert mined(spark, rows + odd) == brute(rows + odd, lambda i: i % 5 == 0, 256, Mining())


def test_many_copies_tie_by_id(spark):
    rows = [(i, [0.5, 0.25], i % 2) for i in range(300)]
    found = mined(spark, rows)
    assert found == brute(rows, lambda i: i % 5 == 0, 256, Mining())
    assert {r[3] for r in found if r[0] == 10} == {1, 3, 5, 7, 9}


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5], 1), (2, [0.5], 0)]) == []
    assert mined(spark, [(5, [0.5], 1)]) == []
    assert mined(spark, [(5, [0.5], 1), (6, [0.5], 0)]) == []
    # A negative score has no window below it.
    assert mined(spark, [(5, [0.5], 1), (6, [-0.5], 1), (7, [-0.5], 0)]) == []


def test_products_are_exact_or_refused():
    rng = np.random.default_rng(1)
    for size in (10, 1 << 28):
        a, b = rng.integers(-size, size, (9, 7)), rng.integers(-size, size, (5, 7))
        exact = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
        assert products(a, b).astype(object).tolist() == exact
    with pytest.raises(ValueError):
        products(np.full((1, 4), 1 << 40), np.full((1, 4), 1 << 40))


def test_the_best_of_each_group_whatever_the_order(monkeypatch):
    monkeypatch.setattr(hard_negatives, "PENDING", 10)
    rng = np.random.default_rng(2)
    group, score, ids = rng.integers(0, 4, 500), rng.integers(0, 9, 500), rng.permutation(500)
    best = Best(5, 3)
    for part in np.array_split(np.arange(500), 40):
        best.add(group[part], score[part], ids[part])
    wanted = defaultdict(list)
    for g, s, i in sorted(zip(group.tolist(), (-score).tolist(), ids.tolist(), strict=True)):
        wanted[g].append((g, -s, i))
    assert [tuple(e) for e in best.shrink().T.tolist()] == [e for g in sorted(wanted) for e in wanted[g][:3]]
