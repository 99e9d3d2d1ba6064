"""Vectors that hardly differ are told apart."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm.neighbours import nearest_neighbours


@pytest.mark.parametrize("jitter,kind", [(1e-4, "float"), (1e-9, "double")])
def test_recall_in_a_tight_cluster(spark, jitter, kind):
    rng = np.random.default_rng(4)
    wide = rng.standard_normal((600, 16))
    tight = wide[3] + rng.uniform(-1, 1, (400, 16)) * jitter * np.abs(wide[3]).max()
    points = np.concatenate([wide, tight]).astype(np.float32 if kind == "float" else np.float64).astype(float)
    table = spark.createDataFrame(list(enumerate(points.tolist())), f"vec_id long, embedding array<{kind}>")
    found = {}
    for r in nearest_neighbours(table, F.col("vec_id") % 50 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for query, answers in found.items():
        apart = ((points - points[query]) ** 2).sum(1)
        apart[query] = np.inf
        hits += len(answers & set(np.argsort(apart)[:10].tolist()))
    assert len(found) == 20 and hits >= 0.97 * 200
