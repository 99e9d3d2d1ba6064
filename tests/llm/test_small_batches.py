"""What tasks hold and sort while they learn."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from orderloom.llm import gru, toxicity


def test_terms_leave_a_task_in_small_batches():
    texts = [f"some words of {i} and more" for i in range(1000)] + [None, ""]
    rows = pa.RecordBatch.from_arrays([pa.array([0, 1] * 501, pa.int32()), pa.array(texts)], ["toxic", "text"])
    made = list(toxicity._term_lists([rows]))
    assert max(part.num_rows for part in made) <= toxicity.TEXTS_AT_ONCE
    table = pa.Table.from_batches(made)
    assert table["toxic"].to_pylist() == [0, 1] * 501
    expected = [sorted({t for w in toxicity.words(text) for t in toxicity.word_terms(w)}) for text in texts]
    assert table["terms"].to_pylist() == expected


def test_the_pipeline_scores_small_batches(spark, monkeypatch):
    most = int(toxicity.TEXTS_PER_BATCH)

    def size_of_batch(model):
        @F.pandas_udf("double")
        def too_large(texts):
            return (texts == texts) * 0.0 + float(len(texts) > most)

        return too_large(F.col("text"))

    monkeypatch.setattr(toxicity, "toxicity", size_of_batch)
    monkeypatch.setattr(toxicity, "learn", lambda docs, labels: None)
    docs = spark.range(0, 3 * most, 1, 1).select(F.col("id").alias("doc_id"), F.lit("a text").alias("text"))
    kept = toxicity.without_toxic(docs, None)
    assert kept.count() == 3 * most and kept.columns == docs.columns


def test_order_of_symbols_is_stable_at_any_number_of_them():
    rng = np.random.default_rng(3)
    for most in (2, 530, 1 << 16, 1 << 20):
        values = rng.integers(0, most, 5000)
        values[:2] = most - 1
        assert gru.by_number(values, most).tolist() == sorted(range(5000), key=lambda i: values[i])
