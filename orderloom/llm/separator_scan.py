"""Token counts of documents in flat token files without an index.

A token file is nothing but ids, two bytes each, with an end-of-document id after
each document. Documents are found again by searching whole blocks for that id at
once; a prefix scan over the blocks of a file then gives each boundary its
document number and the place where its document began, maybe blocks before.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.tables import Scratch, settings
from orderloom.llm.tokens import groups

END = 2
TOKEN_BYTES = 2
BLOCK_TOKENS = 1 << 19
FILE_BYTES = 64 << 20
TEXTS_PER_BATCH = "1000"

# Before its end, a document carries its number in ids that the vocabulary leaves
# free: five digits of 15 bits each. The top bit says that the number is null.
DIGIT = 1 << 15
DIGITS = 5
_SHIFTS = np.arange(DIGITS - 1, -1, -1) * 15


@cache
def _processor(path: str) -> sentencepiece.SentencePieceProcessor:
    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    if processor.vocab_size() > DIGIT:
        raise ValueError(f"the vocabulary must leave the ids from {DIGIT} on free")
    return processor


def _digits(doc_id: int | None) -> np.ndarray:
    number = 1 << (15 * DIGITS - 1) if doc_id is None else doc_id & ((1 << 64) - 1)
    return np.array([DIGIT + ((number >> s) & (DIGIT - 1)) for s in _SHIFTS.tolist()], np.uint16)


def _numbers(digits: np.ndarray) -> list[int | None]:
    """Rows of digits as signed 64-bit numbers."""
    values = []
    for row in (digits.astype(np.int64) - DIGIT).tolist():
        number = sum(d << s for d, s in zip(row, _SHIFTS.tolist(), strict=True))
        if number >> (15 * DIGITS - 1):
            values.append(None)
        else:
            values.append(number - (1 << 64) if number >> 63 else number)
    return values


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, file_bytes: int = FILE_BYTES) -> None:
    """Flat files of the ids of whole texts (null: empty), number and end id after each.

    A task starts another file once one has ``file_bytes``, so a file is that and one
    document at most. Spark's text writer appends the end id as its line separator, so it works on
    any file system Spark can write to. ``tokenizer`` is the file of a sentencepiece
    model, on every executor.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor, written = _processor(tokenizer), 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, texts in groups(batch.column(1).to_pylist()):
                ids = processor.encode(texts, num_threads=1)
                flat = np.fromiter(chain.from_iterable(ids), np.uint16, sum(map(len, ids)))
                ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
                parts = zip(doc_ids[first : first + len(texts)], np.split(flat, ends[:-1]), strict=True)
                rows = [np.concatenate([part, _digits(d)]).astype("<u2").tobytes() for d, part in parts]
                sizes = np.fromiter(map(len, rows), np.int64, len(rows)) + TOKEN_BYTES
                before = written + np.cumsum(sizes) - sizes
                written += int(sizes.sum())
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), pa.array(before // file_bytes)], ["ids", "piece"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=TEXTS_PER_BATCH):
        ids = texts.mapInArrow(encode, "ids binary, piece long").select(F.col("ids").cast("string").alias("value"), "piece")
        separator = END.to_bytes(TOKEN_BYTES, "little").decode()
        ids.write.option("lineSep", separator).partitionBy("piece").text(folder)


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends in each block, and the document numbers in front of them. A block brings
    the last tokens of the one before it, so that a number is never cut."""
    for batch in batches:
        tokens, ends, numbers = [], [], []
        for nr, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
            block = np.frombuffer(data.as_buffer(), "<u2")
            lead = DIGITS if nr else 0
            found = np.flatnonzero(block[lead:] == END)
            tokens.append(len(block) - lead)
            ends.append(found)
            at = (found + lead)[:, None] + np.arange(-DIGITS, 0)
            numbers.append(_numbers(block[at]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("file"),
                batch.column("block"),
                pa.array(tokens, pa.int64()),
                pa.array(ends, pa.list_(pa.int64())),
                pa.array(numbers, pa.list_(pa.int64())),
            ],
            ["file", "block", "tokens", "ends", "numbers"],
        )


def scan_token_files(spark: SparkSession, folder: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per document: doc_id, file, doc_no, start, n_tokens.

    ``doc_no`` counts the documents of a file from 0, ``start`` its tokens before
    the document, numbers and ends included; ``n_tokens`` is the document's own. A
    document without tokens has 0, an empty file no row. Spark reads a file as one
    value, so files must stay below 2 GB.
    """
    Scratch(spark, "separator-scan")
    step, lead = block_tokens * TOKEN_BYTES, DIGITS * TOKEN_BYTES
    files = spark.read.format("binaryFile").load(folder).where("length > 0")
    blocks = files.select(
        F.substring_index("path", "/", -2).alias("file"),
        "content",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / step).cast("int"))).alias("block"),
    ).select(
        "file",
        "block",
        F.when(F.col("block") == 0, F.substring("content", 1, step))
        .otherwise(F.substring("content", (F.col("block") * step + 1 - lead).cast("int"), F.lit(step + lead)))
        .alias("data"),
    )
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="8"):
        searched = Scratch(spark, "separator-scan").write(
            blocks.mapInArrow(_search, "file string, block int, tokens long, ends array<long>, numbers array<long>"), "ends"
        )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("tokens").over(before), F.lit(0))
    based = searched.withColumn("base", base).withColumn("last", F.col("base") + F.try_element_at(F.col("ends"), F.lit(-1)))
    scanned = based.select(
        "file",
        "base",
        "ends",
        "numbers",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("docs_before"),
        (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("open_start"),
    ).where(F.size("ends") > 0)
    each = scanned.select("*", F.posexplode(F.arrays_zip("ends", "numbers")).alias("nr", "end"))
    start = F.when(F.col("nr") == 0, F.col("open_start")).otherwise(
        F.col("base") + F.element_at("ends", F.greatest(F.col("nr"), F.lit(1))) + 1
    )
    placed = each.withColumn("start", start)
    return placed.select(
        F.col("end.numbers").alias("doc_id"),
        "file",
        (F.col("docs_before") + F.col("nr")).cast("long").alias("doc_no"),
        F.col("start").cast("long").alias("start"),
        (F.col("base") + F.col("end.ends") - F.col("start") - DIGITS).cast("long").alias("n_tokens"),
    )


def token_counts(docs: DataFrame, tokenizer: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write the documents as token files and count them by scanning the files.

    Rows as in ``scan_token_files``. Repeated rows are documents of their own, a
    null doc_id comes back as null, an empty table gives no rows, and other columns
    are ignored.
    """
    scratch = Scratch(docs.sparkSession, "token-files")
    folder = scratch.path("tokens")
    write_token_files(docs, tokenizer, folder)
    counted = scratch.write(scan_token_files(docs.sparkSession, folder, block_tokens), "counts")
    scratch.drop(folder)
    return counted
