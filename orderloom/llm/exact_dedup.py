"""Exact deduplication with keyed streaming state.

A Structured Streaming aggregation keeps, for each text digest and for ever, the
stable id and the content locator of the row that stays, and the number of rows.
The state lives in RocksDB on the executors' disks and in the stream's checkpoint,
so later batches continue from it. A digest is only a hint: rows that hit a known
one are compared by their full bytes, and texts that merely share a digest are
told apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.tables import Scratch, join_counted, settings, text_or_empty

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _located(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text and the file and row of each document."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    columns = (F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    try:
        return docs.select(*columns, *place)
    except AnalysisException:  # not a plain file scan: give the rows a place
        return scratch.write(docs.select(*columns), "rows").select("doc_id", "text", *place)


def keyed_state(digests: DataFrame) -> DataFrame:
    """The streaming aggregation: one row per digest, without expiry.

    ``digests`` has digest, doc_id, file, row. Partial aggregation reduces a group
    of copies to one row per task before the shuffle.
    """
    kept = F.max(F.struct("doc_id", "file", "row")).alias("kept")
    return digests.groupBy("digest").agg(kept, F.count(F.lit(1)).alias("group_size"))


def advance(digests: DataFrame, checkpoint: str) -> None:
    """Feed what is new in a streaming frame of digests into the state at ``checkpoint``."""
    spark = digests.sparkSession
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    with settings(
        spark,
        spark__sql__streaming__stateStore__providerClass=provider,
        spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled="true",
        spark__sql__streaming__stateStore__rocksdb__allowFAllocate="false",
        spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
        spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB="256",
    ):
        stream = (
            keyed_state(digests)
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, kept, group_size as the state holds them."""
    state = spark.read.format("statestore").option("path", checkpoint).load()
    kept, size = (f"value.`{name}`" for name in state.schema["value"].dataType.names)
    return state.select(F.col("key.digest").alias("digest"), F.col(kept).alias("kept"), F.col(size).alias("group_size"))


def exact_dedup(docs: DataFrame, digest: Digest = sha256, files_per_batch: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, file, row.

    Of equal texts the row with the largest doc_id stays, and of rows that repeat
    that id the last by file and row. A null text counts as empty; empty texts are
    equal to each other; a null doc_id is the smallest. Texts are compared as they
    are, at any length. An empty table gives no rows. Other columns are ignored.

    ``digest`` may be weak (tests use that): equal digests are confirmed on bytes.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    texts = _located(docs, scratch)
    folder, checkpoint = scratch.path("digests"), scratch.path("state")
    columns = [digest(F.col("text")).alias("digest"), sha256(F.col("text")).alias("text_sha256")]
    texts.select("doc_id", "file", "row", *columns).write.parquet(folder)
    digests = spark.read.parquet(folder)

    reader = spark.readStream.schema(digests.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    advance(reader.parquet(folder).drop("text_sha256"), checkpoint)
    state = scratch.write(read_state(spark, checkpoint), "state-rows")

    hits = state.where("group_size > 1")
    known = hits.select("digest", F.col("group_size").alias("_size"))
    compared = join_counted(texts.withColumn("digest", digest(F.col("text"))), known, "digest", "_size").drop("_size")
    by_bytes = keyed_by_bytes(compared)
    several = by_bytes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    collided = scratch.write(several.select("digest"), "collisions")

    whole = _answer(join_counted(digests, state, "digest", "group_size"))
    if collided.isEmpty():
        return whole
    # Texts that share a digest: by bytes, apart from all others.
    apart = compared.join(collided, "digest", "left_semi")
    exact = apart.join(keyed_by_bytes(apart), ["digest", "text"]).withColumn("text_sha256", sha256(F.col("text")))
    return _answer(digests.join(collided, "digest", "left_anti").join(state, "digest")).unionByName(_answer(exact))


def keyed_by_bytes(texts: DataFrame) -> DataFrame:
    """One row per digest and full text; copies collapse in the map task."""
    kept = F.max(F.struct("doc_id", "file", "row")).alias("kept")
    return texts.groupBy("digest", "text").agg(kept, F.count(F.lit(1)).alias("group_size"))


def _answer(joined: DataFrame) -> DataFrame:
    return joined.select(
        "doc_id",
        F.col("kept.doc_id").alias("keep_id"),
        "group_size",
        (F.struct("file", "row") == F.struct("kept.file", "kept.row")).alias("kept"),
        "text_sha256",
        "file",
        "row",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    scratch = Scratch(docs.sparkSession, "without-copies")
    try:
        docs.select("_metadata.row_index")
        rows = docs
    except AnalysisException:
        rows = scratch.write(docs, "documents")
    dropped = exact_dedup(rows).where(~F.col("kept")).select("file", "row")
    placed = rows.select(F.struct(*rows.columns).alias("_doc"), F.struct("_metadata.file_path", "_metadata.row_index").alias("_at"))
    gone = dropped.select(F.struct("file", "row").alias("_gone"))
    same = (F.col("_at.file_path") == F.col("_gone.file")) & (F.col("_at.row_index") == F.col("_gone.row"))
    return placed.join(gone, same, "left_anti").select("_doc.*")
