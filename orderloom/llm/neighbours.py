"""Approximate nearest neighbours by a graph that NN-descent builds.

Every vector keeps a list of its nearest known ones. A neighbour of a neighbour is
likely a neighbour, so in each round, a Spark join, the vectors around each vector
meet and improve each other's lists, until little changes. A query then walks the
graph greedily: it looks up the lists of the nearest vectors it has found, until
none of them is new. All distances are those of the original vectors, so vectors
that hardly differ are told apart as well as others.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm.tables import Scratch, join_counted, settings

GROUPS_PER_BATCH = "256"


@dataclass(frozen=True)
class Descent:
    """``neighbours`` are kept per vector, and as many that point to it meet it too.

    Lists start from the nearest in ``trees`` random partitions into leaves. Rounds
    end when less than ``settled`` of the entries are new. A round goes over the
    vectors in ``slices``, as each takes all its neighbours along. A search keeps the
    ``beam`` nearest and looks up ``expand`` of them at a time.
    """

    neighbours: int = 40
    leaf: int = 256
    trees: int = 4
    from_leaf: int = 12
    rounds: int = 6
    settled: float = 0.15
    slices: int = 2
    beam: int = 160
    expand: int = 48
    seed: int = 11


# ---- vectors


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vec (doubles) of the vectors that take part.

    Not null, not zero, without null or non-finite components, and of the most
    frequent length (of equally frequent ones the largest).
    """
    vec = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0)
    )
    length = F.size("vec")
    most = valid.groupBy(length.alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return valid.where(length == (most[0]["n"] if most else 0))


def classes_of(valid: DataFrame, members: int) -> DataFrame:
    """One row per distinct vector: members (its smallest vec_ids), vec."""
    ranked = valid.withColumn("_nr", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id")))
    few = ranked.where(F.col("_nr") <= members)  # cut in the map task, before the shuffle
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))


def numbered(classes: DataFrame) -> DataFrame:
    """The rows of a written table with node, the place of a row: file, then row. Different
    vectors may share a vec_id, so that cannot be their number."""
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    return classes.select((F.shiftleft(part, 40) + F.col("_metadata.row_index")).alias("node"), "members", "vec")


@dataclass(frozen=True)
class Form:
    """How a vector is written as bytes: single precision only where that is exact."""

    dimensions: int
    kind: str

    def read(self, points: pa.Array) -> np.ndarray:
        flat = np.frombuffer(b"".join(points.to_pylist()), self.kind)
        return flat.reshape(-1, self.dimensions).astype(np.float64)


def _points(mean: np.ndarray, planes: np.ndarray, form: Form):
    """Vectors as bytes, and their leaf in each tree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(mean))
            around = np.nan_to_num(x - mean)
            leaves = [((around @ p > 0) @ (1 << np.arange(p.shape[1]))).astype(np.int64) for p in planes]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([p.tobytes() for p in x.astype(form.kind)], pa.binary()),
                    pa.array(list(np.stack(leaves, 1)) if leaves else [[]] * len(x), pa.list_(pa.int64())),
                ],
                ["node", "point", "leaves"],
            )

    return run


def placed_points(classes: DataFrame, form: Form, vectors: int, how: Descent) -> DataFrame:
    means = classes.select(F.posexplode("vec").alias("at", "x")).groupBy("at").agg(F.avg("x").alias("mean"))
    mean = np.zeros(form.dimensions)
    for row in means.collect():  # one row per dimension
        mean[row["at"]] = row["mean"]
    bits = max(0, math.ceil(math.log2(max(1, vectors / how.leaf))))
    planes = np.random.default_rng(how.seed).standard_normal((how.trees - 1, form.dimensions, bits))
    fields = "node long, point binary, leaves array<long>"
    return classes.select("node", "vec").mapInArrow(_points(mean, planes, form), fields)


# Below this share of the lengths, a difference of products has lost too many digits.
CANCELLED = 1e-8


def _squares(x: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to each other."""
    x = x - x.mean(0)
    own = np.einsum("ij,ij->i", x, x)
    lengths = own[:, None] + own[None]
    far = np.maximum(lengths - 2 * (x @ x.T), 0)
    near = far < CANCELLED * lengths
    np.fill_diagonal(near, False)
    for i in np.flatnonzero(near.any(1)).tolist():
        apart = x[near[i]] - x[i]
        far[i, near[i]] = np.einsum("ij,ij->i", apart, apart)
    return far


def _groups(batch: pa.RecordBatch) -> tuple[pa.StructArray, Iterator[tuple[int, int]]]:
    lists = batch.column("members")
    ends = np.cumsum(lists.value_lengths().to_numpy())
    return lists.flatten(), zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)


def _edges(u: list[np.ndarray], w: list[np.ndarray], d: list[np.ndarray]) -> pa.RecordBatch:
    parts = [np.concatenate([np.empty(0), *p]) for p in (u, w, d)]
    types = (np.int64, np.int64, np.float64)
    return pa.RecordBatch.from_arrays([pa.array(p.astype(t)) for p, t in zip(parts, types, strict=True)], ["u", "w", "d"])


EDGE = "u long, w long, d double"


def _within_leaves(form: Form, nearest: int):
    """The nearest others of each member of a leaf."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, bounds = _groups(batch)
            nodes, points = rows.field("node").to_numpy(), form.read(rows.field("point"))
            u, w, d = [], [], []
            for a, b in bounds:
                far = _squares(points[a:b])
                np.fill_diagonal(far, np.inf)
                k = min(nearest, b - a - 1)
                if k > 0:
                    best = np.argpartition(far, k - 1, 1)[:, :k]
                    u.append(np.repeat(nodes[a:b], k))
                    w.append(nodes[a:b][best].ravel())
                    d.append(np.take_along_axis(far, best, 1).ravel())
            yield _edges(u, w, d)

    return run


def _local_join(form: Form, nearest: int):
    """Pairs around one vector, at least one of them newly there, that improve a list."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, bounds = _groups(batch)
            nodes, points = rows.field("node").to_numpy(), form.read(rows.field("point"))
            new = rows.field("new").to_numpy(zero_copy_only=False)
            worst = rows.field("worst").to_numpy()
            u, w, d = [], [], []
            for a, b in bounds:
                far = _squares(points[a:b])
                far[~(new[a:b, None] | new[None, a:b])] = np.inf
                far[nodes[a:b, None] == nodes[None, a:b]] = np.inf
                far[far >= worst[a:b, None]] = np.inf
                if b - a > nearest:
                    rest = np.argpartition(far, nearest - 1, 1)[:, nearest:]
                    np.put_along_axis(far, rest, np.inf, 1)
                i, j = np.nonzero(np.isfinite(far))
                u.append(nodes[a:b][i])
                w.append(nodes[a:b][j])
                d.append(far[i, j])
            yield _edges(u, w, d)

    return run


# ---- the graph


def _nearest(edges: DataFrame, number: int) -> DataFrame:
    """The nearest ``number`` of each u, once each; new only if no earlier entry says otherwise."""
    single = edges.groupBy("u", "w").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("u").orderBy("d", "w"))
    return single.withColumn("_nr", place).where(F.col("_nr") <= number).drop("_nr")


def _some_backwards(edges: DataFrame, number: int) -> DataFrame:
    """For each vector some of those that list it, chosen by hash; a popular one has
    too many, and the graph keeps its edge in the other direction."""
    place = F.row_number().over(Window.partitionBy("w").orderBy(F.xxhash64("u"), "u"))
    return edges.withColumn("_nr", place).where(F.col("_nr") <= number).select(F.col("w").alias("u"), F.col("u").alias("w"), "new")


def _tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner find the shuffle files of rounds that are over."""
    gc.collect()
    spark._jvm.System.gc()


def build_graph(points: DataFrame, form: Form, vectors: int, how: Descent, scratch: Scratch) -> DataFrame:
    """u, w, d (squared), new: the list of every vector."""
    spark = points.sparkSession
    random_leaf = F.pmod(F.xxhash64("node"), F.lit(-(-vectors // how.leaf) or 1))
    leaves = points.select("node", F.posexplode(F.concat(F.array(random_leaf), "leaves")).alias("tree", "leaf"))
    leaves = leaves.select("node", (F.col("leaf") * how.trees + F.col("tree")).alias("leaf"))
    sizes = leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("size"))
    # A leaf that came out too large is dealt over several.
    part = F.pmod(F.xxhash64("node", "leaf"), F.expr(f"size div {4 * how.leaf} + 1"))
    placed = join_counted(leaves, sizes, "leaf", "size").select("node", "leaf", part.alias("part"))
    gathered = placed.join(points.select("node", "point"), "node").groupBy("leaf", "part").agg(
        F.collect_list(F.struct("node", "point")).alias("members")
    )
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="8"):
        first = gathered.select("members").mapInArrow(_within_leaves(form, how.from_leaf), EDGE)
        graph = scratch.write(_nearest(first.withColumn("new", F.lit(True)), how.neighbours), "graph")
    _tidy(spark)

    for _ in range(how.rounds):
        around = graph.select("u", "w", "new").unionByName(_some_backwards(graph, how.neighbours // 2))
        around = around.unionByName(points.select(F.col("node").alias("u"), F.col("node").alias("w"), F.lit(False).alias("new")))
        around = scratch.write(around.groupBy("u", "w").agg(F.max("new").alias("new")), "around")
        for nr in range(how.slices):
            worst = graph.groupBy("u").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("n"))
            worst = worst.select(
                F.col("u").alias("node"), F.when(F.col("n") < how.neighbours, float("inf")).otherwise(F.col("d")).alias("worst")
            )
            known = points.select("node", "point").join(worst, "node", "left")
            known = known.withColumn("worst", F.coalesce("worst", F.lit(float("inf"))))
            here = around.where(F.pmod(F.xxhash64("u"), F.lit(how.slices)) == nr)
            met = here.withColumnRenamed("w", "node").join(known, "node").groupBy("u").agg(
                F.collect_list(F.struct("node", "new", "point", "worst")).alias("members")
            )
            with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=GROUPS_PER_BATCH):
                better = met.select("members").mapInArrow(_local_join(form, how.neighbours), EDGE)
                # What was listed when the round began is no longer new; what its slices add is.
                listed = graph if nr else graph.withColumn("new", F.lit(False))
                merged = listed.unionByName(better.withColumn("new", F.lit(True)))
                previous, graph = graph, scratch.write(_nearest(merged, how.neighbours), "graph")
            scratch.drop(previous)
            _tidy(spark)
        scratch.drop(around)
        counts = graph.agg(F.count(F.lit(1)).alias("n"), F.count_if("new").alias("new")).first()
        if counts["new"] <= how.settled * counts["n"]:
            break
    return graph


# ---- search


def _distance(form: Form) -> Column:
    """Squared distance of two points in a row."""

    @F.arrow_udf("double")
    def distance(a: pa.Array, b: pa.Array) -> pa.Array:
        apart = form.read(a) - form.read(b)
        return pa.array(np.einsum("ij,ij->i", apart, apart))

    return distance("point", "_point")


def _measured(reached: DataFrame, points: DataFrame, starts: DataFrame, form: Form) -> DataFrame:
    """q, w, d for pairs q, w."""
    theirs = points.select(F.col("node").alias("w"), "point")
    own = starts.select("q", F.col("point").alias("_point"))
    return reached.join(theirs, "w").join(own, "q").select("q", "w", _distance(form).alias("d"))


def search(starts: DataFrame, graph: DataFrame, points: DataFrame, form: Form, how: Descent, scratch: Scratch) -> DataFrame:
    """q, w, d: the nearest that each start q (with its point) finds."""
    spark = starts.sparkSession
    both = graph.select("u", "w").unionByName(_some_backwards(graph, how.neighbours).select("u", "w"))
    lists = scratch.write(both.groupBy("u").agg(F.collect_set("w").alias("next")), "lists")
    by_distance = Window.partitionBy("q").orderBy("d", "w")

    def step(front: DataFrame, beam: DataFrame | None) -> DataFrame:
        """Look up the lists of the front, measure what is new, keep the nearest."""
        ahead = front.join(lists.withColumnRenamed("u", "at"), "at")
        reached = ahead.select("q", F.explode("next").alias("w")).where("q <> w").distinct()
        if beam is None:
            found = _measured(reached, points, starts, form).withColumn("done", F.lit(False))
        else:
            reached = reached.join(beam.select("q", "w"), ["q", "w"], "left_anti")
            looked_up = front.select("q", F.col("at").alias("w"), F.lit(True).alias("_now"))
            older = beam.join(looked_up, ["q", "w"], "left").select(
                "q", "w", "d", (F.col("done") | F.coalesce("_now", F.lit(False))).alias("done")
            )
            found = older.unionByName(_measured(reached, points, starts, form).withColumn("done", F.lit(False)))
        best = found.withColumn("_nr", F.row_number().over(by_distance)).where(F.col("_nr") <= how.beam).drop("_nr")
        return scratch.write(best, "beam")

    beam = step(starts.select("q", F.col("q").alias("at")), None)
    while not beam.where("NOT done").isEmpty():
        fresh = beam.where("NOT done").withColumn("_nr", F.row_number().over(by_distance))
        front = fresh.where(F.col("_nr") <= how.expand).select("q", F.col("w").alias("at"))
        previous, beam = beam, step(front, beam)
        scratch.drop(previous)
    _tidy(spark)
    return beam


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, how: Descent = Descent()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query, itself excluded.

    ``vectors`` has vec_id and embedding; ``is_query`` picks queries by vec_id. The
    score is the Euclidean distance of the original vectors in double precision,
    ties go to the smaller vec_id. What takes no part is told in ``usable``, a null
    vec_id too; other columns are ignored, an empty table gives no rows. Equal
    vectors, however many, are one vector of the graph. Repeated rows of one vec_id
    are each a candidate. All vectors are in the graph.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    valid = usable(vectors)
    classes = numbered(scratch.write(classes_of(valid, k + 1), "classes"))
    single = F.forall("vec", lambda x: x.cast("float").cast("double") == x)
    found = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dimensions"), F.bool_and(single).alias("single")).first()
    fields = "query_id long, rank int, vec_id long, score double"
    if not found["n"]:
        return spark.createDataFrame([], fields)

    form = Form(found["dimensions"], "<f4" if found["single"] else "<f8")
    how = replace(how, beam=max(how.beam, 4 * (k + 1)))
    points = scratch.write(placed_points(classes, form, found["n"], how), "points")
    graph = build_graph(points, form, found["n"], how, scratch)
    queries = valid.where(is_query).select(F.col("vec_id").alias("query_id"), "vec")
    queries = scratch.write(queries.join(classes.select("node", "vec"), "vec").select("query_id", F.col("node").alias("q")), "queries")
    starts = queries.select("q").distinct().join(points.withColumnRenamed("node", "q"), "q").select("q", "point")
    starts = scratch.write(starts, "starts")
    beam = search(starts, graph, points, form, how, scratch)

    close = beam.select("q", "w").unionByName(starts.select("q", F.col("q").alias("w")))  # copies of the query
    theirs = classes.select(F.col("node").alias("w"), "members", "vec")
    own = classes.select(F.col("node").alias("q"), F.col("vec").alias("_vec"))
    squares = F.zip_with("vec", "_vec", lambda a, b: (a - b) * (a - b))
    score = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))
    scored = close.join(theirs, "w").join(own, "q").select("q", score.alias("score"), F.explode("members").alias("vec_id"))
    # One more than asked for, as the query itself may be among them.
    listed = scored.withColumn("_nr", F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id")))
    listed = listed.where(F.col("_nr") <= k + 1).drop("_nr")
    answers = queries.distinct().join(listed, "q").where("vec_id <> query_id")
    answers = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return answers.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
