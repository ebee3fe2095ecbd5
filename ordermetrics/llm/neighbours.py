"""Approximate nearest neighbours by inner product: robust-pruned directed graphs.

Vectors are dealt over shards of bounded size and each shard becomes one graph. A vector is
inserted by a greedy search for itself: what the search meets is pruned to edges that no kept
edge makes superfluous, by a relaxed factor, so near and far edges stay; edges back are added
and pruned alike. A query runs a beam search in every shard, and the shards' best are merged.
Inner product is nearness after one more coordinate lifts all vectors of a shard to the same
length. Equal vectors are one vertex with the ids that can be among the nearest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ordermetrics.llm.scratch import Scratch

NEAREST = 20
# Larger shards make a query meet less of them, and take longer to build: half a minute here.
SHARD = 16_384
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 96
RELAXED = 1.2
AT_ONCE = 8
QUERIES = 1024
BATCH = 256


def beam_search(
    points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, width: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vertices, squared distances) of the ``width`` nearest met, and how many were met, for each query.

    Each step opens the nearest vertices of the beam that are not open yet, until all are.
    Vertex -1 fills what is missing.
    """
    many = len(queries)
    rows = np.arange(many)[:, None]
    beam = np.full((many, width), -1)
    far = np.full((many, width), np.inf, np.float32)
    opened = np.ones((many, width), bool)
    beam[:, 0] = entry
    far[:, 0] = ((points[entry] - queries) ** 2).sum(axis=1)
    opened[:, 0] = False
    met = np.zeros((many, len(points) + 1), bool)
    met[:, entry] = met[:, -1] = True
    square = (points * points).sum(axis=1)
    own = (queries * queries).sum(axis=1)
    while True:
        open_at = np.argsort(np.where(opened, np.inf, far), axis=1, kind="stable")[:, :AT_ONCE]
        live = ~opened[rows, open_at]
        if not live.any():
            return beam, far, met.sum(axis=1) - 1
        opened[rows, open_at] = True
        near = np.where(live[:, :, None], edges[beam[rows, open_at]], -1).reshape(many, -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[met[rows, near]] = -1
        met[rows, near] = True
        dots = np.einsum("qkd,qd->qk", points[near], queries)
        found = np.where(near < 0, np.inf, square[near] - 2 * dots + own[:, None])
        all_far = np.concatenate([far, found.astype(np.float32)], axis=1)
        best = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(
            all_far, best, 1), axis=1, kind="stable"), 1)
        beam = np.take_along_axis(np.concatenate([beam, near], axis=1), best, 1)
        far = np.take_along_axis(all_far, best, 1)
        opened = np.take_along_axis(np.concatenate([opened, near < 0], axis=1), best, 1)


def prune(
    points: np.ndarray, centre: np.ndarray, choice: np.ndarray, degree: int, relaxed: float,
) -> np.ndarray:
    """At most ``degree`` of each row's vertices: the nearest, less those nearer to a kept one.

    A vertex goes when some kept vertex, times ``relaxed``, is nearer to it than the centre.
    Rows are filled with -1.
    """
    choice = np.where(choice == centre[:, None], -1, choice)
    choice.sort(axis=1)
    choice[:, 1:][choice[:, 1:] == choice[:, :-1]] = -1
    x = points[choice]
    square = (x * x).sum(axis=2)
    here = points[centre]
    far = square - 2 * np.einsum("qkd,qd->qk", x, here) + (here * here).sum(axis=1)[:, None]
    far = np.where(choice < 0, np.inf, far)
    between = square[:, :, None] + square[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
    rows = np.arange(len(centre))
    kept = np.full((len(centre), degree), -1)
    left = far.copy()
    for i in range(degree):
        at = left.argmin(axis=1)
        some = np.isfinite(left[rows, at])
        if not some.any():
            break
        kept[some, i] = choice[rows, at][some]
        left[rows, at] = np.inf
        left[relaxed * relaxed * between[rows, at] <= far] = np.inf
        left[~some] = np.inf
    return kept


def build(points: np.ndarray, degree: int = DEGREE, width: int = BUILD_BEAM) -> tuple[np.ndarray, int]:
    """(edges, entry) of the graph over ``points``; missing edges are -1."""
    n = len(points)
    draw = np.random.default_rng(n)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = draw.integers(0, n, (n, degree))
    edges[:, degree // 2:] = -1
    for turn, relaxed in enumerate((1.0, RELAXED)):
        order = draw.permutation(n)
        for i in range(0, n, BATCH):
            new = order[i:i + BATCH]
            met, _, _ = beam_search(points, edges, entry, points[new], width)
            edges[new] = prune(points, new, np.concatenate([met, edges[new]], axis=1), degree, relaxed)
            _add_back(points, edges, new, degree, relaxed)
    return edges, entry


def _add_back(points, edges, new, degree, relaxed):
    """Edges back from what the new vertices point to."""
    to = edges[new].ravel()
    source = np.repeat(new, degree)[to >= 0]
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    centre, first, many = np.unique(to, return_index=True, return_counts=True)
    for i in range(0, len(centre), BATCH):
        part = slice(i, i + BATCH)
        width = int(many[part].max())
        at = first[part][:, None] + np.arange(width)
        extra = np.where(np.arange(width) < many[part][:, None],
                         source[np.minimum(at, len(source) - 1)], -1)
        both = np.concatenate([edges[centre[part]], extra], axis=1)
        edges[centre[part]] = prune(points, centre[part], both, degree, relaxed)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors of equal length whose order of distances is that of inner products."""
    square = (vectors * vectors).sum(axis=1)
    rest = np.sqrt(np.maximum(square.max(initial=0) - square, 0))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)


def _usable(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector): ids with vectors of the commonest length, finite and not all zero."""
    rows = frame.select(F.col(id_col).cast("bigint").alias("vec_id"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter("vec_id IS NOT NULL AND vector IS NOT NULL").filter(
        finite & F.exists("vector", lambda x: x != 0)).distinct()
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(
        F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("vector") == (length[0]["n"] if length else 0))


def _classes(rows: DataFrame, most: int) -> DataFrame:
    """(class, name, vector, ids): distinct vectors with their smallest ids, at most ``most``.

    The name is the smallest id; it decides between equal scores and need not be unique.
    """
    order = Window.partitionBy("vector").orderBy("vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= most).groupBy("vector").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("class"), F.col("ids")[0].alias("name"), "vector", "ids")


def index(classes: DataFrame, shards: int) -> DataFrame:
    """One row for each shard: its vertices' classes, names and vectors, edges and entry."""
    def run(table):
        names = table.column("name").to_numpy()
        flat = table.column("vector").combine_chunks().flatten().to_numpy()
        vectors = flat.reshape(len(names), -1)
        edges, entry = build(lifted(vectors))
        return pa.table({
            "shard": table.column("shard").slice(0, 1),
            "classes": pa.array([table.column("class").to_numpy()]), "names": pa.array([names]),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "edges": pa.array([edges.astype(np.int32).tobytes()], pa.binary()),
            "entry": pa.array([entry], pa.int64())})

    return classes.select("class", "name", "vector").withColumn(
        "shard", F.pmod(F.xxhash64("class"), F.lit(shards))).groupBy("shard").applyInArrow(
        run, "shard bigint, classes array<bigint>, names array<bigint>, vectors binary, edges binary, "
             "entry bigint")


def search(graphs: DataFrame, queries: DataFrame, blocks: int, most: int) -> DataFrame:
    """(query_id, class, name, score): each query's best of each shard."""
    held = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).groupBy(
        "block").agg(F.collect_list("vec_id").alias("queries"),
                     F.flatten(F.collect_list("vector")).alias("wanted"))
    both = graphs.withColumn("block", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))).join(held, "block")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names, ids = np.array(row["names"]), np.array(row["queries"])
                classes = np.array(row["classes"])
                vectors = np.frombuffer(row["vectors"]).reshape(len(names), -1)
                edges = np.frombuffer(row["edges"], np.int32).reshape(len(names), -1)
                wanted = np.array(row["wanted"]).reshape(len(ids), -1)
                points = lifted(vectors)
                asked = np.concatenate([wanted, np.zeros((len(ids), 1))], axis=1).astype(np.float32)
                for i in range(0, len(ids), BATCH):
                    met, _, _ = beam_search(points, edges, row["entry"], asked[i:i + BATCH],
                                            max(SEARCH_BEAM, most))
                    score = np.einsum("qkd,qd->qk", vectors[met], wanted[i:i + BATCH])
                    score[met < 0] = -np.inf
                    best = np.lexsort((names[met], -score), axis=1)[:, :most]
                    met, score = (np.take_along_axis(x, best, 1) for x in (met, score))
                    some = met >= 0
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(ids[i:i + BATCH], some.sum(axis=1))),
                        pa.array(classes[met[some]]), pa.array(names[met[some]]),
                        pa.array(score[some])], ["query_id", "class", "name", "score"])

    # Dealt by what a row is, so that a task that runs again deals its rows alike.
    return both.repartition("shard", "block").select(
        "classes", "names", "vectors", "edges", "entry", "queries", "wanted").mapInArrow(
        run, "query_id bigint, class bigint, name bigint, score double")


def nearest(
    frame: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    most: int = NEAREST, shard: int = SHARD,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``most`` nearest rows of ``frame``.

    ``queries`` are rows of the same form; a query is not its own neighbour. Score is the
    inner product in double precision; ties go to the smaller id. Rows without id, repeated
    rows, vectors of another length than the commonest and vectors that are null, zero or
    hold null or non-finite components take no part. An id with several vectors is a candidate,
    and a query, with each. Other columns are not read. Fewer rows than asked for are all
    returned. Every row is indexed; no sample is taken. Runs Spark jobs when called.
    """
    scratch = Scratch(frame.sparkSession, "neighbours")
    classes = scratch.keep(_classes(_usable(frame, id_col, vector_col), most + 1), "classes")
    shards = max(1, -(-classes.count() // shard))
    graphs = scratch.keep(index(classes, shards), "graphs")
    wanted = scratch.keep(_usable(queries, id_col, vector_col), "queries")
    blocks = max(1, -(-wanted.count() // QUERIES))
    found = search(graphs, wanted, blocks, most + 1)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "name")
    found = found.withColumn("rank", F.row_number().over(best)).filter(
        F.col("rank") <= most + 1).drop("rank", "name")
    each = found.join(classes.select("class", "ids"), "class").select(
        "query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= most).select("query_id", "rank", "vec_id", "score")
