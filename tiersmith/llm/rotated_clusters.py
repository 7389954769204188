"""Centroid clustering in whole numbers, with candidate centroids filtered in PCA-rotated coordinates.

Vectors become integers once, ``floor(scale * x)``. Their principal axes are found from the second
moments of all vectors (one aggregate, ``dims`` squared numbers). A vector's leading rotated
coordinates and the length of what they leave over, its *rest*, are stored with it. For a centroid,

    |lead_x - lead_c|^2 + (rest_x - rest_c)^2  <=  |x - c|^2,

so the centroid with the least bound is measured first, in integers, and only centroids whose bound
does not exceed that distance are measured after it. The bound is a float and gets ``SLACK`` for its rounding;
all that decides is integer arithmetic, so the rotation never changes a result.

Each round is one scan that emits at most ``k * dims`` sums a task; Spark adds them up and the driver
gets ``k * dims`` numbers. Nothing is grouped by cluster row by row, so a cluster may hold any share
of the vectors.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component are
left out; rows that repeat a vector or an id are vectors of their own; a null id is clustered but
comes last as a seed; fewer than ``k`` vectors give as many centroids; equal distances go to the
smaller number; no vector gives no row. A component beyond 2^27 after scaling (2^21 before) would
overflow the squared distance in a long: it raises an error that names the row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.scratch import stored

CENTROIDS, ROUNDS, SEED = 16, 3, 1
DIMS, SCALE = 64, 64
LEADING = 16
LIMIT = 1 << 27
SLACK = 4e-6  # of the squared lengths; coordinates are stored with 24 bits
PAIRS_AT_ONCE = 1 << 15


class Rotation(NamedTuple):
    mean: np.ndarray  # dims
    axes: np.ndarray  # dims x leading, orthonormal columns

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading coordinates and rest of each row."""
        moved = x - self.mean
        lead = moved @ self.axes
        return lead, np.sqrt(np.maximum((moved * moved).sum(axis=1) - (lead * lead).sum(axis=1), 0))


class Model(NamedTuple):
    rotation: Rotation
    centroids: np.ndarray  # k x dims, int64


def integers(batch: pa.RecordBatch, column: str, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch that hold a whole vector, and their integer components."""
    lists = batch.column(column)
    right = pc.fill_null(pc.equal(pc.list_value_length(lists), dims), False)
    at = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    flat = lists.take(pa.array(at)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    x = flat.reshape(len(at), dims)  # nulls are NaN by now
    finite = np.isfinite(x).all(axis=1)
    at, q = at[finite], np.floor(scale * x[finite])
    if (np.abs(q) > LIMIT).any():
        row = int(at[np.flatnonzero((np.abs(q) > LIMIT).any(axis=1))[0]])
        raise ValueError(f"a component of vector {batch.column('vec_id')[row].as_py()} is beyond {LIMIT} after scaling")
    return at, q.astype(np.int64)


def slim(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("embedding"))


def rotation(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, leading: int = LEADING) -> Rotation:
    """The principal axes of all whole vectors (``vec_id, embedding``)."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # With a one in front, the products hold the count, the sums and the second moments.
        total = np.zeros((dims + 1, dims + 1))
        for batch in batches:
            _, q = integers(batch, "embedding", dims, scale)
            x = np.hstack([np.ones((len(q), 1)), q])
            total += x.T @ x
        i, j = np.triu_indices(dims + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "s"])

    sums = np.zeros((dims + 1, dims + 1))
    parts = vectors.mapInArrow(moments, "i long, j long, s double")
    for r in parts.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # (dims + 1)^2 / 2 rows
        sums[r.i, r.j] = sums[r.j, r.i] = r.s
    n = max(sums[0, 0], 1)
    mean = sums[0, 1:] / n
    _, axes = np.linalg.eigh(sums[1:, 1:] / n - np.outer(mean, mean))
    return Rotation(mean, np.ascontiguousarray(axes[:, ::-1][:, :leading]))


def rotated(vectors: DataFrame, turn: Rotation, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, q, lead, rest`` of each whole vector: integers, leading coordinates, rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, q = integers(batch, "embedding", dims, scale)
            lead, rest = turn.split(q)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(at)), rows_of(q.astype("<i4")), rows_of(lead.astype("<f4")), pa.array(rest.astype("<f4"))],
                names=["vec_id", "q", "lead", "rest"],
            )

    return vectors.mapInArrow(run, "vec_id long, q binary, lead binary, rest float")


def rows_of(x: np.ndarray) -> pa.Array:
    """Each row of a matrix as one binary value."""
    width = x.shape[1] * x.itemsize
    offsets = np.arange(len(x) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """The other way round."""
    n = len(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + n + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind).reshape(n, -1)


def nearest(q: np.ndarray, lead: np.ndarray, rest: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, int]:
    """Cluster and squared distance of each vector, and how many pairs were measured."""
    n, c = len(q), model.centroids
    c_lead, c_rest = model.rotation.split(c.astype(np.float64))
    lead, rest = lead.astype(np.float64), rest.astype(np.float64)
    x_size, c_size = (lead * lead).sum(axis=1), (c_lead * c_lead).sum(axis=1)
    bound = x_size[:, None] + c_size - 2 * lead @ c_lead.T + (rest[:, None] - c_rest) ** 2
    bound -= SLACK * ((x_size + rest * rest)[:, None] + c_size + c_rest * c_rest) + 1e-6
    cluster = bound.argmin(axis=1)
    best = measured(q, c, np.arange(n), cluster)
    near = bound <= best[:, None]
    near[np.arange(n), cluster] = False
    row, centroid = np.nonzero(near)
    distance = measured(q, c, row, centroid)
    # Pairs by row, distance and number: the first of each row stands against the one measured first.
    order = np.lexsort((centroid, distance, row))
    row, centroid, distance = row[order], centroid[order], distance[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    row, centroid, distance = row[first], centroid[first], distance[first]
    won = (distance < best[row]) | ((distance == best[row]) & (centroid < cluster[row]))
    cluster[row[won]], best[row[won]] = centroid[won], distance[won]
    return cluster, best, n + len(order)


def measured(q: np.ndarray, c: np.ndarray, row: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances of pairs, in integers."""
    out = np.empty(len(row), np.int64)
    for a in range(0, len(row), PAIRS_AT_ONCE):
        apart = q[row[a : a + PAIRS_AT_ONCE]].astype(np.int64) - c[centroid[a : a + PAIRS_AT_ONCE]]
        out[a : a + PAIRS_AT_ONCE] = np.einsum("ij,ij->i", apart, apart)
    return out


def assigned(table: DataFrame, model: Model) -> DataFrame:
    """``vec_id, cluster, distance, q`` of each stored vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance, _ = nearest(*columns(batch), model)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
                )

    return table.mapInArrow(run, "vec_id long, cluster int, distance long")


def columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return matrix(batch.column("q"), "<i4"), matrix(batch.column("lead"), "<f4"), batch.column("rest").to_numpy()


def moved(table: DataFrame, model: Model) -> Model:
    """One round: every centroid that has vectors goes to the floor of their mean."""
    k, dims = model.centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Column 0 counts. A batch's sums are exact in floats too, so they may be a matrix product.
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                q, lead, rest = columns(batch)
                cluster, _, _ = nearest(q, lead, rest, model)
                which = np.zeros((k, len(q)))
                which[cluster, np.arange(len(q))] = 1
                total[:, 0] += which.sum(axis=1).astype(np.int64)
                total[:, 1:] += (which @ q.astype(np.float64)).astype(np.int64)
        c, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(total[c, d])], names=["cluster", "component", "s"])

    parts = table.mapInArrow(sums, "cluster long, component long, s long")
    total = np.zeros((k, dims + 1), object)
    for r in parts.groupBy("cluster", "component").agg(F.sum("s").alias("s")).collect():  # k * (dims + 1) rows at most
        total[r.cluster, r.component] = r.s
    centroids = model.centroids.copy()
    for i in range(k):
        if total[i, 0]:
            centroids[i] = [s // total[i, 0] for s in total[i, 1:]]
    return model._replace(centroids=centroids)


def seeds(table: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` stored vectors with the least SHA-256 of ``seed:vec_id``, in that order."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = table.select("q", place.alias("h")).orderBy(F.asc_nulls_last("h"), "q").limit(k).collect()
    return np.array([np.frombuffer(r.q, "<i4") for r in rows], np.int64)


def fit(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS,
    scale: int = SCALE, leading: int = LEADING, id_column: str = "vec_id", vector_column: str = "embedding",
) -> tuple[DataFrame, Model]:
    """The stored rotated vectors, and the rotation and centroids after ``rounds`` rounds."""
    own = slim(vectors, id_column, vector_column)
    turn = rotation(own, dims, scale, leading)
    table = stored(rotated(own, turn, dims, scale), "rotated")
    model = Model(turn, seeds(table, k, seed).reshape(-1, dims))
    for _ in range(rounds if len(model.centroids) else 0):
        model = moved(table, model)
    return table, model


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each whole vector."""
    table, model = fit(vectors, **options)
    if not len(model.centroids):
        return table.selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256"
        )
    found = stored(assigned(table, model), "clusters")
    # One row a cluster.
    spread = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    by_cluster = lambda values: F.array(*(F.lit(v) for v in values))[F.col("cluster")]
    return found.select(
        "vec_id", "cluster", "distance",
        by_cluster(spread.get(i, 0) for i in range(len(model.centroids))).cast("long").alias("cluster_inertia"),
        F.lit(sum(spread.values())).cast("long").alias("inertia"),
        by_cluster(centroid_digest(c) for c in model.centroids).alias("centroid_sha256"),
    )


def cluster_sql(k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE) -> str:
    """The same for DuckDB, every distance worked out."""
    ctes = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), parts AS MATERIALIZED (
  SELECT r, unnest(q) AS v, generate_subscripts(q, 1) AS d FROM kept
), c0 AS MATERIALIZED (
  SELECT s.c, p.d, p.v FROM parts p JOIN (
    SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), q) - 1 AS c FROM kept
    ORDER BY sha256('{seed}:' || vec_id), q LIMIT {k}) s ON s.r = p.r
)"""]
    nearest_of = "SELECT r, min(struct_pack(s := s, c := c)) AS best FROM (SELECT p.r, m.c, CAST(sum((p.v - m.v) * (p.v - m.v)) AS BIGINT) AS s FROM parts p JOIN c{i} m ON m.d = p.d GROUP BY p.r, m.c) GROUP BY r"
    for i in range(rounds):
        ctes.append(f"a{i} AS MATERIALIZED ({nearest_of.format(i=i)})")
        ctes.append(f"""
c{i + 1} AS MATERIALIZED (
  SELECT m.c, m.d, coalesce(n.v, m.v) AS v FROM c{i} m LEFT JOIN (
    SELECT a.best.c AS c, p.d, CAST((sum(p.v) - (((sum(p.v) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS v
    FROM a{i} a JOIN parts p ON p.r = a.r GROUP BY a.best.c, p.d) n ON n.c = m.c AND n.d = m.d
)""")
    ctes.append(f"last AS MATERIALIZED ({nearest_of.format(i=rounds)})")
    ctes.append(f"digests AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c)")
    return f"""WITH {", ".join(ctes)}
SELECT k.vec_id, CAST(l.best.c AS INTEGER) AS cluster, l.best.s AS distance,
  CAST(sum(l.best.s) OVER (PARTITION BY l.best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(l.best.s) OVER () AS BIGINT) AS inertia, g.h AS centroid_sha256
FROM last l JOIN kept k ON k.r = l.r JOIN digests g ON g.c = l.best.c
"""
