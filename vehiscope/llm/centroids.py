"""Centroid clustering of vectors by a bisector tournament.

Components become integers ``floor(64 * x)``. For every pair of centroids
``i < j`` the bisector is known beforehand as an integer normal ``c_j - c_i`` and
a threshold ``|c_j|^2 - |c_i|^2``: a vector ``x`` is nearer to ``j`` if
``2 x . normal > threshold``. A vector plays ``k - 1`` such sign tests, the
centroid that has won so far against the next number; zero favours the smaller
number, so the last winner is the nearest centroid with the smallest number. Only
its distance is then computed, exactly.

A round is one Spark job: tasks play the tournament on Arrow batches and hand on
count, distance and component sums of each centroid, exactly; Spark adds these up,
and the driver sees ``k`` times 66 numbers. The vectors themselves are never shuffled, so a
centroid that holds most vectors is no heavier than another one.

Defined results
    vectors that are null, have another number of components, or hold a null, a
    NaN or an infinity are left out; integer components are held within
    +-2^27, so that every sum of squares fits 64 bits; repeated rows are rows of
    their own; a null vec_id is kept, but never a first centroid; first centroids
    that tie (equal vec_id) are taken in the order of their components; fewer
    vectors than ``k``: as many centroids as vectors; empty table: empty result;
    other columns are not read. An inertia beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vehiscope.llm.common import table

DIMENSIONS, CENTROIDS, ROUNDS = 64, 16, 3
SCALE = 64
#: Largest integer component: 64 * (2 * 2^27)^2 stays below 2^63.
LARGEST = 1 << 27
#: Rows for which a task holds integers at once.
ROWS = 8192

ASSIGNED = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
            "centroid_sha256 string")


def kept_rows(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that count, and their integer components."""
    lists = column.cast(pa.list_(pa.float64()))
    at = np.asarray(lists.offsets, dtype=np.int64)
    here = np.flatnonzero((np.diff(at) == dims) & np.asarray(lists.is_valid()))
    flat = lists.values.to_numpy(zero_copy_only=False)  # a null component reads as NaN
    rows = flat[at[here][:, None] + np.arange(dims)]
    good = np.isfinite(rows).all(axis=1)
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(rows[good] * SCALE), -LARGEST, LARGEST)
    return here[good], whole.astype(np.int64)


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.points = np.array(centroids, dtype=np.int64)
        squares = (self.points ** 2).sum(axis=1)
        self.normals = 2 * (self.points[None] - self.points[:, None])  # [i, j] = 2 (c_j - c_i)
        self.thresholds = squares[None] - squares[:, None]
        # doubles are exact and quicker while no sum of products reaches 2^53
        self.reach = int(np.abs(self.normals).sum(axis=2).max())

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The number of each vector's centroid after k - 1 sign tests."""
        kind = np.float64 if self.reach * int(np.abs(vectors).max(initial=0)) < 1 << 53 else np.int64
        x, normals = vectors.astype(kind), self.normals.astype(kind)
        winner = np.zeros(len(x), dtype=np.int64)
        for j in range(1, len(self.points)):
            side = np.einsum("nd,nd->n", x, normals[winner, j])
            winner[side > self.thresholds[winner, j]] = j
        return winner

    def distances(self, vectors: np.ndarray, winner: np.ndarray) -> np.ndarray:
        return ((vectors - self.points[winner]) ** 2).sum(axis=1)


def _portions(batches: Iterator[pa.RecordBatch], column: str, dims: int):
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            yield part, *kept_rows(part.column(column), dims)


def first_centroids(vectors: DataFrame, id_col: str, column: str, dims: int, k: int) -> list[list[int]]:
    """The k kept vectors with the smallest sha256 of ``1:<id>``, as integers."""
    good = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    whole = F.transform(column, lambda v: F.floor(F.greatest(F.least(
        v.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("long"))
    rows = (vectors.where((F.size(column) == dims) & good & F.col(id_col).isNotNull())
            .select(F.sha2(F.concat(F.lit("1:"), F.col(id_col).cast("string")), 256).alias("h"), whole.alias("v"))
            .orderBy("h", "v").limit(k).collect())
    return [list(r["v"]) for r in rows]


def cluster_sums(vectors: DataFrame, column: str, dims: int, centroids: list[list[int]]) -> dict[int, tuple]:
    """number -> (count, component sums, summed distance) over all vectors."""
    def play(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bisectors = Bisectors(centroids)
        k = len(centroids)
        count, far = [0] * k, [0] * k
        total = [[0] * dims for _ in range(k)]
        for _, _, x in _portions(batches, column, dims):
            winner = bisectors.nearest(x)
            distance = bisectors.distances(x, winner)
            for j in np.unique(winner).tolist():
                mine = x[winner == j]  # at most ROWS rows: 2^13 * 2^27 fits
                count[j] += len(mine)
                far[j] += sum(distance[winner == j].tolist())
                total[j] = [a + b for a, b in zip(total[j], mine.sum(axis=0).tolist())]
        rows = [(j, p, str(v)) for j in range(k) if count[j]
                for p, v in enumerate([count[j], far[j], *total[j]])]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.string())], names=["c", "p", "s"])

    parts = vectors.select(column).mapInArrow(play, "c int, p int, s string")
    out: dict[int, list[int]] = {}
    for c, p, s in parts.groupBy("c", "p").agg(F.sum(F.col("s").cast("decimal(38,0)"))).collect():
        out.setdefault(c, [0] * (dims + 2))[p] = int(s)
    return {j: (v[0], v[2:], v[1]) for j, v in out.items()}


def centroids_of(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", dims: int = DIMENSIONS,
                 k: int = CENTROIDS, rounds: int = ROUNDS) -> list[list[int]]:
    """The centroids after ``rounds`` rounds, each one job over all vectors."""
    centroids = first_centroids(vectors, id_col, column, dims, k)
    for _ in range(rounds if centroids else 0):
        for j, (n, sums, _far) in cluster_sums(vectors, column, dims, centroids).items():
            centroids[j] = [s // n for s in sums]  # floor; an empty centroid stays
    return centroids


def assign(vectors: DataFrame, centroids: list[list[int]], id_col: str = "vec_id", column: str = "embedding",
           dims: int = DIMENSIONS) -> DataFrame:
    """Every kept vector with its centroid, the distance, and the inertias."""
    far = {j: f for j, (_, _, f) in cluster_sums(vectors, column, dims, centroids).items()} if centroids else {}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def fits(v: int) -> int | None:
        return v if v < 1 << 63 else None
    each, whole = [fits(far.get(j, 0)) for j in range(len(centroids))], fits(sum(far.values()))

    def play(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not centroids:
            return
        bisectors = Bisectors(centroids)
        for part, here, x in _portions(batches, column, dims):
            winner = bisectors.nearest(x)
            own = pa.array(winner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col).take(pa.array(here)).cast(pa.int64()), own,
                 pa.array(bisectors.distances(x, winner)), pa.array(each, pa.int64()).take(own),
                 pa.array([whole] * len(here), pa.int64()), pa.array(digest, pa.string()).take(own)],
                names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return vectors.select(id_col, column).mapInArrow(play, ASSIGNED)


def cluster(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding", dims: int = DIMENSIONS,
            k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    return assign(vectors, centroids_of(vectors, id_col, column, dims, k, rounds), id_col, column, dims)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 centroids of all vectors after three rounds."""
    return cluster(table(spark, sf_dir, "embeddings"))


def _round_sql(k: int) -> str:
    return f"""
a{k} as (select r, cluster, d from (select x.r, c.j as cluster, sum((x.v - c.v) * (x.v - c.v)) as d,
    row_number() over (partition by x.r order by sum((x.v - c.v) * (x.v - c.v)), c.j) as place
  from x join c{k} c on x.p = c.p group by x.r, c.j) where place = 1)""" + (f""",
m{k} as (select a.cluster as j, x.p, sum(x.v) as s, count(*) as n
  from x join a{k} a on x.r = a.r group by a.cluster, x.p),
c{k + 1} as (select c.j, c.p, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.v)::hugeint as v
  from c{k} c left join m{k} m on c.j = m.j and c.p = m.p)""" if k < ROUNDS else "")


#: The same contract by all distances, for DuckDB.
OP13_SQL = f"""
with e as (select row_number() over () as r, vec_id, embedding from embeddings
  where len(embedding) = {DIMENSIONS}
    and len(list_filter(embedding, lambda v: v is not null and isfinite(v::double))) = {DIMENSIONS}),
x as (select r, vec_id, unnest(generate_series(1, {DIMENSIONS})) as p,
    floor(unnest(embedding)::double * {SCALE})::hugeint as v from e),
s as (select r, row_number() over (order by sha256('1:' || vec_id::varchar)) - 1 as j from e
  where vec_id is not null),
c0 as (select s.j, x.p, x.v from s join x on s.r = x.r where s.j < {CENTROIDS}),
{','.join(_round_sql(k) for k in range(ROUNDS + 1))},
h as (select j, sha256(string_agg(v::varchar, ',' order by p)) as h from c{ROUNDS} group by j)
select e.vec_id, a.cluster::int as cluster, a.d::bigint as distance,
  (sum(a.d) over (partition by a.cluster))::bigint as cluster_inertia, (sum(a.d) over ())::bigint as inertia,
  h.h as centroid_sha256
from e join a{ROUNDS} a on e.r = a.r join h on h.j = a.cluster
"""
