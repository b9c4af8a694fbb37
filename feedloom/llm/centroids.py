"""Centroid clustering of integer vectors; the nearest centroid comes from a tournament of bisectors.

For centroids i < j, the sign of `x . n - t` with the integer normal `n = 2 (c_j - c_i)` and the integer threshold
`t = |c_j|^2 - |c_i|^2` says which one is nearer to `x`: above zero it is j; zero, a tie, favours i. A vector meets the
centroids in order of their numbers; each of the k - 1 sign tests eliminates one, and the one left is the nearest.
All arithmetic is on integers, so results are exact and do not depend on the order of rows.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import mapped, settle

#: Fixed scale of the components.
SCALE = 64
#: Below this size, sums of 64-bit products over up to 256 components can't overflow; larger ones are Python integers.
NARROW = 1 << 26
#: Sums travel in digits of this many bits, so that adding them up over any number of tasks stays in a long.
DIGIT = 40
#: Rows that the search for the first centroids expects to look at.
SEEDS_SEEN = 64

LONG_MAX = (1 << 63) - 1


class Tournament:
    """The nearest of some centroids, for many integer vectors at a time."""

    def __init__(self, centroids: list[list[int]]):
        narrow = max((abs(x) for c in centroids for x in c), default=0) <= NARROW
        self.centroids = np.array(centroids, np.int64 if narrow else object)
        squares = (self.centroids * self.centroids).sum(axis=1)
        self.normals = 2 * (self.centroids[None, :, :] - self.centroids[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each row, and the squared distance to it."""
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            side = (x * self.normals[best, j]).sum(axis=1) - self.thresholds[best, j]
            best[side > 0] = j
        away = x - self.centroids[best]
        return best, (away * away).sum(axis=1)


def scaled(x: float) -> int:
    return math.floor(SCALE * x) if abs(x) < 2.0**60 else SCALE * int(x)


def integers(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of floor(64 x); 64-bit integers where all are small, Python integers otherwise."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)
    if np.abs(values).max(initial=0) < NARROW // SCALE:
        return np.floor(SCALE * values).astype(np.int64)
    return np.array([[scaled(x) for x in row] for row in values.tolist()], object)


def usable(vectors: DataFrame, dims: int) -> DataFrame:
    """Rows (vec_id, embedding array<double>) of the vectors with exactly `dims` finite components."""
    embedding = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", embedding.alias("embedding")).where((F.size("embedding") == dims) & finite)


def first_centroids(kept: DataFrame, rows: int, k: int, salt: str) -> list[list[int]]:
    """The `k` vectors of smallest sha256 of salt and id, in that order; equal ids in order of their components.

    Only rows below a bound on the hash are sorted. The bound lets through a few rows whatever the size of the
    table and is raised until there are `k`, so tasks send what can win and nothing else.
    """
    name = F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    hashed = kept.withColumn("_hash", F.sha2(name, 256))
    bound = max(k, SEEDS_SEEN) / max(rows, 1)
    while True:
        some = hashed if bound >= 1 else hashed.where(F.substring("_hash", 1, 8) < f"{int(bound * 2**32):08x}")
        found = some.orderBy("_hash", "embedding").limit(k).collect()
        if len(found) == k or bound >= 1:
            return [[scaled(x) for x in r["embedding"]] for r in found]
        bound *= 8


def cluster_sums(kept: DataFrame, centroids: list[list[int]], dims: int) -> dict[int, tuple[int, list[int]]]:
    """Number and exact component sums of the vectors of each non-empty cluster.

    Every task adds up its own vectors, Spark adds up the tasks, and one row per cluster and digit comes back.
    """

    def partial(batches):
        tournament = Tournament(centroids)
        sums = np.zeros((len(centroids), dims), object)
        counts = np.zeros(len(centroids), np.int64)
        for batch in batches:
            x = integers(batch.column("embedding"), dims)
            best, _ = tournament.nearest(x)
            for c in np.unique(best):
                mine = x[best == c]
                sums[c] += mine.sum(axis=0)
                counts[c] += len(mine)
        rows = []
        for c in np.flatnonzero(counts):
            size, sign, place = abs(sums[c]), np.where(sums[c] < 0, -1, 1), 0
            while place == 0 or size.any():
                digits = (sign * (size & ((1 << DIGIT) - 1))).tolist()
                rows.append({"cluster": int(c), "place": place, "n": int(counts[c]), "digits": digits})
                size, place = size >> DIGIT, place + 1
        yield pa.RecordBatch.from_pylist(rows, pa.schema({"cluster": pa.int32(), "place": pa.int32(), "n": pa.int64(), "digits": pa.list_(pa.int64())}))

    parts = kept.select("embedding").mapInArrow(partial, "cluster int, place int, n long, digits array<long>")
    totals = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), *(F.sum(F.col("digits")[i]).alias(f"d{i}") for i in range(dims)))
    out: dict[int, tuple[int, list[int]]] = {}
    for row in totals.collect():
        n, sums = out.get(row["cluster"], (0, [0] * dims))
        n = row["n"] if row["place"] == 0 else n
        out[row["cluster"]] = n, [s + (row[f"d{i}"] << DIGIT * row["place"]) for i, s in enumerate(sums)]
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, salt: str = "1:") -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one per usable vector.

    Vectors (vec_id, embedding) with another number of components, a null or one that is not finite are left out;
    the others take part as integers floor(64 x). Repeated rows count each. A null vec_id hashes as the empty text.
    With fewer usable vectors than `k` each one starts a centroid; an empty table gives no rows. A distance, or a sum of
    them, beyond a long is null. Other columns are not read. The vectors are scanned once a round and once at the end;
    centroids, `k` rows, are all that comes to the driver.
    """
    kept = usable(vectors, dims)
    centroids = first_centroids(kept, vectors.count(), k, salt)
    for _ in range(rounds if centroids else 0):
        for c, (n, sums) in cluster_sums(kept, centroids, dims).items():
            centroids[c] = [s // n for s in sums]

    def assign(batch):
        best, distance = Tournament(centroids).nearest(integers(batch.column("embedding"), dims))
        fits = [d if d <= LONG_MAX else None for d in distance.tolist()]
        yield {"vec_id": batch.column("vec_id"), "cluster": pa.array(best, pa.int32()), "distance": pa.array(fits, pa.int64())}

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    assigned = settle(mapped(kept, assign, f"vec_id {id_type}, cluster int, distance long", rows=1_024), "clusters")
    whole = F.count(F.lit(1)) == F.count("distance")
    sums = assigned.groupBy("cluster").agg(F.when(whole, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("sum"))
    by_cluster = {r["cluster"]: r["sum"] for r in sums.collect()}
    total = None if None in by_cluster.values() else sum(by_cluster.values(), Decimal(0))
    fit = lambda x: None if x is None or x > LONG_MAX else int(x)
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    rows = [(c, fit(s), fit(total), digest(centroids[c])) for c, s in sorted(by_cluster.items())]
    of_cluster = vectors.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql_round(before: str, after: str) -> str:
    """Assign all vectors to the centroids `before` and name the moved ones `after`."""
    return f""",
    a_{after} AS ({_sql_nearest(before)}),
    s_{after} AS (SELECT cluster, pos, sum(x) AS s, count(*) AS n FROM a_{after} JOIN x USING (r) GROUP BY cluster, pos),
    {after} AS (SELECT b.cluster, b.pos, CAST(coalesce((s.s - ((s.s % s.n) + s.n) % s.n) // s.n, b.x) AS BIGINT) AS x
      FROM {before} b LEFT JOIN s_{after} s USING (cluster, pos))"""


def _sql_nearest(centroids: str) -> str:
    return f"""SELECT r, cluster, d FROM (SELECT x.r, c.cluster, sum((x.x - c.x) * (x.x - c.x)) AS d
      FROM x JOIN {centroids} c USING (pos) GROUP BY x.r, c.cluster)
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1"""


def oracle(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """The same clusters by measuring every distance."""
    names = [f"c{i}" for i in range(rounds + 1)]
    steps = "".join(_sql_round(a, b) for a, b in zip(names, names[1:]))
    last = names[-1]
    return f"""WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding FROM embeddings
      WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
    x AS (SELECT r, unnest(range(1, {dims} + 1)) AS pos,
      CAST(floor({SCALE} * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM v),
    h AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM v),
    c0 AS (SELECT cluster, pos, x FROM h JOIN x USING (r) WHERE cluster < {k}){steps},
    a AS ({_sql_nearest(last)}),
    t AS (SELECT cluster, sum(d) AS s FROM a GROUP BY cluster),
    g AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS digest FROM {last} GROUP BY cluster)
    SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(t.s AS BIGINT) AS cluster_inertia,
      CAST((SELECT sum(s) FROM t) AS BIGINT) AS inertia, digest AS centroid_sha256
    FROM a JOIN v USING (r) JOIN t ON t.cluster = a.cluster JOIN g ON g.cluster = a.cluster"""
