"""Centroid clustering: plain Lloyd over whole numbers.

``quantized`` keeps vectors with the right number of finite components;
``nearest`` sends the centroids (k rows, whatever the table's size) to all
tasks, where ``mapInPandas`` turns components into floor(scale * x) and takes
exact squared differences centroid by centroid. ``moved`` adds the members of
each centroid in each partition, splits the sums into base-2^32 digits and
merges these through ``groupBy``, so that a round returns at most k * dim
numbers of a few digits to the driver. Sums, means and distances are exact.

Cases: vectors that are null, too short or too long, or have a null or
non-finite component are left out; of rows that share a vec_id each is kept;
a null vec_id is a vector like others, but starts a centroid only where too few
others do; equal distances go to the lowest number; with fewer vectors than
centroids there are as many centroids as vectors; none give no rows. Vectors whose squared
distances might exceed 64 bits are computed in Python's whole numbers; a distance or
inertia that a long does not hold is null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

DIM, K, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Components up to this keep 2^12 squared differences, and sums of 2^35 rows, within 63 bits.
PLAIN = 1 << 24
#: Rows that are compared with the centroids at once.
BLOCK = 4096

Centroids = tuple[tuple[int, ...], ...]


def kept(vectors: DataFrame, dim: int = DIM, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding as doubles) of the rows whose embedding has ``dim`` finite components."""
    x = F.col(embedding).cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.where((F.size(embedding) == dim) & good).select(F.col(vec_id).alias("vec_id"), x.alias("embedding"))


def whole(embeddings: pd.Series, scale: int) -> np.ndarray:
    """floor(scale * x): int64 where that is plain, else Python's whole numbers."""
    x = np.stack(embeddings.to_numpy()).astype(np.float64, copy=False)
    with np.errstate(over="ignore"):
        scaled = np.floor(x * scale)
    if np.abs(scaled).max() <= PLAIN:
        return scaled.astype(np.int64)
    small = np.abs(x) < 2.0**52  # beyond, x is whole and the product exact in whole numbers
    return np.array([[int(s) if b else int(v) * scale for v, s, b in zip(*row, strict=True)] for row in zip(x, scaled, small, strict=True)], dtype=object)


def _distances(x: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid of each row."""
    wide = x.dtype == object or max(abs(c) for row in centroids for c in row) > PLAIN
    x = x.astype(object) if wide else x
    best = at = None
    for k, row in enumerate(centroids):
        d = x - np.array(row, dtype=object if wide else np.int64)
        d = (d * d).sum(axis=1)
        if best is None:
            best, at = d, np.zeros(len(x), np.int32)
        else:
            nearer = d < best  # equal: the lower number stays
            best, at = np.where(nearer, d, best), np.where(nearer, np.int32(k), at)
    return at, best


def nearest(vectors: DataFrame, centroids: Centroids, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance) of kept vectors."""
    if not centroids:
        return vectors.select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("long").alias("distance")).limit(0)
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for a in range(0, len(frame), BLOCK):
                part = frame.iloc[a : a + BLOCK]
                at, d = _distances(whole(part["embedding"], scale), shared.value)
                d = pd.array([int(v) if v < 1 << 63 else None for v in d] if d.dtype == object else d, dtype="Int64")
                yield pd.DataFrame({"vec_id": part["vec_id"].astype("Int64").array, "cluster": at, "distance": d})

    return vectors.select("vec_id", "embedding").mapInPandas(run, "vec_id long, cluster int, distance long")


def _digits(n: int) -> list[int]:
    """n = sum of digit * 2^(32 place), all digits but the last in [0, 2^32)."""
    out = []
    while not -(1 << 31) <= n < 1 << 31:
        out.append(n & 0xFFFFFFFF)
        n >>= 32
    return [*out, n]


def moved(vectors: DataFrame, centroids: Centroids, scale: int = SCALE) -> Centroids:
    """The floor of the mean of each centroid's vectors; a centroid without any stays."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for frame in frames:
            for a in range(0, len(frame), BLOCK):
                x = whole(frame["embedding"].iloc[a : a + BLOCK], scale)
                at, _ = _distances(x, shared.value)
                for k in np.unique(at).tolist():
                    own = x[at == k]
                    counts[k] = counts.get(k, 0) + len(own)
                    total = own.sum(axis=0).tolist()
                    sums[k] = [p + q for p, q in zip(sums[k], total, strict=True)] if k in sums else total
        rows = [(k, -1, 0, n) for k, n in counts.items()]  # component -1: the number of rows
        rows += [(k, c, place, digit) for k, total in sums.items() for c, s in enumerate(total) for place, digit in enumerate(_digits(int(s)))]
        yield pd.DataFrame(rows, columns=["cluster", "component", "place", "digit"])

    parts = vectors.select("embedding").mapInPandas(run, "cluster int, component int, place int, digit long")
    got: dict[tuple[int, int], int] = {}
    for k, c, place, total in parts.groupBy("cluster", "component", "place").agg(F.sum(F.col("digit").cast("decimal(30,0)"))).collect():
        got[k, c] = got.get((k, c), 0) + (int(total) << (32 * place))
    return tuple(tuple(got[k, c] // got[k, -1] for c in range(len(row))) if (k, -1) in got else row for k, row in enumerate(centroids))


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED, scale: int = SCALE) -> Centroids:
    """The k vectors with the smallest SHA-256 of ``seed:vec_id``, in order; a vec_id's vectors by their components."""
    named = vectors.withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    rows = named.orderBy(F.asc_nulls_last("_h"), "embedding").limit(k).select("embedding").toPandas()
    return tuple(tuple(int(v) for v in row) for row in whole(rows["embedding"], scale)) if len(rows) else ()


def lloyd(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> Centroids:
    """Centroids after ``rounds`` rounds over kept vectors."""
    centroids = first_centroids(vectors, k, seed, scale)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids, scale)
    return centroids


def cluster(vectors: DataFrame, dim: int = DIM, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, Sequence[Sequence[int]]]:
    """(vec_id, cluster, distance, cluster_inertia, inertia) of the vectors that are kept, and the centroids."""
    own = kept(vectors, dim)
    centroids = lloyd(own, k, rounds, scale, seed)
    found = nearest(own, centroids, scale)
    sums = {r["cluster"]: r["s"] if r["held"] else None for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), (F.count("distance") == F.count("*")).alias("held")).collect()}
    all_ = None if None in sums.values() else sum(sums.values(), Decimal(0))
    long_ = lambda v: F.lit(int(v) if v is not None and v < 1 << 63 else None).cast("long")
    own_sum = F.lit(None).cast("long")
    for number, s in sums.items():
        own_sum = F.when(F.col("cluster") == number, long_(s)).otherwise(own_sum)
    return found.select("*", own_sum.alias("cluster_inertia"), long_(all_).alias("inertia")), centroids


def op12_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(table(spark, sf_dir, "embeddings"))
    digest = F.lit(None).cast("string")
    for number, row in enumerate(centroids):
        digest = F.when(F.col("cluster") == number, F.lit(hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())).otherwise(digest)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def _op12_sql() -> str:
    """Each round as two materialised steps: nearest centroids, then floors of means (whole numbers; floor, not truncation)."""
    near = """n{r} AS MATERIALIZED (SELECT vec_id, arg_min(k, (d, k)) AS k, min(d) AS d FROM (
  SELECT v.vec_id, c.k, sum((v.x - c.x) * (v.x - c.x)) AS d FROM v JOIN c{r} c USING (i) GROUP BY v.vec_id, c.k) GROUP BY vec_id)"""
    move = """c{s} AS MATERIALIZED (SELECT c.k, c.i, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
  SELECT k, i, CAST((t - ((t % n) + n) % n) // n AS BIGINT) AS x FROM (SELECT n{r}.k, v.i, sum(v.x) AS t, count(*) AS n FROM v JOIN n{r} USING (vec_id) GROUP BY n{r}.k, v.i)) m USING (k, i))"""
    steps = [f.format(r=r, s=r + 1) for r in range(ROUNDS) for f in (near, move)]
    return f"""
WITH kept AS MATERIALIZED (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
v AS MATERIALIZED (SELECT vec_id, i, CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range({DIM})) AS i FROM kept)),
f AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k FROM kept ORDER BY 2 LIMIT {K}),
c0 AS MATERIALIZED (SELECT f.k, v.i, v.x FROM f JOIN v USING (vec_id)),
{", ".join(steps)}, {near.format(r=ROUNDS)},
t AS (SELECT k, sum(d) AS s FROM n{ROUNDS} GROUP BY k), g AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h FROM c{ROUNDS} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(t.s AS BIGINT) AS cluster_inertia, CAST((SELECT sum(s) FROM t) AS BIGINT) AS inertia, g.h AS centroid_sha256
FROM n{ROUNDS} JOIN t USING (k) JOIN g USING (k)
"""


OP12_SQL = _op12_sql()
