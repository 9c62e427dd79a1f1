"""Lloyd over whole numbers, against plain Python."""

import hashlib
import math

import pytest

from sigspark.llm import lloyd

SCHEMA = "vec_id long, embedding array<double>, cluster string"


def plain(rows, dim, k, rounds, scale=1024, seed=3):
    vectors = [(i, [math.floor(scale * x) if abs(x) < 2**52 else scale * int(x) for x in e]) for i, e in rows if e is not None and len(e) == dim and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(vectors, key=lambda v: (v[0] is None, hashlib.sha256(f"{seed}:{v[0]}".encode()).hexdigest(), v[1]))
    centroids = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = [[v for _, v in vectors if nearest(v)[1] == n] for n in range(len(centroids))]
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    out = [(i, nearest(v)[1], nearest(v)[0]) for i, v in vectors]
    by = {n: sum(d for _, m, d in out if m == n) for n in range(len(centroids))}
    held = lambda x: x if x < 1 << 63 else None
    return [(i, n, held(d), held(by[n]), held(sum(by.values()))) for i, n, d in out], centroids


def rows_of(spark, rows, dim, k, rounds, parts=3):
    found, centroids = lloyd.cluster(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(parts), dim, k, rounds)
    assert dict(found.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint"}
    return sorted((tuple(r) for r in found.collect()), key=str), [list(c) for c in centroids]


def check(spark, rows, dim, k, rounds):
    got, centroids = rows_of(spark, rows, dim, k, rounds)
    want, wanted = plain(rows, dim, k, rounds)
    assert centroids == wanted and got == sorted(want, key=str)


def test_against_plain_python(spark):
    import random

    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 3, 0.5) for _ in range(4)]) for i in range(300)]
    check(spark, rows, 4, 5, 4)


def test_left_out_rows_ties_repeats_and_null_ids(spark):
    nan, inf = math.nan, math.inf
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 0.0]), (6, [inf, 0.0]), (7, [0.0, -inf]), (8, [0.0, 0.0]), (9, [2.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (10, [-3.0, 1e-9]), (None, [-1e-9, 5.0]), (11, [1.0, 2.0, 3.0])]
    check(spark, rows, 2, 3, 3)
    check(spark, rows, 2, 8, 2)  # more centroids than vectors
    check(spark, [(None, [1.0, 2.0])], 2, 2, 2)


def test_an_empty_centroid_stays(spark):
    rows = [(i, [0.0, 0.0]) for i in range(6)] + [(9, [4.0, 4.0])]
    check(spark, rows, 2, 5, 3)


@pytest.mark.parametrize("big", [2.0**20, 1e12, 1e19, 3e38, 1.7e308])
def test_huge_components(spark, big):
    rows = [(i, [big * (i % 3 - 1), 0.25 * i, -big / (i + 1)]) for i in range(12)]
    check(spark, rows, 3, 3, 3)


def test_no_vectors(spark):
    got, centroids = rows_of(spark, [(1, None)], 2, 3, 2)
    assert got == [] and centroids == []


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, centroids = plain(rows, 64, 8, 10)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    got = lloyd.op12_lloyd(spark, sf).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(map(tuple, got)) == sorted((*w, digests[w[1]]) for w in want)
