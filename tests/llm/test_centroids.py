"""Clustering by the bisector tournament against plain Python."""

import hashlib
import math
import random

import oracle
import pytest

from courtlake.llm import centroids, queries

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, x long, n long, total long"


def brute(rows, k, rounds, dims):
    kept = [(i, [math.floor(256 * v) for v in e]) for i, e in rows if e is not None and len(e) == dims and all(v is not None and math.isfinite(v) for v in e)]
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    c = [x for _, x in sorted(kept, key=key)[:k]]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
    nearest = lambda x: min(range(len(c)), key=lambda j: (far(x, c[j]), j))
    for _ in range(rounds):
        own = [nearest(x) for _, x in kept]
        c = [[sum(x[d] for (_, x), o in zip(kept, own, strict=True) if o == j) // own.count(j) for d in range(dims)] if j in own else c[j] for j in range(len(c))]
    found = [(i, nearest(x), x) for i, x in kept]
    cost = [far(x, c[j]) for _, j, x in found]
    sums = [sum(d for d, (_, o, _) in zip(cost, found, strict=True) if o == j) for j in range(len(c))]
    sha = [hashlib.sha256(",".join(map(str, y)).encode()).hexdigest() for y in c]
    return sorted(((i, j, d, sums[j], sum(cost), sha[j]) for (i, j, _), d in zip(found, cost, strict=True)), key=repr)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(3)
    rows = [(i, [rng.choice((-0.5, 0.25, 0.0, rng.random() - 0.5)) for _ in range(4)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(100)] + [rows[7], rows[7], (None, rows[9][1]), (None, [0.1, 0.2, 0.3, 0.4])]
    odd = [None, [], [0.1] * 3, [0.1] * 5, [0.1, None, 0.2, 0.3], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [-float("inf"), 1.0, 1.0, 1.0]]
    return rows + [(500 + i, e) for i, e in enumerate(odd)]


def table(spark, rows):
    return spark.createDataFrame([(i, e, None, 1, 2, 3, 4) for i, e in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize(("k", "rounds"), [(6, 5), (6, 0), (1, 2), (1000, 1)])
def test_clusters_equal_plain_python(spark, vectors, k, rounds):
    df = table(spark, vectors)
    stored = [(r.vec_id, r.embedding) for r in df.collect()]  # as floats
    got = sorted(map(tuple, centroids.cluster(df, k=k, rounds=rounds, dims=4).collect()), key=repr)
    assert got == brute(stored, k, rounds, 4)


def test_ties_go_to_the_smaller_number():
    b = centroids.Bisectors.of([[0, 0], [2, 0], [0, 2], [2, 0]])
    assert b.nearest(centroids.np.array([[1, 0], [1, 1], [2, 0], [3, 0], [0, 2]]))[0].tolist() == [0, 0, 1, 1, 2]


def test_no_vectors_and_vectors_beyond_64_bits(spark):
    assert centroids.cluster(table(spark, []), dims=4).collect() == []
    assert centroids.cluster(table(spark, [(1, [0.5])]), dims=4).collect() == []
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(table(spark, [(1, [1e30, 0.0, 0.0, 0.0])]), dims=4).collect()


def test_query_equals_sql(spark):
    oracle.compare(spark, queries.QUERIES["op11_centroid_clustering"], queries.ORACLES["op11_centroid_clustering"])
