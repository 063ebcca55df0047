"""Hard negatives against the scores of all pairs."""

import numpy as np
import pytest

from pluvio.llm import hard_negatives as H, queries
from pluvio.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(points, every=100, positives=5, negatives=10, low=30, high=90):
    """``points``: (id, label, integers)."""
    ids = np.array([p[0] for p in points])
    labels = np.array([p[1] for p in points])
    x = np.array([p[2] for p in points], object)
    out = []
    for i in np.flatnonzero(ids % every == 0):
        s = (x * x[i]).sum(axis=1)
        order = sorted(range(len(ids)), key=lambda j: (-s[j], ids[j]))
        for p in [j for j in order if labels[j] == labels[i] and j != i][:positives]:
            inside = [j for j in order if labels[j] != labels[i] and low * s[p] <= 100 * s[j] <= high * s[p]][:negatives]
            out.extend((int(ids[i]), int(ids[p]), k + 1, int(ids[j]), int(s[p]), int(s[j])) for k, j in enumerate(inside))
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in H.mine(H.quantised(df), **options).collect())


def points_of(rows):
    return [(i, label, [int(np.floor(256 * c)) for c in v]) for i, v, label in rows]


@pytest.fixture(scope="module")
def clustered():
    """Clusters, a vector that a third of the rows repeat, and plain noise."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16)) * rng.choice([0.05, 0.6], 1500)[:, None]
    x[rng.random(1500) < 0.34] = centres[0]
    labels = rng.integers(0, 4, 1500)
    return [(int(i), [float(c) for c in v], int(label)) for i, v, label in zip(rng.permutation(1500), x, labels)]


def test_cover_tree(clustered):
    x = np.array([p[2] for p in points_of(clustered)])
    longest = float(np.sqrt((x * x).sum(axis=1).max())) * (1 + 1e-12)
    tree = H.CoverTree(x, longest)
    y = H.augmented(x.astype(float), longest)
    assert sorted(tree.order.tolist()) == list(range(len(x))) and len(tree.first) > 20
    centre_rows = {tuple(c): i for i, c in enumerate(x.astype(float).tolist())}
    for k in range(len(tree.first)):
        rows = tree.order[tree.first[k]:tree.last[k]]
        at = y[centre_rows[tuple(tree.centres[k].tolist())]]
        assert np.linalg.norm(y[rows] - at, axis=1).max() <= tree.radius[k] + 1e-6          # covers its rows
        a, z = tree.child[k]
        if a < z:
            assert [tree.first[a], tree.last[z - 1]] == [tree.first[k], tree.last[k]]
            inner = y[[centre_rows[tuple(c)] for c in tree.centres[a:z].tolist()]]
            gap = np.linalg.norm(inner[:, None] - inner[None], axis=2) + np.eye(z - a) * 1e9
            assert gap.min() > max(tree.radius[a:z])                                      # centres lie apart
    seen = []
    q = x[0].astype(float)
    best = H.Best(5)

    def visit(rows):
        seen.extend(rows)
        best.add(rows, np.rint(x[rows] @ q).astype(np.int64))

    tree.descend(q, best.wanted, visit)
    s = x @ x[0]
    assert best.ids.tolist() == np.lexsort((np.arange(len(x)), -s))[:5].tolist()
    assert len(seen) < 0.9 * len(x)                                                       # skips what cannot come in


def test_clusters(spark, clustered):
    df = spark.createDataFrame(clustered, SCHEMA).repartition(3)
    want = plain(points_of(clustered))
    assert len(want) > 300 and mined(df) == want


def test_many_blocks_and_portions(spark, clustered, monkeypatch):
    for name, n in (("BLOCK", 100), ("PORTION", 4), ("SAMPLE", 50), ("LEAF", 4)):
        monkeypatch.setattr(H, name, n)
    assert mined(spark.createDataFrame(clustered, SCHEMA).repartition(3)) == plain(points_of(clustered))


def test_query(spark):
    rows = table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()
    points = [(r[0], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2], [int(np.floor(256 * float(c))) for c in r[1]]) for r in rows]
    assert sorted(tuple(r) for r in queries.op13_hard_negatives(spark, SF).collect()) == plain(points)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.25], 2), (4, None, 2), (5, [0.5, None], 2),
            (6, [nan, 0.5], 2), (7, [0.5, inf], 2), (8, [0.5, 0.5], None), (None, [0.5, 0.5], 2), (9, [0.5, 0.5, 0.5], 2),
            (2, [0.5, 0.5], 2), (10, [0.0, 0.0], 3), (11, [], 2), (100, [-1.0, 0.0], 3), (200, [0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    used = [r for r in rows if r[0] in (0, 1, 2, 3, 10, 100, 200)]
    used = list({r[0]: r for r in used}.values())
    wide = df.selectExpr("*", "1 as x", "2 as n", "3 as ask", "4 as cell", "5 as block", "6 as score", "7 as id")
    assert mined(wide) == plain(points_of(used))
    assert mined(df.limit(0)) == [] and mined(df.filter("vec_id is null")) == [] and mined(df.filter("vec_id = 3")) == []


def test_ties_and_large_components(spark):
    rows = [(i, [1.0, 2.0], i % 2) for i in range(300)]
    assert mined(spark.createDataFrame(rows, SCHEMA), low=30, high=100) == plain(points_of(rows), low=30, high=100)
    big = [(i, [float(1 << 22) + (i * i % 97) / 256, float(i % 3)], i % 2) for i in range(120)]            # products beyond 2 ** 53
    assert mined(spark.createDataFrame(big, SCHEMA), low=30, high=100) == plain(points_of(big), low=30, high=100)
