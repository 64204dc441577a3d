import numpy as np
import pytest

from kilowatt.llm import lattice_dedup as lattice


def test_decoder_finds_the_nearest_point():
    x = np.random.default_rng(0).normal(size=(400, 8)) * 3
    point = lattice.decode_e8(x)
    assert np.allclose(2 * point, np.rint(2 * point)) and np.allclose(point.sum(1) % 2, 0)
    others = ((x[:, None] - point[:, None] - lattice.shortest_vectors()[None]) ** 2).sum(2).min(1)
    assert (((x - point) ** 2).sum(1) <= others + 1e-9).all()


def brute(rows, least=0.98):
    """(n_links, component) per row by comparing all pairs."""
    def usable(v, label):
        return label is not None and v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
    ok = [usable(v, label) for _, v, label in rows]
    linked = np.zeros((len(rows), len(rows)), bool)
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows):
            if i != j and ok[i] and ok[j] and la == lb and len(a) == len(b):
                a64, b64 = np.array(a, float), np.array(b, float)
                linked[i, j] = a64 @ b64 / np.linalg.norm(a64) / np.linalg.norm(b64) >= least
    low = np.array([r[0] for r in rows])
    while True:
        new = np.minimum(low, np.where(linked, low[None, :], 2 ** 60).min(1))
        if (new == low).all():
            return linked.sum(1).tolist(), low.tolist()
        low = new


def check(rows, found):
    n, low = brute(rows)
    want = sorted((r[0], a, b, r[0] == b) for r, a, b in zip(rows, n, low))
    assert sorted(tuple(r) for r in found.collect()) == want


def near(rng, v, cosine):
    z = rng.normal(size=v.shape)
    z -= (z @ v) * v
    return cosine * v + np.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z)


def unit(rng, n):
    v = rng.normal(size=n)
    return v / np.linalg.norm(v)


@pytest.mark.parametrize("cell_rows", [3, 256])
def test_planted_groups_equal_brute_force(spark, cell_rows):
    rng, rows = np.random.default_rng(2), []
    for g in range(12):
        base = unit(rng, 24)
        for cosine in (0.999, 0.99, 0.9805, 0.975, 0.9):
            rows += [(len(rows), near(rng, base, cosine).tolist(), g % 3), (len(rows) + 1, base.tolist(), g % 3)]
    dense = unit(rng, 24)
    rows += [(len(rows) + i, near(rng, dense, 0.9999).tolist(), 1) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    check(rows, lattice.near_vectors(table, cell_rows=cell_rows))


def test_recall_at_the_limit():
    rng = np.random.default_rng(6)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b = np.array([near(rng, v, 0.98) for v in a])
    one, two = (lattice.cells(x, 4, 4, 0.9, 5) for x in (a, b))
    assert (one[:, :, None] == two[:, None, :]).any((1, 2)).mean() > 0.99


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1),
            (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1e-200, 0.0], 1), (13, [1e200, 0.0], 1), (14, [-1.0, 0.0], 1), (15, [1.0, 0.0], 1)]
    table = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, label int, key string, n int")
    want = {1: (4, 1), 2: (4, 1), 12: (4, 1), 13: (4, 1), 15: (4, 1)}
    for r in lattice.near_vectors(table).collect():
        assert (r["n_links"], r["component_id"]) == want.get(r["vec_id"], (0, r["vec_id"])), r
    assert lattice.near_vectors(table.limit(0)).count() == 0


def test_repeated_rows_and_ids(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0], 1)] * 3 + [(None, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(str, (tuple(r) for r in lattice.near_vectors(table).collect()))) == sorted(map(str, [(1, 3, 1, True)] * 3 + [(None, 3, 1, False)]))
