"""The range join of vectors against brute force."""

import random

import numpy as np
import pytest

from ticketlake.llm import pivot_join

SCHEMA = "vec_id long, embedding array<float>, label string, n long, cls string"


def vectors(seed, dim=6):
    """Clusters of all widths, chains, copies, lengths of their own, and vectors that take no part."""
    rng = np.random.default_rng(seed)
    rows = []
    for spread, size in ((0.02, 60), (0.15, 40), (0.35, 40), (2.0, 80)):
        for _ in range(2):
            middle = rng.normal(size=dim)
            rows += [middle / np.linalg.norm(middle) * 3 + spread * rng.normal(size=dim) for _ in range(size // 2)]
    angles = np.arange(40) * 0.3  # each links with its neighbours only
    rows += [[np.cos(a), np.sin(a), *[0.0] * (dim - 2)] for a in angles]
    rows += [list(rows[3])] * 30 + [list(np.asarray(rows[5]) * 2)] * 3
    rows += [rng.normal(size=3) for _ in range(20)] + [[1.0], [2.0], [-1.0]]
    rows += [None, [], [0.0] * dim, [1.0, None, *[0.0] * (dim - 2)], [float("nan")] * dim, [float("inf"), *[0.0] * (dim - 1)], [1e-38] * dim, [3e38] * dim]
    ids = random.Random(seed).sample(range(-50, 1000), len(rows))
    out = [(i, None if v is None else [None if x is None else float(x) for x in v], "clash", 7, "clash") for i, v in zip(ids, rows)]
    return [*out, (None, *out[3][1:]), (None, *out[250][1:]), out[4], out[4], (out[4][0], *out[100][1:]), (None, None, "clash", 7, "clash")]


def brute(rows, cosine):
    xs = []
    for _, v, *_ in rows:
        x = None if not v or any(c is None for c in v) else np.asarray(v, np.float32).astype(np.float64)
        xs.append(None if x is None or not np.isfinite(x).all() or not x.any() else x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()))
    near = [[i != j and a is not None and b is not None and len(a) == len(b) and float(a @ b) >= cosine for j, b in enumerate(xs)] for i, a in enumerate(xs)]
    group = list(range(len(rows)))
    while True:
        new = [min(group[j] for j in [i, *[j for j, x in enumerate(line) if x]]) for i, line in enumerate(near)]
        if new == group:
            break
        group = new
    out = []
    for i, (vec_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        least = vec_id if xs[i] is None else min(ids, default=None)
        out.append((vec_id, sum(near[i]), least, vec_id == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed, cosine, cell_rows, block", [(1, 0.9, 1000, 4 << 20), (2, 0.9, 10, 4 << 20), (3, 0.9, 20, 2000), (4, 0.99, 5, 3000), (5, 0.5, 10, 5000)])
def test_links_like_brute_force(spark, seed, cosine, cell_rows, block):
    rows = vectors(seed)
    got = pivot_join.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), cosine, cell_rows=cell_rows, block_bytes=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, cosine)


def test_a_dense_group_is_not_compared(spark, monkeypatch):
    """All of 3,000 near copies are linked by the bounds: no vector asks anything."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.array([5.0, 0, 0, 0]) + 0.05 * rng.normal(size=4)]) for i in range(3000)]

    def refuse(parts, cosine):
        def run(batches):
            for batch in batches:
                assert not batch.num_rows
                yield batch

        return run

    monkeypatch.setattr(pivot_join, "_compare_blocks", refuse)
    got = pivot_join.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert all((r.n_links, r.component_id, r.kept) == (2999, 0, r.vec_id == 0) for r in got) and len(got) == 3000


def test_bounds_keep_far_parts_apart():
    """A vector at its pivot asks no far part; one that may have neighbours there does."""
    a, b = np.array([1.0, 0.0, 0.0]), np.array([0.0, 1.0, 0.0])
    pivots = pivot_join.Pivots([a.tobytes(), b.tobytes()])
    row = lambda part, most: type("R", (), {"part": part, "total": 5, "leader": part, "least": 0.0, "most": most, "size": 3, "sizes": 3, "bytes": 10})
    eps = float(np.arccos(0.9))
    parts = pivot_join.Parts([row(0, 0.1), row(2, 0.1)], 2, eps, 1 << 20)
    between = np.array([np.cos(1.1), np.sin(1.1), 0.0])
    every, ask = parts.relations(pivots.angles(np.stack((a, between))), np.array([0, 0]), 3)
    assert every.tolist() == [[True, False, False, False], [True, False, False, False]]
    assert ask.tolist() == [[False] * 4, [False, False, True, False]]


def test_forest_keeps_components():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)

    def labels(x, y):
        label = np.arange(300)
        for _ in range(300):
            for p, q in zip(x, y):
                label[p] = label[q] = min(label[p], label[q])
        return label.tolist()

    x, y = pivot_join.forest(a, b)
    assert labels(a, b) == labels(x, y) and len(x) < len(np.unique(np.concatenate((a, b))))


def test_no_vectors(spark):
    for rows in ([], [(1, None), (2, [0.0])]):
        got = pivot_join.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
        assert sorted(map(tuple, got)) == [(i, 0, i, True) for i, _ in rows]
