"""Links of vectors of any size against all pairs, and odd tables."""

from __future__ import annotations

import tracemalloc
from decimal import Decimal, getcontext

import numpy as np
import pytest

from tripmill.llm import cover_tree
from tests.llm.test_operators import roots

getcontext().prec = 60


def cosine(a, b):
    """In decimals, which neither lose nor overflow a square."""
    a, b = [Decimal(x) for x in a], [Decimal(x) for x in b]
    return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)).sqrt()


def made(n, seed):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(n // 6, 6))
    vectors = centers[r.integers(0, len(centers), n)] + r.normal(0, 0.15, (n, 6))
    return vectors * 10.0 ** r.integers(-300, 300, n)[:, None]


@pytest.mark.parametrize("tree_size", [4096, 25])
def test_vectors_of_any_length(spark, tree_size):
    vectors = made(120, 1).tolist() + [[1e200] * 6] * 3 + [[1e-310] * 6, [5e-324, 0.0, 0.0, 0.0, 0.0, 0.0], [1.7e308] * 6]
    rows = list(enumerate(vectors))
    odd = [(900, None), (901, []), (902, [0.0] * 6), (903, [float("nan")] * 6), (904, [float("inf")] + [1.0] * 5), (905, [None] + [1.0] * 5), (906, [1.0])]
    frame = spark.createDataFrame([(k, v, "x", 1) for k, v in rows + odd], "vec_id long, embedding array<double>, n_links string, class int")
    got = {r.vec_id: r for r in cover_tree.near_duplicates(frame.repartition(4), tree_size=tree_size).collect()}
    links = [(i, j) for i in range(len(rows)) for j in range(i) if cosine(vectors[i], vectors[j]) >= Decimal("0.9")]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if abs(cosine(vectors[i], vectors[j]) - Decimal("0.9")) < Decimal("1e-9")]
    assert not near and len(links) > 100
    want = roots(len(rows), links)
    for k, _ in rows:
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (sum(k in pair for pair in links), want[k], want[k] == k)
    for k, _ in odd:
        assert (got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True)
    assert len(got) == len(rows) + len(odd)


def test_trees_refuse_what_is_no_unit_vector():
    with pytest.raises(ValueError, match="unit"):
        cover_tree.build(np.array([[1.0, 0.0], [np.inf, 1.0]]))


def test_empty_table_and_repeated_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [2.0, 4.0])], "vec_id long, embedding array<double>")
    assert cover_tree.near_duplicates(frame.limit(0)).count() == 0
    rows = cover_tree.near_duplicates(frame).collect()
    assert sorted((r.n_links, r.component_id, r.kept, r.vec_id is None) for r in rows) == [(2, 1, False, True), (2, 1, True, False), (2, 1, True, False)]


def test_pairs_of_centers_need_no_bound_each():
    points = cover_tree.unit(np.random.default_rng(3).normal(size=(3000, 64)))
    points[1500:1700] = cover_tree.unit(points[:200] + np.random.default_rng(4).normal(0, 0.03, (200, 64)))
    tree = cover_tree.build(points)
    tracemalloc.start()
    got = {(int(i), int(j)) for rows, columns in cover_tree.dual_pairs(tree, tree, 0.9) for i, j in zip(rows, columns)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(points @ points.T >= 0.9))} and len(got) > 3300
    assert peak < 40e6  # a block's cosines are 12 MB
