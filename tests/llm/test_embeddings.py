import numpy as np
import pytest

from twintally.llm.embeddings import near_vectors
from twintally.llm.scratch import Scratch

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, cell int, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 3) for i, v in rows], SCHEMA)


def brute_force(vectors, threshold):
    x = np.array(vectors, np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    root = np.arange(len(near))
    while True:
        lower = np.minimum(root, np.where(near, root[None, :], len(root)).min(axis=1))
        if (lower == root).all():
            return near.sum(axis=1), root
        root = lower


def clusters(rng, n, size, d, noise):
    """Groups whose members differ by noise that puts many cosines on both sides of 0.9."""
    centres = rng.normal(size=(n, d))
    return np.concatenate([c / np.linalg.norm(c) + rng.normal(size=(size, d)) * noise / np.sqrt(d) for c in centres])


@pytest.mark.parametrize("slack", ["usual", "worst"])
@pytest.mark.parametrize("d", [3, 16, 64])
def test_against_all_pairs(spark, slack, d):
    rng = np.random.default_rng(d)
    vectors = np.concatenate([clusters(rng, 40, 12, d, 0.33), rng.normal(size=(200, d))])
    vectors = np.concatenate([vectors, vectors[:60] * 2]).astype(np.float32)
    found = sorted(near_vectors(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]), slack=slack, chunk=100).collect())
    n_links, root = brute_force(vectors, 0.9)
    got = np.array([r.n_links for r in found])
    # The 60 doubled vectors have another length; their cosines round either way only at 1.
    if slack == "worst":
        assert (got == n_links).all() and [r.component_id for r in found] == root.tolist()
    else:
        assert (got <= n_links).all() and got.sum() >= 0.99 * n_links.sum()
    assert all(r.kept == (r.component_id == r.vec_id) for r in found)


def test_vectors_with_a_falling_spectrum(spark):
    rng = np.random.default_rng(3)
    spread = 1 / np.arange(1, 257)
    vectors = rng.normal(size=(1500, 256)) * spread
    vectors = np.concatenate([vectors, vectors + rng.normal(size=vectors.shape) * spread * 0.4]).astype(np.float32)
    found = sorted(near_vectors(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])).collect())
    n_links, root = brute_force(vectors, 0.9)
    assert [r.n_links for r in found] == n_links.tolist() and [r.component_id for r in found] == root.tolist()


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(500)] + [(500 + i, rng.normal(size=3).tolist()) for i in range(100)]
    found = sorted(near_vectors(frame(spark, rows), chunk=16).collect())
    n_links, root = brute_force([v for _, v in rows], 0.9)
    assert [r.n_links for r in found] == n_links.tolist() and [r.component_id for r in found] == root.tolist()


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]),
        (8, [1.0, -0.0]), (None, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [3e38, 3e38]), (11, [1e-38, 1e-38]),
    ]
    found = near_vectors(frame(spark, rows)).collect()
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found)
    assert got == sorted(
        [(str(i), 0, str(i), True) for i in (1, 2, 3, 4, 5, 6, 9)]
        + [("7", 3, "7", True), ("7", 3, "7", True), ("8", 3, "7", False), ("None", 3, "7", False)]
        + [("10", 1, "10", True), ("11", 1, "10", False)]
    )
    assert near_vectors(frame(spark, [])).collect() == []
    assert [r.n_links for r in near_vectors(frame(spark, rows[:6])).collect()] == [0] * 6


def test_comparison_shuffles_nothing(spark, monkeypatch):
    """What is compared must not be copied for every cell it is near to: that took 124 times the input of 54 MB."""
    plans = {}
    keep = Scratch.keep

    def told(self, kept, name):
        plans[name] = kept._jdf.queryExecution().executedPlan().toString()
        return keep(self, kept, name)

    monkeypatch.setattr(Scratch, "keep", told)
    monkeypatch.setattr("twintally.llm.embeddings.MOST_BLOCK", 100 * 16 * 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vectors = np.random.default_rng(1).normal(size=(600, 16)).astype(np.float32)
        found = sorted(near_vectors(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]), threshold=0.6).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    n_links, root = brute_force(vectors, 0.6)
    assert [r.n_links for r in found] == n_links.tolist() and [r.component_id for r in found] == root.tolist()
    assert n_links.sum() > 100 and "CartesianProduct" in plans["compared-16"] and "Exchange" not in plans["compared-16"]


def test_pairs_at_the_threshold_are_compared_in_double_precision(spark):
    angle = np.arccos(0.9) + np.array([0, -1e-9, 1e-9, -3e-8, 3e-8])
    rows = [(0, [1.0, 0.0, 0.0])]
    rows += [(i + 1, [float(np.cos(a)), float(np.sin(a)) * (-1) ** i, 1e-12 * i]) for i, a in enumerate(angle) if i]
    found = {r.vec_id: r for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    assert [found[i].n_links for i, _ in rows] == (near.sum(axis=1) - 1).tolist()
    assert near[0].tolist() == [True, True, False, True, False]


@pytest.mark.parametrize("chunk", [7, 8192])
def test_large_groups_and_copies(spark, chunk):
    """Rows of one place, some of them copies, over blocks of one cell and of several; identifiers repeat or are missing."""
    rng = np.random.default_rng(9)
    vectors = clusters(rng, 3, 60, 8, 0.4).astype(np.float32)
    vectors = np.concatenate([vectors, vectors[:40], -vectors[:5], vectors[:1].repeat(30, axis=0)])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = sorted(near_vectors(frame(spark, rows), chunk=chunk, most_fitted=96).collect())
    n_links, root = brute_force(vectors, 0.9)
    assert [r.n_links for r in found] == n_links.tolist() and [r.component_id for r in found] == root.tolist()
