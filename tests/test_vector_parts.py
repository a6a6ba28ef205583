"""The vector index in parts and blocks of bounded size."""

import numpy as np

from ledgerline.operators import vector_index
from tests.test_states_vectors import brute, vectors


def test_exact_search_in_parts_and_blocks(spark, monkeypatch):
    """No query is repeated for each list in a Python task, and results are those of brute force however rows are dealt."""
    made, df = vectors(spark)
    index = vector_index.VectorIndex(df, "k", "v", 10)
    asked = [(i, np.array(v)) for i, v in made if v is not None and i % 50 == 0]
    for searched, at_once in ((10_000, 10_000), (100, 5)):
        monkeypatch.setattr(vector_index, "SEARCHED", searched, raising=False)
        monkeypatch.setattr(vector_index, "ASKED", at_once, raising=False)
        found = index.search(df.where("k % 50 = 0"), "k", "v", 7, probes=None)
        assert "MapInPandas" not in found._jdf.queryExecution().executedPlan().toString()
        assert {(r["query"], r.id, r.similarity, r.place) for r in found.collect()} == brute(made, asked, 7)
    all_lists = index.search(df.where("k % 50 = 0"), "k", "v", 7, probes=10)
    assert {(r["query"], r.id, r.similarity, r.place) for r in all_lists.collect()} == brute(made, asked, 7)


def test_a_list_of_many_vectors_has_many_parts(spark, monkeypatch):
    monkeypatch.setattr(vector_index, "PART", 100)
    made, _ = vectors(spark, 200)
    known = [(i, v) for i, v in made if v is not None] + [(1000 + i, made[0][1]) for i in range(700)]
    df = spark.createDataFrame(known, "k long, v array<double>")
    index = vector_index.VectorIndex(df, "k", "v", 20)
    assert index.vectors.groupBy("list", "part").count().agg({"count": "max"}).first()[0] < 200
    got = {(r["query"], r.id, r.similarity, r.place) for r in index.search(df.where("k % 40 = 0"), "k", "v", 10, probes=20).collect()}
    assert got == brute(known, [(i, np.array(v)) for i, v in known if i % 40 == 0], 10)


def test_best_of_blocks_are_those_of_the_whole(monkeypatch):
    rng = np.random.default_rng(1)
    asked, stored = rng.integers(-2, 3, (37, 4)).astype(float), rng.integers(-2, 3, (90, 4)).astype(float)  # many ties
    likeness = np.round(asked @ stored.T, 4) + 0.0
    top = np.argsort(-likeness, axis=1, kind="stable")
    for cells in (1, 500, 1 << 20):
        monkeypatch.setattr(vector_index, "CELLS", cells)
        for k in (1, 10, 90, 200):
            query, at, best = vector_index.highest(asked, stored, k)
            assert at.tolist() == top[:, :k].ravel().tolist() and best.tolist() == np.take_along_axis(likeness, top[:, :k], 1).ravel().tolist()
            assert query.tolist() == np.repeat(np.arange(37), min(k, 90)).tolist()
        number, most = vector_index.nearest(asked, stored)
        assert number.tolist() == (asked @ stored.T).argmax(1).tolist() and most.tolist() == (asked @ stored.T).max(1).tolist()
