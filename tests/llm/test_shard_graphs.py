import numpy as np
from pyspark.sql import functions as F

from tidewire.llm import ann


def vectors_of_size(n: int, dimension: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(n, dimension))


def test_shards_grow_with_the_table(spark):
    vectors = vectors_of_size(1600, 6, 1)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    queries = ann.vectors_of(table, "vec_id", "embedding").filter(F.col("id") % 40 == 0)
    index = ann.build_index(table, 5, shard=20)
    assert index.count() == ann.SPREAD  # not 80 graphs, each of which every query would have to walk
    assert ann.build_index(table, 5, shard=20, numbers=100 * 64).count() == 16  # a graph stays bounded
    out = ann.search(index, queries, 5, block=8).toPandas().sort_values(["query_id", "rank"])
    assert len(out) == 5 * 40
    hit = 0
    for query, found in out.groupby("query_id"):
        score = vectors @ vectors[query]
        score[query] = -np.inf
        hit += len(set(np.argsort(-score)[:5]) & set(found["vec_id"]))
        assert np.allclose(found["score"], score[found["vec_id"]]) and (np.diff(found["score"]) <= 0).all()
    assert hit >= 0.97 * 5 * 40


def test_queries_walk_side_by_side(monkeypatch):
    vectors, queries = vectors_of_size(1200, 16, 2), vectors_of_size(150, 16, 3)
    calls, keys = [], ann.Graph._keys
    monkeypatch.setattr(ann.Graph, "_keys", lambda *a: calls.append(1) or keys(*a))
    graph = ann.Graph(vectors)
    assert not calls  # building compares blocks of points, it walks nowhere
    found = graph.nearest_each(queries, 60)
    assert len(calls) < 150  # steps of all queries together
    for row, query in zip(found, queries):
        assert len(set(row.tolist())) == 60 and (row >= 0).all()
        assert (np.diff((vectors[row] @ query)) <= 1e-4).all()
        assert graph.nearest(query, 60).tolist() == row.tolist()


def test_breadth_suffices_for_queries_that_are_not_in_the_graph():
    vectors, queries = vectors_of_size(6000, 64, 4), vectors_of_size(200, 64, 5)
    graph = ann.Graph(vectors)
    found = graph.nearest_each(queries, ann.needed_breadth(graph, 21))[:, :20]
    best = np.argsort(-(queries @ vectors.T), axis=1)[:, :20]
    assert sum(len(set(a) & set(b)) for a, b in zip(best.tolist(), found.tolist())) >= 0.96 * 20 * 200
    own = np.arange(0, 6000, 50)
    assert not (graph.nearest_each(vectors[own], 40, own) == own[:, None]).any()


def test_graphs_of_odd_sizes_and_scales():
    for n in (1, 2, 3, 17, 65, 600):
        vectors = vectors_of_size(n, 3, n)
        graph = ann.Graph(vectors)
        assert ann.needed_breadth(graph, 5) == ann.SEARCH_BREADTH or n > ann.SEARCH_BREADTH
        for query in vectors[:5]:
            best = np.argsort(-(vectors @ query))[: min(n, 5)]
            assert len(set(best) & set(graph.nearest(query, 96)[:5].tolist())) >= len(best) - 1
    near = vectors_of_size(500, 4, 7)
    for scale in (1e-150, 1e150):  # squares of which leave the range of single and double precision
        assert ann.Graph(near * scale).nearest(near[3] * scale, 96)[:5].tolist() == ann.Graph(near).nearest(near[3], 96)[:5].tolist()
    uneven = np.concatenate((near, [[1e6, 0, 0, 0]]))  # one long vector takes no precision from the others
    query = np.array([0.0, 1.0, 0.5, -0.5])
    assert set(np.argsort(-(uneven @ query))[:5]) == set(ann.Graph(uneven).nearest(query, 96)[:5].tolist())


def test_stored_graphs_lose_nothing():
    for vectors in (vectors_of_size(80, 5, 8), vectors_of_size(80, 5, 8).astype(np.float32).astype(np.float64)):
        row = ann.graph_row(5, 0, vectors, [[i, 100 + i] for i in range(80)], 4)
        shard = type("Row", (), row)
        assert (ann.restored(shard).vectors == vectors).all()
        out = ann.answers_in(shard, np.array([3, 999]), vectors[[3, 3]], 4)
        score = vectors @ vectors[3]
        for query, found in out.groupby("query_id"):
            want = sorted((-s, i) for p, s in enumerate(score.tolist()) for i in (p, 100 + p) if i != query)[:4]
            assert found["vec_id"].tolist() == [i for _, i in want]
            assert np.allclose(found["score"], [-s for s, _ in want], rtol=0, atol=1e-15)
