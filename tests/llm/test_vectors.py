"""Operators 6 and 10 against brute force, and edge rows."""

import numpy as np
import pytest

from quire.llm import hash_forest, hnsw, vectors

SCHEMA = "vec_id long, embedding array<float>, label string, w string, rank int"


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cloud(n=600, d=24, groups=(2, 3, 40, 120), seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    at = 0
    for size in groups:
        x[at:at + size] = x[at] + rng.normal(size=(size, d)) * 0.08
        at += size
    return x.astype(np.float32)


def table(rows, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return [(None if i is None else int(i), None if v is None else [None if c is None else float(c) for c in v],
             "a", "b", 1) for i, v in zip(ids, x)]


EDGES = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]


def test_links_match_brute_force(rows):
    x = cloud()
    extra = [x[3].tolist()] * 3 + [(x[3] * 7).tolist()] + [[1.0, 2.0]] * 2
    data = table(rows, list(x) + EDGES + extra) + [(None, x[0].tolist(), "a", "b", 1)]
    out = hnsw.near_duplicate_vectors(rows(data, SCHEMA)).collect()
    assert len(out) == len(data)
    ok = [(k, np.array(v, float)) for k, v, *_ in data if v and None not in v and np.isfinite(v).all() and any(v)]
    full = [(k, v) for k, v in ok if len(v) == 24]
    u = unit(np.array([v for _, v in full]))
    near = (u @ u.T) >= 0.95
    np.fill_diagonal(near, False)
    expected = {k: int(n) for (k, _), n in zip(full, near.sum(1))} | {len(x) + len(EDGES) + 4: 1, len(x) + len(EDGES) + 5: 1}
    got = {r.vec_id: r for r in out}
    for k, *_ in data:
        if k is not None:
            assert got[k].n_links == expected.get(k, 0), k
    root = {k: k for k, _ in full}
    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    order = [k if k is not None else 10**9 for k, _ in full]
    root = {k: k for k in order}
    for i, j in zip(*np.nonzero(near)):
        a, b = sorted((find(order[i]), find(order[j])))
        root[b] = a
    for k in order:
        if k != 10**9:
            assert got[k].component_id == find(k) and got[k].kept == (k == find(k))
    assert all(got[len(x) + i].component_id == len(x) + i for i in range(len(EDGES)))


def test_widening_finds_what_a_bad_graph_misses():
    x = unit(cloud(400).astype(float))
    graph = hnsw.Graph(np.arange(400), x)
    graph.near[0][:] = -1  # no links at all: only an exact scan can pass the audit
    row, node = hnsw.audited_links(graph, x, x, 0.95)
    assert len(row) == (x @ x.T >= 0.95).sum()


def test_audit_sees_missed_links_the_block_does_not_sample():
    rng = np.random.default_rng(8)
    x = unit(rng.normal(size=(1500, 24)))
    graph = hnsw.Graph(np.arange(1500), x)
    lost = np.setdiff1d(np.arange(0, 1500, 8), graph.order[:20])  # no link leads to these any more
    for near in graph.near:
        near[np.isin(near, lost)] = -1
    q = unit(rng.normal(size=(640, 24)))
    turned = unit(x[lost] + rng.normal(size=(len(lost), 24)) * 0.02)
    free = np.setdiff1d(np.arange(640), np.linspace(0, 639, 64).astype(int))[:len(lost)]
    q[free] = turned  # the other queries have no link in this shard
    truth = (q @ x.T >= 0.95).sum()
    assert truth >= len(lost)
    assert len(hnsw.audited_links(graph, x, q, 0.95)[0]) == truth


@pytest.mark.parametrize("n, d", [(1, 24), (5, 1), (400, 24)])
def test_disturbed_copies_have_a_known_answer(n, d):
    x = unit(np.random.default_rng(n).normal(size=(n, d)))
    node, q = hnsw.disturbed(np.arange(n), x, 0.95)
    assert len(node) == min(n, hnsw.AUDIT_ROWS) == len(set(node.tolist()))
    assert ((q * x[node]).sum(1) >= 0.95).all() and np.allclose(np.linalg.norm(q, axis=1), 1)


def test_graph_is_navigable():
    x = unit(cloud(1500, groups=(300, 2, 2)).astype(float))
    graph = hnsw.Graph(np.arange(1500), x)
    assert all((a < 1500).all() and a.shape[1] in (12, 24) for a in graph.near)
    row, node = graph.range_search(x.astype(np.float32), 0.95, hnsw.BEAM)
    truth = (x @ x.T >= 0.95).sum()
    assert len(row) == len(set(zip(row.tolist(), node.tolist()))) and len(row) >= 0.99 * truth


def test_longest_prefix_and_ranges():
    forest = hash_forest.Forest(unit(cloud(200).astype(float)))
    asked = hash_forest.labels(unit(cloud(30, groups=(), seed=5).astype(float)))
    depth = forest.descend(asked)
    bits = lambda v: format(int(v), "064b")
    for i in range(30):
        common = max(len(__import__("os").path.commonprefix([bits(v), bits(asked[t, i])]))
                     for t in range(hash_forest.TREES) for v in forest.sorted[t])
        assert depth[i] == common
    low, high = forest.ranges(asked, np.full(30, 5))
    for t in range(hash_forest.TREES):
        for i in range(30):
            expected = [k for k, v in enumerate(forest.sorted[t]) if bits(v)[:5] == bits(asked[t, i])[:5]]
            assert list(range(low[t, i], high[t, i])) == expected
    assert all(len(c) == 200 for c in forest.candidates(asked, 10**6))


@pytest.mark.parametrize("n", [3, 900])
def test_neighbours_recall_and_order(rows, n):
    x = cloud(n, groups=(2,) if n < 10 else (2, 40))
    data = table(rows, list(x) + EDGES + [[1.0, 2.0]]) + [(None, x[0].tolist(), "a", "b", 1)]
    data += [data[0], data[2]]  # repeated rows
    docs = rows(data, SCHEMA)
    out = hash_forest.nearest_neighbours(docs, docs.filter("vec_id % 3 = 0")).collect()
    u = unit(x.astype(float))
    hits = total = 0
    for i in range(0, n, 3):
        mine = sorted((r for r in out if r.query_id == i), key=lambda r: r["rank"])
        score = u @ u[i]
        others = [j for j in range(n) if j != i]
        best = sorted(others, key=lambda j: (-score[j], j))[:5]
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        assert all(abs(r.score - score[r.vec_id]) < 1e-12 for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        hits += len({r.vec_id for r in mine} & set(best))
        total += len(best)
    assert hits >= 0.9 * total
    assert all(r.query_id < n and r.vec_id < n for r in out)


def test_ties_go_to_the_smaller_id(rows):
    data = table(rows, [[1.0, 0.0], [0.0, 1.0], [0.0, 1.0], [0.0, 1.0]], ids=[0, 30, 10, 20])
    docs = rows(data, SCHEMA)
    out = hash_forest.nearest_neighbours(docs, docs.filter("vec_id = 0"), k=2).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(out, key=lambda r: r["rank"])] == [(1, 10, 0.0), (2, 20, 0.0)]


def test_empty(rows):
    empty = rows([], SCHEMA)
    assert hnsw.near_duplicate_vectors(empty).collect() == []
    assert hash_forest.nearest_neighbours(empty, empty).collect() == []
    assert vectors.unit(np.array([[1e200, 0.0]])).tolist() == [[1.0, 0.0]]


def test_shards_are_stored_and_asked_in_small_rows(rows, monkeypatch):
    """No shard is one row, whatever its size; pieces and small locksteps give the links of brute force."""
    monkeypatch.setattr(hnsw, "PIECE", 4000, raising=False)
    monkeypatch.setattr(hnsw, "TOGETHER", 9000, raising=False)
    monkeypatch.setattr(hnsw, "CELLS", 5000, raising=False)
    monkeypatch.setattr(hnsw, "HELD", 50, raising=False)
    written, write = {}, hnsw.materialize

    def kept(df, label="table"):
        written[label] = write(df, label)
        return written[label]

    monkeypatch.setattr(hnsw, "materialize", kept)
    x = cloud(500, groups=(2, 150))
    out = hnsw.near_duplicate_vectors(rows(table([], x) + [(900, [1.0, 2.0], "a", "b", 1), (901, [2.0, 4.0], "a", "b", 1)], SCHEMA)).collect()
    from pyspark.sql import functions as F
    assert written["graphs"].agg(F.max(F.length("blob"))).first()[0] <= 4000
    assert all(f.dataType.simpleString() != "binary" for f in written["queries"].schema)
    u = unit(x.astype(float))
    near = (u @ u.T >= 0.95).sum(1) - 1
    got = {r.vec_id: r for r in out}
    assert [got[i].n_links for i in range(500)] == near.tolist()
    assert got[900].n_links == got[901].n_links == 1 and got[901].component_id == 900


def test_links_of_a_large_group_are_not_held():
    """Every query is linked with every node of the shard: 9 million pairs, of which those of one lockstep are held."""
    import tracemalloc
    x = unit(1 + np.random.default_rng(2).normal(size=(3000, 8)) * 0.02).astype(np.float32)
    ids = np.arange(3000)
    shard = hnsw.Asked(hnsw._graph_blob(ids, np.ones(3000, np.int64), x, 0.95))
    tracemalloc.start()
    total, to = shard.links(ids, unit(x.astype(float)), 0.95)
    root = shard.fold()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (total == 2999).all() and (to >= 0).all() and (root == 0).all()
    assert peak < 300e6
