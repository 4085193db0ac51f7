"""Measures of the influence network against plain graphs of authors."""

from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from quire.operators import network


def made(seed, authors=40, years=(1900, 1960)):
    """Authors of one to three years; some share their years, some stand far off."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(authors):
        picked = rng.integers(*years, int(rng.integers(1, 4))) if rng.random() < 0.8 else [years[0], years[0] + 4]
        rows += [(i, f"A{i:03d}", int(y)) for y in picked]
    return rows + [(900, "Far", 1200), (901, "Z", 1500), (902, "Z", 1503), (903, "Y", 1500), (904, "Y", 1503)]


def edges(rows, window):
    years = defaultdict(set)
    for _, a, y in rows:
        if a is not None and y is not None:
            years[a].add(y)
    out = {a: {b for b in years if b != a and any(0 < v - u <= window for u in years[a] for v in years[b])} for a in years}
    return out


@pytest.fixture(scope="module")
def graph(spark):
    def make(rows, window=10):
        table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, author string, year int, cls string, n int")
        return network.class_graph(table, window)
    return make


NULLS = [(None, None, 1900), (5, "NoYear", None), (6, "A001", None)]


@pytest.mark.parametrize("seed, window", [(1, 10), (2, 3), (3, 40)])
def test_pagerank(graph, seed, window):
    rows = made(seed) + NULLS
    out = edges(rows, window)
    n = len(out)
    rank = dict.fromkeys(out, 1 / n)
    for _ in range(12):
        new = dict.fromkeys(out, 0.0)
        for a, to in out.items():
            for b in to or out:
                new[b] += 0.85 * rank[a] / len(to or out)
        rank = {a: r + 0.15 / n for a, r in new.items()}
    got = {r.author: r.pagerank for r in network.pagerank(graph(rows, window), rounds=12, tolerance=0).collect()}
    assert got.keys() == rank.keys()
    assert all(abs(got[a] - rank[a] * n) < 2e-6 for a in rank)
    assert abs(sum(got.values()) - n) < 1e-3


def test_pagerank_stops_when_nothing_moves(graph):
    g = graph(made(4))
    long = {r.author: r.pagerank for r in network.pagerank(g, rounds=80, tolerance=0).collect()}
    until = {r.author: r.pagerank for r in network.pagerank(g, rounds=80, tolerance=1e-9).collect()}
    assert all(abs(long[a] - until[a]) < 1e-5 for a in long)


@pytest.mark.parametrize("seed, window, block", [(1, 10, 1000), (2, 3, 2), (5, 40, 3)])
def test_triangles(graph, monkeypatch, seed, window, block):
    """Also with the lists of every node cut into blocks."""
    monkeypatch.setattr(network, "WEDGE_BLOCK", block)
    rows = made(seed) + NULLS
    out = edges(rows, window)
    near = {a: {b for b in out if b in out[a] or a in out[b]} for a in out}
    want = {}
    for a, others in near.items():
        t = sum(c in near[b] for b, c in combinations(others, 2))
        pairs = len(others) * (len(others) - 1) / 2
        want[a] = (len(others), t, round(t / pairs, 6) if pairs else 0.0)
    got = {r.author: (r.neighbours, r.triangles, r.clustering) for r in network.triangles(graph(rows, window)).collect()}
    assert got.keys() == want.keys()
    assert all(got[a][:2] == want[a][:2] and abs(got[a][2] - want[a][2]) < 2e-6 for a in want)


@pytest.mark.parametrize("seed, window", [(1, 10), (2, 3), (8, 1)])
def test_cores(graph, seed, window):
    rows = made(seed) + NULLS
    out = edges(rows, window)
    near = {a: {b for b in out if b in out[a] or a in out[b]} for a in out}
    want, k = {}, 0
    while near:  # peel what has too few links left
        few = [a for a in near if len(near[a]) <= k]
        if not few:
            k += 1
        for a in few:
            want[a] = k
            for b in near.pop(a):
                near[b].discard(a)
    assert {r.author: r.core for r in network.cores(graph(rows, window)).collect()} == want


def reached(out, a):
    seen, todo = set(), [a]
    while todo:
        for b in out[todo.pop()] - seen:
            seen.add(b)
            todo.append(b)
    return seen


@pytest.mark.parametrize("seed, window", [(1, 10), (2, 3), (6, 1), (7, 40)])
def test_strong_components(graph, seed, window):
    rows = made(seed, 30, (1900, 2000)) + NULLS
    out = edges(rows, window)
    reach = {a: reached(out, a) for a in out}
    want = {a: min([a, *[b for b in reach[a] if a in reach[b]]]) for a in out}
    got = {r.author: (r.component, r.size) for r in network.strong_components(graph(rows, window)).collect()}
    sizes = defaultdict(int)
    for c in want.values():
        sizes[c] += 1
    assert got == {a: (c, sizes[c]) for a, c in want.items()}


def test_components_of_plain_graphs(spark):
    """Rings joined by one-way edges, a loop, a chain, and a two-way pair."""
    ring = lambda names: list(zip(names, names[1:] + names[:1]))
    arcs = ring(["a", "b", "c"]) + ring(["x", "y", "z", "w"]) + [("c", "x"), ("p", "p"), ("p", "q"), ("q", "r"), ("m", "n"),
                                                             ("n", "m"), ("w", "m"), ("a", "b")]
    nodes = sorted({n for e in arcs for n in e} | {"alone"})
    got = {r.cls: r.component for r in network.class_components(
        spark.createDataFrame([(n,) for n in nodes], "cls string"), spark.createDataFrame(arcs, "a string, b string")).collect()}
    assert got == {**dict.fromkeys("abc", "c"), **dict.fromkeys("xyzw", "z"), **dict.fromkeys("mn", "n"), "p": "p", "q": "q",
                   "r": "r", "alone": "alone"}


def test_no_authors_and_no_window(graph):
    empty = graph([])
    assert network.pagerank(empty).collect() == network.triangles(empty).collect() == network.strong_components(empty).collect() == []
    assert network.cores(empty).collect() == []
    flat = graph(made(1), 0)
    assert {r.pagerank for r in network.pagerank(flat).collect()} == {1.0}
    assert {r.triangles for r in network.triangles(flat).collect()} == {0}
    assert {r.size for r in network.strong_components(flat).collect()} == {1}
