"""Measures of the influence network beyond degrees, computed on classes of authors.

Authors with the same set of years have the same neighbours (but for themselves), so each measure has one
value a class, and the graph of classes, with the number of authors of each as its weight, says it all. The
author x author edges are never built. A class may have an edge to itself (its own years lie within the
window); then its authors influence each other.

* ``pagerank``: power iteration. Mass of authors who influence nobody is dealt to all; that and the
  restart are one number a round, taken from what the others passed on. Each round is a written table.
* ``triangles``: every edge goes from the end of lower degree to the other, two edges out of one end are a
  wedge, and a join with the edges closes it. By this order a node has few edges out however many it has; the
  lists of those that still have many are cut into blocks that meet in pairs.
* ``cores``: the core number of an author is the largest k for which a group of authors exists, this one among
  them, each linked to k others of the group. It starts at the degree and is replaced by the h-index of the
  neighbours' numbers until nothing changes. Neighbours are summed by number before they are ranked, so a hub
  is as many rows as its neighbours have numbers.
* ``strong_components``: nodes that cannot lie on a cycle are trimmed; every other node takes the largest
  name that reaches it, and those that reach the node of that name inside its colour are its component. These
  leave the graph, and the rest goes on: all colours at once.

Years come from :func:`quire.operators.influence.author_years`; rows without author or year take no part.
A window below one gives no edges. Results have one row an author, ties are not broken anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import fixed_values as fv
from quire.operators.influence import author_classes, class_pairs
from quire.session import materialize

DAMPING = 0.85
ROUNDS = 50
TOLERANCE = 1e-9
WEDGE_BLOCK = 1000  # edges out of a node that meet each other in one block


@dataclass
class ClassGraph:
    """``authors``: ``(author, cls)``; ``nodes``: ``(cls, n)``; ``edges``: distinct directed ``(a, b)`` of
    classes, with ``a = b`` where a class reaches itself. Written tables."""

    authors: DataFrame
    nodes: DataFrame
    edges: DataFrame


def class_graph(author_years: DataFrame, window: int = fv.TIME_WINDOW) -> ClassGraph:
    authors = author_classes(author_years)
    nodes = materialize(authors.groupBy("cls").agg(F.count(F.lit(1)).alias("n")), "nodes")
    if window < 1:
        edges = nodes.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
    else:
        edges = class_pairs(authors, window).select("a", "b")
    return ClassGraph(authors.select("author", "cls"), nodes, materialize(edges, "classedges"))


def _per_author(graph: ClassGraph, values: DataFrame) -> DataFrame:
    return graph.authors.join(values, "cls").drop("cls")


# -- PageRank ------------------------------------------------------------------------------------

def pagerank(graph: ClassGraph, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE,
             digits: int = 6) -> DataFrame:
    """``(author, pagerank)``: the rank times the number of authors (1 on average), after ``rounds`` rounds
    or when the ranks of all authors together move by less than ``tolerance``."""
    total = graph.nodes.agg(F.sum("n")).first()[0] or 0
    sizes = graph.nodes.select(F.col("cls").alias("b"), F.col("n").alias("m"))
    own = F.when(F.col("a") == F.col("b"), 1).otherwise(0)
    to = graph.edges.join(sizes, "b")
    reach = to.groupBy("a").agg(F.sum(F.col("m") - own).alias("reach"))
    # what an author of b gets from all authors of a, as a share of the rank of one
    sending = graph.nodes.join(reach.filter("reach > 0"), F.col("cls") == F.col("a")).select("a", "n", "reach")
    shares = materialize(graph.edges.join(sending, "a").select(
        "a", "b", ((F.col("n") - own) / F.col("reach")).alias("share")), "shares")
    ranks = graph.nodes.withColumn("r", F.lit(1.0 / max(1, total)))
    for _ in range(rounds):
        got = shares.join(ranks.select(F.col("cls").alias("a"), "r"), "a").groupBy(F.col("b").alias("cls")).agg(
            F.sum(F.col("share") * F.col("r")).alias("got"))
        step = materialize(ranks.join(got, "cls", "left").select(
            "cls", "n", F.col("r").alias("last"), (F.coalesce("got", F.lit(0.0)) * damping).alias("got")), "ranks")
        # restart and the mass of those who influence nobody: what is missing to one
        rest = (1 - (step.agg(F.sum(F.col("n") * F.col("got"))).first()[0] or 0.0)) / max(1, total)
        ranks = step.select("cls", "n", (F.col("got") + rest).alias("r"), "last")
        if tolerance:
            moved = ranks.agg(F.sum(F.col("n") * F.abs(F.col("r") - F.col("last")))).first()[0] or 0.0
            if moved < tolerance:
                break
        ranks = ranks.drop("last")
    return _per_author(graph, ranks.select("cls", F.round(F.col("r") * total, digits).alias("pagerank")))


# -- triangles -----------------------------------------------------------------------------------

def triangles(graph: ClassGraph, digits: int = 6) -> DataFrame:
    """``(author, neighbours, triangles, clustering)`` in the undirected network: how many others an author
    is linked to either way, how many pairs of those are linked, and their share of all such pairs (0 for
    fewer than two neighbours)."""
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = graph.edges.select(*ends).distinct()
    loops = materialize(edges.filter("a = b").select(F.col("a").alias("cls")), "loops")
    edges = materialize(edges.filter("a < b"), "undirected")
    sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = sides.groupBy(F.col("a").alias("cls")).agg(F.count(F.lit(1)).alias("d"))
    nodes = graph.nodes.join(degree, "cls", "left").join(loops.withColumn("loop", F.lit(1)), "cls", "left").select(
        "cls", "n", F.coalesce("d", F.lit(0)).alias("d"), F.coalesce("loop", F.lit(0)).alias("loop"))
    nodes = materialize(nodes, "degrees")

    def end(name):
        return nodes.select(F.col("cls").alias(name), F.struct("d", F.col("cls").alias("c")).alias(f"{name}_at"),
                            F.struct("n", "loop").alias(f"{name}_size"))

    both = edges.join(end("a"), "a").join(end("b"), "b")
    ahead = F.col("a_at") < F.col("b_at")
    pick = lambda x, y: F.when(ahead, F.col(x)).otherwise(F.col(y))
    out = both.select(pick("a", "b").alias("x"), pick("b", "a").alias("y"), pick("b_at", "a_at").alias("y_at"),
                      pick("a_size", "b_size").alias("xs"), pick("b_size", "a_size").alias("ys"))
    out = materialize(out, "oriented")
    lists = out.groupBy("x").agg(F.ceil(F.count(F.lit(1)) / WEDGE_BLOCK).cast("int").alias("lists"))
    out = out.join(lists, "x")

    def dealt(own, other):
        return out.withColumn(own, F.pmod(F.xxhash64("y"), F.col("lists")).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col("lists") - 1)))

    left = dealt("i", "j").select("x", "i", "j", "y", "y_at", "xs", "ys")
    right = dealt("j", "i").select("x", "i", "j", F.col("y").alias("z"), F.col("y_at").alias("z_at"), F.col("ys").alias("zs"))
    wedges = left.join(right, ["x", "i", "j"]).filter("y_at < z_at")
    closed = wedges.join(out.select(F.col("x").alias("y"), F.col("y").alias("z")), ["y", "z"])
    n = {c: F.col(f"{c}s.n") for c in "xyz"}
    of_three = F.array(*[F.struct(F.col(c).alias("cls"), (n[p] * n[q]).alias("t")) for c, p, q in ("xyz", "yxz", "zxy")])
    parts = [closed.select(F.explode(of_three).alias("e")).select("e.cls", "e.t")]
    # two corners in one class that reaches itself, the third in another class
    pairs = lambda m: F.expr(f"{m} * ({m} - 1) div 2")
    of_two = F.array(*[s for u, v in ("xy", "yx") for s in (
        F.struct(F.col(u).alias("cls"), (F.col(f"{v}s.loop") * pairs(f"{v}s.n")).alias("t")),
        F.struct(F.col(u).alias("cls"), (F.col(f"{u}s.loop") * (F.col(f"{u}s.n") - 1) * F.col(f"{v}s.n")).alias("t")))])
    parts.append(out.select(F.explode(of_two).alias("e")).select("e.cls", "e.t"))
    # all three in one class
    parts.append(nodes.filter("loop = 1").select("cls", F.expr("(n - 1) * (n - 2) div 2").alias("t")))
    count = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("cls").agg(F.sum("t").alias("t"))
    near = sides.join(graph.nodes.select(F.col("cls").alias("b"), "n"), "b").groupBy(F.col("a").alias("cls")).agg(
        F.sum("n").alias("others"))
    values = nodes.join(count, "cls", "left").join(near, "cls", "left").select(
        "cls", (F.coalesce("others", F.lit(0)) + F.col("loop") * (F.col("n") - 1)).cast("long").alias("neighbours"),
        F.coalesce("t", F.lit(0)).cast("long").alias("triangles"))
    possible = F.col("neighbours") * (F.col("neighbours") - 1) / 2.0
    share = F.when(possible > 0, F.round(F.col("triangles") / possible, digits)).otherwise(F.lit(0.0))
    return _per_author(graph, values.withColumn("clustering", share))


# -- cores ---------------------------------------------------------------------------------------

def cores(graph: ClassGraph, rounds: int = 10_000) -> DataFrame:
    """``(author, core)``: core numbers in the undirected network, 0 for authors without links."""
    links = graph.edges.unionByName(graph.edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    own = F.when(F.col("a") == F.col("b"), 1).otherwise(0)
    links = links.join(graph.nodes.select(F.col("cls").alias("b"), "n"), "b").select("a", "b", (F.col("n") - own).alias("m"))
    links = materialize(links.filter("m > 0"), "links")
    degree = links.groupBy(F.col("a").alias("cls")).agg(F.sum("m").alias("core"))
    state, seen = materialize(degree, "cores"), None
    upto = Window.partitionBy("a").orderBy(F.col("core").desc()).rowsBetween(Window.unboundedPreceding, 0)
    for _ in range(rounds):
        now = state.agg(F.sum("core")).first()[0]  # numbers only fall: an equal sum means no change
        if now == seen:
            break
        seen = now
        by_number = links.join(state.select(F.col("cls").alias("b"), "core"), "b").groupBy("a", "core").agg(
            F.sum("m").alias("m"))
        reached = by_number.withColumn("many", F.sum("m").over(upto))
        state = materialize(reached.groupBy(F.col("a").alias("cls")).agg(
            F.max(F.least("core", "many")).alias("core")), "cores")
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    return graph.authors.join(state, "cls", "left").select("author", F.coalesce("core", F.lit(0)).cast("long").alias("core"))


# -- strongly connected components ---------------------------------------------------------------

def _spread(names: DataFrame, edges: DataFrame, rounds: int) -> DataFrame:
    """``(cls, name)``: the largest name on any path into a node, its own included."""
    seen = None
    for _ in range(rounds):
        come = edges.join(names.select(F.col("cls").alias("a"), "name"), "a").select(F.col("b").alias("cls"), "name")
        names = materialize(names.unionByName(come).groupBy("cls").agg(F.max("name").alias("name")), "names")
        now = names.agg(F.sum(F.xxhash64("cls", "name").cast("decimal(38,0)"))).first()[0]  # one number
        if now == seen:
            return names
        seen = now
    raise RuntimeError(f"no fixed point after {rounds} rounds")


def class_components(nodes: DataFrame, edges: DataFrame, rounds: int = 10_000) -> DataFrame:
    """``(cls, component)`` of a directed graph ``(a, b)``: the component's largest node."""
    left = materialize(edges.filter("a <> b").select("a", "b").distinct(), "cyclic")
    found = []
    for _ in range(rounds):
        while True:  # trim what has no edge in or no edge out
            kept = left.join(left.select(F.col("b").alias("a")).distinct(), "a", "left_semi").join(
                left.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
            kept = materialize(kept.select("a", "b"), "cyclic")
            before, after = left.count(), kept.count()
            left = kept
            if before == after:
                break
        if not after:
            break
        inside = materialize(left.select(F.col("a").alias("cls")).unionByName(left.select(F.col("b").alias("cls"))).distinct(),
                             "inside")
        colour = _spread(inside.withColumn("name", F.col("cls")), left, rounds)
        # backward from the node of each name, through edges inside its colour
        ends = left.join(colour.select(F.col("cls").alias("a"), F.col("name").alias("p")), "a").join(
            colour.select(F.col("cls").alias("b"), F.col("name").alias("q")), "b").filter("p = q")
        back = materialize(ends.select("a", "b"), "back")
        reached = materialize(colour.filter("cls = name"), "reached")
        size = reached.count()
        for _ in range(rounds):
            more = back.join(reached.select(F.col("cls").alias("b"), "name"), "b").select(F.col("a").alias("cls"), "name")
            reached = materialize(reached.unionByName(more).distinct(), "reached")
            now = reached.count()
            if now == size:
                break
            size = now
        found.append(reached.select("cls", F.col("name").alias("component")))
        done = reached.select("cls")
        left = materialize(left.join(done.withColumnRenamed("cls", "a"), "a", "left_anti").join(
            done.withColumnRenamed("cls", "b"), "b", "left_anti"), "cyclic")
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    out = nodes.select("cls")
    if not found:
        return out.withColumn("component", F.col("cls"))
    parts = found[0]
    for part in found[1:]:
        parts = parts.unionByName(part)
    return out.join(parts, "cls", "left").select("cls", F.coalesce("component", "cls").alias("component"))


def strong_components(graph: ClassGraph) -> DataFrame:
    """``(author, component, size)``: authors who influence each other in both directions, over any number of
    steps; a component is named by its first author, ``size`` counts its authors."""
    parts = materialize(class_components(graph.nodes, graph.edges), "components")
    loops = graph.edges.filter("a = b").select(F.col("a").alias("cls")).withColumn("loop", F.lit(True))
    shared = parts.groupBy("component").agg(F.count(F.lit(1)).alias("classes"))
    # authors of a class that stands alone and does not reach itself are not connected with each other
    joined = parts.join(shared, "component").join(loops, "cls", "left").select(
        "cls", "component", (F.coalesce("loop", F.lit(False)) | (F.col("classes") > 1)).alias("one"))
    rows = graph.authors.join(joined, "cls").select(
        "author", F.when(F.col("one"), F.col("component")).otherwise(F.concat(F.lit("="), "author")).alias("part"))
    rows = materialize(rows, "parts")
    named = rows.groupBy("part").agg(F.min("author").alias("component"), F.count(F.lit(1)).alias("size"))
    return rows.join(named, "part").select("author", "component", "size")
