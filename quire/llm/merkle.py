"""Operator 11: Merkle manifest of a dataset as a persistent, path-copying tree.

Every row is a leaf. The rows of a group (a source) form a tree of fan-out three in the order of
their keys, the roots of the groups, in the order of their names, form one more tree, whose root
names the whole dataset. A changed leaf makes a *version*: a new leaf and new copies of its
ancestors; every other node is the one of the base tree. A proof is the list of the siblings that
the path meets, level by level, and is the same for base and version.

The tree is cut into aligned blocks of ``3 ** 7`` leaves. A task reads a block, makes its nodes and
copies the paths of its changed leaves inside it; what leaves a block is its top node. The tops are
the leaves of the next block layer, until one node of a group is left (a layer is 2,187 times
smaller than the one below it). Versions go on from their block's top: the siblings above are the
same for a whole block, so they are composed from the highest layer down, joined once to the rows of
the block, and the copies are folded there. No task holds more than a block, no join key more rows
than a block, and only one number per layer (the size of the largest tree) reaches the driver. Text
is read once, for the leaf hashes, and never shuffled. Rows are numbered by a range partitioning on
group, key and hash, which splits a hot group, and by counts per partition.

Defined results: null values hash as ``-``; a null group is a tree of its own and comes first; null
keys come first in their group and are never changed by :func:`newline_tampering`; rows of one key
are ordered by their hash, rows equal in everything are leaves of their own, side by side; a group
of one row has that leaf as its root; an empty table has an empty manifest. Other columns do not
matter, whatever their names; a very long text is one row of one scan and costs its own length.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import sorted_groups
from quire.session import materialize

FAN = 3
BLOCK_LEVELS = 7
SPAN = FAN ** BLOCK_LEVELS  # leaves of a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = T.StructType([T.StructField("before", T.BinaryType()), T.StructField("after", T.BinaryType())])
_FOLDED = [T.StructField("path", T.ArrayType(_STEP)), T.StructField("copied", T.ArrayType(T.BinaryType())),
           T.StructField("owned", T.ArrayType(T.BinaryType())), T.StructField("top", T.BinaryType())]


def leaf_hash(values: list[Column]) -> Column:
    """Hex SHA-256 of the values: ``-`` for null, else byte count, colon and value as text."""
    def framed(value):
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[framed(v) for v in values]).cast("binary"), 256)


def newline_tampering(key: str = "doc_id", text: str = "text") -> Column:
    """The text without its newlines where 2 divides crc32 of the decimal key, else the text."""
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.replace(F.col(text), F.lit("\n"), F.lit(""))).otherwise(F.col(text))


def _digest(raw: Column) -> Column:
    """Node over raw child hashes: SHA-256 of their hex text, raw."""
    return F.unhex(F.sha2(F.lower(F.hex(raw)).cast("binary"), 256))


def _node(raw: bytes) -> bytes:
    return hashlib.sha256(raw.hex().encode()).digest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while FAN ** levels < n:
        levels += 1
    return levels


def fold_block(hashes: list[bytes], levels: int) -> list[list[bytes]]:
    """Nodes of a block, level by level, the leaves first."""
    nodes = [hashes]
    for _ in range(levels):
        below = nodes[-1]
        nodes.append([_node(b"".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])
    return nodes


def _numbered(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0 in its ``tree``) and ``n`` (rows of the tree).

    Equal rows are told apart by their place in the scan, so that a mass of copies is split too;
    which of two equal rows comes first changes no hash.
    """
    order = ["tree", *order, "tie"]
    ranged = (rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order)
              .sortWithinPartitions(*order).drop("tie").withColumn("at", F.monotonically_increasing_id()))
    ranged = materialize(ranged, label).withColumn("part", F.shiftright("at", 33))
    counts = ranged.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("tree", "part", "low", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"),
                           F.sum("size").over(Window.partitionBy("tree")).alias("n"))
    return ranged.join(counts, ["tree", "part"]).withColumn(
        "pos", F.col("at") - F.col("low") + F.col("base")).drop("at", "part", "low", "base")


def _fold_blocks(items: DataFrame) -> DataFrame:
    """``items`` (tree, pos, n, hash, start, ...) with what their block tells about each:

    ``path`` the siblings at each level of the block, ``copied`` the nodes from ``start`` (the leaf
    put in place) up to the block's top, ``owned`` the base nodes whose first leaf this is, ``top``
    the base node of the block.
    """
    items = items.withColumn("block", F.expr(f"pos div {SPAN}"))
    schema = T.StructType([*items.schema.fields, *_FOLDED])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    kept = items.columns

    def flush(held, parts):
        befores, afters, path_ends, copied, copied_ends, owned, owned_ends, tops = parts
        table = pa.concat_tables(held)
        steps = pa.StructArray.from_arrays([pa.array(befores, pa.binary()), pa.array(afters, pa.binary())],
                                           fields=list(arrow.field("path").type.value_type))
        lists = {"path": pa.ListArray.from_arrays(pa.array(path_ends, pa.int32()), steps,
                                                  type=arrow.field("path").type)}
        for name, ends, values in (("copied", copied_ends, copied), ("owned", owned_ends, owned)):
            lists[name] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.binary()),
                                                   type=arrow.field(name).type)
        columns = [table.column(c).combine_chunks() for c in kept]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
        return pa.RecordBatch.from_arrays(
            [*[c.cast(arrow.field(i).type) for i, c in enumerate(columns)], lists["path"], lists["copied"],
             lists["owned"], pa.array(tops, pa.binary())], schema=arrow)

    def run(batches):
        held, parts = [], ([], [], [0], [], [0], [], [0], [])
        for group in sorted_groups(batches, ["tree", "block"]):
            befores, afters, path_ends, copied, copied_ends, owned, owned_ends, tops = parts
            starts = group.column("start").to_pylist()
            places = [p % SPAN for p in group.column("pos").to_pylist()]
            if places != list(range(len(places))):
                raise ValueError("a block's leaves are not numbered without gaps")
            levels = min(BLOCK_LEVELS, height(group.column("n")[0].as_py()))
            nodes = fold_block(group.column("hash").to_pylist(), levels)
            for place, node in zip(places, starts):
                copied.append(node)
                owned.append(nodes[0][place])
                at, first = place, True
                for level in range(levels):
                    run_at = at - at % FAN
                    row = nodes[level]
                    before, after = b"".join(row[run_at:at]), b"".join(row[at + 1:run_at + FAN])
                    befores.append(before)
                    afters.append(after)
                    node = _node(before + node + after)
                    copied.append(node)
                    first = first and at == run_at
                    at //= FAN
                    if first:
                        owned.append(nodes[level + 1][at])
                path_ends.append(len(befores))
                copied_ends.append(len(copied))
                owned_ends.append(len(owned))
                tops.append(nodes[-1][0])
            held.append(group)
            if len(tops) >= SPAN:
                yield flush(held, parts)
                held, parts = [], ([], [], [0], [], [0], [], [0], [])
        if held:
            yield flush(held, parts)

    placed = items.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return placed.mapInArrow(run, schema)


def _layers(items: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Block layers of all trees, the lowest first, and ``(tree, hash)`` of their roots."""
    layers = []
    while True:
        layers.append(materialize(_fold_blocks(items), label))
        tops = layers[-1].filter(F.col("pos") % SPAN == 0).select(
            "tree", F.col("block").alias("pos"), F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n"),
            F.col("top").alias("hash"), F.col("top").alias("start"))
        if (tops.agg(F.max("n")).first()[0] or 1) == 1:  # one number
            return layers, tops.select("tree", "hash")
        items = tops


def _upper_paths(layers: list[DataFrame], above: DataFrame) -> DataFrame:
    """``above`` (tree, pos, path, ...) of the highest tops, carried down to the tops of layer 0."""
    for layer in reversed(layers[1:]):
        here = layer.select("tree", F.col("pos").alias("own"), F.col("block").alias("pos"), F.col("path").alias("low"))
        above = here.join(above, ["tree", "pos"]).withColumns(
            {"pos": F.col("own"), "path": F.concat("low", "path")}).drop("own", "low")
    return above


@dataclass
class Manifest:
    """``rows``: every leaf with ``key``, ``tree``, ``pos``, ``leaf``, ``subroot``, ``root`` (raw
    hashes), ``path`` (siblings at each level up to the root) and ``copied`` (the version's nodes from
    the leaf put in place up to its root); ``layers``: the base nodes of the groups' trees."""

    rows: DataFrame
    layers: list[DataFrame]

    def nodes(self) -> DataFrame:
        """The base tree of every group, each node once: ``(tree, level, pos, hash hex)``."""
        parts = [layer.select("tree", F.col("pos").alias("at"), F.posexplode("owned").alias("up", "hash"))
                 .filter(F.lit(number == 0) | (F.col("up") > 0))  # a layer's leaves are the tops below it
                 .select("tree", (F.col("up") + BLOCK_LEVELS * number).alias("level"),
                         F.floor(F.col("at") / F.pow(F.lit(float(FAN)), F.col("up"))).cast("long").alias("pos"),
                         F.lower(F.hex("hash")).alias("hash"))
                 for number, layer in enumerate(self.layers)]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.distinct()

    def versions(self) -> DataFrame:
        """The new nodes of each changed leaf: ``(key, tree, pos of the leaf, level, hash hex)``;
        all others of its version are shared with the base tree."""
        changed = self.rows.filter(F.element_at("copied", 1) != F.col("leaf"))
        return changed.select("key", "tree", "pos", F.posexplode("copied").alias("level", "hash")).withColumn(
            "hash", F.lower(F.hex("hash")))


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source",
          changed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``changed`` gives fields other values in the versions."""
    changed = changed or {}
    leaves = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        F.unhex(leaf_hash([F.col(f) for f in fields])).alias("hash"),
        F.unhex(leaf_hash([changed.get(f, F.col(f)) for f in fields])).alias("start"))
    leaves = materialize(leaves, "leaves")  # the range partitioning looks at its input twice
    layers, roots = _layers(_numbered(leaves, ["key", "hash"], "numbered"), "layer")
    roots = materialize(roots, "roots")
    groups = _numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash",
                                    F.col("hash").alias("start")), ["name"], "groups")
    top_layers, top = _layers(groups, "toplayer")
    none = F.array().cast(T.ArrayType(_STEP))
    over = _upper_paths(top_layers, top.select("tree", F.lit(0).cast("long").alias("pos"), none.alias("path"),
                                               F.col("hash").alias("root")))
    over = top_layers[0].select("tree", "name", F.col("hash").alias("subroot"), F.col("block").alias("pos"),
                                F.col("path").alias("low")).join(over, ["tree", "pos"])
    over = over.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("pos"),
                       F.concat("low", "path").alias("path"), "subroot", "root")
    above = _upper_paths(layers, over).select("tree", F.col("pos").alias("block"), F.col("path").alias("high"),
                                              "subroot", "root")
    rows = layers[0].join(above, ["tree", "block"])
    carried = F.aggregate("high", F.col("copied"), lambda nodes, s: F.concat(
        nodes, F.array(_digest(F.concat(s["before"], F.element_at(nodes, -1), s["after"])))))
    return Manifest(rows.select("key", "tree", "pos", F.col("hash").alias("leaf"), "subroot", "root",
                                F.concat("path", "high").alias("path"), carried.alias("copied")), layers)


def proofs(manifest: Manifest, key: str = "doc_id") -> DataFrame:
    """Per leaf: hashes in hex, the digest of its proof, and the root its version folds to."""
    def as_hex(raw):
        return F.lower(F.hex(raw))
    sides = F.array_join(F.transform("path", lambda s: as_hex(F.concat(s["before"], s["after"]))), "")
    rows = manifest.rows.select("key", "leaf", "subroot", "root", F.sha2(sides.cast("binary"), 256).alias("proof"),
                                F.element_at("copied", -1).alias("folded"))
    return rows.select(F.col("key").alias(key), as_hex("leaf").alias("leaf"), as_hex("subroot").alias("subroot"),
                       as_hex("root").alias("root"), F.col("proof").alias("proof_sha256"),
                       as_hex("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def oracle() -> str:
    """DuckDB twin: levels by recursion, crc32 by a table of 256 remainders."""
    def framed(value):
        return f"coalesce(strlen({value})::varchar || ':' || {value}, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(
            framed(v) for v in ("doc_id::varchar", "source", "lang", "n_chars::varchar", text)) + ")"

    def levels(name, base):
        # every node of every level; (tree, level, idx) -> node, n nodes on the level
        return f"""{name} AS (
  SELECT tree, 0 AS level, idx, hash, n FROM {base}
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (max(n) + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // 3)"""

    def climbs(name, base, nodes):
        # every leaf with its siblings and its refolded node, level by level
        return f"""{name}_sides AS (
  SELECT a.tree, a.level, a.idx, any_value(a.n) AS n,
         coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
         coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM {nodes} a JOIN {nodes} b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
  GROUP BY a.tree, a.level, a.idx),
{name} AS (
  SELECT tree, idx AS leaf_idx, 0 AS level, idx, start AS node, '' AS proof FROM {base}
  UNION ALL
  SELECT c.tree, c.leaf_idx, c.level + 1, c.idx // 3, sha256(s.before || c.node || s.after), c.proof || s.before || s.after
  FROM {name} c JOIN {name}_sides s ON s.tree = c.tree AND s.level = c.level AND s.idx = c.idx WHERE s.n > 1)"""

    return f"""WITH RECURSIVE
crc_steps AS (SELECT range AS byte, range AS value, 0 AS step FROM range(256)
  UNION ALL
  SELECT byte, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END, step + 1
  FROM crc_steps WHERE step < 8),
crc AS (SELECT list(value ORDER BY byte) AS t FROM crc_steps WHERE step = 8),
docs AS (SELECT doc_id, source, {leaf("text")} AS hash,
    CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::BIGINT)),
             lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0
         THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS start
  FROM documents, crc),
leaves AS (SELECT doc_id, coalesce('=' || source, '') AS tree, hash, start,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n FROM docs),
{levels("nodes", "leaves")},
subroots AS (SELECT tree AS name, hash FROM nodes WHERE n = 1),
tops AS (SELECT '' AS tree, name, hash, hash AS start, row_number() OVER (ORDER BY name) - 1 AS idx,
    count(*) OVER () AS n FROM subroots),
{levels("top_nodes", "tops")},
top AS (SELECT hash AS root FROM top_nodes WHERE n = 1),
{climbs("low", "leaves", "nodes")},
reached AS (SELECT tree, leaf_idx, node, proof FROM low
    QUALIFY row_number() OVER (PARTITION BY tree, leaf_idx ORDER BY level DESC) = 1),
joined AS (SELECT l.doc_id, l.hash AS leaf, t.hash AS subroot, t.idx, r.node AS start, r.proof,
    row_number() OVER () AS id FROM leaves l JOIN reached r ON r.tree = l.tree AND r.leaf_idx = l.idx
    JOIN tops t ON t.name = l.tree),
top_sides AS (SELECT a.level, a.idx, any_value(a.n) AS n,
    coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
    coalesce(string_agg(b.hash, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM top_nodes a JOIN top_nodes b ON a.level = b.level AND a.idx // 3 = b.idx // 3 GROUP BY a.level, a.idx),
high AS (SELECT id, 0 AS level, idx, start AS node, proof FROM joined
  UNION ALL
  SELECT h.id, h.level + 1, h.idx // 3, sha256(s.before || h.node || s.after), h.proof || s.before || s.after
  FROM high h JOIN top_sides s ON s.level = h.level AND s.idx = h.idx WHERE s.n > 1),
ends AS (SELECT id, node, proof FROM high QUALIFY row_number() OVER (PARTITION BY id ORDER BY level DESC) = 1)
SELECT j.doc_id, j.leaf, j.subroot, top.root, sha256(e.proof) AS proof_sha256, e.node AS folded_root,
       e.node = top.root AS verified
FROM joined j JOIN ends e USING (id), top"""
