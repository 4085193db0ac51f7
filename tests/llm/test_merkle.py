"""Operator 11: the manifest against a plain tree, path copying, and edge rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from quire.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string, hash string, tree long, pos string"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(*values):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, place, start):
    """Siblings of a place, level by level, the node folded from ``start``, and the root."""
    proof, node = [], start
    while len(nodes) > 1:
        run = nodes[place - place % 3:place - place % 3 + 3]
        before, after = run[:place % 3], run[place % 3 + 1:]
        proof += before + after
        node = H("".join([*before, node, *after]))
        nodes = [H("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
        place //= 3
    return proof, node, nodes[0]


def brute(rows):
    groups = defaultdict(list)
    for doc, source, lang, n, text in rows:
        start = text
        if text is not None and doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
            start = text.replace("\n", "")
        first = leaf(doc, source, lang, n, text)
        groups["" if source is None else "=" + source].append(
            ((doc is not None, doc), first, leaf(doc, source, lang, n, start), doc))
    names = sorted(groups, key=str.encode)
    trees = {g: sorted(groups[g], key=lambda r: (r[0][0], r[0][1] or 0, r[1])) for g in names}
    subroots = [climb([r[1] for r in trees[g]], 0, trees[g][0][1])[2] for g in names]
    out = []
    for at, g in enumerate(names):
        hashes = [r[1] for r in trees[g]]
        for place, (_, first, start, doc) in enumerate(trees[g]):
            low, node, sub = climb(hashes, place, start)
            high, folded, root = climb(subroots, at, node)
            out.append((doc, first, sub, root, H("".join(low + high)), folded, folded == root))
    return sorted(out, key=str)


def run(docs):
    return merkle.build(docs, changed={"text": merkle.newline_tampering()})


def found(manifest):
    return sorted((tuple(r) for r in merkle.proofs(manifest).collect()), key=str)


EDGES = ([(i, f"s{i % 5}", "en", i, f"line {i}\nnext") for i in range(60)]
         + [(None, None, None, None, None), (None, None, "x", 1, "a\nb"), (1, None, "", 0, ""), (1, None, "", 0, ""),
            (7, "lone", "é", 2, "ü\n" * 5000), (7, "s1", "en", 3, "same key"), (7, "s1", "en", 3, "same key"), (8, "", "", 0, None)])


@pytest.mark.parametrize("span_levels", [7, 1])
def test_equals_a_plain_tree(rows, monkeypatch, span_levels):
    """Also with blocks of three leaves, so that versions climb many layers."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", span_levels)
    monkeypatch.setattr(merkle, "SPAN", 3 ** span_levels)
    docs = rows([(*r, "clash", 5, "clash") for r in EDGES], DOCS)
    manifest = run(docs)
    assert found(manifest) == brute(EDGES)

    nodes = manifest.nodes().collect()
    hashes = {(n.tree, n.level, n.pos): n.hash for n in nodes}
    assert len(hashes) == len(nodes)
    for (tree, level, pos), value in hashes.items():  # every node is made of the ones below it
        if level:
            below = [hashes[tree, level - 1, i] for i in range(3 * pos, 3 * pos + 3) if (tree, level - 1, i) in hashes]
            assert value == H("".join(below))
    # a version shares all nodes but one a level
    versions = defaultdict(dict)
    for v in manifest.versions().collect():
        versions[v.tree, v.pos][v.level] = v.hash
    assert versions
    for (tree, pos), copied in versions.items():
        for level in range(1, 4):
            if (tree, level, pos // 3 ** level) in hashes:
                at = pos // 3 ** (level - 1)
                run_ = [copied[level - 1] if i == at else hashes[tree, level - 1, i]
                        for i in range(at - at % 3, at - at % 3 + 3) if (tree, level - 1, i) in hashes]
                assert copied[level] == H("".join(run_)) != hashes[tree, level, pos // 3 ** level]


def test_empty_table_and_lone_row(rows):
    assert found(run(rows([], DOCS))) == []
    one = [(5, "a", None, 1, "x\ny")]
    got = found(run(rows([(*r, None, None, None) for r in one], DOCS)))
    assert got == brute(one) and got[0][1] == got[0][2] == got[0][3]


def test_layers_of_a_large_group(spark):
    """More leaves than two blocks in one group, many of them equal."""
    docs = spark.range(0, 5000, 1, 5).selectExpr("id div 3 AS doc_id", "'hot' AS source", "'en' AS lang", "1L AS n_chars",
                                               "concat('t', id div 6, '\n') AS text")
    want = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert found(run(docs)) == brute(want)
