"""Operator 4: held-out accuracy, gradients, and edge rows."""

import numpy as np

from quire.llm import quality
from quire.llm.queries import op4_quality_classifier


def test_held_out_accuracy(spark):
    out = op4_quality_classifier(spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = out[out.held_out].merge(labels, on="doc_id")
    assert len(out) == 1000 and (both.predicted == both.quality).mean() > 0.95
    assert out.score.between(0, 1).all()
    assert ((out.score >= 0.3).astype(int) == out.predicted).all()


def test_passages_count_every_byte():
    texts = [b"", b"a", b"ab" * 700, "é".encode() * 130]
    counts, first = quality.passages(texts)
    assert first.tolist() == [0, 1, 2, 8] and len(counts) == 10
    assert counts.sum(1).tolist() == [0, 1, 256, 256, 256, 256, 256, 120, 256, 4]


def test_one_document_alone_scores_as_in_a_batch():
    rng = np.random.default_rng(0)
    bags = [rng.integers(0, 5, (rng.integers(1, 5), quality.FEATURES)) for _ in range(40)]
    model = quality.train(bags, np.array([0, 1] * 20, np.float32), epochs=2)
    texts = [b"", b"Some words here.", b"X!! " * 500]
    together = quality.score(model, texts)
    assert np.allclose(together, [quality.score(model, [t])[0] for t in texts], atol=1e-6)


def test_learns_from_bags():
    good, bad = np.zeros((3, quality.FEATURES), int), np.zeros((3, quality.FEATURES), int)
    good[:, 0], bad[:, 0], bad[1, 9] = 50, 50, 50  # one telling passage makes a document bad
    bags, y = [good, bad] * 50, np.array([1, 0] * 50, np.float32)
    model = quality.train(bags, y, epochs=60)
    x = quality.features(np.concatenate([good, bad]))
    scores = quality._forward(model, x, np.array([0, 3]))[-1]
    assert scores[0] > 0.9 and scores[1] < 0.1


def test_edge_rows(rows):
    docs = rows([(1, None, "a"), (None, "", "b"), (2, "x" * 200000, None), (2, "x" * 200000, None)],
                "doc_id long, text string, quality_score string")
    nothing = rows([], "doc_id long, quality int, toxic int")
    out = quality.quality_scores(docs, nothing).collect()
    assert [r.quality_score for r in out] == [0.5] * 4
    labels = rows([(1, 1, 0), (1, 0, 0), (2, 0, 0), (None, 1, 0), (3, None, 0)],
                  "doc_id long, quality int, toxic int")
    out = {(r.doc_id, r.text): r.quality_score for r in quality.quality_scores(docs, labels).collect()}
    assert len(out) == 3 and out[1, None] == out[None, ""]
    assert quality.quality_scores(rows([], docs.schema), labels).collect() == []


def test_passages_of_few_bytes_at_a_time(spark):
    """The arrays of a batch take some 80 times its bytes: batches of the classifier are small."""
    from quire.llm import quality
    from quire.llm.common import arrow_map
    docs = spark.createDataFrame([(i, "word " * 1000) for i in range(400)], "doc_id long, text string").coalesce(1)
    sizes = arrow_map(docs, lambda b: {"n": [b.nbytes]}, "n long", quality.BATCH).collect()
    assert sum(r.n for r in sizes) > 2_000_000 and max(r.n for r in sizes) <= 1.2 * quality.BATCH
