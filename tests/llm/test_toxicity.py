"""Operator 12: held-out accuracy, the machine against its formula, interactions, edge rows."""

import numpy as np

from quire.llm import toxicity
from quire.llm.queries import op12_toxicity


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = op12_toxicity(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().dropna(subset=["toxic"])
    assert len(out) == 10_000 and out.score.between(0, 1).all()
    assert ((out.score >= 0.3).astype(int) == out.predicted).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.85 and (clean.predicted == 0).mean() > 0.97


def brute(model, x, bias):
    terms = [bias, *x]
    z = sum(model["w"][i] for i in terms)
    z += sum(float(model["v"][i] @ model["v"][j]) for a, i in enumerate(terms) for j in terms[a + 1:])
    return 1 / (1 + np.exp(-z))


def test_prediction_sums_all_pairs():
    rng = np.random.default_rng(3)
    model = {"w": rng.normal(size=21), "v": rng.normal(size=(21, toxicity.FACTORS)) / 3}
    model["v"][20] = 0
    rows = [np.sort(rng.choice(20, n, replace=False)) for n in (0, 1, 5, 20)]
    assert np.allclose(toxicity.predict(model, rows), [brute(model, x, 20) for x in rows])
    assert np.allclose(toxicity.predict(model, rows), [toxicity.predict(model, [x])[0] for x in rows])


def test_learns_an_interaction_that_no_sum_of_weights_can():
    """Term 0 or term 1 alone is harmless, both together are toxic, neither is toxic as well."""
    rows = [np.array(x) for x in ([0, 1], [0], [1], [])] * 60
    y = np.array([1, 0, 0, 1] * 60, float)
    model = toxicity.train(rows, y, terms=4, epochs=300, decay=(0, 0))
    assert ((toxicity.predict(model, rows[:4]) > 0.5) == [True, False, False, True]).all()
    linear = {"w": model["w"], "v": model["v"] * 0}
    assert not ((toxicity.predict(linear, rows[:4]) > 0.5) == [True, False, False, True]).all()


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(5)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(200)]
    y = np.array([float(3 in r and 7 in r) for r in rows])

    def loss(model):
        p = toxicity.predict(model, rows)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    losses = [loss(toxicity.train(rows, y, terms=30, epochs=n)) for n in (1, 10, 60)]
    assert losses[0] > losses[1] > losses[2]


def test_words_and_prefixes():
    assert toxicity.distinct_words("Ab1cd É_x AB.ab") == {"ab", "cd", "é", "x"}
    assert len(toxicity.word_buckets("abc")) == 1 and len(toxicity.word_buckets("abcdefghij")) == 6
    long = "spam ham " * 120_000
    assert toxicity.distinct_words(long) == {"spam", "ham"}


DOCS = "doc_id long, text string, k string, score string, y int"


def test_edge_rows(rows):
    mean = "you idiot and your kind "
    data = [(i, mean * 3 if i % 2 else "a kind day in the park", "x", "y", 1) for i in range(60)]
    data += [(None, None, None, None, None), (100, "", "", "", 0), (101, mean * 50_000, "", "", 0), (1, "other", "", "", 0),
             (1, "other", "", "", 0)]
    docs = rows(data, DOCS)
    nothing = rows([], "doc_id long, quality int, toxic int")
    assert {r.toxicity for r in toxicity.toxicity_scores(docs, nothing).collect()} == {0.0}
    labels = rows([(i, 0, i % 2) for i in range(60)] + [(None, 1, 1), (100, 1, None), (3, 0, 0), (999, 0, 1)],
                  "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_scores(docs, labels).collect()
    assert len(out) == len(data) and set(out[0].asDict()) == {"doc_id", "toxicity"}
    score = {r.doc_id: r.toxicity for r in out if r.doc_id != 1}
    assert score[101] > 0.5 and score[3] == score[5] and score[2] < 0.3
    assert score[None] == score[100] < 0.9  # no terms: the base rate
    one_class = rows([(i, 0, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    assert max(r.toxicity for r in toxicity.toxicity_scores(docs, one_class).collect()) < 0.3
    assert toxicity.toxicity_scores(rows([], DOCS), labels).collect() == []


def test_long_text_scores_as_its_words(rows):
    docs = rows([(1, "idiot " * 400_000), (2, "idiot")], "doc_id long, text string")
    labels = rows([(1, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r.toxicity for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert out[1] == out[2]
