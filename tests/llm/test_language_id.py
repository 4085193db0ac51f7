"""Operator 5: held-out accuracy, gradients against differences, and edge rows."""

import numpy as np

from quire.llm import language_id as li
from quire.llm.queries import op5_language_id


def test_held_out_accuracy(spark):
    out = op5_language_id(spark, "/root/testdata/sf0.01").toPandas()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    both = out[out.held_out].merge(docs, on="doc_id")
    assert len(out) == 1000 and (both.lang == both.lang_pred).mean() > 0.97


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3, 5, 9)).astype(np.float64)
    u = rng.normal(size=(3, 9))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], float)
    weight = rng.normal(size=(3, 5, 3))
    for reverse in (False, True):
        def loss(x, u):
            return float((li._gru(x.astype(np.float32), mask.astype(np.float32), u.astype(np.float32),
                                  reverse, False)[0] * weight * mask[:, :, None]).sum())
        _, trace = li._gru(x.astype(np.float32), mask.astype(np.float32), u.astype(np.float32), reverse, True)
        dx, du = li._gru_back(weight * mask[:, :, None], mask, u, trace, reverse)
        for table, gradient, at in ((x, dx, (0, 2, 4)), (x, dx, (1, 1, 7)), (u, du, (1, 2)), (u, du, (2, 8))):
            up, down = table.copy(), table.copy()
            up[at] += 1e-2
            down[at] -= 1e-2
            a = loss(up, u) - loss(down, u) if table is x else loss(x, up) - loss(x, down)
            assert abs(a / 2e-2 - gradient[at]) < 2e-2


def test_word_scores_do_not_depend_on_the_batch():
    model = li.train([b"the", b"und", b"le", b"los"] * 8, np.arange(32) % 4, 4, epochs=1)
    words = [b"a", b"theatre", b"x" * 100, "für".encode()]
    together = li.word_scores(model, words)
    assert np.allclose(together, np.concatenate([li.word_scores(model, [w]) for w in words]), atol=1e-5)


def test_edge_rows(rows):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    data = [(i, f"the cat and dog {i}", "en", "x", 1) for i in range(30)]
    data += [(100 + i, f"der hund und die katze {i}", "de", "x", 1) for i in range(30)]
    data += [(900, None, "en", "x", 1), (901, "", "de", "x", 1), (902, "12 34 !!", "en", "x", 1),
             (903, "Ω", None, "x", 1), (None, "the dog", None, "x", 1), (904, "z" * 300000, None, "x", 1),
             (0, "the cat and dog 0", "en", "x", 1)]
    out = li.identify(rows(data, schema)).collect()
    assert len(out) == len(data)
    by = {r.doc_id: r for r in out}
    assert [by[k].lang_pred for k in (900, 901, 902)] == ["und"] * 3
    assert by[900].score == 0.0
    assert by[None].lang_pred == "en" and by[903].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in out)
    assert li.identify(rows([], schema)).collect() == []
    unlabelled = li.identify(rows([(1, "abc", None, "x", 1)], schema)).collect()
    assert unlabelled[0].lang_pred == "und" and unlabelled[0].score == 0.0


def test_sample_holds_every_language(rows):
    data = [(i, f"common words {i}", "en") for i in range(300)] + [(1000 + i, f"rare {i}", "xx") for i in range(6)]
    docs = rows(data, "doc_id long, text string, lang string")
    _, names = li.training_words(docs, "doc_id", "text", "lang", 5)
    assert {"en", "xx"} == set(names)
    many = rows([(i, f"w{i}", "en") for i in range(400)], "doc_id long, text string, lang string")
    assert len(li.training_words(many, "doc_id", "text", "lang", 5)[1]) == li.LANG_ROWS
