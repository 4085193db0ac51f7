"""Operator 2: the base against brute force, normalisation, learning, and edge rows."""

import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np

from quire.llm import lm_scoring as lm
from quire.llm.queries import op2_lm_scoring

SCHEMA = "doc_id long, text string, score string, word int"


def plain_tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def brute(data):
    train = Counter()
    for k, t in data:
        if crc32(str(k if k is not None else "").encode()) % 5 != 1:
            train.update(plain_tokens(t) + [None])
    n, v = sum(train.values()), len(train)
    out = []
    for k, t in data:
        words = plain_tokens(t) + [None]
        base = sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        out.append((k, crc32(str(k if k is not None else "").encode()) % 5 == 1, len(words),
                    sum(train[w] > 0 for w in words), n, base))
    return out


def same(rows, expected):
    key = lambda r: (r[0] is None, r[0] or 0, r[5])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=key)
    for a, b in zip(got, sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9)


def test_base_against_brute_force_with_edge_rows(rows):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(300)] + ["É", "ÀB", "x y", "x\u0085y", "The", "THE"]
    data = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 80)))) for i in range(120)]
    data += [(500, None), (501, ""), (502, " \t\n\x0b\f\r"), (None, "w1 w2"), (None, None), (3, "w1"), (3, "w1"),
             (503, "long " * 100000)]
    docs = rows([(k, t, "a", 1) for k, t in data], SCHEMA)
    for head in (lm.HEAD, 40, 0):  # any share of the words joined gives the same counts
        same(lm.lm_scores(docs, head=head).collect(), brute(data))


def test_no_training_rows(rows):
    held = [i for i in range(60) if crc32(str(i).encode()) % 5 == 1]
    data = [(i, "some words") for i in held]
    out = lm.lm_scores(rows([(k, t, "a", 1) for k, t in data], SCHEMA)).collect()
    same(out, brute(data))
    assert all(math.isfinite(r.score) for r in out)
    assert lm.lm_scores(rows([], SCHEMA)).collect() == []


def test_model_beats_the_base_on_held_out_texts(spark):
    out = op2_lm_scoring(spark, "/root/testdata/sf0.01").toPandas()
    held = out[out.held_out]
    assert len(out) == 1000 and len(held) > 150
    assert (held.score - held.base_score).sum() / held.n_tokens.sum() > 0.15


def test_probabilities_of_a_position_sum_to_one():
    counts = {f"w{i}".encode(): i + 1 for i in range(500)} | {b"": 40}
    classes = lm.Classes([f"w{i}".encode() for i in range(499, 499 - lm.TOP, -1)])
    words = [w for w in counts if w]
    of = dict(zip(words, classes(words))) | {b"": 0}
    spread = np.full(lm.CLASSES, 0.5)
    for w, c in counts.items():
        spread[of[w]] += c + 0.5
    rng = np.random.default_rng(0)
    model = {k: v + rng.normal(size=v.shape).astype(np.float32) * 0.3
             for k, v in lm.start_parameters(spread / spread.sum()).items()}
    _, context = lm.windows([classes([b"w3", b"w499", b"new"])])
    for at in range(len(context)):
        p = np.exp(lm.log_probabilities(model, np.arange(lm.CLASSES), np.repeat(context[at:at + 1], lm.CLASSES, 0)))
        known = sum(p[of[w]] * (c + 0.5) / spread[of[w]] for w, c in counts.items())
        unseen = sum(p[k] * 0.5 / spread[k] for k in range(lm.CLASSES))
        assert abs(known + unseen - 1) < 1e-5


def test_noise_contrastive_steps_learn_what_follows():
    rng = np.random.default_rng(1)
    prior = np.full(lm.CLASSES, 1 / lm.CLASSES)
    trainer = lm.Trainer(lm.start_parameters(prior), prior)
    ids = [[int(x) for x in np.cumsum(rng.integers(1, 3, 200)) % 20 + 1] for _ in range(400)]
    before = lm.log_probabilities(trainer.m, *lm.windows(ids)).mean()
    for _ in range(6):
        trainer.learn(*lm.windows(ids))
    after = lm.log_probabilities(trainer.m, *lm.windows(ids)).mean()
    assert before < -5 and after > -3.2


def test_windows_do_not_cross_texts():
    target, context = lm.windows([[3, 4], [], [5]])
    assert target.tolist() == [3, 4, 0, 0, 5, 0]
    pad = lm.CLASSES
    assert context[:, 0].tolist() == [pad, 3, 4, pad, pad, 5]
    assert context[2].tolist() == [4, 3, pad, pad, pad]
