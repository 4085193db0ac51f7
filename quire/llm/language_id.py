"""Operator 5: language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes between two space marks, forwards and backwards, and labels every
position; it is trained in numpy by backpropagation through time. Both states start anew at each
word, so a word has one result wherever it stands and is run once in a task. Positions are pooled
to the word (mean log-probability), words to the document (sum over all words of the whole text),
and a softmax makes the document's probabilities. Words over ``PIECE`` bytes are read in pieces.

It learns from ``text`` and ``lang`` of training folds only: at most ``TRAIN_ROWS`` documents
(chosen by a hash of the id), and of every language at least ``LANG_ROWS`` if it has so many; and
``TRAIN_WORDS`` words of each, evenly spaced over the whole text.

Defined results: a null text or one without a letter is ``und`` with score 0; without training
rows everything is; a language tie goes to the smaller name; repeated rows get equal results.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, fold

PIECE = 24
TRAIN_ROWS, TRAIN_WORDS = 1600, 40
LANG_ROWS = 40  # documents of every language at least, if it has so many
EMBED, HIDDEN = 12, 16
EPOCHS, LEAST_STEPS = 4, 200
MARK = 32
CACHE_WORDS = 1_500_000
_LETTER = re.compile(r"[A-Za-z]")


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte matrix (marks at both ends) and mask of words of at most PIECE bytes."""
    size = np.array([len(w) + 2 for w in words])
    ids = np.full((len(words), int(size.max())), MARK, np.int64)
    mask = np.arange(ids.shape[1])[None, :] < size[:, None]
    inner = np.arange(ids.shape[1])[None, :] < (size - 2)[:, None]
    ids[:, 1:][inner[:, :-1]] = np.frombuffer(b"".join(words), np.uint8)
    return ids, mask.astype(np.float32)


def _sigmoid(x):
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


def _gru(x, mask, u, reverse, keep):
    """States of one direction. x: inputs of the three gates (B, T, 3H)."""
    n, steps, width = x.shape
    size = width // 3
    h = np.zeros((n, size), np.float32)
    out = np.zeros((n, steps, size), np.float32)
    trace = {}
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        a = x[:, t, :2 * size] + h @ u[:, :2 * size]
        gates = _sigmoid(a)
        z, r = gates[:, :size], gates[:, size:]
        c = np.tanh(x[:, t, 2 * size:] + (r * h) @ u[:, 2 * size:])
        on = mask[:, t, None]
        new = on * (h + z * (c - h))
        if keep:
            trace[t] = (h, z, r, c)
        out[:, t] = h = new
    return out, trace


def _gru_back(dout, mask, u, trace, reverse):
    n, steps, size = dout.shape
    dx, du = np.zeros((n, steps, 3 * size), np.float32), np.zeros_like(u)
    dh = np.zeros((n, size), np.float32)
    for t in range(steps) if reverse else range(steps - 1, -1, -1):
        h, z, r, c = trace[t]
        d = (dh + dout[:, t]) * mask[:, t, None]
        dc = d * z * (1 - c * c)
        dz = d * (c - h) * z * (1 - z)
        drh = dc @ u[:, 2 * size:].T
        dr = drh * h * r * (1 - r)
        gates = np.concatenate([dz, dr], 1)
        dx[:, t] = np.concatenate([gates, dc], 1)
        du[:, :2 * size] += h.T @ gates
        du[:, 2 * size:] += (r * h).T @ dc
        dh = d * (1 - z) + drh * r + gates @ u[:, :2 * size].T
    return dx, du


def _log_probabilities(m, ids, mask, keep=False):
    inputs = [m["E"] @ m[k] + m[b] for k, b in (("Wf", "bf"), ("Wb", "bb"))]
    f, trace_f = _gru(inputs[0][ids], mask, m["Uf"], False, keep)
    b, trace_b = _gru(inputs[1][ids], mask, m["Ub"], True, keep)
    h = np.concatenate([f, b], 2)
    y = h @ m["O"] + m["o"]
    y -= y.max(2, keepdims=True)
    y -= np.log(np.exp(y).sum(2, keepdims=True))
    return y, h, trace_f, trace_b


def word_scores(m: dict, words: list[bytes]) -> np.ndarray:
    """Mean log-probability of each language over a word's positions (words x languages)."""
    out = np.zeros((len(words), len(m["o"])), np.float32)
    pieces = [(i, w[k:k + PIECE]) for i, w in enumerate(words) for k in range(0, max(1, len(w)), PIECE)]
    pieces.sort(key=lambda p: len(p[1]))
    total = np.zeros(len(words), np.float32)
    for at in range(0, len(pieces), 4096):
        part = pieces[at:at + 4096]
        ids, mask = padded([p for _, p in part])
        y = _log_probabilities(m, ids, mask)[0]
        owner = [i for i, _ in part]
        np.add.at(out, owner, (y * mask[:, :, None]).sum(1))
        np.add.at(total, owner, mask.sum(1))
    return out / np.maximum(1, total)[:, None]


def train(words: list[bytes], labels: np.ndarray, n_languages: int, epochs: int = EPOCHS,
          seed: int = 5) -> dict:
    rng = np.random.default_rng(seed)

    def start(*shape):
        return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

    m = {"E": start(256, EMBED) * 8, "O": start(2 * HIDDEN, n_languages),
         "o": np.zeros(n_languages, np.float32)}
    for d in "fb":
        m |= {f"W{d}": start(EMBED, 3 * HIDDEN), f"U{d}": start(HIDDEN, 3 * HIDDEN),
              f"b{d}": np.zeros(3 * HIDDEN, np.float32)}
    words = [w[:PIECE] for w in words]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    by_size = np.argsort([len(w) for w in words], kind="stable")
    batches = [by_size[k:k + 256] for k in range(0, len(by_size), 256)]
    epochs = max(epochs, -(-LEAST_STEPS // len(batches)))  # few words are read more often
    step = 0
    for epoch in range(epochs):
        for number in rng.permutation(len(batches)):
            chosen = batches[number]
            ids, mask = padded([words[i] for i in chosen])
            y, h, trace_f, trace_b = _log_probabilities(m, ids, mask, True)
            dy = np.exp(y)
            dy[np.arange(len(chosen)), :, labels[chosen]] -= 1
            dy *= (mask / mask.sum())[:, :, None]
            dh = dy @ m["O"].T
            g = {"O": np.einsum("bth,btl->hl", h, dy), "o": dy.sum((0, 1))}
            de = np.zeros_like(m["E"])
            for d, part, trace, reverse in (("f", dh[:, :, :HIDDEN], trace_f, False),
                                            ("b", dh[:, :, HIDDEN:], trace_b, True)):
                dx, g[f"U{d}"] = _gru_back(part, mask, m[f"U{d}"], trace, reverse)
                flat, at = dx.reshape(-1, 3 * HIDDEN), ids.reshape(-1)
                table = np.zeros((256, 3 * HIDDEN), np.float32)
                np.add.at(table, at, flat)
                g[f"W{d}"], g[f"b{d}"] = m["E"].T @ table, table.sum(0)
                de += table @ m[f"W{d}"].T
            g["E"] = de
            step += 1
            size = 0.02 * (0.55 + 0.45 * np.cos(np.pi * epoch / max(1, epochs - 1)))
            for k, v in g.items():
                a, b = moments[k]
                moments[k] = a, b = 0.9 * a + 0.1 * v, 0.99 * b + 0.01 * v * v
                m[k] = (m[k] - size * (a / (1 - 0.9 ** step))
                        / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return m


def training_words(docs: DataFrame, key: str, text: str, lang: str, max_rows: int):
    """``(words, languages)`` of at most ``max_rows`` documents of the training folds, and
    of ``LANG_ROWS`` of each language."""
    usable = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (fold(key) != 0)).select(
        F.col(key).alias("__ck"), F.xxhash64(F.col(text)).alias("__ch"), F.col(lang).alias("__cl"))
    order = [F.xxhash64("__ck", "__ch"), F.col("__ck"), F.col("__ch")]
    # the filter on the row number is taken in each task before the shuffle
    each = usable.withColumn("__n", F.row_number().over(W.partitionBy("__cl").orderBy(*order))).filter(
        F.col("__n") <= LANG_ROWS)
    chosen = usable.orderBy(*order).limit(max_rows).select("__ck", "__ch").union(
        each.select("__ck", "__ch")).distinct()
    found = docs.select(F.col(key).alias("__k"), F.col(text).alias("__t"), F.col(lang).alias("__l")).join(
        F.broadcast(chosen), F.col("__k").eqNullSafe(F.col("__ck"))
        & (F.xxhash64("__t") == F.col("__ch"))).select("__t", "__l").filter("__l is not null")

    def run(batch):
        some = []
        for t in batch.column(0).to_pylist():
            w = words_of(t)
            at = np.unique(np.linspace(0, max(0, len(w) - 1), TRAIN_WORDS).astype(int))
            some.append([w[i][:PIECE] for i in at] if w else [])
        return {"l": batch.column(1), "w": some}

    rows = arrow_map(found, run, "l string, w array<binary>").orderBy("l", "w").collect()
    return [bytes(w) for r in rows for w in r.w], [r.l for r in rows for _ in r.w]


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
             max_rows: int = TRAIN_ROWS) -> DataFrame:
    """``(key, lang_pred, score)`` for every row of ``docs``."""
    docs = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), F.col(lang).alias("__lang"))
    words, names = training_words(docs, "__key", "__text", "__lang", max_rows)
    languages = sorted(set(names))
    number = {name: i for i, name in enumerate(languages)}
    model = train(words, np.array([number[n] for n in names]), len(languages)) if words else None

    state: dict = {"known": {}, "table": None}

    def run(batch):
        known, preds, scores = state["known"], [], []
        texts = batch.column(1).to_pylist()
        if len(known) > CACHE_WORDS or state["table"] is None:
            known.clear()
            state["table"] = np.zeros((0, max(1, len(languages))), np.float32)
        lists = [words_of(t) if model and t and (_LETTER.search(t) or any(map(str.isalpha, t))) else None
                 for t in texts]
        fresh = set().union(*(w for w in lists if w)) - known.keys()
        if fresh:
            fresh = sorted(fresh)
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            state["table"] = np.concatenate([state["table"], word_scores(model, fresh)])
        table = state["table"]
        for w in lists:
            if w is None:
                preds.append("und")
                scores.append(0.0)
                continue
            y = table[[known[x] for x in w]].sum(0, dtype=np.float64)
            p = np.exp(y - y.max())
            p /= p.sum()
            preds.append(languages[int(p.argmax())])
            scores.append(float(p.max()))
        return {"__key": batch.column(0), "lang_pred": preds, "score": scores}

    kind = docs.schema["__key"].dataType.simpleString()
    return arrow_map(docs.select("__key", "__text"), run,
                     f"__key {kind}, lang_pred string, score double").withColumnRenamed("__key", key)
