"""Operator 4: document quality by attention-based multiple-instance learning.

A document is a bag of passages (256 bytes each, the whole text). A passage is encoded from the
frequencies of its byte-class pairs by one tanh layer; gated attention weighs the passages; the
weighted mean representation is scored by a logistic unit. Only documents carry labels: the
gradient of the document loss teaches encoder, attention and score together (numpy, Adam).

Labels come from training folds only, and from at most ``TRAIN_ROWS`` labelled documents (chosen
by a hash of the id), so what reaches the driver is bounded; every passage of every document is
scored. Scoring reads each text once and shuffles nothing.

Defined results: null and empty texts are one empty passage and get the score learned for it;
without any training label every score is 0.5; repeated rows get equal scores; a document labelled
several times is learned once for each of them; null labels teach nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, fold

PASSAGE = 256
BATCH = 200_000  # bytes of text whose passages are arrays at a time: they take some 80 bytes a byte
TRAIN_ROWS = 4000
TRAIN_PASSAGES = 64  # of a training document, evenly spaced; scoring reads them all
HIDDEN, GATE = 16, 8
EPOCHS = 40
REJECT_BELOW = 0.3

#: byte classes: characters of one line behave alike
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r\t",
            ".", ",", "!?", "|", "#$%&*", "<>{}[]\\^~`", ":;", "/=_+@", "()\"'-")
N_CLASSES = len(_CLASSES) + 2  # then other ASCII, then bytes beyond ASCII
FEATURES = N_CLASSES * N_CLASSES


def class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.int64)
    for number, chars in enumerate(_CLASSES):
        table[[ord(c) for c in chars]] = number
    table[128:] = len(_CLASSES) + 1
    return table


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Class-pair counts of every passage (passages x FEATURES), and the first passage of each text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    per = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per)])
    data = class_table()[np.frombuffer(b"".join(texts), np.uint8)]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    text_of = np.repeat(np.arange(len(texts)), sizes)
    where = first[text_of] + (np.arange(len(data)) - starts[text_of]) // PASSAGE
    pair = data * N_CLASSES
    pair[:-1] += data[1:]
    ends = starts[1:][sizes > 0] - 1
    pair[ends] = data[ends] * N_CLASSES + data[ends]  # the last byte pairs with itself
    counts = np.bincount(where * FEATURES + pair, minlength=int(first[-1]) * FEATURES)
    return counts.reshape(-1, FEATURES), first[:-1]


def features(counts: np.ndarray) -> np.ndarray:
    """Square roots of frequencies: rare pairs still show."""
    counts = counts.astype(np.float32)
    return np.sqrt(counts / np.maximum(1, counts.sum(1, keepdims=True)))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(m, x, first):
    h = np.tanh(x @ m["W"] + m["b"])
    t, g = np.tanh(h @ m["V"]), _sigmoid(h @ m["U"])
    e = (t * g) @ m["a"]
    bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
    w = np.exp(e - np.maximum.reduceat(e, first)[bag])
    w /= np.add.reduceat(w, first)[bag]
    z = np.add.reduceat(w[:, None] * h, first, axis=0)
    return h, t, g, w, z, bag, _sigmoid(z @ m["o"] + m["c"])


def score(model: dict, texts: list[bytes]) -> np.ndarray:
    counts, first = passages(texts)
    return _forward(model, features(counts), first)[-1]


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Parameters fitted to bags of passage counts and their 0/1 labels."""
    rng = np.random.default_rng(seed)

    def start(*shape):
        return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

    rate = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    m = {"W": start(FEATURES, HIDDEN) * 4, "b": np.zeros(HIDDEN, np.float32), "V": start(HIDDEN, GATE),
         "U": start(HIDDEN, GATE), "a": start(GATE), "o": start(HIDDEN),
         "c": np.float32(np.log(rate / (1 - rate)))}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    xs, step = [features(b) for b in bags], 0
    for epoch in range(epochs):
        order = rng.permutation(len(xs))
        for at in range(0, len(order), 64):
            chosen = order[at:at + 64]
            x = np.concatenate([xs[i] for i in chosen])
            first = np.concatenate([[0], np.cumsum([len(xs[i]) for i in chosen])[:-1]])
            h, t, g, w, z, bag, p = _forward(m, x, first)
            d = ((p - labels[chosen]) / len(chosen)).astype(np.float32)
            dz = d[:, None] * m["o"]
            dw = np.einsum("ij,ij->i", dz[bag], h)
            de = w * (dw - np.add.reduceat(w * dw, first)[bag])
            dt, dg = de[:, None] * m["a"] * g * (1 - t * t), de[:, None] * m["a"] * t * g * (1 - g)
            dh = w[:, None] * dz[bag] + dt @ m["V"].T + dg @ m["U"].T
            dx = dh * (1 - h * h)
            gradient = {"W": x.T @ dx + 1e-5 * m["W"], "b": dx.sum(0), "V": h.T @ dt, "U": h.T @ dg,
                        "a": (t * g).T @ de, "o": z.T @ d + 1e-4 * m["o"], "c": d.sum()}
            step += 1
            for k, v in gradient.items():
                first_m, second_m = moments[k]
                moments[k] = (0.9 * first_m + 0.1 * v, 0.99 * second_m + 0.01 * v * v)
                size = 0.01 * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs))
                m[k] = (m[k] - size * (moments[k][0] / (1 - 0.9 ** step))
                        / (np.sqrt(moments[k][1] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return m


def training_bags(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
                  max_rows: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Passage counts and labels of at most ``max_rows`` labelled documents of the training folds."""
    chosen = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & (fold(key) != 0)).select(
        F.col(key).alias("__k"), F.col(label).cast("int").alias("__y")).orderBy(
        F.xxhash64("__k"), "__k", "__y").limit(max_rows)
    # the chosen labels are bounded by the limit; the texts stay where they are
    found = docs.select(F.col(key).alias("__k"), F.col(text).alias("__t")).join(
        F.broadcast(chosen), "__k").select("__k", "__t", "__y")

    def run(batch):
        texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        counts, first = passages(texts)
        bags = np.split(np.minimum(counts, 65535).astype(np.uint16), first[1:])
        thin = [b[np.unique(np.linspace(0, len(b) - 1, TRAIN_PASSAGES).astype(int))] for b in bags]
        return {"k": batch.column(0), "y": batch.column(2), "bag": [b.tobytes() for b in thin]}

    kind = docs.schema[key].dataType.simpleString()
    rows = arrow_map(found, run, f"k {kind}, y int, bag binary", BATCH).orderBy(
        F.xxhash64("k"), "k", "y", "bag").collect()
    return ([np.frombuffer(r.bag, np.uint16).reshape(-1, FEATURES) for r in rows],
            np.array([r.y for r in rows], np.float32))


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "quality", max_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) in place of any column of that name."""
    bags, y = training_bags(docs, labels, key, text, label, max_rows)
    model = train(bags, y) if len(bags) else None
    kept = [f for f in docs.schema.fields if f.name != "quality_score"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["quality_score double"])
    at = [docs.columns.index(f.name) for f in kept]
    text_at = docs.columns.index(text)

    def run(batch):
        texts = [(t or "").encode() for t in batch.column(text_at).to_pylist()]
        scores = score(model, texts).astype(float) if model else np.full(len(texts), 0.5)
        return {f.name: batch.column(i) for f, i in zip(kept, at)} | {"quality_score": scores}

    return arrow_map(docs, run, schema, BATCH)
