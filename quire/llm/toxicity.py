"""Operator 12: toxicity by a factorization machine over hashed terms.

The terms of a document are its distinct words in lower case and the first 3 to 7 characters of
longer ones, hashed into ``BUCKETS``. The score is logistic in ``w0 + sum w_i + sum over pairs
<v_i, v_j>``: the factors ``v`` let two terms that stand together (an insult and a group) mean more
than the sum of their weights, and as factors are shared, also pairs that were never seen together.

Only buckets that tell the classes apart have weights: Spark counts, per bucket, the toxic and other
documents of the training sample, and the ``TERMS`` buckets of largest two-proportion score are kept.
So a single insult in a very long text is not drowned by thousands of neutral words, and what reaches
the driver is bounded: ``TERMS`` rows of counts and the kept terms of at most ``TRAIN_ROWS`` labelled
documents (chosen by a hash of the id, written once as a small table). The machine is fitted there in
numpy (Adagrad). Every document is scored over its whole text in one narrow pass; the model sent along
has ``TERMS`` x (1 + ``FACTORS``) numbers.

Defined results: null and empty texts have no terms and get the base rate; without a training label
every score is 0; repeated rows get equal scores; of a key that repeats, the smallest text is learned,
once; a document with several labels counts as toxic if one says so; null keys and null labels teach
nothing. A very long text costs its lower-case copy and its distinct words.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, fold, texts_of
from quire.session import materialize

BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6, 7)
TERMS = 1024
FACTORS = 8
TRAIN_ROWS = 12_000
EPOCHS = 20
TOXIC_FROM = 0.3
LONG_TEXT = 1_000_000  # characters; longer texts are read word by word, without a list of all
CACHE_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]+")


def word_buckets(word: str) -> tuple[int, ...]:
    """Buckets of a word in lower case and of its prefixes."""
    terms = [word, *[word[:k] + "*" for k in PREFIXES if len(word) > k]]
    return tuple(zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in terms)


def distinct_words(text: str) -> set[str]:
    lower = text.lower()
    return set(_WORD.findall(lower)) if len(lower) <= LONG_TEXT else {m.group() for m in _WORD.finditer(lower)}


class Terms:
    """Kept terms of texts: ``number`` maps a bucket to its index, or all buckets where it is None.

    Words already met are looked up; the memory of them is bounded.
    """

    def __init__(self, number: dict[int, int] | None = None):
        self.number, self.known = number, {}

    def __call__(self, text: str) -> np.ndarray:
        out: set[int] = set()
        for word in distinct_words(text):
            found = self.known.get(word)
            if found is None:
                found = word_buckets(word)
                if self.number is not None:
                    found = tuple(self.number[b] for b in found if b in self.number)
                if len(self.known) >= CACHE_WORDS:
                    self.known.clear()
                self.known[word] = found
            out.update(found)
        return np.fromiter(sorted(out), np.int64, len(out))


# -- the machine ---------------------------------------------------------------------------------

def _flat(rows: list[np.ndarray], bias: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of all rows, each with the bias term first, the row of each index, row starts."""
    sizes = np.array([len(r) + 1 for r in rows])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    index = np.full(int(sizes.sum()), bias, np.int64)
    mask = np.ones(len(index), bool)
    mask[first] = False
    if mask.any():
        index[mask] = np.concatenate(rows)
    return index, np.repeat(np.arange(len(rows)), sizes), first


def _forward(model: dict, index: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities, factor sums of each row, factors of each index. The bias has zero factors."""
    v = model["v"][index]
    sums = np.add.reduceat(v, first, axis=0)
    squares = np.add.reduceat(np.einsum("ij,ij->i", v, v), first)
    z = np.add.reduceat(model["w"][index], first) + 0.5 * (np.einsum("ij,ij->i", sums, sums) - squares)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30))), sums, v


def predict(model: dict, rows: list[np.ndarray]) -> np.ndarray:
    if not rows:
        return np.zeros(0)
    index, _, first = _flat(rows, len(model["w"]) - 1)
    return _forward(model, index, first)[0]


def train(rows: list[np.ndarray], labels: np.ndarray, terms: int = TERMS, epochs: int = EPOCHS,
          rate: float = 0.1, decay: tuple[float, float] = (1e-3, 1e-2), seed: int = 12) -> dict:
    """Weights (the bias last) and factors fitted to rows of term numbers and 0/1 labels."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    w, v = np.zeros(terms + 1), rng.normal(0, 0.02, (terms + 1, FACTORS))
    w[terms], v[terms] = np.log(share / (1 - share)), 0
    model = {"w": w, "v": v}
    seen_w, seen_v = np.full(terms + 1, 1e-8), np.full((terms + 1, FACTORS), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            chosen = order[at:at + 64]
            index, row, first = _flat([rows[i] for i in chosen], terms)
            p, sums, factors = _forward(model, index, first)
            d = ((p - labels[chosen]) / len(chosen))[row]
            at_v = d[:, None] * (sums[row] - factors)
            touched, place = np.unique(index, return_inverse=True)
            gw = np.bincount(place, d) + decay[0] * w[touched] * (touched < terms)
            gv = np.stack([np.bincount(place, at_v[:, f]) for f in range(FACTORS)], 1) + decay[1] * v[touched]
            gv[touched == terms] = 0
            seen_w[touched] += gw * gw
            seen_v[touched] += gv * gv
            w[touched] -= rate * gw / np.sqrt(seen_w[touched])
            v[touched] -= 0.5 * rate * gv / np.sqrt(seen_v[touched])
    return model


# -- learning and scoring tables -----------------------------------------------------------------

def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, max_rows: int) -> DataFrame:
    """``(k, t, y)``: at most ``max_rows`` labelled documents of the training folds, written once."""
    chosen = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & (fold(key, 4) != 2))
              .groupBy(F.col(key).alias("k")).agg(F.max(F.col(label).cast("int")).alias("y"))
              .orderBy(F.xxhash64("k"), "k").limit(max_rows))
    # the chosen labels are bounded by the limit; a repeated key is reduced before the shuffle
    found = docs.select(F.col(key).alias("k"), F.coalesce(text, F.lit("")).alias("t")).join(F.broadcast(chosen), "k")
    return materialize(found.groupBy("k").agg(F.min("t").alias("t"), F.max("y").alias("y")), "toxicsample")


def telling_buckets(sample: DataFrame, terms: int = TERMS) -> list[int]:
    """The buckets whose shares of toxic and of other documents differ most for their frequency."""
    def count(batch):
        words, y = Terms(), np.array(batch.column(1).to_pylist(), np.int64)
        rows = [words(t) for t in texts_of(batch.column(0))]
        index, row, _ = _flat(rows, BUCKETS)  # the bias counts documents
        seen, place = np.unique(index, return_inverse=True)
        return {"b": seen, "toxic": np.bincount(place, y[row]).astype(np.int64), "n": np.bincount(place)}

    counts = arrow_map(sample.select("t", "y"), count, "b long, toxic long, n long").groupBy("b").agg(
        F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    counts = materialize(counts, "toxicterms")  # at most BUCKETS + 1 rows
    total = counts.filter(F.col("b") == BUCKETS).first()
    if total is None or total.toxic in (0, total.n):
        return []
    n, toxic = float(total.n), float(total.toxic)
    share, other = F.col("n") / n, F.col("n") - F.col("toxic")
    spread = F.sqrt(share * (1 - share) * (1 / toxic + 1 / (n - toxic)))
    z = F.abs(F.col("toxic") / toxic - other / (n - toxic)) / spread
    best = counts.filter(F.col("b") < BUCKETS).filter(F.col("n") < n).select("b", z.alias("z"))
    return sorted(r.b for r in best.orderBy(F.col("z").desc(), "b").limit(terms).collect())


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = TRAIN_ROWS) -> tuple[dict[int, int], dict] | None:
    """Term numbers by bucket and the machine; None without a training label."""
    sample = training_sample(docs, labels, key, text, label, max_rows)
    number = {b: i for i, b in enumerate(telling_buckets(sample))}

    def run(batch):
        words = Terms(number)
        return {"y": batch.column(1), "x": [words(t) for t in texts_of(batch.column(0))]}

    rows = arrow_map(sample.orderBy("k").select("t", "y"), run, "y int, x array<long>").collect()
    if not rows:
        return None
    return number, train([np.array(r.x, np.int64) for r in rows], np.array([r.y for r in rows], float))


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    label: str = "toxic", out: str = "toxicity", max_rows: int = TRAIN_ROWS) -> DataFrame:
    """``(key, out)``: the probability that a document is toxic, a row for each row of ``docs``."""
    fitted = fit(docs, labels, key, text, label, max_rows)
    made: list[Terms] = []  # one memory of words a task

    def run(batch):
        if fitted is None:
            scores = np.zeros(batch.num_rows)
        else:
            if not made:
                made.append(Terms(fitted[0]))
            scores = predict(fitted[1], [made[0](t) for t in texts_of(batch.column(1))])
        return {key: batch.column(0), out: scores}

    kind = docs.schema[key].dataType.simpleString()
    return arrow_map(docs.select(key, text), run, f"`{key}` {kind}, `{out}` double")

