"""Operator 2: language-model scores from a log-bilinear neural model.

Tokens are words (A-Z lower-cased, cut at ASCII white space) and one end a text. The model factors
a word into its class and the word in it: the most frequent words are classes of their own, the
others share classes by their last two bytes. The vectors of the ``ORDER`` classes before a token,
scaled for each distance, add up to a prediction; its products with the class vectors, plus biases,
are normalised over all classes by batched matrix products. A class spreads its probability over
its words by their corpus counts (c + 0.5, and 0.5 for one unseen word), so the probabilities of a
position sum to one.

The class model is learned by noise-contrastive estimation in numpy over every training text: each
partition starts from the same parameters and reads all its texts in minibatches with noise from the
class counts; the results are averaged, weighted by tokens. Word counts are exact, over all training
texts. Words of at most ``HEAD`` highest counts (a bound on what is broadcast) are looked up in the
task; all others are joined on the word, so no text and no whole vocabulary passes the driver.

Defined results: null text is empty text (one token, the end); a null key counts as empty text when
folds are drawn; repeated rows are rows like others, in counts too; without training rows N and V
are 0, the base is 0 and the model uniform over classes.
"""

from __future__ import annotations

import io
import math
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, fold, sorted_groups
from quire.session import materialize

HEAD = 200_000
TOP, SUFFIXES = 96, 159  # classes: end, TOP words, SUFFIXES by last two bytes
CLASSES = 1 + TOP + SUFFIXES
ORDER, SIZE = 5, 16
NOISE, BATCH, RATE = 40, 4096, 0.15
SCORED = 1024  # positions of a product when scoring: its class scores stay in a core's cache
GATHER = 16  # averages of parameters that reach the driver


def tokens(text: str | None) -> list[bytes]:
    """Words; the end is not among them."""
    return (text or "").encode().lower().split()


class Classes:
    """Class of a word: 0 the end, then the top words, then hashed endings."""

    def __init__(self, top: list[bytes]):
        self.top = {w: i + 1 for i, w in enumerate(top)}
        self.ending = _Endings()

    def __call__(self, words: list[bytes]) -> list[int]:
        top, ending = self.top.get, self.ending
        return [top(w) or ending[w[-2:]] for w in words]


class _Endings(dict):
    def __missing__(self, ending: bytes) -> int:
        number = self[ending] = 1 + TOP + crc32(ending) % SUFFIXES
        return number


def start_parameters(prior: np.ndarray) -> dict[str, np.ndarray]:
    """The common start of all partitions: the class prior, and small random vectors."""
    rng = np.random.default_rng(2)
    return {"R": (rng.normal(size=(CLASSES + 1, SIZE)) * 0.3).astype(np.float32),
            "P": np.full((ORDER, SIZE), 1 / ORDER, np.float32),
            "Q": (rng.normal(size=(CLASSES, SIZE)) * 0.1).astype(np.float32),
            "b": np.log(prior).astype(np.float32)}


def windows(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Targets of all texts (their ends included) and the ORDER classes before each; before a text
    stands the class CLASSES."""
    pad = [CLASSES] * ORDER
    flat: list[int] = []
    for text in ids:
        flat += pad
        flat += text
        flat.append(0)
    line = np.array(flat, np.int32)
    at = np.flatnonzero(line != CLASSES)
    context = np.empty((len(at), ORDER), np.int32, order="F")  # each distance is read as a whole
    for k in range(ORDER):
        context[:, k] = line[at - k - 1]
    return line[at], context


def predictions(m: dict, context: np.ndarray) -> np.ndarray:
    out = (m["R"] * m["P"][0])[context[:, 0]]  # scaled as a table, then gathered
    for k in range(1, ORDER):
        out += (m["R"] * m["P"][k])[context[:, k]]
    return out


def log_probabilities(m: dict, target: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural log-probability of each target class, normalised over all classes."""
    out = np.empty(len(target))
    classes = np.concatenate([m["Q"].T, m["b"][None, :]])
    for k in range(0, len(target), SCORED):
        t = target[k:k + SCORED]
        q = predictions(m, context[k:k + SCORED])
        s = np.concatenate([q, np.ones((len(q), 1), np.float32)], 1) @ classes
        s -= s.max(1, keepdims=True)
        own = s[np.arange(len(t)), t]
        np.exp(s, out=s)
        out[k:k + SCORED] = own - np.log(s.sum(1))
    return out


def _add_rows(n: int, index: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows summed by index."""
    flat = (index[:, None].astype(np.int64) * SIZE + np.arange(SIZE)).reshape(-1)
    return np.bincount(flat, rows.reshape(-1), n * SIZE).reshape(n, SIZE).astype(np.float32)


class Trainer:
    """Noise-contrastive estimation with per-parameter step sizes (AdaGrad)."""

    def __init__(self, parameters: dict, prior: np.ndarray, seed: int = 1):
        self.m = {k: v.copy() for k, v in parameters.items()}
        self.sums = {k: np.full_like(v, 0.05) for k, v in parameters.items()}
        self.prior, self.rng, self.seen = prior, np.random.default_rng(seed), 0
        self.log_noise = np.log(NOISE * prior).astype(np.float32)
        self.steps = np.cumsum(prior)

    def learn(self, target: np.ndarray, context: np.ndarray) -> None:
        order = self.rng.permutation(len(target))
        for k in range(0, len(order), BATCH):
            self._step(target[order[k:k + BATCH]], context[order[k:k + BATCH]])
        self.seen += len(target)

    def _step(self, t, context):
        m, n = self.m, len(t)
        noise = np.minimum(np.searchsorted(self.steps, self.rng.random(NOISE)), CLASSES - 1)
        q = predictions(m, context)
        of_data = np.einsum("bd,bd->b", q, m["Q"][t]) + m["b"][t] - self.log_noise[t]
        of_noise = q @ m["Q"][noise].T + (m["b"][noise] - self.log_noise[noise])
        g_data = (1 / (1 + np.exp(-np.clip(of_data, -30, 30))) - 1).astype(np.float32) / n
        g_noise = (1 / (1 + np.exp(-np.clip(of_noise, -30, 30)))).astype(np.float32) / n
        dq = g_data[:, None] * m["Q"][t] + g_noise @ m["Q"][noise]
        # dq summed by the class at each distance gives both gradients of the context side
        by_class = [_add_rows(CLASSES + 1, context[:, k], dq) for k in range(ORDER)]
        gradient = {
            "Q": _add_rows(CLASSES, t, g_data[:, None] * q) + _add_rows(CLASSES, noise, g_noise.T @ q),
            "b": (np.bincount(t, g_data, CLASSES) + np.bincount(noise, g_noise.sum(0), CLASSES)).astype(np.float32),
            "P": np.stack([(s * m["R"]).sum(0) for s in by_class]),
            "R": sum(s * m["P"][k] for k, s in enumerate(by_class))}
        for k, g in gradient.items():
            g = g * np.float32(20)  # a common scale; the step sizes adapt
            self.sums[k] += g * g
            m[k] -= np.float32(RATE) * g / np.sqrt(self.sums[k])


def _pack(m: dict) -> bytes:
    out = io.BytesIO()
    np.savez(out, **m)
    return out.getvalue()


def _unpack(blob: bytes) -> dict:
    data = np.load(io.BytesIO(blob))
    return {k: data[k] for k in data.files}


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, c)`` of a table of texts; the end is the empty word. Counted in the task first."""
    arrow = pa.schema([("word", pa.binary()), ("c", pa.int64())])

    def emit(counter):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], schema=arrow)

    def run(batches):
        counter: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counter.update(tokens(t))
                counter[b""] += 1
                if len(counter) > 600_000:
                    yield emit(counter)
                    counter = Counter()
        if counter:
            yield emit(counter)

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def head_words(counts: DataFrame, limit: int) -> tuple[list[bytes], list[int]]:
    """All words above a count, at most ``limit`` of them (the count is found from a histogram of
    counts, some hundred rows), most frequent first."""
    step = F.floor(F.log2("c") * 4)
    histogram = counts.filter("word <> x''").groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("s")).collect()
    total, least = 0, None
    for r in histogram:
        if total + r.n > limit:
            break
        total, least = total + r.n, r.s
    if least is None:
        return [], []
    rows = counts.filter("word <> x''").filter(step >= least).collect()
    rows.sort(key=lambda r: (-r.c, bytes(r.word)))
    return [bytes(r.word) for r in rows], [r.c for r in rows]


def class_totals(counts: DataFrame, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each class (the whole vocabulary is read, in tasks)."""
    def run(batch):
        words = [bytes(w) for w in batch.column(0).to_pylist()]
        of = np.array([0 if not w else c for w, c in zip(words, classes(words))], np.int64)
        n = np.bincount(of, batch.column(1).to_numpy(), CLASSES).astype(np.int64)
        v = np.bincount(of, minlength=CLASSES)
        some = np.flatnonzero(v)
        return {"k": some, "n": n[some], "v": v[some]}

    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in arrow_map(counts, run, "k int, n long, v long").groupBy("k").agg(F.sum("n"), F.sum("v")).collect():
        n[r[0]], v[r[0]] = r[1], r[2]
    return n, v


def train(texts: DataFrame, classes: Classes, prior: np.ndarray) -> dict:
    """Parameters learned from every text: partitions learn apart and are averaged by tokens."""
    first = start_parameters(prior)
    arrow = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("blob", pa.binary())])

    def learn(batches):
        trainer = Trainer(first, prior)
        ids: list[list[int]] = []
        held = 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                ids.append(classes(tokens(t)))
                held += len(ids[-1]) + 1
                if held >= 16 * BATCH:
                    trainer.learn(*windows(ids))
                    ids, held = [], 0
        if ids:
            trainer.learn(*windows(ids))
        if trainer.seen:
            blob = _pack(trainer.m)
            yield pa.RecordBatch.from_arrays([pa.array([crc32(blob) % GATHER], pa.int32()),
                                              pa.array([trainer.seen]), pa.array([blob], pa.binary())], schema=arrow)

    def average(batches):
        for table in sorted_groups(batches, ["part"]):
            n = table.column("n").to_numpy()
            total = None
            for weight, blob in zip(n, table.column("blob")):
                m = {k: v.astype(np.float64) * weight for k, v in _unpack(blob.as_py()).items()}
                total = m if total is None else {k: total[k] + m[k] for k in m}
            mean = {k: v / n.sum() for k, v in total.items()}
            yield pa.RecordBatch.from_arrays([table.column("part").combine_chunks()[:1], pa.array([n.sum()]),
                                              pa.array([_pack(mean)], pa.binary())], schema=arrow)

    schema = "part int, n long, blob binary"
    rows = texts.mapInArrow(learn, schema).repartition(GATHER, "part").sortWithinPartitions("part").mapInArrow(
        average, schema).collect()
    if not rows:
        return first
    rows.sort(key=lambda r: r.part)
    weight = np.array([r.n for r in rows], float) / sum(r.n for r in rows)
    means = [_unpack(r.blob) for r in rows]
    return {k: sum(w * m[k] for w, m in zip(weight, means)).astype(np.float32) for k in first}


def lm_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out: int = 1,
              head: int = HEAD) -> DataFrame:
    """``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), (fold(key) == held_out).alias("held_out"))
    learned = rows.filter("not held_out").select("text")
    counts = materialize(word_counts(learned), "counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_train, distinct = int(total[0]), int(total[1])
    words, of = head_words(counts, head)
    classes = Classes(words[:TOP])
    in_class, words_in_class = class_totals(counts, classes)
    spread = in_class + 0.5 * words_in_class + 0.5  # c + 0.5 for each word, 0.5 for an unseen one
    prior = spread / spread.sum()
    model = train(learned, classes, prior)

    end_log = math.log10((in_class[0] if n_train else 0) + 0.5)
    known = spark.sparkContext.broadcast({w: math.log10(c + 0.5) for w, c in zip(words, of)})
    log_spread = np.log10(spread)
    kind = docs.schema[key].dataType.simpleString()

    def run(batch):
        get = known.value.get
        texts = [tokens(t) for t in batch.column(1).to_pylist()]
        ids = [classes(w) for w in texts]
        target, context = windows(ids)
        p = log_probabilities(model, target, context) / math.log(10) - log_spread[target]
        ends = np.cumsum([len(i) + 1 for i in ids])
        model_log = np.add.reduceat(p, np.concatenate([[0], ends[:-1]]))
        logs, rest = [], []
        for w in texts:
            found = list(map(get, w))
            rest.append([x for x, g in zip(w, found) if g is None] if None in found else [])
            logs.append(sum(g for g in found if g is not None) + end_log)
        return {"key": batch.column(0), "held_out": batch.column(2), "n_tokens": [len(w) + 1 for w in texts],
                "head_log": logs, "model_log": model_log, "rest": rest}

    scored = materialize(arrow_map(rows, run, f"key {kind}, held_out boolean, n_tokens long, head_log double, "
                                   "model_log double, rest array<binary>").withColumn(
        "row", F.monotonically_increasing_id()), "scored")
    # words beyond the head meet their counts by a join on the word
    least = of[-1] if of else None
    tail = counts.filter("word <> x''") if least is None else counts.filter(F.col("c") < least)
    found = scored.select("row", F.explode("rest").alias("word")).join(tail, "word").groupBy("row").agg(
        F.sum(F.log10(F.col("c") + F.lit(0.5))).alias("tail_log"), F.count(F.lit(1)).alias("tail_known"))
    full = scored.select("row", "key", "held_out", "n_tokens", "head_log", "model_log",
                         F.size("rest").alias("beyond")).join(found, "row", "left")
    unseen = F.col("beyond") - F.coalesce("tail_known", F.lit(0)) + F.lit(0 if n_train else 1)
    logs = F.col("head_log") + F.coalesce("tail_log", F.lit(0.0)) + (
        F.col("beyond") - F.coalesce("tail_known", F.lit(0))) * F.lit(math.log10(0.5))
    base = logs - F.col("n_tokens") * F.lit(math.log10(n_train + 0.5 * (distinct + 1)))
    return full.select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("n_tokens") - unseen).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"),
        (logs + F.col("model_log")).alias("score"))
