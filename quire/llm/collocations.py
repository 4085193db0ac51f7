"""Operator 13: phrase collocations by SON partitioning.

A phrase of 2 to 4 words that stands at least ``SUPPORT`` times in a language stands, in at least one
shard of the documents, as often as the shard's share of that language's words says. So every shard is
mined completely at its lowered support, what is frequent in some shard is a candidate, and candidates
are counted over all documents, exactly, as text.

* Shards are dealt by a hash of the text; their number is a parameter, not a function of the data,
  because a lowered support of one would make every phrase frequent. A shard is mined by all tasks:
  n-grams are hashed (128 bits) and counted in numpy within a task, the counts are summed by Spark.
* Mining goes by length: an n-gram is counted, in every shard, only if its first and its last n - 1 words
  stand ``SUPPORT`` times in the language. Tasks look that up in a bitmap of ``FILTER_BITS`` bits, the one
  thing that is broadcast; its size is a parameter. Collisions in it only let more through.
* So what the shards count of a candidate is all of it: their sum is the exact count. Parts of a phrase are
  at least as frequent as the phrase, so the same table holds the counts of all parts.
* Every sum remembers one slot (a hash of the text, ``SLOT_BITS`` bits) in which the n-gram stands. The texts
  are read once more to spell the phrases out, each from the texts of its slot alone: about one row a phrase,
  not one of every task that has it.

Text is read five times and never shuffled. Splitting, scores and the dropping of contained phrases are
equi-joins on (language, phrase).

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count
again; ties of scores are broken by count, then by bytes of the phrase; an empty table gives no rows;
other columns do not matter. A text is read in slices of a megabyte, cut where pieces end; one piece
without any cut is held at about 40 bytes a byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import bitmap, give_back, in_bitmap, mix64
from quire.session import materialize

SUPPORT = 30
LONGEST = 4
SHARDS = 2
FILTER_BITS = 27  # 2 ** 27 bits: a bitmap of 16 MB
SLOT_BITS = 16
CONTAINED = 80  # per cent of a phrase's occurrences that lie in a longer one, from which it is dropped
SCALE = 2_000_000
TOP = 2000
SLICE = 1_000_000  # bytes
ROWS = 500  # texts that are Python strings at a time
HELD = 400_000  # hashes that a task sums up before it passes them on
SPELT = 50_000  # phrases that are spelt out at a time
HELD_BYTES = 8_000_000  # of texts that they stand in
SALTS = 32  # of a language's phrases in the first ranking

_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?") + list(range(0x0A, 0x0E))] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KEYS, _MORE_KEYS = np.random.default_rng(131).integers(1, 2**63, (2, 256), dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base % 2**64, np.uint64)]), dtype=np.uint64)


class Words:
    """The words of a slice of texts: where each begins and ends in ``data``, its piece and row; ``hashes`` of
    the k words from each on (no use where they leave the piece)."""

    def __init__(self, slices: list[tuple[int, bytes]], tables: tuple[np.ndarray, np.ndarray]):
        self.data = _LOWER[np.frombuffer(b"\n".join(t for _, t in slices) + b"\n", np.uint8)]
        kind = _KIND[self.data]
        word = kind == 0
        self.begin = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
        self.end = np.flatnonzero(word & ~np.concatenate([word[1:], [False]])) + 1
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.begin] if len(self.begin) else np.zeros(0, np.int32)
        ends = np.cumsum([len(t) + 1 for _, t in slices])
        self.row = np.array([r for r, _ in slices])[np.searchsorted(ends, self.begin, "right")]
        self.tables = tables

    def hashes(self, keys: np.ndarray, longest: int) -> dict[int, np.ndarray]:
        """64-bit hashes of the runs of 1 to ``longest`` words from each word on, by a table of byte keys."""
        power, inverse = self.tables
        total = np.concatenate([[np.uint64(0)], np.cumsum(keys[self.data] * power[:len(self.data)], dtype=np.uint64)])
        one = mix64((total[self.end] - total[self.begin]) * inverse[self.begin])
        grams = {1: one}
        for k in range(2, longest + 1):
            longer = one.copy()
            n = max(0, len(one) - k + 1)
            longer[:n] = mix64(grams[k - 1][:n] * np.uint64(0xD6E8FEB86659FD93) + one[k - 1:] + np.uint64(k))
            grams[k] = longer
        return grams

    def hashes_beside(self, longest: int) -> dict[int, np.ndarray]:
        """64 more bits for each of ``hashes``, independent of them."""
        one = self.hashes(_MORE_KEYS, 1)[1]
        grams = {1: one}
        for k in range(2, longest + 1):
            n = max(0, len(one) - k + 1)
            grams[k] = mix64(grams[k - 1][:n] * np.uint64(_BASE) + one[k - 1:])
        return grams

    def spelt(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts with one space after each word of a piece and no other blanks, and where each word begins and
        ends there: a phrase is what lies from its first to its last word."""
        blank = _KIND[self.data] == 1
        before = np.concatenate([[True], ~blank[:-1] & (_KIND[self.data[:-1]] == 2) | blank[:-1]])
        kept = ~(blank & before)
        place = np.cumsum(kept, dtype=np.int32) - 1
        return np.where(blank, np.uint8(0x20), self.data)[kept], place[self.begin], place[self.end - 1] + 1

    def places(self, k: int) -> np.ndarray:
        """Words from which k words of one piece go on."""
        n = len(self.begin) - k + 1
        return np.flatnonzero(self.piece[:n] == self.piece[k - 1:]) if n > 0 else np.zeros(0, np.int64)


def slices_of(texts: list[str | None]) -> Iterator[list[tuple[int, bytes]]]:
    """Row numbers and bytes in slices of about a megabyte; long texts are cut where a piece ends."""
    held, size = [], 0
    for row, text in enumerate(texts):
        rest = memoryview((text or "").encode("utf-8", "surrogatepass"))
        while len(rest):
            part = rest
            if len(rest) > SLICE:
                cut = np.flatnonzero(_KIND[np.frombuffer(rest, np.uint8)[SLICE:]] == 2)
                if len(cut):
                    part = rest[:SLICE + int(cut[0]) + 1]
            held.append((row, bytes(part)))
            size += len(part)
            rest = rest[len(part):]
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _seeds(names: list[str]) -> np.ndarray:
    """A 64-bit number for each group name."""
    out = np.zeros(len(names), np.uint64)
    for i, name in enumerate(names):
        raw = np.frombuffer(name.encode("utf-8", "surrogatepass") + b"\x00", np.uint8)
        out[i] = mix64(np.array([(_KEYS[raw] * _powers(_BASE, len(raw))[:len(raw)]).sum(dtype=np.uint64)]))[0]
    return out


def _unmixed(x: np.ndarray) -> np.ndarray:
    """What ``mix64`` made ``x`` of."""
    for shift, factor in ((31, 0x94D049BB133111EB), (27, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift)) ^ (x >> np.uint64(2 * shift))) * np.uint64(pow(factor, -1, 2**64))
    return x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))


def _counted(texts: DataFrame, counter: Callable, schema: str) -> DataFrame:
    """Rows of ``count(words, seeds of languages, group of each word, groups, slot of each word)`` for every slice of
    the texts.

    ``counter()`` gives each task its ``count``, which may hold rows back, and what gives the rest; both give lists of
    columns.
    """
    target = texts.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)
    slot = f"cast(shiftrightunsigned(xxhash64(coalesce(text, '')), {64 - SLOT_BITS}) as int) as slot"

    def made(out):
        return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    def run(batches):
        tables = [np.zeros(0, np.uint64)] * 2
        count, rest = counter()
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            langs, shards, body = (batch.column(i).to_pylist() for i in range(3))
            slots = batch.column(3).to_numpy()
            names = sorted(set(zip(langs, shards)))
            number = {n: i for i, n in enumerate(names)}
            group = np.array([number[g, s] for g, s in zip(langs, shards)])
            seeds = _seeds([f":{g}" for g, _ in names])
            for part in slices_of(body):
                need = sum(len(t) + 1 for _, t in part)
                if len(tables[0]) <= need:
                    tables = [_powers(_BASE, need), _powers(pow(_BASE, -1, 2**64), need)]
                words = Words(part, tuple(tables))
                if len(words.begin):
                    yield from map(made, count(words, seeds, group[words.row], names, slots[words.row]))
        yield from map(made, rest())
        del tables
        give_back()

    return texts.selectExpr("lang", "shard", "text", slot).mapInArrow(run, target)


# -- mining the shards ---------------------------------------------------------------------------

def _summed(parts: list[tuple[np.ndarray, ...]], keys: int = 1) -> tuple[np.ndarray, ...]:
    """Parts of (hash, other keys, count, other columns) as one: a row for each of the keys with its sum, other columns
    of its first row. Keys whose hashes are equal may stay several rows."""
    columns = parts[0] if len(parts) == 1 else [np.concatenate(c) for c in zip(*parts)]
    order = np.argsort(columns[0])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in columns[:keys]:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    firsts = np.flatnonzero(new)
    first = order[firsts]
    total = np.add.reduceat(columns[keys][order], firsts) if len(firsts) else columns[keys]
    return *[c[first] for c in columns[:keys]], total, *[c[first] for c in columns[keys + 1:]]


def _mine(texts: DataFrame, k: int, marked, bits: int, shards: list[int]) -> DataFrame:
    """``(l, h, h2, slot, n0, n1, ..)``: n-grams of k words whose two parts pass the bitmap, with their count in each
    shard; l is the seed of the language. Single words come with ``lang``."""
    named = k == 1
    schema = ("lang string, " if named else "") + "l long, shard int, h long, h2 long, n long, slot int"

    def counter():
        held, size, known = [], 0, {}

        def count(words, seeds, group, names, slot):
            nonlocal size
            at, grams, beside = words.places(k), words.hashes(_KEYS, k), words.hashes_beside(k)[k]
            if marked is not None:
                seen = in_bitmap(marked.value, mix64(grams[k - 1] ^ seeds[group]), bits)
                at = at[seen[at] & seen[at + 1]]
            own = _seeds([f"{s}:{g}" for g, s in names])
            code = np.array([known.setdefault(n, (len(known), *pair))[0]
                             for n, *pair in zip(names, seeds.tolist(), own.tolist())], np.int32)
            # hashed with the shard, for sums within it
            keys = mix64(grams[k][at] ^ own[group[at]])
            held.append(_summed([(keys, beside[at], np.ones(len(at), np.int64), code[group[at]], slot[at])], 2))
            size += len(held[-1][0])
            return drained() if size >= HELD else []

        def drained():
            nonlocal size
            if not size:
                return []
            keys, beside, n, of, slot = _summed(held, 2)
            held.clear()
            size = 0
            language, own = (np.array([v[i] for v in known.values()], np.uint64) for i in (1, 2))
            h = mix64(_unmixed(keys) ^ (own ^ language)[of])  # the shard is taken out of the hash again
            out = {"l": language.view(np.int64)[of], "shard": np.array([s for _, s in known], np.int32)[of],
                   "h": h.view(np.int64), "h2": beside.view(np.int64), "n": n, "slot": slot}
            if named:
                out["lang"] = pa.array([g for g, _ in known]).take(pa.array(of))
            return [out]

        return count, drained

    by = ["lang"] * named + ["l", "h", "h2"]
    counts = [F.expr(f"sum(if(shard = {s}, n, 0L))").alias(f"n{i}") for i, s in enumerate(shards)]
    return _counted(texts, counter, schema).groupBy(*by).agg(F.min("slot").alias("slot"), *counts)


def frequent_in_shards(texts: DataFrame, support: int = SUPPORT, bits: int = FILTER_BITS,
                       shards: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lang, k, h, h2, f, slot)`` of every n-gram that is frequent in a shard and stands ``support`` times in all,
    and ``(lang, n)`` words.

    ``h`` and ``h2`` are hashes of n-gram and language, f its count, ``slot`` a slot of texts that has it. Shards are
    numbered from 0 if their number is given.
    """
    spark = texts.sparkSession
    numbers = list(range(shards)) if shards else sorted(r[0] for r in texts.select("shard").distinct().collect())
    one = materialize(_mine(texts, 1, None, bits, numbers), "words")
    every = range(len(numbers))
    sizes = one.groupBy("lang", "l").agg(*[F.sum(f"n{i}").alias(f"m{i}") for i in every])
    sizes = sizes.withColumn("n", F.expr(" + ".join(["0L", *[f"m{i}" for i in every]])))
    # the smallest whole count that is at least the shard's share of the support
    share = "cast((cast({s} as decimal(38,0)) * m{i} + n - 1) div n as long) as least{i}"
    lowered = materialize(sizes.selectExpr("lang", "l", "n", *[share.format(s=support, i=i) for i in every]), "support")
    candidate = " or ".join(["false", *[f"(n{i} > 0 and n{i} >= least{i})" for i in every]])
    total = " + ".join(["0L", *[f"n{i}" for i in every]])
    found, counts = None, one.drop("lang")
    for k in range(1, LONGEST + 1):
        if k > 1:
            counts = _mine(texts, k, spark.sparkContext.broadcast(marked), bits, numbers)
        frequent = counts.join(lowered.drop("n"), "l").filter(candidate).selectExpr(
            "lang", f"{k} as k", "h", "h2", f"{total} as f", "slot").filter(F.col("f") >= support)
        frequent = materialize(frequent, f"frequent{k}")
        marked = bitmap(frequent, bits) if k < LONGEST else None
        found = frequent if found is None else found.unionByName(frequent)
    return found, lowered.select("lang", "n")


# -- the phrases as text -------------------------------------------------------------------------

def exact_counts(texts: DataFrame, candidates: DataFrame, support: int = SUPPORT, bits: int = FILTER_BITS) -> DataFrame:
    """``(lang, phrase, k, f)`` of all candidates (and words) that stand ``support`` times."""
    wanted = candidates.filter(F.col("f") >= support)
    place = F.expr(f"h ^ shiftleft(cast(slot as long), {64 - SLOT_BITS}) ^ slot").alias("h")
    marked = texts.sparkSession.sparkContext.broadcast(bitmap(wanted.select(place), bits))

    def counter():
        held, size = [], 0  # of this task: hashes of phrases, and where each stands
        spelt, length, known = [], 0, {}

        def count(words, seeds, group, names, slot):
            nonlocal size, length
            code = np.array([known.setdefault(g, len(known)) for g, _ in names], np.int32)
            grams, beside = words.hashes(_KEYS, LONGEST), words.hashes_beside(LONGEST)
            text, begin, end = words.spelt()
            slot = slot.astype(np.uint64)
            slot ^= slot << np.uint64(64 - SLOT_BITS)
            for k in range(1, LONGEST + 1):
                at = words.places(k)
                keys = mix64(grams[k][at] ^ seeds[group[at]])
                seen = in_bitmap(marked.value, keys ^ slot[at], bits)
                at, keys = at[seen], keys[seen]
                held.append(_summed([(keys, beside[k][at], np.ones(len(at), np.int64), begin[at].astype(np.int64) + length,
                                      end[at + k - 1] - begin[at], np.full(len(at), k, np.int8), code[group[at]])], 2))
                size += len(held[-1][0])
            spelt.append(text)
            length += len(text)
            return drained() if size >= HELD or length >= HELD_BYTES else []

        def drained():
            nonlocal size, length
            out = []
            if size:
                keys, beside, _, start, many, k, lang = _summed(held, 2)
                held.clear()
                text = np.concatenate(spelt)
                langs = pa.array(list(known))
                for i in range(0, len(keys), SPELT):
                    part = slice(i, i + SPELT)
                    offset = np.concatenate([[0], np.cumsum(many[part], dtype=np.int64)])
                    at = np.arange(offset[-1]) + np.repeat(start[part] - offset[:-1], many[part])
                    phrase = pa.StringArray.from_buffers(len(offset) - 1, pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(text[at]))
                    out.append({"h": keys[part].view(np.int64), "h2": beside[part].view(np.int64), "k": k[part].astype(np.int32),
                                "lang": langs.take(pa.array(lang[part])), "phrase": phrase})
            held.clear()
            spelt.clear()
            size = length = 0
            return out

        return count, drained

    spelled = _counted(texts, counter, "lang string, h long, h2 long, k int, phrase string")
    # rows that a collision in the bitmap let through find no candidate
    return spelled.distinct().join(wanted.select("lang", "h", "h2", "f"), ["lang", "h", "h2"]).select(
        "lang", "phrase", "k", "f")


# -- scores --------------------------------------------------------------------------------------

def _part(words: str, start: str, size: str) -> Column:
    return F.expr(f"array_join(slice({words}, {start}, {size}), ' ')")


def _scored(counts: DataFrame, scale: int, contained: int) -> DataFrame:
    """Candidates of two words and more with their lowest-scoring cut, contained ones dropped."""
    phrases = counts.filter("k > 1").withColumn("words", F.split("phrase", " "))
    # parts of longer phrases: a phrase is dropped if one of them has most of its occurrences
    inner = phrases.filter("k > 2").select(
        "lang", F.col("f").alias("longer"), "words", "k", F.explode(F.expr("sequence(2, k - 1)")).alias("size"))
    inner = inner.select("lang", "longer", "words", "size", F.explode(F.expr("sequence(1, k - size + 1)")).alias("start"))
    inner = inner.select("lang", _part("words", "start", "size").alias("phrase"), "longer").groupBy("lang", "phrase").agg(
        F.max("longer").alias("longer"))
    kept = phrases.join(inner, ["lang", "phrase"], "left").filter(
        f"longer is null or cast(100 as decimal(38,0)) * longer < cast({contained} as decimal(38,0)) * f")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), "words", "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = materialize(cuts.select("lang", "phrase", "a", "cut", _part("words", "1", "cut").alias("left"),
                                   _part("words", "cut + 1", "k - cut").alias("right")), "cuts")
    part = counts.select("lang", F.col("phrase").alias("part"), "f")
    # both joins are of plain tables, so that a part that very many phrases share can be split
    scored = cuts.join(part.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    scored = materialize(scored.select("lang", "phrase", "a", "cut", "l", "right"), "lefts")
    scored = scored.join(part.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr(f"cast((cast({scale} as decimal(38,0)) * a) div (cast(l as decimal(38,0)) + r) as long)")
    scored = scored.select("lang", "phrase", "a", "l", "r", score.alias("score"), "cut")
    lowest = F.min(F.struct("score", "cut", "l", "r"))
    return scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest.alias("low")).select(
        "lang", "phrase", "a", "low.l", "low.r", "low.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", support: int = SUPPORT, shards: int = SHARDS,
                 top: int = TOP, bits: int = FILTER_BITS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of each language."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                        F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(shards)).cast("int").alias("shard"),
                        F.col(text).alias("text"))
    candidates, totals = frequent_in_shards(texts, support, bits, shards)
    counts = materialize(exact_counts(texts, candidates, support, bits), "phrases")
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # ranked in salts first, so that no task sees more of a language than salts x top phrases
    salted = _scored(counts, SCALE, CONTAINED).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).filter(
        F.col("rank") <= top).drop("rank", "salt")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(
        F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              "n", "score")


def oracle() -> str:
    """DuckDB twin: all n-grams counted, none pruned."""
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    after = ", ".join(f"lead(word, {i}) OVER w AS w{i}" for i in range(1, LONGEST))
    grams = "\n  UNION ALL ".join(
        "SELECT lang, {k} AS k, {text} AS phrase FROM runs WHERE {last} IS NOT NULL".format(
            k=k, text=" || ' ' || ".join(["word", *[f"w{i}" for i in range(1, k)]]),
            last=f"w{k - 1}" if k > 1 else "word") for k in range(1, LONGEST + 1))
    return f"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({lowered}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
numbered AS (SELECT lang, row_number() OVER () AS id, string_split_regex(piece, '[\\x20\\x09]+') AS words FROM pieces),
words AS (SELECT lang, id, unnest(words) AS word, unnest(range(len(words))) AS place FROM numbered),
runs AS (SELECT lang, word, {after} FROM words WHERE word <> '' WINDOW w AS (PARTITION BY id ORDER BY place)),
grams AS ({grams}),
counts AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, phrase),
totals AS (SELECT lang, count(*) AS n FROM runs GROUP BY lang),
phrases AS (SELECT *, string_split(phrase, ' ') AS words FROM counts WHERE k > 1 AND f >= {SUPPORT}),
inner_parts AS (SELECT p.lang, array_to_string(p.words[s.start:s.start + z.size - 1], ' ') AS phrase, max(p.f) AS longer
  FROM phrases p, (SELECT unnest(range(2, {LONGEST})) AS size) z, (SELECT unnest(range(1, {LONGEST})) AS start) s
  WHERE z.size < p.k AND s.start + z.size - 1 <= p.k GROUP BY ALL),
kept AS (SELECT p.* FROM phrases p LEFT JOIN inner_parts i USING (lang, phrase)
  WHERE i.longer IS NULL OR 100 * i.longer::HUGEINT < {CONTAINED} * p.f::HUGEINT),
cuts AS (SELECT p.lang, p.phrase, p.f AS a, c.cut, x.f AS l, y.f AS r, ({SCALE}::HUGEINT * p.f) // (x.f + y.f) AS score
  FROM kept p, (SELECT unnest(range(1, {LONGEST})) AS cut) c, counts x, counts y
  WHERE c.cut < p.k AND x.lang = p.lang AND x.phrase = array_to_string(p.words[1:c.cut], ' ')
    AND y.lang = p.lang AND y.phrase = array_to_string(p.words[c.cut + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}"""
