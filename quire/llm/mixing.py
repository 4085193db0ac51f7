"""Operator 3 (native): mixing sources to target weights by Pfair scheduling.

Every source is a task whose weight is its share of the mix, every block of its rows a subtask.
In a period of P slots a source of q slots has weight q / P, and its k-th block may not run before
slot floor((k - 1) P / q) (release) and must have run by slot ceil(k P / q) (deadline). Each slot
takes, among the released blocks, the one of earliest deadline (ties: smaller source name). So at
every slot, until a source runs out, each source has had q / P of the slots to within less than one block.
That is the rounded share: from the exact weight it departs by up to a slot in each period (more where a
smaller weight gets its least slot), and this adds up over the periods.

The schedule of one period is a fold over its slots; all later periods repeat it, so the slot of
block b of a source is a closed form: ``(b div q) * P + slots[b mod q]``. No row is dropped: when
a source has run out its slots stay empty and the others go on.

Scale: rows are numbered inside (source, salt) groups, 4096 salts a source, and shifted by the
counts of the salts before, so a source with a third of all rows is spread over 4096 groups. The
schedule depends on the number of sources only, taken to be the size of a configuration.

Defined results: a null source is a source of its own, null texts and keys are ordinary values,
rows equal in key and text are interchangeable, an empty table gives an empty one. Columns named
like the three results are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOTS = 1000  # slots of a period: weights are met to within one in so many
BLOCK_ROWS = 8
SALT_DIGITS = 3  # hexadecimal: 4096 salts a source

_RESULTS = ("mix_block", "mix_slot", "mix_position")


def target_slots(totals: DataFrame, weights: dict | None = None, slots: int = SLOTS) -> DataFrame:
    """``(src, q)``: the slots of each source in a period, by largest remainders, at least one.

    Without ``weights`` a source weighs the square root of its rows, which flattens the mix.
    Sources that ``weights`` does not name get one slot.
    """
    if weights is None:
        weight = F.sqrt(F.col("n").cast("double"))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            named = F.lit("n") if name is None else F.concat(F.lit("s"), F.lit(name))
            weight = F.when(F.col("src") == named, F.lit(float(value))).otherwise(weight)
    everything = W.partitionBy(F.lit(0))
    share = totals.select("src", weight.alias("w")).select(
        "src", F.round(F.lit(float(slots)) * F.col("w") / F.sum("w").over(everything), 6).alias("x"))
    share = share.select("src", "x", F.greatest(F.lit(1), F.floor("x")).cast("long").alias("base"))
    by_rest = W.partitionBy(F.lit(0)).orderBy(F.desc(F.col("x") - F.floor("x")), "src")
    return share.select(
        "src", (F.col("base") + F.when(
            F.row_number().over(by_rest) <= slots - F.sum("base").over(everything), 1)
            .otherwise(0)).alias("q"))


def period(quotas: DataFrame) -> DataFrame:
    """``(src, q, p, slots)``: the slots that each source gets in a period, earliest deadline first."""
    one = quotas.agg(F.array_sort(F.collect_list(F.struct("src", "q"))).alias("s")).select(
        "s", F.size("s").alias("n"), F.expr("aggregate(s, 0L, (a, x) -> a + x.q)").alias("p"))
    # state: blocks scheduled of each source, and the source of every slot so far
    fold = F.expr("""
      aggregate(
        sequence(0L, p - 1),
        named_struct('done', transform(s, x -> 0L), 'order', cast(array() as array<int>)),
        (state, t) -> transform(array(array_min(transform(state.done, (c, i) ->
            if(c < s[i].q and c * p div s[i].q <= t,
               ((c + 1) * p + s[i].q - 1) div s[i].q * n + i,
               9223372036854775807L)))), best -> named_struct(
          'done', transform(state.done, (c, i) -> if(i = best % n, c + 1, c)),
          'order', array_append(state.order, cast(best % n as int))))[0],
        state -> state.order)""")
    return one.filter("n > 0").select("s", "p", fold.alias("ran")).select(
        "p", "ran", F.posexplode("s").alias("i", "x")).select(
        F.col("x.src").alias("src"), F.col("x.q").alias("q"), "p",
        F.expr("filter(transform(ran, (r, t) -> if(r = i, cast(t as long), -1L)), t -> t >= 0)")
        .alias("slots"))


def mix_sources(docs: DataFrame, weights: dict | None = None, key: str = "doc_id",
                source: str = "source", text: str = "text", slots: int = SLOTS,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with ``mix_block`` (block of the row in its source), ``mix_slot`` (slot of the
    block, over all periods) and ``mix_position`` (order of the row in the mix), all long."""
    tagged = docs.drop(*_RESULTS).withColumns({
        "__src": F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")),
        "__salt": F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, SALT_DIGITS),
    })
    counts = tagged.groupBy(F.col("__src").alias("src"), F.col("__salt").alias("salt")).agg(
        F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("src").agg(F.sum("n").alias("n"))
    plan = period(target_slots(totals, weights, slots))
    before = W.partitionBy("src").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    shifted = counts.select("src", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__shift"))
    lookup = shifted.join(plan, "src").select(
        F.col("src").alias("__src"), F.col("salt").alias("__salt"), "__shift",
        F.col("q").alias("__q"), F.col("p").alias("__p"), F.col("slots").alias("__slots"))
    inside = W.partitionBy("__src", "__salt").orderBy(
        F.col(key), F.md5(F.coalesce(F.col(text), F.lit(""))))
    numbered = tagged.withColumn("__row", F.row_number().over(inside) - 1).join(
        lookup, ["__src", "__salt"])
    row = F.col("__row") + F.col("__shift")
    placed = numbered.withColumn("mix_block", F.expr(f"(__row + __shift) div {block_rows}"))
    placed = placed.withColumn(
        "mix_slot", F.expr("mix_block div __q * __p + __slots[cast(mix_block % __q as int)]"))
    placed = placed.withColumn("mix_position", F.col("mix_slot") * block_rows + row % block_rows)
    return placed.select(*[F.col(c) for c in docs.columns if c not in _RESULTS], *_RESULTS)


def oracle(slots: int = SLOTS, block_rows: int = BLOCK_ROWS) -> str:
    """DuckDB SQL of the same mix (square-root weights) over ``documents``."""
    return f"""
WITH RECURSIVE tagged AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS src, md5(coalesce(text, '')) AS h,
    substr(md5(coalesce(cast(doc_id AS varchar), '')), 1, {SALT_DIGITS}) AS salt FROM documents),
totals AS (SELECT src, count(*) AS n FROM tagged GROUP BY src),
share AS (SELECT src, round({slots}.0::double * sqrt(n::double) / sum(sqrt(n::double)) OVER (), 6) AS x FROM totals),
base AS (SELECT src, x, greatest(1, floor(x))::bigint AS b FROM share),
quota AS (SELECT src, b + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, src)
    <= {slots} - sum(b) OVER () THEN 1 ELSE 0 END AS q FROM base),
conf AS (SELECT list(src ORDER BY src) AS srcs, list(q ORDER BY src) AS qs, count(*) AS n, sum(q)::bigint AS p FROM quota),
edf AS (
  SELECT -1::bigint AS t, -1::bigint AS ran, list_transform(qs, lambda x: 0::bigint) AS done FROM conf
  UNION ALL
  SELECT t, best % n, list_transform(done, lambda c, i: CASE WHEN i - 1 = best % n THEN c + 1 ELSE c END)
  FROM (SELECT t + 1 AS t, done, n, list_min(list_transform(done, lambda c, i:
      CASE WHEN c < qs[i] AND c * p // qs[i] <= t + 1
        THEN ((c + 1) * p + qs[i] - 1) // qs[i] * n + i - 1 END))::bigint AS best
    FROM edf, conf WHERE t + 1 < p)),
plan AS (SELECT srcs[ran + 1] AS src, t, row_number() OVER (PARTITION BY ran ORDER BY t) - 1 AS k FROM edf, conf WHERE t >= 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY salt, doc_id NULLS FIRST, h) - 1 AS r FROM tagged)
SELECT doc_id, source, r // {block_rows} AS mix_block,
  r // {block_rows} // q * p + t AS mix_slot,
  (r // {block_rows} // q * p + t) * {block_rows} + r % {block_rows} AS mix_position
FROM numbered JOIN quota USING (src) JOIN plan USING (src), conf
WHERE k = r // {block_rows} % q
"""
