"""Operator 3: the earliest-deadline schedule, its bound, and edge rows."""

import heapq
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from quire.llm import mixing

SCHEMA = "doc_id long, text string, source string, mix_slot string"


def earliest_deadline_first(quotas):
    """Slots of one period by a plain simulation with a heap."""
    total = sum(quotas.values())
    jobs = sorted((((k - 1) * total // q), -(-k * total // q), s)
                  for s, q in quotas.items() for k in range(1, q + 1))
    ready, order, at = [], [], 0
    for t in range(total):
        while at < len(jobs) and jobs[at][0] <= t:
            heapq.heappush(ready, jobs[at][1:])
            at += 1
        order.append(heapq.heappop(ready)[1])
    return order


@pytest.mark.parametrize("quotas", [{"sa": 1}, {"sa": 3, "sb": 4, "sc": 13}, {"n": 1, "sa": 1, "sb": 98},
                                    {f"s{i:02}": 1 + i % 7 for i in range(30)}])
def test_period_is_edf_and_within_a_block(spark, quotas):
    rows = mixing.period(spark.createDataFrame(list(quotas.items()), "src string, q long")).collect()
    got = {t: r.src for r in rows for t in r.slots}
    total = sum(quotas.values())
    order = [got[t] for t in range(total)]
    assert order == earliest_deadline_first(quotas)
    seen = Counter()
    for t, s in enumerate(order, 1):
        seen[s] += 1
        for name, q in quotas.items():
            assert abs(seen[name] - Fraction(q * t, total)) < 1


def test_every_row_once_and_shares_hold(rows):
    data = [(i, f"t{i}", "big" if i % 3 else f"s{i % 5}", "x") for i in range(600)]
    data += [(None, None, None, "x"), (7, "", None, "x"), (7, "", None, "x"), (1, "t1", "big", "x")]
    docs = rows(data, SCHEMA)
    out = mixing.mix_sources(docs, {"big": 2, "s0": 1, "s1": 1, None: 1}, slots=50, block_rows=4).collect()
    assert Counter((r.doc_id, r.text, r.source) for r in out) == Counter(d[:3] for d in data)
    positions = [r.mix_position for r in out]
    assert len(set(positions)) == len(data)
    per_block = defaultdict(list)
    for r in out:
        assert r.mix_position // 4 == r.mix_slot
        per_block[r.source, r.mix_block].append(r)
    for (source, block), members in per_block.items():
        assert len({r.mix_slot for r in members}) == 1
    total = Counter(d[2] for d in data)
    for source, n in total.items():
        assert sorted(b for s, b in per_block if s == source) == list(range(-(-n // 4)))
    # ids are hashed to salts, so the order inside a source does not depend on partitions
    again = mixing.mix_sources(docs.coalesce(1), {"big": 2, "s0": 1, "s1": 1, None: 1}, slots=50,
                               block_rows=4).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.text, str(r.source), r.mix_position)
    assert sorted(map(key, out), key=str) == sorted(map(key, again), key=str)


def test_empty(rows):
    assert mixing.mix_sources(rows([], SCHEMA)).collect() == []


def test_plan_has_no_python(rows):
    plan = mixing.mix_sources(rows([(1, "a", "b", "c")], SCHEMA).coalesce(1))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
