"""The pipeline against a plain Python version of its stages."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from quire.llm import mixing, quality, substring_dedup as sd
from quire.llm.queries import ORACLES, QUERIES
from tests.llm.test_jaccard_join import brute
from tests.llm.test_mixing import earliest_deadline_first
from tests.llm.test_substring_dedup import slow_units

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert list(entry.queries())[-1] == "pipeline"
    assert len(corpus_pipeline.STAGES) == 5
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def plain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r.doc_id: r.asDict() for r in docs.collect()}
    # 4: the same model, applied text by text
    model = quality.train(*quality.training_bags(docs, labels, "doc_id", "text", "quality", quality.TRAIN_ROWS))
    rows = {k: r for k, r in rows.items() if quality.score(model, [r["text"].encode()])[0] >= 0.3}
    # 9: all pairs
    data = [(k, r["text"]) for k, r in sorted(rows.items())]
    _, lowest, _ = brute(data)
    rows = {k: rows[k] for i, (k, _) in enumerate(data) if lowest[i] == k}
    # 1: chunks in a row, in order of ids
    seen: set = set()
    for k in sorted(rows):
        text = rows[k]["text"]
        (border, digest), = sd.chunks([text])
        again = [i for d, i in slow_units(digest.tolist(), border.tolist()) if d in seen or seen.add(d)]
        if again:
            rows[k]["text"] = sd.without(text, sd.repeated_spans(text, border, np.array(again)))
    # 3: earliest deadline first, source by source in order of salts
    total = Counter(r["source"] for r in rows.values())
    weight = {s: n**0.5 for s, n in total.items()}
    share = {s: round(mixing.SLOTS * w / sum(weight.values()), 6) for s, w in weight.items()}
    quota = {s: max(1, int(x)) for s, x in share.items()}
    for s in sorted(share, key=lambda s: (-(share[s] % 1), s))[:mixing.SLOTS - sum(quota.values())]:
        quota[s] += 1
    order = earliest_deadline_first(quota)
    md5 = lambda x: hashlib.md5(str(x).encode()).hexdigest()[:mixing.SALT_DIGITS]
    queues = {s: sorted((k for k in rows if rows[k]["source"] == s), key=lambda k: (md5(k), k)) for s in total}
    mixed = []
    while any(queues.values()):
        for s in order:
            mixed += queues[s][:mixing.BLOCK_ROWS]
            del queues[s][:mixing.BLOCK_ROWS]
    # 8: the library
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out = []
    for k in mixed:
        ids = library.encode(rows[k]["text"], add_special_tokens=False).ids
        digest = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        out.append((k, rows[k]["lang"], rows[k]["source"], len(ids), ids, digest))
    return out


def test_against_plain_python(spark):
    expected = plain(spark)
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).collect()]
    assert 0 < len(expected) < 200
    assert sorted(got) == sorted(expected)
    assert [r[0] for r in got] == [r[0] for r in expected]  # also in the order of the mix


def test_tokens_keep_the_mix_of_several_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    data = [(i, "en", f"s{i % 3}", " ".join(["word"] * int(rng.integers(1, 60)) * (1 + i // 40))) for i in range(240)]
    order = rng.permutation(240).tolist()
    docs = spark.createDataFrame([(*data[i], k) for k, i in enumerate(order)],
                                 "doc_id long, lang string, source string, text string, at int")
    # files that grow: Spark reads the largest first
    docs.repartitionByRange(6, "at").sortWithinPartitions("at").drop("at").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    assert len(docs.inputFiles()) > 1
    expected = [data[i][0] for i in order]
    result = corpus_pipeline.tokens(spark, docs, SF)
    assert [r.doc_id for r in result.collect()] == expected
    # and in the order of the names of the files that are written
    result.write.parquet(f"{tmp_path}/out")
    written = [r.doc_id for f in sorted((tmp_path / "out").glob("part-*")) for r in spark.read.parquet(str(f)).collect()]
    assert written == expected
