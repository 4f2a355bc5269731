"""The corpus pipeline against its stages by brute force, on the driver's small documents."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scorekit.llm.common import shared_table

from ..conftest import SF_SMALL
from . import test_decontam, test_mixing, test_quality, test_simhash


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(shared_table(stage(spark, out[-1], SF_SMALL)))
    return [(df.columns, df.collect()) for df in out]


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination",
                                                      "mixing sources to target weights"]


def test_each_stage_by_hand(spark, stages):
    rows = [x for _, x in stages]
    assert all(c == stages[0][0] for c, _ in stages[:-1]) and stages[-1][0][:len(stages[0][0])] == stages[0][0]
    ids = [sorted(r.doc_id for r in x) for x in rows]
    assert ids[1] == sorted(r.doc_id for r in rows[0] if test_quality.by_hand(r.text)[-1])
    groups = test_simhash.components_by_hand([(r.doc_id, test_simhash.fp_by_hand(r.text)) for r in rows[1]])
    assert ids[2] == sorted({c for _, _, c in groups}) and len(ids[2]) < len(ids[1])

    seen, want = set(), {}
    for r in sorted(rows[2], key=lambda r: r.doc_id):
        b, gone = r.text.encode(), set()
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                gone.update(range(i, i + 100))
            seen.add(b[i:i + 100])
        left = bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")
        if left or not b:
            want[r.doc_id] = left
    assert {r.doc_id: r.text for r in rows[3]} == want and all(r.n_chars == len(r.text) for r in rows[3])

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    short = [(r.doc_id, r.text) for r in rows[3] if len(r.text) < 1500]
    bad = {int(d) for d, *_ in test_decontam.by_rule(short, bench)}
    assert {d for d, _ in short} - bad == {r.doc_id for r in rows[4]} & {d for d, _ in short}

    mix = [(r.doc_id, r.text, r.source) for r in rows[4]]
    target, words = test_mixing.targets_by_hand(mix)
    taken = defaultdict(int)
    for r in rows[5]:
        assert 1 <= r.mix_copies <= 3 and r.mix_size == test_mixing.n_words(r.text)
        taken[r.source] += r.mix_copies * r.mix_size
    for s in words:
        assert abs(taken[s] - target[s]) <= 0.05 * words[s]


def test_run_is_the_stages_in_turn(spark, stages):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == stages[-1][0]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, stages[-1][1]))


def test_stages_on_odd_rows(spark):
    text = "some words that stand in a row and make more than ten of them, clean enough"
    rows = [(1, text, "en", None, 5), (1, text, "en", None, 5), (None, text + " twice", None, "a", None), (3, None, None, None, None), (4, "", "", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        clash = ["id", "rank", "copies", "_id", "_hash", "_Bad", "_size", "_source", "_found", "_kept", "_sha", "_fate", "_least_id", "_n_spans", "row", "sha",
                 "fate", "found", "left", "kept", "n.spans", "least_id", "n_spans", "root", "fp"]
        for d in (docs, docs.limit(0), docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(clash)])):
            out = stage(spark, d, SF_SMALL)
            assert out.columns[:len(d.columns)] == d.columns, name
            assert out.count() <= d.count()
            if len(d.columns) > len(docs.columns):
                assert {tuple(r)[len(docs.columns):len(d.columns)] for r in out.collect()} <= {tuple(range(len(clash)))}


def test_an_earlier_mix_is_replaced(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 9, "x"), (2, "d e", "t", 9, "y")], "doc_id long, text string, source string, mix_size long, mix_copies string")
    out = corpus_pipeline.mix_sources(spark, docs, SF_SMALL)
    assert out.columns == ["doc_id", "text", "source", "mix_size", "mix_rate", "mix_copies"] and {r.mix_size for r in out.collect()} <= {3, 2}
