"""The pipeline's stages: what they keep, and that it takes effect."""

import corpus_pipeline as pipeline

from docloom.llm import pii
from docloom.llm.storage import keep
from tests.llm.conftest import BYTE_BPE
from tests.llm.test_dedup import brute_force, squeezed
from tests.llm.test_tokens import by_library, check_packing

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, sample):
    docs, rows = sample, [tuple(r) for r in sample.collect()]
    for name, stage in pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, SF), name)
        assert docs.columns == sample.columns
        got = sorted(tuple(r) for r in docs.collect())
        if name == "language":
            expected = rows
        elif name == "exact_dedup":
            best = {}
            for r in sorted(rows, key=lambda r: (-len(r[1]), r[0])):
                best.setdefault(squeezed(r[1]), r)
            expected = list(best.values())
        elif name == "near_dedup":
            classes = brute_force([r[:2] for r in sorted(rows)])
            expected = [r for r in rows if classes[r[0]][0] == r[0]]
        else:
            expected = []
            for r in rows:
                base, more = pii.spans_of(r[1])
                text = pii.redacted(r[1], base + more)
                expected.append((r[0], text, r[2], r[3], len(text)))
            assert expected != rows
        rows = sorted(expected)
        assert got == rows, name
    packed = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    ids = by_library(BYTE_BPE, [r[1] for r in rows])
    check_packing(packed, {r[0]: x + [2] for r, x in zip(rows, ids)}, 1024)
    whole = pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length"]
    assert sorted(tuple(r) for r in whole.select(*key).collect()) == sorted(tuple(r[k] for k in key) for r in packed)


def test_stages_on_awkward_and_empty_tables(spark, awkward):
    for name, stage in pipeline.STAGES:
        out = stage(spark, awkward, SF)
        if name != "packing":
            assert out.columns == awkward.columns
        assert out.count() > 0
        assert stage(spark, awkward.limit(0), SF).count() == 0
