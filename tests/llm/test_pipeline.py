"""Every stage of the corpus pipeline against a brute-force version on its own input."""

import numpy as np
import pytest
from test_llm import brute_components, brute_lines

import corpus_pipeline
from talweg.llm import decontaminate, packing, quality
from talweg.llm.common import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, function in corpus_pipeline.STAGES:
        done = stage(function(spark, docs, SF))
        out.append((docs, done))
        docs = done
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_keep_the_columns(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns
    assert 0 < steps[-1][0].count() < steps[0][0].count()


def test_quality_stage(spark, steps):
    before, after = steps[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(quality.describe(before), labels)
    want = {i for i, t in texts(before).items() if model.score(np.array([quality.statistics((t or "").encode())]))[0] >= 0.3}
    assert set(texts(after)) == want


def test_line_stage(steps):
    before, after = texts(steps[1][0]), texts(steps[1][1])
    want = {i: t for (i, old), t in brute_lines(list(before.items())).items() if t or t == old}
    assert after == want


def test_near_duplicate_stage(steps):
    before, after = texts(steps[2][0]), texts(steps[2][1])
    ids = sorted(before)
    groups = brute_components([before[i] for i in ids], 5, 80)
    assert sorted(after) == [ids[i] for i, _, c in groups if i == c]


def test_decontamination_stage(spark, steps):
    import re

    def words(t):
        return [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in t or "")) if w]

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k : k + decontaminate.WINDOW]) for k in range(max(1, len(w) - decontaminate.WINDOW + 1)) if w}
    sizes = {len(w) for w in windows}
    before, after = texts(steps[3][0]), texts(steps[3][1])

    def hit(t):
        w = words(t)
        return any(tuple(w[k : k + n]) in windows for n in sizes for k in range(len(w) - n + 1))

    assert set(after) == {i for i, t in before.items() if not hit(t)}


def test_packing_stage(steps):
    before, after = texts(steps[4][0]), steps[4][1].collect()
    encoder = packing._encoder(*packing._paths())
    total = {i: len(encoder.encode(t or "")) // 4 + 1 for i, t in before.items()}
    got = {}
    for r in after:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == total
    bins = {}
    for r in after:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([s for _, s in own[:-1]]).tolist()] and sum(s for _, s in own) <= 1024
    assert len(bins) <= packing.lower_bound(np.bincount([r.length for r in after], minlength=1025)) + 2


def test_run_equals_the_stages(spark, steps):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = corpus_pipeline.run(spark, SF).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, steps[-1][1].select(*columns).collect()))
