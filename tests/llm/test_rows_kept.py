"""Rows and columns that the stages of the pipeline must keep, whatever their names and ids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import prose

from talweg.llm import decontaminate, jaccard, linededup, quality, topk, warc
from talweg.llm.common import staging_folder

CLASH = {c: f"keep {c}" for c in ("__starts", "__doc", "__lines", "__body", "__row", "__covered", "doc", "row", "stats", "key", "all", "gone", "n_lines")}


def clashing(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs.select(*[F.lit(v).alias(c) for c, v in CLASH.items()], "doc_id", "text")


def unharmed(df, but=()):
    rows = df.collect()
    for r in rows:
        assert {c: r[c] for c in CLASH if c not in but} == {c: v for c, v in CLASH.items() if c not in but}
    return sorted(((r.doc_id, r.text) for r in rows), key=repr)


def test_clashing_columns_stay(spark):
    rng = random.Random(3)
    block = "\n".join(prose(rng, 8) for _ in range(4))
    rows = [(1, block), (2, block + "\nmore"), (3, None), (4, "")]
    assert unharmed(linededup.dedup_lines(clashing(spark, rows)), but=("n_lines",)) == [(1, block), (2, "more"), (3, None), (4, "")]
    bench = spark.createDataFrame([("x", block)], "item_id string, text string")
    assert unharmed(decontaminate.drop_contaminated(clashing(spark, rows), bench)) == [(3, None), (4, "")]
    assert unharmed(jaccard.keep_one_of_each(clashing(spark, rows), 5, 80)) == [(1, block), (3, None), (4, "")]
    twice = [*rows, (1, "another text of a used id")]
    assert unharmed(jaccard.keep_one_of_each(clashing(spark, twice), 5, 80)) == [(1, "another text of a used id"), (1, block), (3, None), (4, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, quality int")
    assert unharmed(quality.keep_good(clashing(spark, rows), labels, threshold=0.0)) == sorted(rows, key=repr)


def test_near_duplicates_by_id_and_text(spark):
    rng = random.Random(5)
    one, other = prose(rng, 200), prose(rng, 200)
    near = one + " w1"
    rows = [(3, one), (7, other), (7, near), (None, near), (9, other), (9, other), (None, None), (8, "")]
    got = sorted(jaccard.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect(), key=repr)
    # The null id comes first, so its text stands for the texts like it; the other text of id 7 is the first of its own group.
    assert [tuple(r) for r in got] == sorted([(None, near), (7, other), (None, None), (8, "")], key=repr)


def test_many_archives_are_read_in_many_tasks(spark):
    rng = random.Random(9)
    pages = spark.createDataFrame([(i, f"http://a/{i}", prose(rng, 60)) for i in range(600)], "page_id long, url string, html string").repartition(200, "page_id")
    folder = f"{staging_folder(spark)}-archives"
    manifest = warc.write_archives(warc.revisits(pages, 1000), folder, archive_bytes=1000)
    records = warc.read_archives(manifest, folder)
    assert manifest.count() >= 200
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= manifest.count() // 2
    assert records.count() == 600


def dense_scores(x, y, calibrates, model):
    """Ridge by the dense normal equations and calibration by plain pooling, on the features of the model."""
    z = model.features(x)
    fitted, spare = ~calibrates, calibrates
    penalty = np.full(z.shape[1], quality.PENALTY * max(len(y), 100))
    penalty[-1] = 1e-9
    weights = np.linalg.solve(z[fitted].T @ z[fitted] + np.diag(penalty), z[fitted].T @ y[fitted])
    steps = np.round(np.clip(z[spare] @ weights, -1, 2) * quality.STEPS)
    at, level = [], []
    for step in np.unique(steps):
        at.append(step / quality.STEPS)
        level.append(y[spare][steps == step])
    sizes = np.array([len(v) for v in level], float)
    fit = np.array([v.mean() for v in level])
    # The isotonic fit by its max-min formula.
    total, weight = np.concatenate([[0], np.cumsum(fit * sizes)]), np.concatenate([[0], np.cumsum(sizes)])
    n = len(at)
    means = np.array([[(total[j + 1] - total[i]) / (weight[j + 1] - weight[i]) if j >= i else np.nan for j in range(n)] for i in range(n)])
    iso = np.array([max(np.nanmin(means[i, k:]) for i in range(k + 1)) for k in range(n)])
    return weights, np.array(at), iso, sizes


def test_model_equals_dense_equations_and_isotonic_formula(spark):
    rng = random.Random(11)
    texts = [prose(rng, 50 + rng.randrange(200), 30 if i % 3 else 2000) + ("!!! $$$ " * 20 if i % 3 else "") for i in range(260)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    truth = {i: float((i % 3 == 0) ^ (rng.random() < 0.15)) for i in range(260)}
    labels = spark.createDataFrame([(i, int(v)) for i, v in truth.items()], "doc_id long, quality int")
    model = quality.fit(quality.describe(docs), labels)
    folds = {r.doc_id: r.f for r in docs.select("doc_id", quality._fold().alias("f")).collect()}
    used = [i for i in range(260) if folds[i] % 5]
    x = np.array([quality.statistics(texts[i].encode()) for i in used])
    y = np.array([truth[i] for i in used])
    calibrates = np.array([(folds[i] // 5) % 4 == 0 for i in used])
    weights, at, iso, sizes = dense_scores(x, y, calibrates, model)
    assert model.weights == pytest.approx(weights, rel=1e-6, abs=1e-9)
    # Pooled blocks stand at the mean of their members and have the isotonic level.
    blocks = [np.isclose(iso, v) for v in np.unique(np.round(iso, 12))]
    assert model.level == pytest.approx([iso[b][0] for b in blocks])
    assert model.at == pytest.approx([np.average(at[b], weights=sizes[b]) for b in blocks])


def test_huge_components_count_as_the_largest(spark):
    vectors = [[1.0, 2.0], [1e300, 1.0], [-1e300, 5.0], [3.0, 3.0]]
    rows = spark.createDataFrame([(20 * i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    most = int((2.0**53 / 2) ** 0.5)
    whole = [[max(-most, min(most, int(64 * x // 1))) for x in v] for v in vectors]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(rows, k=3).collect()}
    for q in range(4):
        want = sorted(((-sum(a * b for a, b in zip(whole[q], whole[c])), 20 * c) for c in range(4) if c != q))
        assert [got[20 * q, rank] for rank in (1, 2, 3)] == [(c, -s) for s, c in want]
