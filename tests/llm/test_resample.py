"""Resampling against a plain count of features, drawn sets, ties and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from talweg.llm import resample

DOCS = "doc_id long, text string, n_words int, bucket int, n int, score int, rank int, row int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def table(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, 6) for i, t in zip(ids or range(len(texts)), texts)], DOCS)


def features(text, low, high):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, Counter(" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1))


def brute(docs, target, low=1, high=1, buckets=10_000, seed=2024, least_words=20, percent=10):
    def histogram(texts):
        out = Counter()
        for t in texts:
            for f, n in features(t, low, high)[1].items():
                out[zlib.crc32(f.encode()) % buckets] += n
        return out

    s, t = histogram(x for _, x in docs), histogram(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    rows = []
    for doc, text in docs:
        words, counts = features(text, low, high)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] * n for f, n in counts.items())
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append((doc, len(words), counts.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], -1 if r[0] is None else r[0]))
    ranks = {id(r): i for i, r in enumerate(able[: len(able) * percent // 100], 1)}
    return sorted(((*r, ranks.get(id(r))) for r in rows), key=repr)


def texts_of(rng, count):
    pick = ["Apple", "pear", "Ünï", "x9", "日本", "zeta,", "\nwar--time", "Straße"]
    return [rng.choice([" ", "  ", "\t"]).join(rng.choice(pick) for _ in range(rng.randrange(60))) for _ in range(count)]


@pytest.mark.parametrize("settings", [{}, {"low": 1, "high": 3, "buckets": 50, "percent": 35}, {"low": 2, "high": 2, "least_words": 5, "percent": 100, "seed": 7}])
def test_equals_a_plain_count(spark, settings):
    rng = random.Random(5)
    texts = [*texts_of(rng, 150), None, "", "...", "İI K"]
    target = [*texts_of(rng, 5), None, ""]
    got = resample.draw(table(spark, texts), table(spark, target), **settings).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(enumerate(texts)), target, **settings)


def test_ties_repeats_and_null_ids(spark):
    texts, ids = ["one two"] * 40, [3, 3, None, None, *[5] * 36]
    rows = resample.draw(table(spark, texts, ids), table(spark, ["one"]), least_words=2, percent=50).collect()
    drawn = sorted((r.rank, r.score) for r in rows if r.rank is not None)
    assert [r for r, _ in drawn] == list(range(1, 21))
    assert [s for _, s in drawn] == sorted((r.score for r in rows), reverse=True)[:20]
    assert len(rows) == 40


def test_empty_tables(spark):
    assert resample.draw(table(spark, []), table(spark, ["a"])).count() == 0
    rows = resample.draw(table(spark, ["a b"] * 3), table(spark, []), least_words=1, percent=100).collect()
    assert sorted(r.rank for r in rows) == [1, 2, 3]
    with pytest.raises(ValueError):
        resample.draw(table(spark, ["a"]), table(spark, ["a"]), low=0)


def test_runs_by_slices_and_by_joins_agree():
    words = resample.Words()
    data = "a b  c,d é日 e ".encode()
    assert words.offsets(data) == [(0, 1), (2, 3), (5, 6), (7, 8), (9, 14), (15, 16)]
    size, counts = words.features(data, 2, 3)
    assert size == 6
    assert set(counts) == {x.encode() for x in ("a b", "b c", "c d", "d é日", "é日 e", "a b c", "b c d", "c d é日", "d é日 e")}
