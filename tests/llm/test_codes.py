"""Vector codes against plain nearest entries in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from talweg.llm import codes

ROWS = "vec_id long, label int, embedding array<double>, code int, error int, _key int, n int"


def table(spark, vectors, ids=None, labels=None):
    ids, labels = ids or range(len(vectors)), labels or [i % 3 for i in range(len(vectors))]
    return spark.createDataFrame([(i, c, v, 1, 2, 3, 4) for i, c, v in zip(ids, labels, vectors)], ROWS)


def brute(rows, parts, entries, rounds):
    """rows: (vec_id, label, vector), all of one length; gives what the operator returns."""
    def floor(x):
        return math.floor(x * 256) if abs(x) < 2.0**40 else int(x) * 256

    width = -(-len(rows[0][2]) // parts)
    whole = [[floor(x) for x in v] + [0] * (parts * width - len(v)) for _, _, v in rows]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2]))[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(c[p], books[p])[1] for c in cut]
            for k in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own) if o == k]
                if mine:
                    books[p][k] = [sum(column) // len(mine) for column in zip(*mine)]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    dim = len(rows[0][2])
    sha = hashlib.sha256(
        ",".join(str(x) for p, b in enumerate(books) for e in b for i, x in enumerate(e) if p * width + i < dim).encode()
    ).hexdigest()
    error = [sum(d for d, _ in f) for f in found]
    most, out = (1 << 63) - 1, []
    for (vec, label, _), f, e in zip(rows, found, error):
        total = sum(min(x, most) for x, r in zip(error, rows) if r[1] == label)
        out.append((vec, "".join(f"{k:02x}" for _, k in f), min(e, most), min(total, most), sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts, entries, rounds, dim", [(4, 8, 2, 12), (3, 64, 1, 10), (2, 5, 3, 2), (16, 7, 0, 5)])
def test_equals_plain_nearest_entries(spark, parts, entries, rounds, dim):
    rng = random.Random(dim)
    vectors = [[rng.gauss(0, 0.2) for _ in range(dim)] for _ in range(90)]
    vectors += vectors[:20] + [[0.0] * dim] * 10 + [[round(x, 1) for x in v] for v in vectors[:20]]
    labels = [None if i % 4 == 0 else i % 3 for i in range(len(vectors))]
    got = codes.compress(table(spark, vectors, labels=labels), parts, entries, rounds).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(zip(range(len(vectors)), labels, vectors)), parts, entries, rounds)


def test_huge_components_stay_exact(spark):
    rng = random.Random(4)
    vectors = [[rng.choice([1e300, -1e300, 1.7e308, 3e17, 0.1, -5e9]) for _ in range(4)] for _ in range(30)] + [[0.1, 0.2, 0.3, 0.4]] * 5
    got = codes.compress(table(spark, vectors), 2, 4, 2).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(zip(range(35), [i % 3 for i in range(35)], vectors)), 2, 4, 2)


def test_rows_that_take_no_part(spark):
    good = [[0.5, -0.25], [0.1, 0.9], [0.3, 0.3]]
    odd = [None, [], [None, 1.0], [float("nan"), 0.0], [float("inf"), 0.0], [0.5], [0.1, 0.2, 0.3]]
    ids = [4, 4, None, *range(10, 17)]
    got = codes.compress(table(spark, good + odd, ids), 2, 4, 2).collect()
    assert sorted(map(tuple, got), key=repr) == brute(list(zip(ids[:3], [0, 1, 2], good)), 2, 4, 2)
    assert codes.compress(table(spark, odd[:2])).count() == 0
    assert codes.compress(table(spark, [])).count() == 0
    assert codes.compress(table(spark, good).drop("label"), 2, 1, 1).filter("label_error > 0").count() == 3


def test_cells_keep_every_possible_nearest_entry():
    rng = np.random.default_rng(3)
    for spread in (2, 30, 400):
        book = codes.Codebook(rng.integers(-spread, spread, (40, 3)))
        points = rng.integers(-2 * spread, 2 * spread, (3000, 3))
        code, distance = book.nearest(points)
        plain = ((points[:, None, :] - book.entries) ** 2).sum(axis=2)
        assert (code == plain.argmin(axis=1)).all()
        assert (distance == plain.min(axis=1)).all()
        assert spread < 30 or book.count.mean() < 30  # most entries are never evaluated


def test_memory_of_cells_is_bounded(monkeypatch):
    monkeypatch.setattr(codes, "MEMO", 50)
    rng = np.random.default_rng(1)
    book = codes.Codebook(rng.integers(-100, 100, (9, 2)))
    for _ in range(20):
        points = rng.integers(-150, 150, (40, 2))
        code, _ = book.nearest(points)
        assert (code == ((points[:, None, :] - book.entries) ** 2).sum(axis=2).argmin(axis=1)).all()
        assert len(book.memo) <= 50
