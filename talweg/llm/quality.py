"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Statistics of the whole text are standardised and mapped to cosines of random projections, whose inner
products approximate a Gaussian kernel. Each partition sums its part of the normal equations; the
sums are added by matrix row. The ridge scores of labelled rows that the fit has not seen are then
calibrated by pooling adjacent violators over a fixed grid of scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import byte_rows, ready, stage, table

#: Number of random features, ridge penalty per row, seed, score steps of the calibration, and rows that the penalty counts at least.
FEATURES, PENALTY, SEED, STEPS = 192, 1e-3, 20, 1024
THRESHOLD = 0.3
STATISTICS = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_sd", "upper", "digit", "space", "comma_stop", "mark", "symbol",
    "wide", "control", "distinct_words", "top_word", "short_words", "upper_words", "marked_words", "echoed_words", "repeated_threes",
    "log_lines", "repeated_lines", "line_words", "deflated",
)

# Classes of bytes: upper, lower, digit, space, comma or full stop, other prose mark, symbol, part of a wide character, control.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[:32] = _CLASS[127] = 8
_CLASS[list(b" \t\n\r\x0b\x0c")] = 3
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 7
_CLASS[list(b",.")], _CLASS[list(b"!?;:'\"()-")] = 4, 5
_MARKED = frozenset(b"!$%&*#|@^~=+<>/\\_{}[]")
#: Bytes of a block whose deflated size tells of repetition; all blocks of a text are deflated.
_BLOCK = 1 << 16


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a text, whatever its language; those of an empty text are 0."""
    if not text:
        return [0.0] * len(STATISTICS)
    size = len(text)
    kinds = np.zeros(9)
    for i in range(0, size, 1 << 20):
        kinds += np.bincount(_CLASS[np.frombuffer(text[i : i + (1 << 20)], np.uint8)], minlength=9)
    words = text.split()
    n = max(1, len(words))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    threes = {*zip(words, words[1:], words[2:], strict=False)}
    lines = text.split(b"\n")
    return [
        np.log1p(size), np.log1p(len(words)), lengths.mean(), lengths.std(),
        kinds[0] / size, kinds[2] / size, kinds[3] / size, kinds[4] / size, kinds[5] / size, kinds[6] / size,
        kinds[7] / size, kinds[8] / size,
        len(counts) / n, max(counts.values(), default=0) / n, sum(lengths <= 1) / n,
        sum(c for w, c in counts.items() if w.isupper() and len(w) > 1) / n, sum(c for w, c in counts.items() if w[-1] in _MARKED) / n,
        sum(map(eq, words, words[1:])) / n, 1 - len(threes) / max(1, len(words) - 2), np.log1p(len(lines)), 1 - len(set(lines)) / len(lines), len(words) / len(lines),
        sum(len(zlib.compress(text[i : i + _BLOCK], 1)) for i in range(0, size, _BLOCK)) / size,
    ]


@dataclass(frozen=True)
class Model:
    """Everything that a score needs; a few hundred kilobytes."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.at, self.level), 0.0, 1.0)


def described(text: Column) -> Column:
    """Statistics of whole texts; null text counts as empty. Only the text goes to Python, in batches bounded by bytes."""

    @F.arrow_udf("array<double>")
    def numbers(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t) for t in byte_rows(texts)], pa.list_(pa.float64()))

    return numbers(text)


def describe(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every text."""
    return docs.select(F.col("doc_id").cast("long"), described(F.col("text")).alias("stats"))


def _fold() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def held_out() -> Column:
    """Rows that no fit may see: the crc32 of the id as text is a multiple of 5."""
    return _fold() % 5 == 0


def _calibrated(bins: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators over (score, rows, positives) in order of score."""
    blocks: list[list[float]] = []
    for at, rows, good in bins:
        blocks.append([at * rows, rows, good])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    at = np.array([b[0] / b[1] for b in blocks])
    return at, np.array([b[2] / b[1] for b in blocks])


def fit(described: DataFrame, labels: DataFrame) -> Model:
    """Model from labelled rows outside the held-out fold.

    Rows with several labels count with their mean; rows with null labels or ids don't count. A
    quarter of the rows calibrates, the rest is fitted. Without any labels, all scores are 0.5.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("y"))
    rows = stage(
        described.filter(~held_out()).join(known, "doc_id").select("stats", "y", ((_fold() / 5).cast("long") % 4 == 0).alias("calibrates"))
    )
    n = len(STATISTICS)
    moments = rows.select(
        F.count(F.lit(1)), *[f(F.col("stats")[i]) for f in (F.avg, F.stddev_pop) for i in range(n)]
    ).first()
    count = moments[0]
    mean = np.array([x or 0.0 for x in moments[1 : n + 1]])
    scale = np.array([x if x and x > 1e-9 else 1.0 for x in moments[n + 1 :]])
    rng = np.random.default_rng(SEED)
    # The kernel's width is the typical distance of standardised rows.
    directions = rng.standard_normal((n, FEATURES)) / np.sqrt(n / 2)
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    nothing = np.zeros(FEATURES + 1)
    model = Model(mean, scale, directions, phases, nothing, np.array([0.0]), np.array([0.5]))
    if not count:
        return model

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            if batch.num_rows:
                x = model.features(np.stack(batch.column(0).to_numpy(zero_copy_only=False)))
                y = batch.column(1).to_numpy(zero_copy_only=False)
                gram += x.T @ np.column_stack([x, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(gram)), pa.int32()), pa.array(list(gram), pa.list_(pa.float64()))], ["i", "part"]
        )

    def added(rows: pa.Table) -> pa.Table:
        parts = np.stack(rows["part"].combine_chunks().to_numpy(zero_copy_only=False))
        return pa.table({"i": rows["i"].slice(0, 1), "part": pa.array([parts.sum(axis=0)], pa.list_(pa.float64()))})

    kind = "i int, part array<double>"
    used = rows.filter("NOT calibrates") if rows.filter("NOT calibrates").limit(1).count() else rows
    sums = used.select("stats", "y").mapInArrow(summed, kind).groupBy("i").applyInArrow(added, kind).orderBy("i").collect()
    gram = np.array([r["part"] for r in sums])
    system, target = gram[:, :-1], gram[:, -1]
    penalty = np.full(len(system), PENALTY * max(count, 100))
    penalty[-1] = 1e-9
    weights = np.linalg.solve(system + np.diag(penalty), target)
    ridge = Model(mean, scale, directions, phases, weights, np.array([0.0]), np.array([0.5]))

    def rough(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = np.clip(ridge.raw(np.stack(batch.column(0).to_numpy(zero_copy_only=False))), -1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.round(raw * STEPS).astype(np.int64)), batch.column(1)], ["step", "y"])

    spare = rows.filter("calibrates") if rows.filter("calibrates").limit(1).count() else rows
    bins = (
        spare.select("stats", "y").mapInArrow(rough, "step long, y double").groupBy("step")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).orderBy("step").collect()
    )  # at most 3 * STEPS + 1 rows, by the clipping
    at, level = _calibrated([(b["step"] / STEPS, b["n"], b["good"]) for b in bins])
    return Model(mean, scale, directions, phases, weights, at, level)


def score(described: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every described row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = model.score(np.stack(batch.column(1).to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    return described.select("doc_id", "stats").mapInArrow(scored, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that score at least ``threshold``, with all their columns and rows.

    Only ``doc_id`` and ``text`` are read; null text scores as an empty one. Each text is described once: the rows are
    written with their statistics, and both the fit and the verdict read these.
    """
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), described(F.col("text")).alias("stats")))
    model = fit(rows.select(F.col("row.doc_id").cast("long").alias("doc_id"), "stats"), labels)

    @F.arrow_udf("double")
    def scores(stats: pa.Array) -> pa.Array:
        return pa.array(model.score(np.stack(stats.to_numpy(zero_copy_only=False))) if len(stats) else [], pa.float64())

    return rows.filter(scores("stats") >= threshold).select("row.*")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document.

    Null ids belong to the fold of the empty text; repeated rows are scored each; an empty table gives
    an empty result.
    """
    rows = stage(describe(table(spark, sf_dir, "documents")))
    scored = score(rows, fit(rows, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op3_quality": ready(op3_quality)}
ORACLES: dict[str, str] = {}
