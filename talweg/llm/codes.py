"""Compression of vectors into codes of parts, with codebooks fitted in exact integers.

Components become integers and vectors are cut into parts, each with a codebook. The nearest entry is found by memoised
grid cells: a part's coarse cell is looked up in a table that keeps, for each cell seen, the entries that some point of the cell's box
can have as its nearest one (smallest distance to the box at most the smallest of the largest ones). Only those are evaluated exactly.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import ready, stage, table
from talweg.operators.scale import row_digest, with_group_facts

#: Parts of a vector, entries of a codebook, rounds of the fit, scale of the integers.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Cells along the spread of a codebook, cells that a task remembers for each part, numbers that an evaluation holds at once.
CELLS, MEMO, AT_ONCE = 8, 16_384, 1 << 21
#: Integers up to this size are computed in 64 bits, larger ones in Python's own; bits of a limb of their sums.
SMALL, LIMB = 1 << 20, 30
MOST_LONG = (1 << 63) - 1


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exactly: 64-bit integers, or Python's where one is beyond SMALL."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * float(SCALE))
    if not scaled.size or np.abs(scaled).max() <= SMALL:
        return scaled.astype(np.int64)
    # Beyond 2^53 a double is a whole number, so it is scaled after it became one.
    exact = [int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in vectors.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(vectors.shape)


def widths(dim: int, parts: int) -> int:
    """Components of a part; vectors that don't divide evenly get zeros at the end."""
    return max(1, -(-dim // parts))


def _distinct(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows, and which of them each row is."""
    if cells.dtype == object:
        numbers: dict[tuple, int] = {}
        place = np.array([numbers.setdefault(tuple(c), len(numbers)) for c in cells], np.int64)
        return np.array(list(numbers), dtype=object).reshape(len(numbers), cells.shape[1]), place
    low = cells.min(axis=0)
    spans = [int(x) for x in cells.max(axis=0) - low + 1]
    if math.prod(spans) < 1 << 62:  # a row is one number
        keys = np.zeros(len(cells), np.int64)
        for k, span in enumerate(spans):
            keys = keys * span + (cells[:, k] - low[k])
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
        return cells[first], place.ravel()
    unique, place = np.unique(cells, axis=0, return_inverse=True)
    return unique, place.ravel()


class Codebook:
    """Entries of one part and the cells seen so far."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        spread = int((entries.max(axis=0) - entries.min(axis=0)).max()) // CELLS
        self.side = 1 << max(0, spread.bit_length() - 1)
        self.memo: dict[tuple, int] = {}  # cell to row of the table
        self.table = np.zeros((0, len(entries)), np.int32)  # candidates, the last one repeated
        self.count = np.zeros(0, np.int64)

    def candidates(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each cell the entries, in order, that can be the nearest of one of its points, and how many they are."""
        low = (cells * self.side)[:, None, :]
        below, above = low - self.entries, self.entries - (low + (self.side - 1))
        least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(axis=2)
        most = (np.maximum(np.abs(below), np.abs(above)) ** 2).sum(axis=2)
        kept = (least <= most.min(axis=1)[:, None]).astype(bool)
        count = kept.sum(axis=1)
        first = np.argsort(~kept, axis=1, kind="stable").astype(np.int32)
        # A repeated last entry wins no tie against itself.
        return np.take_along_axis(first, np.minimum(np.arange(len(self.entries)), count[:, None] - 1), 1), count

    def _rows(self, cells: np.ndarray) -> np.ndarray:
        """Rows of the table for distinct cells; new ones are added, after all old ones are forgotten if they are too many."""
        names = [tuple(c) for c in cells.tolist()]
        fresh = [i for i, k in enumerate(names) if k not in self.memo]
        if len(self.memo) + len(fresh) > MEMO:
            self.memo.clear()
            self.table, self.count, fresh = self.table[:0], self.count[:0], list(range(len(names)))
        step = max(1, AT_ONCE // self.entries.size)
        found = [self.candidates(cells[fresh[i : i + step]]) for i in range(0, len(fresh), step)]
        for i in fresh:
            self.memo[names[i]] = len(self.memo)
        self.table = np.concatenate([self.table, *[t for t, _ in found]])
        self.count = np.concatenate([self.count, *[c for _, c in found]])
        return np.array([self.memo[k] for k in names], np.int64)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry, ties to the lower one, and the squared distance."""
        code = np.zeros(len(points), np.int64)
        distance = np.zeros(len(points), np.promote_types(points.dtype, self.entries.dtype))
        for start in range(0, len(points), MEMO):
            some = points[start : start + MEMO]
            cells, place = _distinct(some // self.side)
            rows = self._rows(cells)[place]
            order = np.argsort(self.count[rows], kind="stable")  # short lists together
            at = 0
            while at < len(order):
                step = max(1, min(2048, AT_ONCE // self.entries.size))
                own = order[at : at + step]
                which = self.table[rows[own], : self.count[rows[own[-1]]]]
                all_ = ((some[own, None, :] - self.entries[which]) ** 2).sum(axis=2)
                best = all_.argmin(axis=1)[:, None]
                code[start + own] = np.take_along_axis(which, best, 1)[:, 0]
                distance[start + own] = np.take_along_axis(all_, best, 1)[:, 0]
                at += step
        return code, distance


def _parts(column: pa.Array, dim: int, parts: int) -> np.ndarray:
    """Rows of a list column as integers (rows, parts, width)."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    rows, width = whole(values), widths(dim, parts)
    if parts * width > dim:
        rows = np.hstack([rows, np.zeros((len(rows), parts * width - dim), rows.dtype)])
    return rows.reshape(len(rows), parts, width)


def _assigned(points: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    found = [book.nearest(points[:, p, :]) for p, book in enumerate(books)]
    return np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _books(codebooks: list[np.ndarray]) -> list[Codebook]:
    return [Codebook(entries) for entries in codebooks]


def refit(kept: DataFrame, codebooks: list[np.ndarray], dim: int, limbs: int) -> list[np.ndarray]:
    """Every entry replaced by the floored mean of the parts nearest to it; entries without any stay.

    Tasks sum by part and entry; sums are split into ``limbs`` numbers each, so that Spark adds them without overflow.
    """
    parts, entries, width = len(codebooks), len(codebooks[0]), widths(dim, len(codebooks))

    def split(value: int) -> list[int]:
        out = []
        for _ in range(limbs - 1):
            out.append(value & ((1 << LIMB) - 1))
            value >>= LIMB
        return [*out, value]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, counts = _books(codebooks), np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64 if limbs == 1 else object)
        for batch in batches:
            if batch.num_rows:
                points = _parts(batch.column(0), dim, parts)
                codes, _ = _assigned(points, books)
                for p in range(parts):
                    np.add.at(counts[p], codes[:, p], 1)
                    np.add.at(sums[p], codes[:, p], points[:, p, :])
        used = [(p, e) for p in range(parts) for e in range(entries) if counts[p, e]]
        values = [[x for v in sums[p, e].tolist() for x in split(v)] for p, e in used]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
                pa.array([counts[u] for u in used], pa.int64()), pa.array(values, pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "sums"],
        )

    rows = (
        kept.select("embedding").mapInArrow(summed, "part int, entry int, n long, sums array<long>").groupBy("part", "entry")
        .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width * limbs)]).alias("sums")).collect()
    )  # one row for each entry at most
    out = [entries.copy() for entries in codebooks]
    for r in rows:
        pieces = np.array(r["sums"], dtype=object).reshape(width, limbs)
        means = [sum(x << (LIMB * i) for i, x in enumerate(piece)) // r["n"] for piece in pieces]
        out[r["part"]][r["entry"]] = means
    return out


def digest(codebooks: list[np.ndarray], dim: int) -> str:
    """SHA-256 of all components by part, entry and place; added zeros left out."""
    width = codebooks[0].shape[1] if codebooks else 0
    texts = [str(x) for p, b in enumerate(codebooks) for entry in b.tolist() for i, x in enumerate(entry) if p * width + i < dim]
    return hashlib.sha256(",".join(texts).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that takes part.

    Vectors that are null, empty or hold null or non-finite components take no part, nor do those whose length differs from
    that of the smallest id's. Lengths that ``parts`` doesn't divide count as filled with zeros. The first entries are the
    vectors of the smallest ids, ties by the vectors; null ids come last. With fewer vectors than entries, codebooks are as short. Errors
    beyond 64 bits are given as 2^63 - 1. Repeated rows count each; other columns are ignored, and a table without labels has null ones.
    """
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("long")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = stage(
        vectors.select(F.col("vec_id").cast("long"), label.alias("label"), "embedding")
        .filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite)
    )
    schema = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    order = [F.asc_nulls_last("vec_id"), F.asc("embedding")]
    least = kept.orderBy(*order).select(F.size("embedding")).first()
    if least is None:
        return vectors.sparkSession.createDataFrame([], schema)
    dim = least[0]
    kept = kept.filter(F.size("embedding") == dim)
    first = np.array([r[0] for r in kept.orderBy(*order).select("embedding").limit(entries).collect()], np.float64)
    large = kept.select(F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double")))))).first()[0]
    # Sums of limbs stay within 64 bits: a limb of 30 bits, or a whole number below SMALL, from up to 2^32 tasks or rows.
    limbs = 1 if large * SCALE < SMALL else -(-(math.frexp(large)[1] + 48) // LIMB) + 1
    points = _parts(pa.array(first.tolist(), pa.list_(pa.float64())), dim, parts)
    codebooks = [points[:, p, :] for p in range(parts)]
    if limbs > 1:
        codebooks = [b.astype(object) for b in codebooks]
    for _ in range(rounds):
        codebooks = refit(kept, codebooks, dim, limbs)
    digits = max(2, -(-(entries - 1).bit_length() // 4))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(codebooks)
        for batch in batches:
            codes, distances = _assigned(_parts(batch.column(2), dim, parts), books)
            texts = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
            errors = [min(sum(row), MOST_LONG) for row in distances.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"]
            )

    kind = kept.schema["label"].dataType.simpleString()
    rows = stage(kept.mapInArrow(coded, f"vec_id long, label {kind}, code string, error long"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_LONG)).cast("long").alias("label_error")
    return with_group_facts(rows, row_digest("label"), [total], F.lit(True), ["vec_id", "code"]).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks, dim)).alias("codebooks_sha256")
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings: 16 parts, 64 entries, two rounds."""
    return compress(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same codes for vectors of 64 components, by comparing every part with every entry."""
    width = 64 // PARTS
    x, c = [f"x[{i + 1}]" for i in range(width)], [f"c[{i + 1}]" for i in range(width)]
    distance = " + ".join(f"({a} - {b}) * ({a} - {b})" for a, b in zip(x, c, strict=True))
    means = ", ".join(f"floor(sum({a})::DOUBLE / count(*))::BIGINT" for a in x)
    steps = [
        f"""WITH kept AS (
  SELECT vec_id, label, [floor({SCALE} * v::DOUBLE)::BIGINT FOR v IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
parts AS (SELECT vec_id, p, e[p * {width} + 1 : (p + 1) * {width}] AS x FROM kept, range({PARTS}) r(p)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM kept QUALIFY k < {ENTRIES}),
book0 AS (SELECT p, k, x AS c FROM parts JOIN first USING (vec_id))"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"near{i} AS (SELECT vec_id, p, x, min({{'d': {distance}, 'k': k}}) AS n FROM parts JOIN book{i} USING (p) GROUP BY vec_id, p, x)")
        if i < ROUNDS:
            steps.append(
                f"mean{i} AS (SELECT p, n.k AS k, [{means}] AS m FROM near{i} GROUP BY p, n.k),\n"
                f"book{i + 1} AS (SELECT p, k, coalesce(m, c) AS c FROM book{i} LEFT JOIN mean{i} USING (p, k))"
            )
    steps.append(
        f"""coded AS (
  SELECT vec_id, string_agg(lower(lpad(to_base(n.k, 16), 2, '0')), '' ORDER BY p) AS code, sum(n.d)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id),
sha AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), sha"""
    )
    return ",\n".join(steps)


QUERIES = {"op13_vector_codes": ready(op13_vector_codes)}
ORACLES = {"op13_vector_codes": _sql()}
