"""Importance resampling towards a target distribution by hashed word counts.

An untrained regex split over lower-cased text gives words with byte offsets; windows over pairs of offsets are the features,
runs of consecutive words. Their CRC buckets are counted in the corpus and in the target; a bucket's gain is the logarithm of
both shares' ratio. A document weighs the sum of its gains, and the best weights with Gumbel noise are drawn.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import byte_rows, ready, stage, table
from talweg.operators.identifiers import add_sequential_id

#: Shortest and longest run of words, buckets, seed of the noise, words that a drawn document has at least, percent drawn.
LOW, HIGH, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 1, 10_000, 2024, 20, 10
#: What separates words: all of ASCII but digits and small letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Words:
    """Words of a text and their places, by the pre-tokenizer."""

    def __init__(self):
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self.text, self.split = PreTokenizedString, pre_tokenizers.Split(Regex(SEPARATORS), "removed")

    def offsets(self, data: bytes) -> list[tuple[int, int]]:
        """First byte and end of each word of lower-cased UTF-8 bytes."""
        if not data:
            return []
        text = self.text(data.decode())
        self.split.pre_tokenize(text)
        return [place for _, place, _ in text.get_splits("original", "byte")]

    def features(self, data: bytes, low: int, high: int) -> tuple[int, Counter]:
        """Number of words, and every run of ``low`` to ``high`` of them with its count."""
        places = self.offsets(data)
        counts: Counter[bytes] = Counter()
        if low <= 1 <= high:
            counts.update([data[a:b] for a, b in places])
        for n in range(max(low, 2), high + 1):
            words = [data[a:b] for a, b in places]
            # A run whose bytes hold only its words and single spaces is a slice; any other is joined.
            for i, ((a, _), (_, b)) in enumerate(zip(places, places[n - 1 :], strict=False)):
                run = b" ".join(words[i : i + n])
                counts[data[a:b] if b - a == len(run) and data[a:b] == run else run] += 1
        return len(places), counts


def histograms(docs: DataFrame, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, bucket, n): words and features of every whole text, and its features by bucket.

    The lists are as long as the distinct buckets of their own text. Null text has no words.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            sizes, totals, bucket, number = [], [], [], []
            for data in byte_rows(batch.column(1)):
                size, features = words.features(data.lower(), low, high)  # bytes lower only A to Z
                own: dict[int, int] = {}
                for feature, n in features.items():
                    b = zlib.crc32(feature) % buckets
                    own[b] = own.get(b, 0) + n
                sizes.append(size)
                totals.append(sum(own.values()))
                bucket.append(list(own))
                number.append(list(own.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), pa.array(bucket, pa.list_(pa.int32())),
                    pa.array(number, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_words", "n_features", "bucket", "n"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        counted, "doc_id long, n_words long, n_features long, bucket array<int>, n array<long>"
    )


def totals(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket: summed in each task, then by bucket."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(total, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    sums = counted.select("bucket", "n").mapInArrow(summed, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():  # at most ``buckets`` rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)))) for s, t in zip(corpus.tolist(), target.tolist())],
        np.int64,
    )


def weighed(counted: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the sum of the gains of a row's features."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            parts = gain[lists.flatten().to_numpy()] * batch.column(4).flatten().to_numpy()
            before = np.concatenate([[0], np.cumsum(parts)])
            weight = before[ends[1:]] - before[ends[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weight)], ["doc_id", "n_words", "n_features", "weight"])

    return counted.mapInArrow(summed, "doc_id long, n_words long, n_features long, weight long")


def noise(doc: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the hash of seed and id alone; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(
    docs: DataFrame, target: DataFrame, *, low: int = LOW, high: int = HIGH, buckets: int = BUCKETS, seed: int = SEED,
    least_words: int = LEAST_WORDS, percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; rank is null where it isn't drawn.

    Drawn are the highest scores of ``percent`` of the rows with ``least_words`` words or more, ties to the smaller id; rows
    that agree in both are ranked in any order, each with a rank of its own. Null ids count as the smallest. Null and empty
    texts have no words and weight 0; repeated rows count each; other columns are ignored; an empty table gives an empty
    result, an empty target leaves all gains to smoothing. The gains are the only thing that leaves the tasks: ``buckets`` numbers.
    """
    if not 1 <= low <= high:
        raise ValueError("runs of words have at least one word")
    counted = stage(histograms(docs, low, high, buckets))
    wanted = totals(histograms(target.select(F.lit(None).alias("doc_id"), "text"), low, high, buckets), buckets)
    gain = gains(totals(counted, buckets), wanted)
    rows = weighed(counted, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()))
    able = rows.filter(F.col("n_words") >= least_words)
    most = able.count() * percent // 100
    ranked = add_sequential_id(able, [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("row")], column="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    short = rows.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(short).select("doc_id", "n_words", "n_features", "weight", "score", F.col("rank").cast("long"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn towards the benchmark's words."""
    drawn = draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = f"""
WITH steps AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, [j::UBIGINT FOR j IN range(8)]),
      lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c
    FROM range(256) r(i))),
texts AS (
  SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
  FROM documents
  UNION ALL
  SELECT -row_number() OVER (), NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  FROM benchmark),
words AS (SELECT r, unnest(regexp_extract_all(x, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS w FROM texts),
counted AS (SELECT r, w, count(*) AS n FROM words GROUP BY r, w),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda h: ('0x' || h)::UBIGINT)),
      lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT])), 4294967295::UBIGINT) % {BUCKETS} AS b
  FROM (SELECT DISTINCT w FROM counted), steps),
found AS (SELECT r, b, sum(n) AS n FROM counted JOIN hashed USING (w) GROUP BY r, b),
sums AS (
  SELECT b, coalesce(sum(n) FILTER (r > 0), 0) AS s, coalesce(sum(n) FILTER (r < 0), 0) AS t FROM found GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM sums) + {BUCKETS}))::DOUBLE
    / ((s + 1) * ((SELECT sum(t) FROM sums) + {BUCKETS}))::DOUBLE))::BIGINT AS g FROM sums),
weights AS (SELECT r, sum(n)::BIGINT AS n_features, sum(n * g)::BIGINT AS weight FROM found JOIN gain USING (b) WHERE r > 0 GROUP BY r),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (r) WHERE r > 0)
SELECT *, CASE WHEN n_features >= {LEAST_WORDS}
    AND row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST)
      <= (SELECT count(*) FROM scored WHERE n_features >= {LEAST_WORDS}) * {PERCENT} // 100
  THEN row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS FIRST) END AS rank
FROM scored
"""

QUERIES = {"op12_resampling": ready(op12_resampling)}
ORACLES = {"op12_resampling": OP12_SQL}
