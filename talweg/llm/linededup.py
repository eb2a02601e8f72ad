"""Removal of repeated line passages by overlapping three-line windows.

Every three consecutive lines are hashed; a window that occurred before, in another document or
further up, is a later occurrence. The lines under later occurrences go; overlapping windows merge, so a
passage of any number of lines goes as a whole. A first occurrence stays, but for those of its lines that a later
window also covers: of four equal lines only the first stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm.common import ready, table

#: Lines in a window.
WINDOW = 3


def _lines() -> Column:
    return F.split("text", "\n")


def _windows(lines: Column) -> Column:
    """A 128-bit hash for each window in order; null for texts with fewer lines. ``lines`` is a computed column."""
    count = F.size(lines) - (WINDOW - 1)
    rows = F.arrays_zip(*[F.slice(lines, k + 1, count).alias(f"l{k}") for k in range(WINDOW)])

    def hashed(row: Column) -> Column:
        return F.struct(F.xxhash64(row).alias("a"), F.xxhash64(F.lit(7), row).alias("b"))

    return F.when(count > 0, F.transform(rows, hashed))


def _identified(docs: DataFrame) -> DataFrame:
    """Rows that agree in id and text are one document; null ids come before all others."""
    return docs.withColumn("__doc", F.coalesce(F.col("doc_id"), F.lit(-(2**63)))).withColumn("__body", F.xxhash64("text"))


def later_occurrences(docs: DataFrame) -> DataFrame:
    """(__doc, __body, __starts): lines at which windows start that occurred before.

    Occurrences are in order of id, hash of the text and line. Finding the first ones is a partial
    aggregate, so a passage that many documents hold makes no heavy group; the join back has one row
    for each repeated window on one side, so a heavy window's rows on the other can be split.
    """
    place = ["__doc", "__body", "__line"]
    # The lines are a column of their own, split once for each text.
    split = _identified(docs.select("doc_id", "text")).select("__doc", "__body", _lines().alias("__lines"))
    windows = split.select("__doc", "__body", F.posexplode(_windows(F.col("__lines"))).alias("__line", "h")).select(*place, "h.a", "h.b")
    first = windows.groupBy("a", "b").agg(F.min(F.struct(*place)).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    later = windows.join(first.drop("n"), ["a", "b"]).filter(F.struct(*place) > F.col("first"))
    # A list is bounded by the lines of its own document.
    return later.groupBy("__doc", "__body").agg(F.collect_set("__line").alias("__starts"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All columns and rows of ``docs``, the text without later occurrences, and n_lines and n_removed.

    Null text stays null and has no lines; texts of fewer than three lines stay as they are; rows that
    repeat id and text are one document and change alike; all other columns are kept, but n_lines and
    n_removed are replaced. A text whose lines all go becomes empty.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # The rows of the user are one struct, so no column of theirs can clash with the working ones.
    rows = _identified(docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in own]).alias("__row")))
    joined = rows.join(later_occurrences(docs), ["__doc", "__body"], "left")
    covered = F.array_distinct(F.flatten(F.transform("__starts", lambda s: F.sequence(s, s + (WINDOW - 1)))))
    stays = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__covered"))
    shorter = F.array_join(F.transform(stays, lambda i: F.get(F.col("__lines"), i)), "\n")
    done = (
        joined.withColumn("__covered", covered).withColumn("__lines", _lines())
        .withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.size("__lines")).cast("long"))
        .withColumn("n_removed", F.when(F.col("__covered").isNull(), 0).otherwise(F.size("__covered")).cast("long"))
        .withColumn("text", F.when(F.col("__covered").isNull(), F.col("text")).otherwise(shorter))
    )
    return done.select(*[F.col("text") if c == "text" else F.col("__row").getField(c).alias(c) for c in own], "n_lines", "n_removed")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without repeated line passages."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP5_SQL = """
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, i AS line, l[i + 1] || chr(10) || l[i + 2] || chr(10) || l[i + 3] AS w
  FROM (SELECT doc_id, l, unnest(range(len(l) - 2)) AS i FROM lines)),
later AS (
  SELECT doc_id, line FROM windows
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, line) > 1),
gone AS (
  SELECT doc_id, list(DISTINCT line + k) AS covered FROM later, range(3) r(k) GROUP BY doc_id)
SELECT doc_id, CASE WHEN covered IS NULL THEN text ELSE
    array_to_string([l[i + 1] FOR i IN range(len(l)) IF NOT list_contains(covered, i)], chr(10)) END AS text,
  coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(covered), 0)::BIGINT AS n_removed
FROM lines LEFT JOIN gone USING (doc_id)
"""

QUERIES = {"op5_line_dedup": ready(op5_line_dedup)}
ORACLES = {"op5_line_dedup": OP5_SQL}
