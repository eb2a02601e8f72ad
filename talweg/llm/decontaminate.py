"""Benchmark phrases in documents, found by a positional inverted index.

The index is a written table of postings (term, document, position), document-partitioned and in term order in each
part. It holds the terms of the benchmark only, with an end mark at each document's length. A phrase is searched by
joining the lists of its two rarest terms, shifted by their offsets; what remains is compared with the other lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talweg.llm.common import ascii_lower, ready, stage, table

#: Words in a phrase; an item of fewer words is one phrase.
WINDOW = 10
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_END = ""


def words(text: Column) -> Column:
    """Words of a text: runs of digits, letters a to z after lower-casing A to Z, and all non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def _document() -> Column:
    """Rows that agree in id and text are one document."""
    return F.xxhash64("doc_id", "text").alias("doc")


def phrases_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(phrase, item_id, terms): every run of ``window`` words; null and wordless items have none."""
    split = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1))))
    runs = split.select("item_id", "w", starts.alias("s")).select("item_id", F.slice(F.col("w"), F.col("s"), F.lit(window)).alias("terms"))
    return runs.select(F.xxhash64(F.array_join("terms", " ")).alias("phrase"), "item_id", "terms").distinct()


def build_index(docs: DataFrame, phrases: DataFrame) -> DataFrame:
    """Written postings (doc_id, doc, term, position) of the phrases' terms, and each document's end."""
    vocabulary = phrases.select(F.explode("terms").alias("word")).distinct()
    # Written first: Spark broadcasts it if its known size is small, and shuffles otherwise.
    vocabulary = stage(vocabulary.unionByName(docs.sparkSession.range(1).select(F.lit(_END).alias("word"))))
    tokens = docs.select("doc_id", _document(), F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(_END)))).alias("position", "word"))
    return stage(
        tokens.join(vocabulary, "word").select("doc_id", "doc", F.xxhash64("word").alias("term"), "position")
        .sortWithinPartitions("term", "doc", "position")
    )


def _ranked(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, length, term, offset, rank): terms of each phrase, the rarest in the index first."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    each = phrases.select("phrase", "terms").distinct().select("phrase", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "word"))
    counted = each.withColumn("term", F.xxhash64("word")).join(counts, "term", "left")
    # A phrase has at most ``window`` rows here.
    by = Window.partitionBy("phrase")
    return (
        counted.withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(by)).filter("least > 0")
        .withColumn("rank", F.row_number().over(by.orderBy("n", "offset")))
        .select("phrase", "length", "term", "offset", "rank")
    )


def _shifted(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the given phrase terms as starts of the phrase: (phrase, length, doc, start)."""
    return (
        index.join(terms, "term").withColumn("start", F.col("position") - F.col("offset")).filter("start >= 0")
        .select("phrase", "length", "doc", "start")
    )


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(phrase, doc, start, length): every place at which a phrase stands in a document."""
    terms = stage(_ranked(index, phrases))
    rare = _shifted(index, terms.filter("rank = 1"))
    second = _shifted(index, terms.filter("rank = 2")).select("phrase", "doc", "start")
    place = ["phrase", "doc", "start"]
    some = rare.filter("length > 1").join(second, place, "left_semi").distinct()
    found = stage(some.unionByName(rare.filter("length = 1").distinct()))
    # The other lists, in the few documents that are left.
    own = index.join(stage(found.select("doc").distinct()), "doc", "left_semi").select("doc", "term", "position")
    asked = found.join(terms, ["phrase", "length"]).select(*place, "length", "term", (F.col("start") + F.col("offset")).alias("position"))
    return (
        asked.join(own, ["doc", "position", "term"]).groupBy(*place, "length")
        .agg(F.countDistinct("position").alias("n")).filter("n = length").drop("n")
    )


def proximity_matches(index: DataFrame, phrases: DataFrame, slack: int) -> DataFrame:
    """(phrase, doc): documents in which all terms of a phrase stand, in any order, in a span of its length plus ``slack`` words.

    Starts from the rarest term; what is gathered for each of its places is bounded by the span.
    """
    terms = stage(_ranked(index, phrases))
    kinds = terms.groupBy("phrase").agg(F.countDistinct("term").alias("kinds"))
    span = F.col("length") + slack
    anchors = index.join(terms.filter("rank = 1"), "term").select("phrase", "length", "doc", F.col("position").alias("at"))
    wanted = anchors.join(terms.select("phrase", "term").distinct(), "phrase")
    near = wanted.join(index.select("doc", "term", "position"), ["doc", "term"]).filter(F.abs(F.col("position") - F.col("at")) < span)
    places = near.groupBy("phrase", "doc", "at", "length").agg(F.collect_set(F.struct("position", "term")).alias("p")).join(kinds, "phrase")
    full = F.exists(
        "p",
        lambda x: F.size(
            F.array_distinct(F.transform(F.filter("p", lambda y: (y["position"] >= x["position"]) & (y["position"] < x["position"] + span)), lambda y: y["term"]))
        ) == F.col("kinds"),
    )
    return places.filter(full).select("phrase", "doc").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, doc (hash of the row), n_words, n_hit, n_items, items_sha256 and contaminated for every row.

    A word inside any occurrence of a phrase is hit. Null and empty texts have no words. Rows that repeat id and
    text have equal results; null ids are ids like others. Empty tables give no rows, or no hits. Only the columns
    named in the contract are read.
    """
    phrases = stage(phrases_of(benchmark, window))
    index = build_index(docs, phrases)
    matches = stage(phrase_matches(index, phrases))
    hits = (
        matches.select("doc", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("position"))
        .groupBy("doc").agg(F.countDistinct("position").alias("n_hit"))
    )
    # At most one entry for each benchmark item.
    items = (
        matches.select("phrase", "doc").distinct().join(phrases.select("phrase", "item_id").distinct(), "phrase")
        .groupBy("doc").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    )
    ends = index.filter(F.col("term") == F.xxhash64(F.lit(_END))).select("doc_id", "doc", F.col("position").cast("long").alias("n_words"))
    listed = F.array_join(F.array_sort(F.coalesce("items", F.array().cast("array<string>"))), ",")
    return ends.join(hits.join(items, "doc"), "doc", "left").select(
        "doc_id", "doc", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without any phrase of the benchmark, with all their columns and rows."""
    gone = stage(contamination(docs, benchmark, window).filter("contaminated").select("doc").distinct())
    # The rows of the user are one struct, so no column of theirs can clash with the hash.
    rows = docs.select(_document(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(gone, "doc", "left_anti").select("row.*")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("doc")


def _sql_words(name: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(translate(coalesce({name}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )


OP8_SQL = f"""
WITH items AS (SELECT item_id, {_sql_words('text')} AS w FROM benchmark),
phrases AS (
  SELECT item_id, array_to_string(w[s:s + 9], ' ') AS phrase, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
places AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM phrases))),
found AS (SELECT DISTINCT doc_id, s, n, item_id FROM places JOIN phrases USING (n, phrase)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(list_sort(ids), ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
"""

QUERIES = {"op8_decontamination": ready(op8_decontamination)}
ORACLES = {"op8_decontamination": OP8_SQL}
