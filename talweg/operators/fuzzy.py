"""Fuzzy canonical values: a similarity join over distinct texts by their rarest grams or by segments, and a greedy selection."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talweg.functions.text import ascii_fold, strip
from talweg.operators.identifiers import add_sequential_id
from talweg.operators.scale import stage

#: Least ratio of similar texts, and buckets of gram frequencies.
CUTOFF, BUCKETS = 0.9, 4096


@F.arrow_udf(T.DoubleType())
def similarity(candidate: pa.Array, text: pa.Array) -> pa.Array:
    """Ratcliff/Obershelp ratio of two texts."""
    from difflib import SequenceMatcher

    matcher = SequenceMatcher()
    out, last = [], None
    for one, two in zip(candidate.to_pylist(), text.to_pylist()):
        if two != last:
            matcher.set_seq2(two)
            last = two
        matcher.set_seq1(one)
        out.append(matcher.ratio())
    return pa.array(out, pa.float64())


def _slack(total, cutoff):
    """Most characters two texts of this total length may leave unmatched."""
    return F.floor(F.lit(1 - cutoff) * total + F.lit(1e-9)).cast("int")


def _grams(text: Column) -> Column:
    """Neighbouring characters of a text with an end mark on either side."""
    padded = F.concat(F.lit("\x01"), text, F.lit("\x02"))
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.substring(padded, i, F.lit(2)))


def _bucket(gram: Column) -> Column:
    return F.crc32(gram) % BUCKETS


def _longest(size: Column, cutoff: float) -> Column:
    """Length of the longest text that can be similar to one of this length."""
    return F.floor(size * F.lit((2 - cutoff) / cutoff) + F.lit(1e-9)).cast("int")


def _gram_index(grams: DataFrame, cutoff: float) -> DataFrame:
    """Rows (id, size, low, high, key) of each text's rarest grams, as many as may be lost and one more.

    How rare a gram is follows from the frequencies of hashed buckets, a table of fixed size.
    """
    counted = grams.select(F.explode("grams").alias("g")).groupBy(_bucket(F.col("g")).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    seen = {r["b"]: r["n"] for r in counted.collect()}  # at most BUCKETS rows
    # A text that is split when the plan is made: a plan with one literal instead of thousands.
    frequency = F.split(F.lit(",".join(str(seen.get(i, 0)) for i in range(BUCKETS))), ",").cast("array<long>")
    ranked = F.array_sort(
        F.transform("grams", lambda g: F.struct(F.get(frequency, _bucket(g).cast("int")).alias("n"), g.alias("g")))
    )
    rarest = F.slice(ranked, F.lit(1), F.lit(2) * _slack(F.col("size") + _longest(F.col("size"), cutoff), cutoff) + 1)
    return grams.select("id", "size", "low", "high", F.explode(F.array_distinct(F.transform(rarest, lambda r: r["g"]))).alias("key"))


def _segments(size: Column, cutoff: float) -> tuple[Column, Column]:
    """Number and length of the segments of a text: one more than it and a similar one may leave unmatched."""
    count = _slack(size + _longest(size, cutoff), cutoff) + 1
    return count, F.floor(size / count).cast("int")


def _segment_index(texts: DataFrame, cutoff: float) -> tuple[DataFrame, DataFrame]:
    """Rows (id, size, low, high, key, at): the segments of each text, and the places where those of a text not longer can lie in it."""
    text, size = F.col("text"), F.col("size")
    key = lambda length, i, at: F.xxhash64(length, i, F.substring(text, at + 1, length)).alias("key")
    count, length = _segments(size, cutoff)
    own = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.struct(key(length, i, i * length), (i * length).alias("at")))
    shortest = F.greatest(F.lit(1), F.ceil(size * F.lit(cutoff / (2 - cutoff)) - F.lit(1e-9)).cast("int"))
    lengths = F.array_distinct(F.transform(F.sequence(shortest, size), lambda n: _segments(n, cutoff)[1]))
    slack = _slack(size + size, cutoff)

    def places(q, i):
        first, last = F.greatest(F.lit(0), i * q - F.floor(slack / 2).cast("int")), F.least(size - q, i * q + slack)
        return F.when(first <= last, F.transform(F.sequence(first, last), lambda at: F.struct(key(q, i, at), at.alias("at")))).otherwise(
            F.array().cast("array<struct<key:bigint,at:int>>")
        )

    met = F.flatten(F.transform(lengths, lambda q: F.flatten(F.transform(F.sequence(F.lit(0), count - 1), lambda i: places(q, i)))))
    return tuple(texts.select("id", "size", "low", "high", F.inline(rows)) for rows in (own, met))


def _work(left: DataFrame, right: DataFrame) -> int:
    """Pairs of rows with equal keys."""
    sides = left.select("key", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select("key", F.lit(0).alias("l"), F.lit(1).alias("r")))
    met = sides.groupBy("key").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    return met.agg(F.sum(F.col("l").cast("decimal(38,0)") * F.col("r"))).first()[0] or 0


def candidate_pairs(texts: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Pairs (a_id, b_id), a before b, among which are all that can reach the cutoff, for ``texts(id, text)``.

    A ratio of at least ``cutoff`` leaves few characters unmatched. Two indexes follow from that, each with rows in proportion to the text, and
    the one whose keys meet less often is taken. Grams: the texts share all but two grams for each unmatched character, so of their
    rarest grams, as many as may be lost and one more, they have one in common; good for words of which some are rare. Segments: the shorter text is cut
    into one segment more than there are unmatched characters, so one lies whole in the other text, shifted by no more than these; good
    for texts over few letters, all of whose grams are frequent. Where keys meet, parities of the grams drop nearly all pairs that aren't
    similar: an unmatched character changes three of them at most.
    """
    parity = "aggregate(grams, 0L, (s, g) -> s ^ if(crc32(g) % 128 {} 64, shiftleft(1L, cast(crc32(g) % 64 as int)), 0L))"
    grams = texts.select("id", "text", F.length("text").alias("size"), _grams(F.col("text")).alias("grams")).withColumns(
        {"low": F.expr(parity.format("<")), "high": F.expr(parity.format(">="))}
    )
    index, (own, met) = _gram_index(grams, cutoff), _segment_index(grams, cutoff)
    cut = _work(own, met) < _work(index, index)
    left, right = (own, met) if cut else (index, index)
    a, b = (side.select("key", *[F.col(c).alias(f"{p}_{c}") for c in side.columns if c != "key"]) for side, p in ((left, "a"), (right, "b")))
    slack, longer = _slack(F.col("a_size") + F.col("b_size"), cutoff), F.col("b_size") - F.col("a_size")
    flips = F.bit_count(F.col("a_low").bitwiseXOR(F.col("b_low"))) + F.bit_count(F.col("a_high").bitwiseXOR(F.col("b_high")))
    near = (F.abs(longer) <= slack) & (flips <= slack * 3)
    if cut:
        lost, shift = F.floor((slack - longer) / 2), F.col("b_at") - F.col("a_at")
        near = near & ((longer > 0) | ((longer == 0) & (F.col("a_id") < F.col("b_id")))) & shift.between(-lost, longer + lost)
    else:
        near = near & (F.col("a_id") < F.col("b_id"))
    # The planner takes exploded rows for as few as their source's, so it is told not to broadcast them.
    return a.join(b.hint("merge"), "key").filter(near).select(F.least("a_id", "b_id").alias("a_id"), F.greatest("a_id", "b_id").alias("b_id")).distinct()


def similar_pairs(values: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Pairs (earlier, later, score) of keys that reach the cutoff; ids give the order."""
    e = values.select(F.col("id").alias("earlier"), F.col("text").alias("e_text"))
    l = values.select(F.col("id").alias("later"), F.col("text").alias("l_text"))  # noqa: E741
    pairs = candidate_pairs(values, cutoff).select(F.col("a_id").alias("earlier"), F.col("b_id").alias("later"))
    joined = pairs.join(e, "earlier").join(l, "later")
    # Edit distance never exceeds the unmatched characters, so this drops no pair; beyond the slack it is not computed to its end.
    slack = _slack(F.length("e_text") + F.length("l_text"), cutoff)
    close = F.call_function("levenshtein", F.col("e_text"), F.col("l_text"), slack) >= 0
    joined = joined.filter((F.col("e_text") == F.col("l_text")) | close)
    return joined.withColumn("score", similarity("e_text", "l_text")).filter(F.col("score") >= cutoff).select("earlier", "later", "score", "e_text")


def followers(pairs: DataFrame) -> DataFrame:
    """(id, canonical) of all texts with an earlier similar one, for ``pairs(earlier, later)``.

    A text is canonical when no earlier canonical text is similar. What is still open is a set of conditions: a text follows if
    some target is canonical, or not canonical where ``flip`` is set. Each round settles texts whose targets are
    known. A text with one condition left stands for its target or the opposite, so others take that target instead, and
    chains shrink by half in a round.
    """
    rest = stage(pairs.select(F.col("earlier").alias("target"), "later", F.lit(False).alias("flip")))
    known = rest.select(F.col("target").alias("id")).distinct().join(rest.select(F.col("later").alias("id")).distinct(), "id", "left_anti")
    known, found = known.withColumn("canonical", F.lit(True)), None
    while True:
        valued = rest.join(known.select(F.col("id").alias("target"), "canonical"), "target", "left").withColumn("met", F.col("canonical") != F.col("flip"))
        verdict = valued.groupBy("later").agg(
            F.coalesce(F.bool_or("met"), F.lit(False)).alias("follows"), F.count_if(F.col("met").isNull()).alias("open"),
            F.min(F.when(F.col("met").isNull(), F.struct("target", "flip"))).alias("one"), F.max(F.when(F.col("met").isNull(), F.struct("target", "flip"))).alias("last"),
        )
        verdict = stage(verdict)
        known = verdict.filter("follows OR open = 0").select(F.col("later").alias("id"), (~F.col("follows")).alias("canonical"))
        found = known if found is None else found.unionByName(known)
        undecided = verdict.filter("NOT follows AND open > 0")
        if undecided.isEmpty():
            return found
        single = undecided.filter("one = last").select(
            F.col("later").alias("target"), F.col("one.target").alias("instead"), (~F.col("one.flip")).alias("turn")
        )
        left = valued.filter("met IS NULL").join(undecided.select("later"), "later", "left_semi").join(single, "target", "left")
        rest = stage(
            left.select(
                F.coalesce("instead", "target").alias("target"), "later", (F.col("flip") != F.coalesce("turn", F.lit(False))).alias("flip")
            ).distinct()
        )


def fuzzy_mapping(df: DataFrame, column: str, order_by: str, cutoff: float = CUTOFF) -> DataFrame:
    """Rows (value, replacement): texts in order of appearance follow the closest earlier canonical one.

    A text is canonical when no earlier canonical text is similar.
    """
    text = strip(F.col(f"`{column}`").cast("string"))
    distinct = (
        df.select(text.alias("value"), F.col(order_by).alias("at")).filter("value != ''")
        .groupBy("value").agg(F.min("at").alias("at"))
        .withColumn("text", F.upper(ascii_fold(F.col("value"))))
    )
    distinct = stage(add_sequential_id(distinct, ["at", "value"], column="id"))
    pairs = stage(similar_pairs(distinct.filter("text != ''").select("id", "text"), cutoff))
    settled = stage(followers(pairs.select("earlier", "later")))
    followed = (
        pairs.join(settled.filter("NOT canonical").select(F.col("id").alias("later")), "later")
        .join(settled.filter("NOT canonical").select(F.col("id").alias("earlier")), "earlier", "left_anti")
        .groupBy(F.col("later").alias("id"))
        .agg(F.max_by("earlier", F.struct("score", "e_text")).alias("target"))
    )
    names = distinct.select(F.col("id").alias("target"), F.col("value").alias("replacement"))
    return (
        distinct.select("id", "value").join(followed, "id", "left").join(names, "target", "left")
        .select("value", F.coalesce("replacement", "value").alias("replacement"))
    )


def suggestions(mapping: DataFrame, limit: int = 100) -> DataFrame:
    """The first corrections of a mapping, for a report."""
    return mapping.filter("value != replacement").orderBy("value").limit(limit)
